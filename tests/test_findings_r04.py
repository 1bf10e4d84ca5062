"""What the findings of round 4 were about."""

import datetime as dt

import pytest

from pelagic.operators import catalog as c
from pelagic.plans import REGISTRY

DAY = dt.date(2024, 1, 1)


@pytest.mark.parametrize("copies", [1, 3])
@pytest.mark.parametrize("keep", [("file_id",), ("file_id", "n_bytes"), ()])
def test_tiles_of_queries_with_the_columns_that_are_kept(spark, monkeypatch, keep, copies):
    monkeypatch.setattr(c, "CHUNK", 4)
    boxes = [(k + 10 * m, 1.0 + k, 2.0 + k, 1.0, 2.0, DAY + dt.timedelta(days=k % 2), DAY + dt.timedelta(days=2)) for k in range(9) for m in range(copies)]
    tiles = [(k if k % 7 else None, DAY + dt.timedelta(days=k % 4), k % 2, k % 3, 10 * k) for k in range(90)]
    sides = [(0.0, 5.0), (5.0, 40.0)]
    regions = spark.createDataFrame([(k, *s, 0.0, 40.0) for k, s in enumerate(sides)], "region_id int, r_lon_min double, r_lon_max double, r_lat_min double, r_lat_max double")
    d = c.query_tiles(
        spark.createDataFrame(boxes, "query_id long, lon_min double, lon_max double, lat_min double, lat_max double, date_start date, date_end date"),
        spark.createDataFrame(tiles, "file_id long, obs_date date, region_id int, source_id int, n_bytes long"), spark.createDataFrame([(0,), (2,)], "source_id int"), regions, *keep,
    )
    own = keep or ("source_id", "file_id", "n_bytes")
    assert set(d.columns) == {"obs_date", "region_id", "query_id", *own}
    value = {"file_id": 0, "source_id": 3, "n_bytes": 4}
    want = [(q[0], t[1], t[2], *[t[value[o]] for o in own]) for q in boxes for t in tiles if t[3] != 1 and q[5] <= t[1] <= q[6] and q[2] > sides[t[2]][0] and q[1] < sides[t[2]][1]]
    got = [(r["query_id"], r["obs_date"], r["region_id"], *[r[o] for o in own]) for r in d.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(x[3] is None for x in got if own[0] == "file_id") == (own[0] == "file_id")


def test_files_stand_in_plain_arrays_before_they_become_rows(spark):
    """Structs would be cut to their one column anew for every query."""
    plan = REGISTRY.queries["j1_tiles_of_queries"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(__tiles" in plan and "_extract_" not in plan

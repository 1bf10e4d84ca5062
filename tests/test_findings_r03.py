"""What the findings of round 3 were about."""

import datetime as dt

import numpy as np
import pytest

from pelagic.operators import boxes as b
from pelagic.operators import catalog as c
from pelagic.operators import spectra as sp
from pelagic.operators import statistics as st
from pelagic.sources.tables import written

DAY = dt.date(2024, 1, 1)


def test_a_line_with_points_alike_in_its_order_has_one_spectrum(spark):
    r = np.random.default_rng(2)
    rows = [(1, float(k // 2), k, float(v)) for k, v in enumerate(r.normal(size=64))]
    want = sp.psd_1d(np.array([x[3] for x in rows]), 10.0, 16)
    for seed in (1, 2):
        mixed = spark.createDataFrame([rows[k] for k in np.random.default_rng(seed).permutation(64)], "line int, at double, id long, v double")
        got = sorted((x["k"], x["psd"]) for x in sp.line_spectra(mixed, ("line",), ("at", "id"), "v", 10.0, 16).collect())
        assert np.allclose([x[0] for x in got], want[0]) and np.allclose([x[1] for x in got], want[1])


BOXES = "query_id long, lon_min double, lon_max double, lat_min double, lat_max double, date_start date, date_end date"


def plain_iou(u, v):
    w = [max(0.0, min(u[k + 1], v[k + 1]) - max(u[k], v[k])) for k in (1, 3)]
    both = w[0] * w[1]
    return both / ((u[2] - u[1]) * (u[4] - u[3]) + (v[2] - v[1]) * (v[4] - v[3]) - both) if u[5] <= v[6] and v[5] <= u[6] else 0.0


def some_boxes(n, seed, repeats=1):
    """Boxes of two days, each so often."""
    r, out = np.random.default_rng(seed), []
    for k in range(n):
        x, y, day = r.uniform(0, 25), r.uniform(0, 25), DAY + dt.timedelta(days=int(r.integers(4)))
        out += [(k + n * m, float(x), float(x + 8), float(y), float(y + 8), day, day + dt.timedelta(days=1)) for m in range(repeats)]
    return sorted(out)


@pytest.mark.parametrize("n,head", [(60, 20), (60, 1000)])
def test_greedy_boxes_in_rounds_equal_a_plain_loop(spark, n, head):
    rows, kept = some_boxes(n, 3), []
    for u in rows:
        if all(plain_iou(u, v) <= 0.2 for v in kept):
            kept.append(u)
    d, cut = spark.createDataFrame(rows, BOXES), written(spark)
    assert sorted(r["query_id"] for r in b.greedy_boxes(d, 0.2, cut, head=head).collect()) == [u[0] for u in kept]
    first = b.greedy_boxes(d, 0.2, cut, 5, head).orderBy("query_id").limit(5)
    assert [r["query_id"] for r in first.collect()] == [u[0] for u in kept[:5]]


def test_equal_boxes_are_compared_once_and_give_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(b, "CHUNK", 2)
    rows = some_boxes(30, 5, 5)
    want = {(u[0], v[0]): plain_iou(u, v) for u in rows for v in rows if u[0] < v[0] and plain_iou(u, v) > 0.1}
    got = b.overlapping_boxes(spark.createDataFrame(rows, BOXES), 0.1).collect()
    assert len(got) == len(want) and all(abs(want[r["a"], r["b"]] - r["iou"]) < 1e-9 for r in got)
    seen = []
    found = b.for_equal_boxes(spark.createDataFrame([(*u, u[0] % 7) for u in rows] + [(999, *rows[0][1:4], None, *rows[0][5:], 3)], f"{BOXES}, more long"), lambda q: (seen.append(q.count()), q.select("query_id", "lon_min"))[1], "more")
    assert seen == [31] and sorted(map(tuple, found.collect())) == [(u[0], u[1], u[0] % 7) for u in rows] + [(999, rows[0][1], 3)]


def test_statistics_of_weighted_rows_equal_those_of_all(spark):
    r = np.random.default_rng(4)
    rows = [(k, "ab"[k % 2], float(v), int(w)) for k, (v, w) in enumerate(zip(r.normal(size=60).round(1), r.integers(1, 9, 60)))]
    found = {x["variable"]: x for x in st.sample_statistics(spark.createDataFrame(rows, "query_id long, variable string, value double, w long"), weight="w").collect()}
    for name in "ab":
        every = np.repeat([x[2] for x in rows if x[1] == name], [x[3] for x in rows if x[1] == name])
        got = found[name]
        assert got["count"] == len(every) and np.allclose([got[c] for c in ("mean", "std", "var", "min", "max")], [every.mean(), every.std(), every.var(), every.min(), every.max()])
        assert np.allclose([got["p_low"], got["p_high"]], np.percentile(every, [2, 98]))


def test_pairs_of_boxes_are_made_by_many_tasks(spark):
    for repeats in (1, 3):
        found = b.overlapping_boxes(spark.createDataFrame(some_boxes(60, 5, repeats), BOXES), 0.1)
        assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("repeats", [1, 3])
def test_tiles_meet_queries_in_chunks_over_many_tasks(spark, monkeypatch, repeats):
    monkeypatch.setattr(c, "CHUNK", 4)
    rows, r = some_boxes(20, 6, repeats), np.random.default_rng(7)
    tiles = [(k, DAY + dt.timedelta(days=int(r.integers(5))), int(r.integers(2)), k % 3) for k in range(300)] + [(None, DAY, 0, 0)] * 2
    regions = spark.createDataFrame([(0, 0.0, 12.0, 0.0, 40.0), (1, 12.0, 40.0, 0.0, 20.0)], "region_id int, r_lon_min double, r_lon_max double, r_lat_min double, r_lat_max double")
    sides = [(0.0, 12.0, 0.0, 40.0), (12.0, 40.0, 0.0, 20.0)]
    meets = lambda u, s: u[2] > s[0] and u[1] < s[1] and u[4] > s[2] and u[3] < s[3]
    want = [(u[0], *t) for u in rows for t in tiles if t[3] < 2 and u[5] <= t[1] <= u[6] and meets(u, sides[t[2]])]
    found = c.query_tiles(spark.createDataFrame(rows, BOXES), spark.createDataFrame(tiles, "file_id long, obs_date date, region_id int, source_id int"), spark.createDataFrame([(0,), (1,)], "source_id int"), regions)
    got = [(x["query_id"], x["file_id"], x["obs_date"], x["region_id"], x["source_id"]) for x in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 100
    assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_equal_boxes_meet_points_of_split_tiles_as_one(spark, monkeypatch):
    seen, plain = [], b.exploded_days
    monkeypatch.setattr(b, "exploded_days", lambda boxes: (seen.append(boxes.count()), plain(boxes))[1])
    rows, r = [(*u, u[0] % 7) for u in some_boxes(20, 8, 3)], np.random.default_rng(9)
    points = [(k, float(r.uniform(0, 30)), float(r.uniform(0, 30)), DAY + dt.timedelta(days=int(r.integers(6)))) for k in range(400)]
    found = b.boxes_points_adaptive(spark.createDataFrame(rows, f"{BOXES}, more long"), spark.createDataFrame(points, "obs_id long, lon double, lat double, obs_date date"), 3, 3)
    got = sorted((x["query_id"], x["more"], x["obs_id"]) for x in found.collect())
    assert got == sorted((u[0], u[7], p[0]) for u in rows for p in points if u[1] <= p[1] <= u[2] and u[3] <= p[2] <= u[4] and u[5] <= p[3] <= u[6])
    assert seen == [20] and set(found.columns) == {"query_id", "more", *b.BOX, "obs_id", "lon", "lat", "obs_date"}

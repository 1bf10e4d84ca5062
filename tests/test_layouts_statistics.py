"""Stored layouts and their plans, selection of percentiles, kept states, special functions, patches of their own size."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagic.functions import special
from pelagic.operators import boxes as b
from pelagic.operators import matching as m
from pelagic.operators import samples as p
from pelagic.operators import scans as sc
from pelagic.operators import skill
from pelagic.operators import statistics as st
from pelagic.sources import tables

DAY = dt.date(2024, 1, 1)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_stored_products_join_without_a_shuffle(spark, no_broadcast):
    cells = spark.range(4000).select(F.date_add(F.lit(DAY), (F.col("id") % 10).cast("int")).alias("obs_date"), (F.col("id") % 36).cast("int").alias("i"), (F.col("id") % 18).cast("int").alias("j"), (F.col("id") * 1.0).alias("val"))
    a, g = tables.save_bucketed(cells.withColumnRenamed("val", "value"), buckets=4), tables.save_bucketed(cells, buckets=4)
    for joined in (m.both_valid(a, g), m.co_located({"obs": a.withColumnRenamed("value", "val"), "ref": g})):
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert "Exchange" in plan(m.both_valid(cells.withColumnRenamed("val", "value"), cells))
    assert m.both_valid(a, g).count() == m.both_valid(cells.withColumnRenamed("val", "value"), cells).count()


def test_stored_tiles_compare_without_a_shuffle_and_a_stored_grid_stays_where_it_is(spark, no_broadcast):
    place = [F.floor(F.col("id") / 648).cast("int"), F.floor(F.col("id") % 36 / 9).cast("int"), (F.col("id") % 36).cast("int"), F.floor(F.col("id") % 648 / 36).cast("int")]
    cells = spark.range(3000).select(F.date_add(F.lit(DAY), place[0]).alias("obs_date"), place[1].alias("region_id"), F.lit("s").alias("source"), F.lit("v").alias("variable"), place[2].alias("i"), place[3].alias("j"), (F.col("id") * 1.0).alias("val"))
    a, c = (tables.save_bucketed(x, st.TILE_KEYS, 4) for x in (cells, cells.withColumn("val", F.col("val") + 1)))
    assert "Exchange" not in plan(st.compared_tiles(a, c)) and st.compared_tiles(a, c).where("packed - orig = 1").count() == 3000
    points = spark.range(500).select(F.col("id").alias("obs_id"), F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("obs_date"), (F.col("id") % 300 - 150.5).alias("lon"), (F.col("id") % 100 - 50.25).alias("lat"))
    grid = cells.select("obs_date", "i", "j", "val")
    stored = m.bilinear(points, tables.save_bucketed(grid, buckets=4), -175.0, -85.0, 10.0)
    assert plan(stored).count("Exchange hash") == plan(m.bilinear(points, grid, -175.0, -85.0, 10.0)).count("Exchange hash") - 1


def test_stored_tiles_are_pruned(spark, tmp_path):
    cells = spark.range(2000).select(F.lit("l4_ssh").alias("product"), F.date_add(F.lit(DAY), (F.col("id") % 10).cast("int")).alias("obs_date"), (F.col("id") % 8).cast("int").alias("region_id"), (F.col("id") * 1.0).alias("val"))
    path = str(tmp_path / "tiles")
    tables.write_tiles(cells, path, ("product", "obs_date", "region_id"))
    stored = tables.read_tiles(spark, path, cells.schema)
    one = sc.load_tile(stored, "2024-01-03", 2, "l4_ssh")
    assert "PartitionFilters: [isnotnull(obs_date" in plan(one) and one.count() == cells.where("obs_date = DATE '2024-01-03' AND region_id = 2").count() > 0
    catalog = spark.createDataFrame([(k, DAY + dt.timedelta(days=k % 10), k % 8, k % 3) for k in range(60)], "file_id long, obs_date date, region_id int, source_id int")
    catalog.write.parquet(str(tmp_path / "catalog"))
    listed = spark.read.parquet(str(tmp_path / "catalog")).where("source_id = 1 AND obs_date < DATE '2024-01-04'")
    found = sc.load_listed(stored, listed)
    rows = found.collect()
    assert "dynamicpruning" in plan(found) and {(r["obs_date"], r["region_id"]) for r in rows} <= {(r["obs_date"], r["region_id"]) for r in listed.collect()} and rows


def test_a_hot_tile_is_spread(spark):
    r = random.Random(0)
    hot = [(k, DAY, 2.5 + r.random() * 0.01, 1.0 + r.random() * 0.01, 1.0) for k in range(3600)] + [(k, DAY, 2.5, 1.0, 1.0) for k in range(5000, 5200)]
    cold = [(10_000 + k, DAY, r.uniform(-180, 180), r.uniform(-90, 90), 1.0) for k in range(400)]
    points = spark.createDataFrame(hot + cold, "obs_id long, obs_date date, lon double, lat double, val double")
    boxes = spark.createDataFrame([(k, *x, DAY, DAY) for k, x in enumerate([(0.0, 5.0, 0.0, 5.0), (2.504, 2.507, 0.5, 1.005), (2.5, 2.5, 1.0, 1.0), (-180.0, 180.0, -90.0, 90.0), (10.0, 20.0, 10.0, 20.0)])], "query_id long, lon_min double, lon_max double, lat_min double, lat_max double, date_start date, date_end date")
    plain = {(x["query_id"], x["obs_id"]) for x in b.boxes_points(boxes, points).collect()}
    found = b.boxes_points_adaptive(boxes, points, 100, 4)
    rows = [(x["query_id"], x["obs_id"]) for x in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain
    splits = {(x["cut"], x["tile_i"], x["tile_j"]): x["parts"] for x in b.split_tiles(points, 100, 4).collect()}
    assert splits[0, 36, 18] == 1 and splits[4, 584, 291] > 35  # the whole hot place lies in one of the finest tiles


@pytest.mark.parametrize("most", [50_000, 20])
def test_percentiles_by_selection(spark, most):
    r = np.random.default_rng(5)
    groups = {"ties": np.full(3000, 4.25), "mostly": np.r_[np.full(4000, -1.0), r.normal(size=500)], "wide": np.sign(r.normal(size=5000)) * 10.0 ** r.uniform(-200, 200, 5000), "few": np.array([3.0, 1.0, 2.0]), "one": np.array([7.0]), "normal": r.normal(size=20_000)}
    frame = spark.createDataFrame([(k, float(v)) for k, own in groups.items() for v in own] + [("few", None), ("few", float("nan"))], "g string, v double").repartition(5)
    at = [0.0, 0.02, 0.25, 0.5, 0.95, 1.0]
    got = {x["g"]: x for x in st.exact_percentiles(frame, ("g",), "v", at, 200, most).collect()}
    for g, own in groups.items():
        assert got[g]["n"] == len(own) and np.allclose(got[g]["q"], np.percentile(own, [100 * p for p in at]), rtol=1e-12, atol=0), g
    assert st.exact_percentiles(frame.where("g = 'none'"), ("g",), "v", at).count() == 0


def test_a_million_values_leave_few_to_order(spark):
    frame = spark.range(1_000_000).select(F.sin("id").alias("v"))
    assert np.allclose(st.exact_percentiles(frame, (), "v", [0.5, 0.98], most=100).first()["q"], np.percentile(np.sin(np.arange(1_000_000)), [50, 98]), atol=1e-12)


def test_kept_states_equal_one_pass(spark, tmp_path):
    r = np.random.default_rng(2)
    data = [(int(k % 3), DAY + dt.timedelta(days=int(k % 11)), float(x) + 1e6) for k, x in enumerate(r.normal(size=20_000))]
    frame = spark.createDataFrame(data, "g int, obs_date date, val double")
    path = str(tmp_path / "states")
    for low, high in ((0, 8), (6, 11), (2, 4), (2, 4)):
        st.keep_states(st.day_states(frame.where(F.date_diff("obs_date", F.lit(DAY)).between(low, high)), ("g",)), path)
    states = st.read_states(spark, path, st.day_states(frame, ("g",)).schema)
    at = (0.02, 0.5, 0.98)
    for row in st.merged_states(states, ("g",), at).collect():
        own = np.sort([v for g, _, v in data if g == row["g"]])
        assert row["n"] == len(own) and math.isclose(row["mean"], own.mean(), rel_tol=1e-12) and math.isclose(row["std"], own.std(), rel_tol=1e-7) and (row["min"], row["max"]) == (own[0], own[-1])
        assert max(abs(np.searchsorted(own, q) / len(own) - p) for q, p in zip(row["q"], at)) < 0.01


def test_p_values_against_an_integral(spark):
    rows = [(float(r), n) for n in (3, 4, 5, 12, 60, 1000, 50_000) for r in (0.0, 1e-3, -0.02, 0.1, -0.3, 0.7, 0.99, 1.0, -1.0)]
    found = spark.createDataFrame(rows, "r double, n long").select("r", "n", special.correlation_p(F.col("r"), F.col("n")).alias("p")).collect()
    x, w = np.polynomial.legendre.leggauss(400)
    def power(low, high, k):  # the integral of cos^k, in pieces
        edges = np.linspace(low, high, 41)
        return sum((b - a) / 2 * (w * np.cos((b - a) / 2 * x + (a + b) / 2) ** k).sum() for a, b in zip(edges, edges[1:]))
    for row in found:
        want = power(math.asin(min(1.0, abs(row["r"]))), math.pi / 2, row["n"] - 3) / power(0, math.pi / 2, row["n"] - 3)
        assert abs(row["p"] - want) < 1e-9, (row, want)
    two = spark.createDataFrame([(0.5, 2)], "r double, n long").select(special.correlation_p(F.col("r"), F.col("n"))).first()[0]
    assert two is None


def test_log_beta(spark):
    a = [0.5, 1.0, 2.5, 30.0, 1e4, 1e9]
    got = spark.createDataFrame([(x,) for x in a], "a double").select("a", special.log_beta_half(F.col("a")).alias("b")).collect()
    assert all(abs(r["b"] - (math.lgamma(r["a"]) + math.lgamma(0.5) - math.lgamma(r["a"] + 0.5))) < 1e-9 * max(1, abs(r["b"])) for r in got if r["a"] < 1e6)


def test_a_day_missing_in_both_series_counts(spark):
    pairs = spark.createDataFrame([(DAY + dt.timedelta(days=k), 0, 0, float(k), k * 2.0) for k in (0, 1, 3)], "obs_date date, i int, j int, obs double, ref double")
    assert skill.temporal_correlation(pairs).first()["r"] is None
    assert skill.temporal_correlation(pairs.where("obs_date < DATE '2024-01-03'")).first()["r"] == 1.0


def test_each_patch_from_its_own_size_to_its_own(spark):
    r, rows, patches = np.random.default_rng(3), [], {}
    for k in range(30):
        n_j, n_i, h, w = (int(x) for x in r.integers(1, 12, 4))
        patch = r.normal(size=(n_j, n_i))
        patch[r.random((n_j, n_i)) < 0.3] = np.nan
        patches[k] = (patch, (h, w))
        rows += [(k, n_i, n_j, h, w, i, j, None if np.isnan(patch[j, i]) else float(patch[j, i])) for j in range(n_j) for i in range(n_i)]
    got = p.resize_each(spark.createDataFrame(rows, "k int, n_i int, n_j int, h int, w int, i int, j int, val double"), ("k",)).collect()
    found = {(x["k"], x["j"], x["i"]): x["value"] for x in got}
    for k, (patch, shape) in patches.items():
        want = p.resize_reference(patch, shape)
        for j in range(shape[0]):
            for i in range(shape[1]):
                value = found.get((k, j, i))
                assert np.isnan(want[j, i]) if value is None else abs(value - want[j, i]) < 1e-9


def test_batches_are_padded_to_their_largest_patch(spark):
    boxes = spark.createDataFrame([(k, 0.0, 1.0, 0.0, 1.0, DAY, DAY) for k in range(5)], "query_id long, lon_min double, lon_max double, lat_min double, lat_max double, date_start date, date_end date")
    sizes = {0: (1, 2, 3), 1: (2, 3, 2), 3: (1, 1, 1)}  # times, rows, columns; 2 and 4 have no data
    rows = [(q, "v", 1, n_t, h, w, t, i, j, float(100 * t + 10 * j + i + 1)) for q, (n_t, h, w) in sizes.items() for t in range(n_t) for j in range(h) for i in range(w)]
    patches = spark.createDataFrame(rows, "query_id long, variable string, n_files long, n_t int, h int, w int, t int, i int, j int, value double")
    samples = p.assemble_patches(boxes, patches.select("variable"), patches, (4, 5))
    assert {(r["query_id"], r["present"], len(r["data"]), len(r["lats"]), len(r["lons"])) for r in samples.collect()} == {(0, True, 6, 2, 3), (1, True, 12, 3, 2), (2, False, 0, 4, 5), (3, True, 1, 1, 1), (4, False, 0, 4, 5)}
    out = {r["batch"]: r for r in p.collate_patches(samples, 3, tables.written(spark)).collect()}
    first = out[0]
    assert (first["top_t"], first["top_h"], first["top_w"]) == (2, 3, 3) and first["query_ids"] == [0, 1] and len(first["bboxes"]) == 3 and len(first["lons"]) == 3
    for query, data in zip(first["query_ids"], first["data"]):
        want = np.zeros((2, 3, 3))
        for q, _, _, _, _, _, t, i, j, v in rows:
            if q == query:
                want[t, j, i] = v
        assert np.array_equal(np.array(data).reshape(2, 3, 3), want)
    assert out[1]["query_ids"] == [3] and out[1]["data"] == [[1.0]] and len(out[1]["time_ranges"]) == 2


def test_the_folder_of_one_machine_is_refused_on_a_cluster(spark, monkeypatch):
    class Conf:
        def getConf(self):  # noqa: N802
            return self

        def get(self, key, default=""):
            return default

        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Conf()  # noqa: N815
        conf = type("C", (), {"get": staticmethod(lambda key, default="/tmp/warehouse": default or "")})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(Session())

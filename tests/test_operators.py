"""Exact semantics on hand-made frames, and numpy as the oracle of rasters and spectra."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagic.dims import source_token
from pelagic.functions import codec, geo
from pelagic.operators import boxes as b
from pelagic.operators import catalog as c
from pelagic.operators import gridding as g
from pelagic.operators import matching as m
from pelagic.operators import samples as p
from pelagic.operators import scans as sc
from pelagic.operators import spectra as sp
from pelagic.operators import statistics as st
from pelagic.plans import catalog as catalog_plans
from pelagic.sources import tables
from pelagic.streaming import jobs

DAY = dt.date(2024, 1, 1)


def test_nan_is_missing(spark):
    d = spark.createDataFrame([(1, 1, DAY, 0.5, 0.5, 1.0), (2, 1, DAY, 0.5, 0.5, float("nan")), (3, 2, DAY, 0.5, 0.5, float("inf"))], "obs_id long, track_id long, obs_date date, lon double, lat double, val double")
    row = g.bin_points(d, 1.0).first()
    assert (row["value"], row["n_obs"]) == (1.0, 1)
    assert not g.grid_daily_tracks(d, 1.0).first()["is_overlap"]


def test_longitudes_regions_and_bins(spark):
    d = spark.createDataFrame([(190.0,), (-190.0,), (180.0,), (-180.0,), (360.0,)], "x double")
    assert [r[0] for r in d.select(geo.lon_to_180(F.col("x"))).collect()] == [-170.0, 170.0, -180.0, -180.0, 0.0]
    d = spark.createDataFrame([(-180.0, -90.0, 0), (179.9, 89.9, 7), (180.0, 0.0, None), (0.0, 90.0, None)], "x double, y double, want int")
    assert all(r[0] == r[1] for r in d.select(geo.region_id(F.col("x"), F.col("y")), "want").collect())
    d = spark.createDataFrame([(0.0, 0, None), (2.0, 1, 0), (3.9, 1, 1), (4.0, 1, 1), (9.0, 1, None)], "x double, l int, r int")
    assert all((r[0], r[1]) == (r[2], r[3]) for r in d.select(geo.bin_left(F.col("x"), 0, 2, 2), geo.bin_right(F.col("x"), 0, 2, 2), "l", "r").collect())
    d = spark.createDataFrame([(0.0, 0), (4.0, 1), (4.1, None), (-0.1, None)], "x double, want int")
    assert all(r[0] == r[1] for r in d.select(geo.cell_index(F.col("x"), 0.0, 2.0, 2), "want").collect())


def test_box_across_the_date_line(spark):
    d = spark.createDataFrame([(175.0, True), (-175.0, True), (0.0, False), (170.0, True)], "x double, want boolean")
    assert all(r[0] == r[1] for r in d.select(geo.in_box(F.col("x"), F.lit(0.0), geo.BBox(170, -170, -1, 1)), "want").collect())


def test_degrees_of_km_on_the_ellipsoid():
    lon, lat = geo.degrees_of_km(100.0, 0.0)
    assert math.isclose(lon, 100 / 111.31949, rel_tol=1e-6) and math.isclose(lat, 100 / 110.57427, rel_tol=1e-6)


def test_packing_rounds_half_to_even_and_bounds_the_error(spark):
    d = spark.createDataFrame([(0.00025,), (0.00075,), (None,), (1.23456,)], "v double")
    rows = d.select("v", codec.pack(F.col("v"), 0.0005, 0.0).alias("p")).select("v", "p", codec.unpack(F.col("p"), 0.0005, 0.0).alias("u")).collect()
    assert [r["p"] for r in rows][:3] == [0, 2, codec.FILL] and rows[2]["u"] is None
    assert all(r["v"] is None or abs(r["u"] - r["v"]) <= 0.00025 + 1e-12 for r in rows)
    names = spark.createDataFrame([("sla", 0.0005), ("analysed_sst", 0.001), ("sst_flag", 1.0), ("so", 0.002), ("uo", 0.001), ("thing", None)], "n string, want double")
    assert all(r[0] == r[1] for r in names.select(codec.codec(F.col("n"))["scale"], "want").collect())


def test_moments_of_too_few(spark):
    d = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0)], "k string, val double")
    got = {r["k"]: tuple(r)[1:] for r in st.moments(d, ("k",)).collect()}
    assert got == {"a": (0.0, 1.0, 0.0, 0.0, 0.0, 0), "b": (2.0, 1.0, 1.0, 1.0, 3.0, 2)}


def test_greedy_boxes_equal_a_plain_loop(spark):
    r = np.random.default_rng(3)
    at = r.uniform(0, 30, (80, 2))
    d = spark.createDataFrame([(i, float(x), float(x + 8), float(y), float(y + 8), DAY, DAY) for i, (x, y) in enumerate(at)], "query_id long, lon_min double, lon_max double, lat_min double, lat_max double, date_start date, date_end date")

    def iou(u, v):
        w = np.maximum(0, 8 - np.abs(at[u] - at[v])).prod()
        return w / (128 - w)

    kept = []
    for i in range(80):
        if all(iou(i, k) <= 0.2 for k in kept):
            kept.append(i)
    got = b.greedy_accept(d, b.overlapping_boxes(d, 0.2).select("a", "b").persist(), lambda x: x.persist())
    assert sorted(r["query_id"] for r in got.collect()) == kept


def test_patch_starts_reach_the_end():
    assert b.starts(0, 10, 4, 0.5) == [0, 2, 4, 6] and b.starts(0, 9, 4, 0.5) == [0, 2, 4, 5]


@pytest.mark.parametrize("shape,out", [((6, 5), (9, 4)), ((4, 4), (4, 4)), ((3, 8), (2, 16))])
def test_resize_against_numpy(spark, shape, out):
    r = np.random.default_rng(0)
    patch = r.normal(size=shape)
    patch[0, 0] = patch[1, 1] = np.nan
    rows = [(1, i, j, None if math.isnan(patch[i, j]) else float(patch[i, j])) for i in range(shape[0]) for j in range(shape[1])]
    got = np.full(out, np.nan)
    for x in p.resize(spark.createDataFrame(rows, "k int, i int, j int, val double"), shape, out, ("k",)).collect():
        got[x["i"], x["j"]] = np.nan if x["value"] is None else x["value"]
    assert np.allclose(got, p.resize_reference(patch, out), atol=1e-9, equal_nan=True)


def test_smoothing_keeps_a_constant_and_skips_gaps(spark):
    rows = [(1, i, j, 5.0 if (i + j) % 3 else None) for i in range(8) for j in range(8)]
    assert all(abs(r["value"] - 5.0) < 1e-9 for r in p.smooth(spark.createDataFrame(rows, "k int, i int, j int, val double"), 1.0, 8, 8, ("k",)).collect())


def test_spectrum_finds_a_wave_and_its_variance():
    x = np.arange(400)
    k, psd = sp.psd_1d(np.sin(2 * np.pi * x / 20) + 0.001 * x, 1.0)
    assert abs(k[psd.argmax()] - 0.05) < 0.003 and abs(np.trapezoid(psd, k) - 0.5) < 0.05
    assert not len(sp.psd_1d(np.zeros(10), 1.0)[0])
    field = np.sin(2 * np.pi * np.arange(64) / 8)[None, :] * np.ones((64, 1))
    k, psd = sp.psd_2d(field, 1.0, 1.0)
    assert abs(k[(psd / k).argmax()] - 1 / 8) < 0.02
    assert not len(sp.psd_2d(np.full((8, 8), np.nan), 1.0, 1.0)[0])


def test_average_spectra_of_power_laws(spark):
    rows = [(line, 0, float(k), float(a * k**-2)) for line, a in ((1, 1.0), (2, 100.0)) for k in np.geomspace(0.01, 1, 30)]
    got = sp.average_spectra(spark.createDataFrame(rows, "line int, g int, k double, psd double"), ("line",), ("g",), 20).collect()
    assert len(got) == 20 and all(abs(r["psd"] - 10 * r["k"] ** -2) < 1e-6 * r["psd"] and r["n"] == 2 for r in got)


def test_bilinear_of_a_plane_is_exact(spark):
    grid = spark.createDataFrame([(DAY, i, j, 2.0 * i + 3.0 * j) for i in range(5) for j in range(5)], "obs_date date, i int, j int, val double")
    points = spark.createDataFrame([(1, DAY, 1.5, 2.25), (2, DAY, 4.0, 4.0), (3, DAY, 4.5, 1.0)], "obs_id long, obs_date date, lon double, lat double")
    got = {r["obs_id"]: r["grid_val"] for r in m.bilinear(points, grid, 0.0, 0.0, 1.0).collect()}
    assert got == {1: 9.75, 2: 20.0, 3: None}


def test_unknown_tiles_sources_and_ranges(spark):
    cells = spark.createDataFrame([], "product string, obs_date date, region_id int, lon double, lat double")
    with pytest.raises(ValueError):
        sc.load_tile(cells, "2024-01-01", 9, "x")
    with pytest.raises(ValueError):
        sc.multi_source_series(cells, ["x"], "2024-01-01", "2024-01-02")
    with pytest.raises(ValueError):
        b.evaluation_grid(spark, geo.BBox(0, 10, 0, 10), 5.0, 0.0, "2024-01-01", 2, 1, 3)
    with pytest.raises(Exception, match="blank source"):
        spark.range(1).select(source_token(F.lit("  "))).collect()
    assert sc.first_present(spark.createDataFrame([], "Latitude double, sla_x double"), ["sla"]) == "sla_x"


def test_batches_pad_and_mark_absent_samples(spark):
    rows = [(3, "v", True, 2, 2, [1.0, 2.0, 3.0, 4.0]), (8, "v", False, 1, 3, [5.0, 6.0, 7.0]), (40, "v", True, 1, 1, [9.0])]
    frame = spark.createDataFrame(rows, "query_id long, variable string, present boolean, h int, w int, data array<float>")
    got = {r["batch"]: r for r in p.collate(frame, 2, lambda x: x.persist()).collect()}
    assert got[0]["data"] == [[1.0, 2.0, 0.0, 3.0, 4.0, 0.0], [5.0, 6.0, 7.0, 0.0, 0.0, 0.0]] and got[0]["present"] == [True, False]
    assert (got[1]["query_ids"], got[1]["data"]) == ([40], [[9.0]])


def test_numbers_follow_the_order_of_ids(spark):
    ids = [k * 7 % 1009 for k in range(1000)]
    got = p.numbered(spark.createDataFrame([(k,) for k in ids for _ in range(2)], "id long"), "id", lambda x: x.persist()).collect()
    assert sorted((r["id"], r["number"]) for r in got) == [(k, n) for n, k in enumerate(sorted(ids))]


@pytest.mark.parametrize("n", [1, 2, 9, 2500])
def test_exact_percentiles(spark, n):
    r = np.random.default_rng(n)
    values = {k: np.round(r.normal(size=n), 2) for k in ("a", "b")}
    rows = [(k, float(v)) for k, own in values.items() for v in own] + [("a", None), ("b", float("nan")), ("c", None)]
    at = [0.0, 0.02, 0.5, 0.95, 1.0]
    got = {x["k"]: x for x in st.exact_percentiles(spark.createDataFrame(rows, "k string, v double"), ("k",), "v", at).collect()}
    assert set(got) == {"a", "b"} and all(got[k]["n"] == n and np.allclose(got[k]["q"], np.quantile(values[k], at)) for k in got)


def test_coarse_grids_warn(spark):
    d = spark.createDataFrame([(1, 1, DAY, 0.5, 0.5, 1.0)], "obs_id long, track_id long, obs_date date, lon double, lat double, val double")
    with pytest.warns(UserWarning, match="coarser"):
        assert g.grid_each_track(d, 1.0, 2.0).count() == 1
    assert g.grid_each_track(d, 0.01, 2.0).count() == 1


def test_upserts_of_two_batches_keep_both(spark, tmp_path):
    schema = "file_id long, source_id int, obs_date date, n_bytes long"
    for k, rows in enumerate(([(1, 0, DAY, 5), (2, 0, DAY, 6), (3, 1, DAY, 7)], [(2, 0, DAY, 60), (4, 0, DAY, 8)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        jobs.upsert_batches(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()
    assert sorted((r["file_id"], r["n_bytes"]) for r in got) == [(1, 5), (2, 60), (3, 7), (4, 8)]


def test_updates_of_a_stream_end_at_the_last(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(k % 2, 10 * k)], "k int, v int").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("k int, v int").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").groupBy("k").agg(F.sum("v").alias("v"))
    got = jobs.run_available(stream, "updates", "update", f"{tmp_path}/checkpoint", ("k",)).collect()
    assert sorted(map(tuple, got)) == [(0, 20), (1, 10)]


def test_geometry_falls_back_to_the_centroid(spark):
    rows = [("POLYGON((1 2, 3 2, 3 -4.5, 1 2))", "POINT(9 9)"), ("None", "POINT(-7.25 8)"), ("", None), (None, "none"), ("MULTILINESTRING((0 1, 2 3),(4 5, 6 1e1))", "")]
    got = b.bounding_boxes(spark.createDataFrame(rows, "footprint string, centroid string")).collect()
    assert [tuple(r)[2:] for r in got] == [(1.0, 3.0, -4.5, 2.0), (-7.25, -7.25, 8.0, 8.0), (None,) * 4, (None,) * 4, (0.0, 6.0, 1.0, 10.0)]


def test_mask_of_a_triangle(spark):
    """Against a test of every cell's centre."""
    xy = [(-10.0, -10.0), (10.3, -9.0), (0.4, 12.2)]
    edges = spark.createDataFrame([(*xy[k], *xy[(k + 1) % 3]) for k in range(3)], "x1 double, y1 double, x2 double, y2 double")
    grid = spark.range(1440 * 720).select(F.floor(F.col("id") / 1440).cast("int").alias("row"), (F.col("id") % 1440).cast("int").alias("col"))
    got = b.mask_from_edges(edges, grid).where("is_land").select("row", "col").collect()
    lon, lat = np.meshgrid(-180 + (np.arange(1440) + 0.5) * 0.25, -90 + (np.arange(720) + 0.5) * 0.25)
    inside = np.zeros(lon.shape, bool)
    for (x1, y1), (x2, y2) in zip(xy, xy[1:] + xy[:1]):
        inside ^= ((y1 > lat) != (y2 > lat)) & (lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1))
    assert {(r["row"], r["col"]) for r in got} == set(zip(*map(np.ndarray.tolist, np.nonzero(inside))))


def test_upsert_and_tile_overwrite(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1)], "v int, source string, day int")
    new = spark.createDataFrame([(9, "a", 1)], "v int, source string, day int")
    assert sorted(r["v"] for r in c.upsert(old, new, ["source", "day"]).collect()) == [2, 3, 9]
    for part in (old, new):
        tables.write_tiles(part, str(tmp_path / "t"), ("source", "day"))
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [2, 3, 9]


def test_transect_falls_back_to_a_band(spark):
    rows = [("p", i, j, float(j)) for i in (4, 5) for j in range(6) if i == 5 or j < 2]
    got = m.transect(spark.createDataFrame(rows, "product string, i int, j int, val double"), 4, 1).collect()
    assert {r["j"]: r["value"] for r in got} == {j: float(j) for j in range(6)}


@pytest.mark.parametrize("mode", ["append", "complete"])
def test_streaming_results_are_files(spark, tmp_path, mode):
    for k, n in enumerate((3, 0)):
        spark.range(n).write.parquet(f"{tmp_path}/in{k}")
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in{k}")
        frame = stream if mode == "append" else stream.groupBy("id").count()
        got = jobs.run_available(frame, f"files_{mode}_{k}", mode, f"{tmp_path}/checkpoint{k}")
        assert sorted(r["id"] for r in got.collect()) == list(range(n)) and got.schema.names == frame.schema.names
        assert got.inputFiles() and not spark.catalog.tableExists(f"files_{mode}_{k}")


def test_nested_catalogue_is_in_bounded_pieces(spark):
    tiles = spark.range(10_000).select(F.col("id").alias("file_id"), F.lit(DAY).alias("obs_date"), F.lit(0).alias("region_id"), F.lit(3).alias("source_id"), F.lit(5).cast("long").alias("n_bytes"))
    nested = catalog_plans._nested(tiles)
    assert nested.count() == 3 and nested.agg(F.max(F.size(F.split("json", "filename")))).first()[0] <= 4097
    assert c.catalogue_rows(nested).select("filename").distinct().count() == 9000

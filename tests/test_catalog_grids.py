"""Upserts by aliases, grids of regions, references of tracks, first rows of a key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pelagic.functions import geo
from pelagic.operators import catalog as c
from pelagic.operators import spectra as sp
from pelagic.operators import statistics as st

DAY = dt.date(2024, 1, 1)


def test_aliases_of_processed_sources_are_replaced(spark):
    schema = "file_id long, source string, obs_date date"
    old = spark.createDataFrame([(1, "smos_asc", DAY), (2, "smos_desc", DAY), (3, "argo", DAY), (4, "smos_asc", DAY + dt.timedelta(1)), (5, None, DAY), (6, "l4", DAY)], schema)
    new = spark.createDataFrame([(10, "smos_asc", DAY)], schema)
    got = c.upsert_processed(old, new, ["smos", "argo"], {"smos": ["smos_asc", "smos_desc"]}, spark.createDataFrame([(DAY,), (DAY,)], "obs_date date"))
    assert sorted(r["file_id"] for r in got.collect()) == [4, 5, 6, 10] and got.columns == old.columns


def test_the_first_row_of_a_key(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, None, "c"), (2, 7, None), (None, 1, "x"), (None, 0, "y")]
    got = c.first_per_key(spark.createDataFrame(rows, "k int, o int, v string"), ["k"], ["o", F.col("v")])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, None, "c"), (2, 7, None), (None, 0, "y")], key=str)  # nulls come first, as in a window


def test_every_point_has_a_cell_of_a_whole_grid(spark):
    regions = spark.createDataFrame([(r, (r % 4) * 90 - 180.0, (r % 4) * 90 - 90.0, (r // 4) * 90 - 90.0, (r // 4) * 90.0) for r in range(8)], "region_id int, r_lon_min double, r_lon_max double, r_lat_min double, r_lat_max double")
    points = spark.range(4000).select(((F.col("id") * 7919) % 3600 / 10 - 180).alias("lon"), ((F.col("id") * 104729) % 1800 / 10 - 90).alias("lat"))
    whole, centres = (geo.grid_specs(regions, 700.0, mode) for mode in ("whole", "centres"))
    assert geo.on_regional_grid(points, whole).count() == 4000 >= geo.on_regional_grid(points, centres).count()
    at = geo.on_regional_grid(points, whole).agg(F.min("gi"), F.min("gj")).first()
    assert tuple(at) == (0, 0)
    with pytest.raises(ValueError, match="mode"):
        geo.grid_specs(regions, 700.0, "other")


def test_a_track_uses_its_first_variable_and_has_one_vote(spark):
    rows = [(DAY, 1, 0.5, 0.5, 4.0, 9.0, None), (DAY, 1, 0.6, 0.6, 6.0, 9.0, None), (DAY, 1, 0.7, 0.7, None, 9.0, None), (DAY, 2, 0.5, 0.5, float("nan"), 1.0, 8.0), (DAY, 3, 0.5, 0.5, None, None, 3.0), (DAY, 4, 0.5, 0.5, None, None, None)]
    raw = spark.createDataFrame(rows, "obs_date date, track_id int, lon double, lat double, sla_filtered double, sla double, ssha double")
    got = st.pre_encoding_reference(raw, step=1.0).first()
    assert got["val"] == (5.0 + 1.0 + 3.0) / 3 and got["n_tracks"] == 3 and got["variable"] == "sla_filtered"


def test_spectra_along_tracks_by_region_and_method(spark):
    points = [(k, r, r, DAY, 0.2 * r, -20.0 + 0.25 * k, float(k % 7)) for r in (0, 1) for k in range(80)]
    obs = spark.createDataFrame(points, "obs_id long, track_id int, region_id int, obs_date date, lon double, lat double, val double").withColumn("obs_id", F.col("obs_id") + 1000 * F.col("region_id"))
    grid = spark.range(21 * 41).select(F.lit(DAY).alias("obs_date"), (F.col("id") % 21).cast("int").alias("i"), F.floor(F.col("id") / 21).cast("int").alias("j"), F.sin("id").alias("val"))
    found = {m: sp.track_spectra(obs, grid, -10.0, -20.0, 1.0, (21, 41), m, min_points=16, bins=20).collect() for m in ("right", "bilinear")}
    for rows in found.values():
        assert {(r["region_id"], r["product"]) for r in rows} == {(0, "track"), (0, "grid"), (1, "track"), (1, "grid")}
    power = {m: sum(r["psd"] for r in rows if r["product"] == "grid") for m, rows in found.items()}
    assert power["bilinear"] < power["right"]  # interpolation smooths
    with pytest.raises(ValueError, match="method"):
        sp.track_spectra(obs, grid, -10.0, -20.0, 1.0, (21, 41), "nearest")

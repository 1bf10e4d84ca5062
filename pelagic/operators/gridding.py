"""Gridding of points and swaths, tracks per cell, and what depends on them."""

from __future__ import annotations

import warnings
from math import cos, radians, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE_LAT, KM_PER_DEGREE_LON, BBox, bin_left, clean, region_id


def with_cells(points: DataFrame, step: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds region_id, i (longitude) and j (latitude) of the half-open cell of `step` degrees; outside points are dropped."""
    d = points.withColumns({
        "region_id": region_id(F.col(lon), F.col(lat)),
        "i": F.floor((F.col(lon) + 180) / step).cast("int"), "j": F.floor((F.col(lat) + 90) / step).cast("int"),
    })
    return d.where(F.col("region_id").isNotNull())


def bin_points(points: DataFrame, step: float, value: str = "val", method: str = "mean", min_samples: int = 1, keys: tuple[str, ...] = ("obs_date",)) -> DataFrame:
    """Mean, median, first or last track per cell (`nearest` is the mean), with the count; NULL below min_samples."""
    d = with_cells(points.withColumn(value, clean(F.col(value))).where(F.col(value).isNotNull()), step)
    rank = F.struct("track_id", "obs_id") if method in ("first", "last") else None
    how = {
        "mean": lambda: F.avg(value), "nearest": lambda: F.avg(value), "median": lambda: F.median(value),
        "first": lambda: F.min_by(value, rank), "last": lambda: F.max_by(value, rank),
    }[method]()
    out = d.groupBy(*keys, "region_id", "i", "j").agg(how.alias("value"), F.count(value).alias("n_obs"))
    return out.withColumn("value", F.when(F.col("n_obs") >= min_samples, F.col("value")))


def grid_each_track(points: DataFrame, step: float, native_km: float, lat_range: tuple[float, float] = (-90.0, 90.0), value: str = "val", track: str = "track_id") -> DataFrame:
    """Mean and count per cell of every track by itself; warns where the grid is coarser than 1.5 times the native resolution."""
    middle = radians(sum(lat_range) / 2)
    km = sqrt(step * KM_PER_DEGREE_LON * cos(middle) * step * KM_PER_DEGREE_LON)
    if km > 1.5 * native_km:
        warnings.warn(f"cells of {km:.1f} km are coarser than the native resolution of {native_km} km", stacklevel=2)
    return bin_points(points, step, value, keys=("obs_date", track))


def grid_altimetry(points: DataFrame, step: float, filtered: str = "sla_filtered", raw: str = "sla", track: str = "track_id", platform: str = "platform") -> DataFrame:
    """Daily tracks of sea level on a grid: the filtered value where there is one, else the raw; with the cell's platforms, sorted."""
    d = points.withColumn("val", F.coalesce(clean(F.col(filtered)), clean(F.col(raw)))).where(F.col("val").isNotNull())
    grid = grid_daily_tracks(d, step, "val", track)
    names = with_cells(d, step).groupBy("obs_date", "region_id", "i", "j").agg(F.array_join(F.array_sort(F.collect_set(platform)), ", ").alias("platforms"))
    return grid.join(names, ["obs_date", "region_id", "i", "j"])


def track_index(points: DataFrame, track: str = "track_id", value: str = "val") -> DataFrame:
    """Numbers the tracks that contribute a value on a date, in order of their name, from 0."""
    contributing = points.where(F.col(value).isNotNull()).select("obs_date", track).distinct()
    return contributing.withColumn("track_idx", F.row_number().over(Window.partitionBy("obs_date").orderBy(track)) - 1)


def grid_daily_tracks(points: DataFrame, step: float, value: str = "val", track: str = "track_id") -> DataFrame:
    """One pass for mean, count, first contributing track and overlap flag per day and cell."""
    used = points.withColumn(value, clean(F.col(value))).where(F.col(value).isNotNull()).join(track_index(points, track, value), ["obs_date", track])
    return with_cells(used, step).groupBy("obs_date", "region_id", "i", "j").agg(
        F.avg(value).alias("value"), F.count(value).alias("n_obs"), F.min("track_idx").cast("int").alias("primary_track"), (F.min(track) != F.max(track)).alias("is_overlap")
    )


def track_times(points: DataFrame, track: str = "track_id", time: str = "obs_time") -> DataFrame:
    """Mean (rounded down), first and last time of a track and day, in microseconds; the mean is exact, over offsets from the day's start."""
    micros, day = F.unix_micros(F.col(time).cast("timestamp")), F.unix_micros(F.col("obs_date").cast("timestamp"))
    d = points.where(F.col(time).isNotNull()).groupBy("obs_date", track).agg(F.sum(micros - day).alias("total"), F.count(F.lit(1)).alias("n"), F.min(micros).alias("time_min"), F.max(micros).alias("time_max"))
    mean = F.expr("unix_micros(CAST(obs_date AS timestamp)) + (total - pmod(total, n)) div n")
    return d.select("obs_date", track, mean.alias("time_mean"), "time_min", "time_max")


def cells_owned(grid: DataFrame, tracks: DataFrame) -> DataFrame:
    """Cells of which a track is the first contributor; tracks without any have 0."""
    owned = grid.groupBy("obs_date", F.col("primary_track").alias("track_idx")).agg(F.count(F.lit(1)).alias("n_cells"))
    return tracks.join(owned, ["obs_date", "track_idx"], "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0).cast("long")))


def mask_tracks(grid: DataFrame, exclude: list[int], preserve_overlap: bool = False) -> DataFrame:
    """NULLs the cells owned by excluded tracks; cells seen by several tracks may stay."""
    gone = F.col("primary_track").isin(exclude)
    return grid.withColumn("value", F.when(gone & ~F.col("is_overlap") if preserve_overlap else gone, None).otherwise(F.col("value")))


def keep_platforms(grid: DataFrame, tracks: DataFrame, platforms: list[str]) -> DataFrame:
    """NULLs the cells whose owner's platform is not kept."""
    named = grid.join(tracks.select("obs_date", F.col("track_idx").alias("primary_track"), "platform"), ["obs_date", "primary_track"], "left")
    return named.withColumn("value", F.when(F.col("platform").isin(platforms), F.col("value")))


def split_tracks(tracks: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A seeded share of the tracks is for validation: max(1, floor(n * fraction)), none where fraction is 0."""
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col("track_id")))
    n = F.count(F.lit(1)).over(Window.partitionBy("obs_date"))
    rank = F.row_number().over(Window.partitionBy("obs_date").orderBy(order, "track_id"))
    wanted = F.greatest(F.lit(1), F.floor(n * fraction)) if fraction > 0 else F.lit(0)
    return tracks.withColumn("is_validation", rank <= wanted)


def merge_to_grid(cells: DataFrame, box: BBox, step: float, keys: tuple[str, ...], value: str = "val") -> DataFrame:
    """Mean of all values that fall on a target cell of a box (floor, what reaches over the edge is clipped)."""
    n_i, n_j = round((box.lon_max - box.lon_min) / step), round((box.lat_max - box.lat_min) / step)
    d = cells.withColumns({"ti": bin_left(F.col("lon"), box.lon_min, step, n_i), "tj": bin_left(F.col("lat"), box.lat_min, step, n_j)})
    return d.groupBy(*keys, "ti", "tj").agg(F.avg(value).alias("value"), F.count(value).alias("n"))


def temporal_aggregate(cells: DataFrame, how: str, keys: tuple[str, ...], value: str = "val", date: str = "obs_date") -> DataFrame:
    """first, last, mean or stack (dates and values in order) over time."""
    d = cells.where(F.col(value).isNotNull())
    column = {
        "first": lambda: F.min_by(value, date), "last": lambda: F.max_by(value, date), "mean": lambda: F.avg(value),
        "stack": lambda: F.transform(F.sort_array(F.collect_list(F.struct(date, value))), lambda x: x[value]),
    }[how]()
    return d.groupBy(*keys).agg(column.alias("value"))


def daily_mean_complete(hourly: DataFrame, hours: int, keys: tuple[str, ...] = ("i", "j"), value: str = "val", also: tuple[str, ...] = (), done: DataFrame | None = None) -> DataFrame:
    """Daily means of the days on which at least `hours` different hours were seen, anywhere.

    also: further columns with means of their own (the components of a wind). done: dates that exist and are left out.
    """
    hour = F.hour("obs_time")
    hourly = hourly.join(done.select("obs_date").distinct(), "obs_date", "left_anti") if done is not None else hourly
    full = hourly.groupBy("obs_date").agg(F.count_distinct(hour).alias("n_hours")).where(F.col("n_hours") >= hours).select("obs_date")
    return hourly.join(full, "obs_date", "left_semi").groupBy("obs_date", *keys).agg(F.avg(value).alias("value"), *[F.avg(c).alias(c) for c in also], F.count(value).alias("n"))


def resolution(points: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Resolution of a grid from its coordinates, in degrees and kilometres; NULL with a single coordinate."""
    def step(axis: str) -> Column:
        n = F.count_distinct(axis)
        return F.when(n > 1, (F.max(axis) - F.min(axis)) / (n - 1))

    d = points.groupBy(*keys).agg(step("lon").alias("res_lon"), step("lat").alias("res_lat"), ((F.max("lat") + F.min("lat")) / 2).alias("mid"))
    return d.select(*keys, "res_lon", "res_lat", (F.col("res_lon") * KM_PER_DEGREE_LON * F.cos(F.radians("mid"))).alias("res_lon_km"), (F.col("res_lat") * KM_PER_DEGREE_LAT).alias("res_lat_km"))


def tile_extent(points: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Bounding box and time range of a tile."""
    return points.groupBy(*keys).agg(*[f(c).alias(f"{c}_{n}") for c in ("lon", "lat", "obs_time") for n, f in (("min", F.min), ("max", F.max))], F.count(F.lit(1)).alias("n"))

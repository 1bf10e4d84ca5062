"""Patches for model training: resize, smoothing, assembly and batches, as weighted joins and sums."""

from __future__ import annotations

from math import exp

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .boxes import boxes_points
from .catalog import files_of_queries
from .gridding import temporal_aggregate
from .scans import with_unit_offsets


def resize_axis(cells: DataFrame, axis: str, n_in: int, n_out: int, keys: tuple[str, ...], weighted: tuple[str, str] = ("wv", "w")) -> DataFrame:
    """One axis of a bilinear resize (corners not aligned): every source index feeds the targets that it reaches.

    Columns wv (weight times value) and w (weight of valid cells) are carried, so that two calls resize both axes.
    """
    taps: dict[int, list[tuple[int, float]]] = {}
    for target in range(n_out):
        src = max(0.0, (target + 0.5) * n_in / n_out - 0.5)
        low = min(int(src), n_in - 1)
        for at, weight in ((low, 1 - (src - low)), (min(low + 1, n_in - 1), src - low)):
            if weight > 0:
                taps.setdefault(at, []).append((target, weight))
    rows = [(at, target, float(weight)) for at, own in taps.items() for target, weight in own]
    table = cells.sparkSession.createDataFrame(rows, "__at int, __to int, __weight double")  # at most 2 * n_out rows
    wv, w = weighted
    hit = cells.join(F.broadcast(table), F.col(axis) == F.col("__at"))
    others = [c for c in cells.columns if c not in (axis, wv, w)]
    return hit.groupBy(*others, F.col("__to").alias(axis)).agg(F.sum(F.col(wv) * F.col("__weight")).alias(wv), F.sum(F.col(w) * F.col("__weight")).alias(w))


def resize(cells: DataFrame, n_in: tuple[int, int], n_out: tuple[int, int], keys: tuple[str, ...], value: str = "val") -> DataFrame:
    """Patches (keys, i, j, value) to another size; gaps don't count, and a target with next to no weight is NULL."""
    d = cells.where(F.col(value).isNotNull()).select(*keys, "i", "j", F.col(value).cast("double").alias("wv"), F.lit(1.0).alias("w"))
    d = resize_axis(resize_axis(d, "i", n_in[0], n_out[0], keys), "j", n_in[1], n_out[1], keys)
    return d.select(*keys, "i", "j", F.when(F.col("w") > 0.01, F.col("wv") / F.greatest(F.col("w"), F.lit(1e-8))).alias("value"))


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    reach = int(truncate * sigma + 0.5)
    raw = {k: exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)}
    total = sum(raw.values())
    return [(k, v / total) for k, v in raw.items()]


def smooth(cells: DataFrame, sigma: float, n_i: int, n_j: int, keys: tuple[str, ...], value: str = "val") -> DataFrame:
    """Gaussian smoothing that skips gaps, one axis after the other; what has under a hundredth of the weight is NULL."""
    d = cells.where(F.col(value).isNotNull()).select(*keys, "i", "j", F.col(value).alias("wv"), F.lit(1.0).alias("w"))
    if sigma >= 1e-3:
        taps = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in gaussian_weights(sigma)])
        for axis, n in (("i", n_i), ("j", n_j)):
            spread = d.withColumn("t", F.explode(taps)).withColumn(axis, F.col(axis) + F.col("t.k")).where(F.col(axis).between(0, n - 1))
            d = spread.groupBy(*keys, "i", "j").agg(F.sum(F.col("wv") * F.col("t.v")).alias("wv"), F.sum(F.col("w") * F.col("t.v")).alias("w"))
    return d.select(*keys, "i", "j", F.when(F.col("w") >= 0.01, F.col("wv") / F.col("w")).alias("value"))


def smoothed_tracks(cells: DataFrame, sigma: float, n_i: int, n_j: int, keys: tuple[str, ...], track: str = "track_id", value: str = "val") -> DataFrame:
    """Each track smoothed by itself, then the plain mean of the tracks."""
    own = smooth(cells, sigma, n_i, n_j, (*keys, track), value)
    return own.where("value IS NOT NULL").groupBy(*keys, "i", "j").agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n_tracks"))


def coordinates(low: Column, high: Column, n: int) -> Column:
    """n evenly spaced coordinates from low to high."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: low + k * (high - low) / F.lit(max(1, n - 1)))


def assemble(boxes: DataFrame, variables: DataFrame, cells: DataFrame, size: int, fill: float = 0.0) -> DataFrame:
    """A row per box and variable: a patch of size x size values (row by row, gaps filled), its coordinates and files.

    cells: (query_id, variable, i, j, value, n: files) on the target grid of the box. Pairs without data are kept, present = false.
    """
    own = cells.groupBy("query_id", "variable").agg(F.map_from_entries(F.collect_list(F.struct((F.col("j") * size + F.col("i")).alias("at"), F.col("value")))).alias("m"), F.max("n").alias("n_files"))
    wanted = boxes.select("query_id", "lon_min", "lon_max", "lat_min", "lat_max", "date_start", "date_end").withColumn("variable", F.explode(variables_array(variables)))
    d = wanted.join(own, ["query_id", "variable"], "left")
    data = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(fill)).cast("float"))
    return d.select(
        "query_id", "variable", F.col("m").isNotNull().alias("present"), F.coalesce("n_files", F.lit(0)).alias("n_files"), F.lit(size).alias("h"), F.lit(size).alias("w"), data.alias("data"),
        coordinates(F.col("lon_min"), F.col("lon_max"), size).alias("lons"), coordinates(F.col("lat_min"), F.col("lat_max"), size).alias("lats"),
        F.array("lon_min", "lon_max", "lat_min", "lat_max").alias("bbox"), F.array("date_start", "date_end").alias("times"),
    )


def stepped_coordinates(low: Column, high: Column, step: float) -> Column:
    """Coordinates from low, a step apart, below high plus half a step."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((high - low + step / 2) / step - 1e-9).cast("int") - 1)), lambda k: low + k * step)


def sample_cells(boxes: DataFrame, cells: DataFrame, tiles: DataFrame, sources: DataFrame, regions: DataFrame, offsets: dict[str, float], native: int, size: int) -> DataFrame:
    """(query_id, variable, i, j, value, n): the patches of all queries, from tiles to the target grid, in one plan.

    Tiles of a query's dates, regions and sources (with how many there are), their cells in the box, units, a mean over
    tiles and dates on native x native cells of the box, and a resize to size x size. cells: (source_id, variable,
    obs_date, lon, lat, val); tiles: (file_id, source_id, obs_date, region_id).
    """
    files = files_of_queries(boxes, tiles, sources, regions)
    inside = boxes_points(boxes, with_unit_offsets(cells, offsets).where(F.col("val").isNotNull()))
    at = {c: F.least(F.lit(native - 1), F.floor((F.col(axis) - F.col(f"{axis}_min")) / ((F.col(f"{axis}_max") - F.col(f"{axis}_min")) / native))).cast("int") for c, axis in (("i", "lon"), ("j", "lat"))}
    sums = inside.withColumns(at).groupBy("query_id", "source_id", "variable", "i", "j").agg(F.sum("val").alias("sum"), F.count("val").alias("k"))  # no pair of box and cell moves
    merged = sums.join(files, ["query_id", "source_id"]).groupBy("query_id", "variable", "n", "i", "j").agg((F.sum("sum") / F.sum("k")).alias("val"))
    return resize(merged, (native, native), (size, size), ("query_id", "variable", "n"))


def variables_array(variables: DataFrame) -> Column:
    """The names of a small dimension as a literal array."""
    return F.array(*[F.lit(r[0]) for r in variables.select("variable").distinct().orderBy("variable").collect()])


def numbered(frame: DataFrame, id_: str, checkpoint) -> DataFrame:
    """(id, number): distinct ids with their place in order, from 0. Ranges number their own rows; their sizes are summed apart."""
    ids = checkpoint(frame.select(id_).distinct().repartitionByRange(id_).withColumn("__range", F.spark_partition_id()))
    sizes = ids.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))  # a row per range
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("__range")) - F.col("n")).drop("n")
    return ids.join(F.broadcast(before), "__range").select(id_, (F.col("before") + F.row_number().over(Window.partitionBy("__range").orderBy(id_)) - 1).alias("number"))


def _numbered_samples(samples: DataFrame, checkpoint) -> DataFrame:
    return samples if "number" in samples.columns else samples.join(numbered(samples, "query_id", checkpoint), "query_id")


def collate(samples: DataFrame, batch: int, checkpoint) -> DataFrame:
    """Batches of so many consecutive queries: all samples of a variable padded with zeros to the largest, absent ones marked.

    With the coordinates of a batch's first sample, and all boxes and dates. Samples with a column `number` (of `numbered`) are not numbered again.
    """
    d = _numbered_samples(samples, checkpoint).withColumn("batch", F.floor(F.col("number") / batch).cast("long"))
    top = d.groupBy("batch", "variable").agg(F.max("h").alias("top_h"), F.max("w").alias("top_w"))

    def padded(h: Column, w: Column, data: Column) -> Column:
        rows = F.transform(F.sequence(F.lit(0), F.col("top_h") - 1), lambda y: F.when(y < h, F.concat(F.slice(data, y * w + 1, w), F.array_repeat(F.lit(0.0).cast("float"), F.col("top_w") - w))).otherwise(F.array_repeat(F.lit(0.0).cast("float"), F.col("top_w"))))
        return F.flatten(rows)

    one = d.join(top, ["batch", "variable"]).select("batch", "variable", "top_h", "top_w", F.struct("query_id", "present", padded(F.col("h"), F.col("w"), F.col("data")).alias("data"), *[c for c in ("lons", "lats", "bbox", "times") if c in samples.columns]).alias("s"))
    out = one.groupBy("batch", "variable", "top_h", "top_w").agg(F.sort_array(F.collect_list("s")).alias("s"))
    more = [F.col("s")[0][c].alias(c) for c in ("lons", "lats") if c in samples.columns] + [F.col(f"s.{c}").alias(n) for c, n in (("bbox", "bboxes"), ("times", "time_ranges")) if c in samples.columns]
    return out.select("batch", "variable", "top_h", "top_w", F.col("s.query_id").alias("query_ids"), F.col("s.present").alias("present"), F.col("s.data").alias("data"), *more)


def resize_reference(patch: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The same resize of one patch in numpy, for small jobs and for tests."""
    def matrix(n_in: int, n_out: int) -> np.ndarray:
        m = np.zeros((n_out, n_in))
        for t in range(n_out):
            src = max(0.0, (t + 0.5) * n_in / n_out - 0.5)
            low = min(int(src), n_in - 1)
            m[t, low] += 1 - (src - low)
            m[t, min(low + 1, n_in - 1)] += src - low
        return m

    a, b = matrix(patch.shape[0], shape[0]), matrix(patch.shape[1], shape[1])
    ok = np.isfinite(patch)
    w = a @ ok @ b.T
    return np.where(w > 0.01, a @ np.where(ok, patch, 0) @ b.T / np.maximum(w, 1e-8), np.nan)


def axis_taps(at: Column, n_in: Column, n_out: Column) -> Column:
    """The targets that source index `at` feeds in a bilinear resize (corners not aligned), as (to, weight). Sizes may differ by row."""
    low = F.when(at == 0, F.lit(0)).otherwise(F.greatest(F.lit(0), F.ceil((at - 0.5) * n_out / n_in - 0.5)))
    high = F.when(at == n_in - 1, n_out - 1).otherwise(F.least(n_out - 1, F.floor((at + 1.5) * n_out / n_in - 0.5)))
    source = lambda t: F.least(n_in - 1.0, F.greatest(F.lit(0.0), (t + 0.5) * n_in / n_out - 0.5))
    near = F.when(low <= high, F.transform(F.sequence(low.cast("int"), high.cast("int")), lambda t: F.struct(t.alias("to"), (1 - F.abs(source(t) - at)).alias("weight"))))
    return F.filter(near, lambda x: x["weight"] > 0)


def resize_each(cells: DataFrame, keys: tuple[str, ...], value: str = "val") -> DataFrame:
    """Patches (keys, n_i, n_j: native size, h, w: wanted size, i, j, value), each from its own size to its own, in one shuffle.

    Gaps don't count; a target with next to no weight is NULL. Columns h and w stay.
    """
    d = cells.where(F.col(value).isNotNull()).withColumn("__i", F.explode(axis_taps(F.col("i"), F.col("n_i"), F.col("w")))).withColumn("__j", F.explode(axis_taps(F.col("j"), F.col("n_j"), F.col("h"))))
    weight = F.col("__i.weight") * F.col("__j.weight")
    d = d.groupBy(*keys, "h", "w", F.col("__i.to").alias("i"), F.col("__j.to").alias("j")).agg(F.sum(weight * F.col(value)).alias("wv"), F.sum(weight).alias("sum"))
    return d.select(*keys, "h", "w", "i", "j", F.when(F.col("sum") > 0.01, F.col("wv") / F.greatest(F.col("sum"), F.lit(1e-8))).alias("value"))


def sample_patches(
    boxes: DataFrame, cells: DataFrame, tiles: DataFrame, sources: DataFrame, regions: DataFrame, offsets: dict[str, float], temporal: str = "first", target_resolution: float | None = None
) -> DataFrame:
    """(query_id, variable, n_files, n_t, h, w, t, i, j, value): patches of all queries, each of its own size.

    sources: (source_id, resolution: degrees, h, w: the wanted size of a patch, or NULL for what the resolution gives). A
    day's tiles are averaged on the box's grid of the target resolution, or else of the source's own; the days are then
    put together as `temporal` says: the first or last value of a cell, the mean, or a stack (t: the place of the day
    among those with data, n_t of them). Last comes the resize.
    """
    step = F.lit(target_resolution) if target_resolution else F.col("resolution")
    files = files_of_queries(boxes, tiles, sources, regions, "n_files")
    inside = boxes_points(boxes, with_unit_offsets(cells, offsets).where(F.col("val").isNotNull())).join(F.broadcast(sources), "source_id")  # a row per source: their few keys must not deal out the pairs
    size = {n: F.greatest(F.lit(1), F.round((F.col(f"{axis}_max") - F.col(f"{axis}_min")) / step).cast("int")) for n, axis in (("n_i", "lon"), ("n_j", "lat"))}
    inside = inside.withColumns(size)
    at = {c: F.least(F.col(n) - 1, F.floor((F.col(axis) - F.col(f"{axis}_min")) / (F.col(f"{axis}_max") - F.col(f"{axis}_min")) * F.col(n))).cast("int") for c, n, axis in (("i", "n_i", "lon"), ("j", "n_j", "lat"))}
    patch = ("query_id", "source_id", "variable", "n_i", "n_j", "h", "w")
    inside = inside.withColumns(at | {"h": F.coalesce("h", "n_j"), "w": F.coalesce("w", "n_i")})
    daily = inside.groupBy(*patch, "i", "j", "obs_date").agg(F.avg("val").alias("val"))
    if temporal == "stack":
        days = daily.groupBy("query_id", "variable").agg(F.sort_array(F.collect_set("obs_date")).alias("days"))  # those of a query's window
        stacked = daily.join(days, ["query_id", "variable"]).withColumns({"t": F.array_position("days", F.col("obs_date")).cast("int") - 1, "n_t": F.size("days")})
        merged = stacked.select(*patch, "n_t", "t", "i", "j", "val")
    else:
        merged = temporal_aggregate(daily, temporal, (*patch, "i", "j")).withColumnRenamed("value", "val").withColumns({"n_t": F.lit(1), "t": F.lit(0)})
    out = resize_each(merged, ("query_id", "source_id", "variable", "n_t", "t"))
    return out.join(files, ["query_id", "source_id"]).select("query_id", "variable", "n_files", "n_t", "h", "w", "t", "i", "j", "value")


def assemble_patches(boxes: DataFrame, variables: DataFrame, patches: DataFrame, size: tuple[int, int], fill: float = 0.0) -> DataFrame:
    """A row per box and variable: n_t x h x w values (time by time, row by row, gaps filled), coordinates, files.

    Pairs without data are kept with present = false, no data, and coordinates of the default size (h, w).
    """
    place = (F.col("t") * F.col("h") + F.col("j")) * F.col("w") + F.col("i")
    own = patches.groupBy("query_id", "variable", "n_files", "n_t", "h", "w").agg(F.map_from_entries(F.collect_list(F.struct(place.alias("at"), "value"))).alias("m"))
    wanted = boxes.select("query_id", "lon_min", "lon_max", "lat_min", "lat_max", "date_start", "date_end").withColumn("variable", F.explode(variables_array(variables)))
    d = wanted.join(own, ["query_id", "variable"], "left")
    data = F.transform(F.sequence(F.lit(0), F.col("n_t") * F.col("h") * F.col("w") - 1), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(fill)).cast("float"))

    def spaced(axis: str, n: Column) -> Column:
        low, high = F.col(f"{axis}_min"), F.col(f"{axis}_max")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: low + k * (high - low) / F.greatest(F.lit(1), n - 1))

    h, w = F.coalesce("h", F.lit(size[0])), F.coalesce("w", F.lit(size[1]))
    return d.select(
        "query_id", "variable", F.col("m").isNotNull().alias("present"), F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("n_t", F.lit(0)).alias("n_t"), F.coalesce("h", F.lit(0)).alias("h"), F.coalesce("w", F.lit(0)).alias("w"),
        F.when(F.col("m").isNotNull(), data).otherwise(F.array().cast("array<float>")).alias("data"), spaced("lon", w).alias("lons"), spaced("lat", h).alias("lats"),
        F.array("lon_min", "lon_max", "lat_min", "lat_max").alias("bbox"), F.array("date_start", "date_end").alias("times"),
    )


def collate_patches(samples: DataFrame, batch: int, checkpoint) -> DataFrame:
    """Batches of so many consecutive queries: what is present of a variable, padded with zeros to the largest times, rows and columns.

    A query without the variable is left out of its data; a batch's boxes and dates are those of all its queries, its
    coordinates those of its first present sample (of the first one, if none is). A column `number` counts as in collate.
    """
    d = _numbered_samples(samples, checkpoint).withColumn("batch", F.floor(F.col("number") / batch).cast("long"))
    top = d.groupBy("batch", "variable").agg(*[F.max(c).alias(f"top_{c[-1]}") for c in ("n_t", "h", "w")])

    def padded(n_t: Column, h: Column, w: Column, data: Column) -> Column:
        zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)
        line = lambda t, y: F.when((t < n_t) & (y < h), F.concat(F.slice(data, (t * h + y) * w + 1, w), zeros(F.col("top_w") - w))).otherwise(zeros(F.col("top_w")))
        lines = F.transform(F.sequence(F.lit(0), F.col("top_t") * F.col("top_h") - 1), lambda k: line(F.floor(k / F.col("top_h")).cast("int"), (k % F.col("top_h")).cast("int")))
        return F.flatten(lines)

    keys = ["batch", "variable", "top_t", "top_h", "top_w"]
    data = F.when(F.col("present"), padded(F.col("n_t"), F.col("h"), F.col("w"), F.col("data")))
    one = d.join(top, ["batch", "variable"]).select(*keys, F.struct("query_id", "present", data.alias("data"), "lons", "lats", "bbox", "times").alias("s"))
    out = one.groupBy(*keys).agg(F.sort_array(F.collect_list("s")).alias("s"))
    there = F.filter("s", lambda x: x["present"])
    first = F.coalesce(F.get(there, F.lit(0)), F.get(F.col("s"), F.lit(0)))
    return out.select(
        *keys, F.transform(there, lambda x: x["query_id"]).alias("query_ids"), F.transform(there, lambda x: x["data"]).alias("data"), first["lons"].alias("lons"), first["lats"].alias("lats"),
        F.col("s.bbox").alias("bboxes"), F.col("s.times").alias("time_ranges"),
    )

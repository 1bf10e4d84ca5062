"""Along-track distances, segments, ordering and gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_km


def with_steps(points: DataFrame, keys: tuple[str, ...] = ("track_id", "obs_date"), order: tuple[str, ...] = ("lat", "obs_id")) -> DataFrame:
    """Step to the previous point of a track and day, and the distance along it, in km."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = F.coalesce(haversine_km(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat")), F.lit(0.0))
    return points.withColumn("step_km", step).withColumn("along_km", F.sum("step_km").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def with_segments(steps: DataFrame, keys: tuple[str, ...] = ("track_id", "obs_date"), order: tuple[str, ...] = ("lat", "obs_id"), times: float = 3.0) -> DataFrame:
    """A new segment begins where a step is longer than so many times the median of the positive ones."""
    median = steps.where("step_km > 0").groupBy(*keys).agg(F.median("step_km").alias("median_km"))
    d = steps.join(median, list(keys), "left")
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("segment", F.sum(F.when(F.col("step_km") > times * F.col("median_km"), 1).otherwise(0)).over(w))


def qualified_segments(segments: DataFrame, min_km: float = 300.0, min_points: int = 50, min_valid: float = 0.9, keys: tuple[str, ...] = ("track_id", "obs_date"), value: str = "val") -> DataFrame:
    """Segments long, dense and complete enough for a spectrum."""
    d = segments.groupBy(*keys, "segment").agg((F.max("along_km") - F.min("along_km")).alias("length_km"), F.count(F.lit(1)).alias("n"), (F.count(value) / F.count(F.lit(1))).alias("valid"))
    return d.where((F.col("length_km") >= min_km) & (F.col("n") >= min_points) & (F.col("valid") > min_valid))


def column_segments(cells: DataFrame, gap: int = 3, keys: tuple[str, ...] = ("product", "obs_date", "i")) -> DataFrame:
    """Segments of grid columns without track ids: a jump of the row index above gap begins a new one."""
    w = Window.partitionBy(*keys).orderBy("j")
    d = cells.withColumn("__new", F.when(F.col("j") - F.lag("j").over(w) > gap, 1).otherwise(0))
    return d.withColumn("segment", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def densest_band(cells: DataFrame, width: int, keys: tuple[str, ...] = ("product",), n_columns: int = 36) -> DataFrame:
    """The first window of columns with the most cells; columns without cells count, windows are whole."""
    count = cells.groupBy(*keys, "i").agg(F.count("val").alias("n"))
    spine = cells.select(*keys).distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_columns - 1))))
    w = Window.partitionBy(*keys).orderBy("i").rowsBetween(0, width - 1)
    d = spine.join(count, [*keys, "i"], "left").withColumn("total", F.sum(F.coalesce("n", F.lit(0))).over(w)).where(F.col("i") <= n_columns - width)
    return d.groupBy(*keys).agg(F.max_by("i", F.struct("total", -F.col("i"))).alias("first_i"), F.max("total").alias("total"))


def order_choice(points: DataFrame, nominal_km: float, keys: tuple[str, ...] = ("track_id", "obs_date")) -> DataFrame:
    """Order along lat or lon, whichever gives a median step nearer the nominal one (lat where alike)."""
    def median(first: str, second: str, name: str) -> DataFrame:
        d = with_steps(points, keys, (first, second, "obs_id")).where("step_km > 0")
        return d.groupBy(*keys).agg(F.median("step_km").alias(name))

    both = median("lat", "lon", "by_lat").join(median("lon", "lat", "by_lon"), list(keys))
    return both.withColumn("order_by", F.when(F.abs(F.col("by_lat") - nominal_km) <= F.abs(F.col("by_lon") - nominal_km), "lat").otherwise("lon"))


def every_nth(frame: DataFrame, n: int, order: tuple[str, ...], keys: tuple[str, ...], bucket: Column) -> DataFrame:
    """Every n-th row of a group in order, where it has more than 100 n rows; all rows otherwise.

    bucket: whole numbers that never fall in that order. A group is put in order bucket by bucket, and the rows of the
    buckets before are counted, so that no group has to be in one place.
    """
    d = frame.withColumn("__bucket", bucket)
    w = Window.partitionBy(*keys)
    counts = d.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__own"))
    counts = counts.withColumns({"__n": F.sum("__own").over(w), "__before": F.sum("__own").over(w.orderBy("__bucket")) - F.col("__own")}).drop("__own")
    rank = F.row_number().over(Window.partitionBy(*keys, "__bucket").orderBy(*order)) + F.col("__before")
    d = d.join(counts, [*keys, "__bucket"]).withColumn("__rank", rank)
    return d.where((F.col("__n") <= 100 * n) | ((F.col("__rank") - 1) % n == 0)).select(*frame.columns)


def fill_gaps(frame: DataFrame, keys: tuple[str, ...], at: str, value: str) -> DataFrame:
    """Linear interpolation between the nearest values on either side; constant beyond the ends.

    What follows is found by a running window in the other order: one that reaches ahead to the end costs the square of a group.
    """
    w, back = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc(at), F.desc(at)))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("at"), F.col(value).alias("v")))
    d = frame.withColumn("__a", F.last(known, True).over(w)).withColumn("__b", F.last(known, True).over(back))
    line = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * (F.col(at) - F.col("__a.at")) / (F.col("__b.at") - F.col("__a.at"))
    return d.withColumn("filled", F.when(F.col("__a").isNull(), F.col("__b.v")).when(F.col("__b").isNull() | (F.col("__b.at") == F.col("__a.at")), F.col("__a.v")).otherwise(line)).drop("__a", "__b")


def first_usable_date(segments: DataFrame, dates: DataFrame) -> DataFrame:
    """The first date with a qualified segment, or the first of all dates where there is none."""
    both = segments.agg(F.min("obs_date").alias("good")).crossJoin(dates.agg(F.min("obs_date").alias("first")))  # one row each
    return both.select(F.coalesce("good", "first").alias("obs_date"))

"""Matching of points and grids: nearest, bilinear, right neighbour, co-location. All are equi-joins on integer indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_match(points: DataFrame, grid: DataFrame, lon0: float, lat0: float, step: float, tolerance: float | None, keys: tuple[str, ...] = ("obs_date",)) -> DataFrame:
    """The grid value at the nearest node of each axis (node k at lon0 + k * step), NULL where it is farther than tolerance."""
    i, j = F.round((F.col("lon") - lon0) / step).cast("int"), F.round((F.col("lat") - lat0) / step).cast("int")
    d = points.withColumns({"i": i, "j": j})
    if tolerance is not None:
        far = F.greatest(F.abs(F.col("lon") - (lon0 + F.col("i") * step)), F.abs(F.col("lat") - (lat0 + F.col("j") * step)))
        d = d.where(far <= tolerance)
    return d.join(grid.select(*keys, "i", "j", F.col("val").alias("grid_val")), [*keys, "i", "j"], "left")


def nearest_on_axis(points: DataFrame, axis: DataFrame, column: str, tolerance: float, bucket: float) -> DataFrame:
    """Nearest coordinate of an irregular axis (idx, coord) by buckets as wide as the tolerance at least; ties go to the lower one."""
    here = axis.select("idx", "coord", F.floor(F.col("coord") / bucket).alias("bucket"))
    d = points.withColumn("bucket", F.explode(F.array(*[F.floor(F.col(column) / bucket) + k for k in (-1, 0, 1)])))
    d = d.join(here, "bucket").withColumn("far", F.abs(F.col(column) - F.col("coord"))).where(F.col("far") <= tolerance)
    return d.groupBy(*points.columns).agg(F.min_by("idx", F.struct("far", "coord")).alias("idx"))


def bilinear(points: DataFrame, grid: DataFrame, lon0: float, lat0: float, step: float, keys: tuple[str, ...] = ("obs_date",), id_: str = "obs_id", fill: float | None = None, n_i: int | None = None, n_j: int | None = None) -> DataFrame:
    """Grid values interpolated at points: four corners with weights, joined on indices and summed.

    NULL where a corner is missing, unless fill stands in for it; with n_i and n_j, points outside the grid are dropped.
    """
    x, y = (F.col("lon") - lon0) / step, (F.col("lat") - lat0) / step
    d = points.select(id_, *keys, x.alias("x"), y.alias("y"))
    if n_i is not None and n_j is not None:
        d = d.where(F.col("x").between(0, n_i - 1) & F.col("y").between(0, n_j - 1))
    fx, fy = F.col("x") - F.floor("x"), F.col("y") - F.floor("y")
    corners = F.array(*[
        F.struct((F.floor("x") + a).cast("int").alias("i"), (F.floor("y") + b).cast("int").alias("j"), ((fx if a else 1 - fx) * (fy if b else 1 - fy)).alias("w")) for a in (0, 1) for b in (0, 1)
    ])
    d = d.withColumn("c", F.explode(corners)).select(id_, *keys, "c.*").where("w > 0")
    hit = d.join(grid.select(*keys, "i", "j", "val"), [*keys, "i", "j"], "left")
    value = F.col("val") if fill is None else F.coalesce("val", F.lit(fill))
    whole = F.count(value) == F.count(F.lit(1))
    return hit.groupBy(id_, *keys).agg(F.when(whole, F.sum(F.col("w") * value)).alias("grid_val"))


def right_neighbour(points: DataFrame, grid: DataFrame, lon0: float, lat0: float, step: float, n_i: int, n_j: int, keys: tuple[str, ...] = ("obs_date",)) -> DataFrame:
    """The grid value at the first node not below a point on either axis, clipped to the axis."""
    def at(column: str, low: float, n: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.ceil((F.col(column) - low) / step))).cast("int")

    d = points.withColumns({"i": at("lon", lon0, n_i), "j": at("lat", lat0, n_j)})
    return d.join(grid.select(*keys, "i", "j", F.col("val").alias("grid_val")), [*keys, "i", "j"], "left")


def both_valid(obs: DataFrame, ref: DataFrame, keys: tuple[str, ...] = ("obs_date", "i", "j"), also: tuple[str, ...] = ()) -> DataFrame:
    """Observed and reference values of the same cell and day, both there, with further columns of the observations."""
    a = obs.where(F.col("value").isNotNull()).select(*also, *keys, F.col("value").alias("obs"))
    return a.join(ref.where(F.col("val").isNotNull()).select(*keys, F.col("val").alias("ref")), list(keys))


def co_located(fields: dict[str, DataFrame], keys: tuple[str, ...] = ("obs_date", "i", "j")) -> DataFrame:
    """Fields side by side on one grid; a day counts only if all are there."""
    names = list(fields)
    out = fields[names[0]].select(*keys, F.col("val").alias(names[0]))
    for n in names[1:]:
        out = out.join(fields[n].select(*keys, F.col("val").alias(n)), list(keys))
    return out


def surface_level(profiles: DataFrame, below: float = 5.0) -> DataFrame:
    """The shallowest level of each profile above a pressure; ties by level and keys."""
    d = profiles.where(F.col("pres") < below)
    order = F.struct("pres", "level", "l_partkey", "l_suppkey")
    return d.groupBy("profile_id").agg(*[F.min_by(c, order).alias(c) for c in ("lon", "lat", "obs_date", "pres", "temp", "psal")])


def anomalies(frame: DataFrame, value: str, keys: tuple[str, ...]) -> DataFrame:
    """Values less the mean of their field; a grouped mean joined back, so that a large field is not one task."""
    mean = frame.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    return frame.join(mean, list(keys)).withColumn(value, F.col(value) - F.col("__mean")).drop("__mean")


def transect(cells: DataFrame, lon_index: int, band: int, keys: tuple[str, ...] = ("product",)) -> DataFrame:
    """Values by latitude along a column of cells: that column if more than half of it is there, else the mean of a band."""
    n_rows = cells.groupBy(*keys).agg(F.count_distinct("j").alias("n"))
    near = cells.where(F.abs(F.col("i") - lon_index) <= band)
    by_row = near.groupBy(*keys, "j").agg(F.avg(F.when(F.col("i") == lon_index, F.col("val"))).alias("own"), F.avg("val").alias("wide"))
    dense = by_row.groupBy(*keys).agg(F.count("own").alias("k")).join(n_rows, list(keys)).select(*keys, (F.col("k") > F.col("n") / 2).alias("is_dense"))
    return by_row.join(dense, list(keys)).select(*keys, "j", F.when(F.col("is_dense"), F.col("own")).otherwise(F.col("wide")).alias("value"))

"""Scans and formatting of products: crops, merges of tiles, days, passes, level choice, variable pairing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import kelvin_to_celsius
from ..functions.geo import BBox, lon_to_180, region_id
from .gridding import merge_to_grid


def crop(cells: DataFrame, box: BBox, columns: list[str] | None = None) -> DataFrame:
    """Cells of a box (closed on both sides, either order of latitudes); filter and columns reach the scan."""
    d = cells.where(F.col("lon").between(box.lon_min, box.lon_max) & F.col("lat").between(min(box.lat_min, box.lat_max), max(box.lat_min, box.lat_max)))
    return d.select(*columns) if columns else d


def load_tile(cells: DataFrame, date: str, region: int, source: str, n_regions: int = 8) -> DataFrame:
    """One source's tile of a region and date."""
    if not 0 <= region < n_regions:
        raise ValueError(f"unknown tile {region}")
    return cells.where((F.col("obs_date") == F.lit(date).cast("date")) & (F.col("region_id") == region) & (F.col("product") == source))


def load_listed(cells: DataFrame, listed: DataFrame, keys: tuple[str, ...] = ("obs_date", "region_id")) -> DataFrame:
    """The cells of the tiles that a catalog lists. Over a table in folders by these keys only the folders that the list names are read."""
    return cells.join(listed.select(*keys).distinct(), list(keys), "left_semi")


def load_box(cells: DataFrame, date: str, box: BBox, source: str, whole_tiles: bool = True) -> DataFrame:
    """All tiles that a box touches, merged; cropped to the box on request."""
    west, east, south, north = (int((v + o) // 90) for v, o in ((box.lon_min, 180), (box.lon_max, 180), (box.lat_min, 90), (box.lat_max, 90)))
    wanted = [i + 4 * j for i in range(max(0, west), min(3, east) + 1) for j in range(max(0, south), min(1, north) + 1)]
    d = cells.where((F.col("obs_date") == F.lit(date).cast("date")) & F.col("region_id").isin(wanted) & (F.col("product") == source))
    return d if whole_tiles else crop(d, box)


def load_box_merged(cells: DataFrame, date: str, box: BBox, source: str, step: float) -> DataFrame:
    """The tiles that a box touches, cropped and averaged onto one grid of the box."""
    return merge_to_grid(load_box(cells, date, box, source, whole_tiles=False), box, step, ("obs_date",))


def load_swath(swath: DataFrame, dims: dict[str, tuple[str, ...]], box: BBox) -> DataFrame:
    """A swath's cells in a box, with only those variables that lie on time, latitude and longitude alone. dims: of each column."""
    kept = [c for c in swath.columns if set(dims[c]) <= {"time", "lat", "lon"}]
    return crop(swath, box, kept)


def with_unit_offsets(cells: DataFrame, offsets: dict[str, float], keys: tuple[str, ...] = ("obs_date",), variable: str = "variable", value: str = "val") -> DataFrame:
    """Values with their variable's offset on load (Kelvin to Celsius), but only for fields that are still in Kelvin: a mean above 200."""
    table = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]) if offsets else F.create_map().cast("map<string,double>")
    mean = cells.groupBy(*keys, variable).agg(F.avg(value).alias("__mean"))
    offset = F.when(F.col("__mean") > 200, F.coalesce(F.try_element_at(table, F.col(variable)), F.lit(0.0))).otherwise(F.lit(0.0))
    return cells.join(mean, [*keys, variable]).withColumn(value, F.col(value) + offset).drop("__mean")


def expanded_aliases(tokens: Column, aliases: dict[str, list[str]]) -> Column:
    """Names from tokens, which may hold several after commas and may be aliases of several; each name once, in order."""
    table = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    parts = F.filter(F.transform(F.flatten(F.transform(tokens, lambda t: F.split(t, ","))), lambda t: F.trim(t)), lambda p: F.length(p) > 0)
    return F.array_distinct(F.flatten(F.transform(parts, lambda p: F.coalesce(F.try_element_at(table, p), F.array(p)))))


def dated_files(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Files whose name fits their product's pattern, with the date in it. patterns: (product, pattern, date_format), a row per product."""
    d = files.join(F.broadcast(patterns), "product").withColumn("__found", F.expr("regexp_extract(path, pattern, 1)"))
    return d.where("__found <> ''").withColumn("obs_date", F.expr("CAST(try_to_timestamp(__found, date_format) AS date)")).drop("__found", "pattern", "date_format")


def first_of(frame: DataFrame, candidates: list[str], keys: tuple[str, ...], variable: str = "variable") -> DataFrame:
    """The rows of each key's best variable, by place in a list of candidates; those of no candidate are dropped. Long-table form of first_present."""
    place = F.array_position(F.array(*map(F.lit, candidates)), F.col(variable))
    best = frame.where(place > 0).groupBy(*keys).agg(F.min_by(variable, place).alias(variable))
    return frame.join(best, [*keys, variable], "left_semi")


def multi_source_series(cells: DataFrame, sources: list[str], start: str, end: str, region: int | None = None, box: BBox | None = None) -> DataFrame:
    """Several sources over dates, for exactly one of a tile and a box, with a time on every row."""
    if (region is None) == (box is None):
        raise ValueError("give a tile or a box, not both")
    d = cells.where(F.col("product").isin(sources) & F.col("obs_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    d = d.where(F.col("region_id") == region) if box is None else crop(d, box)
    return with_time(d)


def with_time(frame: DataFrame) -> DataFrame:
    """The observation's time, or its day where there is none."""
    time = F.coalesce(F.col("obs_time").cast("timestamp"), F.col("obs_date").cast("timestamp")) if "obs_time" in frame.columns else F.col("obs_date").cast("timestamp")
    return frame.withColumn("obs_time", time)


def day_inputs(files: DataFrame, kinds: DataFrame, date: str) -> DataFrame:
    """Files of a day; of swath and track sources also those of the day before and after. kinds: source_id, kind."""
    day = F.lit(date).cast("date")
    off = F.abs(F.datediff("obs_date", day))
    near = files.where(F.col("obs_date").between(F.date_sub(day, 1), F.date_add(day, 1)))  # reaches the scan
    return near.join(F.broadcast(kinds), "source_id").where((off == 0) | ((off == 1) & F.col("kind").isin("swath", "track")))


def normalised(points: DataFrame, names: dict[str, str]) -> DataFrame:
    """Coordinates under their usual names, longitudes in [-180, 180)."""
    d = points.withColumnsRenamed({k: v for k, v in names.items() if k in points.columns})
    return d.withColumn("lon", lon_to_180(F.col("lon")))


def first_present(frame: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate that is a column, else the first column that contains one."""
    low = {c.lower(): c for c in frame.columns}
    return next((low[c.lower()] for c in candidates if c.lower() in low), next((v for c in candidates for k, v in low.items() if c.lower() in k), None))


def chosen_level(profiles: DataFrame, level_of: DataFrame) -> DataFrame:
    """The rows of each variable's level; the first level where the variable is not listed. level_of: variable, level_idx."""
    d = profiles.join(F.broadcast(level_of.withColumnRenamed("level_idx", "__want")), "variable", "left")
    return d.where(F.col("level_idx") == F.coalesce("__want", F.lit(0))).drop("__want")


def whitelisted(cells: DataFrame, variables: list[str]) -> DataFrame:
    """The rows of wanted variables."""
    return cells.where(F.col("variable").isin(variables))


def format_product(cells: DataFrame, variables: list[str], level_of: DataFrame | None = None) -> DataFrame:
    """A gridded product from raw rows: first time step of a day, wanted variables and levels, normal longitudes, Celsius, regions.

    Where there is no obs_time, a day has one time step; levels are chosen where level_of is given.
    """
    if "obs_time" in cells.columns:
        first = cells.groupBy("variable", "obs_date").agg(F.min("obs_time").alias("obs_time"))
        cells = cells.join(first, ["variable", "obs_date", "obs_time"], "left_semi")
    if level_of is not None:
        cells = chosen_level(cells, level_of)
    d = whitelisted(cells, variables).withColumn("lon", lon_to_180(F.col("lon")))
    d = kelvin_to_celsius(d, ("variable", "obs_date"), "val", "variable")
    return d.withColumn("region_id", region_id(F.col("lon"), F.col("lat"))).where(F.col("region_id").isNotNull())


def tracks_touching(points: DataFrame, regions: DataFrame, keys: tuple[str, ...] = ("obs_date", "track_id")) -> DataFrame:
    """Tracks and regions whose extents meet (upper bounds excluded): a test before any gridding."""
    extent = points.groupBy(*keys).agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    meets = (F.col("e") >= F.col("r_lon_min")) & (F.col("w") < F.col("r_lon_max")) & (F.col("n") >= F.col("r_lat_min")) & (F.col("s") < F.col("r_lat_max"))
    return extent.join(F.broadcast(regions), meets).select(*keys, "region_id")


def swath_lines(points: DataFrame, inside: Column, swath: str = "track_id", line: str = "obs_id", value: str = "val") -> DataFrame:
    """The unbroken lines of each swath from its first to its last hit of a box, whole, with NULL outside the box."""
    span = points.where(inside).groupBy(swath).agg(F.min(line).alias("__low"), F.max(line).alias("__high"))
    d = points.join(span, swath).where(F.col(line).between(F.col("__low"), F.col("__high")))
    return d.withColumn(value, F.when(inside, F.col(value))).drop("__low", "__high")


def with_pass(files: DataFrame, source: str = "source", path: str = "path") -> DataFrame:
    """Files of a source with passes as two sources, the pass recorded; those without a pass keep their source."""
    way = pass_of(F.col(path))
    short = F.when(way == "ascending", "_asc").when(way == "descending", "_desc").otherwise("")
    return files.withColumns({"satellite_pass": way, source: F.concat(F.col(source), short)})


def pass_of(path: Column) -> Column:
    """ascending or descending, from the path of a pass file."""
    return F.when(path.contains("smos-asc"), "ascending").when(path.contains("smos-des"), "descending")


def comparable_variables(left: DataFrame, right: DataFrame, skip: list[str], preferred: list[str]) -> DataFrame:
    """Variables in both lists (source, variable) but the skipped ones; is_chosen marks one per source, by preference."""
    both = left.join(right, ["source", "variable"]).where(~F.col("variable").isin(skip)).distinct()
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, preferred)), F.col("variable")), F.lit(0)), F.lit(len(preferred) + 1).cast("bigint"))
    return both.withColumn("is_chosen", F.row_number().over(Window.partitionBy("source").orderBy(place, "variable")) == 1)


def native_pixels(variables: DataFrame, patch_degrees: float, pixels: int) -> DataFrame:
    """Native against requested pixels of a patch, by variable resolution."""
    native = F.round(F.lit(float(patch_degrees)) / F.col("res_deg")).cast("int")
    return variables.withColumn("native_pixels", native).withColumn("ratio", F.lit(float(pixels)) / native)


def sample_id(source: Column, region: Column, date: Column) -> Column:
    return F.concat_ws("_", source, region, F.date_format(date, "yyyyMMdd"))


def sample_name(source: Column, variable: Column, path: Column) -> Column:
    """A sample's name: its source, but the variable for all-physics files of the model, and the pass for salinity swaths."""
    swath = F.when(F.contains(F.lower(path), F.lit("asc")), "l3_sss_asc").otherwise("l3_sss_desc")
    return F.when(source == "glorys_all_phys", F.concat(F.lit("glorys_"), variable)).when(source.isin("l3_sss_smos_asc", "l3_sss_smos_desc"), swath).otherwise(source)


def modality(source: Column) -> Column:
    return F.when(source == "glorys", "model").when(source == "argo", "in_situ").otherwise("satellite")


def with_pixel_counts(frame: DataFrame, x: str, y: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts of pairs on square bins, with their logarithm."""
    def at(c: str) -> Column:
        return F.least(F.lit(bins - 1), F.floor((F.col(c) - low) / ((high - low) / bins)).cast("int"))

    d = frame.where(F.col(x).between(low, high) & F.col(y).between(low, high)).groupBy(at(x).alias("x"), at(y).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return d.withColumn("log_n", F.log10("n"))

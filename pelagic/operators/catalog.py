"""Tile catalog: look-ups, coverage, gaps, duplicates, upserts, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .boxes import for_equal_boxes, spread

MAX_TILES = 11


def catalog_scan(tiles: DataFrame, start: str, end: str, sources: list, pad_prefix: str | None = None) -> DataFrame:
    """Tiles of some sources in a date range; padding rows, whose id begins with a prefix, are left out. Filters reach the scan."""
    d = tiles.where(F.col("obs_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & F.col("source_id").isin(sources))
    return d.where(~F.col("id").startswith(pad_prefix)) if pad_prefix else d


def catalog_lookup(tiles: DataFrame, regions: DataFrame, date: str, box, needed: DataFrame) -> DataFrame:
    """Tiles of a date whose region touches a box (closed) and whose source is needed."""
    touching = regions.where((F.col("r_lon_min") <= box.lon_max) & (F.col("r_lon_max") >= box.lon_min) & (F.col("r_lat_min") <= box.lat_max) & (F.col("r_lat_max") >= box.lat_min))
    return tiles.where(F.col("obs_date") == F.lit(date).cast("date")).join(F.broadcast(touching.select("region_id")), "region_id", "left_semi").join(needed, "source_id", "left_semi")


def _query_days(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """A row per query, day and region, and whether the region shares area with the box. The eight regions are broadcast."""
    meets = (F.col("lon_max") > F.col("r_lon_min")) & (F.col("lon_min") < F.col("r_lon_max")) & (F.col("lat_max") > F.col("r_lat_min")) & (F.col("lat_min") < F.col("r_lat_max"))
    d = boxes.crossJoin(F.broadcast(regions)).select("query_id", "date_start", "date_end", "region_id", meets.alias("meets"))
    return d.withColumn("obs_date", F.explode(F.sequence("date_start", "date_end", F.expr("INTERVAL 1 DAY")))).drop("date_start", "date_end")


#: Tiles of a date and region in one row, on average: what meets the queries.
CHUNK = 1024


def query_tiles(boxes: DataFrame, tiles: DataFrame, sources: DataFrame, regions: DataFrame, *keep: str) -> DataFrame:
    """Tiles of each query's dates and regions and the wanted sources: dates are exploded, so that the join is an equi-join.

    Tiles meet the queries in arrays of some CHUNK, and equal boxes as one, dealt over all tasks; only then do they become
    rows. What is moved is a row per different box, day, region and array. keep: the tiles' columns of the result beside
    date and region, all if none is named; a single one stands in its arrays as it is, which makes rows faster than structs.
    """
    at = ["obs_date", "region_id"]
    wanted = tiles.join(sources, "source_id", "left_semi")
    wanted = wanted.select(*at, *keep) if keep else wanted
    others = [c for c in wanted.columns if c not in at]
    parts = wanted.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("__parts"))
    dealt = wanted.join(parts, at).withColumn("__part", F.pmod(F.xxhash64(*others), F.col("__parts")).cast("int"))
    chunks = spread(dealt, *at, "__part").groupBy(*at, "__part").agg(F.collect_list(F.struct(*others)).alias("__tiles"))  # structs: a list leaves out nulls
    if len(others) == 1:
        chunks = chunks.withColumn("__tiles", F.col("__tiles")[others[0]])

    def met(q: DataFrame) -> DataFrame:
        days = _query_days(q, regions).where("meets").drop("meets").join(parts, at)
        days = days.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
        return spread(days, *at, "__part").join(chunks, [*at, "__part"]).drop("__part")

    both = for_equal_boxes(boxes, met)
    rows = both.select(*at, "query_id", F.explode("__tiles").alias(others[0] if len(others) == 1 else "__t"))
    return rows if len(others) == 1 else rows.select(*at, "query_id", *[F.col(f"__t.{c}").alias(c) for c in others])


def files_of_queries(boxes: DataFrame, tiles: DataFrame, sources: DataFrame, regions: DataFrame, name: str = "n") -> DataFrame:
    """(query_id, source_id, n): how many tiles query_tiles would give. They are counted by date, region and source first, so that no tile meets a query."""
    counts = tiles.join(sources, "source_id", "left_semi").groupBy("obs_date", "region_id", "source_id").agg(F.count(F.lit(1)).alias("__n"))
    return _query_days(boxes, regions).where("meets").join(counts, ["obs_date", "region_id"]).groupBy("query_id", "source_id").agg(F.sum("__n").alias(name))


def query_file_counts(boxes: DataFrame, tiles: DataFrame, sources: DataFrame, regions: DataFrame) -> DataFrame:
    """By query: tiles of its dates and sources (n_files_indexed), and how many of them, of what size, its box needs.

    Tiles are counted by date and region first, so that no tile meets a query.
    """
    by_day = tiles.join(sources, "source_id", "left_semi").groupBy("obs_date", "region_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes"))
    needed = F.when(F.col("meets"), F.col("n")), F.when(F.col("meets"), F.col("bytes"))
    counts = [F.sum("n").alias("n_files_indexed"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in zip(needed, ("n_files", "n_bytes"))]]
    return _query_days(boxes, regions).join(by_day, ["obs_date", "region_id"]).groupBy("query_id").agg(*counts)


def _expected(tiles: DataFrame) -> DataFrame:
    """A row per date between the first and last, and source."""
    sources = tiles.groupBy("source_id").agg(F.min("obs_date").alias("low"), F.max("obs_date").alias("high"))
    return sources.withColumn("obs_date", F.explode(F.sequence("low", "high", F.expr("INTERVAL 1 DAY")))).select("source_id", "obs_date")


def missing_coverage(tiles: DataFrame, dense: list, n_regions: int = 8) -> DataFrame:
    """Dense sources lack a region where a date has no tile of it; others lack a date where no region has any."""
    expected = _expected(tiles)
    full = expected.where(F.col("source_id").isin(dense)).withColumn("region_id", F.explode(F.sequence(F.lit(0), F.lit(n_regions - 1))))
    by_region = full.join(tiles.select("source_id", "obs_date", "region_id").distinct(), ["source_id", "obs_date", "region_id"], "left_anti")
    by_date = expected.where(~F.col("source_id").isin(dense)).join(tiles.select("source_id", "obs_date").distinct(), ["source_id", "obs_date"], "left_anti")
    return by_region.unionByName(by_date.withColumn("region_id", F.lit(None).cast("int")))


def coverage_summary(tiles: DataFrame) -> DataFrame:
    """By source: first and last date, dates expected, with files and missing, most and fewest files of a date."""
    by_date = tiles.groupBy("source_id", "obs_date").agg(F.count(F.lit(1)).alias("n"))
    d = by_date.groupBy("source_id").agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"), F.count(F.lit(1)).alias("n_with_file"), F.max("n").alias("max_files"), F.min("n").alias("min_files"))
    expected = (F.datediff("last_date", "first_date") + 1).cast("long")
    return d.withColumn("n_expected", expected).withColumn("n_missing", F.col("n_expected") - F.col("n_with_file"))


def missing_dates(tiles: DataFrame) -> DataFrame:
    return _expected(tiles).join(tiles.select("source_id", "obs_date").distinct(), ["source_id", "obs_date"], "left_anti")


def missing_in_catalogue(present: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Files of the catalogue on dates, between the first and the last, on which nothing is present."""
    ends = present.agg(F.min("obs_date").alias("low"), F.max("obs_date").alias("high"))
    spine = ends.select(F.explode(F.sequence("low", "high", F.expr("INTERVAL 1 DAY"))).alias("obs_date"))
    gone = spine.subtract(present.select("obs_date")).intersect(catalogue.select("obs_date"))
    return catalogue.join(gone, "obs_date", "left_semi").select("obs_date", "file_id", "source_id", "region_id")


def availability_segments(tiles: DataFrame) -> DataFrame:
    """Unbroken runs of dates by source (gaps and islands)."""
    days = tiles.select("source_id", "obs_date").distinct()
    island = F.date_sub("obs_date", F.row_number().over(Window.partitionBy("source_id").orderBy("obs_date")))
    return days.withColumn("island", island).groupBy("source_id", "island").agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"), F.count(F.lit(1)).alias("n_days")).drop("island")


def first_per_key(tiles: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the one of the smallest values of `order`: tasks combine what they have before rows move."""
    others = [c for c in tiles.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*[F.col(o).alias(f"o{k}") if isinstance(o, str) else o.alias(f"o{k}") for k, o in enumerate(order)]))
    return tiles.groupBy(*keys).agg(first.alias("__first")).select(*[F.col(c) if c in keys else F.col("__first")[c].alias(c) for c in tiles.columns])


def cap_per_key(tiles: DataFrame, keys: list[str], order: list, most: int = MAX_TILES) -> DataFrame:
    """The first `most` rows of a key; n_dropped says how many more there are."""
    w = Window.partitionBy(*keys)
    d = tiles.withColumn("__rank", F.row_number().over(w.orderBy(*order))).withColumn("n_dropped", F.greatest(F.count(F.lit(1)).over(w) - most, F.lit(0)))
    return d.where(F.col("__rank") <= most).drop("__rank")


def duplicate_report(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once, with the count."""
    n = tiles.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_same")).where("n_same > 1")
    return tiles.join(n, keys)


def first_rows(frame: DataFrame, n: int, order: list) -> DataFrame:
    """The first n rows in an explicit order."""
    return frame.orderBy(*order).limit(n)


def top_collisions(tiles: DataFrame, keys: list[str], most: int = 20) -> DataFrame:
    return tiles.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").transform(first_rows, most, [F.desc("n"), *keys])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key was processed anew give way to the new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_processed(old: DataFrame, new: DataFrame, processed: list[str], aliases: dict[str, list[str]], dates: DataFrame, source: str = "source") -> DataFrame:
    """Old rows of the processed sources on the processed dates go, whether or not new rows came for them; then the new rows.

    processed: names, which may be aliases of several stored sources. dates: obs_date, of which there are few.
    """
    stored = sorted({own for name in processed for own in aliases.get(name, [name])})
    done = dates.select("obs_date").distinct().withColumn("__done", F.lit(True))
    kept = old.join(done, "obs_date", "left").where(~(F.coalesce("__done", F.lit(False)) & F.coalesce(F.col(source).isin(stored), F.lit(False)))).select(*old.columns)
    return kept.unionByName(new, allowMissingColumns=True)


def drop_odd_duplicates(tiles: DataFrame, keys: list[str], canonical: Column) -> DataFrame:
    """Rows with a name that is not canonical go, but only where their key is taken by several rows, one of them canonical."""
    w = Window.partitionBy(*keys)
    d = tiles.withColumn("__ok", canonical).withColumn("__n", F.count(F.lit(1)).over(w)).withColumn("__some", F.max("__ok").over(w))
    return d.where(F.col("__ok") | (F.col("__n") == 1) | ~F.col("__some")).drop("__ok", "__n", "__some")


def inventory_summary(tiles: DataFrame) -> DataFrame:
    """Counts and date ranges by source, by region and overall, in one pass of grouping sets."""
    return tiles.groupingSets([["source_id"], ["region_id"], []], "source_id", "region_id").agg(
        F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"), F.sum("n_bytes").alias("n_bytes")
    )


def hierarchy(tiles: DataFrame, n_regions: int = 8) -> DataFrame:
    """Every date with all its regions, empty ones too, their sorted files, the day's first and last second, and the range of all dates."""
    ends = tiles.agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))
    start = F.unix_seconds(F.col("obs_date").cast("timestamp"))
    days = tiles.select("obs_date").distinct().crossJoin(F.broadcast(ends)).withColumns({"day_start": start, "day_end": start + 86399}).withColumn("region_id", F.explode(F.sequence(F.lit(0), F.lit(n_regions - 1))))
    files = tiles.groupBy("obs_date", "region_id").agg(F.sort_array(F.collect_list("file_id")).alias("files"))
    return days.join(files, ["obs_date", "region_id"], "left").withColumn("files", F.coalesce("files", F.array().cast("array<bigint>")))


def pending_files(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Wanted files that are not there with the same size; an unknown size counts as the same."""
    there = present.select(F.col("name").alias("__name"), F.col("size").alias("__size"))
    same = (F.col("name") == F.col("__name")) & ((F.col("size") == 0) | (F.col("size") == F.col("__size")))
    return wanted.join(there, same, "left_anti")


def catalogue_rows(catalogue: DataFrame, column: str = "json") -> DataFrame:
    """A nested catalogue (cycle -> files) as flat rows; files without a date are dropped."""
    schema = "cycles map<string,array<struct<filename:string,size:bigint,date:string,time:string,version:string>>>"
    d = catalogue.select(F.explode(F.from_json(column, schema)["cycles"]).alias("cycle", "files")).select("cycle", F.explode("files").alias("f")).select("cycle", "f.*")
    return d.withColumn("date", F.try_to_timestamp("date", F.lit("yyyyMMdd")).cast("date")).where(F.col("date").isNotNull())


def highest_version(files: DataFrame, name: str = "filename", pattern: str = r"^(.*)_(\d+)\.nc$") -> DataFrame:
    """The highest version of each base name; names that don't fit the pattern stay."""
    fits = F.col(name).rlike(pattern)
    d = files.withColumn("__base", F.when(fits, F.regexp_extract(name, pattern, 1)).otherwise(F.col(name))).withColumn("__version", F.when(fits, F.regexp_extract(name, pattern, 2).cast("int")).otherwise(0))
    return first_per_key(d, ["__base"], [-F.col("__version"), F.col(name)]).drop("__base", "__version")


def product_priority(files: DataFrame, products: DataFrame) -> DataFrame:
    """Of the products that are valid on a date, the one of the best rank."""
    valid = files.join(products, (files["product"] == products["p_product"]) & files["obs_date"].between(products["valid_from"], products["valid_to"]))
    return first_per_key(valid, ["obs_date"], [F.col("rank"), F.col("product"), F.col("file_id")])


def malformed(tiles: DataFrame, name: str, pattern: str, required: list[str]) -> DataFrame:
    """Rows with a canonical name, the required values, and the region that the name says."""
    d = tiles.where(F.col(name).rlike(pattern) & (F.regexp_extract(name, pattern, 1) == F.col("region_id").cast("string")))
    for c in required:
        d = d.where(F.col(c).isNotNull())
    return d


def source_order(source: Column) -> Column:
    """L4, L3, L2, floats, model, other."""
    order = F.lit(5)
    for rank, start in reversed(list(enumerate(("l4", "l3", "l2", "argo", "glorys")))):
        order = F.when(source.startswith(start), F.lit(rank)).otherwise(order)
    return order


def date_of_name(path: Column, pattern: str) -> Column:
    """The measurement date in a file name: the first of its two dates of eight digits."""
    return F.to_date(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), "yyyyMMdd")


def region_of_path(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def attempt_summary(log: DataFrame) -> DataFrame:
    """Counts of ingest attempts by dataset and status, and over all datasets."""
    return log.rollup("dataset").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("success", "partial", "failed", "skipped")])

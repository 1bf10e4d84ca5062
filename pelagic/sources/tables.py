"""Readers and writers of the product's tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TILES = T.StructType([
    T.StructField("file_id", T.LongType()), T.StructField("obs_date", T.DateType()), T.StructField("region_id", T.IntegerType()), T.StructField("source_id", T.IntegerType()), T.StructField("n_bytes", T.LongType()),
])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one in the warehouse where that is unset.

    A warehouse in a machine's own folder serves a local master alone; on a cluster that is an error.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if spark.conf.get("spark.sql.warehouse.dir").startswith(("file:", "/")) and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}/shared-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Cuts the lineage of frames by writing them to the shared folder."""
    def write(frame: DataFrame) -> DataFrame:
        path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    return write


def read_inventory(spark: SparkSession, path: str, schema: T.StructType = TILES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_inventory(tiles: DataFrame, path: str) -> None:
    """Sorted by date and source, with the date as text."""
    tiles.withColumn("date_str", F.date_format("obs_date", "yyyyMMdd")).orderBy("obs_date", "source_id", "file_id").write.mode("overwrite").parquet(path)


def write_tiles(cells: DataFrame, path: str, keys: tuple[str, ...] = ("source", "obs_date", "region_id")) -> None:
    """A folder per source, date and region; only the partitions that occur are replaced. Rows are clustered by tile."""
    cells.repartition(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(path)


def write_days(points: DataFrame, path: str, day: str = "obs_date") -> None:
    """A folder per date of a point set; only the dates that occur are replaced."""
    write_tiles(points, path, (day,))


def write_swath(points: DataFrame, path: str, step: float = 5.0) -> None:
    """Points in order of their tile, so that the ranges of a file's rows let a box skip most of them."""
    tile = F.floor((F.col("lat") + 90) / step) * 1000 + F.floor((F.col("lon") + 180) / step)
    points.withColumn("__tile", tile).repartitionByRange("__tile").sortWithinPartitions("__tile", "lon", "lat").drop("__tile").write.option("compression", "zstd").parquet(path)


def inventory_of(cells: DataFrame, keys: tuple[str, ...] = ("source", "obs_date", "region_id")) -> DataFrame:
    """A row per written tile, derived from its cells."""
    return cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"), *[f(c).alias(f"{c}_{n}") for c in ("i", "j") for n, f in (("min", F.min), ("max", F.max))])


def read_box(spark: SparkSession, path: str, box, columns: list[str]) -> DataFrame:
    """Rows of a point table in a box; the predicate and the columns reach the scan."""
    return spark.read.parquet(path).where(F.col("lon").between(box.lon_min, box.lon_max) & F.col("lat").between(box.lat_min, box.lat_max)).select(*columns)


def save_queries(boxes: DataFrame, path: str, metadata: dict[str, str] | None = None) -> None:
    """Parquet, and a one-row JSON beside it with the count, the time and the user's own entries."""
    boxes.write.mode("overwrite").parquet(f"{path}/queries")
    facts = {"n_queries": F.count(F.lit(1)), "generated_at": F.lit(datetime.now(timezone.utc).isoformat())} | {k: F.lit(v) for k, v in (metadata or {}).items()}
    boxes.agg(*[v.alias(k) for k, v in facts.items()]).write.mode("overwrite").json(f"{path}/metadata")


def load_queries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/queries"), spark.read.json(f"{path}/metadata")


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").option("header", True).csv(path)


def list_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files below a folder as a table: path, time, size, and the date that a pattern finds in the name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")
    return files.withColumn("obs_date", F.to_date(F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")), "yyyyMMdd"))


def save_bucketed(frame: DataFrame, keys: tuple[str, ...] = ("obs_date", "i", "j"), buckets: int = 64) -> DataFrame:
    """A stored product in buckets by its cells and days, sorted: two of them with as many buckets meet without a shuffle.

    The table lies in the shared folder; more buckets suit larger products (some 128 MB each).
    """
    spark, name = frame.sparkSession, f"stored_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    frame.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def read_tiles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that write_tiles wrote: filters on source, date and region choose its folders."""
    return spark.read.schema(schema).parquet(path)

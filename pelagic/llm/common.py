"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import uuid
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch: texts can be long, so that the default of 10,000 rows could hold gigabytes.
ARROW_ROWS = 500
#: Rows of a few numbers that are written as one file, rather than as many small ones as there are shuffle partitions.
ROWS_PER_FILE = 100_000
#: Rows of one key that a task may get in a join; keys with more meet their rows by broadcast.
HEAVY_ROWS = 1_000_000
#: Such keys that are broadcast at most.
BROADCAST_KEYS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lowers the session's Arrow batch size to ``rows`` (never raises it), for good: results are planned when they are used."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def shared_dir(spark: SparkSession) -> str:
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


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors, is computed once.

    rows: about how many there are at most, of a few numbers each; then a file holds ROWS_PER_FILE of them.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(1 + rows // ROWS_PER_FILE)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(df: DataFrame, of_keys: DataFrame, key: str, n: str, rows: int) -> DataFrame:
    """df joined with of_keys, which has one row for each key of df; n counts about the rows of a key in df, rows is at least their largest sum.

    A shuffle would send all rows of a key to one task. Keys of more than HEAVY_ROWS rows are broadcast instead and their
    rows stay where they are. There are at most rows / HEAVY_ROWS of them; with more than BROADCAST_KEYS, AQE has to split them.
    """
    if rows <= HEAVY_ROWS:
        return df.join(of_keys, key)
    heavy = materialize(of_keys.where(F.col(n) > HEAVY_ROWS), "heavy-keys", 0)
    if not 0 < heavy.count() <= BROADCAST_KEYS:
        return df.join(of_keys, key)
    rest = df.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return rest.join(of_keys, key).unionByName(df.join(F.broadcast(heavy), key))


def set_aside(docs: DataFrame, prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with those columns renamed that begin with an operator's own prefix, and the names to give back."""
    taken = {c.lower() for c in docs.columns}
    free = (name for name in (f"kept_{k}" for k in count()) if name not in taken)
    away = {c: next(free) for c in docs.columns if c.lower().startswith(prefix)}
    return docs.withColumnsRenamed(away), {new: old for old, new in away.items()}


def unit_draw(*parts: Column) -> Column:
    """A reproducible uniform number in [0, 1) from 52 bits of the md5 of the parts, joined by '|' (null: empty)."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))

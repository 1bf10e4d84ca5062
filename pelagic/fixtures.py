"""Ocean-shaped views over the driver's tables, as one SQL text for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "obs": """SELECT event_id AS obs_id, user_id % 12 AS track_id, CAST(ts AS DATE) AS obs_date, ts AS obs_time,
  CAST((event_id*7919 + user_id*613) % 3600 AS DOUBLE)/10 - 180 AS lon,
  CAST((event_id*15485863 + user_id*97) % 1800 AS DOUBLE)/10 - 90 AS lat,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value/100 END AS val FROM events""",
    "cells": """SELECT CASE WHEN l_linestatus='O' THEN 'l4_ssh' ELSE 'glorys' END AS product,
  CAST(DATE '2024-01-01' + CAST(l_partkey % 30 AS INT) AS DATE) AS obs_date,
  CAST(l_orderkey % 36 AS INT) AS i, CAST(l_suppkey % 18 AS INT) AS j,
  AVG(l_extendedprice)/100000 AS val FROM lineitem GROUP BY 1,2,3,4""",
    "tiles": """SELECT o_orderkey AS file_id, CAST(DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT) AS DATE) AS obs_date,
  CAST(o_custkey % 8 AS INT) AS region_id, CAST(o_orderkey % 11 AS INT) AS source_id,
  CAST(FLOOR(o_totalprice) AS BIGINT) AS n_bytes FROM orders WHERE o_orderkey % 13 <> 0""",
    "boxes": """SELECT c_custkey AS query_id,
  CAST(c_custkey*7919 % 3400 AS DOUBLE)/10 - 175 AS lon_min, CAST(c_custkey*7919 % 3400 AS DOUBLE)/10 - 165 AS lon_max,
  CAST(c_custkey*104729 % 1200 AS DOUBLE)/10 - 65 AS lat_min, CAST(c_custkey*104729 % 1200 AS DOUBLE)/10 - 55 AS lat_max,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 28 AS INT) AS DATE) AS date_start,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 28 + c_custkey % 3 AS INT) AS DATE) AS date_end FROM customer""",
    "profiles": """SELECT l_orderkey AS profile_id, l_linenumber AS level, l_partkey, l_suppkey,
  l_quantity/5 AS pres, l_discount*100+10 AS temp, 30+l_tax*50 AS psal,
  CAST(l_orderkey*7919 % 3600 AS DOUBLE)/10 - 180 AS lon, CAST(l_orderkey*104729 % 1800 AS DOUBLE)/10 - 90 AS lat,
  CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT) AS DATE) AS obs_date FROM lineitem""",
}
_FROM = {"obs": "events", "cells": "lineitem", "tiles": "orders", "boxes": "customer", "profiles": "lineitem"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{_FROM[name]}.parquet")
    return spark.sql(VIEWS[name].replace(f"FROM {_FROM[name]}", "FROM {source}"), source=source)


def land_mask(spark: SparkSession) -> DataFrame:
    """A quarter-degree rule mask (i: latitude index, j: longitude index)."""
    return spark.range(1440 * 720).select(
        (F.col("id") % 1440).alias("j"), F.floor(F.col("id") / 1440).alias("i"),
        (((F.col("id") % 1440) * 31 + F.floor(F.col("id") / 1440) * 17) % 10 < 3).alias("is_land"),
    )


LAND_SQL = "SELECT range % 1440 AS j, range // 1440 AS i, ((range % 1440)*31 + (range // 1440)*17) % 10 < 3 AS is_land FROM range(1036800)"


def with_views(sql: str, *names: str) -> str:
    """The oracle's SQL, with the named views in front."""
    own = [f"{n} AS ({LAND_SQL if n == 'land' else VIEWS[n]})" for n in names]
    start = next((s for s in ("WITH RECURSIVE ", "WITH ") if sql.startswith(s)), "")
    return f"{start or 'WITH '}{', '.join(own)}{', ' if start else ' '}{sql[len(start):]}"

"""Streaming queries over the events table, each run to its end and compared with the batch result."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..fixtures import view
from ..sources.tables import shared_folder
from ..streaming import jobs
from .common import Registry, rounded

R = Registry()
_CELL = "CAST(FLOOR((lon+180)/10) AS INT) AS i, CAST(FLOOR((lat+90)/10) AS INT) AS j"


def _stream(spark, sf):
    """The observations as a stream of files."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf)
    return source.selectExpr("event_id AS obs_id", "user_id % 12 AS track_id", "CAST(ts AS TIMESTAMP) AS obs_time", "CAST((event_id*7919 + user_id*613) % 3600 AS DOUBLE)/10 - 180 AS lon",
                             "CAST((event_id*15485863 + user_id*97) % 1800 AS DOUBLE)/10 - 90 AS lat", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value/100 END AS val")


def _run(spark, frame, mode, keys=()):
    name = f"stream_{uuid4().hex}"
    return jobs.run_available(frame, name, mode, f"{shared_folder(spark)}/{name}", keys)


_CLOSED = "CAST(obs_date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT MAX(obs_time) FROM obs) - INTERVAL 1 DAY"  # windows that the watermark has passed
R.add(
    "t1_daily_means", lambda s, d: rounded(_run(s, jobs.daily_means(_stream(s, d), 90.0), "append")),
    f"SELECT obs_date, CAST(FLOOR((lon+180)/90) AS INT) AS i, CAST(FLOOR((lat+90)/90) AS INT) AS j, ROUND(AVG(val), 6) AS value, COUNT(val) AS n, COUNT(DISTINCT HOUR(obs_time)) >= 24 AS is_complete FROM obs WHERE {_CLOSED} GROUP BY 1,2,3", "obs",
)
R.add("t3_gridded_sums", lambda s, d: rounded(_run(s, jobs.gridded_sums(_stream(s, d), 10.0), "update", ("obs_date", "region_id", "i", "j"))), f"SELECT obs_date, CAST(FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90) AS INT) AS region_id, {_CELL}, ROUND(SUM(val), 6) AS total, COUNT(val) AS n FROM obs GROUP BY 1,2,3,4", "obs")
R.add("t4_without_repeats", lambda s, d: _run(s, jobs.without_repeats(_stream(s, d).selectExpr("CAST(track_id AS STRING) AS relative_path", "obs_time AS seen_at"), delay="400 days"), "append").select("relative_path"), "SELECT DISTINCT CAST(track_id AS VARCHAR) AS relative_path FROM obs", "obs")
R.add(
    "t5_matched_to_grid", lambda s, d: rounded(_run(s, jobs.matched_to_grid(_stream(s, d), view(s, d, "cells").where("product = 'glorys'"), 10.0).select("obs_id", "i", "j", "grid_val"), "append"), 10),
    f"SELECT obs_id, o.i, o.j, ROUND(c.val, 10) AS grid_val FROM (SELECT *, {_CELL} FROM obs) o LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = o.obs_date AND c.i = o.i AND c.j = o.j", "obs", "cells",
)
R.add(
    "t6_track_sessions", lambda s, d: _run(s, jobs.track_sessions(_stream(s, d), "2 hours"), "append").groupBy("track_id").agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("n").alias("n_rows")),
    """SELECT track_id, COUNT(*) AS n_sessions, CAST(SUM(n) AS BIGINT) AS n_rows FROM (SELECT track_id, session, COUNT(*) AS n, MAX(obs_time) AS last FROM (SELECT *, SUM(is_new) OVER (PARTITION BY track_id ORDER BY obs_time, obs_id) AS session
 FROM (SELECT *, CASE WHEN obs_time - LAG(obs_time) OVER (PARTITION BY track_id ORDER BY obs_time, obs_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS is_new FROM obs)) GROUP BY 1, 2) WHERE last + INTERVAL 2 HOUR <= (SELECT MAX(obs_time) FROM obs) - INTERVAL 1 DAY GROUP BY 1""", "obs",
)
R.add("t6_track_segments", lambda s, d: rounded(_run(s, jobs.track_segments(_stream(s, d), 1.5), "append")))  # made-up points: all steps are of one order
R.add(
    "t7_sliding_means", lambda s, d: rounded(_run(s, jobs.sliding_means(_stream(s, d), 3, 30.0), "append"), 9),
    """SELECT CAST(obs_date - CAST(k AS INT) AS DATE) AS first_date, CAST(FLOOR((lon+180)/30) AS INT) AS i, CAST(FLOOR((lat+90)/30) AS INT) AS j, ROUND(AVG(val), 9) AS value, COUNT(val) AS n FROM obs, range(3) AS t(k)
 WHERE CAST(obs_date - CAST(k AS INT) AS TIMESTAMP) + INTERVAL 3 DAY <= (SELECT MAX(obs_time) FROM obs) - INTERVAL 1 DAY GROUP BY 1,2,3""", "obs",
)
R.add("t8_online_moments", lambda s, d: rounded(_run(s, jobs.online_moments(_stream(s, d), ("track_id",)), "complete")), "SELECT track_id, ROUND(AVG(val), 6) AS mean, ROUND(STDDEV_POP(val), 6) AS std, ROUND(MIN(val), 6) AS min, ROUND(MAX(val), 6) AS max, COUNT(val) AS count FROM obs GROUP BY 1", "obs")


def _upserted(spark, sf):
    """Tiles streamed into partitions, then read back."""
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders*.parquet").parquet(sf).where("o_orderkey % 13 <> 0")
    tiles = stream.selectExpr("o_orderkey AS file_id", "CAST(DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT) AS DATE) AS obs_date", "CAST(o_custkey % 8 AS INT) AS region_id", "CAST(o_orderkey % 11 AS INT) AS source_id", "CAST(FLOOR(o_totalprice) AS BIGINT) AS n_bytes")
    path = f"{shared_folder(spark)}/upsert-{uuid4().hex}"
    jobs.upsert_batches(tiles, f"{path}/tiles", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/tiles").select("file_id", F.col("obs_date").cast("date").alias("obs_date"), "region_id", F.col("source_id").cast("int").alias("source_id"), "n_bytes")


R.add("t2_upsert_batches", _upserted, "SELECT DISTINCT * FROM tiles", "tiles")

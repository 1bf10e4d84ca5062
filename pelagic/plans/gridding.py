"""Queries over gridding and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import view
from ..functions.geo import BBox, haversine_km, lon_to_180
from ..functions.temporal import season
from ..operators import gridding as g
from .common import Registry, rounded

R = Registry()
_CELL = "CAST(FLOOR((lon+180)/10) AS INT) AS i, CAST(FLOOR((lat+90)/10) AS INT) AS j"
_REGION = "CAST(FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90) AS INT)"
_INDEX = "idx AS (SELECT obs_date, track_id, CAST(ROW_NUMBER() OVER (PARTITION BY obs_date ORDER BY track_id) - 1 AS INT) AS track_idx FROM (SELECT DISTINCT obs_date, track_id FROM obs WHERE val IS NOT NULL))"
_DAILY = f"""grid AS (SELECT obs_date, {_REGION} AS region_id, CAST(FLOOR((lon+180)/10) AS INT) AS i, CAST(FLOOR((lat+90)/10) AS INT) AS j, AVG(val) AS value, COUNT(val) AS n_obs,
 MIN(track_idx) AS primary_track, COUNT(DISTINCT track_id) > 1 AS is_overlap FROM obs JOIN idx USING (obs_date, track_id) WHERE val IS NOT NULL GROUP BY 1,2,3,4)"""


def _daily(spark, sf):
    return g.grid_daily_tracks(view(spark, sf, "obs"), 10.0)


def _track_table(spark, sf):
    return g.track_index(view(spark, sf, "obs"))


for how, sql in (("mean", "AVG(val)"), ("median", "MEDIAN(val)"), ("first", "ARG_MIN(val, (track_id, obs_id))"), ("last", "ARG_MAX(val, (track_id, obs_id))")):
    R.add(
        f"a1_bin_points_{how}", lambda s, d, how=how: rounded(g.bin_points(view(s, d, "obs"), 10.0, method=how, min_samples=2)),
        f"SELECT obs_date, {_REGION} AS region_id, {_CELL}, CASE WHEN COUNT(val) >= 2 THEN ROUND({sql}, 6) END AS value, COUNT(val) AS n_obs FROM obs WHERE val IS NOT NULL GROUP BY 1,2,3,4", "obs",
    )
R.add("a3_grid_daily_tracks", lambda s, d: rounded(_daily(s, d)), f"WITH {_INDEX}, {_DAILY} SELECT * REPLACE (ROUND(value, 6) AS value) FROM grid", "obs")
R.add("a7_track_times", lambda s, d: g.track_times(view(s, d, "obs")), "SELECT obs_date, track_id, CAST(EPOCH_US(CAST(obs_date AS TIMESTAMP)) + SUM(EPOCH_US(obs_time) - EPOCH_US(CAST(obs_date AS TIMESTAMP))) // COUNT(*) AS BIGINT) AS time_mean, MIN(EPOCH_US(obs_time)) AS time_min, MAX(EPOCH_US(obs_time)) AS time_max FROM obs GROUP BY 1,2", "obs")
R.add(
    "a45_cells_owned", lambda s, d: g.cells_owned(_daily(s, d), _track_table(s, d)),
    f"WITH {_INDEX}, {_DAILY} SELECT idx.obs_date, track_id, track_idx, COUNT(grid.i) AS n_cells FROM idx LEFT JOIN grid ON idx.obs_date = grid.obs_date AND idx.track_idx = grid.primary_track GROUP BY 1,2,3", "obs",
)
R.add(
    "f17_mask_tracks", lambda s, d: rounded(g.mask_tracks(_daily(s, d), [0, 3, 5], preserve_overlap=True)),
    f"WITH {_INDEX}, {_DAILY} SELECT * REPLACE (CASE WHEN primary_track IN (0,3,5) AND NOT is_overlap THEN NULL ELSE ROUND(value, 6) END AS value) FROM grid", "obs",
)
R.add(
    "f18_keep_platforms", lambda s, d: rounded(g.keep_platforms(_daily(s, d), _track_table(s, d).withColumn("platform", F.concat(F.lit("p"), F.col("track_id") % 3)), ["p0", "p2"])),
    f"WITH {_INDEX}, {_DAILY} SELECT grid.* REPLACE (CASE WHEN track_id % 3 IN (0, 2) THEN ROUND(value, 6) END AS value), 'p' || (track_id % 3) AS platform FROM grid JOIN idx ON idx.obs_date = grid.obs_date AND idx.track_idx = grid.primary_track", "obs",
)
R.add(
    "k6_split_tracks", lambda s, d: g.split_tracks(_track_table(s, d).select("obs_date", "track_id"), 0.3),
    f"""WITH {_INDEX} SELECT obs_date, track_id, ROW_NUMBER() OVER (PARTITION BY obs_date ORDER BY MD5('42|' || track_id), track_id)
 <= GREATEST(1, FLOOR(COUNT(*) OVER (PARTITION BY obs_date) * 0.3)) AS is_validation FROM idx""", "obs",
)
R.add(
    "a8_merge_to_grid", lambda s, d: rounded(g.merge_to_grid(view(s, d, "obs").where("lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50"), BBox(-80, -40, 10, 50), 4.0, ("obs_date",))),
    """SELECT obs_date, CAST(LEAST(9, FLOOR((lon+80)/4)) AS INT) AS ti, CAST(LEAST(9, FLOOR((lat-10)/4)) AS INT) AS tj, ROUND(AVG(val), 6) AS value, COUNT(val) AS n
 FROM obs WHERE lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50 GROUP BY 1,2,3""", "obs",
)
for how, sql in (("first", "ARG_MIN(val, obs_date)"), ("last", "ARG_MAX(val, obs_date)"), ("mean", "AVG(val)")):
    R.add(f"a9_temporal_{how}", lambda s, d, how=how: rounded(g.temporal_aggregate(view(s, d, "cells"), how, ("product", "i", "j")), 10), f"SELECT product, i, j, ROUND({sql}, 10) AS value FROM cells WHERE val IS NOT NULL GROUP BY 1,2,3", "cells")
R.add(
    "a9_temporal_stack", lambda s, d: rounded(g.temporal_aggregate(view(s, d, "cells"), "stack", ("product", "i", "j")).select("product", "i", "j", F.posexplode("value").alias("place", "value")), 10),
    "SELECT product, i, j, CAST(ROW_NUMBER() OVER (PARTITION BY product, i, j ORDER BY obs_date) - 1 AS INT) AS place, ROUND(val, 10) AS value FROM cells WHERE val IS NOT NULL", "cells",
)
R.add(
    "a10_daily_mean_complete", lambda s, d: rounded(g.daily_mean_complete(g.with_cells(view(s, d, "obs"), 10.0), 24)),
    f"WITH full_days AS (SELECT obs_date FROM obs GROUP BY 1 HAVING COUNT(DISTINCT HOUR(obs_time)) >= 24) SELECT obs_date, {_CELL}, ROUND(AVG(val), 6) AS value, COUNT(val) AS n FROM obs JOIN full_days USING (obs_date) GROUP BY 1,2,3", "obs",
)
R.add(
    "a11_resolution", lambda s, d: rounded(g.resolution(g.with_cells(view(s, d, "obs"), 10.0), ("obs_date", "region_id"))),
    f"""SELECT obs_date, {_REGION} AS region_id, ROUND(rlon, 6) AS res_lon, ROUND(rlat, 6) AS res_lat, ROUND(rlon * 111.32 * COS(RADIANS(mid)), 6) AS res_lon_km, ROUND(rlat * 110.574, 6) AS res_lat_km
 FROM (SELECT obs_date, ANY_VALUE(lon) AS lon, ANY_VALUE(lat) AS lat, (MAX(lon)-MIN(lon))/NULLIF(COUNT(DISTINCT lon)-1, 0) AS rlon, (MAX(lat)-MIN(lat))/NULLIF(COUNT(DISTINCT lat)-1, 0) AS rlat, (MAX(lat)+MIN(lat))/2 AS mid FROM obs GROUP BY obs_date, {_REGION})""", "obs",
)
R.add(
    "a12_tile_extent", lambda s, d: g.tile_extent(g.with_cells(view(s, d, "obs"), 10.0), ("obs_date", "region_id")),
    f"SELECT obs_date, {_REGION} AS region_id, MIN(lon) AS lon_min, MAX(lon) AS lon_max, MIN(lat) AS lat_min, MAX(lat) AS lat_max, MIN(obs_time) AS obs_time_min, MAX(obs_time) AS obs_time_max, COUNT(*) AS n FROM obs GROUP BY 1,2", "obs",
)
R.add("f1_lon_normalise", lambda s, d: view(s, d, "obs").select("obs_id", F.round(lon_to_180(F.col("lon") * 3), 6).alias("lon")), "SELECT obs_id, ROUND((((lon*3+180) % 360)+360)%360 - 180, 6) AS lon FROM obs", "obs")
R.add(
    "f11_region_counts", lambda s, d: g.with_cells(view(s, d, "obs"), 10.0).groupBy("region_id", season(F.col("obs_date")).alias("season")).agg(F.count(F.lit(1)).alias("n")),
    f"SELECT {_REGION} AS region_id, CASE WHEN MONTH(obs_date) IN (12,1,2) THEN 'DJF' WHEN MONTH(obs_date) < 6 THEN 'MAM' WHEN MONTH(obs_date) < 9 THEN 'JJA' ELSE 'SON' END AS season, COUNT(*) AS n FROM obs GROUP BY 1,2", "obs",
)
R.add(
    "c7_haversine", lambda s, d: view(s, d, "obs").select("obs_id", F.round(haversine_km(F.col("lon"), F.col("lat"), F.lit(-30.0), F.lit(40.0)), 6).alias("km")),
    """SELECT obs_id, ROUND(12742*ATAN2(SQRT(a), SQRT(1-a)), 6) AS km FROM (SELECT obs_id, POW(SIN(RADIANS(40-lat)/2), 2) + COS(RADIANS(lat))*COS(RADIANS(40))*POW(SIN(RADIANS(-30-lon)/2), 2) AS a FROM obs)""", "obs",
)

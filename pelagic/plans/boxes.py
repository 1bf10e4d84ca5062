"""Queries over boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import region_boxes
from ..fixtures import land_mask, view
from ..functions.geo import BBox, box_iou, clip_to_box, in_box, patch_degrees
from ..operators import boxes as b
from ..operators import scans as sc
from .common import Registry, rounded, written

R = Registry()
_BOX = BBox(-80.0, -40.0, 10.0, 50.0)
_IOU = """(GREATEST(0, LEAST(a.lon_max, b.lon_max) - GREATEST(a.lon_min, b.lon_min)) * GREATEST(0, LEAST(a.lat_max, b.lat_max) - GREATEST(a.lat_min, b.lat_min)))"""
_AREA = "((a.lon_max-a.lon_min)*(a.lat_max-a.lat_min) + (b.lon_max-b.lon_min)*(b.lat_max-b.lat_min))"
IOU_PAIRS = f"""SELECT a.query_id AS a, b.query_id AS b, {_IOU} / ({_AREA} - {_IOU}) AS iou FROM boxes a JOIN boxes b ON a.query_id < b.query_id
 AND a.date_start <= b.date_end AND b.date_start <= a.date_end AND a.lon_min < b.lon_max AND b.lon_min < a.lon_max AND a.lat_min < b.lat_max AND b.lat_min < a.lat_max"""
FRACTION = """windows AS (SELECT *, CASE WHEN n > 0 AND e > 0 THEN (n-1)*1440 + e-1 END AS ne, CASE WHEN n > 0 AND w > 0 THEN (n-1)*1440 + w-1 END AS nw, CASE WHEN s > 0 AND e > 0 THEN (s-1)*1440 + e-1 END AS se, CASE WHEN s > 0 AND w > 0 THEN (s-1)*1440 + w-1 END AS sw FROM (SELECT *, GREATEST(0, LEAST(1440, FLOOR((lon_min+180)/0.25)))::INT AS w, GREATEST(0, LEAST(1440, FLOOR((lon_max+180)/0.25)+1))::INT AS e,
 GREATEST(0, LEAST(720, FLOOR((lat_min+90)/0.25)))::INT AS s, GREATEST(0, LEAST(720, FLOOR((lat_max+90)/0.25)+1))::INT AS n FROM boxes)),
 sums AS MATERIALIZED (SELECT i*1440 + j AS corner, SUM(row_sum) OVER (PARTITION BY j ORDER BY i) AS land FROM (SELECT i, j, SUM(is_land::INT) OVER (PARTITION BY i ORDER BY j) AS row_sum FROM land)),
 fractions AS (SELECT q.*, CASE WHEN (e-w)*(n-s) > 0 THEN (COALESCE(p1.land,0) - COALESCE(p2.land,0) - COALESCE(p3.land,0) + COALESCE(p4.land,0))::DOUBLE / ((e-w)*(n-s)) ELSE 0 END AS land_fraction FROM windows q
 LEFT JOIN sums p1 ON p1.corner = ne LEFT JOIN sums p2 ON p2.corner = nw LEFT JOIN sums p3 ON p3.corner = se LEFT JOIN sums p4 ON p4.corner = sw)"""


def _boxes(spark, sf):
    return view(spark, sf, "boxes")


def _with_land(spark, sf):
    return b.land_fraction(_boxes(spark, sf), b.land_prefix_sums(land_mask(spark)))


R.add("f3_points_in_box", lambda s, d: view(s, d, "obs").where(in_box(F.col("lon"), F.col("lat"), _BOX)), "SELECT * FROM obs WHERE lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50", "obs")
R.add(
    "f5_box_across_dateline", lambda s, d: view(s, d, "obs").where(in_box(F.col("lon"), F.col("lat"), BBox(170.0, -160.0, -30.0, 30.0))).select("obs_id", *[c.alias(n) for c, n in zip(clip_to_box(F.col("lon"), F.col("lat"), BBox(170.0, -160.0, -30.0, 30.0)), ("lon", "lat"))]),
    "SELECT obs_id, lon, lat FROM obs WHERE (lon >= 170 OR lon <= -160) AND lat BETWEEN -30 AND 30", "obs",
)
R.add(
    "f6_swath_lines_in_box",
    lambda s, d: sc.swath_lines(view(s, d, "obs"), in_box(F.col("lon"), F.col("lat"), _BOX)).select("track_id", "obs_id", "val"),
    """SELECT o.track_id, obs_id, CASE WHEN lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50 THEN val END AS val FROM obs o JOIN (SELECT track_id, MIN(obs_id) AS lo, MAX(obs_id) AS hi FROM obs WHERE lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50 GROUP BY 1) r
 ON o.track_id = r.track_id AND obs_id BETWEEN lo AND hi""", "obs",
)
R.add(
    "f7_split_at_dateline", lambda s, d: rounded(b.split_at_dateline(_boxes(s, d).withColumns({"lon_min": F.col("lon_max"), "lon_max": F.col("lon_min")}).withColumns({"lon_min": F.when(F.col("query_id") % 2 == 0, F.col("lon_min")).otherwise(F.col("lon_max")), "lon_max": F.when(F.col("query_id") % 2 == 0, F.col("lon_max")).otherwise(F.col("lon_min"))}))),
    """SELECT query_id, CASE WHEN query_id % 2 = 1 THEN lon_min WHEN k = 0 THEN lon_max ELSE -180.0 END AS lon_min, CASE WHEN query_id % 2 = 1 THEN lon_max WHEN k = 0 THEN 180.0 ELSE lon_min END AS lon_max, lat_min, lat_max, date_start, date_end FROM boxes, (VALUES (0), (1)) AS t(k) WHERE query_id % 2 = 0 OR k = 0""", "boxes",
)
R.add("f8_boxes_touching", lambda s, d: b.touches(_boxes(s, d), BBox(175.0, -170.0, -20.0, 40.0)).select("query_id"), "SELECT query_id FROM boxes WHERE (lon_max >= 175 OR lon_min <= -170) AND lat_min <= 40 AND lat_max >= -20", "boxes")
R.add(
    "f12_regions_of_boxes", lambda s, d: b.regions_of_boxes(_boxes(s, d), region_boxes(s)).select("query_id", "region_id"),
    "SELECT query_id, CAST(r AS INT) AS region_id FROM boxes, range(8) AS t(r) WHERE lat_max > (r // 4)*90 - 90 AND lat_min < (r // 4)*90 AND lon_max > (r % 4)*90 - 180 AND lon_min < (r % 4)*90 - 90", "boxes",
)
R.add(
    "j2_boxes_points", lambda s, d: b.boxes_points(_boxes(s, d), view(s, d, "obs")).select("query_id", "obs_id", "obs_date", "val"),
    "SELECT query_id, obs_id, obs_date, val FROM boxes JOIN obs ON obs_date BETWEEN date_start AND date_end AND lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max", "boxes", "obs",
)
R.add(
    "j2_adaptive_tiles", lambda s, d: b.boxes_points_adaptive(_boxes(s, d), view(s, d, "obs"), 3, 3).select("query_id", "obs_id", "obs_date", "val"),
    "SELECT query_id, obs_id, obs_date, val FROM boxes JOIN obs ON obs_date BETWEEN date_start AND date_end AND lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max", "boxes", "obs",
)
R.add("j12_overlapping_boxes", lambda s, d: b.overlapping_boxes(_boxes(s, d), 0.0, 6), f"SELECT a, b, ROUND(iou, 6) AS iou FROM ({IOU_PAIRS}) WHERE iou > 0", "boxes")
R.add("j15_land_fraction", lambda s, d: rounded(_with_land(s, d).select("query_id", "land_fraction")), f"WITH {FRACTION} SELECT query_id, ROUND(land_fraction, 6) AS land_fraction FROM fractions", "boxes", "land")
R.add("g4_ocean_boxes", lambda s, d: _with_land(s, d).where("land_fraction <= 0.3").select("query_id"), f"WITH {FRACTION} SELECT query_id FROM fractions WHERE land_fraction <= 0.3", "boxes", "land")
R.add(
    "a46_box_summary", lambda s, d: rounded(b.box_summary(_with_land(s, d), 0.3)),
    f"WITH {FRACTION} SELECT COUNT(*) AS n, COUNT(DISTINCT date_start) AS n_days, ROUND(AVG(lon_max-lon_min), 6) AS mean_width, ROUND(AVG(lat_max-lat_min), 6) AS mean_height, ROUND(AVG(land_fraction), 6) AS mean_land, ROUND(AVG((land_fraction > 0.3)::INT), 6) AS share_above FROM fractions", "boxes", "land",
)
for axis, low, high, bins in (("lon", -180, 180, 36), ("lat", -90, 90, 18)):
    R.add(
        f"a47_histogram_{axis}", lambda s, d, axis=axis, low=low, high=high, bins=bins: b.histogram(_boxes(s, d), f"{axis}_min", float(low), float(high), bins),
        f"SELECT LEAST({bins - 1}, GREATEST(0, CAST(FLOOR(({axis}_min - {low}) / 10.0) AS INT))) AS bin, COUNT(*) AS n FROM boxes GROUP BY 1", "boxes",
    )
R.add(
    "c23_resized_boxes", lambda s, d: rounded(b.resized(_boxes(s, d), 24.0, 16.0, 5)),
    """SELECT query_id, ROUND(GREATEST(-180, (lon_min+lon_max)/2 - 12), 6) AS lon_min, ROUND(LEAST(180, (lon_min+lon_max)/2 + 12), 6) AS lon_max, ROUND(GREATEST(-90, (lat_min+lat_max)/2 - 8), 6) AS lat_min, ROUND(LEAST(90, (lat_min+lat_max)/2 + 8), 6) AS lat_max, date_start, date_start + 4 AS date_end FROM boxes""", "boxes",
)
R.add(
    "c1_patch_degrees", lambda s, d: _boxes(s, d).select("query_id", *[F.round(x, 6).alias(n) for x, n in zip(patch_degrees(F.lit(200.0), "km", F.col("lat_min")), ("width", "height"))]),
    "SELECT query_id, ROUND(200 / (111.0 * GREATEST(COS(RADIANS(lat_min)), 0.1)), 6) AS width, ROUND(200 / 111.0, 6) AS height FROM boxes", "boxes",
)
DRAW = "('0x' || SUBSTR(MD5('42|{}|' || c_custkey), 1, 13))::BIGINT / 4503599627370496.0"
_CANDIDATES = f"""drawn AS (SELECT c_custkey AS query_id, -80 + {DRAW.format('lon')} * 40 AS x, 10 + {DRAW.format('lat')} * 40 AS y, CAST(FLOOR({DRAW.format('day')} * 29) AS INT) AS k FROM customer),
 boxes AS (SELECT query_id, GREATEST(-180, x-4) AS lon_min, LEAST(180, x+4) AS lon_max, GREATEST(-90, y-4) AS lat_min, LEAST(90, y+4) AS lat_max, CAST(DATE '2024-06-01' + k AS DATE) AS date_start, CAST(DATE '2024-06-01' + k + 1 AS DATE) AS date_end FROM drawn)"""


def _candidates(spark, sf):
    ids = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("query_id"))
    return b.candidate_boxes(ids, _BOX, 8.0, "deg", "2024-06-01", 30, 2, 42)


R.add("g1_candidate_boxes", lambda s, d: rounded(_candidates(s, d)), f"WITH {_CANDIDATES} SELECT query_id, ROUND(lon_min, 6) AS lon_min, ROUND(lon_max, 6) AS lon_max, ROUND(lat_min, 6) AS lat_min, ROUND(lat_max, 6) AS lat_max, date_start, date_end FROM boxes")


def _greedy(spark, sf):
    return rounded(b.greedy_boxes(_candidates(spark, sf), 0.3, written(spark)))


R.add(
    "g3_greedy_boxes", _greedy,
    f"""WITH RECURSIVE {_CANDIDATES}, conflicts AS MATERIALIZED (SELECT a, b FROM ({IOU_PAIRS}) WHERE iou > 0.3), turns AS MATERIALIZED (SELECT query_id, ROW_NUMBER() OVER (ORDER BY query_id) AS k, COALESCE(earlier, []) AS earlier FROM (SELECT a AS query_id FROM conflicts UNION SELECT b FROM conflicts) LEFT JOIN (SELECT b AS query_id, LIST(a) AS earlier FROM conflicts GROUP BY 1) USING (query_id)),
 walk(k, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT t.k, CASE WHEN LIST_HAS_ANY(earlier, kept) THEN kept ELSE LIST_APPEND(kept, query_id) END FROM walk JOIN turns t ON t.k = walk.k + 1)
 SELECT query_id, ROUND(lon_min, 6) AS lon_min, ROUND(lon_max, 6) AS lon_max, ROUND(lat_min, 6) AS lat_min, ROUND(lat_max, 6) AS lat_max, date_start, date_end FROM boxes WHERE query_id NOT IN (SELECT query_id FROM turns) OR LIST_CONTAINS((SELECT ARG_MAX(kept, k) FROM walk), query_id)""",
)
R.add(
    "g2_evaluation_grid_points",
    lambda s, d: b.boxes_points(b.evaluation_grid(s, BBox(-180.0, 180.0, -60.0, 60.0), 20.0, 0.25, "2024-01-01", 30, 7, 3), view(s, d, "obs")).groupBy("lon_min", "lat_min", "date_start").agg(F.count(F.lit(1)).alias("n")),
    """WITH lons AS (SELECT -180 + 15.0*k AS lon_min FROM range(0, 23) AS t(k) UNION ALL SELECT 160.0), lats AS (SELECT -60 + 15.0*k AS lat_min FROM range(0, 7) AS t(k) UNION ALL SELECT 40.0),
 days AS (SELECT CAST(DATE '2024-01-01' + CAST(7*k AS INT) AS DATE) AS date_start FROM range(0, 4) AS t(k))
 SELECT lon_min, lat_min, date_start, COUNT(*) AS n FROM lons, lats, days JOIN obs ON obs_date BETWEEN date_start AND date_start + 2 AND lon BETWEEN lon_min AND lon_min + 20 AND lat BETWEEN lat_min AND lat_min + 20 GROUP BY 1,2,3""", "obs",
)
R.add(
    "r13_mask_from_edges",
    lambda s, d: b.mask_from_edges(
        _boxes(s, d).select(F.explode(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(e, ("x1", "y1", "x2", "y2"))]) for e in (("lon_min", "lat_min", "lon_max", "lat_min"), ("lon_max", "lat_min", "lon_max", "lat_max"), ("lon_max", "lat_max", "lon_min", "lat_max"), ("lon_min", "lat_max", "lon_min", "lat_min"))])).alias("e")).select("e.*"),
        s.range(1440 * 720).select(F.floor(F.col("id") / 1440).cast("int").alias("row"), (F.col("id") % 1440).cast("int").alias("col"), (-180 + (F.col("id") % 1440 + 0.5) * 0.25).alias("lon")),
    ).groupBy("row").agg(F.count_if("is_land").alias("n_land")),
    """WITH steps AS (SELECT row, col, SUM(n) AS n FROM (SELECT CAST(r AS INT) AS row, CAST(CASE k WHEN 1 THEN CEIL((lon_min+180)/0.25 - 0.5) ELSE CEIL((lon_max+180)/0.25 - 0.5) END AS INT) AS col, k AS n FROM boxes, range(720) AS t(r), (VALUES (1), (-1)) AS u(k)
 WHERE -90 + (r + 0.5)*0.25 >= lat_min AND -90 + (r + 0.5)*0.25 < lat_max) GROUP BY 1, 2)
 SELECT CAST(range // 1440 AS INT) AS row, COUNT(*) FILTER (WHERE inside % 2 = 1) AS n_land FROM (SELECT range, SUM(COALESCE(n, 0)) OVER (PARTITION BY range // 1440 ORDER BY range % 1440) AS inside FROM range(1036800) LEFT JOIN steps ON row = range // 1440 AND col = range % 1440) GROUP BY 1""", "boxes",
)
R.add(
    "c8_box_iou", lambda s, d: rounded(_boxes(s, d).select("query_id", *[F.col(c).alias(f"a_{c}") for c in ("lon_min", "lon_max", "lat_min", "lat_max")], F.lit(-80.0).alias("b_lon_min"), F.lit(-40.0).alias("b_lon_max"), F.lit(10.0).alias("b_lat_min"), F.lit(50.0).alias("b_lat_max")).select("query_id", box_iou("a_", "b_").alias("iou"))),
    f"SELECT query_id, ROUND({_IOU} / ({_AREA} - {_IOU}), 6) AS iou FROM boxes a, (SELECT -80.0 AS lon_min, -40.0 AS lon_max, 10.0 AS lat_min, 50.0 AS lat_max) b", "boxes",
)

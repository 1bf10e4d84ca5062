"""Queries over whole products: gridding of tracks, loading, names, storage comparison, boxes for training and evaluation."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from ..dims import VARIABLES, region_boxes
from ..fixtures import land_mask, view
from ..functions import codec, geo
from ..operators import boxes as b
from ..operators import gridding as g
from ..operators import scans as sc
from ..operators import statistics as st
from ..sources.tables import save_bucketed
from .boxes import DRAW, FRACTION, IOU_PAIRS
from .common import Registry, rounded, written

R = Registry()
_BOX = geo.BBox(-80.0, -40.0, 10.0, 50.0)
_CELL = "CAST(FLOOR((lon+180)/10) AS INT) AS i, CAST(FLOOR((lat+90)/10) AS INT) AS j"
_REGION = "CAST(FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90) AS INT)"


def _grid_each(s, d):
    with warnings.catch_warnings():  # ten degrees are coarse on purpose
        warnings.simplefilter("ignore")
        return g.grid_each_track(view(s, d, "obs"), 10.0, 2.0)


def _altimetry(s, d):
    return view(s, d, "obs").select("*", F.when(F.col("obs_id") % 3 != 0, F.col("val")).alias("sla_filtered"), (F.col("val") / 2).alias("sla"), F.concat(F.lit("p"), F.col("track_id") % 3).alias("platform")).drop("val")


R.add("a2_grid_each_track", lambda s, d: rounded(_grid_each(s, d)), f"SELECT obs_date, track_id, {_REGION} AS region_id, {_CELL}, ROUND(AVG(val), 6) AS value, COUNT(val) AS n_obs FROM obs WHERE val IS NOT NULL GROUP BY ALL", "obs")
R.add(
    "a4_grid_altimetry", lambda s, d: rounded(g.grid_altimetry(_altimetry(s, d), 10.0)),
    f"""WITH own AS (SELECT * REPLACE (CASE WHEN obs_id % 3 <> 0 THEN val ELSE val/2 END AS val), 'p' || (track_id % 3) AS platform FROM obs WHERE val IS NOT NULL), idx AS (SELECT obs_date, track_id, CAST(DENSE_RANK() OVER (PARTITION BY obs_date ORDER BY track_id) - 1 AS INT) AS track_idx FROM (SELECT DISTINCT obs_date, track_id FROM own))
 SELECT obs_date, {_REGION} AS region_id, {_CELL}, ROUND(AVG(val), 6) AS value, COUNT(val) AS n_obs, MIN(track_idx) AS primary_track, COUNT(DISTINCT track_id) > 1 AS is_overlap, STRING_AGG(DISTINCT platform, ', ' ORDER BY platform) AS platforms FROM own JOIN idx USING (obs_date, track_id) GROUP BY 1,2,3,4""", "obs",
)
R.add(
    "a10_daily_wind", lambda s, d: rounded(g.daily_mean_complete(g.with_cells(view(s, d, "obs"), 10.0).withColumn("v", F.col("val") * F.col("track_id")), 24, also=("v",), done=view(s, d, "cells").where("product = 'glorys'").select(F.date_add("obs_date", 20).alias("obs_date")))),
    f"""WITH full_days AS (SELECT obs_date FROM obs GROUP BY 1 HAVING COUNT(DISTINCT HOUR(obs_time)) >= 24) SELECT obs_date, {_CELL}, ROUND(AVG(val), 6) AS value, ROUND(AVG(val*track_id), 6) AS v, COUNT(val) AS n FROM obs JOIN full_days USING (obs_date)
 WHERE obs_date NOT IN (SELECT obs_date + 20 FROM cells WHERE product = 'glorys') GROUP BY 1,2,3""", "obs", "cells",
)


def _grid_cells(s, d):
    return view(s, d, "cells").withColumns({"lon": F.col("i") * 10 - 175.0, "lat": F.col("j") * 10 - 85.0, "region_id": (F.floor(F.col("i") / 9) + 4 * F.floor(F.col("j") / 9)).cast("int")})


_CELLS = "c AS (SELECT *, i*10 - 175.0 AS lon, j*10 - 85.0 AS lat, i // 9 + 4 * (j // 9) AS region_id FROM cells)"
R.add(
    "s7_load_box_merged", lambda s, d: rounded(sc.load_box_merged(_grid_cells(s, d), "2024-01-10", geo.BBox(-100, 20, -10, 30), "l4_ssh", 20.0)),
    f"WITH {_CELLS} SELECT obs_date, CAST(LEAST(5, FLOOR((lon+100)/20)) AS INT) AS ti, CAST(LEAST(1, FLOOR((lat+10)/20)) AS INT) AS tj, ROUND(AVG(val), 6) AS value, COUNT(val) AS n FROM c WHERE obs_date = DATE '2024-01-10' AND product = 'l4_ssh' AND lon BETWEEN -100 AND 20 AND lat BETWEEN -10 AND 30 GROUP BY 1,2,3", "cells",
)
R.add(
    "s8_load_swath", lambda s, d: sc.load_swath(view(s, d, "obs"), {"obs_id": ("time",), "track_id": ("track",), "obs_date": ("time",), "obs_time": ("time", "line"), "lon": ("lat", "lon"), "lat": ("lat", "lon"), "val": ("time", "lat", "lon")}, _BOX),
    "SELECT obs_id, obs_date, lon, lat, val FROM obs WHERE lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50", "obs",
)


def _files(s, d):
    """File paths of three products, each with dates of its own kind in the name."""
    date = F.col("obs_date")
    path = F.when(F.col("source_id") == 0, F.concat(F.lit("a/ssh_"), F.date_format(date, "yyyyMMdd"), F.lit("_v1.nc"))).when(F.col("source_id") == 1, F.concat(F.lit("b/wind."), F.date_format(date, "yyyy-MM-dd"), F.lit(".nc"))).otherwise(F.concat(F.lit("c/other_"), F.date_format(date, "yyyyDDD"), F.lit(".nc")))
    files = view(s, d, "tiles").select("file_id", F.when(F.col("source_id") < 2, F.concat(F.lit("p"), "source_id")).otherwise("p2").alias("product"), path.alias("path"))
    patterns = s.sql(r"SELECT * FROM VALUES ('p0', '_(\\d{8})_v\\d+\\.nc$', 'yyyyMMdd'), ('p1', '\\.(\\d{4}-\\d{2}-\\d{2})\\.nc$', 'yyyy-MM-dd'), ('p2', '_(\\d{8})\\.nc$', 'yyyyMMdd') AS t(product, pattern, date_format)")
    days = view(s, d, "boxes").select(F.explode(F.sequence("date_start", "date_end", F.expr("INTERVAL 1 DAY"))).alias("obs_date")).distinct()
    return sc.dated_files(files, patterns).join(days, "obs_date", "left_semi").select("file_id", "product", "path", "obs_date")


R.add(
    "s13_dated_files", _files,
    """SELECT file_id, 'p' || source_id AS product, CASE source_id WHEN 0 THEN 'a/ssh_' || STRFTIME(obs_date, '%Y%m%d') || '_v1.nc' ELSE 'b/wind.' || STRFTIME(obs_date, '%Y-%m-%d') || '.nc' END AS path, obs_date FROM tiles
 WHERE source_id < 2 AND obs_date IN (SELECT CAST(UNNEST(GENERATE_SERIES(date_start, date_end, INTERVAL 1 DAY)) AS DATE) FROM boxes)""", "tiles", "boxes",
)


def _geometry(s, d):
    box = F.concat(F.lit("POLYGON(("), *[x for k, (lon, lat) in enumerate((("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max"), ("lon_min", "lat_min"))) for x in (F.lit("," if k else ""), F.col(lon), F.lit(" "), F.col(lat))], F.lit("))"))
    point = F.concat(F.lit("POINT("), F.col("lon_min"), F.lit(" "), F.col("lat_min"), F.lit(")"))
    kind = F.col("query_id") % 4
    texts = view(s, d, "boxes").select("query_id", F.when(kind == 0, box).when(kind == 1, "None").when(kind == 2, "").alias("footprint"), F.when(kind < 3, point).alias("centroid"))
    return b.bounding_boxes(texts).select("query_id", "lon_min", "lon_max", "lat_min", "lat_max")


R.add("f9_bounding_boxes", lambda s, d: rounded(_geometry(s, d)), "SELECT query_id, " + ", ".join(f"ROUND(CASE WHEN query_id % 4 = 0 THEN {a}_{e} WHEN query_id % 4 < 3 THEN {a}_min END, 6) AS {a}_{e}" for a in ("lon", "lat") for e in ("min", "max")) + " FROM boxes", "boxes")


def _offset_cells(s, d):
    warm = F.col("obs_date") < F.lit("2024-01-16").cast("date")
    return view(s, d, "cells").select("obs_date", "i", "j", F.when(F.col("product") == "glorys", "thetao").otherwise("analysed_sst").alias("variable"), F.when(warm, F.col("val") + 273.15).otherwise(F.col("val")).alias("val"))


R.add(
    "f20_unit_offsets", lambda s, d: rounded(sc.with_unit_offsets(_offset_cells(s, d), {v: o for _, _, v, _, o in VARIABLES if o}), 9),
    "SELECT obs_date, i, j, CASE WHEN product = 'glorys' THEN 'thetao' ELSE 'analysed_sst' END AS variable, ROUND(CASE WHEN obs_date >= DATE '2024-01-16' THEN val WHEN product = 'glorys' THEN val + 273.15 ELSE (val + 273.15) - 273.15 END, 9) AS val FROM cells", "cells",
)
R.add(
    "f15_first_of", lambda s, d: rounded(sc.first_of(_offset_cells(s, d).where("NOT (variable = 'analysed_sst' AND i % 2 = 0)"), ["analysed_sst", "thetao"], ("obs_date", "i", "j")), 9),
    """SELECT obs_date, i, j, variable, ROUND(val, 9) AS val FROM (SELECT obs_date, i, j, CASE WHEN product = 'glorys' THEN 'thetao' ELSE 'analysed_sst' END AS variable, CASE WHEN obs_date < DATE '2024-01-16' THEN val + 273.15 ELSE val END AS val,
 ROW_NUMBER() OVER (PARTITION BY obs_date, i, j ORDER BY CASE WHEN product = 'glorys' THEN 2 ELSE 1 END) AS r FROM cells WHERE product = 'glorys' OR i % 2 = 1) WHERE r = 1""", "cells",
)
_ALIASES = {"ssh": ["l4_ssh", "l3_ssh"], "all": ["l4_ssh", "l4_sst", "argo"]}
R.add(
    "c22_expanded_aliases", lambda s, d: view(s, d, "tiles").select("file_id", F.array_join(sc.expanded_aliases(F.array(F.when(F.col("file_id") % 2 == 0, " ssh ,argo").otherwise("argo,,x"), F.when(F.col("source_id") < 3, "all").otherwise("l3_ssh")), _ALIASES), " ").alias("names")),
    "SELECT file_id, CASE WHEN file_id % 2 = 0 THEN CASE WHEN source_id < 3 THEN 'l4_ssh l3_ssh argo l4_sst' ELSE 'l4_ssh l3_ssh argo' END ELSE CASE WHEN source_id < 3 THEN 'argo x l4_ssh l4_sst' ELSE 'argo x l3_ssh' END END AS names FROM tiles", "tiles",
)
_E2 = f"(1 - POW({geo.WGS84_B}/{geo.WGS84_A}, 2))"
R.add(
    "c3_regional_grid_cells", lambda s, d: geo.on_regional_grid(view(s, d, "obs"), geo.grid_specs(region_boxes(s), 700.0, "centres")).groupBy("region_id", "gi", "gj").agg(F.count(F.lit(1)).alias("n")),
    f"""WITH specs AS (SELECT r AS region_id, (r % 4)*90 - 180 AS w, (r // 4)*90 - 90 AS s, 700 / (PI()/180*{geo.WGS84_A} / SQRT(1 - {_E2}*POW(SIN(RADIANS((r // 4)*90 - 45)), 2)) * COS(RADIANS((r // 4)*90 - 45))) AS dx, 700 / (PI()/180*{geo.WGS84_A}*(1 - {_E2}) / POW(1 - {_E2}*POW(SIN(RADIANS((r // 4)*90 - 45)), 2), 1.5)) AS dy FROM range(8) AS t(r))
 SELECT CAST(region_id AS INT) AS region_id, gi, gj, COUNT(*) AS n FROM (SELECT region_id, CAST(FLOOR((lon - w + dx/2)/dx) AS INT) AS gi, CAST(FLOOR((lat - s + dy/2)/dy) AS INT) AS gj, CEIL(90/dx) AS nx, CEIL(90/dy) AS ny FROM obs JOIN specs ON lon >= w AND lon < w + 90 AND lat >= s AND lat < s + 90) WHERE gi < nx AND gj < ny GROUP BY 1,2,3""", "obs",
)
R.add(
    "c3_whole_grid_cells", lambda s, d: geo.on_regional_grid(view(s, d, "obs"), geo.grid_specs(region_boxes(s), 700.0, "whole")).groupBy("region_id", "gi", "gj").agg(F.count(F.lit(1)).alias("n")),
    f"""WITH specs AS (SELECT r AS region_id, (r % 4)*90 - 180 AS w, (r // 4)*90 - 90 AS s, 700 / (PI()/180*{geo.WGS84_A} / SQRT(1 - {_E2}*POW(SIN(RADIANS((r // 4)*90 - 45)), 2)) * COS(RADIANS((r // 4)*90 - 45))) AS dx, 700 / (PI()/180*{geo.WGS84_A}*(1 - {_E2}) / POW(1 - {_E2}*POW(SIN(RADIANS((r // 4)*90 - 45)), 2), 1.5)) AS dy FROM range(8) AS t(r))
 SELECT CAST(region_id AS INT) AS region_id, gi, gj, COUNT(*) AS n FROM (SELECT region_id, CAST(FLOOR((lon - w)/dx) AS INT) AS gi, CAST(FLOOR((lat - s)/dy) AS INT) AS gj, CEIL(90/dx) AS nx, CEIL(90/dy) AS ny FROM obs JOIN specs ON lon >= w AND lon < w + 90 AND lat >= s AND lat < s + 90) WHERE gi < nx AND gj < ny GROUP BY 1,2,3""", "obs",
)


def _formatted(s, d):
    """Tiles of a product as it was formatted, before storage."""
    raw = _grid_cells(s, d).withColumns({"variable": F.when(F.col("product") == "glorys", "thetao").otherwise("sla"), "val": F.col("val") * 300})
    return st.pre_encoding_reference(raw, ("thetao", "sla")).withColumn("source", F.col("product"))


def _stored(s, d):
    """The same through the packed form, by each variable's own rule."""
    rule = codec.codec(F.col("variable"))
    d = _formatted(s, d).withColumns({"scale": rule["scale"], "offset": rule["offset"], "fill": rule["fill"]})
    p = F.coalesce(F.rint((F.round("val", 9) - F.col("offset")) / F.col("scale")).cast("int"), F.col("fill"))
    return d.withColumn("val", F.when(p != F.col("fill"), p * F.col("scale") + F.col("offset")))


_FORMATTED = f"""{_CELLS}, formatted AS (SELECT obs_date, region_id, product AS source, CASE WHEN product = 'glorys' THEN 'thetao' ELSE 'sla' END AS variable, i, j,
 CASE WHEN product = 'glorys' AND AVG(val*300) OVER (PARTITION BY product, obs_date) > 200 THEN val*300 - 273.15 ELSE val*300 END AS orig FROM c)"""
_COMPARED = f"{_FORMATTED}, compared AS (SELECT *, CASE WHEN variable = 'thetao' THEN ROUND_EVEN((ROUND(orig, 9) - 20)/0.001, 0)*0.001 + 20 ELSE ROUND_EVEN(ROUND(orig, 9)/0.0005, 0)*0.0005 END AS packed FROM formatted)"
R.add("a51_reference_tiles", lambda s, d: rounded(_formatted(s, d).select("obs_date", "region_id", "source", "variable", "i", "j", "val")), f"WITH {_FORMATTED} SELECT obs_date, region_id, source, variable, i, j, ROUND(orig, 6) AS val FROM formatted", "cells")
R.add("j11_compared_tiles", lambda s, d: rounded(st.compared_tiles(_formatted(s, d), _stored(s, d)), 9), f"WITH {_COMPARED} SELECT obs_date, region_id, source, variable, i, j, ROUND(orig, 9) AS orig, ROUND(packed, 9) AS packed FROM compared", "cells")
R.add("j11_stored_tiles", lambda s, d: rounded(st.compared_tiles(*[save_bucketed(x.select("obs_date", "region_id", "source", "variable", "i", "j", "val"), st.TILE_KEYS, 8) for x in (_formatted(s, d), _stored(s, d))]), 9), f"WITH {_COMPARED} SELECT obs_date, region_id, source, variable, i, j, ROUND(orig, 9) AS orig, ROUND(packed, 9) AS packed FROM compared", "cells")



def _raw_tracks(s, d):
    """Tracks whose filtered values are there (of one third), or raw ones instead, or only those of a third name."""
    third = F.col("track_id") % 3
    return view(s, d, "obs").select("obs_date", "track_id", "obs_id", "lon", "lat", F.when(third == 0, F.col("val")).alias("sla_filtered"), F.when(third < 2, F.col("val") / 2).alias("sla"), (F.col("val") / 4).alias("ssha"))


R.add(
    "a51_reference_tracks", lambda s, d: rounded(st.pre_encoding_reference(_raw_tracks(s, d), step=10.0), 9),
    f"""WITH own AS (SELECT obs_date, track_id, {_REGION} AS region_id, {_CELL}, AVG(val / CASE track_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS value FROM obs WHERE val IS NOT NULL GROUP BY ALL)
 SELECT obs_date, region_id, 'sla_filtered' AS variable, i, j, ROUND(AVG(value), 9) AS val, COUNT(*) AS n_tracks FROM own GROUP BY ALL""", "obs",
)


def _sums(s):
    return b.land_prefix_sums(land_mask(s))


def _training(s, d):
    ids = s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("query_id"))
    return b.training_boxes(ids, _BOX, 8.0, "deg", "2024-06-01", 30, 2, 42, _sums(s), 200, written(s), 0.3, 0.3)


R.add(
    "g1_training_boxes", lambda s, d: rounded(_training(s, d).drop("c_lon", "c_lat", "day")),
    f"""WITH RECURSIVE drawn AS (SELECT c_custkey AS query_id, -80 + {DRAW.format('lon')} * 40 AS x, 10 + {DRAW.format('lat')} * 40 AS y, CAST(FLOOR({DRAW.format('day')} * 29) AS INT) AS k FROM customer),
 candidates AS (SELECT query_id, GREATEST(-180, x-4) AS lon_min, LEAST(180, x+4) AS lon_max, GREATEST(-90, y-4) AS lat_min, LEAST(90, y+4) AS lat_max, CAST(DATE '2024-06-01' + k AS DATE) AS date_start, CAST(DATE '2024-06-01' + k + 1 AS DATE) AS date_end FROM drawn),
 {FRACTION.replace('FROM boxes)', 'FROM candidates)')}, boxes AS MATERIALIZED (SELECT query_id, lon_min, lon_max, lat_min, lat_max, date_start, date_end, land_fraction FROM fractions WHERE land_fraction <= 0.3),
 conflicts AS MATERIALIZED (SELECT a, b FROM ({IOU_PAIRS}) WHERE iou > 0.3), turns AS MATERIALIZED (SELECT query_id, ROW_NUMBER() OVER (ORDER BY query_id) AS k, COALESCE(earlier, []) AS earlier FROM (SELECT a AS query_id FROM conflicts UNION SELECT b FROM conflicts) LEFT JOIN (SELECT b AS query_id, LIST(a) AS earlier FROM conflicts GROUP BY 1) USING (query_id)),
 walk(k, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT t.k, CASE WHEN LIST_HAS_ANY(earlier, kept) THEN kept ELSE LIST_APPEND(kept, query_id) END FROM walk JOIN turns t ON t.k = walk.k + 1)
 SELECT query_id, ROUND(lon_min, 6) AS lon_min, ROUND(lon_max, 6) AS lon_max, ROUND(lat_min, 6) AS lat_min, ROUND(lat_max, 6) AS lat_max, date_start, date_end, ROUND(land_fraction, 6) AS land_fraction
 FROM boxes WHERE query_id NOT IN (SELECT query_id FROM turns) OR LIST_CONTAINS((SELECT ARG_MAX(kept, k) FROM walk), query_id) ORDER BY query_id LIMIT 200""", "land",
)


def _evaluation(s, d):
    """Observations in the boxes of an evaluation grid."""
    grid = b.evaluation_boxes(s, geo.BBox(-180.0, 180.0, -60.0, 60.0), 2000.0, "km", 0.25, "2024-01-01", 30, 7, 3, _sums(s), 0.3)
    return b.boxes_points(grid, view(s, d, "obs")).groupBy("date_start", "lon_min", "lon_max", "lat_min", "land_fraction").agg(F.count(F.lit(1)).alias("n"))


_SIZE = 2000.0 / 111.0
R.add(
    "g2_evaluation_boxes", lambda s, d: rounded(_evaluation(s, d)),
    f"""WITH lons AS (SELECT -180 + {_SIZE}*0.75*k AS lon_min FROM range(26) AS t(k) UNION ALL SELECT 180 - {_SIZE}), lats AS (SELECT -60 + {_SIZE}*0.75*k AS lat_min FROM range(8) AS t(k) UNION ALL SELECT 60 - {_SIZE}),
 boxes AS (SELECT lon_min, lon_min + 2000.0/(111.0*GREATEST(COS(RADIANS(lat_min + {_SIZE}/2)), 0.1)) AS lon_max, lat_min, lat_min + {_SIZE} AS lat_max, CAST(DATE '2024-01-01' + CAST(7*k AS INT) AS DATE) AS date_start FROM lons, lats, range(0, 4) AS t(k)), {FRACTION}
 SELECT date_start, ROUND(lon_min, 6) AS lon_min, ROUND(lon_max, 6) AS lon_max, ROUND(lat_min, 6) AS lat_min, ROUND(land_fraction, 6) AS land_fraction, COUNT(*) AS n FROM fractions JOIN obs ON obs_date BETWEEN date_start AND date_start + 2 AND lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max WHERE land_fraction <= 0.3 GROUP BY ALL""", "land", "obs",
)

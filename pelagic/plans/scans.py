"""Queries over scans, sinks and formatting."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..dims import region_boxes, source_token
from ..fixtures import view
from ..functions import geo
from ..functions.temporal import posix_range
from ..operators import boxes as b
from ..operators import catalog as c
from ..operators import samples as p
from ..operators import scans as sc
from ..sources import tables
from .common import Registry, rounded

R = Registry()
_BOX = geo.BBox(-80.0, -40.0, 10.0, 50.0)
_CELLS = "c AS (SELECT *, i*10 - 175.0 AS lon, j*10 - 85.0 AS lat, i // 9 + 4 * (j // 9) AS region_id FROM cells)"


def _cells(s, d):
    return view(s, d, "cells").withColumns({"lon": F.col("i") * 10 - 175.0, "lat": F.col("j") * 10 - 85.0, "region_id": (F.floor(F.col("i") / 9) + 4 * F.floor(F.col("j") / 9)).cast("int")})


def _folder(s):
    return f"{tables.shared_folder(s)}/{uuid4().hex}"


def _tiles_and_inventory(s, d):
    """Tiles written by source, date and region, read back, and their inventory derived."""
    path = _folder(s)
    tables.write_tiles(_cells(s, d).withColumnRenamed("product", "source"), path)
    return tables.inventory_of(s.read.parquet(path)).withColumns({"obs_date": F.col("obs_date").cast("date"), "region_id": F.col("region_id").cast("int")})


def _box_read(s, d):
    path = _folder(s)
    tables.write_swath(view(s, d, "obs"), path)
    return tables.read_box(s, path, _BOX, ["obs_id", "val"])


def _days(s, d):
    path = _folder(s)
    tables.write_days(view(s, d, "obs"), path)
    return s.read.parquet(path).select("obs_id", F.col("obs_date").cast("date").alias("obs_date"), "val")


def _product(s, d):
    """Two time steps a day and two levels, of which one each is formatted."""
    raw = _cells(s, d).withColumn("variable", F.when(F.col("product") == "glorys", "thetao").otherwise("mask")).withColumns({"lon": F.col("lon") + 360, "val": F.col("val") * 300})
    steps = F.explode(F.array(*[F.struct((F.col("obs_date").cast("timestamp") + F.expr(f"INTERVAL {h} HOURS")).alias("obs_time"), F.lit(k).alias("level_idx"), F.lit(float(f)).alias("factor")) for h, k, f in ((6, 0, 5.0), (6, 2, 1.0), (18, 2, 7.0))]))
    level_of = s.range(1).select(F.lit("thetao").alias("variable"), F.lit(2).alias("level_idx"))
    return sc.format_product(raw.withColumn("t", steps).select("*", "t.*").drop("t").withColumn("val", F.col("val") * F.col("factor")), ["thetao"], level_of)


def _query_set(s, d):
    path = _folder(s)
    tables.save_queries(view(s, d, "boxes"), path, {"made_by": "test"})
    boxes, facts = tables.load_queries(s, path)
    return boxes.join(F.broadcast(facts.select("n_queries")))


def _inventory(s, d):
    path = _folder(s)
    tables.write_inventory(view(s, d, "tiles"), path)
    return tables.read_inventory(s, path)


def _metrics(s, d):
    path = _folder(s)
    tables.write_metrics(view(s, d, "tiles").groupBy("source_id").agg(F.count(F.lit(1)).alias("n")), path)
    return s.read.option("header", True).schema("source_id int, n long").csv(path)


R.add("s1_s20_inventory", _inventory, "SELECT * FROM tiles", "tiles")
R.add("s5_crop", lambda s, d: rounded(sc.crop(_cells(s, d), _BOX, ["product", "obs_date", "i", "j", "val"]), 10), f"WITH {_CELLS} SELECT product, obs_date, i, j, ROUND(val, 10) AS val FROM c WHERE lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50", "cells")


def stored_tiles(s, d):
    """The cells in folders by product, date and region."""
    cells, path = _cells(s, d), f"{tables.shared_folder(s)}/tiles-{uuid4().hex}"
    tables.write_tiles(cells, path, ("product", "obs_date", "region_id"))
    return tables.read_tiles(s, path, cells.schema).select(*cells.columns)


def _listed(s, d):
    """Tiles of some sources in a week, by the catalog, on the product's regions and days."""
    return c.catalog_scan(view(s, d, "tiles"), "2024-01-08", "2024-01-12", [2, 3, 5])


def _dated_inventory(s, d):
    """The inventory as it was written, with the dates as text."""
    path = f"{tables.shared_folder(s)}/inventory-{uuid4().hex}"
    tables.write_inventory(view(s, d, "tiles"), path)
    return s.read.parquet(path).select("file_id", "date_str")


def _listed_files(s, d):
    """The files of the stored tiles, by product, date and region of their folders."""
    cells, path = _cells(s, d), f"{tables.shared_folder(s)}/tiles-{uuid4().hex}"
    tables.write_tiles(cells, path, ("product", "obs_date", "region_id"))
    found = tables.list_files(s, path, r"(\d{8})").select(*[F.regexp_extract("path", f"{c}=([^/]+)/", 1).alias(c) for c in ("product", "obs_date", "region_id")])
    return found.groupBy("product", F.col("obs_date").cast("date").alias("obs_date"), F.col("region_id").cast("int").alias("region_id")).agg((F.count(F.lit(1)) > 0).alias("has_files"))


R.add("s20_inventory_dates", _dated_inventory, "SELECT file_id, STRFTIME(obs_date, '%Y%m%d') AS date_str FROM tiles", "tiles")
R.add("s13_listed_files", _listed_files, f"WITH {_CELLS} SELECT DISTINCT product, obs_date, region_id, TRUE AS has_files FROM c", "cells")
R.add(
    "s10_timed_series", lambda s, d: rounded(sc.multi_source_series(view(s, d, "obs").withColumns({"product": F.concat(F.lit("p"), F.col("obs_id") % 2), "region_id": geo.region_id(F.col("lon"), F.col("lat")), "obs_time": F.when(F.col("obs_id") % 3 > 0, F.col("obs_time"))}), ["p1"], "2024-01-03", "2024-01-06", region=5).select("obs_id", "obs_time", "val"), 10),
    "SELECT obs_id, CASE WHEN obs_id % 3 > 0 THEN CAST(obs_time AS TIMESTAMP) ELSE CAST(obs_date AS TIMESTAMP) END AS obs_time, val FROM obs WHERE obs_id % 2 = 1 AND obs_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-06' AND FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90) = 5", "obs",
)
R.add("s3_stored_listing", lambda s, d: rounded(sc.load_listed(stored_tiles(s, d), _listed(s, d)), 10), f"WITH {_CELLS} SELECT * REPLACE (ROUND(val, 10) AS val) FROM c WHERE EXISTS (SELECT 1 FROM tiles t WHERE t.obs_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12' AND source_id IN (2, 3, 5) AND t.obs_date = c.obs_date AND t.region_id = c.region_id)", "cells", "tiles")
R.add("s6_stored_tile", lambda s, d: rounded(sc.load_tile(stored_tiles(s, d), "2024-01-10", 5, "glorys"), 10), f"WITH {_CELLS} SELECT * REPLACE (ROUND(val, 10) AS val) FROM c WHERE obs_date = DATE '2024-01-10' AND region_id = 5 AND product = 'glorys'", "cells")
R.add("s7_stored_box", lambda s, d: rounded(sc.load_box(stored_tiles(s, d), "2024-01-10", geo.BBox(-100, 20, -10, 30), "l4_ssh"), 10), f"WITH {_CELLS} SELECT * REPLACE (ROUND(val, 10) AS val) FROM c WHERE obs_date = DATE '2024-01-10' AND region_id IN (0, 1, 2, 4, 5, 6) AND product = 'l4_ssh'", "cells")
R.add("s6_load_tile", lambda s, d: rounded(sc.load_tile(_cells(s, d), "2024-01-10", 5, "glorys"), 10), f"WITH {_CELLS} SELECT * REPLACE (ROUND(val, 10) AS val) FROM c WHERE obs_date = DATE '2024-01-10' AND region_id = 5 AND product = 'glorys'", "cells")
R.add("s7_load_box", lambda s, d: rounded(sc.load_box(_cells(s, d), "2024-01-10", geo.BBox(-100, 20, -10, 30), "l4_ssh"), 10), f"WITH {_CELLS} SELECT * REPLACE (ROUND(val, 10) AS val) FROM c WHERE obs_date = DATE '2024-01-10' AND region_id IN (0, 1, 2, 4, 5, 6) AND product = 'l4_ssh'", "cells")
R.add("s9_multi_source_series", lambda s, d: rounded(sc.multi_source_series(_cells(s, d), ["glorys", "l4_ssh"], "2024-01-03", "2024-01-06", box=_BOX).select("product", "obs_time", "i", "j", "val"), 10), f"WITH {_CELLS} SELECT product, CAST(obs_date AS TIMESTAMP) AS obs_time, i, j, ROUND(val, 10) AS val FROM c WHERE obs_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-06' AND lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50", "cells")
R.add("s11_source_tokens", lambda s, d: view(s, d, "tiles").select("file_id", source_token(F.concat(F.lit(" l4_"), F.col("source_id"), F.when(F.col("file_id") % 2 == 0, ".nc").otherwise(" "))).alias("token")), "SELECT file_id, 'l4_' || source_id AS token FROM tiles", "tiles")
R.add("s18_read_box", _box_read, "SELECT obs_id, val FROM obs WHERE lon BETWEEN -80 AND -40 AND lat BETWEEN 10 AND 50", "obs")
R.add("s19_tile_sink", _tiles_and_inventory, f"WITH {_CELLS} SELECT product AS source, obs_date, region_id, COUNT(*) AS n_cells, MIN(i) AS i_min, MAX(i) AS i_max, MIN(j) AS j_min, MAX(j) AS j_max FROM c GROUP BY 1,2,3", "cells")
R.add("s21_s22_query_set", _query_set, "SELECT *, (SELECT COUNT(*) FROM boxes) AS n_queries FROM boxes", "boxes")
R.add("s25_day_split", _days, "SELECT obs_id, obs_date, val FROM obs", "obs")
R.add("f13_whitelisted", lambda s, d: sc.whitelisted(view(s, d, "tiles").withColumn("variable", F.concat(F.lit("v"), "source_id")), ["v1", "v7"]), "SELECT *, 'v' || source_id AS variable FROM tiles WHERE source_id IN (1, 7)", "tiles")
R.add("s24_metric_sink", _metrics, "SELECT source_id, COUNT(*) AS n FROM tiles GROUP BY 1", "tiles")
R.add(
    "s26_day_inputs", lambda s, d: sc.day_inputs(view(s, d, "tiles"), view(s, d, "tiles").select("source_id").distinct().withColumn("kind", F.when(F.col("source_id") % 3 == 0, "swath").otherwise("gridded")), "2024-01-15"),
    "SELECT *, CASE WHEN source_id % 3 = 0 THEN 'swath' ELSE 'gridded' END AS kind FROM tiles WHERE obs_date = DATE '2024-01-15' OR (source_id % 3 = 0 AND ABS(obs_date - DATE '2024-01-15') = 1)", "tiles",
)
R.add(
    "s27_format_product", lambda s, d: rounded(_product(s, d).select("obs_date", "i", "j", "region_id", "val"), 9),
    f"WITH {_CELLS} SELECT obs_date, i, j, region_id, ROUND(CASE WHEN AVG(val*300) OVER (PARTITION BY obs_date) > 200 THEN val*300 - 273.15 ELSE val*300 END, 9) AS val FROM c WHERE product = 'glorys'", "cells",
)
R.add("f2_normalised", lambda s, d: rounded(sc.normalised(view(s, d, "obs").withColumnsRenamed({"lon": "longitude", "lat": "latitude"}).withColumn("longitude", F.col("longitude") + 360), {"longitude": "lon", "latitude": "lat"}).select("obs_id", "lon", "lat"), 6), "SELECT obs_id, ROUND(lon, 6) AS lon, ROUND(lat, 6) AS lat FROM obs", "obs")
R.add("f10_tracks_touching", lambda s, d: sc.tracks_touching(view(s, d, "obs").withColumns({"lon": F.col("lon") / 8 + F.col("track_id") * 20 - 120, "lat": F.col("lat") / 3 + 25}), region_boxes(s)), "WITH x AS (SELECT obs_date, track_id, MIN(lon/8 + track_id*20 - 120) AS w, MAX(lon/8 + track_id*20 - 120) AS e, MIN(lat/3 + 25) AS s, MAX(lat/3 + 25) AS n FROM obs GROUP BY 1, 2) SELECT obs_date, track_id, CAST(r AS INT) AS region_id FROM x, range(8) AS t(r) WHERE e >= (r % 4)*90 - 180 AND w < (r % 4)*90 - 90 AND n >= (r // 4)*90 - 90 AND s < (r // 4)*90", "obs")
R.add("f14_chosen_level", lambda s, d: sc.chosen_level(view(s, d, "profiles").select("profile_id", "l_partkey", "l_suppkey", F.when(F.col("l_suppkey") % 2 == 0, "uo").otherwise("so").alias("variable"), (F.col("level") - 1).alias("level_idx")), view(s, d, "profiles").select(F.lit("uo").alias("variable"), F.lit(3).alias("level_idx")).distinct()), "SELECT profile_id, l_partkey, l_suppkey, CASE WHEN l_suppkey % 2 = 0 THEN 'uo' ELSE 'so' END AS variable, level - 1 AS level_idx FROM profiles WHERE level - 1 = CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 0 END", "profiles")
R.add("f21_pass_of_path", lambda s, d: view(s, d, "tiles").select(sc.pass_of(F.concat(F.lit("x/smos-"), F.when(F.col("file_id") % 3 == 0, "asc").when(F.col("file_id") % 3 == 1, "des").otherwise("none"), F.lit("/f.nc"))).alias("pass")).groupBy("pass").agg(F.count(F.lit(1)).alias("n")), "SELECT CASE file_id % 3 WHEN 0 THEN 'ascending' WHEN 1 THEN 'descending' END AS pass, COUNT(*) AS n FROM tiles GROUP BY 1", "tiles")
R.add("f21_passes", lambda s, d: sc.with_pass(view(s, d, "tiles").select("file_id", F.lit("l3_sss_smos").alias("source"), F.concat(F.lit("x/smos-"), F.when(F.col("file_id") % 3 == 0, "asc").when(F.col("file_id") % 3 == 1, "des").otherwise("none"), F.lit("/f.nc")).alias("path"))).drop("path"), "SELECT file_id, 'l3_sss_smos' || CASE file_id % 3 WHEN 0 THEN '_asc' WHEN 1 THEN '_desc' ELSE '' END AS source, CASE file_id % 3 WHEN 0 THEN 'ascending' WHEN 1 THEN 'descending' END AS satellite_pass FROM tiles", "tiles")
R.add(
    "f22_comparable_variables", lambda s, d: sc.comparable_variables(view(s, d, "tiles").select(F.concat(F.lit("s"), "source_id").alias("source"), F.concat(F.lit("v"), "region_id").alias("variable")).distinct(), view(s, d, "tiles").where("file_id % 2 = 0").select(F.concat(F.lit("s"), "source_id").alias("source"), F.concat(F.lit("v"), "region_id").alias("variable")).distinct(), ["v0", "v3"], ["v5", "v2"]),
    """WITH shared AS (SELECT DISTINCT 's' || source_id AS source, 'v' || region_id AS variable FROM tiles WHERE file_id % 2 = 0 AND region_id NOT IN (0, 3)) SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY CASE variable WHEN 'v5' THEN 1 WHEN 'v2' THEN 2 ELSE 3 END, variable) = 1 AS is_chosen FROM shared""", "tiles",
)
R.add("a30_pair_density", lambda s, d: rounded(sc.with_pixel_counts(view(s, d, "profiles"), "temp", "psal", 10.0, 40.0, 60)), "SELECT LEAST(59, CAST(FLOOR((temp-10)/0.5) AS INT)) AS x, LEAST(59, CAST(FLOOR((psal-10)/0.5) AS INT)) AS y, COUNT(*) AS n, ROUND(LOG10(COUNT(*)), 6) AS log_n FROM profiles WHERE temp BETWEEN 10 AND 40 AND psal BETWEEN 10 AND 40 GROUP BY 1, 2", "profiles")
R.add("a49_native_pixels", lambda s, d: rounded(sc.native_pixels(view(s, d, "tiles").select("source_id", ((F.col("source_id") + 1) / 24).alias("res_deg")).distinct(), 32.0, 128)), "SELECT DISTINCT source_id, ROUND((source_id+1)/24, 6) AS res_deg, CAST(ROUND(32 * 24.0 / (source_id+1)) AS INT) AS native_pixels, ROUND(128 / ROUND(32 * 24.0 / (source_id+1)), 6) AS ratio FROM tiles", "tiles")
R.add("u1_union_of_records", lambda s, d: view(s, d, "tiles").where("region_id < 4").unionByName(view(s, d, "tiles").where("region_id >= 4").withColumn("sensor", F.lit("x")), allowMissingColumns=True), "SELECT *, CASE WHEN region_id >= 4 THEN 'x' END AS sensor FROM tiles", "tiles")
R.add("u9_first_seen_variables", lambda s, d: view(s, d, "tiles").groupBy("source_id", "region_id").agg(F.min_by("file_id", F.struct("obs_date", "file_id")).alias("file_id")), "SELECT source_id, region_id, ARG_MIN(file_id, (obs_date, file_id)) AS file_id FROM tiles GROUP BY 1, 2", "tiles")
R.add("k5_seeded_subsample", lambda s, d: view(s, d, "obs").orderBy(F.md5(F.concat_ws("|", F.lit(7), "obs_id")), "obs_id").limit(500).select("obs_id"), "SELECT obs_id FROM obs ORDER BY MD5('7|' || obs_id), obs_id LIMIT 500", "obs")
R.add("c4_cell_index", lambda s, d: view(s, d, "obs").select("obs_id", geo.cell_index(F.col("lon"), -100.0, 2.5, 60).alias("cell")), "SELECT obs_id, CASE WHEN lon = 50 THEN 59 WHEN lon >= -100 AND lon < 50 THEN CAST(FLOOR((lon+100)/2.5) AS INT) END AS cell FROM obs", "obs")
R.add("c10_posix_range", lambda s, d: view(s, d, "obs").groupBy("obs_date").agg(F.min("obs_time").alias("a"), F.max("obs_time").alias("b")).select("obs_date", *[x.alias(n) for x, n in zip(posix_range(F.col("a"), F.col("b"), F.col("obs_date")), ("first_s", "last_s"))]), "SELECT obs_date, EPOCH_MS(MIN(obs_time)) // 1000 AS first_s, EPOCH_MS(MAX(obs_time)) // 1000 AS last_s FROM obs GROUP BY 1", "obs")
R.add("c13_sample_ids", lambda s, d: view(s, d, "tiles").select("file_id", sc.sample_id(F.concat(F.lit("s"), "source_id"), F.concat(F.lit("r"), "region_id"), F.col("obs_date")).alias("sample_id")), "SELECT file_id, 's' || source_id || '_r' || region_id || '_' || STRFTIME(obs_date, '%Y%m%d') AS sample_id FROM tiles", "tiles")
_SOURCES = ("glorys", "argo", "glorys_all_phys", "l3_sss_smos_asc", "l4_ssh")
R.add(
    "c13_names_and_modality", lambda s, d: view(s, d, "tiles").select("file_id", F.element_at(F.array(*map(F.lit, _SOURCES)), (F.col("file_id") % 5 + 1).cast("int")).alias("source"), F.when(F.col("file_id") % 2 == 0, "A/Asc/f.nc").otherwise("a/d/f.nc").alias("path")).select("file_id", sc.sample_name(F.col("source"), F.lit("uo"), F.col("path")).alias("name"), sc.modality(F.col("source")).alias("modality")),
    "SELECT file_id, CASE file_id % 5 WHEN 0 THEN 'glorys' WHEN 1 THEN 'argo' WHEN 2 THEN 'glorys_uo' WHEN 3 THEN CASE WHEN file_id % 2 = 0 THEN 'l3_sss_asc' ELSE 'l3_sss_desc' END ELSE 'l4_ssh' END AS name, CASE file_id % 5 WHEN 0 THEN 'model' WHEN 1 THEN 'in_situ' ELSE 'satellite' END AS modality FROM tiles", "tiles",
)
R.add("c14_wind_speed", lambda s, d: view(s, d, "profiles").select("profile_id", "level", "l_partkey", "l_suppkey", F.round(F.hypot("pres", "temp"), 6).alias("speed")), "SELECT profile_id, level, l_partkey, l_suppkey, ROUND(SQRT(pres*pres + temp*temp), 6) AS speed FROM profiles", "profiles")
R.add("c19_coordinates", lambda s, d: view(s, d, "boxes").select("query_id", F.posexplode(p.coordinates(F.col("lon_min"), F.col("lon_max"), 5)).alias("k", "lon")).select("query_id", "k", F.round("lon", 6).alias("lon")), "SELECT query_id, CAST(k AS INT) AS k, ROUND(lon_min + k*(lon_max-lon_min)/4, 6) AS lon FROM boxes, range(5) AS t(k)", "boxes")
R.add("c19_stepped_coordinates", lambda s, d: view(s, d, "boxes").select("query_id", F.posexplode(p.stepped_coordinates(F.col("lon_min"), F.col("lon_max"), 3.0)).alias("k", "lon")).select("query_id", "k", F.round("lon", 6).alias("lon")), "SELECT query_id, CAST(k AS INT) AS k, ROUND(lon_min + 3*k, 6) AS lon FROM boxes, range(4) AS t(k) WHERE 3*k < 11.5 - 1e-9", "boxes")
R.add("j16_cells_to_regions", lambda s, d: _cells(s, d).withColumn("own", geo.region_id(F.col("lon"), F.col("lat"))).groupBy("region_id", "own").agg(F.count(F.lit(1)).alias("n")), f"WITH {_CELLS} SELECT region_id, region_id AS own, COUNT(*) AS n FROM c GROUP BY 1", "cells")
R.add("g6_land_index_window", lambda s, d: view(s, d, "boxes").select("query_id", *[c.alias(n) for n, c in b.index_window().items()]), "SELECT query_id, CAST(GREATEST(0, FLOOR((lon_min+180)/0.25)) AS INT) AS w, CAST(LEAST(1440, FLOOR((lon_max+180)/0.25) + 1) AS INT) AS e, CAST(GREATEST(0, FLOOR((lat_min+90)/0.25)) AS INT) AS s, CAST(LEAST(720, FLOOR((lat_max+90)/0.25) + 1) AS INT) AS n FROM boxes", "boxes")

"""Queries over the tile catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import region_boxes
from ..fixtures import view
from ..functions.geo import BBox
from ..functions.temporal import compact_date, spine_between, week_spans
from ..operators import catalog as c
from .common import Registry, rounded

R = Registry()


def _tiles(spark, sf):
    return view(spark, sf, "tiles")


def _name():
    return F.concat(F.lit("l3/R"), F.col("region_id"), F.lit("/l3_ssh_"), F.date_format("obs_date", "yyyyMMdd"), F.lit("_"), F.date_format(F.date_add("obs_date", 1), "yyyyMMdd"), F.when(F.col("file_id") % 5 == 0, F.lit("_x.nc")).otherwise(F.lit(".nc")))


_NAME_SQL = "'l3/R' || region_id || '/l3_ssh_' || STRFTIME(obs_date, '%Y%m%d') || '_' || STRFTIME(obs_date + 1, '%Y%m%d') || CASE WHEN file_id % 5 = 0 THEN '_x.nc' ELSE '.nc' END"
_EXPECTED = """bounds AS (SELECT source_id, MIN(obs_date) AS low, MAX(obs_date) AS high FROM tiles GROUP BY 1),
 expected AS (SELECT source_id, CAST(UNNEST(GENERATE_SERIES(low, high, INTERVAL 1 DAY)) AS DATE) AS obs_date FROM bounds)"""

#: All tiles on dates with gaps, which differ by source.
_GAPPY = "own AS (SELECT file_id, CAST(DATE '2024-01-01' + CAST(file_id * file_id % 97 AS INT) AS DATE) AS obs_date, region_id, source_id, n_bytes FROM tiles)"


def _gappy(spark, sf):
    return _tiles(spark, sf).withColumn("obs_date", F.expr("date_add(DATE '2024-01-01', CAST(file_id * file_id % 97 AS INT))"))


R.add("s2_catalog_scan", lambda s, d: c.catalog_scan(_tiles(s, d).withColumn("id", F.concat(F.when(F.col("file_id") % 4 == 0, "__PAD__").otherwise("f"), "file_id")), "2024-01-05", "2024-01-20", [1, 3, 7], "__PAD__"), "SELECT *, 'f' || file_id AS id FROM tiles WHERE obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND source_id IN (1, 3, 7) AND file_id % 4 <> 0", "tiles")
R.add(
    "s3_catalog_lookup", lambda s, d: c.catalog_lookup(_tiles(s, d), region_boxes(s), "2024-01-15", BBox(-80, -40, 10, 50), s.range(4, 9).select(F.col("id").cast("int").alias("source_id"))),
    """SELECT t.* FROM tiles t WHERE obs_date = DATE '2024-01-15' AND source_id BETWEEN 4 AND 8 AND (region_id % 4)*90 - 180 <= -40 AND (region_id % 4)*90 - 90 >= -80
 AND (region_id // 4)*90 - 90 <= 50 AND (region_id // 4)*90 >= 10""", "tiles",
)
R.add("s4_one_source_one_date", lambda s, d: c.catalog_scan(_tiles(s, d), "2024-01-15", "2024-01-15", [2]), "SELECT * FROM tiles WHERE obs_date = DATE '2024-01-15' AND source_id = 2", "tiles")
R.add(
    "s9_time_series", lambda s, d: c.catalog_scan(_tiles(s, d), "2024-01-03", "2024-01-12", [0, 5]).groupBy("source_id", "obs_date").agg(F.count(F.lit(1)).alias("n_tiles"), F.sum("n_bytes").alias("n_bytes")).orderBy("obs_date", "source_id"),
    "SELECT source_id, obs_date, COUNT(*) AS n_tiles, CAST(SUM(n_bytes) AS BIGINT) AS n_bytes FROM tiles WHERE obs_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-12' AND source_id IN (0, 5) GROUP BY 1, 2", "tiles",
)
R.add(
    "s12_date_spine", lambda s, d: spine_between(_tiles(s, d).agg(F.min("obs_date").alias("low"), F.max("obs_date").alias("high")), "low", "high").select("obs_date"),
    "SELECT CAST(UNNEST(GENERATE_SERIES(MIN(obs_date), MAX(obs_date), INTERVAL 1 DAY)) AS DATE) AS obs_date FROM tiles", "tiles",
)
R.add(
    "c16_week_spans", lambda s, d: week_spans(_tiles(s, d).groupBy("source_id").agg(F.min("obs_date").alias("low"), F.max("obs_date").alias("high")), "low", "high").select("source_id", "week_start", "week_end"),
    f"WITH {_EXPECTED.split(',' + chr(10))[0]} SELECT source_id, CAST(w AS DATE) AS week_start, LEAST(CAST(w AS DATE) + 6, high) AS week_end FROM (SELECT *, UNNEST(GENERATE_SERIES(low, high, INTERVAL 7 DAY)) AS w FROM bounds)", "tiles",
)
R.add(
    "s14_measurement_date", lambda s, d: _tiles(s, d).select("file_id", c.date_of_name(_name(), r"_(\d{8})_\d{8}\.nc$").alias("name_date"), c.region_of_path(_name()).alias("region")),
    f"SELECT file_id, TRY_STRPTIME(NULLIF(REGEXP_EXTRACT({_NAME_SQL}, '_(\\d{{8}})_\\d{{8}}\\.nc$', 1), ''), '%Y%m%d')::DATE AS name_date, STRING_SPLIT({_NAME_SQL}, '/')[-2] AS region FROM tiles", "tiles",
)
R.add(
    "c15_compact_dates", lambda s, d: _tiles(s, d).select("file_id", compact_date(F.date_format("obs_date", "yyyy_MM_dd")).alias("a"), compact_date(F.date_format("obs_date", "yyyyMMdd")).alias("b")),
    "SELECT file_id, obs_date AS a, obs_date AS b FROM tiles", "tiles",
)
R.add(
    "s15_highest_version", lambda s, d: c.highest_version(_tiles(s, d).select("file_id", F.when(F.col("file_id") % 7 == 0, F.concat(F.lit("plain"), "file_id", F.lit(".dat"))).otherwise(F.concat(F.lit("base"), F.col("file_id") % 500, F.lit("_PGC0_"), F.lpad((F.col("file_id") % 97).cast("string"), 2, "0"), F.lit(".nc"))).alias("filename"))).select("filename"),
    """SELECT filename FROM (SELECT filename, ROW_NUMBER() OVER (PARTITION BY base ORDER BY version DESC, filename) AS r FROM (SELECT filename, CASE WHEN filename LIKE '%.nc' THEN REGEXP_EXTRACT(filename, '^(.*)_(\\d+)\\.nc$', 1) ELSE filename END AS base,
 CASE WHEN filename LIKE '%.nc' THEN CAST(REGEXP_EXTRACT(filename, '^(.*)_(\\d+)\\.nc$', 2) AS INT) ELSE 0 END AS version FROM (SELECT CASE WHEN file_id % 7 = 0 THEN 'plain' || file_id || '.dat' ELSE 'base' || (file_id % 500) || '_PGC0_' || LPAD(CAST(file_id % 97 AS VARCHAR), 2, '0') || '.nc' END AS filename FROM tiles))) WHERE r = 1""", "tiles",
)


def _products(s):
    return s.sql("SELECT * FROM VALUES (1, DATE '2024-01-01', DATE '2024-01-20', 1), (2, DATE '2024-01-01', DATE '2024-02-29', 2), (3, DATE '2024-01-16', DATE '2024-02-29', 1) AS t(p_product, valid_from, valid_to, rank)")


R.add(
    "s16_product_priority", lambda s, d: c.product_priority(_tiles(s, d).withColumn("product", F.col("source_id")), _products(s)).select("obs_date", "product", "file_id"),
    """SELECT obs_date, product, file_id FROM (SELECT t.obs_date, t.source_id AS product, file_id, ROW_NUMBER() OVER (PARTITION BY t.obs_date ORDER BY p.rank, t.source_id, file_id) AS r FROM tiles t
 JOIN (VALUES (1, DATE '2024-01-01', DATE '2024-01-20', 1), (2, DATE '2024-01-01', DATE '2024-02-29', 2), (3, DATE '2024-01-16', DATE '2024-02-29', 1)) AS p(p_product, valid_from, valid_to, rank)
 ON t.source_id = p.p_product AND t.obs_date BETWEEN p.valid_from AND p.valid_to) WHERE r = 1""", "tiles",
)
R.add(
    "j1_query_tiles", lambda s, d: c.query_file_counts(view(s, d, "boxes"), _tiles(s, d), s.range(3).select(F.col("id").cast("int").alias("source_id")), region_boxes(s)),
    """SELECT query_id, COUNT(*) AS n_files_indexed, COUNT(*) FILTER (WHERE lon_max > (region_id % 4)*90 - 180 AND lon_min < (region_id % 4)*90 - 90 AND lat_max > (region_id // 4)*90 - 90 AND lat_min < (region_id // 4)*90) AS n_files,
 CAST(COALESCE(SUM(n_bytes) FILTER (WHERE lon_max > (region_id % 4)*90 - 180 AND lon_min < (region_id % 4)*90 - 90 AND lat_max > (region_id // 4)*90 - 90 AND lat_min < (region_id // 4)*90), 0) AS BIGINT) AS n_bytes
 FROM boxes JOIN tiles ON obs_date BETWEEN date_start AND date_end WHERE source_id < 3 GROUP BY 1""", "boxes", "tiles",
)
R.add(
    "j1_tiles_of_queries", lambda s, d: c.query_tiles(view(s, d, "boxes"), _tiles(s, d).select("file_id", "obs_date", "region_id", "source_id"), s.range(3).select(F.col("id").cast("int").alias("source_id")), region_boxes(s), "file_id").select("query_id", "obs_date", "file_id"),
    """SELECT query_id, obs_date, file_id FROM boxes JOIN tiles ON obs_date BETWEEN date_start AND date_end AND lon_max > (region_id % 4)*90 - 180 AND lon_min < (region_id % 4)*90 - 90 AND lat_max > (region_id // 4)*90 - 90 AND lat_min < (region_id // 4)*90
 WHERE source_id < 3""", "boxes", "tiles",
)
R.add(
    "j13_semi_and_anti", lambda s, d: _tiles(s, d).join(_tiles(s, d).where("n_bytes > 450000").select("obs_date", "source_id").distinct(), ["obs_date", "source_id"], "left_anti"),
    "SELECT * FROM tiles t WHERE NOT EXISTS (SELECT 1 FROM tiles u WHERE u.obs_date = t.obs_date AND u.source_id = t.source_id AND u.n_bytes > 450000)", "tiles",
)
R.add(
    "j14_missing_coverage", lambda s, d: c.missing_coverage(_tiles(s, d), [0, 1, 2, 3, 4]),
    f"""WITH {_EXPECTED} SELECT e.source_id, e.obs_date, CAST(r AS INT) AS region_id FROM expected e, range(8) AS x(r) WHERE e.source_id <= 4 AND NOT EXISTS (SELECT 1 FROM tiles t WHERE t.source_id = e.source_id AND t.obs_date = e.obs_date AND t.region_id = r)
 UNION ALL SELECT source_id, obs_date, NULL FROM expected e WHERE source_id > 4 AND NOT EXISTS (SELECT 1 FROM tiles t WHERE t.source_id = e.source_id AND t.obs_date = e.obs_date)""", "tiles",
)
R.add(
    "a42_coverage_summary", lambda s, d: c.coverage_summary(_tiles(s, d)),
    """SELECT source_id, MIN(obs_date) AS first_date, MAX(obs_date) AS last_date, COUNT(*) AS n_with_file, MAX(n) AS max_files, MIN(n) AS min_files,
 CAST(MAX(obs_date) - MIN(obs_date) + 1 AS BIGINT) AS n_expected, CAST(MAX(obs_date) - MIN(obs_date) + 1 AS BIGINT) - COUNT(*) AS n_missing FROM (SELECT source_id, obs_date, COUNT(*) AS n FROM tiles GROUP BY 1, 2) GROUP BY 1""", "tiles",
)
R.add(
    "u7_missing_dates", lambda s, d: c.missing_dates(_gappy(s, d)),
    f"WITH {_GAPPY}, {_EXPECTED.replace('FROM tiles', 'FROM own')} SELECT source_id, obs_date FROM expected EXCEPT SELECT source_id, obs_date FROM own", "tiles",
)
R.add(
    "w7_availability_segments", lambda s, d: c.availability_segments(_gappy(s, d)),
    f"""WITH {_GAPPY} SELECT source_id, MIN(obs_date) AS first_date, MAX(obs_date) AS last_date, COUNT(*) AS n_days FROM (SELECT source_id, obs_date, obs_date - CAST(ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY obs_date) AS INT) AS island
 FROM (SELECT DISTINCT source_id, obs_date FROM own)) GROUP BY source_id, island""", "tiles",
)
R.add(
    "w8_first_file_of_day", lambda s, d: c.first_per_key(_tiles(s, d), ["source_id", "obs_date"], ["file_id"]),
    "SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_id, obs_date ORDER BY file_id) AS r FROM tiles) WHERE r = 1", "tiles",
)
R.add(
    "w11_cap_per_region", lambda s, d: c.cap_per_key(_tiles(s, d), ["obs_date", "region_id"], ["file_id"]),
    "SELECT * EXCLUDE (r, m), GREATEST(m - 11, 0) AS n_dropped FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY obs_date, region_id ORDER BY file_id) AS r, COUNT(*) OVER (PARTITION BY obs_date, region_id) AS m FROM tiles) WHERE r <= 11", "tiles",
)
R.add("u4_drop_duplicates", lambda s, d: c.first_per_key(_tiles(s, d), ["obs_date", "region_id", "source_id"], ["file_id"]), "SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY obs_date, region_id, source_id ORDER BY file_id) AS r FROM tiles) WHERE r = 1", "tiles")
R.add("u5_duplicate_report", lambda s, d: c.duplicate_report(_tiles(s, d), ["obs_date", "region_id", "source_id"]), "SELECT * FROM (SELECT *, COUNT(*) OVER (PARTITION BY obs_date, region_id, source_id) AS n_same FROM tiles) WHERE n_same > 1", "tiles")
R.add("k2_top_collisions", lambda s, d: c.top_collisions(_tiles(s, d), ["obs_date", "region_id", "source_id"]), "SELECT obs_date, region_id, source_id, COUNT(*) AS n FROM tiles GROUP BY 1,2,3 HAVING COUNT(*) > 1 ORDER BY n DESC, 1, 2, 3 LIMIT 20", "tiles")
R.add(
    "u3_upsert", lambda s, d: c.upsert(_tiles(s, d).where("file_id % 2 = 0"), _tiles(s, d).where("file_id % 2 = 1 AND obs_date > DATE '2024-02-10'"), ["source_id", "obs_date"]),
    """WITH fresh AS (SELECT * FROM tiles WHERE file_id % 2 = 1 AND obs_date > DATE '2024-02-10') SELECT * FROM tiles t WHERE file_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.source_id = t.source_id AND f.obs_date = t.obs_date) UNION ALL SELECT * FROM fresh""", "tiles",
)


def _named(s, d):
    """Tiles with the names of their sources; two passes of one source are stored under names of their own."""
    names = F.element_at(F.array(*map(F.lit, _STORED)), (F.col("source_id") % len(_STORED) + 1).cast("int"))
    return _tiles(s, d).withColumn("source", names)


_STORED = ["l3_sss_smos_asc", "l3_sss_smos_desc", "argo", "l4_ssh"]
R.add(
    "u3_upsert_aliases",
    lambda s, d: c.upsert_processed(
        _named(s, d).where("file_id % 2 = 0"), _named(s, d).where("file_id % 2 = 1 AND obs_date > DATE '2024-02-10' AND source = 'l3_sss_smos_asc'"), ["l3_sss_smos", "argo"],
        {"l3_sss_smos": ["l3_sss_smos_asc", "l3_sss_smos_desc"]}, _tiles(s, d).where("obs_date > DATE '2024-02-10'"),
    ),
    """WITH named AS (SELECT *, CASE source_id % 4 WHEN 0 THEN 'l3_sss_smos_asc' WHEN 1 THEN 'l3_sss_smos_desc' WHEN 2 THEN 'argo' ELSE 'l4_ssh' END AS source FROM tiles) SELECT * FROM named WHERE file_id % 2 = 0 AND (obs_date <= DATE '2024-02-10' OR source = 'l4_ssh')
 UNION ALL SELECT * FROM named WHERE file_id % 2 = 1 AND obs_date > DATE '2024-02-10' AND source = 'l3_sss_smos_asc'""", "tiles",
)
R.add(
    "u6_drop_odd_duplicates", lambda s, d: c.drop_odd_duplicates(_tiles(s, d), ["obs_date", "region_id", "source_id"], F.col("file_id") % 3 != 0),
    """SELECT * EXCLUDE (n, some_ok) FROM (SELECT *, COUNT(*) OVER w AS n, BOOL_OR(file_id % 3 <> 0) OVER w AS some_ok FROM tiles WINDOW w AS (PARTITION BY obs_date, region_id, source_id)) WHERE file_id % 3 <> 0 OR n = 1 OR NOT some_ok""", "tiles",
)
R.add(
    "u2_missing_in_catalogue", lambda s, d: c.missing_in_catalogue(_gappy(s, d), _tiles(s, d).withColumn("obs_date", F.date_add("obs_date", 20))),
    f"""WITH {_GAPPY}, gone AS (SELECT CAST(DATE '2024-01-01' + CAST(k AS INT) AS DATE) AS obs_date FROM range(97) AS x(k) EXCEPT SELECT obs_date FROM own)
 SELECT obs_date + 20 AS obs_date, file_id, source_id, region_id FROM tiles WHERE obs_date + 20 IN (SELECT obs_date FROM gone WHERE obs_date > (SELECT MIN(obs_date) FROM own) AND obs_date < (SELECT MAX(obs_date) FROM own))""", "tiles",
)
R.add(
    "u8_merged_availability", lambda s, d: _tiles(s, d).groupBy("obs_date", F.when(F.col("source_id") < 5, "model").otherwise(F.concat(F.lit("s"), "source_id")).alias("line")).agg(F.count_distinct("source_id").alias("n_sources")),
    "SELECT obs_date, CASE WHEN source_id < 5 THEN 'model' ELSE 's' || source_id END AS line, COUNT(DISTINCT source_id) AS n_sources FROM tiles GROUP BY 1, 2", "tiles",
)
R.add(
    "a41_inventory_summary", lambda s, d: c.inventory_summary(_tiles(s, d)),
    "SELECT source_id, region_id, GROUPING(source_id, region_id) AS level, COUNT(*) AS n, MIN(obs_date) AS first_date, MAX(obs_date) AS last_date, CAST(SUM(n_bytes) AS BIGINT) AS n_bytes FROM tiles GROUP BY GROUPING SETS ((source_id), (region_id), ())", "tiles",
)
R.add(
    "u10_hierarchy", lambda s, d: c.hierarchy(_tiles(s, d)).select("obs_date", "region_id", "day_start", "day_end", "first_date", "last_date", F.size("files").alias("n_files"), F.array_join("files", ",").alias("files")),
    """SELECT e.obs_date, e.region_id, EPOCH(CAST(e.obs_date AS TIMESTAMP))::BIGINT AS day_start, EPOCH(CAST(e.obs_date AS TIMESTAMP))::BIGINT + 86399 AS day_end, (SELECT MIN(obs_date) FROM tiles) AS first_date, (SELECT MAX(obs_date) FROM tiles) AS last_date, CAST(COUNT(file_id) AS INT) AS n_files, COALESCE(STRING_AGG(file_id, ',' ORDER BY file_id), '') AS files FROM (SELECT obs_date, CAST(r AS INT) AS region_id FROM (SELECT DISTINCT obs_date FROM tiles), range(8) AS x(r)) e
 LEFT JOIN tiles t ON t.obs_date = e.obs_date AND t.region_id = e.region_id GROUP BY 1, 2""", "tiles",
)
R.add(
    "u11_pending_files", lambda s, d: c.pending_files(_tiles(s, d).select(F.col("file_id").alias("name"), F.when(F.col("file_id") % 4 == 0, 0).otherwise(F.col("n_bytes")).alias("size")), _tiles(s, d).where("file_id % 3 = 0").select(F.col("file_id").alias("name"), (F.col("n_bytes") + F.col("file_id") % 2).alias("size"))),
    """WITH wanted AS (SELECT file_id AS name, CASE WHEN file_id % 4 = 0 THEN 0 ELSE n_bytes END AS size FROM tiles), present AS (SELECT file_id AS name, n_bytes + file_id % 2 AS size FROM tiles WHERE file_id % 3 = 0)
 SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.name = w.name AND (w.size = 0 OR w.size = p.size))""", "tiles",
)
#: File numbers that one JSON of the nested catalogue spans, so that its length does not grow with the table.
_CHUNK = 4096


def _nested(tiles):
    """The catalogue as JSON, a row per source and span of file numbers."""
    file = F.struct(F.concat(F.lit("f"), "file_id").alias("filename"), F.col("n_bytes").alias("size"), F.when(F.col("file_id") % 10 == 0, "").otherwise(F.date_format("obs_date", "yyyyMMdd")).alias("date"))
    chunks = tiles.groupBy(F.col("source_id").cast("string").alias("k"), F.floor(F.col("file_id") / _CHUNK).alias("chunk")).agg(F.collect_list(file).alias("v"))
    return chunks.select(F.to_json(F.struct(F.map_from_arrays(F.array("k"), F.array("v")).alias("cycles"))).alias("json"))


R.add(
    "s23_catalogue_rows", lambda s, d: c.catalogue_rows(_nested(_tiles(s, d))).select("cycle", "filename", "size", "date"),
    "SELECT CAST(source_id AS VARCHAR) AS cycle, 'f' || file_id AS filename, n_bytes AS size, obs_date AS date FROM tiles WHERE file_id % 10 <> 0", "tiles",
)
R.add("a43_files_per_date", lambda s, d: _tiles(s, d).groupBy("obs_date").agg(F.count(F.lit(1)).alias("n_files")), "SELECT obs_date, COUNT(*) AS n_files FROM tiles GROUP BY 1", "tiles")
def _status():
    return F.element_at(F.array(*map(F.lit, ("success", "partial", "failed", "skipped"))), (F.col("file_id") % 4 + 1).cast("int"))
R.add(
    "a44_attempt_summary", lambda s, d: c.attempt_summary(_tiles(s, d).select(F.concat(F.lit("s"), "source_id").alias("dataset"), _status().alias("status"))),
    """SELECT dataset, COUNT(*) AS n, COUNT(*) FILTER (WHERE k = 0) AS n_success, COUNT(*) FILTER (WHERE k = 1) AS n_partial, COUNT(*) FILTER (WHERE k = 2) AS n_failed, COUNT(*) FILTER (WHERE k = 3) AS n_skipped
 FROM (SELECT 's' || source_id AS dataset, file_id % 4 AS k FROM tiles) GROUP BY ROLLUP (dataset)""", "tiles",
)
R.add(
    "f19_malformed_rows", lambda s, d: c.malformed(_tiles(s, d).withColumn("name", _name()), "name", r"^l3/R(\d)/l3_ssh_\d{8}_\d{8}\.nc$", ["n_bytes", "obs_date"]),
    f"SELECT *, {_NAME_SQL} AS name FROM tiles WHERE file_id % 5 <> 0", "tiles",
)
def _source():
    return F.element_at(F.array(*map(F.lit, ("l4_ssh", "l3_sst", "l2_x", "argo", "glorys", "other"))), F.col("source_id") % 6 + 1)
R.add(
    "k4_source_order", lambda s, d: _tiles(s, d).select(_source().alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("place", c.source_order(F.col("source"))),
    "SELECT source, n, CAST(k AS INT) AS place FROM (SELECT source_id % 6 AS k, ['l4_ssh', 'l3_sst', 'l2_x', 'argo', 'glorys', 'other'][source_id % 6 + 1] AS source, COUNT(*) AS n FROM tiles GROUP BY 1, 2)", "tiles",
)
R.add(
    "a40_sizes_by_modality", lambda s, d: rounded(_tiles(s, d).rollup("source_id").agg(F.sum("n_bytes").alias("packed"), F.sum(F.col("n_bytes") * 2).alias("raw"), (F.sum("n_bytes") / F.count_distinct("obs_date") / 1e6).alias("mb_per_day"))),
    "SELECT source_id, CAST(SUM(n_bytes) AS BIGINT) AS packed, CAST(SUM(n_bytes*2) AS BIGINT) AS raw, ROUND(SUM(n_bytes) / COUNT(DISTINCT obs_date) / 1e6, 6) AS mb_per_day FROM tiles GROUP BY ROLLUP (source_id)", "tiles",
)

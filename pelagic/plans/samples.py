"""Queries over patches, smoothing and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import region_boxes
from ..fixtures import view
from ..operators import boxes as b
from ..operators import matching as m
from ..operators import samples as p
from ..operators import spectra as sp
from ..operators import statistics as st
from ..operators import tracks as t
from ..operators.gridding import with_cells
from .common import Registry, rounded, written
from .fields import SEGMENTS, STEPS

R = Registry()
_TAPS = """taps{a} AS (SELECT src, target, SUM(weight) AS weight FROM (
 SELECT LEAST(FLOOR(GREATEST(0, (t+0.5)*{n}/{m} - 0.5)), {n}-1)::INT AS src, t::INT AS target, 1 - (GREATEST(0, (t+0.5)*{n}/{m} - 0.5) - LEAST(FLOOR(GREATEST(0, (t+0.5)*{n}/{m} - 0.5)), {n}-1)) AS weight FROM range({m}) AS x(t)
 UNION ALL SELECT LEAST(LEAST(FLOOR(GREATEST(0, (t+0.5)*{n}/{m} - 0.5)), {n}-1) + 1, {n}-1)::INT, t::INT, GREATEST(0, (t+0.5)*{n}/{m} - 0.5) - LEAST(FLOOR(GREATEST(0, (t+0.5)*{n}/{m} - 0.5)), {n}-1) FROM range({m}) AS x(t)) WHERE weight > 0 GROUP BY 1, 2)"""
R.add(
    "r1_resize", lambda s, d: rounded(p.resize(view(s, d, "cells"), (36, 18), (64, 40), ("product", "obs_date")), 9),
    f"""WITH {_TAPS.format(a='i', n=36, m=64)}, {_TAPS.format(a='j', n=18, m=40)} SELECT product, obs_date, ti.target AS i, tj.target AS j, CASE WHEN SUM(ti.weight*tj.weight) > 0.01 THEN ROUND(SUM(ti.weight*tj.weight*val)/SUM(ti.weight*tj.weight), 9) END AS value
 FROM cells JOIN tapsi ti ON ti.src = cells.i JOIN tapsj tj ON tj.src = cells.j GROUP BY 1,2,3,4""", "cells",
)
_G = ", ".join(f"({k}, {v!r}::DOUBLE)" for k, v in p.gaussian_weights(1.0))
R.add(
    "r4_smooth", lambda s, d: rounded(p.smooth(view(s, d, "cells").withColumn("val", F.when(F.col("i") % 3 != 0, F.col("val"))), 1.0, 36, 18, ("product", "obs_date"))),
    f"""WITH g(k, v) AS (VALUES {_G}) SELECT product, obs_date, i + a.k AS i, j + b.k AS j, CASE WHEN SUM(a.v*b.v) >= 0.01 THEN ROUND(SUM(a.v*b.v*val)/SUM(a.v*b.v), 6) END AS value FROM cells, g a, g b
 WHERE i % 3 <> 0 AND i + a.k BETWEEN 0 AND 35 AND j + b.k BETWEEN 0 AND 17 GROUP BY 1,2,3,4""", "cells",
)


def _track_cells(s, d):
    return with_cells(view(s, d, "obs").where("val IS NOT NULL"), 10.0).groupBy("obs_date", "track_id", "i", "j").agg(F.avg("val").alias("val"))


R.add(
    "r5_smoothed_tracks", lambda s, d: rounded(p.smoothed_tracks(_track_cells(s, d), 0.5, 36, 18, ("obs_date",)), 9),
    f"""WITH g(k, v) AS (VALUES {", ".join(f"({k}, {v!r}::DOUBLE)" for k, v in p.gaussian_weights(0.5))}), tc AS (SELECT obs_date, track_id, CAST(FLOOR((lon+180)/10) AS INT) AS i, CAST(FLOOR((lat+90)/10) AS INT) AS j, AVG(val) AS val FROM obs WHERE val IS NOT NULL GROUP BY 1,2,3,4),
 own AS (SELECT obs_date, track_id, i + a.k AS i, j + b.k AS j, SUM(a.v*b.v*val)/SUM(a.v*b.v) AS value FROM tc, g a, g b WHERE i + a.k BETWEEN 0 AND 35 AND j + b.k BETWEEN 0 AND 17 GROUP BY 1,2,3,4 HAVING SUM(a.v*b.v) >= 0.01)
 SELECT obs_date, i, j, ROUND(AVG(value), 9) AS value, COUNT(*) AS n_tracks FROM own GROUP BY 1,2,3""", "obs",
)


def _sample_cells(s, d, boxes):
    """Observations as cells of two sources, their tiles, and the patches of boxes."""
    cells = view(s, d, "obs").withColumns({"source_id": (F.col("obs_id") % 2).cast("int"), "variable": F.concat(F.lit("v"), F.col("obs_id") % 2)}).withColumn("val", F.when(F.col("source_id") == 1, F.col("val") + 273.15).otherwise(F.col("val")))
    tiles = with_cells(cells, 10.0).groupBy("source_id", "obs_date", "region_id").agg(F.min("obs_id").alias("file_id"))
    return p.sample_cells(boxes, cells, tiles, s.range(2).select(F.col("id").cast("int").alias("source_id")), region_boxes(s), {"v1": -273.15}, 4, 8)


def _samples(s, d, boxes):
    names = view(s, d, "obs").select(F.concat(F.lit("v"), F.col("obs_id") % 2).alias("variable"))
    return p.assemble(boxes, names, _sample_cells(s, d, boxes), 8)


def _sample_values(s, d):
    """A row per box, variable and value; what boxes have in common is worked out and rounded once."""
    def run(boxes):
        shown = [F.transform(c, lambda x: F.round(x.cast("double"), n)).alias(c) for c, n in (("data", 3), ("lons", 6), ("lats", 6))]  # noqa: B023
        return _samples(s, d, boxes).select("query_id", "variable", "present", "n_files", *shown)

    one = b.for_equal_boxes(view(s, d, "boxes"), run).select("query_id", "variable", "present", "n_files", "lons", "lats", F.posexplode("data").alias("k", "value"))
    return one.select("query_id", "variable", "present", "n_files", "k", "value", F.col("lons")[F.col("k") % 8].alias("lon"), F.col("lats")[F.floor(F.col("k") / 8).cast("int")].alias("lat"))


_SAMPLES = f"""{_TAPS.format(a='i', n=4, m=8)}, {_TAPS.format(a='j', n=4, m=8)}, hits AS (SELECT query_id, 'v' || (obs_id % 2) AS variable, LEAST(3, FLOOR((lon-lon_min)/((lon_max-lon_min)/4)))::INT AS i, LEAST(3, FLOOR((lat-lat_min)/((lat_max-lat_min)/4)))::INT AS j, AVG(val) AS val
 FROM boxes JOIN obs ON val IS NOT NULL AND obs_date BETWEEN date_start AND date_end AND lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max GROUP BY 1,2,3,4),
 files AS (SELECT query_id, 'v' || source_id AS variable, COUNT(*) AS n_files FROM boxes JOIN (SELECT DISTINCT obs_id % 2 AS source_id, obs_date, CAST(FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90) AS INT) AS region_id FROM obs) ON obs_date BETWEEN date_start AND date_end
 AND lon_max > (region_id % 4)*90 - 180 AND lon_min < (region_id % 4)*90 - 90 AND lat_max > (region_id // 4)*90 - 90 AND lat_min < (region_id // 4)*90 GROUP BY 1, 2),
 own AS (SELECT query_id, variable, tj.target*8 + ti.target AS k, CASE WHEN SUM(ti.weight*tj.weight) > 0.01 THEN SUM(ti.weight*tj.weight*val)/SUM(ti.weight*tj.weight) END AS value FROM hits JOIN tapsi ti ON ti.src = hits.i JOIN tapsj tj ON tj.src = hits.j GROUP BY 1,2,3),
 samples AS (SELECT q.query_id, v.variable, t.k, own2.query_id IS NOT NULL AS present, CASE WHEN own2.query_id IS NULL THEN 0 ELSE n_files END AS n_files, COALESCE(own.value, 0) AS value, lon_min + (t.k % 8)*(lon_max-lon_min)/7 AS lon, lat_min + (t.k // 8)*(lat_max-lat_min)/7 AS lat, lon_min, date_end,
 DENSE_RANK() OVER (ORDER BY q.query_id) - 1 AS number FROM boxes q CROSS JOIN (VALUES ('v0'), ('v1')) AS v(variable) CROSS JOIN range(64) AS t(k) LEFT JOIN own ON own.query_id = q.query_id AND own.variable = v.variable AND own.k = t.k
 LEFT JOIN (SELECT DISTINCT query_id, variable FROM own) own2 ON own2.query_id = q.query_id AND own2.variable = v.variable LEFT JOIN files f ON f.query_id = q.query_id AND f.variable = v.variable)"""
R.add(
    "r2_samples", _sample_values,
    f"WITH {_SAMPLES} SELECT query_id, variable, present, CAST(n_files AS BIGINT) AS n_files, CAST(k AS INT) AS k, ROUND(value::FLOAT::DOUBLE, 3) AS value, ROUND(lon, 6) AS lon, ROUND(lat, 6) AS lat FROM samples", "boxes", "obs",
)


def _numbered_boxes(s, d):
    boxes, cut = view(s, d, "boxes"), written(s)
    return cut(boxes.join(p.numbered(boxes, "query_id", cut), "query_id"))


def _batches(s, d):
    cut = written(s)
    samples = b.for_equal_boxes(_numbered_boxes(s, d), lambda boxes: cut(_samples(s, d, boxes)), "number")
    one = p.collate(samples, 8, cut).select("batch", "variable", "top_h", "top_w", F.col("lons")[0].alias("lon"), F.posexplode(F.arrays_zip("query_ids", "present", "data", "bboxes", "time_ranges")).alias("place", "s"))
    return one.select("batch", "variable", "top_h", "top_w", "lon", "place", F.col("s.query_ids").alias("query_id"), F.col("s.present").alias("present"), F.round(F.aggregate(F.col("s.data"), F.lit(0.0), lambda a, x: a + x), 2).alias("total"), F.col("s.bboxes")[0].alias("lon_min"), F.col("s.time_ranges")[1].alias("date_end"))


R.add(
    "r3_batches", lambda s, d: rounded(_batches(s, d)),
    f"""WITH {_SAMPLES} SELECT number // 8 AS batch, variable, 8 AS top_h, 8 AS top_w, ROUND(ARG_MIN(lon_min, number) OVER (PARTITION BY number // 8, variable), 6) AS lon, CAST(number % 8 AS INT) AS place, query_id, present, total, ROUND(lon_min, 6) AS lon_min, date_end
 FROM (SELECT query_id, variable, number, present, lon_min, date_end, ROUND(SUM(value::FLOAT::DOUBLE), 2) AS total FROM samples GROUP BY ALL)""", "boxes", "obs",
)
#: Three sources of the observations: resolution in degrees, and the size (h, w) of their patches where one is wanted.
_SOURCES = [(0, 2.5, None, None), (1, 2.0, 6, 7), (2, 5.0, None, 3)]


def _patches(s, d, how: str, boxes):
    """Observations as cells of three sources of different resolution, and the patches of boxes over their days."""
    source = (F.col("obs_id") % 3).cast("int")
    cells = view(s, d, "obs").withColumns({"source_id": source, "variable": F.concat(F.lit("v"), source)}).withColumn("val", F.when(F.col("source_id") == 1, F.col("val") + 273.15).otherwise(F.col("val")))
    tiles = with_cells(cells, 10.0).groupBy("source_id", "obs_date", "region_id").agg(F.min("obs_id").alias("file_id"))
    sources = s.createDataFrame(_SOURCES, "source_id int, resolution double, h int, w int")
    return p.sample_patches(boxes, cells, tiles, sources, region_boxes(s), {"v1": -273.15}, how)


_PATCH_VALUES = {"first": "ARG_MIN(val, obs_date)", "last": "ARG_MAX(val, obs_date)", "mean": "AVG(val)"}


def _weight(axis: str, at: str, n_in: str, n_out: str) -> str:
    return f"1 - ABS(LEAST({n_in} - 1.0, GREATEST(0.0, ({axis} + 0.5)*{n_in}/{n_out} - 0.5)) - {at})"


def patches_sql(how: str) -> str:
    """Tables up to patches (query_id, variable, n_t, h, w, t, i, j, value)."""
    merged = (
        "SELECT d.* EXCLUDE obs_date, days.t, n_t FROM daily d JOIN days USING (query_id, variable, obs_date)" if how == "stack"
        else f"SELECT query_id, variable, n_i, n_j, h, w, i, j, {_PATCH_VALUES[how]} AS val, 0 AS t, 1 AS n_t FROM daily GROUP BY ALL"
    )
    return f"""own_sources(source_id, resolution, h, w) AS (VALUES {", ".join(str(r).replace("None", "NULL") for r in _SOURCES)}),
 sized AS (SELECT query_id, 'v' || s.source_id AS variable, obs_date, lon, lat, val, lon_min, lon_max, lat_min, lat_max, ROUND((lon_max-lon_min)/resolution)::INT AS n_i, ROUND((lat_max-lat_min)/resolution)::INT AS n_j, h, w
 FROM boxes JOIN obs ON val IS NOT NULL AND obs_date BETWEEN date_start AND date_end AND lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max JOIN own_sources s ON s.source_id = obs_id % 3),
 daily AS (SELECT query_id, variable, n_i, n_j, COALESCE(h, n_j) AS h, COALESCE(w, n_i) AS w, LEAST(n_i-1, FLOOR((lon-lon_min)/(lon_max-lon_min)*n_i))::INT AS i, LEAST(n_j-1, FLOOR((lat-lat_min)/(lat_max-lat_min)*n_j))::INT AS j, obs_date, AVG(val) AS val FROM sized GROUP BY ALL),
 days AS (SELECT query_id, variable, obs_date, CAST(ROW_NUMBER() OVER w - 1 AS INT) AS t, CAST(COUNT(*) OVER (PARTITION BY query_id, variable) AS INT) AS n_t FROM (SELECT DISTINCT query_id, variable, obs_date FROM daily) WINDOW w AS (PARTITION BY query_id, variable ORDER BY obs_date)),
 merged AS ({merged}),
 patches AS (SELECT query_id, variable, n_t, h, w, t, x::INT AS i, y::INT AS j, CASE WHEN SUM(a*b) > 0.01 THEN SUM(a*b*val)/SUM(a*b) END AS value FROM
 (SELECT m.*, x.x, y.y, {_weight('x.x', 'i', 'n_i', 'w')} AS a, {_weight('y.y', 'j', 'n_j', 'h')} AS b FROM merged m JOIN range(12) AS x(x) ON x.x < w JOIN range(12) AS y(y) ON y.y < h) WHERE a > 0 AND b > 0 GROUP BY ALL)"""


def _patch_batches(s, d):
    names, cut = view(s, d, "obs").select(F.concat(F.lit("v"), F.col("obs_id") % 3).alias("variable")), written(s)
    samples = b.for_equal_boxes(_numbered_boxes(s, d), lambda boxes: cut(p.assemble_patches(boxes, names, _patches(s, d, "stack", boxes), (6, 7))), "number")
    one = p.collate_patches(samples, 8, cut).select("batch", "variable", "top_t", "top_h", "top_w", F.size("bboxes").alias("n_queries"), F.explode(F.arrays_zip("query_ids", "data")).alias("s"))
    return one.select("batch", "variable", "top_t", "top_h", "top_w", "n_queries", F.col("s.query_ids").alias("query_id"), F.posexplode("s.data").alias("k", "value")).withColumn("value", F.round(F.col("value").cast("double"), 3))


for _how in ("first", "last", "mean", "stack"):
    R.add(
        f"r2_patches_{_how}", lambda s, d, how=_how: b.for_equal_boxes(view(s, d, "boxes"), lambda boxes: rounded(_patches(s, d, how, boxes).drop("n_files"), 7)),
        f"WITH {patches_sql(_how)} SELECT query_id, variable, n_t, h, w, t, i, j, ROUND(value, 7) AS value FROM patches", "boxes", "obs",
    )
R.add(
    "r3_padded_batches", _patch_batches,
    f"""WITH {patches_sql('stack')}, numbers AS (SELECT query_id, ROW_NUMBER() OVER (ORDER BY query_id) - 1 AS number FROM boxes), shapes AS (SELECT DISTINCT query_id, variable, number // 8 AS batch, n_t, h, w FROM patches JOIN numbers USING (query_id)),
 tops AS (SELECT batch, variable, MAX(n_t) AS top_t, MAX(h) AS top_h, MAX(w) AS top_w FROM shapes GROUP BY ALL), sizes AS (SELECT number // 8 AS batch, CAST(COUNT(*) AS INT) AS n_queries FROM numbers GROUP BY 1)
 SELECT batch, shapes.variable, top_t, top_h, top_w, n_queries, shapes.query_id, CAST(k AS INT) AS k, ROUND(COALESCE(value, 0)::FLOAT::DOUBLE, 3) AS value FROM shapes JOIN tops USING (batch, variable) JOIN sizes USING (batch) JOIN range(2000) AS r(k) ON k < top_t*top_h*top_w
 LEFT JOIN patches p ON p.query_id = shapes.query_id AND p.variable = shapes.variable AND p.t = k // (top_h*top_w) AND p.j = k // top_w % top_h AND p.i = k % top_w""", "boxes", "obs",
)


def _statistics(s, d):
    """A class of equal boxes counts as often as it has members."""
    classes = b.equal_boxes(view(s, d, "boxes"))
    cells = _sample_cells(s, d, classes.drop("n_boxes")).join(classes.select("query_id", "n_boxes"), "query_id")
    return rounded(st.sample_statistics(cells, weight="n_boxes"), 5)


R.add(
    "a15_sample_statistics", _statistics,
    f"WITH {_SAMPLES} SELECT variable, ROUND(AVG(value), 5) AS mean, ROUND(STDDEV_POP(value), 5) AS std, ROUND(VAR_POP(value), 5) AS var, ROUND(MIN(value), 5) AS min, ROUND(MAX(value), 5) AS max, COUNT(value) AS count, ROUND(QUANTILE_CONT(value, 0.02), 5) AS p_low, ROUND(QUANTILE_CONT(value, 0.98), 5) AS p_high FROM own WHERE value IS NOT NULL GROUP BY 1", "boxes", "obs",
)


def _fields(s, d):
    cells = view(s, d, "cells")
    a, c = cells.where("product = 'l4_ssh'"), cells.where("product = 'glorys'")
    return m.co_located({"obs": a, "ref": c})


_BRIDGED = "CASE WHEN a IS NULL THEN vb WHEN b IS NULL OR a = b THEN va ELSE va + (vb-va)*(x-a)/(b-a) END"
_KNOWN = """LAST_VALUE(CASE WHEN val IS NOT NULL THEN x END IGNORE NULLS) OVER p AS a, LAST_VALUE(val IGNORE NULLS) OVER p AS va, FIRST_VALUE(CASE WHEN val IS NOT NULL THEN x END IGNORE NULLS) OVER f AS b, FIRST_VALUE(val IGNORE NULLS) OVER f AS vb"""


def lines_sql(keys: str, order: str, least: int, dx: float) -> str:
    """Tables line ... spec (keys, k, psd) over a table pts (keys, order column, val): spectra of lines as sums of cosines and sines."""
    return f"""line AS (SELECT {keys}, val, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) - 1 AS x, COUNT(*) OVER (PARTITION BY {keys}) AS n, COUNT(val) OVER (PARTITION BY {keys}) AS m FROM pts),
 filled AS (SELECT {keys}, x, n, {_BRIDGED} AS v, 0.5 - 0.5*COS(2*PI()*x/(n-1)) AS h FROM (SELECT *, {_KNOWN} FROM line WHERE n >= {least} AND m > 1 WINDOW p AS (PARTITION BY {keys} ORDER BY x ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY {keys} ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
 fit AS (SELECT {keys}, REGR_SLOPE(v, x) AS slope, REGR_INTERCEPT(v, x) AS base FROM filled GROUP BY ALL),
 dft AS (SELECT {keys}, n, q, SUM((v - slope*x - base)*h*COS(2*PI()*q*x/n)) AS re, SUM((v - slope*x - base)*h*SIN(2*PI()*q*x/n)) AS im, AVG(h*h) AS ww FROM filled JOIN fit USING ({keys}) JOIN range(1, 100000) AS t(q) ON q <= n // 2 GROUP BY ALL),
 spec AS (SELECT {keys}, q / (n*{dx}) AS k, (re*re + im*im) / (n*ww) * {dx} * CASE WHEN 2*q = n THEN 1 ELSE 2 END AS psd, COUNT(*) OVER (PARTITION BY {keys}) AS bins FROM dft WHERE re*re + im*im > 0 QUALIFY bins >= 5)"""


def average_sql(line: str, over: str, bins: int) -> str:
    """Tables over spec (line, over, k, psd): the geometric mean on a common log axis, as (over, bin, k, psd, n)."""
    return f"""logs AS (SELECT {line}, {over}, LOG10(k) AS x, LOG10(psd) AS y FROM spec), ends AS (SELECT {over}, CASE WHEN MAX(lo) < MIN(hi) THEN MAX(lo) ELSE MIN(lo) END AS x0, CASE WHEN MAX(lo) < MIN(hi) THEN MIN(hi) ELSE MAX(hi) END AS x1
 FROM (SELECT {line}, {over}, MIN(x) AS lo, MAX(x) AS hi FROM logs GROUP BY ALL) GROUP BY ALL),
 pieces AS (SELECT *, LEAD(x) OVER (PARTITION BY {line}, {over} ORDER BY x) AS xn, LEAD(y) OVER (PARTITION BY {line}, {over} ORDER BY x) AS yn FROM logs),
 hits AS (SELECT {line}, {over}, bin, ANY_VALUE(x0 + bin*(x1-x0)/({bins}-1)) AS spot, ARG_MIN(y + (yn-y)*(x0 + bin*(x1-x0)/({bins}-1) - x)/(xn-x), x) AS y FROM pieces JOIN ends USING ({over}) JOIN range({bins}) AS t(bin)
 ON x0 + bin*(x1-x0)/({bins}-1) BETWEEN x - 1e-9*(x1-x0)/({bins}-1) AND xn + 1e-9*(x1-x0)/({bins}-1) WHERE xn > x GROUP BY ALL),
 mean AS (SELECT {over}, CAST(bin AS INT) AS bin, POW(10, MIN(spot)) AS k, POW(10, AVG(y)) AS psd, COUNT(*) AS n FROM hits GROUP BY ALL)"""


def zonal_sql(keys: str, source: str, name: str, n: int = 36, dx: float = 10.0) -> str:
    """A table `name` (keys, bin, k, psd, n_rows) of zonal spectra of source (keys, i, j, val), means over the rows of a field."""
    return f"""{name}_rows AS (SELECT {keys}, j, x, val, COUNT(val) OVER (PARTITION BY {keys}, j) AS m FROM (SELECT DISTINCT {keys}, j FROM {source}) JOIN range({n}) AS t(x) ON TRUE LEFT JOIN (SELECT {keys}, j, i AS x, val FROM {source}) USING ({keys}, j, x)),
 {name}_filled AS (SELECT {keys}, j, x, {_BRIDGED} AS v, 0.5 - 0.5*COS(2*PI()*x/({n}-1)) AS h FROM (SELECT *, {_KNOWN} FROM {name}_rows WHERE m >= {n}*0.5 WINDOW p AS (PARTITION BY {keys}, j ORDER BY x ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY {keys}, j ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
 {name}_fit AS (SELECT {keys}, j, REGR_SLOPE(v, x) AS slope, REGR_INTERCEPT(v, x) AS base FROM {name}_filled GROUP BY ALL),
 {name} AS (SELECT {keys}, CAST(q - 1 AS INT) AS bin, q / ({n}*{dx}) AS k, AVG(2 / ({n}*{dx}) * (re*re + im*im)) AS psd, COUNT(*) AS n_rows FROM (SELECT {keys}, j, q, SUM((v - slope*x - base)*h*COS(2*PI()*q*x/{n})) AS re, SUM((v - slope*x - base)*h*SIN(2*PI()*q*x/{n})) AS im
 FROM {name}_filled JOIN {name}_fit USING ({keys}, j) JOIN range(1, {n // 2 + 1}) AS t(q) ON TRUE GROUP BY ALL) GROUP BY ALL)"""


#: A track's observations of a day are a line: its length is bounded, however many days there are.
_LINE = ("track_id", "obs_date")


def _lines(s, d):
    return sp.line_spectra(view(s, d, "obs"), _LINE, "obs_id", "val", 10.0, 16)


R.add("r6_line_spectra", lambda s, d: rounded(_lines(s, d)), f"WITH pts AS (SELECT track_id, obs_date, obs_id, val FROM obs), {lines_sql('track_id, obs_date', 'obs_id', 16, 10.0)} SELECT track_id, obs_date, ROUND(k, 6) AS k, ROUND(psd, 6) AS psd FROM spec", "obs")
R.add(
    "r7_field_spectra", lambda s, d: rounded(sp.field_spectra(view(s, d, "cells"), ("product", "obs_date"), 36, 18, 1.0, 1.3, 0.7)),
    """WITH own AS (SELECT product, obs_date, AVG(val) AS mean FROM cells GROUP BY ALL HAVING COUNT(val) >= 0.7*36*18), grid AS (SELECT product, obs_date, i, j, i - 17.5 AS x, j - 8.5 AS y, COALESCE(val, mean) - mean AS z, (0.5 - 0.5*COS(2*PI()*i/35)) * (0.5 - 0.5*COS(2*PI()*j/17)) AS w
 FROM own JOIN range(36) AS t(i) ON TRUE JOIN range(18) AS u(j) ON TRUE LEFT JOIN cells USING (product, obs_date, i, j)),
 fit AS (SELECT product, obs_date, SUM(x*z)/SUM(x*x) AS sx, SUM(y*z)/SUM(y*y) AS sy, AVG(w*w) AS ww FROM grid GROUP BY ALL), off AS (SELECT product, obs_date, i, j, ww, (z - sx*x - sy*y)*w AS z FROM grid JOIN fit USING (product, obs_date)),
 ahead AS (SELECT product, obs_date, j, p, ww, SUM(z*COS(2*PI()*p*i/36)) AS re, -SUM(z*SIN(2*PI()*p*i/36)) AS im FROM off JOIN range(36) AS t(p) ON TRUE GROUP BY ALL),
 spectrum AS (SELECT product, obs_date, p, q, ww, SUM(re*COS(2*PI()*q*j/18) + im*SIN(2*PI()*q*j/18)) AS re, SUM(im*COS(2*PI()*q*j/18) - re*SIN(2*PI()*q*j/18)) AS im FROM ahead JOIN range(18) AS t(q) ON TRUE GROUP BY ALL),
 rings AS (SELECT product, obs_date, FLOOR((SQRT(POW(LEAST(p, 36-p)/36.0, 2) + POW(LEAST(q, 18-q)/23.4, 2)) - 0.5/23.4) * 23.4) AS ring, (re*re + im*im) / (36*18*ww) * 1.3 AS power FROM spectrum)
 SELECT product, obs_date, ROUND((ring + 1)/23.4, 6) AS k, ROUND(AVG(power) * 2*PI()*(ring + 1)/23.4, 6) AS psd FROM rings WHERE ring BETWEEN 0 AND 8 GROUP BY product, obs_date, ring""", "cells",
)
R.add("r8_zonal_spectra", lambda s, d: rounded(sp.grid_rows_spectra(view(s, d, "cells"), ("product", "obs_date"), 36, 10.0)), f"WITH {zonal_sql('product, obs_date', 'cells', 'zonal')} SELECT product, obs_date, bin, ROUND(k, 6) AS k, ROUND(psd, 6) AS psd, n_rows FROM zonal", "cells")


def _zonal(s, d, column):
    own = m.anomalies(_fields(s, d).withColumn("diff", F.col("ref") - F.col("obs")).withColumnRenamed(column, "val").select("obs_date", "i", "j", "val"), "val", ("obs_date",))
    return sp.grid_rows_spectra(own, ("obs_date",), 36, 10.0)


def _three_spectra(s, d):
    """Of observations, reference and their differences."""
    one = lambda c: _zonal(s, d, c).select("obs_date", "bin", "k", F.col("psd").alias(c))
    return one("obs").join(one("ref").drop("k"), ["obs_date", "bin"]).join(one("diff").drop("k"), ["obs_date", "bin"])


_THREE = "fields AS (SELECT a.obs_date, a.i, a.j, a.val AS obs, b.val AS ref FROM cells a JOIN cells b ON a.product = 'l4_ssh' AND b.product = 'glorys' AND a.obs_date = b.obs_date AND a.i = b.i AND a.j = b.j), " + ", ".join(
    f"f_{c} AS (SELECT obs_date, i, j, {e} AS val FROM fields), {zonal_sql('obs_date', f'f_{c}', f's_{c}')}" for c, e in (("obs", "obs"), ("ref", "ref"), ("diff", "ref - obs"))
)
R.add("r9_difference_spectra", lambda s, d: rounded(_three_spectra(s, d)), f"WITH {_THREE} SELECT obs_date, bin, ROUND(a.k, 6) AS k, ROUND(a.psd, 6) AS obs, ROUND(b.psd, 6) AS ref, ROUND(c.psd, 6) AS diff FROM s_obs a JOIN s_ref b USING (obs_date, bin) JOIN s_diff c USING (obs_date, bin)", "cells")
R.add(
    "r10_average_spectra", lambda s, d: rounded(sp.average_spectra(_lines(s, d).withColumn("g", F.col("track_id") % 3), _LINE, ("g",), 50)),
    f"WITH pts AS (SELECT track_id, obs_date, track_id % 3 AS g, obs_id, val FROM obs), {lines_sql('track_id, obs_date, g', 'obs_id', 16, 10.0)}, {average_sql('track_id, obs_date', 'g', 50)} SELECT g, bin, ROUND(k, 6) AS k, ROUND(psd, 6) AS psd, n FROM mean", "obs",
)
R.add("r11_effective_resolution", lambda s, d: rounded(sp.effective_resolution(_zonal(s, d, "obs"), _zonal(s, d, "diff"), ("obs_date",))), f"WITH {_THREE} SELECT obs_date, ROUND(MIN(a.k), 6) AS k, ROUND(1/MIN(a.k), 6) AS wavelength FROM s_obs a JOIN s_diff c USING (obs_date, bin) WHERE c.psd/a.psd > 0.5 GROUP BY 1", "cells")


def _segment_spectra(s, d):
    """Spectra of qualified track segments, observed and of a grid sampled along them, averaged by product and date: one plan."""
    segments = t.with_segments(t.with_steps(view(s, d, "obs")))
    good = t.qualified_segments(segments, 300.0, 16, 0.9).select("track_id", "obs_date", "segment")
    sampled = m.right_neighbour(segments.join(good, ["track_id", "obs_date", "segment"], "left_semi"), view(s, d, "cells").where("product = 'glorys'"), -175.0, -85.0, 10.0, 36, 18)
    products = F.explode(F.array(F.struct(F.lit("track").alias("product"), F.col("val").alias("value")), F.struct(F.lit("grid").alias("product"), F.col("grid_val").alias("value"))))
    keys = ("track_id", "segment", "product", "obs_date")
    lines = sp.line_spectra(sampled.withColumn("p", products).select("track_id", "segment", "obs_date", "obs_id", "along_km", "p.*"), keys, ("along_km", "obs_id"), "value", 10.0, 16)
    return rounded(sp.average_spectra(lines, ("track_id", "segment"), ("product", "obs_date"), 40), 5)


R.add(
    "r12_segment_spectra", _segment_spectra,
    f"""WITH {STEPS}, {SEGMENTS}, good AS (SELECT track_id, obs_date, segment FROM segments GROUP BY ALL HAVING MAX(along_km)-MIN(along_km) >= 300 AND COUNT(*) >= 16 AND COUNT(val)/COUNT(*) > 0.9),
 kept AS (SELECT track_id, obs_date, segment, along_km, val AS own, CAST(GREATEST(0, LEAST(35, CEIL((lon+175)/10))) AS INT) AS i, CAST(GREATEST(0, LEAST(17, CEIL((lat+85)/10))) AS INT) AS j FROM segments JOIN good USING (track_id, obs_date, segment)),
 pts AS (SELECT track_id, obs_date, segment, 'track' AS product, along_km, own AS val FROM kept UNION ALL SELECT track_id, k.obs_date, segment, 'grid', along_km, c.val FROM kept k LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = k.obs_date AND c.i = k.i AND c.j = k.j),
 {lines_sql('track_id, segment, product, obs_date', 'along_km', 16, 10.0)}, {average_sql('track_id, segment', 'product, obs_date', 40)} SELECT product, obs_date, bin, ROUND(k, 5) AS k, ROUND(psd, 5) AS psd, n FROM mean""", "obs", "cells",
)


def _halves(s, d):
    """Observations with the half of the globe as their region: a day's track has too few points in an eighth."""
    return view(s, d, "obs").withColumn("region_id", F.when(F.col("lon") < 0, 0).otherwise(1))


_OF_HALVES = STEPS.replace("FROM obs", "FROM (SELECT *, CASE WHEN lon < 0 THEN 0 ELSE 1 END AS region_id FROM obs)").replace("PARTITION BY track_id, obs_date", "PARTITION BY track_id, obs_date, region_id")
_OF_HALVES += ", " + SEGMENTS.replace("SELECT track_id, obs_date, MEDIAN", "SELECT track_id, obs_date, region_id, MEDIAN").replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3").replace("s.track_id, s.obs_date", "s.track_id, s.obs_date, s.region_id").replace("s.obs_date = m.obs_date", "s.obs_date = m.obs_date AND s.region_id = m.region_id")
_SAMPLED = {
    "right": "SELECT k.*, c.val AS grid_val FROM (SELECT *, CAST(GREATEST(0, LEAST(35, CEIL((lon+175)/10))) AS INT) AS i, CAST(GREATEST(0, LEAST(17, CEIL((lat+85)/10))) AS INT) AS j FROM kept) k LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = k.obs_date AND c.i = k.i AND c.j = k.j",
    "bilinear": """SELECT k.*, g.grid_val FROM kept k LEFT JOIN (SELECT obs_id, CASE WHEN COUNT(val) = COUNT(*) THEN SUM(w*val) END AS grid_val FROM (SELECT obs_id, obs_date, CAST(FLOOR(x) + a AS INT) AS i, CAST(FLOOR(y) + b AS INT) AS j, (CASE WHEN a = 1 THEN x - FLOOR(x) ELSE 1 - (x - FLOOR(x)) END) * (CASE WHEN b = 1 THEN y - FLOOR(y) ELSE 1 - (y - FLOOR(y)) END) AS w
 FROM (SELECT *, (lon+175)/10 AS x, (lat+85)/10 AS y FROM kept), (VALUES (0), (1)) AS p(a), (VALUES (0), (1)) AS q(b)) n LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = n.obs_date AND c.i = n.i AND c.j = n.j WHERE w > 0 GROUP BY obs_id) g USING (obs_id)""",
}
for _method, _sql in _SAMPLED.items():
    R.add(
        f"r12_region_spectra_{_method}", lambda s, d, method=_method: rounded(sp.track_spectra(_halves(s, d), view(s, d, "cells").where("product = 'glorys'"), -175.0, -85.0, 10.0, (36, 18), method, min_points=10, min_valid=0.8, bins=40), 5),
        f"""WITH {_OF_HALVES}, good AS (SELECT track_id, obs_date, region_id, segment FROM segments GROUP BY ALL HAVING MAX(along_km)-MIN(along_km) >= 300 AND COUNT(*) >= 10 AND COUNT(val)/COUNT(*) > 0.8),
 kept AS (SELECT track_id, obs_date, region_id, segment, obs_id, lon, lat, along_km, val AS own FROM segments JOIN good USING (track_id, obs_date, region_id, segment)), both_values AS ({_sql}),
 pts AS (SELECT track_id, obs_date, region_id, segment, 'track' AS product, along_km, own AS val FROM both_values UNION ALL SELECT track_id, obs_date, region_id, segment, 'grid', along_km, grid_val FROM both_values),
 {lines_sql('track_id, segment, region_id, product, obs_date', 'along_km', 10, 10.0)}, {average_sql('track_id, segment', 'region_id, product, obs_date', 40)} SELECT region_id, product, obs_date, bin, ROUND(k, 5) AS k, ROUND(psd, 5) AS psd, n FROM mean""", "obs", "cells",
    )

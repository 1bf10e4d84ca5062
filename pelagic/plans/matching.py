"""Queries over matching and skill."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..fixtures import view
from ..functions.geo import bin_left, region_id
from ..functions.temporal import season
from ..operators import matching as m
from ..operators import skill as k
from ..operators import statistics as st
from ..sources.tables import save_bucketed, shared_folder
from .common import Registry, rounded

R = Registry()
_SEASON = "CASE WHEN MONTH(obs_date) IN (12,1,2) THEN 'DJF' WHEN MONTH(obs_date) < 6 THEN 'MAM' WHEN MONTH(obs_date) < 9 THEN 'JJA' ELSE 'SON' END"
_REGION = "CAST(FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90) AS INT)"
_PAIRS = """pairs AS (SELECT obs_id, o.obs_date, o.i, o.j, lon, lat, o.val AS obs, c.val AS ref FROM (SELECT *, CAST(FLOOR((lon+180)/10) AS INT) AS i, CAST(FLOOR((lat+90)/10) AS INT) AS j FROM obs WHERE val IS NOT NULL) o
 JOIN cells c ON c.product = 'glorys' AND o.obs_date = c.obs_date AND o.i = c.i AND o.j = c.j)"""
_FIELDS = "fields AS (SELECT a.obs_date, a.i, a.j, a.val AS obs, b.val AS ref FROM cells a JOIN cells b ON a.product = 'l4_ssh' AND b.product = 'glorys' AND a.obs_date = b.obs_date AND a.i = b.i AND a.j = b.j)"


def _grid(spark, sf, product="glorys"):
    return view(spark, sf, "cells").where(F.col("product") == product)


def _pairs(spark, sf):
    points = view(spark, sf, "obs").where("val IS NOT NULL").withColumns({"i": F.floor((F.col("lon") + 180) / 10).cast("int"), "j": F.floor((F.col("lat") + 90) / 10).cast("int")})
    return m.both_valid(points.withColumnRenamed("val", "value"), _grid(spark, sf), also=("obs_id", "lon", "lat"))


def _fields(spark, sf):
    a, b = _grid(spark, sf, "l4_ssh"), _grid(spark, sf, "glorys")
    return m.co_located({"obs": a, "ref": b})


def _kept_sums(spark, sf):
    """Differences by season from kept states of their days."""
    states = st.day_states(_pairs(spark, sf).withColumns({"season": season(F.col("obs_date")), "d": F.col("ref") - F.col("obs")}), ("season",), "d")
    path = f"{shared_folder(spark)}/states-{uuid4().hex}"
    st.keep_states(states, path)
    return rounded(st.merged_states(st.read_states(spark, path, states.schema), ("season",)).select("season", "n", "mean", "std", "min", "max"))


R.add(
    "j4_nearest_match", lambda s, d: rounded(m.nearest_match(view(s, d, "obs").withColumn("region_id", region_id(F.col("lon"), F.col("lat"))), _grid(s, d).withColumn("region_id", region_id(F.col("i") * 10 - 175.0, F.col("j") * 10 - 85.0)), -175.0, -85.0, 10.0, 4.6, ("obs_date", "region_id")).select("obs_id", "obs_date", "i", "j", "val", "grid_val"), 10),
    """SELECT obs_id, o.obs_date, o.i, o.j, o.val, ROUND(c.val, 10) AS grid_val FROM (SELECT *, CAST(ROUND((lon+175)/10) AS INT) AS i, CAST(ROUND((lat+85)/10) AS INT) AS j FROM obs) o LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = o.obs_date AND c.i = o.i AND c.j = o.j AND c.i // 9 + 4*(c.j // 9) = FLOOR((lon+180)/90) + 4*FLOOR((lat+90)/90)
 WHERE GREATEST(ABS(lon - (-175 + o.i*10)), ABS(lat - (-85 + o.j*10))) <= 4.6""", "obs", "cells",
)
R.add(
    "j4_nearest_on_axis", lambda s, d: m.nearest_on_axis(view(s, d, "obs").select("obs_id", "lat"), _grid(s, d).select(F.col("j").alias("idx")).distinct().select("idx", (F.col("idx") * F.col("idx") * 0.5 - 85.0).alias("coord")), "lat", 3.0, 3.0).select("obs_id", "idx"),
    """WITH axis AS (SELECT DISTINCT j AS idx, j*j*0.5 - 85.0 AS coord FROM cells WHERE product = 'glorys') SELECT obs_id, idx FROM (SELECT obs_id, idx, ROW_NUMBER() OVER (PARTITION BY obs_id ORDER BY ABS(lat - coord), coord) AS r FROM obs JOIN axis ON ABS(lat - coord) <= 3.0) WHERE r = 1""", "obs", "cells",
)
_BILINEAR = """corners AS (SELECT obs_id, obs_date, CAST(FLOOR(x) + a AS INT) AS i, CAST(FLOOR(y) + b AS INT) AS j, (CASE WHEN a = 1 THEN x - FLOOR(x) ELSE 1 - (x - FLOOR(x)) END) * (CASE WHEN b = 1 THEN y - FLOOR(y) ELSE 1 - (y - FLOOR(y)) END) AS w
 FROM (SELECT *, (lon+175)/10 AS x, (lat+85)/10 AS y FROM obs), (VALUES (0), (1)) AS p(a), (VALUES (0), (1)) AS q(b){where})"""
R.add(
    "j5_bilinear", lambda s, d: rounded(m.bilinear(view(s, d, "obs"), _grid(s, d), -175.0, -85.0, 10.0)),
    f"WITH {_BILINEAR.format(where='')} SELECT obs_id, k.obs_date, CASE WHEN COUNT(val) = COUNT(*) THEN ROUND(SUM(w*val), 6) END AS grid_val FROM corners k LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = k.obs_date AND c.i = k.i AND c.j = k.j WHERE w > 0 GROUP BY 1, 2", "obs", "cells",
)
R.add(
    "j5_stored_grid", lambda s, d: rounded(m.bilinear(view(s, d, "obs"), save_bucketed(_grid(s, d), buckets=8), -175.0, -85.0, 10.0)),
    f"WITH {_BILINEAR.format(where='')} SELECT obs_id, k.obs_date, CASE WHEN COUNT(val) = COUNT(*) THEN ROUND(SUM(w*val), 6) END AS grid_val FROM corners k LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = k.obs_date AND c.i = k.i AND c.j = k.j WHERE w > 0 GROUP BY 1, 2", "obs", "cells",
)
R.add(
    "j6_bilinear_filled", lambda s, d: rounded(m.bilinear(view(s, d, "obs"), _grid(s, d), -175.0, -85.0, 10.0, fill=0.0, n_i=36, n_j=18)),
    f"WITH {_BILINEAR.format(where=' WHERE x BETWEEN 0 AND 35 AND y BETWEEN 0 AND 17')} SELECT obs_id, k.obs_date, ROUND(SUM(w*COALESCE(val, 0)), 6) AS grid_val FROM corners k LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = k.obs_date AND c.i = k.i AND c.j = k.j WHERE w > 0 GROUP BY 1, 2", "obs", "cells",
)
R.add(
    "j7_nearest_regrid", lambda s, d: rounded(m.nearest_match(view(s, d, "obs").where("lon BETWEEN -175 AND 175 AND lat BETWEEN -85 AND 85"), _grid(s, d), -175.0, -85.0, 10.0, None).select("obs_id", "grid_val"), 10),
    """SELECT obs_id, ROUND(c.val, 10) AS grid_val FROM (SELECT *, CAST(ROUND((lon+175)/10) AS INT) AS i, CAST(ROUND((lat+85)/10) AS INT) AS j FROM obs WHERE lon BETWEEN -175 AND 175 AND lat BETWEEN -85 AND 85) o LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = o.obs_date AND c.i = o.i AND c.j = o.j""", "obs", "cells",
)
R.add(
    "j8_right_neighbour", lambda s, d: rounded(m.right_neighbour(view(s, d, "obs"), _grid(s, d), -175.0, -85.0, 10.0, 36, 18).select("obs_id", "i", "j", "grid_val"), 10),
    """SELECT obs_id, o.i, o.j, ROUND(c.val, 10) AS grid_val FROM (SELECT *, CAST(GREATEST(0, LEAST(35, CEIL((lon+175)/10))) AS INT) AS i, CAST(GREATEST(0, LEAST(17, CEIL((lat+85)/10))) AS INT) AS j FROM obs) o LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = o.obs_date AND c.i = o.i AND c.j = o.j""", "obs", "cells",
)
R.add("j9_both_valid", lambda s, d: rounded(_pairs(s, d), 10), f"WITH {_PAIRS} SELECT * REPLACE (ROUND(ref, 10) AS ref, ROUND(obs, 10) AS obs, ROUND(lon, 10) AS lon, ROUND(lat, 10) AS lat) FROM pairs", "obs", "cells")


def _stored_pairs(spark, sf, of):
    """The pairs of two stored products, both in buckets by day and cell."""
    points = view(spark, sf, "obs").where("val IS NOT NULL").withColumns({"i": F.floor((F.col("lon") + 180) / 10).cast("int"), "j": F.floor((F.col("lat") + 90) / 10).cast("int")})
    return of(save_bucketed(points.withColumnRenamed("val", "value").drop("obs_time"), buckets=8), save_bucketed(_grid(spark, sf), buckets=8))


R.add("j9_stored_pairs", lambda s, d: rounded(_stored_pairs(s, d, lambda a, g: m.both_valid(a, g, also=("obs_id", "lon", "lat"))), 10), f"WITH {_PAIRS} SELECT * REPLACE (ROUND(ref, 10) AS ref, ROUND(obs, 10) AS obs, ROUND(lon, 10) AS lon, ROUND(lat, 10) AS lat) FROM pairs", "obs", "cells")
R.add("j10_co_located", lambda s, d: rounded(_fields(s, d), 10), f"WITH {_FIELDS} SELECT obs_date, i, j, ROUND(obs, 10) AS obs, ROUND(ref, 10) AS ref FROM fields", "cells")
R.add(
    "f16_surface_level", lambda s, d: m.surface_level(view(s, d, "profiles")),
    """SELECT profile_id, lon, lat, obs_date, pres, temp, psal FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY profile_id ORDER BY pres, level, l_partkey, l_suppkey) AS r FROM profiles WHERE pres < 5) WHERE r = 1""", "profiles",
)
R.add("w6_anomalies", lambda s, d: rounded(m.anomalies(view(s, d, "cells"), "val", ("product", "obs_date"))), "SELECT product, obs_date, i, j, ROUND(val - AVG(val) OVER (PARTITION BY product, obs_date), 6) AS val FROM cells", "cells")
R.add(
    "a31_transect", lambda s, d: rounded(m.transect(view(s, d, "cells"), 12, 1, ("product", "obs_date")), 9),
    """WITH near AS (SELECT product, obs_date, j, AVG(val) FILTER (WHERE i = 12) AS own, AVG(val) AS wide FROM cells WHERE ABS(i - 12) <= 1 GROUP BY 1, 2, 3),
 dense AS (SELECT n.product, n.obs_date, COUNT(own) > ANY_VALUE(r.n) / 2 AS is_dense FROM near n JOIN (SELECT product, obs_date, COUNT(DISTINCT j) AS n FROM cells GROUP BY 1, 2) r USING (product, obs_date) GROUP BY 1, 2)
 SELECT product, obs_date, j, ROUND(CASE WHEN is_dense THEN own ELSE wide END, 9) AS value FROM near JOIN dense USING (product, obs_date)""", "cells",
)
R.add(
    "a16_binned_sums", lambda s, d: rounded(k.binned_sums(_pairs(s, d)), 5),
    f"""WITH {_PAIRS}, keyed AS (SELECT LEAST(179, CAST(FLOOR((lon+180)/2) AS INT)) AS bi, LEAST(89, CAST(FLOOR((lat+90)/2) AS INT)) AS bj, {_SEASON} AS season, LEAST(35, CAST(FLOOR((lat+90)/5) AS INT)) AS band, CAST(MONTH(obs_date) AS INT) AS month, {_REGION} AS region_id, ref - obs AS d FROM pairs),
 sums AS (SELECT bi, bj, season, band, month, region_id, GROUPING(bi, bj, season, band, month, region_id) AS level, SUM(d) AS s, SUM(d*d) AS sq, COUNT(d) AS n FROM keyed GROUP BY GROUPING SETS ((bi, bj), (season, bi, bj), (band, month), (region_id, month), ()))
 SELECT bi, bj, season, band, month, region_id, level, n, CASE WHEN n >= 5 THEN ROUND(s/n, 5) END AS bias, CASE WHEN n >= 5 THEN ROUND(SQRT(sq/n), 5) END AS rmse, CASE WHEN n >= 5 THEN ROUND(SQRT(GREATEST(sq/n - (s/n)*(s/n), 0)), 5) END AS spread FROM sums""", "obs", "cells",
)
_GLOBAL = """SELECT {keys}COUNT(*) AS n, AVG(ref-obs) AS bias, SQRT(AVG((ref-obs)*(ref-obs))) AS rmse, CORR(obs, ref) AS r, STDDEV_POP(obs) AS so, STDDEV_POP(ref) AS sr FROM {source}{group}"""
_GLOBAL_OUT = "{keys}n, ROUND(bias, 6) AS bias, ROUND(rmse, 6) AS rmse, ROUND(SQRT(GREATEST(rmse*rmse-bias*bias, 0)), 6) AS crmse, ROUND(r, 6) AS r, ROUND(sr/so, 6) AS std_ratio, ROUND(bias/so, 6) AS norm_bias, ROUND(SQRT(GREATEST(rmse*rmse-bias*bias, 0))/so, 6) AS norm_crmse"
R.add("a18_global_skill", lambda s, d: rounded(k.global_skill(_pairs(s, d))), f"WITH {_PAIRS} SELECT {_GLOBAL_OUT.format(keys='')} FROM ({_GLOBAL.format(keys='', source='pairs', group='')})", "obs", "cells")
R.add(
    "c24_diagram_points", lambda s, d: rounded(k.diagram_points(k.global_skill(_fields(s, d), ("obs_date",))), 5),
    f"""WITH {_FIELDS}, g AS ({_GLOBAL.format(keys='obs_date, ', source='fields', group=' GROUP BY 1')}), o AS (SELECT obs_date, n, bias, rmse, r, SQRT(GREATEST(rmse*rmse-bias*bias, 0)) AS crmse, sr/so AS std_ratio, bias/so AS norm_bias, SQRT(GREATEST(rmse*rmse-bias*bias, 0))/so AS norm_crmse FROM g)
 SELECT obs_date, n, ROUND(bias, 5) AS bias, ROUND(rmse, 5) AS rmse, ROUND(crmse, 5) AS crmse, ROUND(r, 5) AS r, ROUND(std_ratio, 5) AS std_ratio, ROUND(norm_bias, 5) AS norm_bias, ROUND(norm_crmse, 5) AS norm_crmse, ROUND(ACOS(r), 5) AS theta, ROUND(std_ratio, 5) AS radius,
 ROUND(CASE WHEN std_ratio >= 1 THEN norm_crmse ELSE -norm_crmse END, 5) AS target_x, ROUND(norm_bias, 5) AS target_y FROM o""", "cells",
)
#: The p-value as a quotient of two integrals of powers of a cosine, by Simpson's rule: over what lies beyond the correlation, and over all.
_P_SQL = """, p AS (SELECT g.{key} AS p_key, SUM(w*POW(COS(low + k*(PI()/2 - low)/4000), n - 3))*(PI()/2 - ANY_VALUE(low)) / (SUM(w*POW(COS(k*PI()/8000), n - 3))*PI()/2) AS p_value
 FROM (SELECT {key}, COUNT(*) AS n, ASIN(ABS(CORR(obs, ref))) AS low FROM ({source}) GROUP BY 1 HAVING COUNT(*) >= 3) g, (SELECT k, CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(4001) AS t(k)) GROUP BY 1)"""
_PAIR_SQL = "COUNT(*) AS n, ROUND(AVG(ref-obs), 6) AS bias, ROUND(SQRT(AVG((ref-obs)*(ref-obs))), 6) AS rmse, ROUND(CORR(obs, ref), 6) AS r, ROUND(STDDEV_SAMP(obs), 6) AS std_obs, ROUND(STDDEV_SAMP(ref), 6) AS std_ref, ROUND(STDDEV_POP(ref-obs), 6) AS crmse, ROUND(CORR(obs, ref)*SQRT((COUNT(*)-2)/(1-POW(CORR(obs, ref), 2))), 6) AS t, ROUND(STDDEV_SAMP(ref)/STDDEV_SAMP(obs), 6) AS std_ratio, ROUND(AVG(ref-obs)/STDDEV_SAMP(obs), 6) AS norm_bias, ROUND(STDDEV_POP(ref-obs)/STDDEV_SAMP(obs), 6) AS norm_crmse, ROUND(ANY_VALUE(p_value), 6) AS p_value"
R.add("a19_pair_skill", lambda s, d: rounded(k.pair_skill(_pairs(s, d), ("obs_date",))), f"WITH {_PAIRS}{_P_SQL.format(key='obs_date', source='SELECT * FROM pairs')} SELECT obs_date, {_PAIR_SQL} FROM pairs JOIN p ON p_key = obs_date GROUP BY 1 HAVING COUNT(*) >= 3", "obs", "cells")
R.add(
    "a16_kept_sums", lambda s, d: _kept_sums(s, d),
    f"WITH {_PAIRS} SELECT {_SEASON} AS season, COUNT(*) AS n, ROUND(AVG(ref-obs), 6) AS mean, ROUND(STDDEV_POP(ref-obs), 6) AS std, ROUND(MIN(ref-obs), 6) AS min, ROUND(MAX(ref-obs), 6) AS max FROM pairs GROUP BY 1", "obs", "cells",
)
R.add("a23_seasonal_skill", lambda s, d: rounded(k.pair_skill(_pairs(s, d).withColumn("season", season(F.col("obs_date"))), ("season",))), f"WITH {_PAIRS}{_P_SQL.format(key='season', source=f'SELECT *, {_SEASON} AS season FROM pairs')} SELECT season, {_PAIR_SQL} FROM (SELECT *, {_SEASON} AS season FROM pairs) JOIN p ON p_key = season GROUP BY 1 HAVING COUNT(*) >= 3", "obs", "cells")
R.add(
    "a20_binned_bias", lambda s, d: rounded(k.binned_bias(_pairs(s, d))),
    f"WITH {_PAIRS} SELECT bi, bj, ROUND(AVG(ref-obs), 6) AS bias, COUNT(*) AS n FROM (SELECT *, CAST(CEIL((lon+180)/2) - 1 AS INT) AS bi, CAST(CEIL((lat+90)/2) - 1 AS INT) AS bj FROM pairs) WHERE bi BETWEEN 0 AND 179 AND bj BETWEEN 0 AND 89 GROUP BY 1, 2 HAVING COUNT(*) >= 3", "obs", "cells",
)
_BIAS = "ROUND(AVG(ref-obs), 6) AS bias, ROUND(STDDEV_SAMP(ref-obs), 6) AS std, COUNT(*) AS n"
R.add("a21_band_month_bias", lambda s, d: rounded(k.bias_by(_pairs(s, d), bin_left(F.col("lat"), -90.0, 5.0, 36), "band")), f"WITH {_PAIRS} SELECT LEAST(35, CAST(FLOOR((lat+90)/5) AS INT)) AS band, CAST(DATE_TRUNC('month', obs_date) AS DATE) AS month, {_BIAS} FROM pairs GROUP BY 1, 2 HAVING COUNT(*) >= 3", "obs", "cells")
R.add("a21_band_bias", lambda s, d: rounded(k.bias_by(_pairs(s, d), bin_left(F.col("lat"), -90.0, 5.0, 36), "band", month=False)), f"WITH {_PAIRS} SELECT LEAST(35, CAST(FLOOR((lat+90)/5) AS INT)) AS band, {_BIAS} FROM pairs GROUP BY 1 HAVING COUNT(*) >= 3", "obs", "cells")
R.add("a22_region_month_bias", lambda s, d: rounded(k.regional_bias(_pairs(s, d), 500)), f"WITH {_PAIRS} SELECT region_id, CAST(DATE_TRUNC('month', obs_date) AS DATE) AS month, {_BIAS} FROM (SELECT *, {_REGION} AS region_id, COUNT(*) OVER (PARTITION BY {_REGION}) AS k FROM pairs) WHERE k >= 500 GROUP BY 1, 2 HAVING COUNT(*) >= 3", "obs", "cells")
R.add(
    "a23_seasonal_bias", lambda s, d: rounded(k.seasonal_bias(_pairs(s, d))),
    f"""WITH {_PAIRS} SELECT season, bi, bj, ROUND(AVG(ref-obs), 6) AS bias, COUNT(*) AS n FROM (SELECT *, {_SEASON} AS season, COUNT(*) OVER (PARTITION BY {_SEASON}) AS k, CAST(CEIL((lon+180)/2) - 1 AS INT) AS bi, CAST(CEIL((lat+90)/2) - 1 AS INT) AS bj FROM pairs)
 WHERE k >= 10 AND bi BETWEEN 0 AND 179 AND bj BETWEEN 0 AND 89 GROUP BY 1, 2, 3 HAVING COUNT(*) >= 3""", "obs", "cells",
)
R.add(
    "a24_scatter_density", lambda s, d: rounded(k.scatter_density(_fields(s, d), 0.0, 2.0)),
    f"WITH {_FIELDS} SELECT LEAST(79, CAST(FLOOR(obs/0.025) AS INT)) AS x, LEAST(79, CAST(FLOOR(ref/0.025) AS INT)) AS y, COUNT(*) AS n, ROUND(LOG10(COUNT(*)), 6) AS log_n FROM fields WHERE obs BETWEEN 0 AND 2 AND ref BETWEEN 0 AND 2 GROUP BY 1, 2", "cells",
)
_REGR = "COUNT(*) AS n, ROUND(CORR(ref, obs), 6) AS r, ROUND(REGR_SLOPE(ref, obs), 6) AS slope, ROUND(REGR_INTERCEPT(ref, obs), 6) AS intercept, ROUND(REGR_R2(ref, obs), 6) AS r2"
R.add("a24_regression", lambda s, d: rounded(k.regression(_pairs(s, d))), f"WITH {_PAIRS} SELECT {_REGR} FROM pairs", "obs", "cells")
R.add("a27_regional_coupling", lambda s, d: rounded(k.regression(_fields(s, d).withColumn("region_id", F.floor(F.col("i") / 9) + 4 * F.floor(F.col("j") / 9)), ("region_id",))), f"WITH {_FIELDS} SELECT i // 9 + 4 * (j // 9) AS region_id, {_REGR} FROM fields GROUP BY 1", "cells")
R.add(
    "a28_pooled_sample", lambda s, d: rounded(k.regression(k.hash_sample(_pairs(s, d), "obs_id", 20))),
    f"WITH {_PAIRS} SELECT {_REGR} FROM pairs WHERE ('0x' || SUBSTR(MD5('42|' || obs_id), 1, 8))::BIGINT % 100 < 20", "obs", "cells",
)
R.add(
    "a25_box_plot", lambda s, d: rounded(k.box_plot(_pairs(s, d), region_id(F.col("lon"), F.col("lat")), "region_id")),
    f"""WITH {_PAIRS}, d AS (SELECT {_REGION} AS region_id, ref - obs AS d FROM pairs), q AS (SELECT region_id, COUNT(*) AS n, QUANTILE_CONT(d, 0.25) AS q1, QUANTILE_CONT(d, 0.5) AS q2, QUANTILE_CONT(d, 0.75) AS q3 FROM d GROUP BY 1 HAVING COUNT(*) >= 3)
 SELECT region_id, n, ROUND(q1, 6) AS q1, ROUND(q2, 6) AS q2, ROUND(q3, 6) AS q3, ROUND(MIN(d), 6) AS low, ROUND(MAX(d), 6) AS high FROM d JOIN q USING (region_id) WHERE d BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1) GROUP BY ALL""", "obs", "cells",
)
R.add("a26_bias_limit", lambda s, d: rounded(k.bias_limit(_pairs(s, d))), f"WITH {_PAIRS} SELECT ROUND(GREATEST(QUANTILE_CONT(ABS(ref-obs), 0.95), 0.05), 6) AS bias_limit FROM pairs", "obs", "cells")
R.add(
    "a29_temporal_correlation", lambda s, d: rounded(k.temporal_correlation(_fields(s, d))),
    f"WITH {_FIELDS} SELECT i, j, COUNT(DISTINCT obs_date) AS n, CASE WHEN COUNT(DISTINCT obs_date) = (SELECT DATE_DIFF('day', MIN(obs_date), MAX(obs_date)) + 1 FROM fields) THEN ROUND(CORR(obs, ref), 6) END AS r FROM fields GROUP BY 1, 2", "cells",
)
R.add(
    "a33_error_map", lambda s, d: rounded(k.error_map(_fields(s, d), ("obs_date",))),
    f"""WITH {_FIELDS} SELECT obs_date, ROUND(SQRT(AVG(d*d)), 6) AS rmse, ROUND(AVG(ABS(d)), 6) AS mae, COUNT(*) AS n FROM (SELECT obs_date, (ref - AVG(ref) OVER w) - (obs - AVG(obs) OVER w) AS d FROM fields WINDOW w AS (PARTITION BY obs_date)) GROUP BY 1""", "cells",
)
R.add(
    "a32_pair_agreement", lambda s, d: rounded(k.pair_skill(m.bilinear(view(s, d, "obs"), _grid(s, d), -175.0, -85.0, 10.0, fill=0.0, n_i=36, n_j=18).join(view(s, d, "obs").where("val IS NOT NULL").select("obs_id", F.col("val").alias("obs")), "obs_id").withColumnRenamed("grid_val", "ref"), (), 10).select("n", "r", "rmse"), 5),
    f"""WITH {_BILINEAR.format(where=' WHERE x BETWEEN 0 AND 35 AND y BETWEEN 0 AND 17')}, g AS (SELECT obs_id, SUM(w*COALESCE(val, 0)) AS ref FROM corners k LEFT JOIN cells c ON c.product = 'glorys' AND c.obs_date = k.obs_date AND c.i = k.i AND c.j = k.j WHERE w > 0 GROUP BY 1)
 SELECT COUNT(*) AS n, ROUND(CORR(val, ref), 5) AS r, ROUND(SQRT(AVG((ref-val)*(ref-val))), 5) AS rmse FROM g JOIN obs USING (obs_id) WHERE val IS NOT NULL""", "obs", "cells",
)

"""Queries over tracks, packing and statistics."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..dims import VARIABLES
from ..fixtures import view
from ..functions import codec
from ..operators import statistics as st
from ..operators import tracks as t
from ..sources.tables import shared_folder
from .common import Registry, rounded

R = Registry()
_HAV = "12742*ATAN2(SQRT(a), SQRT(1-a))"
STEPS = f"""lagged AS (SELECT *, LAG(lon) OVER w AS lon0, LAG(lat) OVER w AS lat0 FROM obs WINDOW w AS (PARTITION BY track_id, obs_date ORDER BY lat, obs_id)),
 hav AS (SELECT *, POW(SIN(RADIANS(lat-lat0)/2), 2) + COS(RADIANS(lat0))*COS(RADIANS(lat))*POW(SIN(RADIANS(lon-lon0)/2), 2) AS a FROM lagged),
 steps AS (SELECT *, SUM(step_km) OVER (PARTITION BY track_id, obs_date ORDER BY lat, obs_id ROWS UNBOUNDED PRECEDING) AS along_km FROM (SELECT *, COALESCE({_HAV}, 0) AS step_km FROM hav))"""
SEGMENTS = """med AS (SELECT track_id, obs_date, MEDIAN(step_km) AS median_km FROM steps WHERE step_km > 0 GROUP BY 1, 2),
 segments AS (SELECT s.*, m.median_km, SUM(CASE WHEN step_km > 3*m.median_km THEN 1 ELSE 0 END) OVER (PARTITION BY s.track_id, s.obs_date ORDER BY lat, obs_id ROWS UNBOUNDED PRECEDING) AS segment FROM steps s LEFT JOIN med m ON s.track_id = m.track_id AND s.obs_date = m.obs_date)"""


def _obs(s, d):
    return view(s, d, "obs")


def _segments(s, d):
    return t.with_segments(t.with_steps(_obs(s, d)))


R.add("w1_w2_track_steps", lambda s, d: t.with_steps(_obs(s, d)).select("obs_id", F.round("step_km", 4).alias("step_km"), F.round("along_km", 4).alias("along_km")), f"WITH {STEPS} SELECT obs_id, ROUND(step_km, 4) AS step_km, ROUND(along_km, 4) AS along_km FROM steps", "obs")
R.add("w3_track_segments", lambda s, d: _segments(s, d).select("obs_id", "segment"), f"WITH {STEPS}, {SEGMENTS} SELECT obs_id, CAST(segment AS BIGINT) AS segment FROM segments", "obs")
R.add(
    "w4_qualified_segments", lambda s, d: rounded(t.qualified_segments(_segments(s, d), 300.0, 8, 0.8), 4),
    f"WITH {STEPS}, {SEGMENTS} SELECT track_id, obs_date, CAST(segment AS BIGINT) AS segment, ROUND(MAX(along_km)-MIN(along_km), 4) AS length_km, COUNT(*) AS n, ROUND(COUNT(val)/COUNT(*), 4) AS valid FROM segments GROUP BY 1,2,3 HAVING MAX(along_km)-MIN(along_km) >= 300 AND COUNT(*) >= 8 AND COUNT(val)/COUNT(*) > 0.8", "obs",
)
R.add(
    "k7_first_usable_date", lambda s, d: t.first_usable_date(t.qualified_segments(_segments(s, d), 300.0, 8, 0.8), _obs(s, d)),
    f"WITH {STEPS}, {SEGMENTS} SELECT COALESCE(MIN(obs_date), (SELECT MIN(obs_date) FROM obs)) AS obs_date FROM (SELECT obs_date FROM segments GROUP BY track_id, obs_date, segment HAVING MAX(along_km)-MIN(along_km) >= 300 AND COUNT(*) >= 8 AND COUNT(val)/COUNT(*) > 0.8)", "obs",
)
R.add(
    "w5_column_segments", lambda s, d: rounded(t.column_segments(view(s, d, "cells").withColumn("j", F.col("j") * F.col("j")), 7), 10),
    """SELECT product, obs_date, i, j, ROUND(val, 10) AS val, CAST(SUM(is_new) OVER (PARTITION BY product, obs_date, i ORDER BY j ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
 FROM (SELECT *, CASE WHEN j - LAG(j) OVER (PARTITION BY product, obs_date, i ORDER BY j) > 7 THEN 1 ELSE 0 END AS is_new FROM (SELECT * REPLACE (j*j AS j) FROM cells))""", "cells",
)
R.add(
    "w9_densest_band", lambda s, d: t.densest_band(view(s, d, "cells"), 5, ("product", "obs_date")),
    """WITH full_ AS (SELECT k.product, k.obs_date, CAST(r AS INT) AS i, COUNT(c.val) AS n FROM (SELECT DISTINCT product, obs_date FROM cells) k CROSS JOIN range(36) AS x(r) LEFT JOIN cells c ON c.product = k.product AND c.obs_date = k.obs_date AND c.i = r GROUP BY 1,2,3),
 w AS (SELECT *, SUM(n) OVER (PARTITION BY product, obs_date ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS total FROM full_)
 SELECT product, obs_date, first_i, CAST(total AS BIGINT) AS total FROM (SELECT product, obs_date, i AS first_i, total, ROW_NUMBER() OVER (PARTITION BY product, obs_date ORDER BY total DESC, i) AS r FROM w WHERE i <= 31) WHERE r = 1""", "cells",
)
_WAY = """{name} AS (SELECT track_id, obs_date, MEDIAN({hav}) AS km FROM (SELECT *, POW(SIN(RADIANS(lat-lat0)/2), 2) + COS(RADIANS(lat0))*COS(RADIANS(lat))*POW(SIN(RADIANS(lon-lon0)/2), 2) AS a FROM (SELECT *, LAG(lon) OVER w AS lon0, LAG(lat) OVER w AS lat0
 FROM obs WINDOW w AS (PARTITION BY track_id, obs_date ORDER BY {order}, obs_id))) WHERE {hav} > 0 GROUP BY 1, 2)"""
R.add(
    "w10_order_choice", lambda s, d: t.order_choice(_obs(s, d), 9000.0).select("track_id", "obs_date", F.round("by_lat", 3).alias("by_lat"), F.round("by_lon", 3).alias("by_lon"), "order_by"),
    f"""WITH {_WAY.format(name='ways_lat', hav=_HAV, order='lat, lon')}, {_WAY.format(name='ways_lon', hav=_HAV, order='lon, lat')} SELECT track_id, obs_date, ROUND(p.km, 3) AS by_lat, ROUND(q.km, 3) AS by_lon,
 CASE WHEN ABS(p.km - 9000) <= ABS(q.km - 9000) THEN 'lat' ELSE 'lon' END AS order_by FROM ways_lat p JOIN ways_lon q USING (track_id, obs_date)""", "obs",
)
R.add(
    "w12_every_nth", lambda s, d: t.every_nth(_obs(s, d).where("val IS NOT NULL"), 5, ("lat", "lon", "obs_id"), ("track_id",), F.floor("lat")),
    "SELECT * EXCLUDE (r, n) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY track_id ORDER BY lat, lon, obs_id) AS r, COUNT(*) OVER (PARTITION BY track_id) AS n FROM obs WHERE val IS NOT NULL) WHERE n <= 500 OR (r - 1) % 5 = 0", "obs",
)
R.add(
    "w13_fill_gaps", lambda s, d: t.fill_gaps(_obs(s, d), ("track_id", "obs_date"), "obs_id", "val").select("obs_id", F.round("filled", 9).alias("filled")),
    """SELECT obs_id, ROUND(CASE WHEN a IS NULL THEN vb WHEN b IS NULL OR b = a THEN va ELSE va + (vb-va)*(obs_id-a)/(b-a) END, 9) AS filled FROM (SELECT obs_id,
 LAST_VALUE(CASE WHEN val IS NOT NULL THEN obs_id END IGNORE NULLS) OVER p AS a, LAST_VALUE(val IGNORE NULLS) OVER p AS va, FIRST_VALUE(CASE WHEN val IS NOT NULL THEN obs_id END IGNORE NULLS) OVER f AS b, FIRST_VALUE(val IGNORE NULLS) OVER f AS vb
 FROM obs WINDOW p AS (PARTITION BY track_id, obs_date ORDER BY obs_id ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY track_id, obs_date ORDER BY obs_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""", "obs",
)
_PACKED = "packed AS (SELECT product, obs_date, i, j, val AS orig, ROUND_EVEN(val / 0.0005, 0)::INT AS p, ROUND_EVEN(val / 0.0005, 0)::INT * 0.0005 + 0.0 AS packed FROM cells)"


def _packed(s, d):
    cells = view(s, d, "cells").withColumnRenamed("val", "orig").withColumn("p", codec.pack(F.col("orig"), 0.0005, 0.0))
    return cells.withColumn("packed", codec.unpack(F.col("p"), 0.0005, 0.0))


R.add("c11_pack", lambda s, d: rounded(_packed(s, d).select("product", "obs_date", "i", "j", "p", "packed"), 8), f"WITH {_PACKED} SELECT product, obs_date, i, j, p, ROUND(packed, 8) AS packed FROM packed", "cells")
#: The variables of all sources, and names that one rule or another takes.
_NAMES = [
    *dict.fromkeys(v for _, _, v, _, _ in VARIABLES), "ssh_mean", "mdt", "adt", "sst_night", "sea_temperature", "sss", "sss_error", "l3_sss", "ossso", "sea_surface_salinity", "uo_mean", "vo_wind_max",
    "ocean_current", "wind_gust", "mean_speed", "n_obs", "track_id", "overlap", "land_mask", "num_tracks", "platform_number", "time", "time_count", "quality_flag", "quality_count", "source_id", "sun_angle", "obs_date", "depth",
]


def _codecs(s, d):
    names = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("l_partkey") % len(_NAMES) + 1).cast("int"))
    used = s.read.parquet(f"{d}/lineitem.parquet").groupBy(names.alias("variable")).agg(F.count(F.lit(1)).alias("n"))
    return used.select("variable", "n", codec.codec(F.col("variable")).alias("c")).select("variable", "n", "c.*")


R.add(
    "c11_codecs", _codecs,
    f"""SELECT variable, n, CASE WHEN r IN (0, 9) THEN 'float32' WHEN r = 8 THEN 'int8' ELSE 'int16' END AS dtype, CASE r WHEN 2 THEN 0.0005 WHEN 3 THEN 0.001 WHEN 4 THEN 0.002 WHEN 5 THEN 0.001 WHEN 6 THEN 0.01 WHEN 1 THEN 1 WHEN 7 THEN 1 WHEN 8 THEN 1 END::DOUBLE AS scale,
 CASE r WHEN 3 THEN 20 WHEN 4 THEN 30 WHEN 0 THEN NULL WHEN 9 THEN NULL ELSE 0 END::DOUBLE AS "offset", CASE WHEN r IN (7, 8) THEN -1 WHEN r NOT IN (0, 9) THEN -32767 END AS fill FROM (SELECT variable, COUNT(*) AS n, CASE
 WHEN regexp_matches(v, 'time|date|mask|quality|flag|status|source|angle') THEN CASE WHEN regexp_matches(v, 'flag|status|source|count|number') THEN 1 ELSE 0 END WHEN regexp_matches(v, 'ssh|sla|mdt|zos|adt') THEN 2
 WHEN regexp_matches(v, 'sst|thetao|temperature') THEN 3 WHEN v IN ('sss', 'so', 'sos') OR v LIKE '%salinity%' OR starts_with(v, 'sss_') OR ends_with(v, '_sss') THEN 4 WHEN regexp_matches(v, 'uo|vo|current') THEN 5
 WHEN regexp_matches(v, 'wind|speed') THEN 6 WHEN regexp_matches(v, 'n_obs|count') THEN 7 WHEN regexp_matches(v, 'track|overlap|mask|num') THEN 8 ELSE 9 END AS r
 FROM (SELECT names[CAST(l_partkey % len(names) + 1 AS INT)] AS variable, LOWER(names[CAST(l_partkey % len(names) + 1 AS INT)]) AS v FROM lineitem, (SELECT {_NAMES!r} AS names)) GROUP BY variable, v)""",
)
R.add(
    "c12_range_check", lambda s, d: rounded(codec.range_check(view(s, d, "cells").withColumn("variable", F.when(F.col("product") == "glorys", "thetao").otherwise("sla"))), 10),
    "SELECT CASE WHEN product = 'glorys' THEN 'thetao' ELSE 'sla' END AS variable, ROUND(MIN(val), 10) AS low, ROUND(MAX(val), 10) AS high, CASE WHEN product = 'glorys' THEN MIN(val) >= 20 - 32.76 AND MAX(val) <= 52.76 ELSE MIN(val) >= -16.38 AND MAX(val) <= 16.38 END AS is_safe FROM cells GROUP BY product", "cells",
)
R.add(
    "c2_kelvin_to_celsius", lambda s, d: rounded(codec.kelvin_to_celsius(view(s, d, "cells").withColumn("variable", F.when(F.col("product") == "glorys", "thetao").otherwise("sla")).withColumn("val", F.col("val") * 300), ("product", "obs_date"), "val", "variable"), 9),
    "SELECT product, obs_date, i, j, CASE WHEN product = 'glorys' THEN 'thetao' ELSE 'sla' END AS variable, ROUND(CASE WHEN product = 'glorys' AND AVG(val*300) OVER (PARTITION BY product, obs_date) > 200 THEN val*300 - 273.15 ELSE val*300 END, 9) AS val FROM cells", "cells",
)
_LOSS = """SELECT product, obs_date, COUNT(*) AS n_valid, AVG(a) AS mae, SQRT(AVG(e*e)) AS rmse, MAX(a) AS max_abs, QUANTILE_CONT(a, 0.99) AS p99, QUANTILE_CONT(CASE WHEN a > 0 THEN a END, 0.99) AS p99_nonzero, AVG((a > 0)::INT) AS nonzero_share, AVG(e) AS bias,
 MAX(orig)-MIN(orig) AS range_orig, MAX(packed)-MIN(packed) AS range_packed FROM (SELECT *, orig - packed AS e, ABS(orig - packed) AS a FROM packed) GROUP BY 1, 2"""
R.add(
    "a34_loss_statistics", lambda s, d: rounded(st.loss_statistics(_packed(s, d), ("product", "obs_date")).withColumn("p99_nonzero", F.coalesce("p99_nonzero", F.lit(0.0))), 11),
    f"WITH {_PACKED}, loss AS ({_LOSS}) SELECT product, obs_date, n_valid, ROUND(mae, 11) AS mae, ROUND(rmse, 11) AS rmse, ROUND(max_abs, 11) AS max_abs, ROUND(p99, 11) AS p99, ROUND(COALESCE(p99_nonzero, 0), 11) AS p99_nonzero, ROUND(nonzero_share, 11) AS nonzero_share, ROUND(bias, 11) AS bias, ROUND(range_orig, 11) AS range_orig, ROUND(range_packed, 11) AS range_packed, ROUND(CASE WHEN p99 < rmse AND p99_nonzero > 0 AND nonzero_share < 0.1 THEN p99_nonzero ELSE p99 END, 11) AS p99_reported FROM loss", "cells",
)


def _losses(s, d):
    return st.loss_statistics(_packed(s, d), ("product", "obs_date"))


R.add("a36_weighted_mean", lambda s, d: rounded(st.weighted_mean(_losses(s, d), ("product",), "mae", "n_valid"), 8), f"WITH {_PACKED}, loss AS ({_LOSS}) SELECT product, ROUND(SUM(mae*n_valid)/SUM(n_valid), 8) AS mae FROM loss GROUP BY 1", "cells")
R.add("a38_loss_by_date", lambda s, d: rounded(st.loss_by_date(_losses(s, d), ("obs_date",)), 8), f"WITH {_PACKED}, loss AS ({_LOSS}) SELECT obs_date, ROUND(AVG(mae), 8) AS mae_mean, ROUND(STDDEV_POP(mae), 8) AS mae_std, ROUND(AVG(rmse), 8) AS rmse_mean, ROUND(STDDEV_POP(rmse), 8) AS rmse_std FROM loss GROUP BY 1", "cells")
R.add("a39_loss_summary", lambda s, d: rounded(st.loss_summary(_losses(s, d), ("product",)), 8), f"WITH {_PACKED}, loss AS ({_LOSS}) SELECT product, ROUND(AVG(mae), 8) AS mae_mean, ROUND(STDDEV_SAMP(mae), 8) AS mae_std, ROUND(AVG(rmse), 8) AS rmse_mean, ROUND(STDDEV_SAMP(rmse), 8) AS rmse_std FROM loss GROUP BY 1", "cells")
R.add("a35_storage_gain", lambda s, d: rounded(st.storage_gain(view(s, d, "cells"), ("product",), F.when(F.col("product") == "glorys", 4).otherwise(2))), "SELECT product, COUNT(*) AS n, CAST(SUM(CASE WHEN product = 'glorys' THEN 4 ELSE 2 END) AS BIGINT) AS stored_bytes, COUNT(*)*4 AS float32_bytes, ROUND(COUNT(*)*4 / SUM(CASE WHEN product = 'glorys' THEN 4 ELSE 2 END), 6) AS ratio FROM cells GROUP BY 1", "cells")
R.add("a37_memory_improvement", lambda s, d: rounded(st.storage_gain(view(s, d, "cells").where("product <> 'glorys'"), (), F.lit(2)).select("ratio")), "SELECT ROUND(COUNT(*)*4 / (COUNT(*)*2), 6) AS ratio FROM cells WHERE product <> 'glorys'", "cells")
_MOMENTS = "CASE WHEN COUNT(val) >= 2 THEN ROUND({}, 6) ELSE {} END AS {}"
R.add(
    "a13_moments", lambda s, d: rounded(st.moments(_obs(s, d), ("track_id", "obs_date"))),
    "SELECT track_id, obs_date, " + ", ".join(_MOMENTS.format(*x) for x in (("AVG(val)", 0, "mean"), ("STDDEV_POP(val)", 1, "std"), ("VAR_POP(val)", 0, "var"), ("MIN(val)", 0, "min"), ("MAX(val)", 0, "max"))) + ", CASE WHEN COUNT(val) >= 2 THEN COUNT(val) ELSE 0 END AS count FROM obs GROUP BY 1, 2", "obs",
)
R.add("a14_percentiles", lambda s, d: rounded(st.percentiles(_obs(s, d), ("track_id", "obs_date"))), "SELECT track_id, obs_date, CASE WHEN COUNT(val) >= 10 THEN ROUND(QUANTILE_CONT(val, 0.02), 6) END AS p_low, CASE WHEN COUNT(val) >= 10 THEN ROUND(QUANTILE_CONT(val, 0.98), 6) END AS p_high FROM obs GROUP BY 1, 2", "obs")


def _kept(s, d):
    """Moments by track from kept states of days: three runs, of which the last two bring days that are there already."""
    obs, path = _obs(s, d), f"{shared_folder(s)}/states-{uuid4().hex}"
    states = lambda low, high: st.day_states(obs.where(F.dayofmonth("obs_date").between(low, high)), ("track_id",))
    for low, high in ((1, 20), (11, 31), (5, 8)):
        st.keep_states(states(low, high), path)
    return st.read_states(s, path, states(1, 31).schema)


R.add(
    "a13_kept_moments", lambda s, d: rounded(st.merged_states(_kept(s, d), ("track_id",))),
    "SELECT track_id, COUNT(val) AS n, ROUND(AVG(val), 6) AS mean, ROUND(STDDEV_POP(val), 6) AS std, ROUND(VAR_POP(val), 6) AS var, ROUND(MIN(val), 6) AS min, ROUND(MAX(val), 6) AS max FROM obs GROUP BY 1", "obs",
)
R.add(
    "a14_kept_percentiles", lambda s, d: _rank_errors(s, d),
    "SELECT track_id, k, TRUE AS is_near FROM (SELECT DISTINCT track_id FROM obs WHERE val IS NOT NULL), (VALUES (0), (1), (2)) AS t(k)", "obs",
)


def _rank_errors(s, d):
    """Whether the shares of values up to the percentiles of merged sketches are within one percent of those asked for."""
    at = (0.02, 0.5, 0.98)
    q = st.merged_states(_kept(s, d), ("track_id",), at).select("track_id", F.posexplode("q").alias("k", "x"))
    d = _obs(s, d).where("val IS NOT NULL").join(q, "track_id").groupBy("track_id", "k").agg(F.avg((F.col("val") < F.col("x")).cast("double")).alias("below"), F.avg((F.col("val") <= F.col("x")).cast("double")).alias("upto"))
    asked = F.array(*map(F.lit, at))[F.col("k")]
    return d.select("track_id", "k", ((F.col("below") <= asked + 0.01) & (F.col("upto") >= asked - 0.01)).alias("is_near"))


R.add(
    "a48_timing_summary", lambda s, d: rounded(st.timing_summary(_obs(s, d).where("val > 0"), ("track_id",), "val")),
    "SELECT track_id, ROUND(MEDIAN(val), 6) AS median, ROUND(AVG(val), 6) AS mean, ROUND(STDDEV_POP(val), 6) AS std, ROUND(QUANTILE_CONT(val, 0.05), 6) AS p5, ROUND(QUANTILE_CONT(val, 0.95), 6) AS p95, ROUND(MIN(val), 6) AS min, ROUND(MAX(val), 6) AS max, ROUND(COUNT(*)/SUM(val), 6) AS per_second FROM obs WHERE val > 0 GROUP BY 1", "obs",
)
R.add("a50_valid_share", lambda s, d: rounded(st.valid_share(view(s, d, "cells"), ("product", "obs_date"), 648)), "SELECT product, obs_date, ROUND(COUNT(val)*100.0/648, 6) AS valid_percent FROM cells GROUP BY 1, 2", "cells")

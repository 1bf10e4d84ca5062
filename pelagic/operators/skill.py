"""Skill scores of a reference against observations, by cell, season, latitude band, region and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import bin_left, bin_right, region_id
from ..functions.special import correlation_p
from ..functions.temporal import season
from .statistics import exact_percentiles


def binned_sums(pairs: DataFrame, min_count: int = 5) -> DataFrame:
    """Sums of differences by cell, season and cell, band and month, region and month, and overall: one pass of grouping sets.

    pairs: obs_date, lon, lat, obs, ref. Bias and RMSE are NULL below min_count; the spread is that of the differences.
    """
    d = pairs.select(
        bin_left(F.col("lon"), -180.0, 2.0, 180).alias("bi"), bin_left(F.col("lat"), -90.0, 2.0, 90).alias("bj"), season(F.col("obs_date")).alias("season"), bin_left(F.col("lat"), -90.0, 5.0, 36).alias("band"),
        F.month("obs_date").alias("month"), region_id(F.col("lon"), F.col("lat")).alias("region_id"), (F.col("ref") - F.col("obs")).alias("d"),
    )
    keys = ["bi", "bj", "season", "band", "month", "region_id"]
    sums = d.groupingSets([["bi", "bj"], ["season", "bi", "bj"], ["band", "month"], ["region_id", "month"], []], *keys).agg(
        F.grouping_id().cast("long").alias("level"), F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("sq"), F.count("d").alias("n")
    )
    enough, mean = F.col("n") >= min_count, F.col("s") / F.col("n")
    return sums.select(
        *keys, "level", "n", F.when(enough, mean).alias("bias"), F.when(enough, F.sqrt(F.col("sq") / F.col("n"))).alias("rmse"),
        F.when(enough, F.sqrt(F.greatest(F.col("sq") / F.col("n") - mean * mean, F.lit(0.0)))).alias("spread"),
    )


def global_skill(pairs: DataFrame, keys: tuple[str, ...] = (), min_count: int = 10) -> DataFrame:
    """Population statistics (ddof 0): bias, RMSE, centred RMSE, correlation, ratio of spreads, and both normalised."""
    d = F.col("ref") - F.col("obs")
    out = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"), F.corr("obs", "ref").alias("r"), F.stddev_pop("obs").alias("so"), F.stddev_pop("ref").alias("sr"))
    crmse = F.sqrt(F.greatest(F.col("rmse") ** 2 - F.col("bias") ** 2, F.lit(0.0)))

    def shown(c: Column) -> Column:
        return F.when(F.col("n") >= min_count, c)

    return out.select(
        *keys, "n", shown(F.col("bias")).alias("bias"), shown(F.col("rmse")).alias("rmse"), shown(crmse).alias("crmse"), shown(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("r")))).alias("r"),
        shown(F.col("sr") / F.col("so")).alias("std_ratio"), shown(F.col("bias") / F.col("so")).alias("norm_bias"), shown(crmse / F.col("so")).alias("norm_crmse"),
    )


def pair_skill(pairs: DataFrame, keys: tuple[str, ...] = (), min_count: int = 3) -> DataFrame:
    """Sample statistics (ddof 1): bias, RMSE, correlation with its t statistic and p-value, spreads, centred RMSE of the differences.

    std_ratio, norm_bias and norm_crmse are by the spread of the observations, NULL where that is 0.
    """
    d = F.col("ref") - F.col("obs")
    out = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"), F.corr("obs", "ref").alias("r"), F.stddev_samp("obs").alias("std_obs"), F.stddev_samp("ref").alias("std_ref"), F.stddev_pop(d).alias("crmse")
    )
    t = F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") ** 2))
    by_spread = {name: F.when(F.col("std_obs") > 0, F.col(c) / F.col("std_obs")) for name, c in (("std_ratio", "std_ref"), ("norm_bias", "bias"), ("norm_crmse", "crmse"))}
    return out.where(F.col("n") >= min_count).withColumns({"t": F.when(F.abs("r") < 1, t), "p_value": correlation_p(F.col("r"), F.col("n"))} | by_spread)


def binned_bias(pairs: DataFrame, step: float = 2.0, min_count: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean bias by right-closed cells of so many degrees."""
    d = pairs.withColumns({"bi": bin_right(F.col("lon"), -180.0, step, round(360 / step)), "bj": bin_right(F.col("lat"), -90.0, step, round(180 / step))}).where("bi IS NOT NULL AND bj IS NOT NULL")
    return d.groupBy(*keys, "bi", "bj").agg(F.avg(F.col("ref") - F.col("obs")).alias("bias"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def bias_by(pairs: DataFrame, key: Column, name: str, month: bool = True, min_count: int = 3) -> DataFrame:
    """Mean, sample spread and count of the bias by a key (latitude band, region), by month or over the whole period."""
    keys = [key.alias(name), *([F.trunc("obs_date", "month").alias("month")] if month else [])]
    return pairs.groupBy(*keys).agg(F.avg(F.col("ref") - F.col("obs")).alias("bias"), F.stddev_samp(F.col("ref") - F.col("obs")).alias("std"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def regional_bias(pairs: DataFrame, min_region: int = 5) -> DataFrame:
    """bias_by region and month, for the regions with enough pairs over the whole period."""
    d = pairs.withColumn("region_id", region_id(F.col("lon"), F.col("lat")))
    enough = d.groupBy("region_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_region).select("region_id")
    return bias_by(d.join(F.broadcast(enough), "region_id", "left_semi"), F.col("region_id"), "region_id")


def seasonal_bias(pairs: DataFrame, min_season: int = 10, min_cell: int = 3, step: float = 2.0) -> DataFrame:
    """Binned bias by season, for the seasons with enough pairs and the cells with enough of them."""
    d = pairs.withColumn("season", season(F.col("obs_date")))
    enough = d.groupBy("season").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_season).select("season")
    return binned_bias(d.join(F.broadcast(enough), "season", "left_semi"), step, min_cell, ("season",))


def scatter_density(pairs: DataFrame, low: float, high: float, bins: int = 80) -> DataFrame:
    """Counts of (obs, ref) on a square grid of bins, and their logarithm."""
    def at(c: str) -> Column:
        return bin_left(F.col(c), low, (high - low) / bins, bins)

    inside = pairs.where(F.col("obs").between(low, high) & F.col("ref").between(low, high))
    return inside.groupBy(at("obs").alias("x"), at("ref").alias("y")).agg(F.count(F.lit(1)).alias("n")).withColumn("log_n", F.log10("n"))


def regression(pairs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.corr("ref", "obs").alias("r"), F.regr_slope("ref", "obs").alias("slope"), F.regr_intercept("ref", "obs").alias("intercept"), F.regr_r2("ref", "obs").alias("r2"))


def box_plot(pairs: DataFrame, key: Column, name: str, min_count: int = 3) -> DataFrame:
    """Quartiles of the bias, and the most extreme values within 1.5 times their distance."""
    d = pairs.select(key.alias(name), (F.col("ref") - F.col("obs")).alias("d"))
    q = exact_percentiles(d, (name,), "d", [0.25, 0.5, 0.75]).where(F.col("n") >= min_count)
    q = q.select(name, "n", *[F.col("q")[k].alias(f"q{k + 1}") for k in range(3)])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = d.join(q, name).where(F.col("d").between(F.col("q1") - reach, F.col("q3") + reach))
    return inside.groupBy(name, "n", "q1", "q2", "q3").agg(F.min("d").alias("low"), F.max("d").alias("high"))


def bias_limit(pairs: DataFrame, floor: float = 0.05) -> DataFrame:
    """The 95th percentile of the absolute bias, at least a floor."""
    q = exact_percentiles(pairs.select(F.abs(F.col("ref") - F.col("obs")).alias("d")), (), "d", [0.95])
    return q.select(F.greatest(F.col("q")[0], F.lit(floor)).alias("bias_limit"))


def temporal_correlation(pairs: DataFrame) -> DataFrame:
    """Correlation over time by cell, only where no day of the period, from the first date to the last, is missing in either series."""
    days = pairs.agg((F.date_diff(F.max("obs_date"), F.min("obs_date")) + 1).alias("n_days"))
    by = pairs.groupBy("i", "j").agg(F.corr("obs", "ref").alias("r"), F.count_distinct("obs_date").alias("n"))
    return by.join(F.broadcast(days)).select("i", "j", "n", F.when(F.col("n") == F.col("n_days"), F.col("r")).alias("r"))


def diagram_points(skill: DataFrame) -> DataFrame:
    """Places in a Taylor diagram (angle, radius) and a target diagram (x by the sign of the spreads' difference, y)."""
    sign = F.when(F.col("std_ratio") >= 1, 1.0).otherwise(-1.0)
    return skill.withColumns({"theta": F.acos("r"), "radius": F.col("std_ratio"), "target_x": sign * F.col("norm_crmse"), "target_y": F.col("norm_bias")})


def error_map(pairs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Differences of anomalies, with pooled RMSE and MAE by key."""
    mean = pairs.groupBy(*keys).agg(F.avg("obs").alias("mo"), F.avg("ref").alias("mr"))
    d = (F.col("ref") - F.col("mr")) - (F.col("obs") - F.col("mo"))
    return pairs.join(mean, list(keys)).groupBy(*keys).agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"), F.count(F.lit(1)).alias("n"))


def hash_sample(frame: DataFrame, id_: str, percent: int, seed: int = 42) -> DataFrame:
    """A share of the rows by a hash of their id: the same rows on any partitioning."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(id_))), 1, 8), 16, 10).cast("long") % 100
    return frame.where(bucket < percent)

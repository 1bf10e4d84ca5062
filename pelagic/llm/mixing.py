"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every source s has a target repetition rate: its share of the wanted rows, divided by its rows. A document's number of
copies is drawn from a Poisson distribution with that mean by inverting the distribution at a number hashed from the
seed and the document's id, so that a rerun, a lost executor or another partitioning gives the same mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import set_aside, unit_draw

#: A draw with a larger mean is the sum of several with at most this mean: exp(-mean) stays exact.
MEAN_PER_DRAW = 16.0
#: P(X > 95) is below 1e-40 at mean 16, far under the 2^-52 steps of the drawn numbers.
CDF_TERMS = 96
#: Up to so many sources the rate table (about 1 KB a row) is broadcast; beyond, the join is salted.
BROADCAST_SOURCES = 10_000
SALTS = 64


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, temperature: float = 0.5, source_col: str = "source"
) -> tuple[DataFrame, int]:
    """(a row per source: __mix_source, __mix_rate; the number of sources). Rates use counts over all rows."""
    counts = docs.groupBy(F.col(source_col).alias("__mix_source")).agg(F.count(F.lit(1)).alias("__mix_n"))
    if weights is None:
        weight = F.pow(F.col("__mix_n").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("__mix_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("__mix_weight", weight)
    n_sources, rows, total = counts.agg(F.count(F.lit(1)), F.sum("__mix_n"), F.sum("__mix_weight")).first()
    wanted = float(rows or 0) * float(epochs)
    rate = F.col("__mix_weight") / F.lit(float(total or 1.0) or 1.0) * F.lit(wanted) / F.col("__mix_n")
    return counts.select("__mix_source", rate.alias("__mix_rate")), int(n_sources)


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    epochs: float = 1.0,
    temperature: float = 0.5,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    copy_col: str | None = None,
) -> DataFrame:
    """Replicates the rows of docs so that each source reaches its weight, and shuffles the copies globally.

    weights: target share by source (any positive scale; sources not named get none). None: rows ** temperature.
    epochs: expected rows of the result, as a multiple of the rows of docs.
    copy_col: adds the copy's number (from 1) under this name, in place of a column of that name.

    Null sources are one source of their own. A null id counts as an empty one; rows with equal ids get equal counts.
    An empty table gives an empty table. All other columns, null or not, are carried along untouched, whatever their names.
    """
    docs, names = set_aside(docs.drop(copy_col) if copy_col else docs, "__mix_")
    own = docs.columns
    rates, n_sources = source_rates(docs, weights, epochs, temperature, source_col)
    draws = F.greatest(F.lit(1), F.ceil(F.col("__mix_rate") / F.lit(MEAN_PER_DRAW))).cast("int")
    rates = rates.withColumn("__mix_draws", draws).withColumn("__mix_mean", F.col("__mix_rate") / F.col("__mix_draws"))
    first = F.exp(-F.col("__mix_mean"))
    state = F.aggregate(
        F.sequence(F.lit(1), F.lit(CDF_TERMS - 1)),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf")),
        lambda s, k: F.struct(
            (s["p"] * F.col("__mix_mean") / k).alias("p"),
            (s["c"] + s["p"] * F.col("__mix_mean") / k).alias("c"),
            F.concat(s["cdf"], F.array(s["c"] + s["p"] * F.col("__mix_mean") / k)).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )
    rates = rates.select("__mix_source", "__mix_draws", state.alias("__mix_cdf"))
    same = F.col(source_col).eqNullSafe(F.col("__mix_source"))
    if n_sources <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(rates), same)
    else:
        salt = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(SALTS)).cast("int")
        rates = rates.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = docs.withColumn("__mix_at", salt).join(rates, same & (F.col("__mix_at") == F.col("__mix_salt")))
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("__mix_draws")),
        F.lit(0),
        lambda n, j: n + F.aggregate(
            F.col("__mix_cdf"),
            F.struct(F.lit(0).alias("n"), unit_draw(F.lit(seed), F.col(id_col), j).alias("u")),
            lambda s, c: F.struct((s["n"] + F.when(c <= s["u"], 1).otherwise(0)).alias("n"), s["u"].alias("u")),
            lambda s: s["n"],
        ),
    )
    copied = (
        joined.withColumn("__mix_copies", copies)
        .where("__mix_copies > 0")
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
        .withColumn("__mix_key", F.xxhash64(F.lit(seed), F.col(id_col), F.col("__mix_copy"), F.lit("order")))
    )
    shuffled = copied.repartition("__mix_key").sortWithinPartitions("__mix_key")
    return shuffled.select(*own, *([F.col("__mix_copy").alias(copy_col)] if copy_col else [])).withColumnsRenamed(names)

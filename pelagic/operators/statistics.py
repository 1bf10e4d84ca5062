"""Statistics of fields, of storage loss and of run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import clean
from ..sources.tables import written
from .gridding import with_cells
from .scans import format_product


#: Different values of a group and percentile that one task puts in order, at most; and the parts of a round that narrows them.
SELECTED_VALUES, PARTS = 50_000, 1024


def exact_percentiles(frame: DataFrame, keys: tuple[str, ...], value: str, at: list[float], accuracy: int = 10_000, most: int = SELECTED_VALUES, weight: str | None = None) -> DataFrame:
    """(keys, n, q): interpolated percentiles as an array, exact, without a group's values in one place.

    Approximate percentiles bracket each wanted one. Values below a bracket are counted; those within it, some 0.4 percent
    of a group (all of a small one), become one row for each different value, with its count, so that ties cost nothing.
    Brackets of more than `most` different values are narrowed in rounds: cut into equal parts, of which counts say
    which one, or which two, hold the wanted ranks. What is left is put in order. weight: a row stands for so many equal
    values (a whole number); there are no brackets then, but rounds from the start.
    """
    by, write = ["__all", *keys], written(frame.sparkSession)
    d = frame.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, F.lit(0).alias("__all"), F.col(value).cast("double").alias("__v"))
    if weight is not None:
        d = frame.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.col(weight) > 0)).select(*keys, F.lit(0).alias("__all"), F.col(value).cast("double").alias("__v"), F.col(weight).cast("long").alias("__c"))
        counted = write(d.groupBy(*by, "__v").agg(F.sum("__c").alias("__c")))
        whole = counted.groupBy(*by).agg(F.sum("__c").alias("n"))
        wanted = F.posexplode(F.array(*[F.lit(float(p)) for p in at])).alias("__k", "p")
        targets = write(whole.select(*by, "n", wanted).select(*by, "n", "__k", (F.col("p") * (F.col("n") - 1)).alias("__place"), F.lit(0).cast("long").alias("__below")))
        return _selected(counted.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(len(at) - 1)))), targets, by, most, write)
    near, small = max(0.002, 2 / accuracy), F.count(F.lit(1)) < 2000

    def end(p: float, extreme: Column) -> Column:
        return F.when(small, extreme).otherwise(F.percentile_approx("__v", p, accuracy)) if 0 < p < 1 else extreme

    low, high = [end(p - near, F.min("__v")) for p in at], [end(p + near, F.max("__v")) for p in at]
    wanted = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(p)).alias("p"), a.alias("low"), b.alias("high")) for k, (p, a, b) in enumerate(zip(at, low, high))])
    brackets = write(d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), wanted.alias("__w")))
    met = d.join(brackets.select(*by, "__w"), by)
    sides = F.transform("__w", lambda w: F.struct(w["k"].alias("__k"), F.when(F.col("__v") < w["low"], F.lit(None).cast("double")).otherwise(F.col("__v")).alias("__v"), (F.col("__v") <= w["high"]).alias("__in")))
    # a row for each percentile and value within its bracket (those below it as NULL), combined where it arises
    counted = met.select(*by, F.explode(F.filter(sides, lambda x: x["__v"].isNull() | x["__in"])).alias("s")).groupBy(*by, "s.__k", "s.__v").agg(F.count(F.lit(1)).alias("__c"))
    counted = write(counted)
    below = counted.where("__v IS NULL").select(*by, "__k", F.col("__c").alias("__below"))
    place = brackets.select(*by, "n", F.explode("__w").alias("w")).select(*by, "n", F.col("w.k").alias("__k"), (F.col("w.p") * (F.col("n") - 1)).alias("__place"))
    targets = place.join(below, [*by, "__k"], "left").withColumn("__below", F.coalesce("__below", F.lit(0).cast("long")))
    return _selected(counted.where("__v IS NOT NULL"), targets, by, most, write)


def _selected(values: DataFrame, targets: DataFrame, by: list[str], most: int, write) -> DataFrame:
    """The wanted percentiles from values with their counts, narrowed until few are left."""
    while (values.groupBy(*by, "__k").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0) > most:
        values, targets = _narrowed(values, targets, by, write)
    running = Window.partitionBy(*by, "__k").orderBy("__v")
    ranked = values.join(targets, [*by, "__k"]).withColumn("__last", F.col("__below") + F.sum("__c").over(running) - 1).withColumn("__first", F.col("__last") - F.col("__c") + 1)
    rank, part = F.floor("__place"), F.col("__place") - F.floor("__place")
    share = F.when(rank.between(F.col("__first"), F.col("__last")), 1 - part).otherwise(0.0) + F.when((rank + 1).between(F.col("__first"), F.col("__last")), part).otherwise(0.0)
    one = ranked.withColumn("__share", share).where("__share > 0").groupBy(*by, "n", "__k").agg(F.sum(F.col("__share") * F.col("__v")).alias("__v"))
    return one.groupBy(*by, "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("__k", "__v"))), lambda x: x["__v"]).alias("q")).drop("__all")


def _narrowed(values: DataFrame, targets: DataFrame, by: list[str], write) -> tuple[DataFrame, DataFrame]:
    """(values, targets) with only the parts of each bracket that hold the wanted ranks, and with what lies below them added."""
    key = [*by, "__k"]
    ends = values.groupBy(*key).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    share = (F.col("__v") / 2 - F.col("__low") / 2) / (F.col("__high") / 2 - F.col("__low") / 2)
    cut = values.join(ends, key).withColumn("__part", F.when(F.col("__high") > F.col("__low"), F.least(F.lit(PARTS - 1), F.floor(share * PARTS).cast("int"))).otherwise(0))
    parts = cut.groupBy(*key, "__part").agg(F.sum("__c").alias("__c"))  # at most PARTS rows of a bracket
    running = Window.partitionBy(*key).orderBy("__part")
    placed = parts.join(targets, key).withColumn("__last", F.col("__below") + F.sum("__c").over(running) - 1)
    rank, first = F.floor("__place"), F.col("__last") - F.col("__c") + 1
    kept = placed.where((first <= rank + 1) & (F.col("__last") >= rank)).withColumn("__first", first)
    moved = write(kept.groupBy(*key, "n", "__place").agg(F.min("__first").alias("__below"), F.min("__part").alias("__from"), F.max("__part").alias("__to")))
    inside = cut.join(moved.select(*key, "__from", "__to"), key).where(F.col("__part").between(F.col("__from"), F.col("__to")))
    return write(inside.select(*key, "__v", "__c")), moved.drop("__from", "__to")


#: Rank error of a kept sketch of 2^KLL_K items a level: some 1.3 / 2^9 at this size, whatever is merged.
KLL_K = 400


def day_states(frame: DataFrame, keys: tuple[str, ...], value: str = "val", date: str = "obs_date") -> DataFrame:
    """Mergeable states by day and keys: count, mean, sum of squared deviations (m2), extremes, and a quantile sketch of bounded size."""
    d = frame.where(F.col(value).isNotNull() & ~F.isnan(value))
    v = F.col(value).cast("double")
    return d.groupBy(date, *[k for k in keys if k != date]).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(F.lit(1))).alias("m2"), F.min(v).alias("min"), F.max(v).alias("max"), F.kll_sketch_agg_double(v, KLL_K).alias("sketch"))


def keep_states(states: DataFrame, path: str, date: str = "obs_date") -> None:
    """Adds days to a kept table, a folder for each; a day that is there is replaced, so that running it again changes nothing."""
    states.repartition(date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def read_states(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def merged_states(states: DataFrame, keys: tuple[str, ...], at: tuple[float, ...] = (), date: str = "obs_date") -> DataFrame:
    """(keys, n, mean, std, var, min, max and, if asked for, q: percentiles) over the days of kept states.

    Days are merged pair by pair, in order: means by their counts, squared deviations with those between the means. A
    group has a state per day, however many values there were.
    """
    def merged(a, b):
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    days = F.sort_array(F.collect_list(F.struct(date, "n", "mean", "m2")))
    d = states.where("n > 0").groupBy(*keys).agg(F.aggregate(days, zero, merged).alias("s"), F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"))
    var = F.col("s.m2") / F.col("s.n")
    more = [F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, at))).alias("q")] if at else []
    return d.select(*keys, "s.n", "s.mean", F.sqrt(var).alias("std"), var.alias("var"), "min", "max", *more)


def moments(frame: DataFrame, keys: tuple[str, ...], value: str = "val") -> DataFrame:
    """Mean, population spread and variance, extremes and count; (0, 1, 0, 0, 0, 0) below two values."""
    d = frame.groupBy(*keys).agg(F.count(value).alias("__k"), F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"), F.var_pop(value).alias("__v"), F.min(value).alias("__lo"), F.max(value).alias("__hi"))

    def shown(c: str, default: float) -> Column:
        return F.when(F.col("__k") >= 2, F.col(c)).otherwise(F.lit(default))

    return d.select(*keys, shown("__m", 0.0).alias("mean"), shown("__s", 1.0).alias("std"), shown("__v", 0.0).alias("var"), shown("__lo", 0.0).alias("min"), shown("__hi", 0.0).alias("max"), F.when(F.col("__k") >= 2, F.col("__k")).otherwise(F.lit(0)).alias("count"))


def percentiles(frame: DataFrame, keys: tuple[str, ...], value: str = "val", low: float = 0.02, high: float = 0.98, approximate: bool = False) -> DataFrame:
    """Low and high percentiles, NULL below ten values; exact by selection, or approximate in one pass."""
    names = ("p_low", "p_high")
    if approximate:
        return frame.groupBy(*keys).agg(*[F.when(F.count(value) >= 10, F.percentile_approx(value, p, 10_000)).alias(name) for p, name in zip((low, high), names)])
    q = exact_percentiles(frame, keys, value, [low, high])
    groups = frame.select(*keys).distinct()
    return groups.join(q, [groups[k].eqNullSafe(q[k]) for k in keys], "left").select(*[groups[k] for k in keys], *[F.when(F.col("n") >= 10, F.col("q")[k]).alias(name) for k, name in enumerate(names)])


def loss_statistics(pairs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Errors of packed against original values (orig - packed), ranges, and the P99 to report.

    That of the errors that are not zero is reported where P99 is below the RMSE and few errors differ from zero.
    """
    e = F.col("orig") - F.col("packed")
    d = pairs.where("orig IS NOT NULL AND packed IS NOT NULL").withColumn("e", e).withColumn("a", F.abs("e"))
    out = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_valid"), F.avg("a").alias("mae"), F.sqrt(F.avg(F.col("e") ** 2)).alias("rmse"), F.max("a").alias("max_abs"),
        F.avg((F.col("a") > 0).cast("double")).alias("nonzero_share"), F.avg("e").alias("bias"), (F.max("orig") - F.min("orig")).alias("range_orig"), (F.max("packed") - F.min("packed")).alias("range_packed"),
    )
    for name, own in (("p99", d), ("p99_nonzero", d.where("a > 0"))):
        out = out.join(exact_percentiles(own, keys, "a", [0.99]).select(*keys, F.col("q")[0].alias(name)), list(keys), "left")
    odd = (F.col("p99") < F.col("rmse")) & (F.coalesce("p99_nonzero", F.lit(0.0)) > 0) & (F.col("nonzero_share") < 0.1)
    return out.withColumn("p99_reported", F.when(odd, F.col("p99_nonzero")).otherwise(F.col("p99")))


def weighted_mean(frame: DataFrame, keys: tuple[str, ...], value: str, weight: str) -> DataFrame:
    ok = frame.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.col(weight) > 0))
    return ok.groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(value))


def storage_gain(frame: DataFrame, keys: tuple[str, ...], item_bytes: Column) -> DataFrame:
    """Stored against float32 bytes."""
    d = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(item_bytes).cast("long").alias("stored_bytes"), (F.count(F.lit(1)) * 4).alias("float32_bytes"))
    return d.withColumn("ratio", F.col("float32_bytes") / F.col("stored_bytes"))


def timing_summary(log: DataFrame, keys: tuple[str, ...], seconds: str) -> DataFrame:
    q = exact_percentiles(log, keys, seconds, [0.05, 0.5, 0.95]).select(*keys, "q")
    d = log.groupBy(*keys).agg(F.avg(seconds).alias("mean"), F.stddev_pop(seconds).alias("std"), F.min(seconds).alias("min"), F.max(seconds).alias("max"), (F.count(F.lit(1)) / F.sum(seconds)).alias("per_second")).join(q, list(keys))
    return d.select(*keys, F.col("q")[1].alias("median"), "mean", "std", F.col("q")[0].alias("p5"), F.col("q")[2].alias("p95"), "min", "max", "per_second")


def loss_by_date(losses: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return losses.groupBy(*keys).agg(*[f(c).alias(f"{c}_{n}") for c in ("mae", "rmse") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def loss_summary(losses: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return losses.groupBy(*keys).agg(*[x.alias(n) for c in ("mae", "rmse") for n, x in ((f"{c}_mean", F.avg(c)), (f"{c}_std", F.coalesce(F.stddev_samp(c), F.lit(0.0))))])


def valid_share(cells: DataFrame, keys: tuple[str, ...], n_cells: int, value: str = "val") -> DataFrame:
    """Percent of a field's cells that have a value."""
    return cells.groupBy(*keys).agg((F.count(value) * 100.0 / n_cells).alias("valid_percent"))


def sample_statistics(samples: DataFrame, max_samples: int | None = None, weight: str | None = None) -> DataFrame:
    """Moments and percentiles of every variable over the cells of samples that have data.

    samples: (query_id, variable, value), NULL where a sample has no data. max_samples: only queries below this number.
    weight: a row stands for so many equal ones (for instance a class of equal boxes); samples are written once then.
    """
    d = samples.where(F.col("value").isNotNull())
    d = d if max_samples is None else d.where(F.col("query_id") < max_samples)
    if weight is not None:
        d = written(samples.sparkSession)(d.select("variable", "value", F.col(weight).alias("__weight")))
    q = exact_percentiles(d, ("variable",), "value", [0.02, 0.98], weight=None if weight is None else "__weight").select("variable", *[F.when(F.col("n") >= 10, F.col("q")[k]).alias(c) for k, c in enumerate(("p_low", "p_high"))])
    found = moments(d, ("variable",), "value") if weight is None else weighted_moments(d, ("variable",), "value", "__weight")
    return found.join(F.broadcast(q), "variable")


def weighted_moments(frame: DataFrame, keys: tuple[str, ...], value: str, weight: str) -> DataFrame:
    """moments of rows that stand for so many equal ones: means first, then squared deviations from them."""
    d = frame.where(F.col(value).isNotNull() & (F.col(weight) > 0))
    w, v, all_ = F.col(weight), F.col(value).cast("double"), F.sum(weight)
    sums = d.groupBy(*keys).agg(all_.alias("__k"), (F.sum(w * v) / all_).alias("__m"), F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    var = d.join(sums, list(keys)).groupBy(*keys).agg((F.sum(w * (v - F.col("__m")) ** 2) / all_).alias("__v"))

    def shown(c: Column, default: float) -> Column:
        return F.when(F.col("__k") >= 2, c).otherwise(F.lit(default))

    named = {"mean": shown(F.col("__m"), 0.0), "std": shown(F.sqrt("__v"), 1.0), "var": shown(F.col("__v"), 0.0), "min": shown(F.col("__lo"), 0.0), "max": shown(F.col("__hi"), 0.0), "count": F.when(F.col("__k") >= 2, F.col("__k")).otherwise(F.lit(0))}
    return sums.join(var, list(keys)).select(*keys, *[c.alias(n) for n, c in named.items()])


#: What names a cell of a table of tiles.
TILE_KEYS = ("obs_date", "region_id", "source", "variable", "i", "j")


def compared_tiles(original: DataFrame, packed: DataFrame) -> DataFrame:
    """Cells of two tables of tiles side by side, the original and the stored value of each."""
    keys = list(TILE_KEYS)
    return original.select(*keys, F.col("val").alias("orig")).join(packed.select(*keys, F.col("val").alias("packed")), keys)


def pre_encoding_reference(raw: DataFrame, variables: tuple[str, ...] = ("sla_filtered", "sla", "ssha"), step: float | None = None, level_of: DataFrame | None = None) -> DataFrame:
    """A product's tiles as they were before they were packed, in doubles, for a fair comparison with the stored ones.

    Gridded products (step: NULL) go through the formatting, as (obs_date, region_id, variable, ..., val). Tracks are
    binned one by one on cells of so many degrees and averaged, each track with one vote; a track uses the first of the
    variables of which it has any value, under the first one's name.
    """
    if step is None:
        return format_product(raw, list(variables), level_of)
    d = raw.withColumns({v: clean(F.col(v)) for v in variables})
    has = d.groupBy("obs_date", "track_id").agg(F.coalesce(*[F.when(F.count(v) > 0, F.lit(k)) for k, v in enumerate(variables)]).alias("__use"))
    own = d.join(has, ["obs_date", "track_id"]).withColumn("val", F.coalesce(*[F.when(F.col("__use") == k, F.col(v)) for k, v in enumerate(variables)]))
    tracks = with_cells(own.where(F.col("val").isNotNull()), step).groupBy("obs_date", "region_id", "track_id", "i", "j").agg(F.avg("val").alias("val"))
    return tracks.groupBy("obs_date", "region_id", F.lit(variables[0]).alias("variable"), "i", "j").agg(F.avg("val").alias("val"), F.count(F.lit(1)).alias("n_tracks"))

"""Quality rules as a learned decision list (DataFrame functions only).

Sequential covering: each rule grows a conjunction of thresholds that covers documents labelled bad, is pruned against
other labelled documents, and takes what it covers out of the way of the next rule. Only counts by feature, bin and label
come to the driver. The list is emitted as one ordered conditional expression.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classifiers import labelled_sample
from .common import materialize, set_aside

#: Bound of the labelled sample.
SAMPLE_ROWS = 20_000
SPACE = "[ \\t-\\r]+"
#: Ratios that rules may put thresholds on, each from the statistics below.
FEATURES = ("symbols_per_word", "marks_per_word", "upper_share", "word_length", "dup_line_share", "repeat_share", "distinct_share", "words_per_line")
QUANTILES = [i / 16 for i in range(17)]


class Literal(NamedTuple):
    feature: int
    bin: int
    above: bool
    threshold: float

    def holds(self) -> Column:
        """On the binned sample."""
        bin_ = F.col("bins")[self.feature]
        return bin_ >= self.bin if self.above else bin_ < self.bin

    def expression(self) -> Column:
        """On the statistics of a document."""
        value = F.col(f"__q_{FEATURES[self.feature]}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold:.4g}"


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds __q_ columns: the base statistics and the ratios. A null or empty text has no words, lines or symbols."""
    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace("__q_text", pattern, ""))

    def longs(column: Column) -> Column:
        return F.coalesce(column, F.array().cast("array<bigint>"))

    n, text = F.col("__q_words_n"), F.col("__q_text")
    window = F.transform(F.sequence(F.lit(0), n - 8), lambda i: F.xxhash64(*[F.col("__q_hash")[i + k] for k in range(8)]))
    ordered = F.sort_array(F.transform("__q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    size = F.size("__q_ordered")
    twice = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda k: F.when(F.col("__q_ordered")[k]["h"] == F.col("__q_ordered")[k - 1]["h"], F.array(F.col("__q_ordered")[k - 1]["i"], F.col("__q_ordered")[k]["i"])).otherwise(F.array().cast("array<int>")),
    )
    starts = F.col("__q_starts")
    covered = F.aggregate(
        starts, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-8).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(8), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"],
    )
    d = docs.withColumn("__q_text", F.coalesce(F.col(text_col), F.lit("")))
    d = d.withColumn("__q_words", F.array_remove(F.split("__q_text", SPACE), ""))
    d = d.withColumns({
        "__q_words_n": F.size("__q_words").cast("bigint"),
        "__q_hash": F.transform("__q_words", lambda w: F.xxhash64(w)),
        "__q_lines": F.filter(F.split("__q_text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
        "__q_word_chars": count(SPACE).cast("bigint"),
        "__q_symbols": count("[^#*$%&|<>]+").cast("bigint"),
        "__q_marks": count("[^!?]+"),
        "__q_upper": count("[^A-Z]+"),
    })
    d = d.withColumns({
        "__q_windows": longs(F.when(n >= 8, window)),
        "__q_lines_n": F.size("__q_lines"),
        "__q_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("bigint"),
        "__q_distinct": F.size(F.array_distinct("__q_hash")),
    })
    d = d.withColumn("__q_ordered", F.when(F.size(F.array_distinct("__q_windows")) < F.size("__q_windows"), ordered))
    d = d.withColumn("__q_starts", F.when(F.col("__q_ordered").isNotNull(), F.sort_array(F.array_distinct(F.flatten(twice)))))
    d = d.withColumn("__q_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))
    one, chars = F.greatest(n, F.lit(1)), F.greatest(F.length(text), F.lit(1))
    lines = F.greatest(F.col("__q_lines_n"), F.lit(1))
    ratios = {
        "symbols_per_word": F.col("__q_symbols") / one, "marks_per_word": F.col("__q_marks") / one, "upper_share": F.col("__q_upper") / chars,
        "word_length": F.col("__q_word_chars") / one, "dup_line_share": F.col("__q_dup_lines") / lines, "repeat_share": F.col("__q_repeat_words") / one,
        "distinct_share": F.col("__q_distinct") / one, "words_per_line": n / lines,
    }
    d = d.withColumns({f"__q_{name}": ratios[name] for name in FEATURES})
    failed = (n < 20) | (100 * F.col("__q_repeat_words") > 30 * n)
    return d.withColumn("__q_base_failed", failed).drop("__q_words", "__q_hash", "__q_lines", "__q_windows", "__q_ordered", "__q_starts", "__q_text")


def learn_rules(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_rules: int = 8, max_literals: int = 3, min_precision: float = 0.95, min_covered: int = 5, label_col: str = "quality"
) -> list[tuple[Literal, ...]]:
    """Rules for rejection, in order: conjunctions that are right on held-back labelled documents. No labels: no rules."""
    sample = with_statistics(labelled_sample(docs, labels, label_col, rows)).select(
        "__q_base_failed",
        F.array(*[F.col(f"__q_{f}") for f in FEATURES]).alias("values"), (F.col("label") == 0).alias("bad"),
        (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("prune"),
    )
    sample = materialize(sample.repartition(1 + rows // 5_000), "quality-rules-sample").where(~F.col("__q_base_failed"))
    marks = sample.groupBy("bad").agg(*[F.percentile_approx(F.col("values")[i], QUANTILES, 1000).alias(f"q{i}") for i in range(len(FEATURES))]).collect()
    cuts = []
    for i in range(len(FEATURES)):
        grid = sorted({x for row in marks for x in row[f"q{i}"]})
        cuts.append([(a + b) / 2 for a, b in zip(grid, grid[1:])])
    bins = F.array(*[F.size(F.filter(F.array(*map(F.lit, c)), _below(F.col("values")[i]))) if c else F.lit(0) for i, c in enumerate(cuts)])
    sample = materialize(sample.select("bad", "prune", bins.alias("bins")), "quality-rules-bins")
    rules: list[tuple[Literal, ...]] = []
    while len(rules) < max_rules:
        left = reduce(lambda d, rule: d.where(~reduce(and_, [x.holds() for x in rule])), rules, sample)
        rule = _grow(left.where("not prune"), cuts, max_literals, min_covered)
        rule = _prune(left.where("prune"), rule, min_precision) if rule else ()
        if not rule:
            break
        rules.append(rule)
    return rules


def _below(value: Column):
    return lambda t: t < value


def _grow(left: DataFrame, cuts: list[list[float]], max_literals: int, min_covered: int) -> tuple[Literal, ...]:
    """Adds the literal of most FOIL gain until no good document is covered."""
    rule: list[Literal] = []
    while len(rule) < max_literals:
        covered = left.where(reduce(and_, [x.holds() for x in rule])) if rule else left
        counts = covered.select(F.posexplode("bins").alias("feature", "bin"), "bad").groupBy("feature", "bin").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
        by = {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counts}
        bad, good = (sum(v[k] for (f, _), v in by.items() if f == 0) for k in (0, 1))
        if bad < min_covered or not good:
            break
        best, chosen, low = 0.0, None, math.log2(bad / (bad + good))
        for f, cut in enumerate(cuts):
            p = q = 0
            for b in range(1, len(cut) + 1):
                under = by.get((f, b - 1), (0, 0))
                p, q = p + under[0], q + under[1]
                for above, (x, y) in ((True, (bad - p, good - q)), (False, (p, q))):
                    gain = x * (math.log2(x / (x + y)) - low) if x >= min_covered else 0.0
                    if gain > best:
                        best, chosen = gain, Literal(f, b, above, cut[b - 1])
        if chosen is None:
            break
        rule.append(chosen)
    return tuple(rule)


def _prune(left: DataFrame, rule: tuple[Literal, ...], min_precision: float) -> tuple[Literal, ...]:
    """The beginning of the rule that does best on documents it was not grown on, or none if that is not precise enough."""
    begins = [reduce(and_, [x.holds() for x in rule[: k + 1]]) for k in range(len(rule))]
    counts = left.agg(*[F.count_if(c & (F.col("bad") if bad else ~F.col("bad"))).alias(f"n{k}{int(bad)}") for k, c in enumerate(begins) for bad in (True, False)]).first()
    scored = [((counts[f"n{k}1"] - counts[f"n{k}0"]) / max(1, counts[f"n{k}1"] + counts[f"n{k}0"]), counts[f"n{k}1"], k) for k in range(len(rule))]
    value, bad, k = max(scored)
    return rule[: k + 1] if bad and (value + 1) / 2 >= min_precision else ()


def rule_number(rules: list[tuple[Literal, ...]]) -> Column:
    """The number (from 1) of the first rule that holds, 0 where none does: the decision list as one expression."""
    if not rules:
        return F.lit(0)
    first, *rest = [(reduce(and_, [x.expression() for x in rule]), i + 1) for i, rule in enumerate(rules)]
    return reduce(lambda e, r: e.when(*r), rest, F.when(*first)).otherwise(F.lit(0))


def judge_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with __q_ columns: statistics, __q_base_failed, __q_rule (0: none) and __q_kept.

    docs needs doc_id and text; other columns are carried along, but for those that begin with __q_. A null or empty text
    has no words and fails; a text of any length is judged whole. Documents are judged by their texts alone, so that equal texts get equal verdicts. An empty table gives an empty one.
    """
    judged = with_statistics(docs).withColumn("__q_rule", rule_number(learn_rules(docs, labels, rows)))
    # always true, but not deterministic to the optimizer: else a later filter on the verdict would be pushed below the
    # statistics, and copies of their expressions would be evaluated inside one another
    fence = F.monotonically_increasing_id() >= 0
    return judged.withColumn("__q_kept", ~F.col("__q_base_failed") & (F.col("__q_rule") == 0) & fence)


def quality_report(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule for every row of docs.

    Null ids and repeated rows each have their row; texts as for judge_documents; other columns are not read.
    """
    names = {"words_n": "n_words", "word_chars": "word_chars", "symbols": "n_symbols", "dup_lines": "n_dup_lines", "repeat_words": "n_repeat_words", "base_failed": "base_failed", "kept": "kept", "rule": "rule"}
    return judge_documents(docs.select("doc_id", "text"), labels, rows).select("doc_id", *[F.col(f"__q_{k}").alias(v) for k, v in names.items()])


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that neither the base limits nor a rule rejects, with the columns of docs, whatever their names.

    A null or empty text fails; a text of any length is judged whole; rows with equal texts stay or go together. An empty
    table stays empty, and without labels only the base limits reject.
    """
    safe, names = set_aside(docs, "__q_")
    return judge_documents(safe, labels, rows).where("__q_kept").select(*safe.columns).withColumnsRenamed(names)

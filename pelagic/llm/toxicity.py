"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features: densities of a fixed lexicon, of learned words and of learned word beginnings, nearness of second-person words,
capitals, punctuation and obfuscation. The learned lexicon and the trees see a bounded labelled sample; features of a
training document come from a lexicon learned without its fold, so that the trees don't trust what was learned by heart.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classifiers import collect_features, labelled_sample, score_documents
from .common import materialize, small_batches
from .gbdt import fit_forest, fit_isotonic

#: Bound of the labelled sample.
SAMPLE_ROWS = 12_000
FOLDS = 4
#: Most terms in the learned lexicon.
LEXICON_TERMS = 600
#: Seen verdicts on words that a worker keeps before it starts anew.
CACHE_ENTRIES = 400_000
#: Common insults, by language.
INSULTS = frozenset(
    """idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown fool
    imbecile jerk bastard bitch ass asshole crap damn shit fuck fucking hate ugly liar pig rat vermin filth filthy
    dumm idioten trottel arschloch scheisse abschaum wertlos widerlich hure schwein
    idiote imbécile connard salope merde stupide ordure abruti nul
    estúpido estúpida imbécil tonto tonta basura asqueroso mierda puta cabrón inútil""".split()
)
#: Second-person words, by language.
SECOND_PERSON = frozenset("you your yours yourself ur u du dich dir dein deine euch euer tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros".split())
#: Characters that stand in for letters.
STAND_INS = str.maketrans("013457@$!", "oieastasi")
NEAR = 5
WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[@$!*0-57][\w@$!*]*[\w@$]")
DOTTED = re.compile(r"\b(?:[^\W\d_][.\-*_ ]){3,}[^\W\d_]\b")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
WIDTH = 17


def terms_of(text: str) -> set[str]:
    """Candidate terms: whole words, and word beginnings of 4 to 7 letters marked by an asterisk."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in range(4, 8) if len(w) > k}


class ToxicFeatures:
    """Dense features of texts under a learned lexicon (term -> log odds)."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.seen: dict[str, tuple[int, float, float]] = {}

    def verdict(self, word: str) -> tuple[int, float, float]:
        """(fixed insult, log odds as a learned word, log odds of its best learned beginning)."""
        found = (int(word in INSULTS), self.lexicon.get(word, 0.0), max((self.lexicon.get(f"{word[:k]}*", 0.0) for k in range(4, min(8, len(word)))), default=0.0))
        if len(self.seen) >= CACHE_ENTRIES:
            self.seen = {}
        self.seen[word] = found
        return found

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.array([self.row(t) for t in texts], np.float64).reshape(len(texts), WIDTH)

    def row(self, text: str) -> list[float]:
        words = WORD.findall(text.lower())
        seen, verdict = self.seen, self.verdict
        hits, odds, n_fixed, n_word, n_start = [], 0.0, 0, 0, 0
        for i, w in enumerate(words):
            v = seen.get(w) or verdict(w)
            if v[0] or v[1] or v[2]:
                hits.append(i)
                odds += max(v[1], v[2])
                n_fixed, n_word, n_start = n_fixed + v[0], n_word + (v[1] > 0), n_start + (v[2] > 0)
        n, chars = max(1, len(words)), max(1, len(text))
        you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = 0
        if hits and you:
            at = np.searchsorted(you, hits)
            far = np.array([-(10**9), *you, 10**9])
            near = int((np.minimum(np.abs(far[at + 1] - hits), np.abs(np.array(hits) - far[at])) <= NEAR).sum())
        mixed = MIXED.findall(text)
        masked = sum(t.lower().translate(STAND_INS).replace("*", "") in INSULTS for t in mixed)
        dotted = DOTTED.findall(text)
        upper = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(text.translate(_NO_CAPITALS))
        return [
            n_fixed / n, n_word / n, n_start / n, np.log1p(n_fixed), np.log1p(n_word), np.log1p(n_start), odds / n, np.log1p(odds),
            len(you) / n, near / n, near / max(1, len(hits)), upper / chars, (text.count("!") + text.count("?")) / n,
            masked / n, (len(mixed) + len(dotted)) / n, len(STRETCHED.findall(text)) / n, np.log1p(len(words)),
        ]


_NO_CAPITALS = {c: None for c in range(65, 91)}


def term_statistics(sample: DataFrame, folds: int = FOLDS) -> tuple[list[tuple[str, np.ndarray, np.ndarray]], np.ndarray]:
    """(terms worth a look with documents by fold, toxic and not; documents by label and fold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, slot in zip(batch.column("text").to_pylist(), batch.column("slot").to_pylist()):
                counts.update((t, slot) for t in terms_of(text))
                counts["", slot] += 1
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in counts], pa.string()), pa.array([s for _, s in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["term", "slot", "n"])

    small_batches(sample.sparkSession)
    slotted = sample.select("text", (F.col("label") * folds + F.col("fold")).alias("slot"))
    by = slotted.mapInArrow(run, "term string, slot int, n long").groupBy("term").agg(*[F.sum(F.when(F.col("slot") == s, F.col("n")).otherwise(0)).alias(f"s{s}") for s in range(2 * folds)])
    neg, pos = (sum((F.col(f"s{k * folds + f}") for f in range(1, folds)), F.col(f"s{k * folds}")) for k in (0, 1))
    kept = by.where((F.col("term") == "") | ((pos >= 3) & (pos > neg / 4))).withColumn("odds", pos * F.log((pos + 0.5) / (neg + 0.5)))
    rows = kept.orderBy(F.col("term") != "", F.desc("odds"), "term").limit(8 * LEXICON_TERMS).collect()
    found = [(r["term"], np.array([r[f"s{folds + f}"] for f in range(folds)]), np.array([r[f"s{f}"] for f in range(folds)])) for r in rows]
    totals = np.array([[x.sum() for x in (n, p)] for t, p, n in found if t == ""] or [[0, 0]])[0]
    split = next(([n, p] for t, p, n in found if t == ""), [np.zeros(folds), np.zeros(folds)])
    return [x for x in found if x[0]], np.array(split) if totals.sum() else np.zeros((2, folds))


def _fold(folds: int):
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(folds)).cast("int")


def lexicon_of(terms: list[tuple[str, np.ndarray, np.ndarray]], totals: np.ndarray, without: int | None = None) -> dict[str, float]:
    """Terms of clearly toxic documents, with their log odds; a fold can be left out."""
    use = [f for f in range(totals.shape[1]) if f != without]
    n_neg, n_pos = totals[0][use].sum() + 1, totals[1][use].sum() + 1
    scored = []
    for term, pos, neg in terms:
        p, q = pos[use].sum(), neg[use].sum()
        odds = np.log((p + 0.5) / n_pos / ((q + 0.5) / n_neg))
        if p >= 3 and odds > np.log(12.0):
            scored.append((p * odds, term, float(odds)))
    return {t: o for _, t, o in sorted(scored, key=lambda s: (-s[0], s[1]))[:LEXICON_TERMS]}


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, label_col: str = "toxic"):
    """(features, model): from at most `rows` labelled documents outside the held-out fold."""
    sample = materialize(labelled_sample(docs, labels, label_col, rows).withColumn("fold", _fold(FOLDS)), "toxicity-sample")
    terms, totals = term_statistics(sample)
    apart = [ToxicFeatures(lexicon_of(terms, totals, f)) for f in range(FOLDS)]
    x, y, fold = collect_features(sample, lambda texts, folds: np.concatenate([apart[f]([t]) for t, f in zip(texts, folds)]), ("label", "fold"), by="fold")
    parts = [(x[fold == f], y[fold == f]) for f in range(FOLDS)]
    out_of_fold = [np.zeros(0)] * FOLDS
    for f, (own, _) in enumerate(parts):
        rest = [p for i, p in enumerate(parts) if i != f]
        out_of_fold[f] = fit_forest(np.concatenate([p[0] for p in rest]), np.concatenate([p[1] for p in rest]).astype(float)).probability(own)
    y = np.concatenate([p[1] for p in parts]).astype(float)
    forest = fit_forest(np.concatenate([p[0] for p in parts]), y)
    knots = fit_isotonic(np.concatenate(out_of_fold), y)
    return ToxicFeatures(lexicon_of(terms, totals)), lambda x: np.interp(forest.probability(x), *knots)


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs (columns doc_id and text; others are not read).

    A null text scores as an empty one; a text of any length is read whole; a null doc_id stays, and belongs to the fold of
    an empty one. Rows with equal texts get equal scores. Without usable labels, or with one class
    alone, every score is the same. An empty table gives no rows.
    """
    features, model = fit_toxicity(docs, labels, rows)
    return score_documents(docs, features, model, cut)

"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from .classifiers import collect_features, labelled_sample, score_documents
from .gbdt import fit_forest

#: Bound of the labelled sample.
SAMPLE_ROWS = 20_000
WIDTH = 21
_CLASSES = {
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (9, 10, 11, 12, 13, 32),
    "symbol": b"#*$%&|<>~^=+{}[]\\_@/`",
    "stop": b".!?",
    "mark": b",;:'\"()-",
}


def statistics(texts: list[str]) -> np.ndarray:
    """Statistics of each text: sizes, character classes, repetition of words and lines. Empty: mostly zeros."""
    out = np.zeros((len(texts), WIDTH))
    for row, text in zip(out, texts):
        raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256) if text else np.zeros(256, np.int64)
        total = max(1, int(raw.sum()))
        words = text.split()
        n = max(1, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
        tally = Counter(words)
        lines = [x for x in text.split("\n") if x.strip()]
        m = max(1, len(lines))
        row[:6] = [raw[list(c)].sum() / total for c in _CLASSES.values()]
        row[6:] = [
            raw[128:].sum() / total, raw[124] / n, raw[33] / n, np.log1p(len(words)), np.log1p(len(text)),
            len(tally) / n, max(tally.values(), default=0) / n, sum(map(str.__eq__, words, words[1:])) / n,
            lengths.mean(), lengths.std(), min(1000, lengths.max()), sum(map(str.isupper, words)) / n,
            1 - len(set(lines)) / m, sum(x.rstrip()[-1] in ".!?" for x in lines) / m, n / m,
        ]
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, label_col: str = "quality"):
    """The forest, from at most `rows` labelled documents outside the held-out fold."""
    x, y = collect_features(labelled_sample(docs, labels, label_col, rows), statistics)
    return fit_forest(x, y.astype(float), trees=80, depth=4)


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs (columns doc_id and text; others are not read).

    A null text scores as an empty one; a text of any length is read whole; a null doc_id stays, and belongs to the fold of
    an empty one. Rows with equal texts get equal scores. Without usable labels, or with one class
    alone, every score is the same. An empty table gives no rows.
    """
    forest = fit_quality(docs, labels, rows)
    return score_documents(docs, statistics, forest.probability, cut)

"""What the two classifiers share: the fold of a document, the bounded labelled sample, scoring of batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the documents whose labels are never learned from; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most `rows` labelled documents outside the held-out fold, as (doc_id, text, label): those of lowest hash.

    Rows with a null label are left out; of several labels of a document one counts (the largest), of several texts of an
    id too. The sampled ids and labels are a table of at most `rows` rows of two numbers, so that it is broadcast to the
    scan of the texts.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    picked = (
        usable.groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("__id"), "__id").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
    return found.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("doc_id", "text", "label")


def collect_features(sample: DataFrame, features: Callable[..., np.ndarray], extra: tuple[str, ...] = ("label",), by: str | None = None) -> tuple[np.ndarray, ...]:
    """(features, *extra columns) of a bounded sample, computed on the executors, in doc_id order.

    features gets the texts of a batch, and the values of column `by` if that is given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = features(*[batch.column(c).to_pylist() for c in ("text", by) if c])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(c) for c in extra], pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", *extra, "x"])

    small_batches(sample.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in sample.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *extra)) + ", x array<double>"
    rows = sorted(sample.mapInArrow(run, schema).collect(), key=lambda r: (r["doc_id"], list(r["x"])))
    x = np.array([r["x"] for r in rows], np.float64)
    return x.reshape(len(rows), -1) if rows else np.zeros((0, 1)), *[np.array([r[c] for r in rows], np.int64) for c in extra]


def score_documents(
    docs: DataFrame, features: Callable[[list[str]], np.ndarray], model: Callable[[np.ndarray], np.ndarray], cut: float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score in [0, 1] and predicted (score >= cut) for every row of docs; null text scores as empty."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.clip(model(features(batch.column("text").to_pylist())), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")

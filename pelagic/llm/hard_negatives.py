"""Hard negatives for contrastive training, by LEMP-style coordinate pruning of inner-product searches.

Rows with equal vectors and labels are one class that keeps its few smallest ids, so that a very common vector costs no
more than a rare one. Classes lie in buckets of similar length, of a bounded number of vectors; a bucket holds, besides
its vectors, for each coordinate the list of its vectors in the order of that coordinate. Anchors come in groups of a
bounded size; a group meets every bucket that is long enough.

For an anchor q and a score s to be reached, a vector p of a bucket has to lie within arccos(t) of q, t = s / (|q| * length);
so each coordinate of p / |p| has to lie within arccos(t) of that of q / |q|, both taken as angles. For the anchor's
largest coordinates, binary searches in the sorted lists give the feasible places; what lies in all of them is verified
with exact integers. s rises with what a task has found, longest buckets first, and starts at what the longest bucket
of all gives.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shared_dir

#: Vectors of a bucket, and the width of a bucket's lengths (a factor of exp(LEVEL / 2)): at most some 900 levels.
BUCKET_ROWS, LEVEL = 4096, 0.1
#: Components of the anchors of a group, which goes to all workers: some 8 MB.
GROUP_COMPONENTS = 2_000_000
#: Coordinates of an anchor whose lists are met.
FOCUS = 4
NONE = np.iinfo(np.int64).max
INDEX = "level int, chunk long, rows int, low double, high double, labels binary, ids binary, vectors binary, lists binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def valid(rows: DataFrame, vec_col: str = "vector", label_col: str = "label", id_col: str = "vec_id") -> DataFrame:
    """(vec_id long, label long, vector array<long>): of the rows that repeat an id, the one of smallest label and vector.

    Rows with a null id, label or vector, or with a null component, take no part.
    """
    kept = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda x: x.isNull()))
    own = F.struct(F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<long>").alias("vector"))
    return kept.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(own).alias("own")).select("vec_id", "own.label", "own.vector")


def build_index(rows: DataFrame, keep: int) -> DataFrame:
    """The buckets of the classes of rows (vec_id, label, vector), each class with its `keep` smallest ids, written once."""
    first = Window.partitionBy("label", "vector").orderBy("vec_id")
    classes = rows.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= keep).groupBy("label", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    classes = materialize(classes.withColumn("square", square).withColumn("level", F.floor(F.log1p("square") / LEVEL).cast("int")), "negatives-classes")
    levels = classes.groupBy("level").agg((1 + F.floor(F.count(F.lit(1)) / BUCKET_ROWS)).alias("chunks"))
    dealt = classes.join(F.broadcast(levels), "level").withColumn("chunk", F.pmod(F.xxhash64("label", "vector"), F.col("chunks")))

    def pack(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("vector"))
        ids = np.full((len(vectors), keep), NONE, np.int64)
        for k, own in enumerate(group.column("ids").to_pylist()):
            ids[k, : len(own)] = own
        norms = np.sqrt(group.column("square").to_numpy())
        lists = np.argsort(vectors / np.where(norms == 0, 1, norms)[:, None], axis=0, kind="stable").astype(np.int32)
        row = {
            "level": group.column("level")[0].as_py(), "chunk": group.column("chunk")[0].as_py(), "rows": len(vectors), "low": float(norms.min()), "high": float(norms.max()),
            "labels": group.column("label").to_numpy().astype(np.int64).tobytes(), "ids": ids.tobytes(), "vectors": vectors.tobytes(), "lists": lists.tobytes(),
        }
        kinds = {"level": pa.int32(), "chunk": pa.int64(), "rows": pa.int32(), "low": pa.float64(), "high": pa.float64()}
        return pa.table({name: pa.array([value], kinds.get(name, pa.binary())) for name, value in row.items()})

    return materialize(dealt.groupBy("level", "chunk").applyInArrow(pack, INDEX), "negatives-index")


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Integer vectors as the rows of a matrix; shorter ones end in zeros."""
    lists = vectors.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), sizes.max(initial=0)), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Bucket:
    def __init__(self, row: dict, keep: int) -> None:
        n = row["rows"]
        self.low, self.high = row["low"], row["high"]
        self.labels, self.ids = np.frombuffer(row["labels"], np.int64), np.frombuffer(row["ids"], np.int64).reshape(n, keep)
        whole = np.frombuffer(row["vectors"], np.int64).reshape(n, -1)
        norms = np.sqrt((whole.astype(np.float64) ** 2).sum(1))
        self.order = np.frombuffer(row["lists"], np.int32).reshape(whole.shape)
        self.sorted = np.take_along_axis(whole / np.where(norms == 0, 1, norms)[:, None], self.order, 0)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(n, dtype=np.int32)[:, None], 0)
        self.whole, self.as_kind = whole, {}

    def scores(self, q: np.ndarray, norm: float, found: np.ndarray | None) -> np.ndarray:
        """Exact inner products with the found vectors (None: all): no sum passes |q| * |p|, so that floats of enough bits are exact."""
        kind = np.float32 if norm * self.high < 2**23 else np.float64 if norm * self.high < 2**52 else object
        if kind not in self.as_kind:
            self.as_kind[kind] = self.whole.astype(kind)
        vectors = self.as_kind[kind]
        return ((vectors if found is None else vectors[found]) @ q.astype(kind)).astype(np.int64)

    def feasible(self, q: np.ndarray, norm: float, focus: np.ndarray, least: float) -> np.ndarray | None:
        """Places of the vectors whose focus coordinates allow a score of `least`, or None for all of them."""
        length = self.high if least >= 0 else self.low
        if norm * self.high == 0:
            return None if least <= 0 else np.zeros(0, np.int64)
        t = -1.0 if norm * length == 0 else least / (norm * length)
        if t <= -1:
            return None
        if t > 1 + 1e-9:
            return np.zeros(0, np.int64)
        around = np.arccos(min(1.0, t))
        at = np.arccos(np.clip(q[focus] / norm, -1, 1))
        low, high = np.cos(np.minimum(np.pi, at + around)) - 1e-9, np.cos(np.maximum(0, at - around)) + 1e-9
        ranges = []
        for f, a, b in zip(focus, low, high):
            begin, end = np.searchsorted(self.sorted[:, f], a), np.searchsorted(self.sorted[:, f], b, "right")
            if end - begin < len(self.sorted):
                ranges.append((end - begin, f, begin, end))
        if not ranges:
            return None
        (_, f, begin, end), *others = sorted(ranges)
        found = self.order[begin:end, f]
        for _, g, begin, end in others:
            place = self.place[found, g]
            found = found[(place >= begin) & (place < end)]
        return found


class Best:
    """The k best (score, id) of some searches, by score downwards, then id."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.score, self.id = k, np.full((n, k), -NONE, np.int64), np.full((n, k), NONE, np.int64)

    def least(self, n: int) -> int:
        """The score from which a row may still enter."""
        return int(self.score[n, -1])

    def add(self, n: int, scores: np.ndarray, ids: np.ndarray, but: int) -> None:
        """scores of classes, the classes' ids (a row each), and an id that doesn't count. Only k + 1 classes can matter."""
        if len(scores) > self.k + 1:
            least = np.partition(scores, -self.k - 1)[-self.k - 1]
            scores, ids = scores[scores >= least], ids[scores >= least]
            first = np.lexsort((ids[:, 0], -scores))[: self.k + 1]
            scores, ids = scores[first], ids[first]
        flat, own = ids.ravel(), np.repeat(scores, ids.shape[1])
        real = (flat != NONE) & (flat != but)
        own, flat = np.concatenate([self.score[n], own[real]]), np.concatenate([self.id[n], flat[real]])
        first = np.lexsort((flat, -own))[: self.k]
        self.score[n], self.id[n] = own[first], flat[first]


class Anchors:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.focus = np.argsort(-np.abs(vectors), axis=1, kind="stable")[:, :FOCUS]

    def fitted(self, a: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """An anchor's vector in a bucket's width, and those of its focus coordinates that the bucket has."""
        q = np.zeros(width, np.int64)
        q[: min(width, self.vectors.shape[1])] = self.vectors[a, :width]
        return q, self.focus[a][self.focus[a] < width]


def _buckets(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[Bucket]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Bucket(batch.slice(k, 1).to_pylist()[0], keep)


def _positives(group: Anchors, start: np.ndarray, wanted: int, keep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best = Best(len(group.ids), wanted)
    for bucket in _buckets(batches, keep):
        for a in range(len(group.ids)):
            q, focus = group.fitted(a, bucket.whole.shape[1])
            least = max(int(start[a]), best.least(a))
            found = bucket.feasible(q, group.norms[a], focus, least)
            scores = bucket.scores(q, group.norms[a], found)
            labels, ids = (bucket.labels, bucket.ids) if found is None else (bucket.labels[found], bucket.ids[found])
            good = np.flatnonzero((scores >= least) & (labels == group.labels[a]))
            if len(good):
                best.add(a, scores[good], ids[good], int(group.ids[a]))
    a, k = np.nonzero(best.id != NONE)
    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(best.id[a, k]), pa.array(best.score[a, k])], names=["a", "other", "score"])


def _negatives(group: Anchors, windows: np.ndarray, wanted: int, keep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """windows: (a, lowest, highest score) of each search, by a."""
    best = Best(len(windows), wanted)
    begins = np.searchsorted(windows[:, 0], np.arange(len(group.ids) + 1))
    for bucket in _buckets(batches, keep):
        for a in range(len(group.ids)):
            own = range(begins[a], begins[a + 1])
            if not own:
                continue
            q, focus = group.fitted(a, bucket.whole.shape[1])
            least = [max(int(windows[w, 1]), best.least(w)) for w in own]
            found = bucket.feasible(q, group.norms[a], focus, min(least))
            scores = bucket.scores(q, group.norms[a], found)
            labels, ids = (bucket.labels, bucket.ids) if found is None else (bucket.labels[found], bucket.ids[found])
            other = np.flatnonzero((scores >= min(least)) & (labels != group.labels[a]))
            scores, ids = scores[other], ids[other]
            for w, low in zip(own, least):
                good = np.flatnonzero((scores >= low) & (scores <= windows[w, 2]))
                if len(good):
                    best.add(w, scores[good], ids[good], int(group.ids[a]))
    w, k = np.nonzero(best.id != NONE)
    yield pa.RecordBatch.from_arrays([pa.array(w.astype(np.int32)), pa.array(best.id[w, k]), pa.array(best.score[w, k])], names=["a", "other", "score"])


def _merged(found: DataFrame, wanted: int) -> DataFrame:
    """The first `wanted` of each search over what all tasks found: (a, rank, other, score)."""
    w = Window.partitionBy("a").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= wanted).select("a", "rank", "other", "score")


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows needs vec_id, label and vector, an array of whole numbers; other columns are not read. Anchors are the rows that
    `anchor`, a condition on vec_id, chooses. An anchor's positives are the `positives` other rows of its label with the highest inner
    products; a positive's negatives are the first `negatives` rows of another label whose product, in percent of the
    positive's, is within low and high. Ties go to the smaller id; fewer come where there are fewer. Rows with a null id,
    label, vector or component take no part; of the rows that repeat an id one counts (see `valid`). A shorter vector
    ends in zeros; an empty one scores 0. An empty table, or one without anchors, gives no rows.
    """
    spark, keep = rows.sparkSession, max(positives, negatives) + 1
    rows = materialize(valid(rows), "negatives-rows")
    index = build_index(rows, keep)
    longest = index.agg(F.max(F.struct("level", "chunk"))).first()[0]
    chosen = rows.where(F.coalesce(anchor, F.lit(False)))
    sizes = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum(1 + F.size("vector")).alias("size")).first()
    groups = 1 + (sizes["size"] or 0) // GROUP_COMPONENTS
    path = f"{shared_dir(spark)}/negatives-{uuid.uuid4().hex}"
    spark.createDataFrame([], RESULT).write.parquet(path)
    for g in range(groups if longest else 0):
        own = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).toArrow()  # bounded by GROUP_COMPONENTS
        group = spark.sparkContext.broadcast(Anchors(own.column("vec_id").to_numpy(), own.column("label").to_numpy(), _matrix(own.column("vector"))))
        norms, n = group.value.norms, own.num_rows
        if not n:
            continue
        search = lambda buckets, start: _merged(buckets.mapInArrow(lambda b: _positives(group.value, start, positives, keep, b), "a int, other long, score long"), positives)  # noqa: B023, E731
        start = np.full(n, -NONE, np.int64)
        for r in search(index.where((F.col("level") == longest["level"]) & (F.col("chunk") == longest["chunk"])), start).where(F.col("rank") == positives).collect():
            start[r["a"]] = r["score"]
        # a bucket that no anchor of the group needs is not read: its length is too short for a score that is there
        needed = np.where(start > 0, start / np.where(norms == 0, 1, norms), 0).min()
        best = search(index.where(F.col("high") >= float(needed) * (1 - 1e-9)).sortWithinPartitions(F.desc("level")), start).orderBy("a", "rank").toArrow()  # bounded by the group
        a, other, score = (best.column(c).to_numpy().astype(np.int64) for c in ("a", "other", "score"))
        windows = np.stack([a, -((-low * score) // 100), (high * score) // 100], 1)
        needed = np.where(norms[a] > 0, windows[:, 1] / np.where(norms[a] == 0, 1, norms[a]), 0).min(initial=np.inf)
        met = index.where(F.col("high") >= max(0.0, float(needed)) * (1 - 1e-9)).sortWithinPartitions(F.desc("level"))
        found = _merged(met.mapInArrow(lambda b: _negatives(group.value, windows, negatives, keep, b), "a int, other long, score long"), negatives)  # noqa: B023
        pairs = spark.createDataFrame(pa.table({"a": np.arange(len(a), dtype=np.int32), "anchor_id": group.value.ids[a], "positive_id": other, "positive_score": score}))
        result = found.join(F.broadcast(pairs), "a").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        result.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)

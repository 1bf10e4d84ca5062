"""Ranked lexical search by NRA: lists sorted by impact are read from the top, and no document is looked up.

One pass over the texts keeps, for each document, its length and how often it has each of the queries' terms. Over these
small rows, the counts of documents, terms and documents per term are exact sums; then every task searches its own
documents, shard by shard: a shard's postings are lists by term, sorted by impact. For an item, each step reads the
entries of all its lists down to a falling bound. A document that was seen has at least the sum of what was read of it,
at most that and the next impacts of the lists in which it wasn't seen. Once the unseen ones can't reach the k-th best
lower bound, only the seen ones go on whose upper bound does, ties included, until lower and upper bounds are equal.
What a task has found so far counts for its next shards. The tasks' best k of each item are merged by a window.

The items' terms go to all workers in blocks of a bounded size: a block of items is a pass over the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Bytes of the items' texts whose terms go to the workers at once.
BLOCK_BYTES = 4 << 20
#: Documents and postings of a shard.
SHARD_DOCS, SHARD_POSTINGS = 16_384, 4_000_000
#: Each step of a search reads down to this share of the highest impact that is left.
STEP = 0.6


def terms(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWER))


class Items:
    """The items of a block: texts become lists of (term number, how often)."""

    def __init__(self, texts: list[str]) -> None:
        self.numbers: dict[str, int] = {}
        self.of = [{self.numbers.setdefault(t, len(self.numbers)): n for t, n in Counter(terms(text)).items()} for text in texts]


def postings(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """(doc_id, n, t, f) of every document with a term: how many terms it has, which of the numbered ones, how often each."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            sizes, found, often = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms(text)
                own = Counter(t for t in map(number.get, words) if t is not None)
                sizes.append(len(words))
                found.append(list(own))
                often.append(list(own.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int32()))], names=["doc_id", "n", "t", "f"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, n long, t array<int>, f array<int>").where("n > 0")


class Shard:
    """Postings of some documents as one list per term, sorted by impact: docs[begin[t]:begin[t + 1]] and impacts alike."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, often: np.ndarray, m: np.ndarray, n_terms: int) -> None:
        impact = (1_000_000_000 * often) // (1000 * often + 12 * m[doc])
        order = np.lexsort((-impact, term))
        self.n_docs, self.docs, self.impacts = len(m), doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))

    def search(self, own: list[int], weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of all documents that may be among the k best of those with at least `floor` points (1 at least)."""
        lists = [(self.docs[a:b], w * self.impacts[a:b]) for t, w in zip(own, weights) if w and (a := self.begin[t]) < (b := self.begin[t + 1])]
        lower, seen = np.zeros(self.n_docs, np.int64), np.zeros((len(lists), self.n_docs), bool)
        at = [0] * len(lists)
        bars = np.array([points[0] for _, points in lists], np.int64)
        alive = None  # the documents that may still be among the best, once no unseen one can
        while bars.any():
            bound = int(bars.max() * STEP)
            for k_list, (docs, points) in enumerate(lists):
                if bars[k_list] > bound or bars[k_list] and not bound:
                    end = len(points) - int(np.searchsorted(points[::-1], bound, "right"))
                    read, gained = docs[at[k_list] : end], points[at[k_list] : end]
                    lower[read] += gained
                    seen[k_list, read] = True
                    at[k_list] = end
                    bars[k_list] = points[end] if end < len(points) else 0
            if alive is None:
                touched = np.flatnonzero(lower)
                best = max(floor, _kth(lower[touched], k))
                if bars.sum() < best:
                    alive = touched
            if alive is not None:
                upper = lower[alive] + bars @ ~seen[:, alive]
                best = max(floor, _kth(lower[alive], k))
                alive = alive[upper >= best]
                if not (bars @ ~seen[:, alive]).any():
                    break
        found = np.flatnonzero(lower >= floor) if alive is None else alive
        return found, lower[found]


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, -k)[-k]) if len(scores) >= k else 1


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of each item with the highest scores above 0.

    docs needs doc_id (whole numbers) and text, items item_id and text; other columns are not read. A null text has no terms;
    texts of any length are taken whole. Equal scores go by ascending doc_id, a null id comes last. Rows that repeat a
    doc_id are documents of their own. Equal rows of items are one; rows that repeat an item_id with another text are items
    of their own. An item without terms, or whose terms no document has, gives no rows, as do empty tables.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    blocks = 1 + (items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // BLOCK_BYTES
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()  # bounded by BLOCK_BYTES
        found = _search_block(docs, items.schema["item_id"].dataType.simpleString(), [r["item_id"] for r in own], Items([r["text"] for r in own]), k)
        out = found if out is None else out.unionByName(found)
    return out


def _search_block(docs: DataFrame, item_kind: str, ids: list, items: Items, k: int) -> DataFrame:
    spark, n_terms = docs.sparkSession, len(items.numbers)
    stored = materialize(postings(docs, items.numbers), "postings")
    n_docs, length = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(n_terms, np.int64)
    for r in stored.select(F.explode("t").alias("t")).groupBy("t").count().collect():  # at most a row for each of the block's terms
        holding[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in holding], np.int64)
    lists = spark.sparkContext.broadcast([(list(own), np.array([n * weights[t] for t, n in own.items()], np.int64)) for own in items.of])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in lists.value]  # (-score, id is null, id) of each item, in order
        for id_null, doc_ids, shard in _shards(batches, n_docs, length, n_terms):
            for item, (own, points) in enumerate(lists.value):
                had = best[item]
                found, scores = shard.search(own, points, k, -had[-1][0] if len(had) == k else 1)
                if len(found):
                    more = zip((-scores).tolist(), id_null[found].tolist(), doc_ids[found].tolist())
                    best[item] = sorted([*had, *more])[:k]
        rows = [(i, None if null else doc, -score) for i, own in enumerate(best) for score, null, doc in own]
        item, doc, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc", "score"])

    found = stored.mapInArrow(run, "item int, doc long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_kind}")  # of one block
    return first.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").cast(kind).alias("doc_id"), "score")


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, length: int, n_terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, Shard]]:
    """(which ids are null, ids, shard), of a bounded number of documents and postings each."""

    def made(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, Shard]:
        rows = pa.Table.from_batches(held).combine_chunks()
        t = rows.column("t").combine_chunks()
        doc = np.repeat(np.arange(rows.num_rows), t.value_lengths().to_numpy(zero_copy_only=False))
        flat = lambda c: rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        m = 75 + 25 * rows.column("n").to_numpy() * n_docs // length
        ids = rows.column("doc_id").combine_chunks()
        return ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), Shard(doc, flat("t"), flat("f"), m, n_terms)

    held, docs, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        docs, size = docs + batch.num_rows, size + len(batch.column("t").flatten())
        if docs >= SHARD_DOCS or size >= SHARD_POSTINGS:
            yield made(held)
            held, docs, size = [], 0, 0
    if docs:
        yield made(held)

"""Document fingerprints by I-Match over several randomised lexicons.

The lexicon is the terms inside a band of document frequency, counted over all documents. A fingerprint hashes the sorted
distinct terms of a text that lie in a random part of the lexicon, for several parts of several sizes: an edit leaves the
parts alone in which no changed term lies, and parts of some size fit texts of every length. The lower end of the band is
a share of all documents, so that the lexicon has at most (mean distinct terms of a document) / LOW terms at any scale.
Terms go by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import small_batches

#: The band of document frequency, as shares of all documents (inverse document frequency from ln 10 to ln 1000).
LOW, HIGH = 0.001, 0.1
#: Random parts of the lexicon: so many for each of the shares 2^-2 ... 2^-9.
SCALES, PARTS = range(2, 10), 5
#: A text with fewer terms in the band uses all its terms; one without any word is hashed as it stands.
MIN_TERMS = 8
#: Bytes of text of a range of consecutive ids, that is of a task, about; ranges at most.
RANGE_BYTES, MAX_RANGES = 16 << 20, 50_000
#: Ids sampled for a range's bounds, about.
RANGE_SAMPLE = 20
#: Terms counted in a worker before they are handed on.
FLUSH_TERMS = 300_000
#: Places in the lexicon of so many different terms of at most LONG letters are kept in a worker; then it starts anew.
CACHE_ENTRIES, LONG = 400_000, 64
WORD = re.compile(r"[^\W_]+")
WIDTH = 8
EMPTY = "0" * WIDTH


def term_hash(term: str) -> int:
    return xxh64_intdigest(term) - (1 << 63)


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency over all rows of docs lies in the band (at least 2 documents)."""

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([term_hash(t) for t in counts], pa.int64()), pa.array(counts.values(), pa.int32())], names=["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(set(WORD.findall(text.as_py().lower())))
                if len(counts) >= FLUSH_TERMS:
                    yield counted(counts)
                    counts = Counter()
        yield counted(counts)

    total = docs.count()
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = texts.mapInArrow(run, "term long, n int").groupBy("term").agg(F.sum("n").alias("n"))
    rows = df.where(F.col("n").between(max(2.0, low * total), max(2.0, high * total))).select("term").collect()
    return np.sort(np.array([r["term"] for r in rows], np.int64))


class Fingerprinter:
    def __init__(self, terms: np.ndarray) -> None:
        self.terms, self.hashes = terms, terms.view(np.uint64)
        self.parts = membership(self.hashes)
        self.known: dict[str, int] = {}

    def places(self, words: list[str]) -> np.ndarray:
        """Sorted places in the lexicon of those of the words that it has."""
        at = list(map(self.known.get, words))
        if None in at:
            fresh = [k for k, i in enumerate(at) if i is None]
            if len(self.known) + len(fresh) > CACHE_ENTRIES:
                self.known = {}
            hashes = np.array([term_hash(words[k]) for k in fresh], np.int64)
            found = np.searchsorted(self.terms, hashes)
            there = found < len(self.terms)
            there[there] = self.terms[found[there]] == hashes[there]
            for k, i in zip(fresh, np.where(there, found, -1).tolist()):
                at[k] = i
                if len(words[k]) <= LONG:
                    self.known[words[k]] = i
        places = np.array(at, np.int64)
        return np.sort(places[places >= 0])

    def __call__(self, text: str) -> str:
        words = list(set(WORD.findall(text.lower())))
        if not words:
            return hashlib.blake2b(text.encode(), digest_size=WIDTH // 2).hexdigest() * (len(SCALES) * PARTS)
        at = self.places(words)
        if len(at) >= MIN_TERMS:
            hashes, parts = self.hashes[at], self.parts[at]
        else:
            hashes = np.sort(np.array([term_hash(t) for t in words], np.int64)).view(np.uint64)
            parts = membership(hashes)
        some = parts.any(0)
        return "".join(hashlib.blake2b(hashes[parts[:, k]].tobytes(), digest_size=WIDTH // 2).hexdigest() if some[k] else EMPTY for k in range(parts.shape[1]))


def membership(hashes: np.ndarray) -> np.ndarray:
    """Whether a term lies in each part of the lexicon: bits of its hash, mixed with the part's number."""
    out = np.zeros((len(hashes), len(SCALES) * PARTS), bool)
    for k in range(out.shape[1]):
        with np.errstate(over="ignore"):
            x = (hashes ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = (x >> np.uint64(40)) % np.uint64(2 ** SCALES[k // PARTS]) == 0
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal parts among those that hold a term of either text; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    pairs = [(a[i : i + WIDTH], b[i : i + WIDTH]) for i in range(0, len(a), WIDTH)]
    used = [(x, y) for x, y in pairs if x != EMPTY or y != EMPTY]
    return sum(x == y for x, y in used) / len(used) if used else 0.0


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key, tie, row) in ranges of ascending doc_id, one shuffle of the texts. Null ids come first.

    Rows of one id follow each other by the hash of their texts and then as they come, so that many of them fill several
    ranges; equal rows may change places. The ranges' bounds are fixed here, from a sample of the ids, so that every plan
    that uses the result cuts it alike, whether or not it shares the exchange.
    """
    size, rows = docs.agg(F.sum(F.octet_length("text").cast("long")), F.count(F.lit(1))).first()
    ranges = int(min(MAX_RANGES, max(1, (size or 0) // RANGE_BYTES)))
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")]
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select("*", *own)
    some = d.where(F.pmod(F.xxhash64("key", "row"), F.lit(max(1, rows // (ranges * RANGE_SAMPLE)))) == 0) if ranges > 1 else d.limit(0)
    seen = sorted(map(tuple, some.select("key", "tie", "row").collect()))  # about RANGE_SAMPLE rows a range
    bounds = docs.sparkSession.sparkContext.broadcast(list(dict.fromkeys(seen[k * len(seen) // ranges] for k in range(1, ranges))) if seen else [])

    @F.pandas_udf("int")
    def range_of(key: pd.Series, tie: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series([bisect_left(bounds.value, x) for x in zip(key.tolist(), tie.tolist(), row.tolist())], dtype="int32")

    return d.withColumn("range", range_of("key", "tie", "row")).repartitionById(ranges, "range")


def seams(ordered: DataFrame) -> DataFrame:
    """(doc_id, text, next): the last row of every range with the first text of the range after it, that of the last with the very first."""
    kind = ordered.schema["doc_id"].dataType.simpleString()
    order = ("key", "tie", "row")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if not batch.num_rows:
                continue
            by = np.lexsort([batch.column(c).to_numpy() for c in reversed(order)])
            first, last = (batch.slice(int(by[k]), 1) for k in (0, -1))
            at = lambda row: tuple(row.column(c)[0].as_py() for c in order)
            low = first if low is None or at(first) < at(low) else low
            high = last if high is None or at(last) > at(high) else high
        if low is not None:
            yield pa.RecordBatch.from_arrays([low.column("range"), high.column("doc_id"), high.column("text"), low.column("text")], names=["part", "doc_id", "text", "head"])

    found = ordered.mapInArrow(ends, f"part int, doc_id {kind}, text string, head string")  # a row for each range
    # a range holds the row that bounds it, so that those with rows are numbered from 0 without gaps
    tail = F.struct(F.col("part").alias("slot"), F.struct("doc_id", "text").alias("tail"), F.lit(None).cast("string").alias("head"))
    head = F.struct((F.col("part") - 1).alias("slot"), F.lit(None).cast(f"struct<doc_id:{kind},text:string>").alias("tail"), F.col("head").alias("head"))
    sides = found.select(F.explode(F.array(tail, head)).alias("s")).select("s.*")

    def paired(rows: DataFrame, slot: Column) -> DataFrame:
        return rows.groupBy(slot.alias("slot")).agg(F.first("tail", True).alias("tail"), F.first("head", True).alias("head"))

    met = paired(sides, F.col("slot"))
    met = paired(met, F.when(F.col("tail").isNotNull() & F.col("head").isNotNull(), F.col("slot")).otherwise(-1))  # the last with the first
    return met.select("tail.doc_id", "tail.text", F.col("head").alias("next"))


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of docs.

    The edited text is the text whose last floor(n_chars / 4) code points gave way to the first as many of the next
    document. docs needs doc_id (whole numbers) and text; other columns are not read. A null text is empty. Equal texts
    have equal fingerprints. Null ids come before all others; rows that repeat an id follow each other by a hash of their
    texts. A text of any length is taken whole. An empty table gives no rows; a single document is its own next.
    """
    spark = docs.sparkSession
    small_batches(spark)
    terms = spark.sparkContext.broadcast(lexicon(docs, low, high))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def row(make: Fingerprinter, doc: int | None, text: str, own: str, after: str, after_print: str) -> tuple:
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        edited_print = make(edited)
        return doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, edited_print, likeness(own, edited_print), likeness(own, after_print)

    def batch_of(out: list[tuple], doc_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        kinds = [doc_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, last = Fingerprinter(terms.value), None
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = make(text)
                if last is not None:
                    out.append(row(make, *last, text, own))
                last = (doc, text, own)
            yield batch_of(out, batch.column("doc_id").type)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter(terms.value)
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "next")])
            yield batch_of([row(make, doc, text, make(text), after, make(after)) for doc, text, after in rows], batch.column("doc_id").type)

    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ordered = in_order(docs)
    inner = ordered.sortWithinPartitions("key", "tie", "row").mapInArrow(within, schema)
    return inner.unionByName(seams(ordered).mapInArrow(between, schema))

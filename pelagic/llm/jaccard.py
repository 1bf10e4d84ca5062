"""N-gram Jaccard join by parity sketches.

Two sets of sizes a and b with a Jaccard similarity of at least 0.75 differ in at most (a + b) / 7 elements. Every element
is XORed into a part of a sketch that its hash chooses, so that at most so many parts of two sketches differ.

Pigeonhole. Sets are banded by the powers of two of their sizes (a set in the top quarter of a band joins the next one,
too) and a band has one division into parts. Let D = n // 3, which bounds the difference of a set of n elements to any
partner. The set emits, in part order, D + 1 of its parts that are not empty, and n // 8 more, its slack. Of those that
the set which stops first emits, more than its slack are untouched by the difference, hence equal in both and emitted by
both. With m, the smaller slack of the two, linked sets share m + 1 parts at least: joining on (band, part, content) finds
every pair, and pairs that share fewer are none.

Hot parts. A part shared by more than GROUP sets gives no pairs. A set with h hot parts shares at most h of them, so that
a pair needs m + 1 - min(h, h') other parts. Only where that is no more than none, both sets with more hot parts than the
least slack of a partner, a link may show in hot parts alone. Such sets share m + 1 hot parts, hence, with all hot parts
in one order, the rarest first, one of the first h - m of either: of these prefixes each part ties its sets to one of
them. The task that reads the texts already knows many parts as hot, those that more than GROUP of its own sets share: of
such a part it sends GROUP + 1 sets to the join, enough to show there that it is hot, and keeps the others out of it. A
key of the join so has at most GROUP + 1 sets a task, and those that came alone in a flush of a task, which are not counted.

Clusters. Pairs with parts enough, and sets tied by hot parts, are edges; a connected component of them, a cluster, holds
every link of its sets. Sets travel to blocks of their cluster, of bounded sets and elements. There, pairs not yet
connected are compared by the Hamming distance of whole parity sketches, a lower bound of the difference, and what remains
is verified on the sets themselves. A task gives at most one link fewer than it has sets, enough to connect what is linked.
A cluster of several blocks is first compared within each, together with some typical sets. What that leaves outside the
cluster's largest component, the strays, then meets all blocks whose sizes allow links; members of that component need not
meet each other, so that a family of near copies costs no square of its size.

Equal sets are one class from the start. Classes, shingles and parts go by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import join_counted, materialize, small_batches
from .components import components

SHINGLE = 5
#: Sets that may share a part before it is hot.
GROUP = 8
#: Entries (12 bytes) of a bucket of the key join, about.
BUCKET_ENTRIES = 500_000
#: Tasks of the key join at most; beyond, a task has several buckets, one after the other.
MAX_TASKS = 20_000
#: Entries gathered in a worker before they are handed on.
FLUSH_ENTRIES = 500_000
#: Parts whose sets a task counts beyond a flush; with more of them it begins anew, and sends some parts' sets again.
COUNTED_PARTS = 1_000_000
#: Sets of hot parts in a row that goes past the join.
LOOSE_ENTRIES = 50_000
#: Sets and elements of a block of a cluster, about; a larger set is a block by itself.
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 1 << 20
#: Typical sets of a slice of a large cluster that all blocks near it are compared with.
PIVOTS = 8
#: Up to so many document numbers, with four visits to blocks each on average (some 40 bytes a visit), are broadcast to the
#: scan that fetches their texts; beyond, they are joined by shuffle.
BROADCAST_IDS = 200_000

#: A-Z to a-z and the other white space to spaces.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking number for each byte.
_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(text: str | None) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles; none for a text without words."""
    h = word_hashes(text.encode()) if text else np.zeros(0, np.uint64)
    width = min(SHINGLE, len(h))
    if not width:
        return h
    x = _mix(h[: len(h) - width + 1] + np.uint64(width))
    for k in range(1, width):
        x = _mix(x * np.uint64(31) + h[k : len(h) - width + 1 + k])
    return np.unique(x)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order, without making them: differences of a running polynomial sum.

    The sum up to each byte weighs it by a power of an odd number; a word's share, times the inverse of the power at its
    start, depends on the word alone.
    """
    letters = np.frombuffer(raw.translate(_BYTES), np.uint8)
    word = letters != 32
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(letters))
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_LETTERS[letters] * power[: len(letters)], out=total[1:])
    return _mix((total[end] - total[start]) * inverse[start] + _mix((end - start).astype(np.uint64)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, as many as the longest text so far needs."""
    if len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors)
    return _POWERS[0], _POWERS[1]


def _band(n: int) -> int:
    return int(n).bit_length() - 1


def bands(n: int) -> list[int]:
    """The bands in which a set of n elements meets its partners: its own, and the next if one may lie there."""
    k = _band(n)
    return [k, k + 1] if 4 * n >= 3 * 2 ** (k + 1) else [k]


def n_parts(band: int) -> int:
    """Enough parts that a set has far more of them than it must emit; small sets get one for each element, nearly."""
    top = 2 ** (band + 1)
    return 1 << 20 if top <= 16 else 4 * top if top < 512 else top * 3 // 4


def slack(n: int) -> int:
    return n // 8


def least_slack(n: Column) -> Column:
    """The slack of the smallest set that may link with one of n elements."""
    return F.floor(F.floor((3 * n + 3) / 4) / 8)


def part_keys(elements: np.ndarray, band: int) -> np.ndarray:
    """Hashes of (band, part, content) of the parts that a set emits."""
    part = (elements >> np.uint64(16)) % np.uint64(n_parts(band))
    order = np.argsort(part, kind="stable")
    part = part[order]
    start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])[: len(elements) // 3 + 1 + slack(len(elements))]
    end = np.searchsorted(part, part[start[-1]], side="right")
    content = np.bitwise_xor.reduceat(elements[order][:end], start)
    return _mix(content ^ _mix(part[start] * np.uint64(64) + np.uint64(band + 1)))


def sketch(elements: np.ndarray, band: int) -> np.ndarray:
    """The whole parity sketch for pairs whose larger set is in the band: a bit for each place, flipped by every element that hashes there."""
    bits = max(512, 2 ** (band + 4))
    place, times = np.unique((elements >> np.uint64(8)) % np.uint64(bits), return_counts=True)
    odd = np.zeros(bits, np.uint8)
    odd[place[times % 2 == 1].astype(np.int64)] = 1
    return np.packbits(odd).view(np.uint64)


def _class(elements: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


def _ids(docs: DataFrame) -> DataFrame:
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id has to be a whole number")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


class SentParts:
    """How many sets of each part a task has sent to the join, up to one more than may share a part that is not hot."""

    def __init__(self, group: int) -> None:
        self.most = group + 1
        self.parts, self.sent = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def sends(self, part: np.ndarray) -> np.ndarray:
        """Which entries to send, of sorted parts with one entry for each set: the first of every part, up to most in all."""
        start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        size = np.diff(np.r_[start, len(part)])
        name, before = part[start], np.zeros(len(start), np.int64)
        at = np.searchsorted(self.parts, name)
        at[at == len(self.parts)] = 0
        known = self.parts[at] == name if len(self.parts) else np.zeros(len(name), bool)
        before[known] = self.sent[at[known]]
        after = np.minimum(before + size, self.most)
        self.sent[at[known]] = after[known]
        new = ~known & (size > 1)  # most parts are of one set: these are not kept
        parts, sent = np.r_[self.parts, name[new]], np.r_[self.sent, after[new]]
        if len(parts) > COUNTED_PARTS:
            parts, sent = parts[:0], sent[:0]
        order = np.argsort(parts, kind="stable")
        self.parts, self.sent = parts[order], sent[order]
        return np.arange(len(part)) - np.repeat(start, size) < np.repeat(after - before, size)


def keyed(docs: DataFrame, buckets: int, group: int = GROUP) -> DataFrame:
    """One pass over the texts, of three kinds of rows.

    (doc_id, n, node) for every row of docs: the size and the class of its set; no class without words or without id.
    (bucket, blob, false): emitted parts, as keys within the bucket (32 bits) and nodes (64 bits), one set of each class per partition.
    (any bucket, blob, true): parts (64 bits) and nodes of those parts of which the partition has sent more than group nodes.
    """
    names = ["bucket", "blob", "loose", "doc_id", "n", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = rows = 0

        sent = SentParts(group)

        def flush() -> pa.RecordBatch:
            key, node = np.concatenate(keys), np.concatenate(owners)
            keys.clear(), owners.clear()
            part = (key >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | key & np.uint64(0xFFFFFFFF)
            order = np.argsort(part, kind="stable")
            part, node = part[order], node[order]
            first = np.r_[True, (part[1:] != part[:-1]) | (node[1:] != node[:-1])]  # two keys of a set may be one here
            part, node = part[first], node[first]
            goes = sent.sends(part)
            bucket, short = (part >> np.uint64(32)).astype(np.int64), part.astype(np.uint32)
            hot, of = short[~goes].astype(np.int64) * buckets + bucket[~goes], node[~goes]
            bucket, short, node = bucket[goes], short[goes], node[goes]
            start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
            blobs = [short[a:b].tobytes() + node[a:b].tobytes() for a, b in zip(start, np.r_[start[1:], len(bucket)])]
            cuts = np.arange(0, len(hot), LOOSE_ENTRIES)
            loose = [hot[a : a + LOOSE_ENTRIES].tobytes() + of[a : a + LOOSE_ENTRIES].tobytes() for a in cuts]
            target = np.r_[bucket[start], (rows + cuts // LOOSE_ENTRIES) % buckets].astype(np.int32)
            kinds = pa.array([False] * len(blobs) + [True] * len(loose))
            none = pa.nulls(len(target), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(target), pa.array(blobs + loose, pa.binary()), kinds, none, none, none], names=names)

        for batch in batches:
            sizes, nodes = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                s = shingles(text.as_py())
                node = _class(s) if len(s) and doc is not None else None
                sizes.append(len(s)), nodes.append(node)
                if node is None or node in seen:
                    continue
                seen.add(node)
                for band in bands(len(s)):
                    keys.append(part_keys(s, band))
                    owners.append(np.full(len(keys[-1]), node, np.int64))
                    held += len(keys[-1])
                if held >= FLUSH_ENTRIES:
                    held = 0
                    yield flush()
            even = (rows + np.arange(len(sizes))) % buckets
            rows += len(sizes)
            yield pa.RecordBatch.from_arrays([pa.array(even.astype(np.int32)), pa.nulls(len(sizes), pa.binary()), pa.nulls(len(sizes), pa.bool_()), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], names=names)
        if keys:
            yield flush()

    return _ids(docs).mapInArrow(run, "bucket int, blob binary, loose boolean, doc_id long, n long, node long")


def shared_parts(rows: DataFrame, buckets: int, group: int) -> DataFrame:
    """The rows of documents, and (a, b, shared) of two kinds.

    Pairs of nodes and how many parts of the bucket they share; (node, number of the part, -1) for hot parts, which may repeat.
    """
    names = ["doc_id", "n", "node", "a", "b", "shared"]

    def find(bucket: int, blobs: list[bytes]) -> list[np.ndarray]:
        sizes = [len(b) // 12 for b in blobs]
        key = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes)])
        node = np.concatenate([np.frombuffer(b, np.int64, n, 4 * n) for b, n in zip(blobs, sizes)])
        order = np.argsort(key, kind="stable")
        key = key[order]
        again = np.r_[False, key[1:] == key[:-1]]
        again[:-1] |= again[1:]
        key, node = key[again], node[order][again]  # keys of one set alone, by far the most, go
        names, node = np.unique(node, return_inverse=True)
        both = np.unique(key.astype(np.uint64) << np.uint64(32) | node.astype(np.uint64))  # copies of a class are one
        key, node = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[start, len(key)])
        pairs = [np.zeros(0, np.int64)]
        for g in range(2, group + 1):
            rows = start[size == g]
            if len(rows):
                members = node[rows[:, None] + np.arange(g)]
                i, j = np.triu_indices(g, 1)
                pairs.append((members[:, i] << 32 | members[:, j]).ravel())
        pair, shared = np.unique(np.concatenate(pairs), return_counts=True)
        hot = np.repeat(size, size) > group
        a, b = np.r_[names[pair >> 32], names[node[hot]]], np.r_[names[pair & 0xFFFFFFFF], key[hot] * np.int64(buckets) + bucket]
        return [a, b, np.r_[shared, np.full(hot.sum(), -1)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(columns[0]), 200_000):
                found = [pa.array(c[at : at + 200_000]) for c in columns]
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(found[0]), pa.int64())] * 3, *found], names=names)

        def made() -> Iterator[pa.RecordBatch]:
            if blobs:
                yield from given(find(current, blobs))

        current, blobs = -1, []
        for batch in batches:
            of_docs = batch.filter(batch.column("blob").is_null())
            if of_docs.num_rows:
                yield pa.RecordBatch.from_arrays([*[of_docs.column(c) for c in names[:3]], *[pa.nulls(of_docs.num_rows, pa.int64())] * 3], names=names)
            for bucket, blob, loose in zip(batch.column("bucket").to_pylist(), batch.column("blob"), batch.column("loose").to_pylist()):
                if not blob.is_valid:
                    continue
                if loose:
                    part, node = np.frombuffer(blob.as_py(), np.int64).reshape(2, -1)
                    yield from given([node, part, np.full(len(node), -1)])
                    continue
                if bucket != current:
                    yield from made()
                    current, blobs = bucket, []
                blobs.append(blob.as_py())
        yield from made()

    dealt = rows.repartition(min(buckets, MAX_TASKS), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def spanning_links(nodes: tuple[int, ...], sides: tuple[bool, ...], sets: tuple[np.ndarray, ...], labels: tuple[int, ...]) -> list[tuple[int, int]]:
    """Links between sets of different labels, enough to connect all that are linked. With two sides, only those across."""
    order = sorted(range(len(sets)), key=lambda x: (len(sets[x]), nodes[x]))
    sets, node, side = [sets[x] for x in order], np.array(nodes)[order], np.array(sides)[order]
    n = np.array([len(s) for s in sets])
    band, root, out = np.array([_band(x) for x in n]), np.unique(np.array(labels)[order], return_inverse=True)[1], []
    across = side.min() != side.max()
    for k in np.unique(band):
        at = np.flatnonzero((band == k) | (band == k - 1) & (4 * n >= 3 * 2**k))
        if len(at) < 2:
            continue
        bits = np.stack([sketch(sets[x], k) for x in at])
        for y in range(max(1, np.searchsorted(band[at], k)), len(at)):
            larger = at[y]
            xs = np.arange(np.searchsorted(n[at], -(-3 * n[larger] // 4)), y)
            xs = xs[root[at[xs]] != root[larger]]
            if across:
                xs = xs[side[at[xs]] != side[larger]]
            if not len(xs):
                continue
            far = np.bitwise_count(bits[xs] ^ bits[y]).sum(1).astype(np.int64)
            near = 7 * far <= n[at[xs]] + n[larger]
            for x in at[xs[near][np.argsort(far[near], kind="stable")]]:
                if root[x] != root[larger] and similar(sets[x], sets[larger]):
                    root[root == root[x]] = root[larger]
                    out.append((int(node[x]), int(node[larger])))
    return out


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= 75 * (len(x) + len(y) - common)


def _blocks() -> Column:
    return F.greatest(F.ceil(F.sum("n") / BLOCK_ELEMENTS), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("long")


def _with_counts(placed: DataFrame) -> DataFrame:
    """placed with the numbers of blocks of its cluster's parts, as a map; a part is a slice, or the strays or others of one."""
    counts = placed.groupBy("cluster", "part").agg(_blocks().alias("blocks")).groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("part", "blocks"))).alias("counts"))
    return placed.join(counts, "cluster")


def _in_blocks(offsets: list[int], first: Column | None = None) -> tuple[Column, Column]:
    """(a set's own block, the blocks of the parts at some offsets from its own part, or from another one), over _with_counts.

    A block's number is its part's, times 2^32, plus its place in the part.
    """
    part = F.col("part")
    own = F.shiftleft(part, 32) + F.pmod(F.xxhash64("node"), F.element_at("counts", part))
    near = F.filter(F.transform(F.array(*map(F.lit, offsets)), lambda d: (part if first is None else first) + d), lambda p: F.map_contains_key("counts", p))
    blocks = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(F.lit(0).cast("long"), F.element_at("counts", p) - 1), lambda b: F.shiftleft(p, 32) + b)))
    return own, blocks


class JaccardJoin:
    """One run of the join over docs (doc_id, text)."""

    def __init__(self, docs: DataFrame, group: int = GROUP) -> None:
        small_batches(docs.sparkSession)
        self.docs = docs
        size, rows = docs.agg(F.sum(F.octet_length("text").cast("long")), F.count(F.lit(1))).first()
        buckets = int(max(8, (size or 0) // (12 * BUCKET_ENTRIES)))  # an entry comes of some twelve bytes
        found = materialize(shared_parts(keyed(docs, buckets, group), buckets, group), "jaccard-found")
        self.rows = found.where("a IS NULL").select("doc_id", "n", "node")
        self.pairs = found.where("shared > 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
        hot = found.where("shared < 0").select(F.col("a").alias("node"), F.col("b").alias("part"))
        self.hot, self.sharers = hot.distinct(), hot.groupBy("part").agg(F.count(F.lit(1)).alias("sets"))
        known = self.rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
        count = self.hot.groupBy("node").agg(F.count(F.lit(1)).alias("hot"))
        self.nodes = materialize(known.join(count, "node", "left").withColumn("hot", F.coalesce("hot", F.lit(0))), "jaccard-classes", rows)
        self.classes, self.ties = self.nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("hot"), F.lit(0))).first()

    def edges(self) -> DataFrame:
        """(a, b): pairs that share parts enough, and ties of sets by the hot parts of their prefixes."""

        def known(side: str) -> DataFrame:
            return self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("hot").alias(f"hot_{side}"))

        sized = self.pairs.join(known("a"), "a").join(known("b"), "b").where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
        pairs = sized.where("shared >= least(n_a, n_b) div 8 + 1 - least(hot_a, hot_b)").select("a", "b")
        spare = F.col("hot") - least_slack(F.col("n"))
        rank = F.row_number().over(Window.partitionBy("node").orderBy("sets", "part"))
        spared = self.hot.join(self.nodes.where(spare > 0).select("node", spare.alias("spare")), "node")
        prefix = join_counted(spared, self.sharers, "part", "sets", self.ties).withColumn("rank", rank).where("rank <= spare")
        prefix = materialize(prefix.select("node", "part"), "jaccard-prefixes", self.ties)
        tied = prefix.groupBy("part").agg(F.min("node").alias("tied"), F.count(F.lit(1)).alias("sets"))
        ties = join_counted(prefix, tied, "part", "sets", self.ties).where("node != tied")
        return pairs.unionByName(ties.select(F.col("tied").alias("a"), F.col("node").alias("b")).distinct())

    def clusters(self) -> DataFrame:
        """(node, doc_id, n, share, cluster, large, slice) of every set that may have links; share: that of its hot parts.

        A cluster of more than a block is cut by size: no link is between sizes more than a slice apart.
        """
        in_clusters = components(self.edges()).select("node", F.col("component").alias("cluster"))
        sets = self.nodes.join(in_clusters, "node").select("node", "doc_id", "n", (F.col("hot") / F.col("n")).alias("share"), "cluster")
        sets = materialize(sets, "jaccard-clusters", self.classes)
        large = sets.groupBy("cluster").agg(_blocks().alias("blocks")).where("blocks > 1").select("cluster", F.lit(True).alias("large"))
        width = F.floor(F.log("n") / F.log(F.lit(4 / 3)))
        return sets.join(large, "cluster", "left").withColumn("slice", F.when(F.col("large"), width).otherwise(F.lit(0)).cast("long"))

    def links(self) -> DataFrame:
        """(a, b): verified links between classes, enough of them that every component is connected."""
        sets = materialize(self.clusters(), "jaccard-slices", self.classes)
        links = self.compared(self.blocks_and_pivots(sets), "jaccard-links")
        left = self.strays(sets.where("large"), links)
        return links if left is None else links.unionByName(self.compared(left, "jaccard-more-links"))

    def blocks_and_pivots(self, sets: DataFrame) -> DataFrame:
        """Every set in one block of its slice; some typical sets of a slice, with most hot parts, in all blocks near it.

        These join most of a family of near copies, so that its members need not meet each other.
        """
        turn = F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(PIVOTS))
        pivots = sets.where("large").groupBy("cluster", "slice", turn.alias("turn")).agg(F.max_by("node", F.struct("share", F.xxhash64("node"))).alias("node"))
        placed = sets.join(pivots.select("node", F.lit(True).alias("pivot")), "node", "left").withColumn("part", F.col("slice"))
        own, near = _in_blocks([-1, 0, 1])
        target = F.when(F.col("pivot"), near).otherwise(F.array(own))
        meets = F.transform(target, lambda b: F.struct(b.alias("i"), b.alias("j"), F.lit(False).alias("side")))
        return _with_counts(placed).select("node", "doc_id", "n", "cluster", F.col("node").alias("label"), meets.alias("meets"))

    def strays(self, sets: DataFrame, links: DataFrame) -> DataFrame | None:
        """What is left of large clusters: the sets outside a cluster's largest component, which meet all, and the others, which meet these alone."""
        labelled = sets.join(components(links), "node", "left").withColumn("label", F.coalesce("component", "node"))
        labelled = materialize(labelled.drop("component"), "jaccard-labelled", self.classes)
        sizes = labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size"))
        main = sizes.groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
        placed = labelled.join(main, "cluster").withColumn("settled", (F.col("label") == F.col("main")).cast("long")).withColumn("part", 2 * F.col("slice") + F.col("settled"))
        if not main.limit(1).count():
            return None
        first = F.col("part") - F.col("settled")
        own, to_all = _in_blocks([-2, -1, 0, 1, 2, 3], first)
        to_strays = _in_blocks([-2, 0, 2], first)[1]
        target = F.when(F.col("settled") == 1, to_strays).otherwise(to_all)
        meets = F.transform(target, lambda b: F.struct(F.least(own, b).alias("i"), F.greatest(own, b).alias("j"), (own > b).alias("side")))
        return _with_counts(placed).select("node", "doc_id", "n", "cluster", "label", meets.alias("meets"))

    def compared(self, placed: DataFrame, name: str) -> DataFrame:
        """(a, b): links found in the blocks (cluster, i, j) that placed sends its sets to."""
        placed = materialize(placed, f"{name}-placed", self.classes)
        ids, visits, sent = placed.agg(F.count(F.lit(1)), F.sum(F.size("meets")), F.sum(F.col("n") * F.size("meets"))).first()
        tasks = int(min(MAX_TASKS, max(int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (sent or 0) // BLOCK_ELEMENTS)))
        rows = self.sets(placed, max(ids, (visits or 0) // 4) <= BROADCAST_IDS).withColumn("m", F.explode("meets")).select("cluster", "m.i", "m.j", "m.side", "node", "label", "set")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, group = None, []
            found: list[tuple[int, int]] = []
            for batch in batches:
                keys = zip(*[batch.column(c).to_pylist() for c in ("cluster", "i", "j", "side", "node", "label")])
                for (*block, side, node, label), elements in zip(keys, batch.column("set")):
                    if block != current:
                        found += spanning_links(*zip(*group)) if len(group) > 1 else []
                        current, group = block, []
                    group.append((node, side, np.frombuffer(elements.as_py(), np.uint64), label))
                yield links_of(found)
                found = []
            yield links_of(spanning_links(*zip(*group)) if len(group) > 1 else [])

        def links_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        dealt = rows.repartition(tasks, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
        return materialize(dealt.mapInArrow(run, "a long, b long").where("a != b"), name)

    def sets(self, placed: DataFrame, small: bool) -> DataFrame:
        """placed with the sets of its nodes, from the texts of their first documents; a row that repeats one may come again."""
        placed = placed.select("node", F.col("doc_id").alias("first"), "cluster", "label", "meets")
        wanted = F.broadcast(placed) if small else placed
        texts = _ids(self.docs).join(wanted, F.col("doc_id") == F.col("first")).drop("doc_id", "first")
        kept = [c for c in placed.columns if c != "first"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [shingles(text.as_py()) for text in batch.column("text")]
                same = pa.array([_class(s) == node for s, node in zip(sets, batch.column("node").to_pylist())], pa.bool_())
                columns = [*[batch.column(c) for c in kept], pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "set"]).filter(same)

        kinds = dict(placed.dtypes)
        return texts.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in kept], "set binary"]))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id for every row."""
        label = components(self.links())
        first = self.nodes.select("node", F.col("doc_id").alias("first"))
        named = first.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
        by_node = named.join(lowest, "component").select("node", "component_id")
        return self.rows.select("doc_id", "n", "node").join(by_node, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row of docs (doc_id, text).

    A null text has no words, like an empty one: no shingles, linked with nothing. Rows of equal texts are one class. A
    row whose doc_id is null is linked with nothing. Rows that repeat a doc_id each get the component of their own text.
    A text of any length is one set. doc_id has to be of an integer type, else TypeError. An empty table gives no rows;
    other columns are not read.
    """
    return JaccardJoin(docs, group).result()


def keep_first(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """docs without near duplicates: of each component the rows with the smallest doc_id stay, with the columns of docs.

    Rows without words, or without doc_id, all stay. Of rows that repeat a doc_id, those stay whose component it names.
    Other columns are kept as they are, whatever their names. An empty table stays empty.
    """
    found = near_duplicates(docs, group)
    stays = found.groupBy("doc_id").agg(F.max(F.col("component_id") == F.col("doc_id")).alias("stays"))
    gone = stays.where("NOT stays").select(F.col("doc_id").alias("gone"))
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")

"""Packing documents into fixed-length sequences: bounded-space online best fit in each partition, then a merge.

A partition keeps a fixed number of windows open. A piece goes to the open window that it fills best; where none has
room, the fullest is emitted and a new one opened. The windows still open at the end are merged, best fit again, in
groups of a fixed number of partitions, so that no task holds more than WINDOWS * GROUP of them.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches

LENGTH = 2048
#: The id that ends each document.
END_ID = 1
#: Windows open at a time in a partition.
WINDOWS = 64
#: Partitions whose leftover windows are merged together.
GROUP = 32
#: Ids of so many different words of at most LONG letters are kept in a worker; then it starts anew. This bounds memory, not results.
CACHE_ENTRIES, LONG = 800_000, 64
#: Words of letters alone that are encoded as one string.
JOINED = 100
_SEQUENCES = 1 << 40


class WordIds:
    """Ids (little-endian 32 bits) of words between spaces and line breaks, which the tokenizer never joins."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.entries = Tokenizer.from_file(path), entries
        self.seen: dict[str, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[number for token, number in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_lower(t).replace("\n", " ").split(" ") for t in texts]
        words = set(chain.from_iterable(split))
        if len(self.seen) + len(words) > self.entries:
            self.seen = {}
        fresh = words.difference(self.seen)
        # letters and one full stop or comma are two pre-tokens, so that the letters alone are enough
        ended = {w: w[:-1] for w in fresh if w.endswith((".", ",")) and _letters(w[:-1])}
        if ended:
            fresh = {*fresh, *ended.values(), ".", ","}.difference(self.seen, ended)
        self.seen.update(self.plain([w for w in fresh if _letters(w)]))
        other = [w for w in fresh if w not in self.seen]
        encoded = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        self.seen.update((w, array("I", x.ids).tobytes()) for w, x in zip(other, encoded))
        self.seen.update((w, self.seen[base] + self.seen[w[-1]]) for w, base in ended.items())
        out = [b"".join(map(self.seen.__getitem__, x)) for x in split]
        for w in fresh.union(ended):
            if len(w) > LONG:
                del self.seen[w]
        return out

    def plain(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of words of letters, many encoded at a time: each is one pre-token, whose last id alone ends a word."""
        for part in (words[k : k + JOINED] for k in range(0, len(words), JOINED)):
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                yield from zip(part, (raw[a:b] for a, b in zip([0, *ends], ends)))


def _letters(word: str) -> bool:
    return word.isalpha() and max(word) < "\u0100"


def _lower(text: str) -> str:
    """In lower case if that is surely what the tokenizer makes of it; else as it is, to be lowered there."""
    if "<|" in text:  # special tokens are found before letters are lowered
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


_tokenizers: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _tokenizers:  # one for each Python worker, which Spark reuses
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class OpenWindows:
    """At most `windows` open windows of `length` tokens; add() gives the window that is full or had to go, if any."""

    def __init__(self, length: int, windows: int) -> None:
        self.length, self.windows = length, windows
        self.room: list[tuple[int, int]] = []  # (free tokens, number), ascending
        self.items: dict[int, list] = {}
        self.number = 0

    def add(self, item, size: int) -> list | None:
        out = None
        at = bisect_left(self.room, (size, -1))
        if at < len(self.room):
            free, number = self.room.pop(at)
        else:
            if len(self.room) >= self.windows:
                out = self.items.pop(self.room.pop(0)[1])
            free, number, self.number = self.length, self.number, self.number + 1
            self.items[number] = []
        self.items[number].append((item, self.length - free))
        if free == size:  # an old window, so that none had to go: pieces are shorter than a new one
            return self.items.pop(number)
        insort(self.room, (free - size, number))
        return out

    def left(self) -> list[tuple[int, list]]:
        return [(self.length - free, self.items[number]) for free, number in self.room]


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, used long, open boolean"


def pack_documents(
    docs: DataFrame, tokenizer_path: str, length: int = LENGTH, windows: int = WINDOWS, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    A document's ids are those of its whole text and end_id. Pieces of `length` ids fill a sequence alone; a document's
    rest is placed whole. A null or empty text is its end_id alone. Ids may be null or repeat: each row is packed by
    itself. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    names = ["doc_id", *(x.split()[0] for x in PIECES.split(", "))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = _word_ids(tokenizer_path), TaskContext.get().partitionId() * _SEQUENCES
        ending, open_, done, ids_type = np.array([end_id], "<u4").tobytes(), OpenWindows(length, windows), 0, pa.null()

        def rows(window: list, still: bool) -> list[tuple]:
            nonlocal done
            used, done = window[-1][1] + window[-1][0][2], done + 1
            return [(*item, part + done - 1, offset, used, still) for item, offset in window]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [ids_type, *[pa.int64()] * (len(names) - 2), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            ids_type, out = batch.column("doc_id").type, []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text").to_pylist())):
                ids += ending
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    size = len(piece) // 4
                    item = (doc, start, size, zlib.crc32(piece), total)
                    if full := [(item, 0)] if size == length else open_.add(item, size):
                        out += rows(full, False)
            yield batch_of(out)
        if open_.items:
            yield batch_of([x for _, window in open_.left() for x in rows(window, True)])

    placed = materialize(source.mapInArrow(place, f"doc_id {kind}, {PIECES}"), "packing")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        """Leftover windows of a group of partitions, the longest first, best fit without a bound."""
        group = group.sort_values(["used", "window"], ascending=[False, True])
        bins: list[tuple[int, int]] = []
        out = []
        for window, used in zip(group["window"], group["used"]):
            at = bisect_left(bins, (used, -1))
            free, first = bins.pop(at) if at < len(bins) else (length, window)
            out.append((window, first, length - free))
            insort(bins, (free - used, first))
        return pd.DataFrame(out, columns=["window", "sequence_id", "base"])

    left = placed.where("open")
    merged = (
        left.groupBy("window").agg(F.max("used").alias("used"))
        .groupBy(F.floor(F.col("window") / F.lit(_SEQUENCES * GROUP)).alias("group"))
        .applyInPandas(lambda g: merge(g), "window long, sequence_id long, base long")
    )
    moved = left.join(merged, "window").withColumn("offset", F.col("offset") + F.col("base"))
    closed = placed.where("not open").withColumn("sequence_id", F.col("window"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return closed.select(*columns).unionByName(moved.select(*columns))

"""Token counts for a sentence-piece BPE vocabulary by rank-synchronous array merging.

Pre-tokens of a batch lie end to end in one numpy array. In each round every pre-token finds its lowest-rank adjacent
pair and all pre-tokens merge theirs at once; the symbols that survive are the tokens. A pre-token starts at a word
mark (U+2581) or a line break: no piece of the vocabulary crosses either, which is checked when the model is read.

Where a merge may open a better one, a pre-token merges one pair a round, so that rounds grow with its length. Those of
more than LONG letters (unbroken scripts, base64) go by a heap of their pairs instead, in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

MARK = "▁"
#: Counts of so many different pre-tokens of at most LONG letters are kept in a worker; then it starts anew. This bounds memory, not results.
CACHE_ENTRIES, LONG = 800_000, 128
NO_RANK = np.iinfo(np.int64).max


class PieceVocabulary:
    """Merge ranks of a sentencepiece BPE model, as sorted arrays for vectorised look-ups."""

    def __init__(self, pieces: list[str], scores: list[float]) -> None:
        score = dict(zip(pieces, scores))
        self.runs = {len(p) for p in pieces if p and not p.strip(MARK)}  # pieces of word marks alone
        order = {s: i for i, s in enumerate(sorted({s for p, s in score.items() if p.strip(MARK)}, reverse=True))}
        number = {p: i for i, p in enumerate(pieces)}
        self.chars = {p: i for p, i in number.items() if len(p) == 1}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("a piece crosses a word mark or a line break")
        left, right, rank, merged, self.at_once = [], [], [], [], True
        for p in pieces:
            if len(p) < 2 or not p.strip(MARK):
                continue
            for cut in range(1, len(p)):
                u, v = p[:cut], p[cut:]
                if u in number and v in number:
                    left.append(number[u]), right.append(number[v]), rank.append(order[score[p]]), merged.append(number[p])
                    # a merge may never open a better one, else equal pairs of a round have to wait for each other
                    self.at_once &= all(len(x) == 1 or not x.strip(MARK) or score[x] > score[p] for x in (u, v))
        self.size = len(pieces)
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        by = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[by], np.array(rank, np.int64)[by], np.array(merged, np.int64)[by]

    @classmethod
    def load(cls, path: str) -> PieceVocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        return cls([model.id_to_piece(i) for i in normal], [model.get_score(i) for i in normal])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.rank[at], NO_RANK), self.merged[at]

    def count(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each word, whether its first token is a lone word mark); words are not empty, runs of marks aside."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        known, inverse = np.unique(points, return_inverse=True)
        ids = np.array([self.chars.get(chr(c), -len(chr(c).encode())) for c in known], np.int64)
        symbol, owner = ids[inverse], np.repeat(np.arange(len(words)), lengths)
        tokens, lone = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        mark = self.chars.get(MARK, -3)
        while len(symbol):
            pair = np.flatnonzero(owner[1:] == owner[:-1])
            rank, merged = self.ranks(symbol[pair], symbol[pair + 1])
            best = np.full(len(words), NO_RANK)
            np.minimum.at(best, owner[pair], rank)
            open_ = best[owner] != NO_RANK
            done = ~open_
            if done.any():  # an unknown character is as many byte tokens as it has bytes
                np.add.at(tokens, owner[done], np.where(symbol[done] < 0, -symbol[done], 1))
                first = np.flatnonzero(done & np.r_[True, owner[1:] != owner[:-1]])
                lone[owner[first]] = symbol[first] == mark
            take = (rank != NO_RANK) & (rank == best[owner[pair]])
            at, into = pair[take], merged[take]
            if self.at_once:  # of overlapping pairs (aaa) every other one, from the left
                run = np.r_[True, np.diff(at) != 1] if len(at) else np.zeros(0, bool)
                start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0)) if len(at) else at
                keep = (np.arange(len(at)) - start) % 2 == 0
            else:
                keep = np.r_[True, np.diff(owner[at]) != 0] if len(at) else np.zeros(0, bool)
            at, into = at[keep], into[keep]
            symbol[at] = into
            open_[at + 1] = False
            symbol, owner = symbol[open_], owner[open_]
        return tokens, lone

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist())))

    def count_long(self, word: str) -> tuple[int, bool]:
        """(tokens, whether the first is a lone word mark) of one word: pairs by rank, then from the left, from a heap."""
        symbol = [self.chars.get(c, -len(c.encode())) for c in word]
        n, size, merges = len(symbol), self.size, self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def found(left: int, right: int) -> tuple[int, int] | None:
            return merges.get(left * size + right) if left >= 0 and right >= 0 else None

        heap = [(pair[0] << 40) + i for i in range(n - 1) if (pair := found(symbol[i], symbol[i + 1]))]
        heapify(heap)
        gone = bytearray(n)
        while heap:
            top = heappop(heap)
            i, rank = top & (1 << 40) - 1, top >> 40
            if gone[i] or (j := after[i]) == n or (pair := found(symbol[i], symbol[j])) is None or pair[0] != rank:
                continue  # one of the two has merged since
            symbol[i], gone[j], k = pair[1], 1, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if right := found(symbol[i], symbol[k]):
                    heappush(heap, (right[0] << 40) + i)
            if (h := before[i]) >= 0 and (left := found(symbol[h], symbol[i])):
                heappush(heap, (left[0] << 40) + h)
        return sum(-s if s < 0 else 1 for s, dead in zip(symbol, gone) if not dead), symbol[0] == self.chars.get(MARK, -3)

    def run(self, marks: int) -> int:
        """Tokens of a run of word marks: their pieces score lowest of all and alike, so that the leftmost pair merges first."""
        stack: list[int] = []
        for _ in range(marks):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                stack[-2:] = [stack[-2] + stack[-1]]
        return len(stack)


class TokenCounter:
    """Counts tokens of texts; the counts of pre-tokens seen before are kept."""

    def __init__(self, vocabulary: PieceVocabulary, entries: int = CACHE_ENTRIES) -> None:
        self.vocabulary, self.entries = vocabulary, entries
        self.seen: dict[str, int] = {}
        self.lone: set[str] = set()

    def learn(self, words: set[str]) -> None:
        if len(self.seen) + len(words) > self.entries:
            self.seen, self.lone = {}, set()
        fresh = [w for w in words if w and w not in self.seen]
        long = [w for w in fresh if len(w) > LONG and not self.vocabulary.at_once]
        fresh = [w for w in fresh if len(w) <= LONG or self.vocabulary.at_once]
        if fresh:  # a word after a line break has no mark; the break itself is one byte token
            tokens, lone = self.vocabulary.count([w if w[0] == "\n" else MARK + w for w in fresh])
            self.seen.update(zip(fresh, tokens.tolist()))
            self.lone.update(w for w, x in zip(fresh, lone.tolist()) if x)
        for w in long:
            self.seen[w], lone_mark = self.vocabulary.count_long(w if w[0] == "\n" else MARK + w)
            if lone_mark:
                self.lone.add(w)

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [t.replace(MARK, " ").replace("\n", " \n").split(" ") if t else [] for t in texts]
        words = set(chain.from_iterable(split))
        self.learn(words)
        out = [self.spaced(x) if "" in x else sum(map(self.seen.__getitem__, x)) for x in split]
        for w in [w for w in words if len(w) > LONG]:
            del self.seen[w]
            self.lone.discard(w)
        return out

    def spaced(self, words: list[str]) -> int:
        """With runs of spaces: the last mark of a run belongs to the next word if that word took it."""
        total = marks = 0
        for w in words:
            if w == "":
                marks += 1
            elif w[0] == "\n":
                total, marks = total + self.vocabulary.run(marks) + self.seen[w], 0
            elif marks and w in self.lone:
                total, marks = total + self.vocabulary.run(marks + 1) + self.seen[w] - 1, 0
            else:
                total, marks = total + self.vocabulary.run(marks) + self.seen[w], 0
        return total + self.vocabulary.run(marks)


_counters: dict[str, TokenCounter] = {}


def _counter(path: str) -> TokenCounter:
    if path not in _counters:  # one for each Python worker, which Spark reuses
        _counters[path] = TokenCounter(PieceVocabulary.load(path))
    return _counters[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    model_path: a sentencepiece BPE model with identity normalisation, on every executor. A null or empty text has no
    bytes and no tokens; a text of any length is counted whole. Ids may be null or repeat; each row is counted by itself.
    An empty table gives no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = counter.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

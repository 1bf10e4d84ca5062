import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pelagic.llm import common, jaccard
from pelagic.llm.components import components
from pelagic.llm.jaccard import keep_first, near_duplicates


def plain(rows):
    """Brute force: sets of word tuples, an inverted index, union-find."""
    sets, parent, index, first = [], {i: i for i, _ in rows}, defaultdict(list), {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    for k, (i, text) in enumerate(rows):
        w = [x for x in (text or "").encode().translate(jaccard._BYTES).split(b" ") if x]
        s = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
        sets.append(s)
        if s and s in first:
            join(i, first[s])
            continue
        first[s] = i
        shared = Counter(j for x in s for j in index[x])
        for x in s:
            index[x].append(k)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                join(i, rows[j][0])
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets)}


def families(seed):
    r = random.Random(seed)

    def words(n):
        return [r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 2) + r.choice("xyz") for _ in range(n)]

    rows, passage = [], words(70)
    for _ in range(3):
        base = words(r.choice([30, 60, 120]))
        for _ in range(14):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 3])):
                w[r.randrange(len(w))] = f"q{r.randrange(10**6)}"
            rows.append(" ".join(w))
    rows += [" ".join(words(r.randint(3, 30)) + passage + words(r.randint(3, 30))) for _ in range(30)]
    rows += [" ".join(words(r.randint(0, 7))) for _ in range(20)] + [None, "", " \n", "A b", "a\tB", "A b"]
    r.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


CASES = [(1, 32, 5, 1 << 20, 8, 500), (2, 2, 5, 1 << 20, 1, 10**6), (3, 8, 1000, 300, 2, 10**6), (4, 1, 3, 200, 1, 300)]


@pytest.mark.parametrize("seed,group,sets,elements,pivots,flush", CASES)
def test_against_brute_force(spark, monkeypatch, seed, group, sets, elements, pivots, flush):
    """Small groups make nearly every shared part hot, so that ties find the links; small blocks need both rounds."""
    for name, value in (("BLOCK_SETS", sets), ("BLOCK_ELEMENTS", elements), ("PIVOTS", pivots), ("FLUSH_ENTRIES", flush)):
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(common, "HEAVY_ROWS", 10 if group < 8 else 10**6)
    rows = families(seed)
    want = plain(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), group).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_links_in_a_block_connect_what_is_linked():
    r = np.random.default_rng(5)
    base = [r.integers(0, 2**63, n).astype(np.uint64) for n in (3, 40, 52, 200)]
    sets = []
    for _ in range(120):
        s = base[r.integers(4)].copy()
        s[r.random(len(s)) < r.choice([0, 0.05, 0.1, 0.2])] = r.integers(0, 2**63)
        sets.append(np.unique(s))
    sets = list({s.tobytes(): s for s in sets}.values())
    side = [bool(x) for x in r.integers(0, 2, len(sets))]
    linked = {(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}

    def groups(links, labels):
        own = list(labels)
        for a, b in links:
            own = [own[b] if x == own[a] else x for x in own]
        return {frozenset(i for i, x in enumerate(own) if x == y) for y in own}

    alone = list(range(len(sets)))
    for sides, labels, wanted in (([False] * len(sets), alone, linked), (side, alone, {(a, b) for a, b in linked if side[a] != side[b]}), ([False] * len(sets), [i // 3 for i in alone], linked)):
        got = jaccard.spanning_links(alone, sides, sets, labels)
        assert all(tuple(sorted(x, reverse=True)) in wanted for x in got) and groups(got, labels) == groups(wanted, labels)
        assert len(got) < len(sets)


def test_text_ids_are_an_error(spark):
    with pytest.raises(TypeError):
        near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_odd_rows(odd, empty):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(odd).collect()]
    assert len(got) == odd.count()
    assert {c for i, _, c in got if i in (4, 5)} == {4} and {(i, n, c) for i, n, c in got if i in (1, 2, 3)} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}
    assert [c for i, _, c in got if i is None] == [None]
    assert near_duplicates(empty).count() == 0
    kept = keep_first(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 4, 6, 7, 8, 9]


@pytest.mark.parametrize("group", [8, 1])
def test_a_copy_without_id_before_its_document(spark, group):
    """Group 1 makes every shared part hot, so that hot parts tie all sets."""
    words = [f"w{k}" for k in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    frame = spark.createDataFrame([(None, text), (5, text), (3, near)], "doc_id long, text string").coalesce(1)
    got = sorted(((r["doc_id"] or 0, r["component_id"]) for r in near_duplicates(frame, group).collect()))
    assert [g for g in got if g[0]] == [(3, 3), (5, 3)] and len(got) == 3
    assert sorted(r["doc_id"] or 0 for r in keep_first(frame).collect()) == [0, 3]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(8, 30)] + [(7, 7), (8, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{k: 7 for k in range(7, 30)}}


@pytest.mark.parametrize("most", [10**6, 40])
def test_sent_parts_against_a_loop(monkeypatch, most):
    """No more than group + 1 sets of a part that two sets of a flush share, and never fewer than show that it is hot."""
    monkeypatch.setattr(jaccard, "COUNTED_PARTS", most)
    r, sent, times, total = np.random.default_rng(3), jaccard.SentParts(4), Counter(), Counter()
    for _ in range(30):
        part = np.sort(np.r_[np.repeat(np.arange(6), 2), r.integers(0, 10**4, 120)].astype(np.uint64))
        goes = sent.sends(part)
        times.update(part[goes].tolist())
        total.update(part.tolist())
    assert all(min(total[p], 5) <= times[p] for p in total)
    assert most == 40 or all(times[p] <= 5 for p in range(6))


def test_a_passage_of_all_texts_is_no_large_bucket(spark, monkeypatch):
    """Every text holds the same passage: its parts send a few sets of each task to their buckets, and all sets past them."""
    monkeypatch.setattr(jaccard, "FLUSH_ENTRIES", 20_000)
    r, passage = random.Random(9), " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(40)) + " " + passage) for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = jaccard.keyed(docs, 8).where("blob IS NOT NULL").select("bucket", "blob", "loose").collect()
    of_part, past = Counter(), Counter()
    for bucket, blob, loose in got:
        if loose:
            past.update(np.frombuffer(blob, np.int64, len(blob) // 16).tolist())
        else:
            of_part.update((np.frombuffer(blob, np.uint32, len(blob) // 12).astype(np.int64) * 8 + bucket).tolist())
    assert max(of_part.values()) <= 2 * (jaccard.GROUP + 1 + 5)  # of some five flushes, each may hold one set uncounted
    assert max(past.values()) > 500 and all(of_part[p] > jaccard.GROUP for p in past)
    assert near_duplicates(docs).where("component_id != doc_id").count() == 0


def test_heavy_keys_meet_their_rows_by_broadcast(spark, monkeypatch):
    rows = [(1, k) for k in range(50)] + [(k, k) for k in range(2, 20)]
    frame = spark.createDataFrame(rows, "k long, v long")
    of_keys = frame.groupBy("k").count()
    want = sorted(map(tuple, frame.join(of_keys, "k").collect()))
    for heavy, keys in ((10, 100), (10, 0), (60, 100), (1000, 100)):
        monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
        monkeypatch.setattr(common, "BROADCAST_KEYS", keys)
        assert sorted(map(tuple, common.join_counted(frame, of_keys, "k", "count", 68).collect())) == want

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from pelagic.llm import fingerprints as fingerprinting
from pelagic.llm import personal_data as pd
from pelagic.llm.fingerprints import Fingerprinter, fingerprints, likeness
from pelagic.llm.personal_data import personal_data, redact

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    values = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def plain_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (14 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), number, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_base_spans_against_plain_python(spark):
    r = random.Random(5)
    parts = ["a", "1", "12", "@", ".", "-", " ", "+1", "4111 1111 1111 1111", "x@y.zz", "10.0.0.255", "+1 (555) 555-5555", "é", "\U0001f600", "\u0001", "(", ")", "b.co", "_", "999", "0", ",", "\n"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for i in range(1200)] + [(5000, "9" * 20_000), (5001, "a@" * 9000), (5002, "1 " * 9000)]
    texts = dict(rows)
    for x in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert x["base_sha256"] == hashlib.sha256(plain_spans(texts[x["doc_id"]]).encode()).hexdigest(), texts[x["doc_id"]]


def test_a_text_of_very_many_matches_takes_time_in_proportion(spark):
    """A megabyte with 50,000 matches: spans as in plain Python, redacted within seconds."""
    r = random.Random(3)
    kinds = [lambda k: f"user{k}@host{k % 50}.org", lambda k: f"10.0.{k % 256}.{k % 200}", lambda k: f"call\u00e9 555 867 {k % 9000 + 1000},", lambda k: f"me{k}(at)host.org"]
    text = "".join(f"{r.choice(kinds)(k)} " for k in range(50_000))
    frame = spark.createDataFrame([(1, text, len(text)), (2, "a@b.cc" * 3, 18), (3, "x" * 4096 + " a@b.cc", 4103)], "doc_id long, text string, n_chars long")
    began = time.perf_counter()
    got = {x["doc_id"]: x for x in personal_data(frame).collect()}
    new = {x["doc_id"]: x["text"] for x in redact(frame).collect()}
    assert time.perf_counter() - began < 60
    for i, t in ((1, text), (2, "a@b.cc" * 3), (3, "x" * 4096 + " a@b.cc")):
        assert got[i]["base_sha256"] == hashlib.sha256(plain_spans(t).encode()).hexdigest()
        out, at = [], 0
        for kind, s, e in sorted((x.split(":") for x in got[i]["spans"].split(",") if x), key=lambda x: (int(x[1]), pd.KINDS.index(x[0]), int(x[2]))):
            if int(s) >= at:
                out += [t[at : int(s)], f"[{kind.upper()}]"]
            at = max(at, int(e))
        assert new[i] == "".join(out) + t[at:]


def test_contexts_discover_an_unseen_number(spark):
    rows = [(i, f"Contact phone: +1 (555) 555-{1000 + i} thanks a{i}") for i in range(30)] + [(100, "x contact phone: 555 867 5309 thanks b"), (101, "only 555 867 5308 here")]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["spans"] for r in personal_data(frame).collect()}
    assert got[100] == "phone:17:29" and got[101] == ""
    new = {r["doc_id"]: (r["text"], r["n_chars"]) for r in redact(frame).collect()}
    assert new[100] == ("x contact phone: [PHONE] thanks b", 33) and new[101] == ("only 555 867 5308 here", 22)


UNSEEN = [
    ("email", "john(at)example.com"), ("email", "jane[at]site.org"), ("email", "Jim(AT)Example.com"), ("email", "joe@localhost"), ("email", "john(at)example.com 42"),
    ("ip", "fe80::1a2b:3c4d"), ("ip", "2001:db8::ff00:42:8329"), ("ip", "FE80:0:0:0:a:b:c:d"), ("ip", "2001:db8:a::"), ("ip", "a.b.c.d"), ("ip", "1.2.3.999"), ("ip", "fe80::1a2b:3c4d 80"),
    ("card", "4111 1111 1111 1112"), ("card", "4111-1111.1111/1112"), ("phone", "555 867 5309"), ("phone", "(555) 867-5309"),
]
SEED = {"email": "mail{0}@host.org", "ip": "10.0.0.{0}", "card": "4111 1111 1111 1111", "phone": "+1 (555) 555-{1}"}


def plain_discovery(rows):
    """Spans beyond the base ones, with dictionaries for the graph."""
    low, seen = pd.CONTEXT, []
    for i, text in rows:
        base = [(int(s), list(BASE).index(k), int(e)) for k, s, e in (x.split(":") for x in plain_spans(text).split(",") if x)]
        spans = list(base)
        for m in regex.finditer(pd.CANDIDATE, text) if regex.search(pd.CANDIDATE_HINT, text) else ():
            kept = m[0].rstrip(" .!?)")
            value = kept if kept.endswith("::") and regex.search(pd.SHAPES["ip"], kept) else m[0].rstrip(" .:!?)")
            if value and not any(s < m.end() and m.start() < e for s, _, e in base):
                spans.append((m.start(), -1, m.start() + len(value)))
        for s, kind, e in spans:
            left, right = (regex.sub(r"[^\p{L}\p{N}:=#]+", " ", x.lower()).split() for x in (text[max(0, s - low) : s], text[e : e + low]))
            patterns = [f"<1 {left[-1]}"] if left else []
            patterns += [f"<2 {left[-2]} {left[-1]}"] if len(left) > 1 else []
            patterns += [f"<> {left[-1]} _ {right[0]}"] if left and right else []
            seen.append((i, s, e, kind, text[s:e].lower(), patterns))
    edges = {}
    for *_, kind, value, patterns in seen:
        for p in patterns:
            edges[p, value] = max(kind, edges.get((p, value), -1))
    seeds = {(v, k): 1.0 for (_, v), k in edges.items() if k >= 0}
    scores, found = dict(seeds), {}
    for _ in range(pd.ROUNDS):
        votes, size = defaultdict(float), Counter(p for p, _ in edges)
        for p, v in edges:
            for (w, k), score in scores.items():
                if w == v:
                    votes[p, k] += score
        sure = {(p, k): x / (size[p] + 1) for (p, k), x in votes.items() if x >= pd.MIN_SEEDS and x / (size[p] + 1) >= pd.MIN_SHARE}
        miss = defaultdict(float)
        for (p, v), kind in edges.items():
            for number, name in enumerate(pd.KINDS):
                if kind < 0 and (p, number) in sure and regex.search(pd.SHAPES[name], v):
                    miss[v, number] += math.log1p(-min(sure[p, number], 0.999))
        found = {}
        for (v, k), x in miss.items():
            found[v] = max(found.get(v, (-1.0, 0)), (1 - math.exp(x), -k))
        scores = seeds | {(v, -k): x for v, (x, k) in found.items()}
    good = {v: -k for v, (x, k) in found.items() if x >= pd.MIN_SCORE}
    return {(i, s, e, good[v]) for i, s, e, kind, v, _ in seen if kind < 0 and v in good}


def test_discovery_against_plain_python(spark):
    r = random.Random(11)
    heads, tails = ["call us at", "Phone:", "mail to", "server", "card no", "see", "order #"], ["thanks", "today.", "now", "please", ""]
    values = ["+1 (555) 555-{0}", "555 867 {0}", "me{0}@host.org", "me{0}(at)host.org", "10.0.{1}.7", "fe80::{1}:1a2b", "{0} {0}", "nothing"]
    rows = []
    for i in range(400):
        parts = []
        for _ in range(r.randint(1, 3)):
            k = r.randrange(len(heads))
            value = values[(2 * k + r.choice([0, 0, 0, 1])) % len(values)]
            parts.append(f"{heads[k]} {value.format(r.randint(1000, 1040), r.randint(1, 60))} {r.choice(tails)}")
        rows.append((i, " and ".join(parts)))
    want = plain_discovery(rows)
    got = personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    texts = dict(rows)
    extra = {(x["doc_id"], int(s), int(e), pd.KINDS.index(k)) for x in got for k, s, e in (y.split(":") for y in set(x["spans"].split(",")) - set(plain_spans(texts[x["doc_id"]]).split(",")) if y)}
    assert len(want) > 20 and extra == want


def test_every_shape_is_discovered_in_a_learned_context(spark):
    rows, cards = [], [d for d in map(str, range(4111111111110000, 4111111111110600)) if luhn(d)]
    for kind in SEED:
        rows += [(len(rows), f"Contact {kind}: {cards[i] if kind == 'card' else SEED[kind].format(i, 1000 + i)} thanks") for i in range(50)]
    seeds = len(rows)
    rows += [(seeds + k, f"x contact {kind}: {value}. thanks") for k, (kind, value) in enumerate(UNSEEN)] + [(999, "only add... meet (at) noon, john(at)example.net or fe80::9:9")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in personal_data(frame).collect()}
    new = {r["doc_id"]: r["text"] for r in redact(frame).collect()}
    for k, (kind, value) in enumerate(UNSEEN):
        start, own = len(f"x contact {kind}: "), value.removesuffix(" 42").removesuffix(" 80")
        assert got[seeds + k] == f"{kind}:{start}:{start + len(own)}", value
        assert new[seeds + k] == f"x contact {kind}: [{kind.upper()}]{value[len(own):]}. thanks"
    assert got[999] == "" and new[999] == dict(rows)[999]


def test_personal_data_of_odd_rows(odd, empty):
    assert personal_data(odd).count() == odd.count() and personal_data(empty).count() == 0
    out = redact(odd)
    assert out.columns == odd.columns and sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))


def test_personal_data_uses_no_python(odd):
    plan = personal_data(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def plain_fingerprint(text, band):
    """One text at a time, with whole numbers and sets instead of arrays."""
    words = {w for w in re.findall(r"[^\W_]+", text.lower())}
    if not words:
        return [hashlib.blake2b(text.encode(), digest_size=4).hexdigest()] * 40
    hashed = {w: xxhash.xxh64_intdigest(w) - 2**63 for w in words}
    used = [h for w, h in hashed.items() if w in band]
    used = sorted(used if len(used) >= 8 else hashed.values())
    parts = []
    for k in range(40):
        members = []
        for h in used:
            x = ((h % 2**64) ^ ((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * 0xBF58476D1CE4E5B9 % 2**64
            x = (x ^ x >> 31) * 0x94D049BB133111EB % 2**64
            if (x >> 40) % 2 ** (2 + k // 5) == 0:
                members.append(h.to_bytes(8, "little", signed=True))
        parts.append(hashlib.blake2b(b"".join(members), digest_size=4).hexdigest() if members else "00000000")
    return parts


def plain_likeness(a, b):
    pairs = [(x, y) for x, y in zip(a, b) if x != "00000000" or y != "00000000"]
    return 1.0 if a == b else sum(x == y for x, y in pairs) / len(pairs)


@pytest.mark.parametrize("range_bytes", [16 << 20, 20_000, 1])
def test_fingerprints_against_brute_force(corpus, monkeypatch, range_bytes):
    monkeypatch.setattr(fingerprinting, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(fingerprinting, "MAX_RANGES", 60)
    docs = corpus[0].where("doc_id % 3 <> 2")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    seen = Counter(w for _, t in rows for w in set(re.findall(r"[^\W_]+", t.lower())))
    band = {w for w, n in seen.items() if max(2, 0.002 * len(rows)) <= n <= max(2, 0.9 * len(rows))}
    got = {r["doc_id"]: r for r in fingerprints(docs.repartition(5), low=0.002, high=0.9).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, changed, other = (plain_fingerprint(t, band) for t in (text, edited, after))
        want = (len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(changed), plain_likeness(own, changed), plain_likeness(own, other))
        assert tuple(got[i])[1:] == want
    assert sum(r["near_edited"] for r in got.values()) > 3 * sum(r["near_next"] for r in got.values())


def test_rows_of_one_id_fill_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprinting, "RANGE_BYTES", 500)
    frame = spark.createDataFrame([(7 if k % 3 else k, f"text number {k % 40} of some") for k in range(300)], "doc_id long, text string").repartition(4)
    sizes = fingerprinting.in_order(frame).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 100
    assert sorted(r["doc_id"] for r in fingerprints(frame).collect()) == sorted(r["doc_id"] for r in frame.collect())


def test_ranges_are_cut_once_whatever_the_plan_reuses(spark, monkeypatch):
    """Ranges are cut at sampled ids: with few samples and no reuse of exchanges, the plans that use them cut alike."""
    monkeypatch.setattr(fingerprinting, "RANGE_BYTES", 2000)
    texts = {i: f"text number {i * 7 % 1000} of {i} some and more words {i % 13}" for i in range(1000)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    monkeypatch.setattr(fingerprinting, "RANGE_SAMPLE", 2)
    conf = {"spark.sql.exchange.reuse": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = fingerprints(frame).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        text, after = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % 1000]
        cut = len(text) // 4
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()


def test_fingerprints_of_odd_rows(spark, odd, empty):
    got = fingerprints(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}) == 1
    assert fingerprints(empty).count() == 0
    assert fingerprints(spark.createDataFrame([(1, "one word")], "doc_id long, text string")).first()["near_next"] == 1.0


def test_likeness_skips_parts_that_neither_has():
    make = Fingerprinter(np.sort(np.array([fingerprinting.term_hash(f"t{i:04}") for i in range(400)])))
    a = " ".join(f"t{i:04}" for i in range(0, 120))
    assert likeness(make(a), make(a)) == 1.0 and make("!!!") != make("???")
    assert likeness(make(a), make(a + " t0300")) > 0.5 > likeness(make(a), make(" ".join(f"t{i:04}" for i in range(200, 320))))

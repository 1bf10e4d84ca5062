import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagic.llm import hard_negatives as negatives
from pelagic.llm import ranked_search as search
from pelagic.llm.hard_negatives import hard_negatives
from pelagic.llm.html_text import extract_text, main_text
from pelagic.llm.ranked_search import ranked_search

VECTORS = "vec_id long, label long, vector array<long>"


def plain_negatives(rows, every, positives=5, wanted=3):
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    rows, out = {i: (label, v) for i, label, v in sorted(rows, key=lambda r: (-r[0], -r[1], [-x for x in r[2]]))}, set()
    for a, (label, v) in rows.items():
        if a % every:
            continue
        by = sorted((-product(v, u), i, own) for i, (own, u) in rows.items() if i != a)
        for s, p, _ in [x for x in by if x[2] == label][:positives]:
            found = [(-t, i) for t, i, own in by if own != label and 50 * -s <= 100 * -t <= 95 * -s][:wanted]
            out |= {(a, p, k + 1, i, -s, t) for k, (t, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "BUCKET_ROWS", 16)
    monkeypatch.setattr(negatives, "GROUP_COMPONENTS", 40)
    r = np.random.default_rng(seed)
    common = [int(x) for x in r.integers(-20, 20, 6)]
    rows = []
    for i in range(240):
        long = [3, 200, 40_000, 10**9][i % 4] if seed == 1 else 30
        v = [int(x) for x in r.integers(-long, long + 1, 6)]
        rows.append((i, int(r.integers(0, 3)), [common, [0] * 6, v[: i % 7], v][0 if i % 3 == 0 else 1 if i % 11 == 0 else 2 if seed == 2 and i % 5 == 0 else 3]))
    repeats = [rows[3], rows[3], (5, 9, [1, 2, 3]), rows[10]] * 20
    frame = spark.createDataFrame(rows + repeats + [(None, 1, [1]), (7000, None, [1]), (7050, 1, None), (7100, 1, [1, None])], VECTORS)
    got = [tuple(x) for x in hard_negatives(frame.repartition(5), F.col("vec_id") % 10 == 0).collect()]
    assert len(set(got)) == len(got) and set(got) == plain_negatives(rows, 10) and len(got) > 100


def test_feasible_ranges_keep_all_that_reach_the_score():
    r = np.random.default_rng(7)
    whole = (r.normal(size=(500, 4)) * r.choice([1, 1, 1, 9], 4) * 100).astype(np.int64)
    whole[::50] = 0
    norms = np.sqrt((whole.astype(float) ** 2).sum(1))
    lists = np.argsort(whole / np.where(norms == 0, 1, norms)[:, None], axis=0, kind="stable").astype(np.int32)
    row = {"rows": 500, "low": norms.min(), "high": norms.max(), "labels": np.zeros(500, np.int64).tobytes(), "ids": np.arange(500).tobytes(), "vectors": whole.tobytes(), "lists": lists.tobytes()}
    bucket, pruned = negatives.Bucket(row, 1), 0
    for q in np.vstack([whole[:40], [[0, 0, 0, 0], [1, 0, 0, 0]]]):
        norm, focus = float(np.sqrt((q.astype(float) ** 2).sum())), np.argsort(-np.abs(q))[:3]
        exact = whole @ q
        assert (bucket.scores(q, norm, None) == exact).all()
        for least in (-10**9, -1000, 0, 1, int(np.percentile(exact, 90)), int(exact.max()), int(exact.max()) + 1):
            found = bucket.feasible(q, norm, focus, least)
            found = np.arange(500) if found is None else found
            assert len(set(found.tolist())) == len(found) and set(np.flatnonzero(exact >= least)) <= set(found.tolist())
            pruned += 500 - len(found)
    assert pruned > 10_000


def test_a_common_vector_is_one_entry_of_one_bucket(spark):
    rows = [(i, 0, [5, 5, 5]) for i in range(5000)] + [(5000 + i, 1, [i % 50, 3, 4]) for i in range(500)]
    index = negatives.build_index(negatives.valid(spark.createDataFrame(rows, VECTORS)), 6).collect()
    assert sum(r["rows"] for r in index) == 51


def test_hard_negatives_of_empty_tables(spark):
    assert hard_negatives(spark.createDataFrame([], VECTORS), F.lit(True)).collect() == []
    assert hard_negatives(spark.createDataFrame([(1, 1, [2])], VECTORS), F.lit(False)).collect() == []
    assert hard_negatives(spark.createDataFrame([(1, 1, [2])], VECTORS), F.lit(True)).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain_ranks(docs, items, k):
    counts = [(i, Counter(search.terms(t or ""))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 25 + 25 * c.total() * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in search.terms(text or "") if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "shard", "block"), [(0, 16_384, 4 << 20), (1, 7, 60), (2, 50, 200)])
def test_ranked_search_against_brute_force(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.7)) % 60}" for _ in range(400)] + ["É", "Ünd", "ABC", "a_b", "x-y", "1", "日本"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 3, 10, 60])))) for i in range(300)]
    docs += [(i + 1000, docs[5][1]) for i in range(100)] + [(5, docs[5][1]), (2000, None), (2001, ""), (2002, "- _ ."), (None, docs[5][1]), (None, "w1 w2")]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 4, 20])))) for i in range(12)] + [(50, None), (51, "?"), (52, "nowhere"), (53, docs[5][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({"score": F.lit(1), "t": F.lit("x"), "n": F.lit(2)})
    got = ranked_search(frame, spark.createDataFrame(items + items[:3], "item_id long, text string"), 20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_ranks(docs, items, 20)


def test_ranked_search_reads_little_of_lists_that_cannot_matter():
    n = 20_000
    doc, term = np.concatenate([np.arange(n), np.arange(30)]), np.concatenate([np.zeros(n, np.int64), np.ones(30, np.int64)])
    shard = search.Shard(doc, term, np.ones(n + 30, np.int64), np.full(n, 100), 2)
    found, scores = shard.search([0, 1], np.array([1, 10_000]), 20, 1)
    assert set(found) == set(range(30)) and len(set(scores.tolist())) == 1
    assert [len(x) for x in shard.search([0, 1], np.array([1, 10_000]), 20, 10**12)] == [0, 0]


def test_ranked_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search(docs, items).collect() == ranked_search(one, items).collect() == ranked_search(docs, one.withColumnRenamed("doc_id", "item_id")).collect() == []


def page(article, around="{}", head="<head><title>T</title><script>var t='</p>';</script></head>"):
    return f"<!DOCTYPE html><html>{head}<body>{around.format(article)}</body></html>"


TEXT = "Many words of running text make a paragraph that is long enough to be dense, as articles have them."


def test_main_text_is_the_dense_subtree():
    menu = "<ul>" + "".join(f"<li><a href='/{k}'>Menu entry {k}</a></li>" for k in range(40)) + "</ul>"
    body = f"<div class='x1'><h1>Title &amp; more</h1><div><p>{TEXT}</p><p>{TEXT} <a href='#'>link</a> 2</p><p>Short.</p></div></div>"
    want = f"Title & more {TEXT} {TEXT} link 2 Short."
    assert main_text(page(body, "<div>" + menu + "</div>{}<div>" + menu + "</div>")) == want  # no name or tag tells what the menus are
    extra = [
        "<nav>{0}</nav>", "<header><h2>Site</h2>{0}</header>", "<footer>{0}</footer>", "<aside>{0}</aside>", "<form>{0}<input><textarea>{0}</textarea></form>", "<style>p > a {{}}</style>", "<!-- <p>{0}</p> -->",
        "<div class='ad'>{0}</div>", "<div id=cookie-notice><p>{0}</p></div>", "<section class='user comments'><article class='comment'><p>{0}</p></article></section>", "<div role=banner>{0}</div>", "<noscript>{0}</noscript>",
    ]
    for x in extra:
        noise = x.format(TEXT)
        assert main_text(page(body, noise.replace("{", "{{").replace("}", "}}") + "{}")) == want, x
        inside = page(f"<article><h1>Title &amp; more</h1><p>{TEXT}</p>{noise}<p>{TEXT} <a>link</a> 2<p>Short.</article>")
        assert main_text(inside) == want or x.startswith("<header"), x


def test_main_text_of_odd_markup():
    assert main_text("") == main_text("<html></html>") == main_text("<script>x</script>") == ""
    assert main_text("plain &lt;text&gt; a < b &amp; c &nbsp; d") == "plain <text> a < b & c d"
    assert main_text(f"<article><p>one<b>two</b>three<br>four<p>x&#233;&eacute;&#x1F600;\n\n y</p><table><tr><td>a<td>b</table>{TEXT}</article>") == f"onetwothree four xéé\U0001f600 y a b {TEXT}"
    assert main_text(f"<title>no</title><p>{TEXT}<p>{TEXT}") == f"{TEXT} {TEXT}"
    assert main_text(f"<body class='has-sidebar nav'><div class=with-comments><p>{TEXT}</div>") == TEXT
    assert main_text(f'<article><p title="a > b">{TEXT}</p><a href="unclosed>more</a></article>').startswith(TEXT)


@pytest.mark.parametrize("text", ['<a "' * 50_000, "<" * 100_000, "<div>" * 30_000 + "x" + "</b>" * 30_000, "<p><b>" * 30_000, "<!--" * 50_000, "<h1>" * 30_000 + "x", "<ul>" + "<li><div>" * 30_000, "<article>" + "<p>word " * 60_000])
def test_main_text_is_linear(text):
    began = time.perf_counter()
    main_text(text)
    assert time.perf_counter() - began < 10


def test_pages_with_odd_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", None, 1, "x"), (1, "u", "", 1, "x"), (None, None, "<p>a b</p>", 1, "x"), (2, "v", "<p>a b</p>", 1, "x"), (2, "v", "<p>a b</p>", 1, "x"), (3, "w", "<article>" + "<p>word</p>" * 20_000, 1, "x")]
    got = sorted(map(tuple, extract_text(spark.createDataFrame(rows, schema)).collect()), key=str)
    long = " ".join(["word"] * 20_000)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a b", 3), (2, "v", "a b", 3), (2, "v", "a b", 3), (3, "w", long, len(long))], key=str)
    assert extract_text(spark.createDataFrame([], schema)).collect() == []


def test_every_article_of_the_pages_is_whole(spark):
    """The pages mark their articles: all of their words come out, and no others."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    text = F.regexp_replace(F.regexp_extract("html", "(?s)<article>(.*)</article>", 1), "<(/?(b|i|a|em))( [^>]*)?>", "")
    marked = pages.select("page_id", F.regexp_replace(text, "<[^>]*>", " ").alias("marked"))
    import html

    rows = extract_text(pages).join(marked, "page_id").collect()
    assert len(rows) == pages.count() and all(r["text"] == " ".join(html.unescape(r["marked"]).split()) for r in rows)

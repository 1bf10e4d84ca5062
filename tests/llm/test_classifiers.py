import numpy as np
import pytest

from pelagic.llm.classifiers import labelled_sample
from pelagic.llm.gbdt import fit_forest, fit_isotonic
from pelagic.llm.quality import quality_scores
from pelagic.llm.quality import statistics as quality_statistics
from pelagic.llm.quality_rules import FEATURES, keep_good, learn_rules, quality_report
from pelagic.llm.toxicity import ToxicFeatures, toxicity_scores


def test_forest_learns_a_conjunction():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] < 0.1)).astype(float)
    forest = fit_forest(x[:3000], y[:3000])
    assert ((forest.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


@pytest.mark.parametrize("y", [np.zeros(5), np.ones(5), np.zeros(0)])
def test_forest_with_one_class_is_constant(y):
    p = fit_forest(np.random.default_rng(0).normal(size=(len(y), 3)), y).probability(np.zeros((2, 3)))
    assert p[0] == p[1] and 0 < p[0] < 1


def test_flat_traversal_equals_a_plain_walk():
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(1500, 4)), 1)  # with many ties on thresholds
    forest = fit_forest(x, ((x[:, 0] + x[:, 1] ** 2 > 1) ^ (r.random(1500) < 0.1)).astype(float), trees=25)

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return total

    seen = np.concatenate([x[:200], r.normal(size=(200, 4)) * 5])
    assert len(forest.roots) == 25 and np.allclose(forest.margin(seen), [walk(row) for row in seen], atol=1e-12)


def test_isotonic_equals_the_largest_of_smallest_means():
    r = np.random.default_rng(6)
    for n in (1, 2, 7, 60):
        score, y = r.integers(0, max(2, n // 2), n).astype(float), r.integers(0, 2, n).astype(float)
        at = np.unique(score)
        total, count = (np.array([w[score == a].sum() for a in at]) for w in (y, np.ones(n)))
        want = [max(min(total[a : b + 1].sum() / count[a : b + 1].sum() for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))]
        assert np.allclose(np.interp(at, *fit_isotonic(score, y)), want)


def test_isotonic_is_monotone_and_matches_means():
    score, y = np.array([1.0, 2, 3, 4, 5, 5]), np.array([0.0, 1, 0, 1, 1, 0])
    x, p = fit_isotonic(score, y)
    assert (np.diff(p) >= 0).all()
    assert np.allclose(np.interp([1, 2, 3], x, p), [0, 0.5, 0.5])
    assert fit_isotonic(np.zeros(0), np.zeros(0))[0].tolist() == [0.0, 1.0]


@pytest.mark.parametrize("score,label", [(toxicity_scores, "toxic"), (quality_scores, "quality")])
def test_held_out_accuracy(corpus, score, label):
    docs, labels = corpus
    rows = score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60
    assert sum(r["predicted"] == r[label] for r in rows) / len(rows) > 0.95


@pytest.mark.parametrize("score", [toxicity_scores, quality_scores])
def test_scores_of_odd_rows(odd, empty, labels, score):
    rows = score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert score(empty, labels).count() == 0
    assert len({r["score"] for r in score(odd, labels.limit(0)).collect()}) == 1


def test_features_are_finite():
    texts = ["", " ", "IDIOT you 1d10t s.t.u.p.i.d", "a" * 5000, "!!!"]
    assert np.isfinite(ToxicFeatures({"zzzz*": 2.0})(texts)).all() and np.isfinite(quality_statistics(texts)).all()
    assert ToxicFeatures({})(["you idiot"])[0][9] > 0


def plain_statistics(text):
    import re

    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def test_rule_statistics_against_plain_python(spark, corpus, odd):
    docs, labels = corpus
    more = spark.createDataFrame([(1000, "a b c d e f g h " * 3), (1001, "x " * 30), (1002, "l1\nl1\n\n \nl2\nl1 "), (1003, " ".join(map(str, range(40))) + " 0 1 2 3 4 5 6 7 8")], "doc_id long, text string")
    for frame in (docs.select("doc_id", "text").unionByName(more), odd.where("doc_id <> 4").select("doc_id", "text")):
        texts = {r["doc_id"]: r["text"] for r in frame.collect()}
        for r in quality_report(frame, labels).collect():
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_statistics(texts[r["doc_id"]])
            assert not (r["base_failed"] and r["kept"])


def test_verdicts_against_plain_python(corpus):
    import re

    docs, labels = corpus
    rules = learn_rules(docs, labels)
    got = {r["doc_id"]: r for r in quality_report(docs, labels).collect()}
    for r in docs.collect():
        n, chars, symbols, dup, repeated, failed = plain_statistics(r["text"])
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", r["text"]), max(1, sum(bool(x.strip(" \t\r\x0b\x0c")) for x in r["text"].split("\n")))
        one = max(1, n)
        of = {
            "symbols_per_word": symbols / one, "marks_per_word": sum(c in "!?" for c in r["text"]) / one, "upper_share": sum("A" <= c <= "Z" for c in r["text"]) / max(1, len(r["text"])), "word_length": chars / one,
            "dup_line_share": dup / lines, "repeat_share": repeated / one, "distinct_share": len(set(words)) / one, "words_per_line": n / lines,
        }
        holds = [all((of[FEATURES[x.feature]] > x.threshold) == x.above for x in rule) for rule in rules]
        assert got[r["doc_id"]]["rule"] == (holds.index(True) + 1 if any(holds) else 0)
        assert got[r["doc_id"]]["kept"] == (not failed and not any(holds))


def test_rules_reject_poor_and_keep_clean(corpus, empty):
    docs, labels = corpus
    assert learn_rules(docs, labels)
    rows = quality_report(docs, labels).join(labels, "doc_id").collect()
    assert sum(r["kept"] for r in rows if r["quality"] == 1) / sum(r["quality"] == 1 for r in rows) > 0.99
    assert sum(r["kept"] for r in rows if r["quality"] == 0) == 0
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert keep_good(empty, labels).count() == 0 and learn_rules(docs, labels.limit(0)) == []


def test_rules_use_no_python_on_executors(corpus):
    plan = quality_report(*corpus)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_the_labelled_sample_is_bounded_by_ids(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(2000)] + [(2, "two")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    got = labelled_sample(docs, labels, "quality", 10).collect()
    assert {(r["doc_id"], r["text"], r["label"]) for r in got} <= {(1, "text 999", 1), (2, "two", 0)} and 1 <= len(got) <= 2


def test_quality_statistics_one_by_one():
    """Each statistic of a small text, counted by hand or by the plainest loop."""
    text = "The cat cat sat.\n\nTHE DOG | ran!\nThe cat cat sat.\né#1 ...\nno end"
    got = dict(zip(("upper", "digit", "space", "symbol", "stop", "mark", "beyond", "bars", "bangs", "words", "chars", "different", "top", "twice", "mean", "std", "longest", "capitals", "same_lines", "ended", "per_line"), quality_statistics([text])[0]))
    raw, words, lines = text.encode(), text.split(), [x for x in text.split("\n") if x.strip()]
    sizes = [len(w) for w in words]
    mean = sum(sizes) / len(sizes)
    want = {
        "upper": sum(65 <= b <= 90 for b in raw) / len(raw), "digit": sum(48 <= b <= 57 for b in raw) / len(raw), "space": sum(chr(b).isspace() for b in raw if b < 128) / len(raw), "symbol": 2 / len(raw), "stop": 6 / len(raw), "mark": 0.0,
        "beyond": 2 / len(raw), "bars": 1 / len(words), "bangs": 1 / len(words), "words": np.log1p(16), "chars": np.log1p(len(text)), "different": len(set(words)) / 16, "top": 4 / 16, "twice": 2 / 16,
        "mean": mean, "std": (sum((x - mean) ** 2 for x in sizes) / 16) ** 0.5, "longest": 4, "capitals": 2 / 16, "same_lines": 1 - 4 / 5, "ended": 4 / 5, "per_line": 16 / 5,
    }
    assert len(words) == 16 and len(lines) == 5
    for name, value in want.items():
        assert np.isclose(got[name], value), name


def test_toxic_features_one_by_one():
    features = ToxicFeatures({"zorp": 2.0, "blub*": 1.5, "zorp*": 0.5})
    names = ("fixed", "word", "start", "l_fixed", "l_word", "l_start", "odds", "l_odds", "you", "near", "near_share", "capitals", "marks", "masked", "odd", "stretched", "words")
    text = "You idiot zorp! a b c d e f blubber you see ZORPING? 1d1ot m0ron i.d.i.o.t soooo"
    got = dict(zip(names, features([text])[0]))
    # words: You idiot zorp a b c d e f blubber you see ZORPING d ot m ron i d i o t soooo; odd: d1ot, m0ron, a b c d e f, i.d.i.o.t
    n = 23
    want = {
        "fixed": 1 / n, "word": 1 / n, "start": 2 / n, "l_fixed": np.log(2), "l_word": np.log(2), "l_start": np.log(3), "odds": (2.0 + 1.5 + 0.5) / n, "l_odds": np.log1p(4.0),
        "you": 2 / n, "near": 4 / n, "near_share": 1.0, "capitals": 8 / len(text), "marks": 2 / n, "masked": 1 / n, "odd": 4 / n, "stretched": 1 / n, "words": np.log1p(n),
    }
    for name, value in want.items():
        assert np.isclose(got[name], value), (name, got[name] * n, value * n)
    assert not features([""])[0].any()

import zlib

import numpy as np
import public_tokenizers
import pytest

from pelagic.llm.mixing import mix_sources
from pelagic.llm.packing import WordIds, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_mix_reaches_the_weights(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 > 0 THEN 'big' WHEN id % 2 = 0 THEN 'mid' ELSE NULL END AS source")
    got = {r["source"]: r["count"] for r in mix_sources(docs, {"big": 1, "mid": 1, None: 2}).groupBy("source").count().collect()}
    assert abs(got["big"] - 1500) < 200 and abs(got["mid"] - 1500) < 200 and abs(got[None] - 3000) < 300
    means = mix_sources(docs.where("doc_id < 40"), {"big": 0, "mid": 1, None: 0}, epochs=20).groupBy("doc_id").count().collect()
    assert all(60 < r["count"] < 240 for r in means)  # a mean above that of one draw


def test_mix_is_the_same_on_any_partitioning_and_keeps_columns(odd, empty):
    a, b = (sorted(map(str, mix_sources(d, copy_col="copy").collect())) for d in (odd, odd.repartition(7)))
    assert a == b and mix_sources(odd).columns == odd.columns
    assert mix_sources(odd, copy_col="copy").columns == [c for c in odd.columns if c != "copy"] + ["copy"]
    assert mix_sources(empty).count() == 0


@pytest.mark.parametrize("windows", [2, 64])
def test_packing_round_trip(spark, odd, windows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    rows = [(i, "word, two. Three " * (i * i % 700)) for i in range(60)]
    docs = odd.where("doc_id <> 4").select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in rows], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    pieces = pack_documents(docs, PATH, windows=windows).collect()
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own)
        assert p["ids_crc32"] == zlib.crc32(np.array(own[p["start"] : p["start"] + p["length"]], "<u4").tobytes())
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert by_doc.keys() == ids.keys()
    for at, total in ((sorted(v), len(ids[i])) for i, v in by_doc.items()):
        assert [s for s, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) == total
    for at in map(sorted, by_sequence.values()):
        assert [s for s, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 2048
    if windows == 64:
        tokens = sum(map(len, ids.values()))
        assert len(by_sequence) <= tokens // 2048 + 1 + max(2, tokens // 2048 // 10)


def test_packing_repeats_and_empty(odd, empty):
    assert pack_documents(odd.where("doc_id = 4"), PATH).count() == 2
    assert pack_documents(empty, PATH).count() == 0


def test_word_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    texts = ["Hello,  World.\nIt's <|endoftext|> A<|startoftext|>b <|ENDOFTEXT|>", "İstanbul, café. ΣΣ", "é, क़. 10,000.5 ...,", "", " "]
    want = [np.array(x.ids, "<u4").tobytes() for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert WordIds(PATH).encode(texts) == want and WordIds(PATH, entries=3).encode(texts) == want

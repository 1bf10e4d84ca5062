import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pelagic.llm.jaccard import near_duplicates
from pelagic.llm.personal_data import redact
from pelagic.llm.quality_rules import quality_report


def test_stages_in_turn(spark, corpus, tmp_path):
    docs, labels = corpus
    twice = docs.where("doc_id < 40 AND doc_id % 6 = 0").selectExpr("doc_id + 10000 AS doc_id", "concat(text, ' mail me.now@x.org') AS text", "lang", "source", "n_chars")
    docs = docs.unionByName(twice)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    frame, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        seen[name] = frame
        if name != "packing":
            assert frame.columns == docs.columns
    kept = {r["doc_id"] for r in quality_report(docs, labels).where("kept").collect()}
    assert {r["doc_id"] for r in seen["quality_rules"].collect()} == kept
    first = {r["doc_id"] for r in near_duplicates(seen["quality_rules"]).where("component_id = doc_id").collect()}
    assert {r["doc_id"] for r in seen["jaccard_join"].collect()} == first and not any(i >= 10000 for i in first)
    assert seen["personal_data"].count() == len(first) and "@" not in " ".join(r["text"] for r in redact(docs).collect())
    mixed = {r["doc_id"] for r in seen["mix_sources"].collect()}
    assert mixed <= first and {r["doc_id"] for r in seen["packing"].collect()} == mixed
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids_crc32").collect())) == sorted(map(str, seen["packing"].select("doc_id", "ids_crc32").collect()))


def clashing(frame):
    """With columns under the names that the stages use themselves."""
    names = ["__q_text", "__q_kept", "__p_text", "__p_more", "__mix_rate", "__mix_copies", "__gone", "gone", "stays", "kept_0", "node", "component_id", "label", "kind", "Kept_1"]
    return frame.withColumns({n: F.lit(k) for k, n in enumerate(names)})


@pytest.mark.parametrize("k", range(5))
def test_odd_rows_and_names_in_every_stage(spark, odd, empty, labels, tmp_path, k):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    name, stage = corpus_pipeline.STAGES[k]
    long = spark.createDataFrame([(20, "a river runs through the valley. " * 400 + str(k), "en", "s", 1, "c", 1.5, 7) for k in range(2)], odd.schema)
    docs = clashing(odd.unionByName(long))
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    nothing = stage(spark, clashing(empty), str(tmp_path))
    assert nothing.count() == 0
    if name == "packing":
        assert sorted({r["doc_id"] or 0 for r in rows}) == sorted({r["doc_id"] or 0 for r in docs.collect()})
        return
    assert out.columns == docs.columns and nothing.columns == clashing(empty).columns
    before = {}
    for r in docs.collect():
        before[r["doc_id"], r["text"]] = tuple(r)
    assert all(tuple(r) == before[r["doc_id"], r["text"]] for r in rows)  # nothing here is personal data
    if name == "personal_data":
        assert len(rows) == docs.count()
    if name == "quality_rules":
        assert all(len((r["text"] or "").split()) >= 20 for r in rows)
    if name == "jaccard_join":
        assert [r["doc_id"] for r in rows].count(None) == 1 and 5 not in {r["doc_id"] for r in rows}

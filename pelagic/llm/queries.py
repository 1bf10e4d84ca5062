"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_digests
from .common import table
from .fingerprints import fingerprints
from .hard_negatives import hard_negatives
from .html_text import extract_text
from .jaccard import near_duplicates
from .mixing import mix_sources
from .packing import pack_documents
from .personal_data import personal_data
from .quality import quality_scores
from .quality_rules import quality_report
from .ranked_search import ranked_search
from .token_counts import token_counts
from .toxicity import toxicity_scores


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), copy_col="copy")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], rows.schema)
    return chat_digests(rows.unionByName(added), _tokenizer("byte_bpe_50k.json")).drop("n_tokens")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, x = table(spark, sf_dir, "embeddings"), F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.where(finite).select("vec_id", label.alias("label"), F.transform(x, lambda v: F.floor(256 * v.cast("double"))).alias("vector"))
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_mix_sources": op3_mix_sources,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_quality_rules": op6_quality_rules,
    "op7_pack_documents": op7_pack_documents,
    "op8_token_counts": op8_token_counts,
    "op9_fingerprints": op9_fingerprints,
    "op10_personal_data": op10_personal_data,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_html_text": op12_html_text,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    # the control strings are <, backslashes and |; each gets one backslash more.
    "op5_chat_formatting": r"""
WITH own AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized AS (
  SELECT *, LENGTH(text) + LEN(REGEXP_EXTRACT_ALL(text, '<\\*\|')) AS text_n,
    LENGTH(REPLACE(REPLACE(role, '\', '\\'), CHR(10), '\n')) + LEN(REGEXP_EXTRACT_ALL(REPLACE(role, '\', '\\'), '<\\*\|')) AS role_n
  FROM own
)
SELECT conv_id, COUNT(*) AS n_turns,
  SHA256(STRING_AGG(role || CHR(10) || text || CHR(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  COALESCE(SUM(LENGTH(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  SHA256(COALESCE(STRING_AGG(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  SUM(12 + role_n + 1 + text_n + 10 + 1)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op3_mix_sources": """
WITH counts AS (
  SELECT source AS s, COUNT(*) AS n, SQRT(COUNT(*)::DOUBLE) AS w FROM documents GROUP BY source
), rates AS (
  SELECT s, w / (SELECT SUM(w) FROM counts) * (SELECT SUM(n) FROM counts) / n AS rate FROM counts
), means AS (
  SELECT s, GREATEST(1, CEIL(rate / 16.0))::INT AS draws, rate / GREATEST(1, CEIL(rate / 16.0)) AS mean FROM rates
), terms AS (
  SELECT s, draws, k, EXP(-mean + k * LN(mean) - LGAMMA(k + 1)) AS p FROM means, range(96) AS t(k)
), cdf AS (
  SELECT s, draws, LIST(c ORDER BY k) AS cdf
  FROM (SELECT s, draws, k, SUM(p) OVER (PARTITION BY s ORDER BY k) AS c FROM terms) GROUP BY s, draws
), drawn AS (
  SELECT d.doc_id, SUM(LEN(LIST_FILTER(c.cdf, lambda x: x <= ('0x' || SUBSTR(MD5('17|' || d.doc_id || '|' || j.j), 1, 13))::BIGINT / 4503599627370496.0)))::BIGINT AS copies
  FROM documents d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.s, range(1, 1000) AS j(j)
  WHERE j.j <= c.draws GROUP BY d.doc_id
)
SELECT d.*, k.k::INT AS copy FROM documents d JOIN drawn USING (doc_id), range(1, 200) AS k(k) WHERE k.k <= drawn.copies
""",
    "op11_hard_negatives": """
WITH own AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, LIST_TRANSFORM(embedding, lambda v: FLOOR(256 * v::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND LEN(LIST_FILTER(embedding, lambda v: v IS NULL OR NOT ISFINITE(v))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, LIST_INNER_PRODUCT(a.vector, b.vector)::BIGINT AS score
  FROM own a JOIN own b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id, ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INT AS rank,
  s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
""",
    "op13_ranked_search": r"""
WITH words AS (
  SELECT doc_id, UNNEST(REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), asked AS (
  SELECT item_id, term, COUNT(*) AS often FROM (
    SELECT item_id, UNNEST(REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY item_id, term
), lengths AS (
  SELECT doc_id, COUNT(*) AS n FROM words GROUP BY doc_id
), whole AS (
  SELECT COUNT(*) AS big_n, SUM(n)::BIGINT AS big_l FROM lengths
), postings AS (
  SELECT doc_id, term, COUNT(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY doc_id, term
), weights AS (
  SELECT term, FLOOR(1000 * LN((2 * big_n + 2)::DOUBLE / (2 * COUNT(*) + 1)))::BIGINT AS w FROM postings, whole GROUP BY term, big_n
), points AS (
  SELECT p.doc_id, p.term, weights.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * l.n * big_n) // big_l))) AS points
  FROM postings p JOIN lengths l USING (doc_id) JOIN weights USING (term), whole
), scored AS (
  SELECT item_id, doc_id, SUM(often * points)::BIGINT AS score FROM asked JOIN points USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 20
""",
}

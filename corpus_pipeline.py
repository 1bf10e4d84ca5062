"""The corpus pipeline: quality rules, near duplicates, personal data, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() writes every stage's result as
Parquet to the shared folder and reads it again. All stages but the last return the columns of documents, whatever else
docs holds; extra columns may have any names. doc_id has to be of an integer type. Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pelagic.llm.common import materialize, table
from pelagic.llm.jaccard import keep_first
from pelagic.llm.mixing import mix_sources
from pelagic.llm.packing import pack_documents
from pelagic.llm.personal_data import redact
from pelagic.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base limit or a learned rule rejects go.

    A null or empty text goes, as one of fewer than 20 words does. Rows with equal texts stay or go together, also with a
    null or repeated doc_id. A text of any length is judged whole.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest doc_id.

    Rows without words or without doc_id stay. Of rows that repeat a doc_id, all stay whose group it names.
    """
    return keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows. All rows stay; a null text stays null."""
    return redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to weights that grow as the square root of their rows; a document may come several times, or not at all.

    A null source is one of its own; rows with equal ids, null ones too, come equally often.
    """
    return mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048: a row per piece of a document. A null or empty text is its end mark alone; each row is packed by itself."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join), ("personal_data", personal_data), ("mix_sources", mix), ("packing", pack)]

#: Learned rules and tokenizers are beyond SQL: tests/llm compares run() with plain Python, stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

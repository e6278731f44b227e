"""From raw documents to token ids: five stages over the documents table, each written before the next.

Every stage but the last returns the columns of documents. ``run`` applies them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.llm.common import staged
from signalmill.sources.files import table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without a letter and those whose language is in doubt; fills in a missing ``lang``."""
    from signalmill.llm.language import UNKNOWN, identified, train

    rows = docs.select(F.struct(*docs.columns).alias("doc"), identified(train(docs), "text").alias("found"))
    sure = rows.where((F.col("found.lang_pred") != UNKNOWN) & ~F.col("found.ambiguous"))
    lang = F.coalesce("doc.lang", "found.lang_pred").alias("lang")
    return sure.select(*[lang if c == "lang" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that repeat an earlier one; a document keeps its row even if no line is left."""
    from signalmill.llm.lines import dedup_lines

    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones, that with the smallest id."""
    from signalmill.llm.jaccard import first_of_each

    return first_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings sources to their weights; a document stands as often as the mix takes it."""
    from signalmill.llm.mixing import mixed_documents

    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the mix; one row per document and copy."""
    from public_tokenizers import path

    from signalmill.llm.pieces import encode

    return encode(docs, path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("near_duplicates", distinct_documents),
    ("source_mix", mixed_sources),
    ("token_ids", token_ids),
]

#: The classifier, the edit join and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

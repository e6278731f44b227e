"""The registered queries of the text operators, with SQL equivalents where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalmill.llm import sql
from signalmill.plans.catalogue import Catalogue
from signalmill.sources.files import table

CATALOGUE = Catalogue()


@CATALOGUE.query("op1_token_counts")
def op1_token_counts(spark, folder):
    from public_tokenizers import path

    from signalmill.llm.token_counts import count_tokens

    counted = count_tokens(table(spark, folder, "documents"), path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@CATALOGUE.query("op2_quality_rules", sql.quality_rules())
def op2_quality_rules(spark, folder):
    from signalmill.llm.quality import BASE, POLICIES, kept, ledger

    entries = ledger(table(spark, folder, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~kept(BASE)).alias("base_failed"), kept(POLICIES[-1]).alias("kept"), "fail_bits",
    )


@CATALOGUE.query("op3_jaccard_join")
def op3_jaccard_join(spark, folder):
    from signalmill.llm.jaccard import similar_documents

    return similar_documents(table(spark, folder, "documents"))


@CATALOGUE.query("op4_mix_sources", sql.mix_sources())
def op4_mix_sources(spark, folder):
    from signalmill.llm.mixing import mix

    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@CATALOGUE.query("op5_language_id")
def op5_language_id(spark, folder):
    from signalmill.llm.language import identify, train

    docs = table(spark, folder, "documents")
    return identify(docs, train(docs))


@CATALOGUE.query("op6_sentencepiece")
def op6_sentencepiece(spark, folder):
    from public_tokenizers import path

    from signalmill.llm.pieces import encode

    return encode(table(spark, folder, "documents"), path("piece_bpe_32k.model"))


@CATALOGUE.query("op7_personal_data")
def op7_personal_data(spark, folder):
    from signalmill.llm.personal import find, train

    docs = table(spark, folder, "documents")
    return find(docs, train(docs))


@CATALOGUE.query("op8_line_dedup")
def op8_line_dedup(spark, folder):
    from signalmill.llm.lines import dedup_lines

    kept = dedup_lines(table(spark, folder, "documents"))
    return kept.select(
        "doc_id", F.col("_removed").alias("n_removed"), F.col("_near").alias("n_near"),
        F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"),
    )


@CATALOGUE.query("op9_fingerprints")
def op9_fingerprints(spark, folder):
    from signalmill.llm.fingerprints import fingerprints

    return fingerprints(table(spark, folder, "documents"))


@CATALOGUE.query("op10_license_scan", sql.license_scan())
def op10_license_scan(spark, folder):
    from signalmill.llm.licenses import scan

    found = scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_sentences", "n_matches",
        F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


@CATALOGUE.query("op11_embedding_whitening")
def op11_embedding_whitening(spark, folder):
    from signalmill.llm.whitening import whitened_rows

    white = whitened_rows(table(spark, folder, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


@CATALOGUE.query("op12_chat_formatting", sql.chat_formatting())
def op12_chat_formatting(spark, folder):
    from signalmill.llm.chat import format_conversations, read_back

    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], given.schema)
    return read_back(format_conversations(given.union(planted)), arranged=True)


@CATALOGUE.query("op13_phrase_collocations", sql.phrase_collocations())
def op13_phrase_collocations(spark, folder):
    from signalmill.llm.phrases import collocations

    return collocations(table(spark, folder, "documents"))


def all_queries():
    return dict(CATALOGUE.queries)


def all_sql():
    return dict(CATALOGUE.sql)

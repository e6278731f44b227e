"""Word counting over text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.functions import text as T


def explode_words(df: DataFrame, text: str) -> DataFrame:
    """One row per word of every line of a text column."""
    lines = df.select(F.explode(T.lines(F.col(text))).alias("line"))
    return lines.select(F.explode(T.words(F.col("line"))).alias("word"))


def word_count(words: DataFrame) -> DataFrame:
    """Occurrences per word; partial counts keep a frequent word off the shuffle."""
    return words.groupBy("word").agg(F.count("*").alias("n"))


def by_count(counts: DataFrame, descending: bool = False) -> DataFrame:
    """Words in order of their count; equal counts in word order."""
    n = F.col("n").desc() if descending else F.col("n")
    return counts.orderBy(n, "word")


def max_pair(counts: DataFrame) -> DataFrame:
    """The largest (count, word) pair."""
    top = counts.agg(F.max(F.struct("n", "word")).alias("top"))
    return top.select("top.n", "top.word")


def total(counts: DataFrame) -> DataFrame:
    """Number of words counted."""
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))

"""Word counts over the document texts, and capitalisation of part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalmill.functions import text as T
from signalmill.operators import words
from signalmill.plans.catalogue import Catalogue
from signalmill.sources.files import table

CATALOGUE = Catalogue()

# Words as the text functions define them: inner empty words count, trailing ones do not.
_WORDS = """
  SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) l
  WHERE line = '' OR rtrim(line, ' ') <> ''"""
_COUNTS = f"SELECT word, count(*) AS n FROM ({_WORDS}) w GROUP BY 1"

_CAPITALIZED = """
  SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS p_name FROM part"""


def _words(spark, folder):
    return words.explode_words(table(spark, folder, "documents"), "text")


def _counts(spark, folder):
    return words.word_count(_words(spark, folder))


@CATALOGUE.query("word_explode", f"SELECT word FROM ({_WORDS}) w")
def word_explode(spark, folder):
    return _words(spark, folder)


@CATALOGUE.query("word_count", _COUNTS)
def word_count(spark, folder):
    return _counts(spark, folder)


@CATALOGUE.query("word_count_sorted", f"SELECT n, word FROM ({_COUNTS}) c ORDER BY n, word")
def word_count_sorted(spark, folder):
    return words.by_count(_counts(spark, folder)).select("n", "word")


@CATALOGUE.query(
    "word_prefix", f"SELECT word, n FROM ({_COUNTS}) c WHERE starts_with(word, 'a')"
)
def word_prefix(spark, folder):
    return _counts(spark, folder).where(F.col("word").startswith("a"))


@CATALOGUE.query(
    "word_pattern",
    f"""SELECT word FROM ({_WORDS}) w
        WHERE starts_with(word, 'c') AND length(word) >= 4 AND substr(word, 4, 1) = 'e'""",
)
def word_pattern(spark, folder):
    word = F.col("word")
    return _words(spark, folder).where(word.startswith("c") & T.has_letter_at(word, 4, "e"))


@CATALOGUE.query("word_total", f"SELECT count(*) AS total FROM ({_WORDS}) w")
def word_total(spark, folder):
    return _words(spark, folder).agg(F.count("*").alias("total"))


@CATALOGUE.query(
    "word_distinct_count", f"SELECT count(DISTINCT word) AS words FROM ({_WORDS}) w"
)
def word_distinct_count(spark, folder):
    return _counts(spark, folder).agg(F.count("*").alias("words"))


@CATALOGUE.query(
    "word_max_pair", f"SELECT n, word FROM ({_COUNTS}) c ORDER BY n DESC, word DESC LIMIT 1"
)
def word_max_pair(spark, folder):
    return words.max_pair(_counts(spark, folder))


@CATALOGUE.query("word_first", f"SELECT n, word FROM ({_COUNTS}) c ORDER BY n, word LIMIT 1")
def word_first(spark, folder):
    return words.by_count(_counts(spark, folder)).limit(1).select("n", "word")


@CATALOGUE.query("word_bottom_k", f"SELECT n, word FROM ({_COUNTS}) c ORDER BY n, word LIMIT 3")
def word_bottom_k(spark, folder):
    return words.by_count(_counts(spark, folder)).limit(3).select("n", "word")


@CATALOGUE.query("capitalize_words", _CAPITALIZED)
def capitalize_words(spark, folder):
    name = T.capitalize_words(F.col("p_name")).alias("p_name")
    return table(spark, folder, "part").select("p_partkey", name)


@CATALOGUE.query("capitalize_words_sql", _CAPITALIZED)
def capitalize_words_sql(spark, folder):
    T.register_capitalize_words(spark, "capitalize_words")
    table(spark, folder, "part").createOrReplaceTempView("part_view")
    return spark.sql("SELECT p_partkey, capitalize_words(p_name) AS p_name FROM part_view")


@CATALOGUE.query("capitalize_words_udf", _CAPITALIZED)
def capitalize_words_udf(spark, folder):
    spark.udf.register("capitalize_words_udf", T.capitalize_words_udf())
    table(spark, folder, "part").createOrReplaceTempView("part_view")
    return spark.sql("SELECT p_partkey, capitalize_words_udf(p_name) AS p_name FROM part_view")

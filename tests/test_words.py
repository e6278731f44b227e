import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from signalmill.functions import text as T
from signalmill.operators import words as W
from signalmill.sources.files import table


def counted(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return W.word_count(W.explode_words(df, "text"))


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a b", ["a", "b"]),
        ("a  b", ["a", "", "b"]),
        (" a", ["", "a"]),
        ("a b  ", ["a", "b"]),
        ("", [""]),
        ("   ", []),
        ("a\tb c", ["a\tb", "c"]),
    ],
)
def test_words_of_a_line(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(T.words(F.col("line")).alias("w")).first()["w"] == expected


def test_counts_and_ties(spark):
    counts = counted(spark, "b a b\nc a", "d")
    assert rows(counts) == [("a", 2), ("b", 2), ("c", 1), ("d", 1)]
    assert [tuple(r) for r in W.by_count(counts).collect()] == [("c", 1), ("d", 1), ("a", 2), ("b", 2)]
    assert W.by_count(counts, descending=True).first()["word"] == "a"
    assert rows(W.max_pair(counts)) == [(2, "b")]
    assert rows(W.total(counts)) == [(6,)]


def test_null_text_has_no_words(spark):
    assert counted(spark, None).count() == 0


def test_letter_position_is_one_based_and_needs_the_length(spark):
    df = spark.createDataFrame([("circle",), ("cir",), ("cold",)], "w string")
    assert rows(df.where(T.has_letter_at(F.col("w"), 4, "c"))) == [("circle",)]
    assert rows(df.where(T.has_letter_at(F.col("w"), 4, "d"))) == [("cold",)]


TEXTS = [("be the cHANGE, that's all", "Be The CHANGE, That's All"), ("a  b ", "A  B "), ("", ""), ("élan ß", "Élan SS"), (None, None)]


@pytest.mark.parametrize("kind", ["native", "sql", "udf"])
def test_capitalisation_leaves_the_rest_of_a_word(spark, kind):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "t string")
    if kind == "native":
        got = df.select(T.capitalize_words(F.col("t")))
    else:
        if kind == "sql":
            T.register_capitalize_words(spark, "capitalised")
        else:
            spark.udf.register("capitalised", T.capitalize_words_udf())
        df.createOrReplaceTempView("quotes")
        got = spark.sql("SELECT capitalised(t) FROM quotes")
    assert [r[0] for r in got.collect()] == [want for _, want in TEXTS]
    if kind == "udf":
        spark.sql("DROP TEMPORARY FUNCTION capitalised")


def test_sql_function_runs_without_python(spark, folder):
    T.register_capitalize_words(spark, "capitalised_sql")
    table(spark, folder, "part").createOrReplaceTempView("part_names")
    assert "Python" not in plan(spark.sql("SELECT capitalised_sql(p_name) FROM part_names"))


def test_a_frequent_word_is_counted_before_the_shuffle(spark, folder):
    documents = table(spark, folder, "documents")
    text = plan(W.word_count(W.explode_words(documents, "text")))
    assert "partial_count" in text
    assert "doc_id" not in text

"""Text functions: words of a line, capitalisation, name joining."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def words(line: Column) -> Column:
    """Words of a line separated by single blanks.

    Inner empty words are kept and trailing ones dropped; an empty line has one
    empty word, a line of blanks has none.
    """
    trimmed = F.rtrim(line)
    blank = (line != "") & (trimmed == "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def lines(text: Column) -> Column:
    """Lines of a text, broken at line feeds."""
    return F.split(text, "\n")


def has_letter_at(word: Column, position: int, letter: str) -> Column:
    """True if the word is long enough and holds the letter at a 1-based position."""
    return (F.length(word) >= position) & (F.substring(word, position, 1) == letter)


def capitalize_words(text: Column) -> Column:
    """Upper-cases the first letter of every word and leaves the rest as it is."""
    return F.array_join(
        F.transform(
            F.split(text, " "),
            lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647)),
        ),
        " ",
    )


def register_capitalize_words(spark: SparkSession, name: str = "capitalize_words") -> None:
    """Makes the native expression callable from SQL; the optimizer inlines it."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN "
        "array_join(transform(split(s, ' '), "
        "w -> concat(upper(substring(w, 1, 1)), substring(w, 2))), ' ')"
    )


def capitalize_words_udf():
    """The same as an Arrow-batched user function, for ``spark.udf.register``."""

    @F.pandas_udf("string")
    def capitalize(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            return " ".join(w[:1].upper() + w[1:] for w in text.split(" "))

        return texts.map(one)

    return capitalize


def joined_names(*names: Column) -> Column:
    """Names joined by commas; empty ones keep their place and NULL is the text ``null``."""
    return F.concat_ws(",", *[F.coalesce(n, F.lit("null")) for n in names])

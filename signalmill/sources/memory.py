"""Small tables made of rows in the program."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows_table(
    spark: SparkSession, rows: Sequence, schema: str | Sequence[str] | StructType
) -> DataFrame:
    """In-memory rows under column names, a DDL schema or a full schema."""
    return spark.createDataFrame(rows, schema)


def json_table(spark: SparkSession, text: str, ddl: str) -> DataFrame:
    """A table from a JSON array of objects; raises if the text is malformed.

    Single quotes are accepted, as in Spark's JSON reader.
    """
    parsed = F.from_json(F.lit(text), ddl, {"mode": "FAILFAST", "allowSingleQuotes": "true"})
    return spark.range(1).select(F.inline(parsed))

"""What several text operators share: words, staging, and values bound once inside a row."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.session import scratch_path

#: Words and the blanks between them, alike in Java's, DuckDB's and Python's patterns.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

TEXTS_PER_BATCH = 256


def staged(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, so that it is computed once.

    The table also cuts the lineage: a lost executor costs its running tasks
    only, never the work before this point.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, label: str) -> DataFrame:
    """As :func:`staged`, dealt by ``column``, so that grouping by it moves no row."""
    spark, name = df.sparkSession, f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, column).option("compression", "zstd")
    writer.format("parquet").option("path", scratch_path(spark, label)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay; the name would outlive its use
    return table


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``TEXTS_PER_BATCH`` rows, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_PER_BATCH):
            yield batch.slice(at, TEXTS_PER_BATCH)
        del batch
    pa.default_memory_pool().release_unused()


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def count_words(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]

"""File writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.sources.capabilities import require_format

MODES = ("append", "overwrite", "ignore", "error")


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV files; with ``ignore`` an existing target stays as it is."""
    df.write.mode(_known(mode)).csv(path, header=header)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """A table directory, Parquet or Delta."""
    if fmt != "parquet":
        require_format(df.sparkSession, fmt)
    df.write.mode(_known(mode)).format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, *keys: str, mode: str = "overwrite") -> None:
    """Parquet in one directory per key value.

    Rows are first brought together by key, so that a directory gets few files;
    adaptive execution splits a key that is too large for one file. An empty
    text key is read back as NULL.
    """
    if not keys:
        raise ValueError("name at least one partition key")
    seen: set[str] = set()
    twice = {c for c in df.columns if c.lower() in seen or seen.add(c.lower())}
    if twice:
        raise ValueError(f"rename the duplicate columns first: {sorted(twice)}")
    df.hint("rebalance", *keys).write.mode(_known(mode)).partitionBy(*keys).parquet(path)


def write_text(df: DataFrame, path: str, column: str) -> None:
    """A text column as lines."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_json_multiline(df: DataFrame, path: str, record: str, rows_per_file: int) -> None:
    """Indented JSON arrays, one per file, of rows with neighbouring record numbers.

    ``record`` is a unique integer column, which bounds the rows of a file.
    """
    number = F.col(record)
    chunk = (number - F.pmod(number, F.lit(rows_per_file))).alias("chunk")
    array = F.to_json(F.collect_list(F.struct(*df.columns)), {"pretty": "true"}).alias("value")
    df.groupBy(chunk).agg(array).write.mode("overwrite").partitionBy("chunk").text(path)


def _known(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; choose from {MODES}")
    return mode

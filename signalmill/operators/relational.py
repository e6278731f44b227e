"""Projections, renames, aggregates and row maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Selects columns (or struct fields) under new names: ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames columns, ``{old: new}``; old names match in any case."""
    return df.withColumnsRenamed(dict(names))


def rename_positions(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Renames all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns need as many names, got {len(names)}")
    return df.toDF(*names)


def rename_by_mapping(
    df: DataFrame, mapping: DataFrame, old: str = "sig_name", new: str = "sig_mapping_name"
) -> DataFrame:
    """Renames columns as a mapping table says, in one projection; old names match in any case.

    The filter leaves at most one mapping row per column of ``df``, so what the
    driver reads is bounded by the width of ``df``, whatever the mapping's size.
    """
    known = F.lower(old).isin([c.lower() for c in df.columns])
    wanted = mapping.where(known).select(F.lower(old).alias(old), new).distinct()
    pairs = wanted.limit(len(df.columns) + 1).collect()
    names = {row[old]: row[new] for row in pairs}
    if len(names) < len(pairs):
        raise ValueError("the mapping gives one column several names")
    return df.withColumnsRenamed(names)


def having(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], condition: Column
) -> DataFrame:
    """Grouped aggregates, filtered on their results."""
    grouped = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    return grouped.where(condition)


def count_and_distinct_count(df: DataFrame) -> DataFrame:
    """Rows before and after removing duplicates, in one scan and one shuffle of distinct rows."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    )


def fold(df: DataFrame, column: str, zero: int = 0) -> DataFrame:
    """Sum of a column plus a starting value, which counts once however the data is split."""
    total = F.coalesce(F.sum(column), F.lit(0))
    return df.agg((total + F.lit(zero)).alias("folded"))


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str
) -> DataFrame:
    """Maps rows in Arrow batches with a helper that ``make`` builds once per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        helper = make()
        for batch in batches:
            yield helper(batch)

    return df.mapInPandas(run, schema)

"""Bringing streams into table directories."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from signalmill.functions.signals import rejected_lines
from signalmill.operators.rollups import (
    coarser_partials,
    count_points,
    day_partials,
    merge_days,
    merge_partials,
    merge_points,
    point_partials,
)
from signalmill.sinks.sql_tables import check_modes
from signalmill.sources.capabilities import require_format
from signalmill.streaming.batches import FOLD_EVERY, batch_path, current_folders, fold, read_batches


def append_writer(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> DataStreamWriter:
    """Appends rows exactly once, through the file sink's commit log."""
    if fmt != "parquet":
        require_format(stream.sparkSession, fmt)
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def landing_writer(stream: DataFrame, path: str) -> DataStreamWriter:
    """Lands the rows of each batch in a folder of its own, which a repeat overwrites.

    Unlike the file sink, it can take over a checkpoint that other batches have begun.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch_id))

    return stream.writeStream.foreachBatch(write)


def table_writer(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str,
    table_mode: str,
    keys: Sequence[str] = (),
    fold_every: int = FOLD_EVERY,
) -> DataStreamWriter:
    """Keeps an aggregate of a stream as a table directory.

    ``refresh`` and ``snapshot`` keep every complete result, and ``upsert`` every changed row, under its
    ``batch_id``. :func:`newest_result` reads a refreshed table, so that a reader never
    meets half of a result; :func:`current_rows` gives an upsert table's rows. All are
    safe to repeat: a batch overwrites only what it wrote itself.

    Folders of finished batches are folded: snapshots are put together, and of an upsert's rows the newest of each of
    its ``keys`` stays, if they are given.
    """
    check_modes(output_mode, table_mode)
    if table_mode == "append":
        return append_writer(stream, path, checkpoint)

    def newest(rows: DataFrame) -> DataFrame:
        return _newest_rows(rows, *keys)

    merge = {"snapshot": lambda rows: rows, "upsert": newest if keys else None}.get(table_mode)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch_id))
        if merge and batch_id % fold_every == 0:
            fold(batch.sparkSession, path, merge, fold_every)

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )


def newest_result(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete result of a refreshed table.

    A folder counts once its writer has marked it as complete. The driver sees folder names only.
    """
    whole = current_folders(spark, path)
    if not whole:
        raise FileNotFoundError(f"{path} holds no complete result yet")
    return spark.read.parquet(max(whole, key=lambda f: f.last).path)


def current_rows(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """An upsert table's newest row for each key, of complete batches only."""
    return latest_per_key(read_batches(spark, path), *keys)


def latest_per_key(changes: DataFrame, *keys: str) -> DataFrame:
    """The row of the newest batch for each key."""
    return _newest_rows(changes, *keys).drop("batch_id")


def _newest_rows(changes: DataFrame, *keys: str) -> DataFrame:
    others = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.col("batch_id")).alias("row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "row.*")


def fan_out(
    root: str, grains: Sequence[str] = ("day", "month", "quarter"), fold_every: int = FOLD_EVERY
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that feeds the signal table and all rollups from one read.

    The batch's parsed rows land in ``root/signals``. Its day totals are computed
    from that landed copy, so the source is read and parsed once, and are kept while
    the totals of each grain are derived from them. The timestamps of each day go to ``root/points`` as bitmaps. Every
    target takes the batch under its own ``batch_id``, which makes repeats harmless and leaves no
    state between batches; :func:`fanned_rollup` and :func:`fanned_datapoints` add up the batches.

    Signals with a ledger (:func:`~signalmill.functions.signals.parse_with_ledger`) also feed ``root/rejected``
    with the lines that have a rejected field, why, and the line itself; the signal table keeps the ledger as well.

    Every ``fold_every`` batches the totals of finished ones are added up into fewer folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = batch_path(f"{root}/signals", batch_id)
        batch.write.mode("overwrite").parquet(landed)
        signals = spark.read.schema(batch.schema).parquet(landed)
        if "reject_bits" in batch.columns:
            rejected_lines(signals).write.mode("overwrite").parquet(batch_path(f"{root}/rejected", batch_id))
        point_partials(signals).write.mode("overwrite").parquet(batch_path(f"{root}/points", batch_id))
        days = day_partials(signals).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for grain in grains:
                target = batch_path(f"{root}/{grain}", batch_id)
                coarser_partials(days, grain).write.mode("overwrite").parquet(target)
        finally:
            days.unpersist()
        if batch_id % fold_every == 0:
            fold_fanned(spark, root, grains, fold_every)

    return write


def fold_fanned(
    spark: SparkSession, root: str, grains: Sequence[str] = ("day", "month", "quarter"), every: int = FOLD_EVERY
) -> None:
    """Adds up the totals of finished batches that :func:`fan_out` has taken; signals stay as they are."""

    def folded(merge: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: merge(rows.drop("batch_id")).withColumn("batch_id", F.lit(None).cast("long"))

    for grain in grains:
        fold(spark, f"{root}/{grain}", folded(merge_days), every)
    fold(spark, f"{root}/points", folded(merge_points), every)


def fanned_rollup(
    spark: SparkSession, root: str, grain: str, style: str = "sum", by_year: bool = False
) -> DataFrame:
    """A rollup over all complete batches that :func:`fan_out` has taken."""
    return merge_partials(read_batches(spark, f"{root}/{grain}"), grain, style, by_year)


def fanned_datapoints(spark: SparkSession, root: str) -> DataFrame:
    """Distinct timestamps per day over all complete batches that :func:`fan_out` has taken."""
    return count_points(read_batches(spark, f"{root}/points"))

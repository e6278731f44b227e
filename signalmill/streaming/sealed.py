"""Streams by event time: windows that are cut into arrays once they have closed, and day totals of days that are open.

A table notes with every batch how far time has come. The watermark of a batch is the latest time of all earlier
batches less a delay, as in Spark's own stateful operators: rows of windows or days that ended before are late. They are not
lost, but kept in a table of their own. Time is read from the records and never from a clock. A batch depends on
its rows and the note of the batch before only, so it may be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from signalmill.operators.rollups import coarser_partials, day_partials, merge_days, merge_partials
from signalmill.operators.windows import MAX_ARRAY, cut_windows, sliding_rows, window_rows
from signalmill.streaming.batches import Folder, batch_path, delete_folders, fold, marked_folders, read_batches

_NOTE = "top long, open array<struct<batch: long, newest: long>>, done array<long>"


@dataclass
class _Note:
    """Latest time in microseconds; batches that hold open windows, with their newest end; batches that need not be kept."""

    top: int | None
    open: list[tuple[int, int]]
    done: list[int]

    def watermark(self, delay: int) -> int:
        return -(2**63) if self.top is None else self.top - delay


def _note_before(spark: SparkSession, root: str, batch_id: int) -> _Note:
    earlier = [f for f in marked_folders(spark, f"{root}/notes") if f.last < batch_id]
    if not earlier:
        return _Note(None, [], [])
    row = spark.read.schema(_NOTE).parquet(earlier[-1].path).first()
    delete_folders(spark, earlier[:-1])
    return _Note(row["top"], [(o["batch"], o["newest"]) for o in row["open"]], list(row["done"]))


def _note_down(spark: SparkSession, root: str, batch_id: int, note: _Note) -> None:
    row = spark.createDataFrame([(note.top, note.open, note.done)], _NOTE)
    row.coalesce(1).write.mode("overwrite").parquet(batch_path(f"{root}/notes", batch_id))


def _latest(a: int | None, b: int | None) -> int | None:
    return max((x for x in (a, b) if x is not None), default=None)


def _micros(df: DataFrame, time: str) -> Column:
    """Microseconds of a timestamp, with or without a zone."""
    kind = df.select(time).schema[0].dataType.simpleString()
    if kind == "timestamp":
        return F.unix_micros(F.col(time))
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01'"), F.col(time))


def _delay_micros(spark: SparkSession, delay: str) -> int:
    begin = "timestamp_ntz'2000-01-01'"
    return spark.sql(f"SELECT timestampdiff(MICROSECOND, {begin}, {begin} + INTERVAL {delay})").first()[0]


@dataclass(frozen=True)
class SealedWindows:
    """Sliding windows of a stream, collected into arrays as they close.

    Every batch lands the rows of its windows. Windows that its watermark has passed are then read from the landed
    batches, counted, and cut into parts of about ``max_array`` rows, so a hot window is spread over tasks by the size it
    turned out to have. No array is ever held as state, and no number of parts is set beforehand. Landed batches go once all of
    their windows have closed.

    ``time`` is a column of the records, or None for the time at which a batch is processed. Rows without a time are in no window.
    """

    root: str
    time: str | None
    length: str
    slide: str
    arrays: Mapping[str, str]
    number: str
    delay: str
    max_array: int = MAX_ARRAY
    deal: Column | None = None

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        if self.time is None:
            stream = stream.withColumn("_arrived", F.current_timestamp())
        return stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        spark, time = batch.sparkSession, self.time or "_arrived"
        note, delay = _note_before(spark, self.root, batch_id), _delay_micros(spark, self.delay)
        rows_root = f"{self.root}/rows"
        delete_folders(spark, [Folder(b, b, batch_path(rows_root, b)) for b in note.done])

        windows = sliding_rows(batch, time, self.length, self.slide)
        rows = window_rows(windows, dict(self.arrays), self.number, self.deal, F.col(time).alias("_time"))
        marked = rows.select("*", _micros(rows, "window.end").alias("_end"), _micros(rows, "_time").alias("_at")).drop("_time")
        marked.write.mode("overwrite").parquet(batch_path(rows_root, batch_id))
        landed = spark.read.schema(marked.schema).parquet(batch_path(rows_root, batch_id))
        top, newest = landed.agg(F.max("_at"), F.max("_end")).first()

        before = note.watermark(delay)
        note = _Note(_latest(note.top, top), [*note.open, *([(batch_id, newest)] if newest is not None else [])], [])
        now = note.watermark(delay)
        late = landed.where(F.col("_end") <= before).drop("_end", "_at", "_deal")
        late.write.mode("overwrite").parquet(batch_path(f"{self.root}/late", batch_id))

        kept = [batch_path(rows_root, b) for b, _ in note.open]
        closed = spark.read.schema(landed.schema).parquet(*kept) if kept else landed
        closed = closed.where((F.col("_end") > before) & (F.col("_end") <= now))
        sealed = cut_windows(closed, dict(self.arrays), self.number, self.max_array)
        sealed.write.mode("overwrite").parquet(batch_path(f"{self.root}/sealed", batch_id))
        still = [(b, end) for b, end in note.open if end > now]
        _note_down(spark, self.root, batch_id, _Note(note.top, still, [b for b, end in note.open if end <= now]))

    def sealed(self, spark: SparkSession) -> DataFrame:
        """Closed windows so far: window, part, arrays."""
        return read_batches(spark, f"{self.root}/sealed").drop("batch_id")

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that came after their window had closed, once per such window."""
        return read_batches(spark, f"{self.root}/late").drop("batch_id")


@dataclass(frozen=True)
class DayTotals:
    """Day totals of a signal stream whose state holds open days only.

    A batch adds its day totals to those of the open days. Days that the watermark has passed leave the state for the
    table of closed days, one row per day for good. Signals of days that were closed before are late and go to a table as they are.
    Signals without a date belong to no day and stay in the state, as one row.
    """

    root: str
    delay: str

    def writer(self, signals: DataFrame, checkpoint: str) -> DataStreamWriter:
        return signals.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note, delay = _note_before(spark, self.root, batch_id), _delay_micros(spark, self.delay)
        before = note.watermark(delay)
        path = batch_path(f"{self.root}/taken", batch_id)
        batch.withColumn("_at", _micros(batch, "signal_ts")).write.mode("overwrite").parquet(path)
        taken = spark.read.parquet(path)
        top = _latest(note.top, taken.agg(F.max("_at")).first()[0])
        now = _Note(top, [], []).watermark(delay)

        late = F.coalesce(_day_end() <= before, F.lit(False))
        taken.where(late).drop("_at").write.mode("overwrite").parquet(batch_path(f"{self.root}/late", batch_id))
        totals = day_partials(taken.where(~late))
        states = [f for f in marked_folders(spark, f"{self.root}/open") if f.last < batch_id]
        if states:
            totals = merge_days(spark.read.schema(totals.schema).parquet(states[-1].path).unionByName(totals))
        closes = F.coalesce(_day_end() <= now, F.lit(False))
        # the totals are landed once and then dealt to both tables
        both = batch_path(f"{self.root}/totals", batch_id)
        totals.write.mode("overwrite").parquet(both)
        totals = spark.read.schema(totals.schema).parquet(both)
        totals.where(~closes).write.mode("overwrite").parquet(batch_path(f"{self.root}/open", batch_id))
        totals.where(closes).write.mode("overwrite").parquet(batch_path(f"{self.root}/closed", batch_id))
        _note_down(spark, self.root, batch_id, _Note(top, [], []))
        passed = [f for t in ("taken", "totals") for f in marked_folders(spark, f"{self.root}/{t}") if f.last <= batch_id]
        delete_folders(spark, [*passed, *states[:-1]])

    def fold(self, spark: SparkSession, every: int) -> None:
        """Puts the closed days of finished batches into fewer folders."""
        fold(spark, f"{self.root}/closed", lambda days: days, every)

    def open_days(self, spark: SparkSession) -> DataFrame:
        """The state: totals of days that can still grow."""
        newest = marked_folders(spark, f"{self.root}/open")[-1:]
        return read_batches(spark, f"{self.root}/open", newest).drop("batch_id")

    def closed_days(self, spark: SparkSession) -> DataFrame:
        return read_batches(spark, f"{self.root}/closed").drop("batch_id")

    def late(self, spark: SparkSession) -> DataFrame:
        """Signals that came after their day had closed."""
        return read_batches(spark, f"{self.root}/late").drop("batch_id")

    def rollup(
        self, spark: SparkSession, grain: str, style: str = "sum", by_year: bool = False, with_late: bool = False
    ) -> DataFrame:
        """The rollup of all signals in time, and with the late ones if asked for."""
        days = self.closed_days(spark).unionByName(self.open_days(spark))
        if with_late:
            days = days.unionByName(day_partials(self.late(spark)))
        return merge_partials(coarser_partials(days, grain), grain, style, by_year)


def _day_end() -> Column:
    return F.timestamp_diff(
        "MICROSECOND", F.expr("timestamp_ntz'1970-01-01'"), F.date_add("signal_date", 1).cast("timestamp_ntz")
    )

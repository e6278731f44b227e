"""Windows sealed by event time and day totals with bounded state, over batches with late records and repeats."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalmill.functions.signals import parse_signals
from signalmill.operators.rollups import rollup
from signalmill.streaming.batches import marked_folders, read_batches
from signalmill.streaming.runner import run_available
from signalmill.streaming.sealed import DayTotals, SealedWindows

START = dt.datetime(2024, 1, 1)
ARRAYS = {"ids": "id", "names": "name"}


def at(second):
    return START + dt.timedelta(seconds=second)


def some_batches(seed, n=6):
    """Batches of (id, name, second): time moves on, some records are late, one batch is empty."""
    rng = random.Random(seed)
    made, number = [], 0
    for b in range(n):
        batch = []
        for _ in range(0 if b == 3 else rng.randint(5, 40)):
            batch.append((number, f"n{number % 4}", b * 10 + rng.choice([0, 1, 5, 9, 9, -3, -8, -25])))
            number += 1
        made.append(batch)
    return made


def brute(batches, delay, max_array):
    """Sealed windows with their parts, and late rows, by the rules that Spark's own watermark follows."""
    top, windows, late = None, {}, []
    for batch in batches:
        before = None if top is None else top - delay
        for i, name, second in batch:
            last = second // 2 * 2
            for begin in (last - 2, last):
                if before is not None and begin + 4 <= before:
                    late.append((at(begin), i))
                else:
                    windows.setdefault(begin, []).append((i, name))
        top = max([s for _, _, s in batch] + ([] if top is None else [top]), default=None)
    sealed = []
    for begin, members in windows.items():
        if begin + 4 <= top - delay:
            parts = -(-len(members) // max_array)
            for part in range(parts):
                chosen = sorted(m for m in members if m[0] % parts == part)
                if chosen:
                    sealed.append((at(begin), part, [i for i, _ in chosen], [n for _, n in chosen]))
    return sorted(sealed, key=repr), sorted(late, key=repr)


def batch_of(spark, records, kind="timestamp"):
    data = [(i, name, at(s)) for i, name, s in records]
    return spark.createDataFrame(data, f"id int, name string, ts {kind}")


@pytest.mark.parametrize(("kind", "max_array"), [("timestamp", 3), ("timestamp_ntz", 100)])
def test_closed_windows_hold_every_record_in_time(spark, where, kind, max_array):
    batches = some_batches(max_array)
    windows = SealedWindows(where("w"), "ts", "4 seconds", "2 seconds", ARRAYS, "id", "5 seconds", max_array, F.col("id"))
    for n, records in enumerate(batches):
        for _ in range(2 if n in (2, 5) else 1):  # a repeated batch changes nothing
            windows.take(batch_of(spark, records, kind), n)
    sealed, late = brute(batches, 5, max_array)
    found = windows.sealed(spark).select(F.col("window.start"), "part", "ids", "names")
    assert rows(found) == sealed and late
    assert rows(windows.late(spark).select("window.start", "id")) == late
    # landed batches whose windows have all closed are gone, but for those of the last batch's own closing
    assert len(marked_folders(spark, where("w/rows"))) < len(batches)
    assert len(marked_folders(spark, where("w/notes"))) <= 3


def test_a_window_is_sealed_once_and_not_before_it_has_closed(spark, where):
    windows = SealedWindows(where("w"), "ts", "4 seconds", "2 seconds", ARRAYS, "id", "5 seconds", 100, F.col("id"))
    windows.take(batch_of(spark, [(1, "a", 0), (2, "a", 8)]), 0)
    assert {r["window"]["end"] for r in windows.sealed(spark).collect()} == {at(2)}
    windows.take(batch_of(spark, [(3, "a", 1), (4, "a", 9)]), 1)
    assert {tuple(r["ids"]) for r in windows.sealed(spark).collect() if r["window"]["end"] == at(4)} == {(1, 3)}
    windows.take(batch_of(spark, [(5, "a", 1)]), 2)
    assert windows.sealed(spark).count() == 2 and windows.late(spark).count() == 3


def test_a_stream_by_processing_time(spark, where):
    """Records have no time of their own: those of a batch share the batch's time, and nothing is ever late."""
    windows = SealedWindows(where("w"), None, "4 seconds", "2 seconds", ARRAYS, "id", "0 seconds", 10)
    records = spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("name"))
    for part in (0, 1):
        records.where(F.col("id") % 2 == part).coalesce(1).write.mode("append").parquet(where("in"))
        stream = spark.readStream.schema(records.schema).parquet(where("in"))
        run_available(windows.writer(stream, where("c")))
    landed = read_batches(spark, where("w/rows"))
    assert landed.groupBy("id").count().where("count <> 2").count() == 0 and landed.count() == 200
    assert landed.select("_at").distinct().count() == 2
    later = spark.createDataFrame([(1000, "x", dt.datetime(2200, 1, 1))], "id int, name string, _arrived timestamp")
    windows.take(later, 2)
    sealed = windows.sealed(spark)
    assert sealed.select(F.explode("ids")).count() == 200 and sealed.agg(F.max(F.size("ids"))).first()[0] < 40
    assert windows.late(spark).count() == 0


def lines(batch):
    return [(f"{dt.date(2024, 1, 1) + dt.timedelta(days=d):%d %m %Y} {h:02d}:00,{v},{v},{v},1",) for d, h, v in batch] + [("bad,1,1,1,1",)]


def test_state_holds_open_days_only_and_late_signals_are_kept(spark, where):
    rng = random.Random(3)
    batches = [[(max(0, b - rng.choice([0, 0, 1, 3])), rng.randint(0, 23), rng.randint(1, 9) / 8) for _ in range(30)] for b in range(5)]
    totals = DayTotals(where("d"), "6 hours")
    for n, batch in enumerate(batches):
        for _ in range(2 if n == 3 else 1):
            totals.take(parse_signals(spark.createDataFrame(lines(batch), "value string")), n)
        assert totals.open_days(spark).count() <= 3  # two open days, and the row without a date
    whole = parse_signals(spark.createDataFrame([x for b in batches for x in lines(b)], "value string"))
    for grain in ("day", "month"):
        found = totals.rollup(spark, grain, "mixed", with_late=True)
        assert rows(found) == rows(rollup(whole, grain, "mixed"))
    late = totals.late(spark)
    in_time = totals.rollup(spark, "month")
    assert late.count() > 0
    assert in_time.agg(F.sum("count")).first()[0] + late.count() == whole.count()
    closed = totals.closed_days(spark)
    assert closed.count() == closed.select("signal_date").distinct().count() >= 3
    before = rows(totals.rollup(spark, "day"))
    totals.fold(spark, 3)
    assert rows(totals.rollup(spark, "day")) == before
    assert not marked_folders(spark, where("d/taken")) and len(marked_folders(spark, where("d/open"))) <= 2


def test_late_is_what_spark_drops(spark, where):
    """The same records through Spark's stateful operator give the same counts of closed days."""
    batches = [[(0, 1, 1), (1, 2, 1)], [(0, 3, 1), (2, 4, 1)], [(1, 5, 1), (0, 2, 1), (4, 1, 1)]]
    totals = DayTotals(where("d"), "12 hours")
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(lines(batch)[:-1], "value string")
        totals.take(parse_signals(df), n)
        df.coalesce(1).write.mode("append").parquet(where("in"))
        signals = parse_signals(spark.readStream.schema("value string").parquet(where("in")))
        timed = signals.withColumn("ts", F.col("signal_ts").cast("timestamp")).withWatermark("ts", "12 hours")
        counts = timed.groupBy(F.window("ts", "1 day")).count().select(F.col("window.start").cast("date").alias("day"), "count")
        query = counts.writeStream.format("parquet").option("path", where("out")).option("checkpointLocation", where("c"))
        run_available(query)
    spark_closed = rows(spark.read.parquet(where("out")))
    assert rows(totals.closed_days(spark).select("signal_date", "count")) == spark_closed and len(spark_closed) == 3

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalmill.operators.windows import (
    collect_windows,
    collect_windows_live,
    newest_first,
    sliding_rows,
)
from signalmill.streaming.runner import run_available
from signalmill.streaming.tables import append_writer

ARRAYS = {"ids": "id", "names": "name"}
START = dt.datetime(2024, 1, 1)


def at(second):
    return START + dt.timedelta(seconds=second)


@pytest.fixture
def events(spark):
    data = [(i, f"n{i % 3}", at(s)) for i, s in enumerate([0, 1, 1, 3, 5, 5, 20])]
    return spark.createDataFrame(data, "id int, name string, ts timestamp")


def brute(data, max_array):
    """Sliding windows of 4 s every 2 s, cut into parts."""
    windows = {}
    for i, name, ts in data:
        second = (ts - START).total_seconds()
        last = second // 2 * 2
        for begin in (last - 2, last):
            windows.setdefault(begin, []).append((i, name))
    result = []
    for begin, members in windows.items():
        parts = -(-len(members) // max_array)
        for part in range(parts):
            chosen = sorted(m for m in members if m[0] % parts == part)
            if chosen:
                result.append((at(begin), part, [i for i, _ in chosen], [n for _, n in chosen]))
    return sorted(result, key=repr)


def plain(windows):
    return rows(windows.select("window.start", "part", "ids", "names"))


@pytest.mark.parametrize("max_array", [1, 2, 3, 100])
def test_parts_hold_every_row_of_a_window(events, max_array):
    got = collect_windows(
        sliding_rows(events, "ts", "4 seconds", "2 seconds"), ARRAYS, "id", max_array, F.col("id")
    )
    assert plain(got) == brute([tuple(r) for r in events.collect()], max_array)


def test_windows_come_newest_first(events):
    got = newest_first(collect_windows(sliding_rows(events, "ts", "4 seconds", "2 seconds"), ARRAYS, "id"))
    starts = [r["window"]["start"] for r in got.collect()]
    assert starts == sorted(starts, reverse=True)


def test_a_hot_window_is_spread_over_bounded_arrays(spark):
    second = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    df = spark.range(0, 30_000, 1, 8).select(
        "id", F.lit("x").alias("name"), F.timestamp_seconds(second).alias("ts")
    )
    got = collect_windows(sliding_rows(df, "ts", "4 seconds", "2 seconds"), ARRAYS, "id", max_array=500)
    sizes = got.select(F.size("ids").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 700
    assert sizes.agg(F.sum("n")).first()[0] == 60_000


def test_live_windows_are_emitted_once_the_watermark_has_passed(spark, events, where):
    events.write.parquet(where("in"))
    stream = spark.readStream.schema(events.schema).parquet(where("in"))
    live = collect_windows_live(
        stream, "ts", "4 seconds", "2 seconds", ARRAYS, "id", watermark="5 seconds", parts=2, deal=F.col("id")
    )
    run_available(append_writer(live, where("out"), where("checkpoint")))
    got = plain(spark.read.parquet(where("out")))
    expected = []
    for begin, ids in ((-2, [0, 1, 2]), (0, [0, 1, 2, 3]), (2, [3, 4, 5]), (4, [4, 5])):
        for part in (0, 1):
            chosen = [i for i in ids if i % 2 == part]
            if chosen:
                expected.append((at(begin), part, chosen, [f"n{i % 3}" for i in chosen]))
    assert got == sorted(expected, key=repr)


def test_live_parts_must_be_positive(events):
    with pytest.raises(ValueError, match="at least one part"):
        collect_windows_live(events, "ts", "4 seconds", "2 seconds", ARRAYS, "id", "5 seconds", parts=0)

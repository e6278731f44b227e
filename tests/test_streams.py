import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalmill.functions.signals import parse_signals
from signalmill.operators.rollups import rollup
from signalmill.plans.signal_data import order_lines, order_signals, rounded
from signalmill.session import scratch_path, shuffle_partitions
from signalmill.sinks.sql_tables import check_modes
from signalmill.sources.files import table
from signalmill.streaming.runner import await_all, run_available, start, to_console
from signalmill.streaming.tables import (
    append_writer,
    fan_out,
    fanned_rollup,
    latest_per_key,
    newest_result,
    table_writer,
)


@pytest.fixture
def lines(spark, folder, where):
    """Order lines in four files, newest file last."""
    parts = order_lines(table(spark, folder, "orders")).repartition(4)
    parts.write.parquet(where("lines"))
    return where("lines")


def signals(spark, path, files=1):
    reader = spark.readStream.schema("value string").option("maxFilesPerTrigger", files)
    return parse_signals(reader.parquet(path))


@pytest.mark.parametrize("grain", ["day", "month", "quarter"])
@pytest.mark.parametrize("style", ["sum", "mixed"])
def test_complete_mode_over_several_batches_equals_batch(spark, folder, lines, where, grain, style):
    rolled = rollup(signals(spark, lines), grain, style)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    writer = table_writer(rolled, where("out"), where("c"), "complete", "refresh")
    query = run_available(writer, spark, state_partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert query.lastProgress["batchId"] == 3
    got = rounded(newest_result(spark, where("out")), style)
    assert rows(got) == rows(rounded(rollup(order_signals(spark, folder), grain, style), style))


def test_update_mode_gives_changes_whose_latest_rows_are_the_result(spark, folder, lines, where):
    rolled = rollup(signals(spark, lines), "month", ordered=False)
    run_available(table_writer(rolled, where("out"), where("c"), "update", "upsert"))
    changes = spark.read.parquet(where("out"))
    assert changes.count() > 12
    got = rounded(latest_per_key(changes, "month"), "sum")
    assert rows(got) == rows(rounded(rollup(order_signals(spark, folder), "month"), "sum"))


def test_snapshots_are_kept_apart(spark, lines, where):
    rolled = rollup(signals(spark, lines), "quarter")
    run_available(table_writer(rolled, where("out"), where("c"), "complete", "snapshot"))
    counts = spark.read.parquet(where("out")).groupBy("batch_id").agg(F.sum("count")).collect()
    totals = [r[1] for r in sorted(counts)]
    assert len(totals) == 4
    assert totals == sorted(totals)
    assert totals[-1] == 1500


def test_a_restart_takes_up_new_files_only(spark, folder, where):
    orders = table(spark, folder, "orders")
    for part in ("o_orderkey < 700", "o_orderkey >= 700"):
        order_lines(orders.where(part)).write.mode("append").parquet(where("lines"))
        stream = signals(spark, where("lines"))
        run_available(append_writer(stream, where("out"), where("c")))
    assert spark.read.parquet(where("out")).count() == 1500


def test_a_repeated_batch_changes_nothing(spark, where):
    one = parse_signals(spark.createDataFrame([("01 01 2018 01:00,1,2,3,4",)], "value string"))
    two = parse_signals(spark.createDataFrame([("02 05 2018 01:00,1,2,3,4",)], "value string"))
    write = fan_out(where("fan"))
    for batch, batch_id in ((one, 0), (two, 1), (two, 1)):
        write(batch, batch_id)
    assert spark.read.parquet(where("fan/signals")).count() == 2
    for grain in ("day", "month", "quarter"):
        assert [r["count"] for r in fanned_rollup(spark, where("fan"), grain).collect()] == [1, 1]


@pytest.mark.parametrize("style", ["sum", "mixed"])
def test_fan_out_over_several_batches_equals_batch(spark, folder, lines, where, style):
    writer = signals(spark, lines).writeStream.foreachBatch(fan_out(where("fan")))
    run_available(writer.option("checkpointLocation", where("c")))
    for grain in ("day", "month", "quarter"):
        got = rounded(fanned_rollup(spark, where("fan"), grain, style), style)
        assert rows(got) == rows(rounded(rollup(order_signals(spark, folder), grain, style), style))
    assert not spark.sparkContext._jsc.getPersistentRDDs()


@pytest.mark.parametrize(
    ("output_mode", "table_mode"),
    [("append", "refresh"), ("update", "refresh"), ("complete", "append"), ("complete", "upsert"),
     ("update", "append"), ("update", "snapshot"), ("append", "merge")],
)
def test_lossy_pairs_of_modes_are_refused(spark, where, output_mode, table_mode):
    with pytest.raises(ValueError, match="mode"):
        check_modes(output_mode, table_mode)
    with pytest.raises(ValueError, match="mode"):
        table_writer(spark.range(1), where("x"), where("c"), output_mode, table_mode)


def test_late_rows_are_dropped_by_the_watermark(spark, where):
    def land(name, *seconds):
        times = spark.createDataFrame([(s,) for s in seconds], "s long")
        times.select(F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(where(name))

    def run():
        stream = spark.readStream.schema("ts timestamp").parquet(where("in"))
        counts = stream.withWatermark("ts", "5 seconds").groupBy(F.window("ts", "10 seconds")).count()
        rows_out = counts.select("window.start", "count")
        run_available(append_writer(rows_out, where("out"), where("c")))

    land("in", 1, 2, 31)
    run()
    land("in", 3, 55)
    run()
    got = {r["start"].timestamp(): r["count"] for r in spark.read.parquet(where("out")).collect()}
    assert sorted(got.values()) == [1, 2]


def test_long_running_streams_are_awaited_and_failures_raised(spark, lines, where):
    spark.streams.resetTerminated()
    bad = signals(spark, lines).select(F.raise_error(F.lit("boom")).cast("string").alias("v"))
    start(append_writer(bad, where("bad"), where("bad-c")), every="1 second")
    with pytest.raises(Exception, match="boom"):
        await_all(spark)
    spark.streams.resetTerminated()
    await_all(spark)


def test_console(spark, lines, where, capfd):
    run_available(to_console(signals(spark, lines, 4).limit(1), "append", where("c")))


def test_state_partitions_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), shuffle_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_folders_lie_in_the_shared_folder_and_differ(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert os.path.dirname(a) == shared


def test_a_reader_meets_whole_results_only(spark, where):
    spark.range(3).write.parquet(where("t/batch_id=9"))
    spark.range(5).write.parquet(where("t/batch_id=10"))
    os.makedirs(where("t/batch_id=11"))  # a result that is being written
    assert newest_result(spark, where("t")).count() == 5
    with pytest.raises(FileNotFoundError):
        os.makedirs(where("u"))
        newest_result(spark, where("u"))


def test_scratch_folders_are_cleaned_on_request(spark, monkeypatch):
    from signalmill import session

    monkeypatch.setattr(session, "_handed_out", [])
    used, unused = scratch_path(spark, "used"), scratch_path(spark, "unused")
    spark.range(1).write.parquet(used)
    assert session.clean_scratch(spark) == 1
    assert not os.path.exists(used) and not os.path.exists(unused)

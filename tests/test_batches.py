"""Folding of batch folders: the same rows before, during and after, and few folders."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalmill.functions.signals import parse_signals
from signalmill.operators.rollups import datapoints_per_day, rollup
from signalmill.streaming import batches
from signalmill.streaming.batches import batch_path, current_folders, fold, marked_folders, read_batches
from signalmill.streaming.runner import run_available
from signalmill.streaming.tables import current_rows, fan_out, fanned_datapoints, fanned_rollup, newest_result, table_writer


def write(spark, root, n, data):
    spark.createDataFrame(data, "k string, n long").write.mode("overwrite").parquet(batch_path(root, n))


def totals(spark, root):
    return rows(read_batches(spark, root).groupBy("k").agg(F.sum("n")))


def added(df):
    return df.groupBy("k").agg(F.sum("n").alias("n")).withColumn("batch_id", F.lit(None).cast("long"))


def test_tiers(spark, where):
    for n in range(30):
        write(spark, where("t"), n, [("a", n), (f"k{n % 2}", 1)])
        if n % 3 == 0:
            before = totals(spark, where("t"))
            fold(spark, where("t"), added, 3)
            assert totals(spark, where("t")) == before
            assert len(current_folders(spark, where("t"))) <= 10
            assert len(marked_folders(spark, where("t"))) <= 20
    assert {(f.first, f.last) for f in current_folders(spark, where("t"))} >= {(0, 26)}
    assert dict(totals(spark, where("t"))) == {"a": sum(range(30)), "k0": 15, "k1": 15}


def test_a_half_written_fold_or_batch_is_not_read(spark, where):
    for n in range(4):
        write(spark, where("t"), n, [("a", n)])
    os.makedirs(where("t/batches=0-2"))
    os.makedirs(where("t/batch_id=4"))
    assert totals(spark, where("t")) == [("a", 6)]
    fold(spark, where("t"), added, 3)  # a new attempt overwrites it
    assert totals(spark, where("t")) == [("a", 6)]
    assert {(f.first, f.last) for f in current_folders(spark, where("t"))} == {(0, 2), (3, 3)}


def test_readers_of_the_old_folders_are_not_cut_off(spark, where):
    for n in range(4):
        write(spark, where("t"), n, [("a", n)])
    reader = read_batches(spark, where("t"))
    fold(spark, where("t"), added, 3)
    assert reader.agg(F.sum("n")).first()[0] == 6
    fold(spark, where("t"), added, 3)  # now they go
    assert {(f.first, f.last) for f in marked_folders(spark, where("t"))} == {(0, 2), (3, 3)}


def test_a_fold_that_fails_changes_nothing(spark, where):
    for n in range(5):
        write(spark, where("t"), n, [("a", n)])
    with pytest.raises(Exception, match="boom"):
        fold(spark, where("t"), lambda df: df.withColumn("k", F.raise_error(F.lit("boom"))), 2)
    assert totals(spark, where("t")) == [("a", 10)]


def test_the_newest_batch_may_be_repeated(spark, where):
    for n in range(4):
        write(spark, where("t"), n, [("a", n)])
    fold(spark, where("t"), added, 2)
    write(spark, where("t"), 3, [("a", 30)])
    assert totals(spark, where("t")) == [("a", 33)]


def test_bad_arguments_and_missing_tables(spark, where):
    with pytest.raises(ValueError):
        fold(spark, where("t"), added, 1)
    with pytest.raises(FileNotFoundError):
        read_batches(spark, where("t"))
    assert fold(spark, where("t"), added, 2) == [] == batches.current_folders(spark, where("t"))


def some_signals(spark, n):
    data = [(f"{d:02d} 01 2024 {h:02d}:{n % 3:02d}{':30' if h % 5 == 0 else ''},{h / 7},{d},{n},1",) for d in range(1, 8) for h in range(24)]
    return parse_signals(spark.createDataFrame(data, "value string"))


def test_fan_out_folds_its_totals(spark, where):
    write_batch = fan_out(where("f"), fold_every=2)
    whole = None
    for n in range(5):
        one = some_signals(spark, n)
        whole = one if whole is None else whole.unionByName(one)
        for _ in range(2 if n == 4 else 1):
            write_batch(one, n)
    for grain in ("day", "month", "quarter"):
        assert rows(fanned_rollup(spark, where("f"), grain, "mixed")) == rows(rollup(whole, grain, "mixed"))
        assert len(current_folders(spark, where(f"f/{grain}"))) < 5
    assert rows(fanned_datapoints(spark, where("f"))) == rows(datapoints_per_day(whole))


def counted_stream(spark, where):
    stream = spark.readStream.schema("k string").option("maxFilesPerTrigger", 1).parquet(where("in"))
    return stream.groupBy("k").agg(F.count("*").alias("n"))


@pytest.fixture
def seven_files(spark, where):
    for n in range(7):
        spark.createDataFrame([("a",), (f"k{n}",)], "k string").coalesce(1).write.mode("append").parquet(where("in"))


def test_upserts_are_folded_to_the_newest_rows(spark, where, seven_files):
    writer = table_writer(counted_stream(spark, where), where("out"), where("c"), "update", "upsert", ["k"], fold_every=2)
    run_available(writer, spark, 2)
    found = {r["k"]: r["n"] for r in current_rows(spark, where("out"), "k").collect()}
    assert found == {"a": 7} | {f"k{n}": 1 for n in range(7)}
    assert any(f.folded for f in current_folders(spark, where("out")))


def test_snapshots_keep_their_numbers(spark, where, seven_files):
    writer = table_writer(counted_stream(spark, where), where("out"), where("c"), "complete", "snapshot", fold_every=2)
    run_available(writer, spark, 2)
    sums = read_batches(spark, where("out")).groupBy("batch_id").agg(F.sum("n"))
    assert rows(sums) == [(n, 2 * (n + 1)) for n in range(7)]
    assert len(current_folders(spark, where("out"))) < 7
    assert newest_result(spark, where("out")).agg(F.sum("n")).first()[0] == 14

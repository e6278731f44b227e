import time
import uuid

import pytest
from conftest import rows

from signalmill.functions.signals import parse_signals
from signalmill.operators.rollups import rollup
from signalmill.plans.signal_data import order_lines, order_signals, rounded
from signalmill.plans.sql_table_plans import database
from signalmill.sinks import sql_tables as K
from signalmill.sources.files import read_csv, table
from signalmill.sources.sql_tables import Database, read_sql_table
from signalmill.streaming.runner import run_available


@pytest.fixture
def db():
    return Database(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, v double")


def test_append_twice_is_append_once(spark, db):
    for batch_id, batch in ((0, frame(spark, (1, 1.0))), (1, frame(spark, (1, 1.0), (2, 2.0)))):
        for _ in range(2):
            K.apply_batch(batch, batch_id, db, "t", "append")
    found = read_sql_table(spark, db, "t")
    assert rows(found.select("k", "v", "batch_id")) == [(1, 1.0, 0), (1, 1.0, 1), (2, 2.0, 1)]
    assert found.select("batch_id", "row_id").distinct().count() == 3


def test_refresh_replaces_all(spark, db):
    K.apply_batch(frame(spark, (1, 1.0), (2, 2.0)), 0, db, "t", "refresh")
    K.apply_batch(frame(spark, (3, 3.0)), 1, db, "t", "refresh")
    assert rows(read_sql_table(spark, db, "t")) == [(3, 3.0)]


def test_upsert_replaces_by_key_null_included(spark, db):
    K.apply_batch(frame(spark, (1, 1.0), (2, 2.0), (None, 3.0)), 0, db, "t", "upsert", ["k"])
    for _ in range(2):
        K.apply_batch(frame(spark, (2, 5.0), (4, 6.0), (None, 7.0)), 1, db, "t", "upsert", ["k"])
    assert rows(read_sql_table(spark, db, "t")) == [(1, 1.0), (2, 5.0), (4, 6.0), (None, 7.0)]


def test_upsert_by_two_keys(spark, db):
    def batch(*data):
        return spark.createDataFrame(list(data), "y int, k int, v double")

    K.apply_batch(
        batch((1, 1, 1.0), (1, None, 2.0), (None, None, 3.0), (2, 1, 4.0)),
        0, db, "t", "upsert", ["y", "k"],
    )
    K.apply_batch(batch((1, None, 5.0), (2, 1, 6.0)), 1, db, "t", "upsert", ["y", "k"])
    got = rows(read_sql_table(spark, db, "t"))
    assert got == [(1, 1, 1.0), (1, None, 5.0), (2, 1, 6.0), (None, None, 3.0)]


def test_moving_many_rows_takes_one_pass(spark, db):
    data = spark.range(0, 60_000, 1, 6).selectExpr("cast(id AS int) AS k", "1.0D AS v")
    begun = time.time()
    K.write_sql_table(data, db, "t")
    assert read_sql_table(spark, db, "t", split_by="k").count() == 60_000
    assert time.time() - begun < 60


def test_upsert_needs_keys(spark, db):
    with pytest.raises(ValueError, match="key"):
        K.batch_sink(db, "t", "update", "upsert")
    with pytest.raises(ValueError, match="key"):
        K.apply_batch(frame(spark), 0, db, "t", "upsert")


def test_lossy_modes_are_refused(db):
    with pytest.raises(ValueError, match="lose or repeat"):
        K.batch_sink(db, "t", "append", "refresh")
    with pytest.raises(ValueError, match="lose or repeat"):
        K.batch_sink(db, "t", "update", "refresh")


def test_rows_of_a_repeated_task_are_moved_once(spark, db):
    """A task whose executor is lost after its commit leaves its rows in the stage twice."""
    tagged = K._with_attempt(frame(spark, (1, 1.0), (1, 1.0), (2, 2.0)).coalesce(1))
    again = tagged.withColumn("task_attempt", tagged["task_attempt"] + 1)
    staged = tagged.union(again)
    original = K._with_attempt
    K._with_attempt = lambda df: staged
    try:
        K.write_sql_table(frame(spark, (0, 0.0)), db, "t")
    finally:
        K._with_attempt = original
    assert rows(read_sql_table(spark, db, "t")) == [(1, 1.0), (1, 1.0), (2, 2.0)]


def test_a_failed_move_leaves_the_table_as_it_was(spark, db):
    K.write_sql_table(frame(spark, (1, 1.0)), db, "t")
    with pytest.raises(Exception, match="NO_SUCH"):
        K._transaction(spark, db, ["DELETE FROM t", "INSERT INTO t SELECT * FROM no_such"])
    assert rows(read_sql_table(spark, db, "t")) == [(1, 1.0)]


def test_partitioned_read(spark, db):
    data = spark.range(0, 100).selectExpr("cast(id AS int) AS k", "cast(id AS double) AS v")
    K.write_sql_table(data, Database(db.url, connections=3), "t")
    found = read_sql_table(spark, db, "t", split_by="k", partitions=4)
    assert found.rdd.getNumPartitions() == 4
    assert rows(found) == rows(data)
    assert read_sql_table(spark, db, "t").rdd.getNumPartitions() == 1


def test_partitioned_read_of_an_empty_and_of_a_one_value_table(spark, db):
    K.write_sql_table(frame(spark, (1, 1.0)).limit(0), db, "e")
    assert read_sql_table(spark, db, "e", split_by="k").count() == 0
    K.write_sql_table(frame(spark, (1, 1.0), (1, 2.0)), db, "o")
    assert read_sql_table(spark, db, "o", split_by="k").count() == 2


def test_partitioned_read_keeps_null_keys(spark, db):
    K.write_sql_table(frame(spark, (1, 1.0), (9, 2.0), (None, 3.0)), db, "t")
    assert read_sql_table(spark, db, "t", split_by="k", partitions=2).count() == 3


def test_export(spark, db, where):
    K.write_sql_table(frame(spark, (1, 1.5), (2, None)), db, "t")
    K.export_csv(spark, db, "t", where("csv"))
    K.write_sql_table(frame(spark), db, "t")
    K.export_csv(spark, db, "t", where("csv"), mode="ignore")
    assert rows(read_csv(spark, where("csv"), schema="k int, v double")) == [(1, 1.5), (2, None)]


@pytest.mark.parametrize(
    ("output_mode", "table_mode"), [("complete", "refresh"), ("update", "upsert")]
)
def test_rollup_stream_in_several_batches(spark, folder, where, db, output_mode, table_mode):
    order_lines(table(spark, folder, "orders")).repartition(3).write.parquet(where("lines"))
    reader = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1)
    stream = parse_signals(reader.parquet(where("lines")))
    rolled = rollup(stream, "month", ordered=output_mode == "complete")
    sink = K.batch_sink(db, "months", output_mode, table_mode, ["month"])
    writer = rolled.writeStream.foreachBatch(sink).outputMode(output_mode)
    run_available(writer.option("checkpointLocation", where("c")))
    got = rounded(read_sql_table(spark, db, "months"), "sum")
    assert rows(got) == rows(rounded(rollup(order_signals(spark, folder), "month"), "sum"))


def test_database_settings(spark, set_conf):
    set_conf("spark.signalmill.jdbc.url", "jdbc:somewhere")
    set_conf("spark.signalmill.jdbc.user", "u")
    db = database(spark)
    assert (db.url, db.properties) == ("jdbc:somewhere", {"user": "u"})
    assert "properties" not in repr(db)

import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalmill.sinks import topics as K
from signalmill.sources import topics as S
from signalmill.sources.capabilities import MissingConnector, has_format
from signalmill.sources.topics import Topic
from signalmill.streaming.runner import replay_then_follow, run_available, skip_present
from signalmill.streaming.tables import append_writer, landing_writer


READING_DDL = "sensor long, at timestamp, value double"
READING_AVRO = json.dumps({"type": "record", "name": "Reading", "fields": [
    {"name": "sensor", "type": "long"}, {"name": "at", "type": {"type": "long", "logicalType": "timestamp-micros"}},
    {"name": "value", "type": ["null", "double"]}]})


@pytest.fixture
def topic(where):
    return Topic("t", "csv", path=where("topic"))


@pytest.fixture
def kafka():
    return Topic("t", "csv", servers="nowhere:9092")


def test_a_topic_has_one_format_and_one_place():
    with pytest.raises(ValueError, match="payload"):
        Topic("t", "xml", path="p")
    with pytest.raises(ValueError, match="either"):
        Topic("t", "csv")
    with pytest.raises(ValueError, match="either"):
        Topic("t", "csv", servers="s", path="p")


def test_lines_of_rows(spark, topic):
    df = spark.createDataFrame([(1, None, 2.5), (2, "b", None)], "a int, b string, c double")
    K.append_to_topic(K.csv_records(df), topic)
    assert rows(S.text_values(S.read_topic(spark, topic))) == [("1,null,2.5",), ("2,b,null",)]
    record = S.read_topic(spark, topic).first()
    assert record["topic"] == "t"
    assert bytes(record["value"]) in (b"1,null,2.5", b"2,b,null")
    assert record["timestamp"] is not None


def test_json_leaves_out_null_and_bad_records_give_null(spark, where):
    topic = Topic("t", "json", path=where("topic"))
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5), None), (2, None, 0.5)], READING_DDL)
    K.append_to_topic(K.json_records(df), topic)
    K.append_to_topic(spark.createDataFrame([("{oops",)], "value string"), topic)
    texts = [r["value"] for r in S.text_values(S.read_topic(spark, topic)).collect()]
    assert sorted(texts) == ['{"sensor":1,"at":"2024-01-01T05:00:00.000Z"}', '{"sensor":2,"value":0.5}', "{oops"]
    data = S.json_values(S.read_topic(spark, topic), READING_DDL).select("data.*")
    assert rows(data) == [(1, dt.datetime(2024, 1, 1, 5), None), (2, None, 0.5), (None, None, None)]


def test_signals_are_not_read_from_a_topic_of_another_format(spark, where):
    with pytest.raises(ValueError, match="carries json"):
        S.signals_of(Topic("t", "json", path=where("t")), spark.range(0))


def test_relay_in_several_batches_keeps_keys_and_loses_nothing(spark, topic, where):
    df = spark.range(0, 1000, 1, 5).select(
        F.encode(F.col("id").cast("string"), "utf-8").alias("key"),
        F.concat(F.lit("v"), "id").alias("value"),
    )
    K.append_to_topic(df, topic)
    target = Topic("u", "csv", path=where("target"))
    stream = S.stream_topic(spark, topic, max_files_per_trigger=2)
    query = run_available(K.topic_writer(stream, target, where("checkpoint")))
    assert query.lastProgress["batchId"] >= 2
    got = S.read_topic(spark, target)
    assert got.count() == 1000
    assert got.where("topic = 'u' AND 'v' || cast(key AS string) = cast(value AS string)").count() == 1000


def test_starting_points(spark, topic, where):
    def append(text):
        K.append_to_topic(spark.createDataFrame([(text,)], "value string"), topic)

    def seen(stream, name):
        run_available(append_writer(S.text_values(stream), where(name), where(name + "-c")))
        return rows(spark.read.parquet(where(name)))

    append("old")
    end = S.read_topic(spark, topic).agg(F.max("timestamp")).first()[0]
    skip_present(S.stream_topic(spark, topic), where("b-c"))
    append("new")
    assert seen(S.stream_topic(spark, topic), "a") == [("new",), ("old",)]
    live = landing_writer(S.text_values(S.stream_topic(spark, topic)), where("b"))
    run_available(live.option("checkpointLocation", where("b-c")))
    assert rows(spark.read.parquet(where("b")).select("value")) == [("new",)]
    assert seen(S.stream_topic(spark, topic, starting=end), "c") == [("new",)]
    for start in ("5", "latest"):
        with pytest.raises(ValueError, match="cannot start"):
            S.stream_topic(spark, topic, starting=start)


def test_a_batch_that_began_before_the_replay_is_seen_once(spark, topic, where):
    """Its records are older than the replay's end, and land after it."""

    def append(text, second):
        when = F.timestamp_seconds(F.lit(second))
        record = spark.range(1).select(F.lit(None).cast("binary").alias("key"), F.encode(F.lit(text), "utf-8").alias("value"), F.lit("t").alias("topic"), when.alias("timestamp"))
        record.write.mode("append").parquet(topic.path)

    def writer(name):
        texts = S.text_values(S.stream_topic(spark, topic))
        return landing_writer(texts, where(name))

    append("first", 1000)
    replay = writer("replayed")
    run_available(replay.option("checkpointLocation", where("c")))
    append("late", 10)
    append("new", 2000)
    replay_then_follow(writer("more"), writer("live"), where("c"), every=None)
    assert rows(spark.read.parquet(where("replayed")).select("value")) == [("first",)]
    assert rows(spark.read.parquet(where("more")).select("value")) == [("late",), ("new",)]


def test_vanished_records_raise_unless_tolerated(spark, topic):
    K.append_to_topic(spark.range(100).repartition(4).select(F.col("id").cast("string").alias("value")), topic)
    strict, tolerant = S.read_topic(spark, topic), S.read_topic(spark, topic, fail_on_data_loss=False)
    assert strict.count() == tolerant.count() == 100
    next(Path(topic.path).glob("part-*.parquet")).unlink()
    assert tolerant.count() == 75
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FAILED_READ_FILE|does not exist"):
        strict.count()


def test_kafka_offsets_that_continue_after_a_batch(spark):
    batch = spark.createDataFrame(
        [("t", 0, 5), ("t", 0, 9), ("t", 1, 2)], "topic string, partition int, offset long"
    )
    assert json.loads(S.offsets_after(batch)) == {"t": {"0": 10, "1": 3}}


def test_kafka_settings_without_prefix_are_refused():
    assert S.kafka_options({"kafka.group.id": "g", "maxOffsetsPerTrigger": "9"})
    with pytest.raises(ValueError, match="group.id"):
        S.kafka_options({"group.id": "g"})


def test_kafka_is_named_when_absent(spark, kafka, where):
    if has_format(spark, "kafka"):
        pytest.skip("kafka is installed")
    records = spark.createDataFrame([("v",)], "value string")
    for use in (
        lambda: S.read_topic(spark, kafka),
        lambda: S.stream_topic(spark, kafka, dt.datetime(2024, 1, 1)),
        lambda: K.append_to_topic(records, kafka),
        lambda: K.topic_writer(records, kafka, where("c")),
    ):
        with pytest.raises(MissingConnector, match="spark-sql-kafka"):
            use()


def test_avro_is_named_when_absent(spark):
    if has_format(spark, "avro"):
        df = spark.createDataFrame([(7, dt.datetime(2024, 1, 1, 5), 0.5)], READING_DDL)
        data = S.avro_values(spark, K.avro_records(df, READING_AVRO), READING_AVRO)
        assert rows(data.select("data.*")) == rows(df)
    else:
        with pytest.raises(MissingConnector, match="spark-avro"):
            K.avro_records(spark.range(1), READING_AVRO)
        with pytest.raises(MissingConnector, match="spark-avro"):
            S.avro_values(spark, spark.range(1), READING_AVRO)

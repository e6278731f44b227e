"""Message topics as batch tables and streams.

A topic is a Kafka topic or a directory of Parquet files that holds the same
record: ``key``, ``value``, ``topic``, ``timestamp``. Readers differ only in the
format they open; what follows uses ``value``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro

from signalmill.functions.signals import parse_signals
from signalmill.sources.capabilities import require_format

RECORD_DDL = "key binary, value binary, topic string, timestamp timestamp"
PAYLOADS = ("csv", "json", "avro")


@dataclass(frozen=True)
class Topic:
    """A topic's name, the one payload format it carries, and where it lives.

    Give ``servers`` for Kafka or ``path`` for a directory.
    """

    name: str
    payload: str
    servers: str | None = None
    path: str | None = None

    def __post_init__(self) -> None:
        if self.payload not in PAYLOADS:
            raise ValueError(f"payload {self.payload!r} is none of {PAYLOADS}")
        if (self.servers is None) == (self.path is None):
            raise ValueError("give either servers or path")

    @property
    def is_kafka(self) -> bool:
        return self.servers is not None


def read_topic(
    spark: SparkSession,
    topic: Topic,
    fail_on_data_loss: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The whole log of a topic, as a batch.

    Records that vanish while it is read raise an error, unless ``fail_on_data_loss`` is off.
    """
    if topic.is_kafka:
        return _kafka(spark.read, spark, topic, "earliest", fail_on_data_loss, options).load()
    reader = spark.read.schema(RECORD_DDL).option("ignoreMissingFiles", not fail_on_data_loss)
    return reader.parquet(topic.path)


def stream_topic(
    spark: SparkSession,
    topic: Topic,
    starting: str | datetime = "earliest",
    fail_on_data_loss: bool = True,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream from its start, or from the records of an instant on.

    Kafka may also start at its present end (``latest``) or at an offset map, given as its JSON
    text. It uses the start only for a stream without a checkpoint. A directory's start is
    a condition on the record time; pass the same instant when resuming.

    Record times are set where a batch begins, so they do not tell what has been seen. To start
    at a topic's present end, or to go on after a replay, use one checkpoint: see
    :func:`signalmill.streaming.runner.skip_present` and :func:`replay_then_follow`.
    Records that vanish raise an error, unless ``fail_on_data_loss`` is off.
    """
    if topic.is_kafka:
        return _kafka(spark.readStream, spark, topic, starting, fail_on_data_loss, options).load()
    reader = spark.readStream.schema(RECORD_DDL).option("ignoreMissingFiles", not fail_on_data_loss)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(topic.path)
    if starting == "earliest":
        return stream
    if not isinstance(starting, datetime):
        raise ValueError(f"a directory topic cannot start at {starting!r}; skip_present() leaves out what is there")
    return stream.where(F.col("timestamp") > F.lit(starting))


def offsets_after(batch: DataFrame) -> str:
    """Kafka starting offsets that continue after a batch read of a topic.

    One row per topic partition reaches the driver.
    """
    ends = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))
    offsets: dict[str, dict[str, int]] = {}
    for row in ends.collect():
        offsets.setdefault(row["topic"], {})[str(row["partition"])] = row["next"]
    return json.dumps(offsets)


def text_values(records: DataFrame) -> DataFrame:
    """Record values decoded as text."""
    return records.select(F.col("value").cast("string").alias("value"))


def json_values(records: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """JSON values as a struct column ``data``; a bad record gives NULL fields."""
    return records.select(F.from_json(F.col(value).cast("string"), ddl).alias("data"))


def avro_values(spark: SparkSession, records: DataFrame, avro_schema: str) -> DataFrame:
    """Avro values as a struct column ``data``."""
    require_format(spark, "avro")
    return records.select(from_avro(F.col("value"), avro_schema).alias("data"))


def signals_of(topic: Topic, records: DataFrame) -> DataFrame:
    """Parsed signals of a topic that carries signal lines."""
    if topic.payload != "csv":
        raise ValueError(f"topic {topic.name!r} carries {topic.payload}, not signal lines")
    return parse_signals(records)


def _kafka(reader, spark: SparkSession, topic: Topic, starting, fail_on_data_loss, options):
    require_format(spark, "kafka")
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers)
        .option("subscribe", topic.name)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**kafka_options(options or {}))
    )
    if isinstance(starting, datetime):
        return reader.option("startingTimestamp", str(int(starting.timestamp() * 1000)))
    return reader.option("startingOffsets", starting)


def kafka_options(options: dict[str, str]) -> dict[str, str]:
    """Rejects client settings that lack the ``kafka.`` prefix and would be ignored."""
    bare = sorted(k for k in options if "." in k and not k.startswith("kafka."))
    if bare:
        raise ValueError(f"Kafka client settings need the prefix 'kafka.': {bare}")
    return options

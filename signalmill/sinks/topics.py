"""Writing rows to topics, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import to_avro
from pyspark.sql.streaming import DataStreamWriter

from signalmill.functions.signals import csv_line
from signalmill.sources.capabilities import require_format
from signalmill.sources.topics import RECORD_DDL, Topic


def csv_records(df: DataFrame, *columns: str | Column) -> DataFrame:
    """One comma-joined line per row."""
    return df.select(csv_line(columns or df.columns).alias("value"))


def json_records(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON object per row; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def avro_records(df: DataFrame, avro_schema: str) -> DataFrame:
    """One Avro record per row."""
    require_format(df.sparkSession, "avro")
    return df.select(to_avro(F.struct(*df.columns), avro_schema).alias("value"))


def append_to_topic(records: DataFrame, topic: Topic) -> None:
    """Appends a batch of records."""
    if topic.is_kafka:
        require_format(records.sparkSession, "kafka")
        records = _kafka_record(records)
        records.write.format("kafka").options(**_kafka_target(topic)).save()
    else:
        _stored_record(records, topic).write.mode("append").parquet(topic.path)


def topic_writer(records: DataFrame, topic: Topic, checkpoint: str) -> DataStreamWriter:
    """A writer that appends a stream of records; start it to run."""
    if topic.is_kafka:
        require_format(records.sparkSession, "kafka")
        writer = _kafka_record(records).writeStream.format("kafka").options(**_kafka_target(topic))
    else:
        writer = _stored_record(records, topic).writeStream.format("parquet")
        writer = writer.option("path", topic.path)
    return writer.outputMode("append").option("checkpointLocation", checkpoint)


def _kafka_target(topic: Topic) -> dict[str, str]:
    return {"kafka.bootstrap.servers": topic.servers, "topic": topic.name}


def _kafka_record(records: DataFrame) -> DataFrame:
    return records.select([c for c in ("key", "value") if c in records.columns])


def _stored_record(records: DataFrame, topic: Topic) -> DataFrame:
    made = {
        "key": F.col("key") if "key" in records.columns else F.lit(None),
        "value": F.col("value"),
        "topic": F.lit(topic.name),
        "timestamp": F.current_timestamp(),
    }
    fields = [f.strip().split(" ") for f in RECORD_DDL.split(",")]
    return records.select(*[made[name].cast(kind).alias(name) for name, kind in fields])

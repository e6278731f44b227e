"""Topics: encoding, replay, streaming, relay and ingest.

Each query first fills a topic with every row of a table. Directory topics are
used, which need no broker; a Kafka topic differs in the ``Topic`` only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from signalmill.functions.signals import load_stamped, map_form, typed_lines
from signalmill.plans.catalogue import Catalogue
from signalmill.plans.signal_data import (
    EVENT_SIGNALS,
    comparable,
    event_lines,
    event_signal_stream,
    event_values,
)
from signalmill.schemas import SIGNALS, TYPED_SIGNAL_DDL, WRITE_TIME_PATTERN
from signalmill.session import scratch_path
from signalmill.sinks.files import write_csv
from signalmill.sinks.topics import append_to_topic, csv_records, json_records, topic_writer
from signalmill.sources.files import read_table, stream_csv, table
from signalmill.sources.topics import (
    Topic,
    json_values,
    read_topic,
    signals_of,
    stream_topic,
    text_values,
)
from signalmill.streaming.runner import run_available, skip_present
from signalmill.streaming.tables import append_writer, landing_writer

CATALOGUE = Catalogue()

# Records before this instant are in a topic's first load, the others in its second.
_CUT = "2024-01-16 00:00:00"

_DATE_TIME = "strftime(ts, '%d %m %Y %H:%M')"
_TYPED = f"""
  SELECT {_DATE_TIME} AS DateTime, LV_ActivePower, Wind_Speed, Theoretical_Power_Curve,
         Wind_Direction
  FROM (SELECT ts, value AS LV_ActivePower, CAST(user_id AS DOUBLE) AS Wind_Speed,
               CAST(event_id % 3600 AS DOUBLE) AS Theoretical_Power_Curve,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS Wind_Direction
        FROM events) e"""


def _topic(spark, name: str, payload: str = "csv") -> Topic:
    return Topic(name, payload, path=scratch_path(spark, f"topic-{name}"))


def _filled_topic(spark, folder, name: str) -> Topic:
    topic = _topic(spark, name)
    append_to_topic(event_lines(table(spark, folder, "events")), topic)
    return topic


def _typed_events(spark, folder):
    """Events as typed signal rows with the date/time as text."""
    values = [
        v.cast("double").alias(s.column) for v, s in zip(event_values(), SIGNALS, strict=True)
    ]
    return table(spark, folder, "events").select(
        F.date_format("ts", WRITE_TIME_PATTERN).alias("DateTime"), *values
    )


@CATALOGUE.query(
    "topic_csv_encode",
    f"""SELECT {_DATE_TIME} || ',' || CAST(value AS VARCHAR) || ',' || CAST(user_id AS VARCHAR)
               || ',' || CAST(event_id % 3600 AS VARCHAR)
               || ',' || json_extract_string(props, '$.k') AS value
        FROM events""",
)
def topic_csv_encode(spark, folder):
    topic = _topic(spark, "signals")
    when = F.date_format("ts", WRITE_TIME_PATTERN)
    append_to_topic(csv_records(table(spark, folder, "events"), when, *event_values()), topic)
    return text_values(read_topic(spark, topic))


@CATALOGUE.query("topic_batch_replay", EVENT_SIGNALS)
def topic_batch_replay(spark, folder):
    topic = _filled_topic(spark, folder, "signals")
    return comparable(signals_of(topic, read_topic(spark, topic)))


@CATALOGUE.query("topic_stream_decode", EVENT_SIGNALS)
def topic_stream_decode(spark, folder):
    topic = _filled_topic(spark, folder, "signals")
    signals = comparable(signals_of(topic, stream_topic(spark, topic)))
    path = scratch_path(spark, "signals")
    run_available(append_writer(signals, path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path)


@CATALOGUE.query("topic_relay", EVENT_SIGNALS)
def topic_relay(spark, folder):
    """From one topic to another, record by record."""
    source, target = _filled_topic(spark, folder, "source"), _topic(spark, "target")
    records = stream_topic(spark, source)
    run_available(topic_writer(records, target, scratch_path(spark, "checkpoint")))
    return comparable(signals_of(target, read_topic(spark, target)))


@CATALOGUE.query("topic_typed_columns", _TYPED)
def topic_typed_columns(spark, folder):
    """A stream of signal lines as typed columns that keep the date/time text."""
    topic = _filled_topic(spark, folder, "signals")
    path = scratch_path(spark, "typed")
    rows = typed_lines(stream_topic(spark, topic))
    run_available(append_writer(rows, path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path)


@CATALOGUE.query("stream_csv_dir", _TYPED)
def stream_csv_dir(spark, folder):
    source, path = scratch_path(spark, "csv"), scratch_path(spark, "typed")
    write_csv(_typed_events(spark, folder), source)
    rows = stream_csv(spark, source, TYPED_SIGNAL_DDL)
    run_available(append_writer(rows, path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path)


@CATALOGUE.query("topic_json_encode", _TYPED)
def topic_json_encode(spark, folder):
    """A stream of CSV files to a topic of JSON objects, read back by its schema."""
    source, topic = scratch_path(spark, "csv"), _topic(spark, "signals", "json")
    write_csv(_typed_events(spark, folder), source)
    records = json_records(stream_csv(spark, source, TYPED_SIGNAL_DDL))
    run_available(topic_writer(records, topic, scratch_path(spark, "checkpoint")))
    return json_values(read_topic(spark, topic), TYPED_SIGNAL_DDL).select("data.*")


@CATALOGUE.query(
    "topic_json_replay",
    "SELECT event_id AS id, event_type AS name FROM events",
)
def topic_json_replay(spark, folder):
    """The whole log of a topic of JSON events."""
    topic = _topic(spark, "events", "json")
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("name")
    )
    append_to_topic(json_records(events), topic)
    return json_values(read_topic(spark, topic), "id long, name string").select("data.*")


@CATALOGUE.query(
    "topic_latest",
    f"SELECT * FROM ({EVENT_SIGNALS}) s WHERE signal_date >= '{_CUT[:10]}'",
)
def topic_latest(spark, folder):
    """A stream that starts at the topic's present end sees the second load only."""
    topic = _topic(spark, "signals")
    events = table(spark, folder, "events")
    append_to_topic(event_lines(events.where(F.col("ts") < F.lit(_CUT))), topic)
    checkpoint = scratch_path(spark, "checkpoint")
    skip_present(stream_topic(spark, topic), checkpoint)
    append_to_topic(event_lines(events.where(F.col("ts") >= F.lit(_CUT))), topic)
    path = scratch_path(spark, "signals")
    signals = comparable(signals_of(topic, stream_topic(spark, topic)))
    run_available(landing_writer(signals, path).option("checkpointLocation", checkpoint))
    return spark.read.parquet(path).drop("batch_id")


@CATALOGUE.query(
    "replay_then_stream",
    f"""SELECT CASE WHEN signal_date < '{_CUT[:10]}' THEN 'batch' ELSE 'stream' END
               AS seen_by, s.* FROM ({EVENT_SIGNALS}) s""",
)
def replay_then_stream(spark, folder):
    """A replay of the log, then what was appended after it, on one checkpoint."""
    topic = _topic(spark, "signals")
    events = table(spark, folder, "events")
    append_to_topic(event_lines(events.where(F.col("ts") < F.lit(_CUT))), topic)
    checkpoint = scratch_path(spark, "checkpoint")
    seen = {}
    for by in ("batch", "stream"):
        seen[by] = scratch_path(spark, by)
        signals = comparable(signals_of(topic, stream_topic(spark, topic)))
        run_available(landing_writer(signals, seen[by]).option("checkpointLocation", checkpoint))
        if by == "batch":
            append_to_topic(event_lines(events.where(F.col("ts") >= F.lit(_CUT))), topic)
    batch, stream = (spark.read.parquet(p).drop("batch_id").withColumn("seen_by", F.lit(by)) for by, p in seen.items())
    return batch.unionByName(stream)


@CATALOGUE.query(
    "replay_then_stream_json",
    f"""SELECT CASE WHEN ts < TIMESTAMP '{_CUT}' THEN 'batch' ELSE 'stream' END AS seen_by,
               event_id AS id, event_type AS name FROM events""",
)
def replay_then_stream_json(spark, folder):
    """A topic of JSON events: its log is replayed, then what came after it is followed, on one checkpoint."""
    topic = _topic(spark, "events", "json")
    events = table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "ts")
    loads = {"batch": F.col("ts") < F.lit(_CUT), "stream": F.col("ts") >= F.lit(_CUT)}
    checkpoint, seen = scratch_path(spark, "checkpoint"), {by: scratch_path(spark, by) for by in loads}
    for by, chosen in loads.items():
        append_to_topic(json_records(events.where(chosen), "id", "name"), topic)
        rows = json_values(stream_topic(spark, topic), "id long, name string").select("data.*")
        run_available(landing_writer(rows, seen[by]).option("checkpointLocation", checkpoint))
    batch, stream = (spark.read.parquet(p).drop("batch_id").withColumn("seen_by", F.lit(by)) for by, p in seen.items())
    return batch.unionByName(stream)


def _ingested(spark, folder) -> str:
    """Path of the map-form signal table after a stream has filled it."""
    path = scratch_path(spark, "signal-table")
    rows = load_stamped(map_form(event_signal_stream(spark, folder)))
    run_available(append_writer(rows, path, scratch_path(spark, "checkpoint")))
    return path


@CATALOGUE.query(
    "signal_ingest", f"SELECT *, 4 AS entries, TRUE AS stamped FROM ({EVENT_SIGNALS}) s"
)
def signal_ingest(spark, folder):
    """The stream's signal table, with its map entries as columns."""
    rows = read_table(spark, _ingested(spark, folder))
    return rows.select(
        "signal_date",
        F.col("signal_ts").cast("timestamp_ntz").alias("signal_ts"),
        *[F.col("signals")[s.label].alias(s.column) for s in SIGNALS],
        F.size("signals").alias("entries"),
        (F.col("create_date").isNotNull() & F.col("create_ts").isNotNull()).alias("stamped"),
    )


@CATALOGUE.query(
    "signal_table_read",
    f"""SELECT signal_date, count(*) AS n, round(avg(Wind_Speed), 4) AS wind
        FROM ({EVENT_SIGNALS}) s GROUP BY 1""",
)
def signal_table_read(spark, folder):
    rows = read_table(spark, _ingested(spark, folder))
    wind = F.col("signals")[SIGNALS[1].label]
    return rows.groupBy("signal_date").agg(
        F.count("*").alias("n"), F.round(F.avg(wind), 4).alias("wind")
    )

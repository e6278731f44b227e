"""Streaming rollups, sliding windows, watermarks, restarts and fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalmill.functions.signals import csv_line, parse_with_ledger
from signalmill.operators.rollups import group_keys, rollup
from signalmill.operators.windows import collect_windows, newest_first, sliding_rows
from signalmill.plans.catalogue import Catalogue
from signalmill.plans.signal_data import (
    EVENT_SIGNALS,
    ORDER_SIGNALS,
    comparable,
    event_lines,
    event_values,
    order_lines,
    rollup_sql,
    rounded,
)
from signalmill.schemas import WRITE_TIME_PATTERN
from signalmill.session import scratch_path
from signalmill.sinks.topics import append_to_topic, json_records
from signalmill.sources.files import table, table_stream
from signalmill.sources.topics import Topic, json_values, signals_of, stream_topic, text_values
from signalmill.streaming.batches import read_batches
from signalmill.streaming.runner import run_available
from signalmill.streaming.sealed import DayTotals, SealedWindows
from signalmill.streaming.tables import (
    append_writer,
    current_rows,
    fan_out,
    fanned_datapoints,
    fanned_rollup,
    newest_result,
    table_writer,
)

CATALOGUE = Catalogue()

def state_partitions(spark) -> int:
    """State partitions of the ready-made rollups: ``spark.signalmill.state.partitions``, 4 if unset.

    Map-side totals leave a row per task and key, so months need few; raise it for days on large inputs.
    """
    return int(spark.conf.get("spark.signalmill.state.partitions", "4"))


#: Where the tables' rows are cut into the two loads of a stream.
_EVENT_CUT, _ORDER_CUT = "2024-01-16 00:00:00", "1995-06-01 00:00:00"


def event_loads(spark, folder):
    """Signal lines of events in two loads, by time."""
    return _cut(table(spark, folder, "events"), "ts", _EVENT_CUT, event_lines)


def order_loads(spark, folder):
    """Signal lines of orders in two loads, by time."""
    return _cut(table(spark, folder, "orders"), "o_orderdate", _ORDER_CUT, order_lines)


def _cut(rows, time, cut, lines):
    first = F.coalesce(F.col(time) < F.lit(cut), F.lit(True))
    return [lines(rows.where(first)), lines(rows.where(~first))]


def signals_by_load(spark, loads):
    """Appends one load after the other to a topic; gives the topic's signal stream after each."""
    topic = Topic("signals", "csv", path=scratch_path(spark, "topic-signals"))
    for load in loads:
        append_to_topic(load, topic)
        yield signals_of(topic, stream_topic(spark, topic))


def _rolled(spark, loads, grain, style, positive, output_mode, table_mode):
    """A rollup stream over several loads, each taken up by a new run with the same checkpoint and state."""
    path, checkpoint = scratch_path(spark, f"rollup-{grain}"), scratch_path(spark, "checkpoint")
    keys = group_keys(grain) if table_mode == "upsert" else ()
    for stream in signals_by_load(spark, loads):
        rolled = rollup(stream, grain, style, positive, ordered=output_mode == "complete")
        writer = table_writer(rolled, path, checkpoint, output_mode, table_mode, keys)
        run_available(writer, spark, state_partitions(spark))
    found = newest_result(spark, path) if table_mode == "refresh" else current_rows(spark, path, *keys)
    return rounded(found, style)


@CATALOGUE.query("stream_rollup_day", rollup_sql(EVENT_SIGNALS, "day", "sum"))
def stream_rollup_day(spark, folder):
    return _rolled(spark, event_loads(spark, folder), "day", "sum", False, "complete", "refresh")


@CATALOGUE.query(
    "stream_rollup_day_mixed",
    rollup_sql(EVENT_SIGNALS, "day", "mixed", where="LV_ActivePower > 0"),
)
def stream_rollup_day_mixed(spark, folder):
    return _rolled(spark, event_loads(spark, folder), "day", "mixed", True, "complete", "refresh")


@CATALOGUE.query("stream_rollup_month", rollup_sql(ORDER_SIGNALS, "month", "sum"))
def stream_rollup_month(spark, folder):
    return _rolled(spark, order_loads(spark, folder), "month", "sum", False, "complete", "refresh")


@CATALOGUE.query("stream_rollup_quarter", rollup_sql(ORDER_SIGNALS, "quarter", "sum"))
def stream_rollup_quarter(spark, folder):
    return _rolled(spark, order_loads(spark, folder), "quarter", "sum", False, "complete", "refresh")


@CATALOGUE.query("stream_rollup_month_update", rollup_sql(ORDER_SIGNALS, "month", "sum"))
def stream_rollup_month_update(spark, folder):
    """The second load changes months of the first; the newest row of each counts."""
    return _rolled(spark, order_loads(spark, folder), "month", "sum", False, "update", "upsert")


@CATALOGUE.query(
    "stream_watermark_append",
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS n FROM events
       GROUP BY 1
       HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_watermark_append(spark, folder):
    """Counts of the hours that the watermark has closed; the state of the others waits."""
    # a watermark needs an instant; the zone-less time is taken as one in UTC, whatever the session's zone
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)")
    timed = table_stream(spark, folder, "events").select(F.timestamp_micros(micros).alias("ts"))
    hourly = (
        timed.withWatermark("ts", "1 hour")
        .groupBy(F.window("ts", "1 hour").alias("window"))
        .agg(F.count("*").alias("n"))
        .select(
            F.expr(
                "timestampadd(MICROSECOND, unix_micros(window.start), timestamp_ntz'1970-01-01')"
            ).alias("window_start"),
            "n",
        )
    )
    path, checkpoint = scratch_path(spark, "hourly"), scratch_path(spark, "checkpoint")
    run_available(append_writer(hourly, path, checkpoint), spark, state_partitions(spark))
    return spark.read.parquet(path)


_SLIDING = """
  WITH w AS (
    SELECT time_bucket(INTERVAL 2 HOUR, ts) - k * INTERVAL 2 HOUR AS window_start,
           event_id, event_type
    FROM (SELECT *, unnest([0, 1]) AS k FROM events) e),
  sized AS (
    SELECT *, CAST(ceil(count(*) OVER (PARTITION BY window_start) / 50.0) AS BIGINT) AS parts
    FROM w)
  SELECT window_start, window_start + INTERVAL 4 HOUR AS window_end,
         CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % parts AS part,
         string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids,
         string_agg(event_type, ',' ORDER BY event_id) AS names
  FROM sized GROUP BY 1, 2, 3"""


_ARRAYS = {"ids": "event_id", "names": "event_type"}


def _deal():
    """A digest that SQL can compute as well."""
    return F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("long")


def _windows(rows):
    return _shown(collect_windows(rows, _ARRAYS, "event_id", max_array=50, deal=_deal()))


def _shown(windows):
    return newest_first(windows).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "part",
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        F.array_join("names", ",").alias("names"),
    )


@CATALOGUE.query("sliding_window_collect", _SLIDING)
def sliding_window_collect(spark, folder):
    events = table(spark, folder, "events").select("ts", "event_id", "event_type")
    return _windows(sliding_rows(events, "ts", "4 hours", "2 hours"))


@CATALOGUE.query("stream_sliding_collect", _SLIDING)
def stream_sliding_collect(spark, folder):
    """A topic of JSON events, whose stream lands the rows of each window without state.

    Reading the landed rows builds the arrays.
    """
    topic = Topic("events", "json", path=scratch_path(spark, "topic-events"))
    ddl = "event_id long, event_type string, ts timestamp_ntz"
    columns = ["event_id", "event_type", "ts"]
    append_to_topic(json_records(table(spark, folder, "events"), *columns), topic)
    events = json_values(stream_topic(spark, topic), ddl).select("data.*")
    path = scratch_path(spark, "window-rows")
    rows = sliding_rows(events, "ts", "4 hours", "2 hours")
    run_available(append_writer(rows, path, scratch_path(spark, "checkpoint")))
    return _windows(spark.read.parquet(path))


# Three loads: the second has some records from just before the first one's end, the third some that are days late.
_LOAD = """CASE WHEN ts >= TIMESTAMP '2024-01-21' OR (ts < TIMESTAMP '2024-01-11' AND event_id % 50 = 0) THEN 3
                WHEN ts >= TIMESTAMP '2024-01-11' OR (ts >= TIMESTAMP '2024-01-10 20:00:00' AND event_id % 7 = 0) THEN 2
                ELSE 1 END"""

# The watermark before and after each load, one hour behind the latest record.
_WATERMARKS = f"""
  loaded AS (SELECT *, {_LOAD} AS load FROM events),
  latest AS (SELECT load, max(ts) AS ts FROM loaded GROUP BY load),
  marks AS (SELECT a.load, max(b.ts) FILTER (b.load < a.load) - INTERVAL 1 HOUR AS before, max(b.ts) - INTERVAL 1 HOUR AS after
            FROM latest a JOIN latest b ON b.load <= a.load GROUP BY a.load)"""


def _load_columns(spark, folder):
    events = table(spark, folder, "events")
    return events.withColumn("load", F.expr(_LOAD.replace("TIMESTAMP '", "timestamp_ntz'")))


@CATALOGUE.query(
    "live_window_collect",
    f"""
  WITH {_WATERMARKS},
  w AS (SELECT time_bucket(INTERVAL 2 HOUR, ts) - k * INTERVAL 2 HOUR AS window_start, event_id, event_type, before
        FROM (SELECT loaded.*, before, unnest([0, 1]) AS k FROM loaded JOIN marks USING (load)) e),
  kept AS (SELECT *, window_start + INTERVAL 4 HOUR AS window_end FROM w
           WHERE (before IS NULL OR window_start + INTERVAL 4 HOUR > before)
             AND window_start + INTERVAL 4 HOUR <= (SELECT max(after) FROM marks)),
  sized AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY window_start) / 50.0) AS BIGINT) AS parts FROM kept)
  SELECT window_start, window_end, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % parts AS part,
         string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids,
         string_agg(event_type, ',' ORDER BY event_id) AS names
  FROM sized GROUP BY 1, 2, 3""",
)
def live_window_collect(spark, folder):
    """A topic of JSON events followed over three loads; windows are cut into arrays as the watermark closes them."""
    topic = Topic("events", "json", path=scratch_path(spark, "topic-events"))
    columns, ddl = ["event_id", "event_type", "ts"], "event_id long, event_type string, ts timestamp_ntz"
    windows = SealedWindows(
        scratch_path(spark, "windows"), "ts", "4 hours", "2 hours", _ARRAYS, "event_id", "1 hour", max_array=50, deal=_deal()
    )
    events, checkpoint = _load_columns(spark, folder), scratch_path(spark, "checkpoint")
    for load in (1, 2, 3):
        append_to_topic(json_records(events.where(F.col("load") == load), *columns), topic)
        run_available(windows.writer(json_values(stream_topic(spark, topic), ddl).select("data.*"), checkpoint))
    return _shown(windows.sealed(spark))


_DAY_END = "CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP)"
_IN_TIME = f"""
  WITH {_WATERMARKS.replace("max(ts) AS ts", "max(date_trunc('minute', ts)) AS ts")},
  told AS (SELECT loaded.*, before IS NOT NULL AND {_DAY_END} <= before AS late FROM loaded JOIN marks USING (load))"""


def _day_totals(spark, folder):
    events, checkpoint = _load_columns(spark, folder), scratch_path(spark, "checkpoint")
    totals = DayTotals(scratch_path(spark, "days"), "1 hour")
    loads = [event_lines(events.where(F.col("load") == load)) for load in (1, 2, 3)]
    for stream in signals_by_load(spark, loads):
        run_available(totals.writer(stream, checkpoint))
    return totals


@CATALOGUE.query(
    "day_totals_in_time",
    f"{_IN_TIME} "
    + rollup_sql(EVENT_SIGNALS.replace("FROM events", "FROM told WHERE NOT late"), "day", "sum"),
)
def day_totals_in_time(spark, folder):
    """Day totals of three loads with late records, which the closed days no longer take."""
    return rounded(_day_totals(spark, folder).rollup(spark, "day"), "sum")


@CATALOGUE.query(
    "late_signals", f"{_IN_TIME} " + EVENT_SIGNALS.replace("FROM events", "FROM told WHERE late")
)
def late_signals(spark, folder):
    """The records that came after their day had closed."""
    return comparable(_day_totals(spark, folder).late(spark))


@CATALOGUE.query("checkpoint_resume", EVENT_SIGNALS)
def checkpoint_resume(spark, folder):
    """Two runs with one checkpoint: the second takes up what came after the first."""
    topic = Topic("signals", "csv", path=scratch_path(spark, "topic-signals"))
    path, checkpoint = scratch_path(spark, "signals"), scratch_path(spark, "checkpoint")
    events = table(spark, folder, "events")
    cut = F.lit("2024-01-16 00:00:00")
    for load in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)):
        append_to_topic(event_lines(load), topic)
        signals = comparable(signals_of(topic, stream_topic(spark, topic)))
        run_available(append_writer(signals, path, checkpoint))
    return spark.read.parquet(path)


def _fanned_sql(grain, key):
    inner = rollup_sql(ORDER_SIGNALS, grain, "sum")
    return (
        f"SELECT '{grain}' AS grain, CAST({key} AS VARCHAR) AS period, count, "
        "total_LV_ActivePower, total_Wind_Speed, total_Theoretical_Power_Curve, "
        f"total_Wind_Direction FROM ({inner}) {grain}_rollup"
    )


@CATALOGUE.query(
    "fanout_rollups",
    " UNION ALL ".join(
        _fanned_sql(grain, key)
        for grain, key in (("day", "date"), ("month", "month"), ("quarter", "quarter"))
    ),
)
def fanout_rollups(spark, folder):
    """One pass over the stream feeds the signal table and three rollups, load by load."""
    root = _fanned(spark, order_loads(spark, folder))
    result = None
    for grain, key in (("day", "date"), ("month", "month"), ("quarter", "quarter")):
        rolled = rounded(fanned_rollup(spark, root, grain), "sum")
        keyed = rolled.withColumns(
            {"grain": F.lit(grain), "period": F.col(key).cast("string")}
        ).drop(key)
        result = keyed if result is None else result.unionByName(keyed)
    return result


# Event lines of which some lack fields, have a word for a number, or no time.
_DIRTY = {"kind": "event_id % 5 = 0", "short": "event_id % 7 = 0", "undated": "event_id % 11 = 0"}


def _dirty_lines(events):
    when, values = F.date_format("ts", WRITE_TIME_PATTERN), event_values()
    first = F.when(F.expr(_DIRTY["kind"]), F.col("event_type")).otherwise(values[0].cast("string"))
    when = F.when(F.expr(_DIRTY["undated"]), F.concat(F.lit("at "), F.col("event_type"))).otherwise(when)
    whole = csv_line([when, first, *values[1:]])
    return events.select(F.when(F.expr(_DIRTY["short"]), csv_line([when, first])).otherwise(whole).alias("value"))


@CATALOGUE.query(
    "rejected_lines",
    f"""
  WITH e AS (SELECT *, CASE WHEN {_DIRTY["undated"]} THEN 'at ' || event_type ELSE strftime(ts, '%d %m %Y %H:%M') END AS d,
                    CASE WHEN {_DIRTY["kind"]} THEN event_type ELSE CAST(value AS VARCHAR) END AS p FROM events),
  l AS (SELECT *, CASE WHEN {_DIRTY["short"]} THEN d || ',' || p ELSE d || ',' || p || ',' || CAST(user_id AS VARCHAR) || ','
                       || CAST(event_id % 3600 AS VARCHAR) || ',' || json_extract_string(props, '$.k') END AS line FROM e)
  SELECT line, (CASE WHEN {_DIRTY["undated"]} THEN 2 ELSE 0 END + CASE WHEN {_DIRTY["kind"]} THEN 8 ELSE 0 END
          + CASE WHEN {_DIRTY["short"]} THEN 16 + 64 + 256 ELSE 0 END)::INTEGER AS reject_bits,
         concat_ws('; ', CASE WHEN {_DIRTY["undated"]} THEN 'Date/Time not convertible' END,
           CASE WHEN {_DIRTY["kind"]} THEN 'LV ActivePower (kW) not convertible' END,
           CASE WHEN {_DIRTY["short"]} THEN 'Wind Speed (m/s) absent; Theoretical_Power_Curve (KWh) absent; Wind Direction (°) absent' END)
           AS reasons
  FROM l WHERE {" OR ".join(_DIRTY.values())}""",
)
def rejected_lines(spark, folder):
    """The fan-out's second output: lines with rejected fields and why, from the decode that fills the signal table."""
    root, checkpoint = scratch_path(spark, "fan-out"), scratch_path(spark, "checkpoint")
    topic = Topic("signals", "csv", path=scratch_path(spark, "topic-signals"))
    for load in _cut(table(spark, folder, "events"), "ts", _EVENT_CUT, _dirty_lines):
        append_to_topic(load, topic)
        ledger = parse_with_ledger(text_values(stream_topic(spark, topic)))
        run_available(ledger.writeStream.foreachBatch(fan_out(root)).option("checkpointLocation", checkpoint))
    return read_batches(spark, f"{root}/rejected").drop("batch_id")


def _fanned(spark, loads) -> str:
    root, checkpoint = scratch_path(spark, "fan-out"), scratch_path(spark, "checkpoint")
    for stream in signals_by_load(spark, loads):
        run_available(stream.writeStream.foreachBatch(fan_out(root)).option("checkpointLocation", checkpoint))
    return root


@CATALOGUE.query(
    "fanned_datapoints",
    f"""SELECT signal_date, count(DISTINCT signal_ts) AS datapoints
        FROM ({EVENT_SIGNALS}) s GROUP BY 1""",
)
def fanned_datapoints_query(spark, folder):
    """Distinct times per day, added up from the bitmaps of two loads that share a day's times."""
    events = table(spark, folder, "events")
    loads = [event_lines(events.where(F.col("event_id") % 2 == part)) for part in (0, 1)]
    return fanned_datapoints(spark, _fanned(spark, loads))

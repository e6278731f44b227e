"""Signal records derived from the dataset tables, in Spark and in SQL.

``events`` gives a month of records, ``orders`` several years. Every table row
becomes one signal line, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.functions.signals import parse_signals, signal_line
from signalmill.operators.rollups import result_columns
from signalmill.schemas import SIGNALS
from signalmill.sources.files import table, table_stream


def event_values() -> list[Column]:
    return [
        F.col("value"),
        F.col("user_id"),
        F.col("event_id") % 3600,
        F.get_json_object("props", "$.k").try_cast("int"),
    ]


def order_values() -> list[Column]:
    return [
        F.col("o_totalprice"),
        F.col("o_custkey"),
        F.col("o_orderkey") % 3600,
        F.col("o_orderkey") % 360,
    ]


def event_lines(events: DataFrame) -> DataFrame:
    return events.select(signal_line(F.col("ts"), event_values()).alias("value"))


def order_lines(orders: DataFrame) -> DataFrame:
    return orders.select(signal_line(F.col("o_orderdate"), order_values()).alias("value"))


def event_signals(spark: SparkSession, folder: str) -> DataFrame:
    return parse_signals(event_lines(table(spark, folder, "events")))


def order_signals(spark: SparkSession, folder: str) -> DataFrame:
    return parse_signals(order_lines(table(spark, folder, "orders")))


def event_signal_stream(spark: SparkSession, folder: str) -> DataFrame:
    return parse_signals(event_lines(table_stream(spark, folder, "events")))


def order_signal_stream(spark: SparkSession, folder: str) -> DataFrame:
    return parse_signals(order_lines(table_stream(spark, folder, "orders")))


def comparable(signals: DataFrame) -> DataFrame:
    """Parsed signals with the timestamp free of a zone, as the tables have it."""
    values = [s.column for s in SIGNALS]
    return signals.select("signal_date", F.col("signal_ts").cast("timestamp_ntz"), *values)


def rounded(rollup: DataFrame, style: str, digits: int = 2) -> DataFrame:
    """A rollup with rounded values, for comparing."""
    return rollup.withColumns({c: F.round(c, digits) for c in result_columns(style)})


EVENT_SIGNALS = """
  SELECT strftime(ts, '%Y-%m-%d') AS signal_date,
         date_trunc('minute', ts) AS signal_ts,
         value AS LV_ActivePower,
         CAST(user_id AS DOUBLE) AS Wind_Speed,
         CAST(event_id % 3600 AS DOUBLE) AS Theoretical_Power_Curve,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS Wind_Direction
  FROM events"""

ORDER_SIGNALS = """
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS signal_date,
         date_trunc('minute', o_orderdate) AS signal_ts,
         o_totalprice AS LV_ActivePower,
         CAST(o_custkey AS DOUBLE) AS Wind_Speed,
         CAST(o_orderkey % 3600 AS DOUBLE) AS Theoretical_Power_Curve,
         CAST(o_orderkey % 360 AS DOUBLE) AS Wind_Direction
  FROM orders"""

_KEY_SQL = {
    "day": "signal_date AS date",
    "month": "CAST(month(signal_ts) AS INTEGER) AS month",
    "quarter": "CAST(quarter(signal_ts) AS INTEGER) AS quarter",
}


def rollup_sql(
    source: str, grain: str, style: str, by_year: bool = False, where: str = "TRUE"
) -> str:
    """SQL of a rollup over one of the signal sources above."""
    keys = [_KEY_SQL[grain]]
    if by_year:
        keys.insert(0, "CAST(year(signal_ts) AS INTEGER) AS year")
    values = [
        f"round({'avg' if name.startswith('avg_') else 'sum'}({s.column}), 2) AS {name}"
        for s, name in zip(SIGNALS, result_columns(style), strict=True)
    ]
    groups = ", ".join(str(i + 1) for i in range(len(keys)))
    return (
        f"SELECT {', '.join(keys)}, count(*) AS count, {', '.join(values)} "
        f"FROM ({source}) s WHERE {where} GROUP BY {groups}"
    )

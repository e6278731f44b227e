"""Parsing, rollups and hourly analysis of signals."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from signalmill.functions.signals import map_form
from signalmill.operators.joins import lookup_join
from signalmill.operators.relational import rename_by_mapping
from signalmill.operators.rollups import (
    datapoints_per_day,
    hourly_signal_avg,
    positive_power,
    rollup,
    with_generation_indicator,
)
from signalmill.plans.catalogue import Catalogue
from signalmill.plans.signal_data import (
    EVENT_SIGNALS,
    ORDER_SIGNALS,
    event_signals,
    order_signals,
    rollup_sql,
    rounded,
)
from signalmill.schemas import SIGNAL_MAPPING_DDL, SIGNAL_MAPPING_JSON, SIGNALS
from signalmill.sources.files import table
from signalmill.sources.memory import json_table

CATALOGUE = Catalogue()

# Bands that the hourly averages of the dataset fill; the default bands fit turbines.
_BANDS = ((48.0, "Low"), (50.0, "Medium"), (52.0, "High"), (None, "Exceptional"))

_HOURLY = f"""
  SELECT CAST(hour(signal_ts) AS INTEGER) AS hour,
         avg(LV_ActivePower) AS power, avg(Wind_Speed) AS wind,
         avg(Theoretical_Power_Curve) AS theoretical, avg(Wind_Direction) AS direction
  FROM ({EVENT_SIGNALS}) s GROUP BY 1 HAVING hour <> 0"""

_MAPPING = "(VALUES {}) m(sig_name, sig_mapping_name)".format(
    ", ".join(f"('{m['sig_name']}', '{m['sig_mapping_name']}')" for m in json.loads(SIGNAL_MAPPING_JSON))
)


@CATALOGUE.query("signal_parse", f"SELECT *, 0 AS bad_fields FROM ({EVENT_SIGNALS}) s")
def signal_parse(spark, folder):
    signals = event_signals(spark, folder)
    return signals.withColumn("signal_ts", F.col("signal_ts").cast("timestamp_ntz"))


@CATALOGUE.query(
    "positive_power",
    """SELECT c_custkey, c_acctbal AS LV_ActivePower FROM customer WHERE c_acctbal > 0""",
)
def positive_power_query(spark, folder):
    customers = table(spark, folder, "customer")
    return positive_power(customers.select("c_custkey", F.col("c_acctbal").alias("LV_ActivePower")))


def _register_rollup(name, source, source_sql, grain, style, by_year=False):
    positive = style == "mixed" and grain != "quarter"
    where = "LV_ActivePower > 0" if positive else "TRUE"

    @CATALOGUE.query(name, rollup_sql(source_sql, grain, style, by_year, where))
    def run(spark, folder):
        signals = source(spark, folder)
        return rounded(rollup(signals, grain, style, positive, by_year), style)


_register_rollup("rollup_day_sum", event_signals, EVENT_SIGNALS, "day", "sum")
_register_rollup("rollup_day_mixed", event_signals, EVENT_SIGNALS, "day", "mixed")
_register_rollup("rollup_month_sum", order_signals, ORDER_SIGNALS, "month", "sum")
_register_rollup("rollup_month_mixed", order_signals, ORDER_SIGNALS, "month", "mixed")
_register_rollup("rollup_quarter_sum", order_signals, ORDER_SIGNALS, "quarter", "sum")
_register_rollup("rollup_quarter_mixed", order_signals, ORDER_SIGNALS, "quarter", "mixed")
_register_rollup("rollup_month_sum_by_year", order_signals, ORDER_SIGNALS, "month", "sum", True)


@CATALOGUE.query(
    "datapoints_per_day",
    f"""SELECT signal_date, count(DISTINCT signal_ts) AS datapoints
        FROM ({EVENT_SIGNALS}) s GROUP BY 1""",
)
def datapoints_per_day_query(spark, folder):
    return datapoints_per_day(event_signals(spark, folder))


@CATALOGUE.query(
    "hourly_signal_avg",
    f"""SELECT hour, round(power, 4) AS power, round(wind, 4) AS wind,
               round(theoretical, 4) AS theoretical, round(direction, 4) AS direction
        FROM ({_HOURLY}) h""",
)
def hourly_signal_avg_query(spark, folder):
    hourly = hourly_signal_avg(map_form(event_signals(spark, folder)))
    short = ["power", "wind", "theoretical", "direction"]
    return hourly.select(
        "hour",
        *[F.round(F.col(f"`{s.label}`"), 4).alias(n) for s, n in zip(SIGNALS, short, strict=True)],
    )


@CATALOGUE.query(
    "generation_indicator",
    f"""SELECT hour, CASE WHEN power < 48 THEN 'Low' WHEN power < 50 THEN 'Medium'
                          WHEN power < 52 THEN 'High' ELSE 'Exceptional' END
               AS generation_indicator
        FROM ({_HOURLY}) h""",
)
def generation_indicator(spark, folder):
    hourly = hourly_signal_avg(event_signals(spark, folder))
    return with_generation_indicator(hourly, bands=_BANDS).select("hour", "generation_indicator")


@CATALOGUE.query(
    "rename_by_mapping",
    f"""SELECT hour, round(power, 4) AS active_power_average, round(wind, 4) AS wind_speed_average,
               round(theoretical, 4) AS theo_power_curve_average,
               round(direction, 4) AS wind_direction_average,
               CASE WHEN power < 48 THEN 'Low' WHEN power < 50 THEN 'Medium'
                    WHEN power < 52 THEN 'High' ELSE 'Exceptional' END AS generation_indicator
        FROM ({_HOURLY}) h""",
)
def rename_by_mapping_query(spark, folder):
    hourly = hourly_signal_avg(event_signals(spark, folder))
    banded = with_generation_indicator(hourly, bands=_BANDS)
    mapping = json_table(spark, SIGNAL_MAPPING_JSON, SIGNAL_MAPPING_DDL)
    renamed = rename_by_mapping(banded, mapping)
    averages = [c for c in renamed.columns if c.endswith("_average")]
    return renamed.withColumns({c: F.round(c, 4) for c in averages})


@CATALOGUE.query(
    "mapping_from_json",
    f"""SELECT sig_name, sig_mapping_name, count(*) AS n, round(sum(v), 2) AS total
        FROM (SELECT 'LV ActivePower (kW)' AS name, LV_ActivePower AS v FROM ({EVENT_SIGNALS}) a
              UNION ALL SELECT 'Wind Speed (m/s)', Wind_Speed FROM ({EVENT_SIGNALS}) b
              UNION ALL SELECT 'Theoretical_Power_Curve (KWh)', Theoretical_Power_Curve
                        FROM ({EVENT_SIGNALS}) c
              UNION ALL SELECT 'Wind Direction (°)', Wind_Direction FROM ({EVENT_SIGNALS}) d) u
        LEFT JOIN {_MAPPING} ON u.name = m.sig_name
        GROUP BY 1, 2""",
)
def mapping_from_json(spark, folder):
    """Totals per signal name, looked up in the name mapping."""
    entries = map_form(event_signals(spark, folder)).select(F.explode("signals").alias("name", "v"))
    totals = entries.groupBy("name").agg(
        F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total")
    )
    mapping = json_table(spark, SIGNAL_MAPPING_JSON, SIGNAL_MAPPING_DDL)
    return lookup_join(totals, mapping, "name", "sig_name").drop("name")

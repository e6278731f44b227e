"""Rollups of parsed signals per day, month or quarter, and hourly analysis.

All aggregates here combine partially on the map side, so a hot day or month
reaches the shuffle as one row per input task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.functions.signals import band
from signalmill.schemas import GENERATION_BANDS, POWER, SIGNALS

GRAINS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "day": ("date", F.to_date),
    "month": ("month", F.month),
    "quarter": ("quarter", F.quarter),
}

# Which aggregate each signal gets in the two rollup styles.
STYLES: dict[str, tuple[str, ...]] = {
    "sum": ("sum", "sum", "sum", "sum"),
    "mixed": ("sum", "avg", "sum", "avg"),
}
_PREFIX = {"sum": "total_", "avg": "avg_"}

# Values below are added up exactly, as decimals of this type. Larger ones, and those that are no numbers, have no place
# in it and are added as doubles.
_LARGE = 1e15
_EXACT = "decimal(38,15)"


def group_keys(grain: str, by_year: bool = False) -> list[str]:
    """Names of a rollup's key columns."""
    key, _ = _choice(GRAINS, grain, "grain")
    return ["year", key] if by_year else [key]


def result_columns(style: str) -> list[str]:
    """Names of a rollup's value columns after ``count``."""
    kinds = _choice(STYLES, style, "style")
    return [_PREFIX[kind] + s.column for kind, s in zip(kinds, SIGNALS, strict=True)]


def positive_power(signals: DataFrame) -> DataFrame:
    """Records that generated power; values between 0 and 1 count."""
    return signals.where(F.col(POWER) > 0)


def rollup(
    signals: DataFrame,
    grain: str,
    style: str = "sum",
    positive_only: bool = False,
    by_year: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Record count and signal totals or averages per day, month or quarter.

    Months and quarters of different years fall together unless ``by_year``.
    Records without a valid date form the NULL group. Streams may only be
    ``ordered`` in complete mode.

    Sums are exact to 15 decimal places and rounded once at the end, so they are the same bits however the records are
    partitioned or batched. Values from 1e15 on are added as doubles, in no fixed order.
    """
    kinds = _choice(STYLES, style, "style")
    count, value = _counted(positive_only)
    values = [
        _result(kind, *(a for _, a in _sums(value(s.column)))).alias(name)
        for kind, s, name in zip(kinds, SIGNALS, result_columns(style), strict=True)
    ]
    grouped = _keyed(signals, "signal_date", grain, by_year).agg(count.alias("count"), *values)
    grouped = grouped.where(F.col("count") > 0) if positive_only else grouped
    return grouped.orderBy(*group_keys(grain, by_year)) if ordered else grouped


def day_partials(signals: DataFrame, positive_only: bool = False) -> DataFrame:
    """Mergeable day totals: record count, and exact sum, sum of large values and value count of each signal."""
    count, value = _counted(positive_only)
    values = [a.alias(f"{name}_{s.column}") for s in SIGNALS for name, a in _sums(value(s.column))]
    grouped = signals.groupBy("signal_date").agg(count.alias("count"), *values)
    return grouped.where(F.col("count") > 0) if positive_only else grouped


def merge_days(partials: DataFrame) -> DataFrame:
    """Day totals of several loads as one row per day, mergeable as before."""
    return coarser_partials(partials, "day", merged=True)


def coarser_partials(partials: DataFrame, grain: str, merged: bool = False) -> DataFrame:
    """Partial totals per day, month or quarter, dated by the first day of the period.

    Days are left as they are unless they are to be ``merged``.
    """
    _choice(GRAINS, grain, "grain")
    if grain == "day" and not merged:
        return partials
    start = F.col("signal_date") if grain == "day" else F.trunc("signal_date", grain).alias("signal_date")
    totals = [F.sum(c).cast(t).alias(c) for c, t in partials.dtypes if c != "signal_date"]
    return partials.groupBy(start).agg(*totals)


def merge_partials(
    partials: DataFrame, grain: str, style: str = "sum", by_year: bool = False
) -> DataFrame:
    """The rollup of all records whose day totals, from any number of loads, are given."""
    kinds = _choice(STYLES, style, "style")
    values = [
        _result(kind, *(F.sum(f"{part}_{s.column}") for part in ("sum", "large", "n"))).alias(name)
        for kind, s, name in zip(kinds, SIGNALS, result_columns(style), strict=True)
    ]
    keyed = _keyed(partials, "signal_date", grain, by_year)
    return keyed.agg(F.sum("count").alias("count"), *values)


def _sums(value: Column) -> list[tuple[str, Column]]:
    """Aggregates that can be merged in any order."""
    small = F.abs(value) < _LARGE
    exact = F.sum(F.when(small, value).cast(_EXACT))
    return [("sum", exact), ("large", F.sum(F.when(~small, value.cast("double")))), ("n", F.count(value))]


def _result(kind: str, exact: Column, large: Column, n: Column) -> Column:
    """Sum or average as a double, rounded once."""
    small = exact.cast("double")
    total = F.when(large.isNull(), small).when(exact.isNull(), large).otherwise(small + large)
    return total if kind == "sum" else F.try_divide(total, n)


def point_partials(signals: DataFrame) -> DataFrame:
    """Mergeable sets of timestamps: signal_date, grain, bucket, bits.

    Whole minutes, whole seconds and other times are numbered apart, each in its own unit, and stand as bits in bitmaps
    of 32,768 units. A day of minutes is in one or two bitmaps per task, however many records have them.
    """
    kind = signals.schema["signal_ts"].dataType.simpleString()
    epoch = F.expr("timestamp_ntz'1970-01-01'")
    micros = F.unix_micros("signal_ts") if kind == "timestamp" else F.timestamp_diff("MICROSECOND", epoch, F.col("signal_ts"))
    grain = F.when(F.col("_micros") % 60_000_000 == 0, 60_000_000).when(F.col("_micros") % 1_000_000 == 0, 1_000_000).otherwise(1)
    number = F.call_function("div", F.col("_micros"), F.col("grain"))
    numbered = signals.select("signal_date", micros.alias("_micros")).withColumn("grain", grain).withColumn("_number", number)
    keys = ["signal_date", "grain", F.bitmap_bucket_number("_number").alias("bucket")]
    return numbered.groupBy(*keys).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"))


def merge_points(partials: DataFrame) -> DataFrame:
    """Sets of timestamps of several loads as one row per set."""
    return partials.groupBy("signal_date", "grain", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_points(partials: DataFrame) -> DataFrame:
    """Distinct timestamps per day, in day order, from sets of any number of loads."""
    sizes = merge_points(partials).groupBy("signal_date").agg(F.sum(F.bitmap_count("bits")).alias("datapoints"))
    return sizes.orderBy("signal_date")


def datapoints_per_day(signals: DataFrame) -> DataFrame:
    """Distinct timestamps per day, in day order; no timestamp is shuffled."""
    sizes = point_partials(signals).groupBy("signal_date").agg(F.sum(F.bitmap_count("bits")).alias("datapoints"))
    return sizes.orderBy("signal_date")


def hourly_signal_avg(signals: DataFrame) -> DataFrame:
    """Average of every signal per hour of day, without hour 0, in hour order.

    Takes the map or the wide form. From a stored table the wide form reads less,
    because a map column is read with all its entries. Hour 0 is left out inside of the aggregates: a filter
    on the hour would be pushed below the parsing of lines, which would then run twice.
    """

    def value(s):
        return F.col("signals")[s.label] if "signals" in signals.columns else F.col(s.column)

    told = F.col("hour") != 0
    hourly = signals.withColumn("hour", F.hour("signal_ts")).groupBy("hour")
    averages = hourly.agg(
        F.count(F.when(told, 1)).alias("_n"), *[F.avg(F.when(told, value(s))).alias(s.label) for s in SIGNALS]
    )
    return averages.where(F.col("_n") > 0).drop("_n").orderBy("hour")


def with_generation_indicator(
    averages: DataFrame,
    power: str = SIGNALS[0].label,
    bands: Sequence[tuple[float | None, str]] = GENERATION_BANDS,
) -> DataFrame:
    """Adds the name of the power band of each row."""
    return averages.withColumn("generation_indicator", band(F.col(f"`{power}`"), bands))


def _counted(positive_only: bool) -> tuple[Column, Callable[[str], Column]]:
    """A count and the values to aggregate, of all records or of those with power.

    The condition stands inside of the aggregates: as a filter it would be pushed below the parsing
    of lines, which would then run twice.
    """
    if not positive_only:
        return F.count("*"), F.col
    positive = F.col(POWER) > 0
    return F.count(F.when(positive, 1)), lambda column: F.when(positive, F.col(column))


def _keyed(df: DataFrame, date: str, grain: str, by_year: bool):
    key, of = _choice(GRAINS, grain, "grain")
    keys = [of(F.col(date)).alias(key)]
    if by_year:
        keys.insert(0, F.year(date).alias("year"))
    return df.groupBy(*keys)


def _choice(options: dict, name: str, what: str):
    if name not in options:
        raise ValueError(f"unknown {what} {name!r}; choose from {sorted(options)}")
    return options[name]

"""Sliding time windows and the collection of their values into arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.session import scratch_path

MAX_ARRAY = 100_000


def sliding_rows(df: DataFrame, time: str, length: str, slide: str) -> DataFrame:
    """Every row once per sliding window that holds it, as a ``window{start,end}`` column."""
    return df.select(F.window(F.col(time), length, slide).alias("window"), *df.columns)


def collect_windows(
    rows: DataFrame,
    arrays: dict[str, str],
    number: str,
    max_array: int = MAX_ARRAY,
    deal: Column | None = None,
) -> DataFrame:
    """Values per window as arrays, ``{array name: column}``, in order of a record number.

    A window with more than ``max_array`` rows is cut into numbered parts of
    about that size, so a hot window never has to fit into one array or one
    task; the parts of a window hold all of its rows. ``deal`` is the evenly
    spread integer that assigns rows to parts. By default it is drawn from a row's place
    in its task, so equal and missing numbers are spread like any others.

    The rows are evaluated once and land in the shared folder, since a processing time would put
    them into other windows the next time.
    """
    landed = _landed(window_rows(rows, arrays, number, deal), "window-rows")
    return cut_windows(landed, arrays, number, max_array)


def window_rows(
    rows: DataFrame, arrays: dict[str, str], number: str, deal: Column | None = None, *further: Column
) -> DataFrame:
    """Window rows as they should land: window, array values, number, and the integer that deals them to parts."""
    kept = list(dict.fromkeys([*arrays.values(), number]))
    return rows.select("window", *kept, (_by_place() if deal is None else deal).alias("_deal"), *further)


def cut_windows(landed: DataFrame, arrays: dict[str, str], number: str, max_array: int = MAX_ARRAY) -> DataFrame:
    """Landed window rows as arrays per window and part; what :func:`collect_windows` does after landing.

    The window sizes are counted first and kept as a small table, whose known size lets Spark broadcast it instead of
    shuffling the rows for the join.
    """
    counted = landed.groupBy("window").agg(
        F.ceil(F.count("*") / F.lit(max_array)).cast("long").alias("parts")
    )
    sizes = _landed(counted, "window-sizes")
    dealt = landed.join(sizes, "window").withColumn("part", _part(F.col("_deal"), F.col("parts")))
    return _collected(dealt, ["window", "part"], arrays, number)


def collect_windows_live(
    df: DataFrame,
    time: str,
    length: str,
    slide: str,
    arrays: dict[str, str],
    number: str,
    watermark: str,
    parts: int,
    deal: Column | None = None,
) -> DataFrame:
    """The same on a stream, where the number of parts per window is set beforehand.

    Choose it for the busiest window: an array holds about a window's rows divided by ``parts``.
    The watermark comes before the aggregation; in append mode a window is
    emitted, and its state dropped, once the watermark has passed its end. Where no such number is known, or arrays
    are too large for a state, ``streaming.sealed.SealedWindows`` collects windows as they close.
    """
    if parts < 1:
        raise ValueError(f"a window has at least one part, got {parts}")
    spread = _by_place() if deal is None else deal
    timed = df.withWatermark(time, watermark).withColumn("part", _part(spread, F.lit(parts)))
    return _collected(timed, [F.window(time, length, slide).alias("window"), "part"], arrays, number)


def newest_first(windows: DataFrame) -> DataFrame:
    """Windows in descending order of their start."""
    return windows.orderBy(F.col("window.start").desc(), "part")


def _by_place() -> Column:
    return F.xxhash64(F.monotonically_increasing_id())


def _part(spread: Column, parts: Column) -> Column:
    return F.pmod(spread, parts).cast("long")


def _landed(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _collected(
    df: DataFrame, keys: Sequence[str | Column], arrays: dict[str, str], number: str
) -> DataFrame:
    fields = [F.col(number).alias("_order")]
    fields += [F.col(column).alias(name) for name, column in arrays.items()]
    grouped = df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("_values")
    )
    return grouped.select(
        "window", "part", *[F.col(f"_values.{name}").alias(name) for name in arrays]
    )

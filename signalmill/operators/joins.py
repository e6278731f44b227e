"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.operators.sketches import HOT_SHARE, heavy_keys

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

#: Sides from this size on are searched for hot keys.
SKETCH_FROM_BYTES = 256 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size of a table as the statistics of its plan have it; no job runs for it."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size)


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left outer join to a lookup table, broadcast only if its estimated size permits.

    A larger lookup is joined by key, where adaptive execution splits hot keys
    of the left side, and still broadcasts what turns out to be small.
    """
    small = estimated_bytes(lookup) <= max_bytes
    right = F.broadcast(lookup) if small else lookup
    return df.join(right, df[key] == lookup[lookup_key], "left")


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join; a text key is compared as the other side's type.

    Text that does not convert matches nothing. The keys come out as they were.
    """
    left, right = _compared(left, right, left_key, right_key)
    return left.join(right, F.col(_LEFT) == F.col(_RIGHT), "inner").drop(_LEFT, _RIGHT)


def full_outer_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    suffix: str = "_right",
    sketch_from: int = SKETCH_FROM_BYTES,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Full outer equi-join without duplicate column names; keys come out as they were.

    Adaptive execution cannot split a hot key of a full outer join. The hot keys of a side whose estimated size
    reaches ``sketch_from`` bytes are measured first, in a pass over its key column. Rows of such a key are dealt to as many cells as its share
    asks for, and its rows on the other side repeated for each cell; rows without a key, which match nothing, are dealt as well. All others
    are joined as ever, in one scan and one shuffle of each side. Right-hand columns whose
    name the left side also has get the suffix.
    """
    taken = {c.lower() for c in left.columns}
    names = {c: c + suffix for c in right.columns if c.lower() in taken}
    right = right.withColumnsRenamed(names)
    left, right = _compared(left, right, left_key, names.get(right_key, right_key))
    large = [estimated_bytes(df) >= sketch_from for df in (left, right)]
    if not any(large):
        return left.join(right, F.col(_LEFT) == F.col(_RIGHT), "full").drop(_LEFT, _RIGHT)

    cells = _cells(left.sparkSession)
    hot_left = {k: cells(s) for k, s in heavy_keys(left, _LEFT, share).items()} if large[0] else {}
    hot_right = {k: cells(s) for k, s in heavy_keys(right, _RIGHT, share).items()} if large[1] else {}
    spread = cells(1.0)
    # a row's own cell is drawn before it is repeated
    left = left.withColumn("_i", _dealt(_LEFT, hot_left, spread)).withColumn("_j", _repeated(_LEFT, hot_right))
    right = right.withColumn("_m", _dealt(_RIGHT, hot_right, spread)).withColumn("_k", _repeated(_RIGHT, hot_left))
    same = (F.col(_LEFT) == F.col(_RIGHT)) & (F.col("_i") == F.col("_k")) & (F.col("_j") == F.col("_m"))
    joined = left.join(right, same, "full")
    # a hot key does occur on its side, so a repeated row that found no partner in one cell has found it in another
    no_left = F.col("_i").isNull() & _among(_RIGHT, hot_left)
    no_right = F.col("_m").isNull() & _among(_LEFT, hot_right)
    return joined.where(~no_left & ~no_right).drop(_LEFT, _RIGHT, "_i", "_j", "_k", "_m")


_LEFT, _RIGHT = "_compared_left", "_compared_right"


def _cells(spark: SparkSession) -> Callable[[float], int]:
    """Cells for a share of the rows: about two per partition that it would fill."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lambda share: max(2, min(2 * partitions, math.ceil(2 * partitions * share)))


def _numbers(key: str, hot: dict[object, int]) -> Column:
    """Cells of a row's key; null if it is not hot."""
    if not hot:
        return F.lit(None).cast("int")
    keys, numbers = F.array(*map(F.lit, hot)), F.array(*map(F.lit, hot.values()))
    return F.try_element_at(F.map_from_arrays(keys, numbers), F.col(key))


def _dealt(key: str, hot: dict[object, int], spread: int) -> Column:
    place = F.xxhash64(F.monotonically_increasing_id())
    parts = F.when(F.col(key).isNull(), F.lit(spread)).otherwise(F.coalesce(_numbers(key, hot), F.lit(1)))
    return F.pmod(place, parts).cast("int")


def _repeated(key: str, hot: dict[object, int]) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(_numbers(key, hot), F.lit(1)) - 1))


def _among(key: str, hot: dict[object, int]) -> Column:
    return F.coalesce(_numbers(key, hot).isNotNull(), F.lit(False))


def _compared(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a helper column of one type to compare."""
    left_type = left.schema[left_key].dataType.simpleString()
    right_type = right.schema[right_key].dataType.simpleString()
    a, b = left[left_key], right[right_key]
    if left_type != right_type and right_type == "string":
        b = b.try_cast(left_type)
    elif left_type != right_type and left_type == "string":
        a = a.try_cast(right_type)
    return left.withColumn(_LEFT, a), right.withColumn(_RIGHT, b)

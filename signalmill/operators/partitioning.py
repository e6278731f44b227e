"""Control over how rows are spread across partitions and files."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.operators.joins import estimated_bytes


def repartition_by_key(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Brings rows of a key together in up to ``partitions`` partitions.

    Adaptive execution splits a partition that a hot key makes too large and
    merges small ones. Follow with a join or aggregate on the keys as usual;
    Spark adds an exchange where one is still needed.
    """
    _at_least_one(partitions)
    return df.hint("rebalance", partitions, *keys)


def place_by_size(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Deals rows to exactly ``partitions`` partitions of about one size, with few keys in more than one.

    Keys are counted first, map-side. Those with a fair partition's rows or more are cut into pieces that fill partitions up;
    these, and other keys of some size, are packed largest first into the emptiest partition. The driver sees keys that hold a quarter of a fair
    partition or more, so four per partition at most, and broadcasts their places; all smaller keys go where their hash points.
    """
    _at_least_one(partitions)
    counted = df.groupBy(*[F.col(k) for k in keys]).agg(F.count("*").alias("_rows"))
    total = counted.agg(F.sum("_rows")).first()[0] or 0
    fair = max(1, math.ceil(total / partitions))
    large = counted.where(F.col("_rows") >= max(1, fair / 4)).select(F.xxhash64(*keys).alias("_key"), "_rows").collect()
    places = _packed({r["_key"]: r["_rows"] for r in large}, partitions, total)
    known = df.sparkSession.createDataFrame(list(places.items()), "_place_key long, _slots array<int>")
    own, slot = F.xxhash64(*keys), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.size("_slots")).cast("int")
    dealt = df.withColumn("_place_own", own).join(F.broadcast(known), F.col("_place_own") == F.col("_place_key"), "left")
    hashed = F.pmod("_place_own", F.lit(partitions)).cast("int")
    placed = dealt.withColumn("_place", F.when(F.col("_slots").isNotNull(), F.get("_slots", slot)).otherwise(hashed))
    return placed.repartitionById(partitions, F.col("_place")).select(*[F.col(f"`{c}`") for c in df.columns])


#: Into so many slots per partition a divided key is dealt.
_SLOTS = 16


def _packed(rows: dict[int, int], partitions: int, total: int) -> dict[int, list[int]]:
    """Partitions of each large key, as slots that its rows are dealt to evenly.

    Keys are placed largest first. One that is larger than a fair partition fills up the emptiest ones, others go
    whole into the emptiest.
    """
    fair = max(1, total / partitions)
    small = (total - sum(rows.values())) / partitions
    loads = [(small, p) for p in range(partitions)]
    places: dict[int, list[int]] = {}
    for key, n in sorted(rows.items(), key=lambda r: (-r[1], r[0])):
        pieces, left = [], float(n)
        while left > 0:
            load, partition = heapq.heappop(loads)
            taken = min(left, max(fair - load, fair / _SLOTS)) if n > fair else left
            pieces.append((partition, taken))
            left -= taken if left - taken > fair / _SLOTS else left
            heapq.heappush(loads, (load + taken, partition))
        slots = [[p] * max(1, round(_SLOTS * t / fair)) for p, t in pieces]
        places[key] = [p for s in slots for p in s] if len(pieces) > 1 else [pieces[0][0]]
    return places


def round_robin(df: DataFrame, partitions: int) -> DataFrame:
    """Spreads rows evenly over a number of partitions."""
    _at_least_one(partitions)
    return df.repartition(partitions)


def coalesce(df: DataFrame, partitions: int) -> DataFrame:
    """Merges partitions without a shuffle; the work before it narrows as well."""
    _at_least_one(partitions)
    return df.coalesce(partitions)


def coalesce_to_size(df: DataFrame, bytes_per_partition: int | None = None) -> DataFrame:
    """Rows in partitions of about a size, which become files of about that size, however large the table is.

    No job counts the rows and the work before it keeps its tasks: adaptive execution measures what they give and merges or splits
    it. The size is the session's advisory partition size, or about the given one by the plan's estimate.
    """
    if bytes_per_partition is None:
        return df.hint("rebalance")
    _at_least_one(bytes_per_partition)
    return df.repartition(max(1, math.ceil(estimated_bytes(df) / bytes_per_partition)))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def _at_least_one(n: int) -> None:
    if n < 1:
        raise ValueError(f"at least one partition is needed, got {n}")

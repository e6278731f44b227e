"""Keys that own a large share of the rows, from one pass with little memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows is hot.
HOT_SHARE = 0.002


def heavy_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> dict[object, float]:
    """Keys that hold ``share`` of the rows or more, with their approximate shares; a few smaller ones may be among them.

    Every task keeps Misra-Gries counters, whose number depends on ``share`` only, and gives out those that matter. They never
    count a row too many, and all tasks together miss less than three quarters of ``share`` of a key's rows, so keys with
    a quarter of it are taken: fewer than ``4 / share``, each of which does occur. Null is no key.
    """
    if not 0 < share <= 1:
        raise ValueError(f"a share lies between 0 and 1, got {share}")
    counters = int(np.ceil(4 / share))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, total = None, 0
        for batch in batches:
            total += batch.num_rows
            found = pa.table({"key": batch.column(0), "n": pa.array(np.ones(batch.num_rows, dtype=np.int64))})
            kept = found if kept is None else pa.concat_tables([kept, found])
            kept = kept.filter(pc.is_valid(kept["key"])).group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])
            if kept.num_rows > counters:
                n = kept["n"].to_numpy()
                over = int(np.partition(n, -counters - 1)[-counters - 1])
                kept = kept.set_column(1, "n", pa.array(n - over)).filter(pa.array(n > over))
        if kept is not None:
            kept = kept.filter(pc.greater_equal(kept["n"], max(1, int(total * share / 2))))
            yield from kept.to_batches()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kept["key"].type), pa.array([total])], names=["key", "n"])

    kind = df.schema[key].dataType.simpleString()
    summaries = df.select(F.col(key)).mapInArrow(summarise, f"key {kind}, n long")
    merged = summaries.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.col("key").asc_nulls_first())
    found = merged.limit(counters + 1).collect()
    total = next((r["n"] for r in found if r["key"] is None), 0)
    return {r["key"]: r["n"] / total for r in found if r["key"] is not None and r["n"] >= total * share / 4}

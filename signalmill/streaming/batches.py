"""Folders of batches: written whole by one batch, read once marked as complete, and folded into fewer ones.

A batch writes ``batch_id=N`` below its table and overwrites it if repeated. A fold merges the folders of a finished range into
``batches=A-B``, whose rows carry their ``batch_id`` as a column. Readers take marked folders only, and of these the widest, so that they see
the same rows before, during and after a fold. What a fold has replaced is deleted by the next one, when readers have moved on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: So many folders of a tier make one of the next.
FOLD_EVERY = 10


class Folder(NamedTuple):
    first: int
    last: int
    path: str

    @property
    def folded(self) -> bool:
        return self.path.rsplit("/", 1)[-1].startswith("batches=")


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def marked_folders(spark: SparkSession, root: str) -> list[Folder]:
    """Complete folders below a table, by their first batch. The driver sees folder names only."""
    jvm, top = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(top) if fs.exists(top) else []:
        path = status.getPath()
        kind, _, name = path.getName().partition("=")
        if kind in ("batch_id", "batches") and fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            first, _, last = name.partition("-")
            found.append(Folder(int(first), int(last or first), path.toString()))
    return sorted(found)


def current_folders(spark: SparkSession, root: str) -> list[Folder]:
    """The complete folders that no wider complete folder replaces."""
    return _widest(marked_folders(spark, root))


def read_batches(spark: SparkSession, root: str, folders: Iterable[Folder] | None = None) -> DataFrame:
    """Rows of a table's complete batches, with ``batch_id``; raises FileNotFoundError if there are none yet."""
    chosen = current_folders(spark, root) if folders is None else list(folders)
    if not chosen:
        raise FileNotFoundError(f"{root} holds no complete batch yet")
    base = chosen[0].path.rsplit("/", 1)[0]
    parts = []
    if single := [f.path for f in chosen if not f.folded]:
        read = spark.read.option("basePath", base).parquet(*single)
        parts.append(read.withColumn("batch_id", F.col("batch_id").cast("long")))
    if folded := [f.path for f in chosen if f.folded]:
        parts.append(spark.read.parquet(*folded))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold(
    spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame], every: int = FOLD_EVERY
) -> list[Folder]:
    """Merges finished batches in tiers of ``every``, 10 to 10 to 10; returns the folders that are current then.

    ``merge`` gets rows of several batches with ``batch_id`` and returns fewer that mean the same, ``batch_id`` included. The
    newest batch may still be repeated and is left alone. At most ``every`` folders of each tier stay, and those that the
    last fold replaced.
    """
    if every < 2:
        raise ValueError(f"a fold takes two folders at least, got {every}")
    marked = marked_folders(spark, root)
    current = _widest(marked)
    delete_folders(spark, set(marked) - set(current))
    newest = max((f.last for f in current), default=-1)
    size = every
    while size <= newest:
        for begin in range(0, newest - size + 1, size):
            inside = [f for f in current if begin <= f.first and f.last < begin + size]
            if len(inside) < 2:
                continue
            path = f"{root}/batches={begin}-{begin + size - 1}"
            merge(read_batches(spark, root, inside)).write.mode("overwrite").parquet(path)
            current = sorted({*current, Folder(begin, begin + size - 1, path)} - set(inside))
        size *= every
    return current


def delete_folders(spark: SparkSession, folders: Iterable[Folder]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _widest(folders: list[Folder]) -> list[Folder]:
    def inside(a: Folder, b: Folder) -> bool:
        return a != b and b.first <= a.first and a.last <= b.last and (b.folded, b.last - b.first) > (a.folded, a.last - a.first)

    return [a for a in folders if not any(inside(a, b) for b in folders)]

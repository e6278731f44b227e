"""Session construction and the places a job may write intermediate data."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_root: str | None = None


def build_session(
    app_name: str = "signalmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution, skew handling and on-disk stream state.

    ``master`` and ``shuffle_partitions`` belong to the deployment, so neither
    has a default here; leave them out under spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_single_process(spark: SparkSession) -> bool:
    """True when executors are threads of the driver's JVM."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, stream checkpoints and round trips.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a
    single-machine session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _temporary_root(spark)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


_handed_out: list[str] = []


def clean_scratch(spark: SparkSession) -> int:
    """Deletes all folders that :func:`scratch_path` has given this process; returns how many there were.

    Nothing else removes them, as later reads and restarts may need them. Call it once per run, when
    its results have been written elsewhere.
    """
    found = 0
    while _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        found += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return found


def _temporary_root(spark: SparkSession) -> str:
    global _local_root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="signalmill-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


@contextmanager
def shuffle_partitions(spark: SparkSession, count: int) -> Iterator[None]:
    """Start streams inside this block to give them ``count`` state partitions.

    A stream copies the session's settings when it starts and keeps them in its
    checkpoint. Adaptive execution does not resize stateful operators, so a
    rollup with a dozen keys should not open one state store per default partition.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count))
    try:
        yield
    finally:
        spark.conf.set(key, before)

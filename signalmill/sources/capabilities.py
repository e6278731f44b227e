"""Checks for connectors that are separate packages."""

from __future__ import annotations

from pyspark.sql import SparkSession

PACKAGES = {
    "kafka": "org.apache.spark:spark-sql-kafka-0-10_2.13",
    "avro": "org.apache.spark:spark-avro_2.13",
    "delta": "io.delta:delta-spark_2.13",
}


class MissingConnector(RuntimeError):
    """A format was asked for whose package is not on Spark's class path."""


def has_format(spark: SparkSession, name: str) -> bool:
    """Whether Spark can resolve a data source; touches no data."""
    try:
        spark.read.format(name).load()
    except Exception as error:  # the class differs by connector and Spark version
        text = str(error)
        return "Failed to find" not in text and "DATA_SOURCE_NOT_FOUND" not in text
    return True


def require_format(spark: SparkSession, name: str) -> None:
    if not has_format(spark, name):
        package = PACKAGES.get(name, name)
        raise MissingConnector(f"format {name!r} needs the package {package} (spark.jars.packages)")


def checked_options(options: dict[str, object], allowed: frozenset[str]) -> dict[str, object]:
    """Rejects option names that Spark would ignore without a word."""
    unknown = sorted(k for k in options if k.lower() not in allowed)
    if unknown:
        raise ValueError(f"unknown options {unknown}; known are {sorted(allowed)}")
    return options

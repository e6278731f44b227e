"""File readers, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from signalmill.sources.capabilities import checked_options, require_format

# Reader options of Spark's CSV source, in lower case.
CSV_OPTIONS = frozenset(
    "sep delimiter encoding charset quote escape comment header inferschema preferdate "
    "enforceschema ignoreleadingwhitespace ignoretrailingwhitespace nullvalue nanvalue "
    "positiveinf negativeinf dateformat timestampformat timestampntzformat "
    "enabledatetimeparsingfallback maxcolumns maxcharspercolumn mode columnnameofcorruptrecord "
    "multiline chartoescapequoteescaping samplingratio emptyvalue locale linesep "
    "unescapedquotehandling pathglobfilter recursivefilelookup modifiedbefore modifiedafter".split()
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a dataset folder: one file, or a directory of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream.

    A stream's path must be a directory or a pattern; the one-name pattern
    accepts a single file as well as a directory.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(f"{folder}/{{{name}.parquet}}")


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    sep: str = ",",
    schema: str | StructType | None = None,
    infer: bool = False,
    multiline: bool = False,
    **options: object,
) -> DataFrame:
    """CSV with every column as text, inferred types or a given schema.

    Inference reads the data one more time, so give a schema where it is known.
    A multiline file cannot be split: it is read by one task, and parallelism
    comes from the number of files.
    """
    if schema is not None and infer:
        raise ValueError("give a schema or infer it, not both")
    reader = spark.read.options(**checked_options(options, CSV_OPTIONS))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path, header=header, sep=sep, inferSchema=infer, multiLine=multiline)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    header: bool = True,
    sep: str = ",",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A directory of CSV files as a stream; the schema must be given."""
    reader = spark.readStream.schema(schema).option("header", header).option("sep", sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def read_json_multiline(
    spark: SparkSession, path: str, schema: str | StructType | None = None
) -> DataFrame:
    """Files that each hold one JSON value over several lines; one task reads a file."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one row per line, in column ``value``."""
    return spark.read.text(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table directory, Parquet or Delta."""
    if fmt != "parquet":
        require_format(spark, fmt)
    return spark.read.format(fmt).load(path)


def stream_avro(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A directory of Avro files as a stream."""
    require_format(spark, "avro")
    return spark.readStream.format("avro").schema(schema).load(path)

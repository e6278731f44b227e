"""Round trips through files: every writer is read back by its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalmill.operators import partitioning, relational
from signalmill.plans.catalogue import Catalogue
from signalmill.session import scratch_path
from signalmill.sinks import files as sinks
from signalmill.sources import files as sources
from signalmill.sources.files import table
from signalmill.sources.multiline import read_csv_blocks

CATALOGUE = Catalogue()

_CUSTOMER_DDL = (
    "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


@CATALOGUE.query("scan_parquet", "SELECT * FROM events")
def scan_parquet(spark, folder):
    return table(spark, folder, "events")


@CATALOGUE.query(
    "scan_csv_strings",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
              CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
              c_mktsegment FROM customer""",
)
def scan_csv_strings(spark, folder):
    path = scratch_path(spark, "customer-csv")
    table(spark, folder, "customer").write.csv(path, header=True, sep="|")
    return sources.read_csv(spark, path, sep="|")


@CATALOGUE.query("scan_csv_inferred", "SELECT * FROM supplier")
def scan_csv_inferred(spark, folder):
    """No header: columns come as ``_c0`` and so on, and are named by position."""
    suppliers = table(spark, folder, "supplier")
    path = scratch_path(spark, "supplier-csv")
    sinks.write_csv(suppliers, path, header=False)
    found = sources.read_csv(spark, path, header=False, infer=True)
    named = relational.rename_positions(found, suppliers.columns)
    return named.withColumn("s_suppkey", F.col("s_suppkey").cast("long"))


@CATALOGUE.query(
    "scan_csv_multiline",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def scan_csv_multiline(spark, folder):
    """Texts with line breaks, read back by as many tasks as the files have blocks."""
    path = scratch_path(spark, "document-csv")
    table(spark, folder, "documents").write.option("escape", '"').csv(path, header=True)
    return read_csv_blocks(spark, path, escape='"')


@CATALOGUE.query(
    "scan_json_multiline",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_json_multiline(spark, folder):
    path = scratch_path(spark, "customer-json")
    customers = table(spark, folder, "customer")
    sinks.write_json_multiline(customers, path, "c_custkey", rows_per_file=10_000)
    found = sources.read_json_multiline(spark, path)
    return found.select(customers.columns).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@CATALOGUE.query(
    "scan_text_lines",
    "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line "
    "FROM documents) l GROUP BY 1",
)
def scan_text_lines(spark, folder):
    path = scratch_path(spark, "document-text")
    sinks.write_text(table(spark, folder, "documents"), path, "text")
    found = sources.read_text(spark, path).withColumnRenamed("value", "line")
    return found.groupBy("line").agg(F.count("*").alias("n"))


@CATALOGUE.query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "customer-csv")
    customers = table(spark, folder, "customer")
    sinks.write_csv(customers, path, header=False)
    sinks.write_csv(customers, path, header=True)
    return sources.read_csv(spark, path, schema=_CUSTOMER_DDL)


@CATALOGUE.query("parquet_roundtrip", "SELECT * FROM orders")
def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "orders")
    sinks.write_table(table(spark, folder, "orders"), path)
    return sources.read_table(spark, path)


@CATALOGUE.query(
    "partitioned_roundtrip",
    "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def partitioned_roundtrip(spark, folder):
    path = scratch_path(spark, "orders-by-status")
    sinks.write_partitioned(table(spark, folder, "orders"), path, "o_orderstatus", "o_orderpriority")
    sources.read_table(spark, path).createOrReplaceTempView("orders_by_status")
    return spark.sql("SELECT * FROM orders_by_status WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")


@CATALOGUE.query("write_mode_ignore", "SELECT * FROM supplier")
def write_mode_ignore(spark, folder):
    """The second write finds the target present and leaves it as it is."""
    path = scratch_path(spark, "supplier")
    suppliers = table(spark, folder, "supplier")
    sinks.write_table(suppliers, path, mode="ignore")
    sinks.write_table(suppliers.withColumn("s_acctbal", F.lit(0.0)), path, mode="ignore")
    return sources.read_table(spark, path)


@CATALOGUE.query(
    "repartition_by_key",
    """SELECT o_orderstatus, count(*) AS rows, ceil(count(*) / ((SELECT count(*) FROM orders) / 8.0)) > 1 AS divided,
              TRUE AS few, TRUE AS even, 8 AS used FROM orders GROUP BY 1""",
)
def repartition_by_key(spark, folder):
    """Orders dealt to 8 partitions by the sizes of their keys: which keys are divided, and whether all partitions are about a fair size."""
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "orders-by-key")
    placed = partitioning.place_by_size(orders, 8, "o_orderstatus").withColumn("partition", F.spark_partition_id())
    sinks.write_table(placed, path)
    found = sources.read_table(spark, path).groupBy("o_orderstatus", "partition").agg(F.count("*").alias("rows"))
    loads = found.groupBy("partition").agg(F.sum("rows").alias("rows"))
    total, used, largest = loads.agg(F.sum("rows"), F.count("*"), F.max("rows")).first()  # eight rows
    of_key = found.groupBy("o_orderstatus").agg(F.sum("rows").alias("rows"), F.count("*").alias("parts"))
    fair = F.ceil(F.col("rows") / (total / 8))
    return of_key.select(
        "o_orderstatus", "rows", (F.col("parts") > 1).alias("divided"), (F.col("parts") <= fair + 2).alias("few"),
        F.lit(largest <= 1.25 * total / 8).alias("even"), F.lit(used).cast("int").alias("used"),
    )


@CATALOGUE.query("coalesce_files", "SELECT *, TRUE AS merged FROM orders")
def coalesce_files(spark, folder):
    """Many small partitions become files of the session's advisory size: fewer than there were partitions."""
    path = scratch_path(spark, "orders-coalesced")
    scattered = table(spark, folder, "orders").repartition(64)
    sinks.write_table(partitioning.coalesce_to_size(scattered), path)
    written = sources.read_table(spark, path)
    return written.withColumn("merged", F.lit(len(written.inputFiles()) < 64))


@CATALOGUE.query(
    "partition_sizes", "SELECT 8 AS partitions, count(*) AS rows, TRUE AS even FROM events"
)
def partition_sizes(spark, folder):
    """How a fixed number of partitions share the rows: even if they differ by one row per input task at most."""
    events = table(spark, folder, "events")
    sizes = partitioning.partition_sizes(partitioning.round_robin(events, 8))
    tasks = events.rdd.getNumPartitions()
    return sizes.agg(
        F.count("*").cast("int").alias("partitions"), F.sum("rows").alias("rows"),
        (F.max("rows") - F.min("rows") <= tasks).alias("even"),
    )

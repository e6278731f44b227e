"""Projections, filters, joins, aggregates and row maps over the dataset tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalmill.functions.text import joined_names
from signalmill.operators import joins, relational
from signalmill.plans.catalogue import Catalogue
from signalmill.sources.files import table
from signalmill.sources.memory import rows_table

CATALOGUE = Catalogue()


# --- projections ---------------------------------------------------------------


@CATALOGUE.query(
    "project_alias",
    "SELECT p_partkey AS part_id, p_name AS part_name, p_retailprice AS price FROM part",
)
def project_alias(spark, folder):
    names = {"part_id": "p_partkey", "part_name": "p_name", "price": "p_retailprice"}
    return relational.project(table(spark, folder, "part"), names)


@CATALOGUE.query("with_constant", "SELECT *, 'A/1' AS code FROM supplier")
def with_constant(spark, folder):
    return table(spark, folder, "supplier").withColumn("code", F.lit("A/1"))


@CATALOGUE.query(
    "rename_columns",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation_id,
              s_acctbal AS balance FROM supplier""",
)
def rename_columns(spark, folder):
    by_position = relational.rename_positions(
        table(spark, folder, "supplier"), ["id", "supplier_name", "nation_id", "balance"]
    )
    return relational.rename(by_position, {"ID": "supplier_id"})


@CATALOGUE.query("drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(spark, folder):
    return table(spark, folder, "customer").drop("c_acctbal", "c_mktsegment", "not_a_column")


@CATALOGUE.query(
    "map_rows",
    """SELECT p_name || ',' || p_brand || ',' || p_type AS full_name, p_partkey, p_retailprice
       FROM part""",
)
def map_rows(spark, folder):
    full = joined_names(F.col("p_name"), F.col("p_brand"), F.col("p_type"))
    return table(spark, folder, "part").select(
        full.alias("full_name"), "p_partkey", "p_retailprice"
    )


@CATALOGUE.query(
    "map_partitions",
    """SELECT p_name || ',' || p_brand || ',' || p_type AS full_name, p_partkey, p_retailprice
       FROM part""",
)
def map_partitions(spark, folder):
    def make():
        def combine(batch):
            names = batch["p_name"] + "," + batch["p_brand"] + "," + batch["p_type"]
            return batch.assign(full_name=names)[["full_name", "p_partkey", "p_retailprice"]]

        return combine

    parts = table(spark, folder, "part").select(
        *[F.coalesce(c, F.lit("null")).alias(c) for c in ("p_name", "p_brand", "p_type")],
        "p_partkey",
        "p_retailprice",
    )
    schema = "full_name string, p_partkey long, p_retailprice double"
    return relational.map_batches(parts, make, schema)


@CATALOGUE.query(
    "json_fields",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS nested_k FROM events""",
)
def json_fields(spark, folder):
    data = table(spark, folder, "events").select(
        "event_id", F.from_json("props", "k int").alias("data")
    )
    return data.select("event_id", "data.*", F.col("data.k").alias("nested_k"))


@CATALOGUE.query(
    "values_table",
    """SELECT rank, tags, count(*) AS orders FROM orders JOIN (VALUES
         ('1-URGENT', 1, 'hot,first'), ('2-HIGH', 2, 'hot'), ('3-MEDIUM', 3, 'warm'),
         ('4-NOT SPECIFIED', 4, ''), ('5-LOW', 5, 'cold')) v(priority, rank, tags)
       ON o_orderpriority = priority GROUP BY 1, 2""",
)
def values_table(spark, folder):
    """Orders per row of an in-memory table that has an array column."""
    ranks = rows_table(
        spark,
        [
            ("1-URGENT", 1, ["hot", "first"]),
            ("2-HIGH", 2, ["hot"]),
            ("3-MEDIUM", 3, ["warm"]),
            ("4-NOT SPECIFIED", 4, []),
            ("5-LOW", 5, ["cold"]),
        ],
        "priority string, rank int, tags array<string>",
    )
    counts = table(spark, folder, "orders").groupBy("o_orderpriority").count()
    joined = counts.join(ranks, counts["o_orderpriority"] == ranks["priority"])
    return joined.select(
        "rank", F.array_join("tags", ",").alias("tags"), F.col("count").alias("orders")
    )


# --- filters -------------------------------------------------------------------


@CATALOGUE.query("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filter_eq(spark, folder):
    return table(spark, folder, "customer").where(F.col("c_mktsegment") == "MACHINERY")


@CATALOGUE.query(
    "filter_and",
    "SELECT * FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 2",
)
def filter_and(spark, folder):
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    return table(spark, folder, "customer").where((segment == "HOUSEHOLD") & (nation == 2))


@CATALOGUE.query("filter_gt", "SELECT * FROM part WHERE p_size > 25")
def filter_gt(spark, folder):
    return table(spark, folder, "part").where(F.col("p_size") > 25)


@CATALOGUE.query("filter_expr_string", "SELECT * FROM part WHERE p_size = 25")
def filter_expr_string(spark, folder):
    return table(spark, folder, "part").where("P_Size == '25'")


@CATALOGUE.query(
    "sql_where",
    "SELECT * FROM customer WHERE c_acctbal >= 4000 AND c_mktsegment = 'MACHINERY'",
)
def sql_where(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("customer_view")
    return spark.sql(
        "SELECT * FROM Customer_View WHERE c_acctbal >= 4000 AND c_mktsegment = 'MACHINERY'"
    )


# --- joins ---------------------------------------------------------------------

_ORDERS_OF_CUSTOMERS = """
  SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def _text_key_customers(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("cust_text"), "c_name", "c_mktsegment"
    )


@CATALOGUE.query(
    "join_inner",
    _ORDERS_OF_CUSTOMERS.replace("c_mktsegment", "c_mktsegment, CAST(c_custkey AS VARCHAR) AS cust_text", 1),
)
def join_inner(spark, folder):
    orders, customers = table(spark, folder, "orders"), _text_key_customers(spark, folder)
    joined = joins.inner_join(orders, customers, "o_custkey", "cust_text")
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "cust_text")


@CATALOGUE.query("join_sql_comma", _ORDERS_OF_CUSTOMERS)
def join_sql_comma(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("order_view")
    table(spark, folder, "customer").createOrReplaceTempView("customer_view")
    return spark.sql(
        """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
           FROM order_view o, customer_view c WHERE o.o_custkey = c.c_custkey"""
    )


@CATALOGUE.query("join_sql_inner", _ORDERS_OF_CUSTOMERS)
def join_sql_inner(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("order_view")
    table(spark, folder, "customer").createOrReplaceTempView("customer_view")
    return spark.sql(
        """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
           FROM ORDER_VIEW o INNER JOIN CUSTOMER_VIEW c ON o.o_custkey == c.c_custkey"""
    )


@CATALOGUE.query(
    "join_broadcast_left",
    """SELECT c_custkey, c_name, n_name FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def join_broadcast_left(spark, folder):
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = joins.lookup_join(
        table(spark, folder, "customer"), nations, "c_nationkey", "n_nationkey"
    )
    return joined.select("c_custkey", "c_name", "n_name")


@CATALOGUE.query(
    "join_full_outer",
    """SELECT o_orderkey, o_custkey, name, c_custkey, name_right
       FROM (SELECT o_orderkey, o_custkey, o_orderpriority AS name FROM orders
             WHERE o_orderstatus = 'F') o
       FULL JOIN (SELECT c_custkey, c_name AS name_right FROM customer
                  WHERE c_acctbal > 0) c ON o_custkey = c_custkey""",
)
def join_full_outer(spark, folder):
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    customers = table(spark, folder, "customer").where(F.col("c_acctbal") > 0)
    return joins.full_outer_join(
        orders.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("name")),
        customers.select("c_custkey", F.col("c_name").alias("name")),
        "o_custkey",
        "c_custkey",
    )


# --- aggregates ----------------------------------------------------------------


@CATALOGUE.query(
    "group_sum",
    "SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def group_sum(spark, folder):
    grouped = table(spark, folder, "orders").groupBy("o_orderstatus")
    return grouped.agg(F.round(F.sum("O_TotalPrice"), 2).alias("total"))


@CATALOGUE.query(
    "group_min", "SELECT o_orderpriority, min(o_totalprice) AS lowest FROM orders GROUP BY 1"
)
def group_min(spark, folder):
    grouped = table(spark, folder, "orders").groupBy("o_orderpriority")
    return grouped.agg(F.min("o_totalprice").alias("lowest"))


@CATALOGUE.query(
    "group_sum_two_keys",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity
       FROM lineitem GROUP BY 1, 2""",
)
def group_sum_two_keys(spark, folder):
    grouped = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return grouped.agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))


@CATALOGUE.query(
    "having_agg",
    """SELECT l_returnflag, l_suppkey, round(sum(l_extendedprice), 2) AS sum_price,
              min(l_extendedprice) AS min_price, round(avg(l_extendedprice), 4) AS avg_price,
              round(avg(l_quantity), 4) AS avg_quantity
       FROM lineitem GROUP BY 1, 2 HAVING avg(l_quantity) >= 25""",
)
def having_agg(spark, folder):
    grouped = relational.having(
        table(spark, folder, "lineitem"),
        ["l_returnflag", "l_suppkey"],
        {
            "sum_price": F.sum("l_extendedprice"),
            "min_price": F.min("l_extendedprice"),
            "avg_price": F.avg("l_extendedprice"),
            "avg_quantity": F.avg("l_quantity"),
        },
        F.col("avg_quantity") >= 25,
    )
    digits = {"sum_price": 2, "avg_price": 4, "avg_quantity": 4}
    return grouped.withColumns({c: F.round(c, n) for c, n in digits.items()})


@CATALOGUE.query(
    "group_count_three_keys",
    """SELECT o_orderstatus, o_orderpriority, o_custkey, count(*) AS count
       FROM orders GROUP BY 1, 2, 3""",
)
def group_count_three_keys(spark, folder):
    keys = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    return table(spark, folder, "orders").groupBy(*keys).count()


@CATALOGUE.query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@CATALOGUE.query(
    "count_before_after_distinct",
    """SELECT (SELECT count(*) FROM lineitem) AS rows_before,
              (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem) d)
              AS rows_after""",
)
def count_before_after_distinct(spark, folder):
    pairs = table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag")
    return relational.count_and_distinct_count(pairs)


@CATALOGUE.query(
    "fold_with_zero", "SELECT CAST(sum(l_linenumber) + 2 AS BIGINT) AS folded FROM lineitem"
)
def fold_with_zero(spark, folder):
    return relational.fold(table(spark, folder, "lineitem"), "l_linenumber", zero=2)


@CATALOGUE.query(
    "preview_limit", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
)
def preview_limit(spark, folder):
    ordered = table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return ordered.limit(20)

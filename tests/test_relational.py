import pandas as pd
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from signalmill.functions.text import joined_names
from signalmill.operators import partitioning as P
from signalmill.operators import relational as R
from signalmill.schemas import SIGNAL_MAPPING_DDL, SIGNAL_MAPPING_JSON
from signalmill.sources.files import table
from signalmill.sources.memory import json_table, rows_table


def test_names_match_in_any_case(spark):
    df = spark.createDataFrame([(1, 10), (1, 5)], "Id int, Salary int")
    assert R.rename(df, {"SALARY": "pay"}).columns == ["Id", "pay"]
    assert rows(df.groupBy("ID").agg(F.sum("salary"))) == [(1, 15)]


def test_dropping_absent_columns_changes_nothing(spark):
    assert spark.range(1).drop("x", "y").columns == ["id"]


def test_positional_rename_needs_all_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert R.rename_positions(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError, match="2 columns"):
        R.rename_positions(df, ["x"])


def test_project_reaches_into_structs(spark):
    df = spark.createDataFrame([((1, "a"),)], "data struct<id int, name string>")
    assert rows(R.project(df, {"key": "data.id", "label": "data.name"})) == [(1, "a")]


def test_mapping_renames_in_one_projection(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "`Wind Speed (m/s)` double, `Wind Direction (°)` double, hour int")
    mapping = json_table(spark, SIGNAL_MAPPING_JSON, SIGNAL_MAPPING_DDL)
    assert mapping.count() == 4
    assert R.rename_by_mapping(df, mapping).columns == [
        "wind_speed_average", "wind_direction_average", "hour"
    ]


def test_mapping_with_two_names_for_a_column_is_refused(spark):
    mapping = spark.createDataFrame([("id", "a"), ("id", "b")], "sig_name string, sig_mapping_name string")
    with pytest.raises(ValueError, match="several names"):
        R.rename_by_mapping(spark.range(1), mapping)


def test_malformed_json_table_is_refused(spark):
    broken = SIGNAL_MAPPING_JSON.replace("},", "}", 1)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        json_table(spark, broken, SIGNAL_MAPPING_DDL).collect()


def test_json_table_takes_single_quotes(spark):
    assert rows(json_table(spark, "[{'a': 1}, {'a': 2}]", "array<struct<a int>>")) == [(1,), (2,)]


def test_rows_table_kinds_of_schema(spark):
    named = rows_table(spark, [(1, "a")], ["id", "user"])
    assert named.columns == ["id", "user"]
    typed = rows_table(spark, [(1, ["x", "y"])], "id int, tags array<string>")
    assert dict(typed.dtypes)["tags"] == "array<string>"


def test_int_against_text_predicate(spark):
    df = spark.createDataFrame([("Bob", 25), ("Al", 30)], "Name string, Age int")
    assert rows(df.where("Age == '25'")) == [("Bob", 25)]


def test_having(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 1)], "k string, v int")
    got = R.having(df, ["k"], {"mean": F.avg("v"), "low": F.min("v")}, F.col("mean") >= 2)
    assert rows(got) == [("a", 2.0, 1)]


def test_counts_before_and_after_distinct(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(R.count_and_distinct_count(df)) == [(3, 2)]
    assert rows(R.count_and_distinct_count(df.limit(0))) == [(0, 0)]


@pytest.mark.parametrize("partitions", [1, 4])
def test_fold_counts_its_start_once(spark, partitions):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 5, 3, 2)], "v int").repartition(partitions)
    assert rows(R.fold(df, "v", zero=2)) == [(22,)]


def test_joined_names_keep_places(spark):
    df = spark.createDataFrame([("James", "", "Smith"), ("Jen", None, "Brown")], "a string, b string, c string")
    got = df.select(joined_names(F.col("a"), F.col("b"), F.col("c")))
    assert rows(got) == [("James,,Smith",), ("Jen,null,Brown",)]


def test_map_batches_builds_its_helper_once_per_partition(spark):
    def make():
        made = {"batches": 0}

        def helper(batch: pd.DataFrame) -> pd.DataFrame:
            made["batches"] += 1
            return pd.DataFrame({"batch": [made["batches"]] * len(batch)})

        return helper

    df = spark.range(0, 50_000, 1, 2)
    got = R.map_batches(df, make, "batch int").groupBy("batch").count().collect()
    assert sorted(r["batch"] for r in got) == [1, 2, 3]
    assert sum(r["count"] for r in got) == 50_000


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(table(spark, folder, "part").where(F.col("p_size") > 25).select("p_name"))
    assert "GreaterThan(p_size,25)" in text
    assert "p_retailprice" not in text


@pytest.mark.parametrize("call", [P.round_robin, P.coalesce, lambda df, n: P.repartition_by_key(df, n, "id"), lambda df, n: P.place_by_size(df, n, "id")])
def test_no_partition_is_refused(spark, call):
    with pytest.raises(ValueError, match="at least one"):
        call(spark.range(1), 0)


def test_partition_counts(spark):
    df = spark.range(0, 1000, 1, 8)
    assert P.partition_sizes(P.coalesce(df, 2)).count() == 2
    assert P.partition_sizes(P.round_robin(df, 5)).count() == 5
    assert P.partition_sizes(P.coalesce_to_size(df, 2000)).count() == 4  # by the plan's estimate of 8,000 bytes


def test_small_partitions_become_few_files_without_a_count(spark, where):
    df = spark.range(0, 1000, 1, 40)
    P.coalesce_to_size(df).write.parquet(where("out"))
    found = spark.read.parquet(where("out"))
    assert found.count() == 1000 and len(found.inputFiles()) < 10


def test_placement_by_size(spark):
    """One key with 40 % of the rows, a few of some size, and many small ones."""
    kind = F.pmod(F.xxhash64("id"), F.lit(100))
    key = F.when(kind < 40, "hot").when(kind < 70, F.concat(F.lit("k"), (kind % 4).cast("string"))).otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string")))
    df = spark.range(0, 20_000, 1, 6).select("id", F.when(kind == 99, None).otherwise(key).alias("k"))
    placed = P.place_by_size(df, 10, "k").withColumn("p", F.spark_partition_id())
    found = placed.groupBy("k", "p").count().collect()
    loads, spread = {}, {}
    for r in found:
        loads[r["p"]] = loads.get(r["p"], 0) + r["count"]
        spread[r["k"]] = spread.get(r["k"], 0) + 1
    assert sorted(loads) == list(range(10)) and sum(loads.values()) == 20_000
    assert max(loads.values()) < 1.25 * 2000
    assert spread.pop("hot") in (4, 5, 6) and set(spread.values()) == {1}
    assert P.place_by_size(df.limit(0), 3, "k").count() == 0


def test_repartition_by_key_keeps_a_small_key_together_and_splits_a_hot_one(spark, set_conf, where):
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128kb")
    set_conf("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    keyed = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k")
    )
    P.repartition_by_key(keyed, 4, "k").write.parquet(where("out"))
    found = spark.read.parquet(where("out"))
    placed = found.select("k", F.input_file_name().alias("file"))
    files = placed.groupBy("k").agg(F.count_distinct("file").alias("n"))
    places = {r["k"]: r["n"] for r in files.collect()}
    assert places[0] > 1
    assert min(places.values()) == 1
    assert found.count() == 60_000

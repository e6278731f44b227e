import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from signalmill.operators import joins as J
from signalmill.operators.sketches import heavy_keys
from signalmill.sources.files import table


@pytest.fixture
def staff(spark):
    return spark.createDataFrame(
        [(1, "Ann", 10), (2, "Bob", 20), (3, "Cy", 20), (4, "Di", 99), (5, "Ed", None)],
        "eid int, name string, dept int",
    )


@pytest.fixture
def depts(spark):
    return spark.createDataFrame(
        [("10", "X", "Zed"), ("20", "Y", "Yan"), ("40", "W", "Wim"), ("n/a", "V", "Vic"), (None, "U", "Uli")],
        "dept_id string, title string, name string",
    )


def test_int_key_meets_text_key(staff, depts):
    got = J.inner_join(staff, depts, "dept", "dept_id").select("eid", "title")
    assert rows(got) == [(1, "X"), (2, "Y"), (3, "Y")]
    turned = J.inner_join(depts, staff, "dept_id", "dept").select("eid", "title")
    assert rows(turned) == rows(got)


def test_full_outer_equals_sparks_own(staff, depts):
    got = J.full_outer_join(staff, depts, "dept", "dept_id")
    assert got.columns == ["eid", "name", "dept", "dept_id", "title", "name_right"]
    own = staff.join(depts, staff["dept"] == depts["dept_id"].try_cast("int"), "full")
    assert rows(got) == rows(own.toDF(*got.columns))
    assert got.count() == 8


def test_full_outer_result_can_be_written_and_a_shared_key_name_is_kept(spark, where):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    J.full_outer_join(left, right, "k", "k").write.parquet(where("out"))
    assert rows(spark.read.parquet(where("out")).select("k", "v", "k_right", "v_right")) == [
        (1, "a", None, None),
        (2, "b", 2, "c"),
        (None, None, 3, "d"),
    ]


def test_small_lookup_is_broadcast_and_large_one_is_not(spark, folder, set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    set_conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    small = J.lookup_join(customers, nations, "c_nationkey", "n_nationkey")
    assert "BroadcastHashJoin" in plan(small)
    large = J.lookup_join(customers, nations, "c_nationkey", "n_nationkey", max_bytes=10)
    assert "BroadcastHashJoin" not in plan(large)
    assert rows(small) == rows(large)


def test_estimated_size_runs_no_job(spark, folder):
    nations = table(spark, folder, "nation")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert 0 < J.estimated_bytes(nations) < 1_000_000
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def sketched(*args):
    return J.full_outer_join(*args, sketch_from=0, share=0.2)


@pytest.mark.parametrize("join", [J.inner_join, J.full_outer_join, sketched])
def test_text_keys_come_out_as_they_were(spark, join):
    texts = spark.createDataFrame([("010", 1), ("n/a", 2), (None, 3), ("10", 4)], "k string, a int")
    numbers = spark.createDataFrame([(10, 5), (11, 6)], "n int, b int")
    matched = [("010", 1, 10, 5), ("10", 4, 10, 5)]
    rest = [("n/a", 2, None, None), (None, 3, None, None), (None, None, 11, 6)]
    wanted = matched if join is J.inner_join else matched + rest
    assert rows(join(texts, numbers, "k", "n")) == sorted(wanted, key=repr)
    turned = join(numbers, texts, "n", "k").select("k", "a", "n", "b")
    assert rows(turned) == sorted(wanted, key=repr)
    assert dict(turned.dtypes)["k"] == "string"


@pytest.mark.parametrize("hot_side", ["left", "right", "both"])
@pytest.mark.parametrize("kind", ["inner", "full"])
def test_a_hot_key_is_split_and_nothing_is_lost(spark, set_conf, hot_side, kind):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    set_conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8kb")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4kb")

    def side(hot, rest, count, first):
        key = F.col("id") + first
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(key) if hot else key
        return spark.range(0, count, 1, 8).select(F.col("id").alias(rest), key.alias(f"k_{rest}"))

    left = side(hot_side in ("left", "both"), "a", 3000 if hot_side != "both" else 1800, 0)
    right = side(hot_side in ("right", "both"), "b", 3000 if hot_side != "both" else 1800, 300)
    right = right.union(spark.createDataFrame([(-1, 7)], "b long, k_b long")) if hot_side == "left" else right
    if kind == "inner":
        got = J.inner_join(left, right, "k_a", "k_b")
        assert "skew=true" in plan(got)
    else:
        got = J.full_outer_join(left, right, "k_a", "k_b", sketch_from=0, share=0.05)
        final = plan(got).split("Initial Plan")[0]
        assert final.count("SortMergeJoin") == 1 and final.count("ShuffleQueryStage") == 2
    own = left.join(right, F.col("k_a") == F.col("k_b"), kind)
    assert got.count() == own.count()
    assert got.exceptAll(own.select(got.columns)).count() == 0


def test_hot_keys_of_a_full_outer_join_are_spread_over_tasks(spark, set_conf):
    """Keys hot on either side, on both, on one only without a partner, and rows without a key."""
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def side(name, seed):
        kind = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10))
        key = F.when(kind < 3, seed).when(kind == 3, 7).when(kind == 4, None).otherwise(F.col("id") + seed * 100)
        return spark.range(0, 2000, 1, 6).select(F.col("id").alias(name), key.cast("string").alias(f"k_{name}"))

    left = side("a", 1).union(spark.createDataFrame([(9000 + i, "2") for i in range(3)], "a long, k_a string"))
    right = side("b", 2)
    got = J.full_outer_join(left, right, "k_a", "k_b", sketch_from=0, share=0.05)
    own = left.join(right, F.col("k_a") == F.col("k_b"), "full")
    assert got.columns == own.columns
    hashed = [F.count("*"), F.sum(F.xxhash64(*own.columns).cast("decimal(38,0)"))]
    assert got.agg(*hashed).first() == own.agg(*hashed).first()
    only_hot = got.where("k_a = '1' AND k_b IS NULL").groupBy(F.spark_partition_id()).count()
    assert only_hot.count() > 1


def test_heavy_keys_are_found_and_not_overcounted(spark):
    n = 40_000
    key = F.when(F.col("id") % 10 < 3, "hot").when(F.col("id") % 50 == 7, "warm").when(F.col("id") % 20 == 4, None).otherwise(F.col("id").cast("string"))
    df = spark.range(0, n, 1, 7).select(key.alias("k"))
    counts = {r["k"]: r["count"] / n for r in df.groupBy("k").count().collect()}
    for share in (0.25, 0.02):
        found = heavy_keys(df, "k", share)
        assert {k for k, s in counts.items() if k and s >= share} <= set(found) and len(found) <= 4 / share
        assert all(share / 4 <= s <= counts[k] for k, s in found.items())
    assert set(heavy_keys(df, "k", 0.02)) == {"hot", "warm"}
    assert heavy_keys(df.limit(0), "k") == {} and heavy_keys(df.where("k IS NULL"), "k") == {}
    with pytest.raises(ValueError):
        heavy_keys(df, "k", 0)

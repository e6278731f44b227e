import glob

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from signalmill.schemas import TYPED_SIGNAL_DDL

PERSON_DDL = "id int, name string, age int, address string"
from signalmill.sinks import files as K
from signalmill.sources import files as S
from signalmill.sources.capabilities import MissingConnector, has_format
from signalmill.streaming.runner import run_available
from signalmill.streaming.tables import append_writer


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("James ", "M", 3000), ("Jen", "F", 1000), ("Sam", "", 4000), ("Kit", None, 4000)],
        "firstname string, gender string, salary int",
    )


def test_csv_kinds(spark, people, where):
    K.write_csv(people.where("gender <> ''"), where("h"))
    text = S.read_csv(spark, where("h"))
    assert set(dict(text.dtypes).values()) == {"string"}
    inferred = S.read_csv(spark, where("h"), infer=True)
    assert dict(inferred.dtypes)["salary"] == "int"
    given = S.read_csv(spark, where("h"), schema="a string, b string, c long")
    assert dict(given.dtypes)["c"] == "bigint"
    K.write_csv(people, where("n"), header=False)
    assert S.read_csv(spark, where("n"), header=False).columns == ["_c0", "_c1", "_c2"]


def test_ten_columns_without_header_are_named_by_position(spark, where):
    spark.createDataFrame([tuple(range(10))]).write.csv(where("ten"), sep="|")
    found = S.read_csv(spark, where("ten"), header=False, sep="|", infer=True)
    assert found.toDF(*"abcdefghij").first()["j"] == 9


def test_misspelt_option_is_refused(spark, where):
    with pytest.raises(ValueError, match="Delimeter"):
        S.read_csv(spark, where("x"), Delimeter="|")


def test_schema_and_inference_exclude_each_other(spark, where):
    with pytest.raises(ValueError, match="not both"):
        S.read_csv(spark, where("x"), schema="a int", infer=True)


def test_multiline_csv(spark, where):
    texts = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, "one")], "i int, t string")
    texts.write.option("escape", '"').csv(where("m"), header=True)
    found = S.read_csv(spark, where("m"), schema="i int, t string", multiline=True, escape='"')
    assert rows(found) == rows(texts)


def test_multiline_json_files_hold_neighbouring_records(spark, where):
    df = spark.range(10).select("id", F.concat(F.lit("n\n"), "id").alias("name"))
    K.write_json_multiline(df, where("j"), "id", rows_per_file=4)
    assert len(glob.glob(where("j") + "/*/part-*")) == 3
    assert rows(S.read_json_multiline(spark, where("j"))) == rows(df)
    assert rows(S.read_json_multiline(spark, where("j"), "id long")) == [(i,) for i in range(10)]


def test_text_lines(spark, where):
    K.write_text(spark.createDataFrame([("a b",), ("c\nd",)], "t string"), where("t"), "t")
    assert rows(S.read_text(spark, where("t"))) == [("a b",), ("c",), ("d",)]


def test_modes(spark, people, where):
    K.write_csv(people, where("c"), mode="ignore")
    K.write_csv(people.limit(0), where("c"), mode="ignore")
    assert S.read_csv(spark, where("c")).count() == 4
    K.write_table(people, where("p"))
    K.write_table(people, where("p"), mode="append")
    assert S.read_table(spark, where("p")).count() == 8
    K.write_table(people, where("p"))
    assert S.read_table(spark, where("p")).count() == 4
    with pytest.raises(ValueError, match="write mode"):
        K.write_table(people, where("p"), mode="replace")


def test_partition_values_prune_and_an_empty_one_reads_as_null(spark, people, where):
    K.write_partitioned(people, where("p"), "gender", "salary")
    found = S.read_table(spark, where("p"))
    men = found.where("salary >= 3000 AND gender = 'M'")
    text = plan(men)
    assert "PartitionFilters: [isnotnull(" in text
    assert rows(men) == [("James ", "M", 3000)]
    assert rows(found.where("gender IS NULL").select("firstname")) == [("Kit",), ("Sam",)]


def test_partitioned_write_needs_keys_and_distinct_names(spark, people, where):
    with pytest.raises(ValueError, match="at least one"):
        K.write_partitioned(people, where("p"))
    twice = people.join(people.withColumnRenamed("salary", "pay"), "firstname")
    with pytest.raises(ValueError, match="gender"):
        K.write_partitioned(twice, where("p"), "salary")


def test_a_hot_partition_value_is_written_by_several_tasks(spark, where, set_conf):
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64kb")
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
        F.xxhash64("id").alias("v"),
    )
    K.write_partitioned(df, where("p"), "k")
    files = {k: len(glob.glob(where("p") + f"/k={k}/part-*")) for k in ("hot", "k1")}
    assert files["hot"] > 1
    assert S.read_table(spark, where("p")).count() == 100_000


def test_csv_directory_as_a_stream(spark, where):
    source = where("in")
    data = [("01 01 2018 00:10", 1.0, 2.0, 3.0, 4.0)]
    spark.createDataFrame(data, TYPED_SIGNAL_DDL).write.csv(source, header=True)
    stream = S.stream_csv(spark, source, TYPED_SIGNAL_DDL, max_files_per_trigger=1)
    run_available(append_writer(stream, where("out"), where("checkpoint")))
    assert rows(spark.read.parquet(where("out"))) == data


def test_a_table_streams_from_a_file_and_from_a_directory(spark, folder, where):
    one = S.table(spark, folder, "events")
    one.repartition(3).write.parquet(where("events.parquet"))
    for place in (folder, where("")):
        out = where(f"out{len(place)}")
        stream = S.table_stream(spark, place, "events", max_bytes_per_trigger=10_000)
        run_available(append_writer(stream, out, out + "-checkpoint"))
        assert spark.read.parquet(out).count() == 1000


@pytest.mark.parametrize("fmt", ["delta", "avro"])
def test_absent_connectors_are_named(spark, people, where, fmt):
    if has_format(spark, fmt):
        pytest.skip(f"{fmt} is installed")
    with pytest.raises(MissingConnector, match=fmt):
        K.write_table(people, where("x"), fmt=fmt)
    with pytest.raises(MissingConnector, match=fmt):
        S.read_table(spark, where("x"), fmt=fmt)
    with pytest.raises(MissingConnector, match=fmt):
        append_writer(people, where("x"), where("c"), fmt=fmt)


def test_avro_stream_works_where_the_package_is(spark, people, where):
    if has_format(spark, "avro"):
        spark.createDataFrame([(1, "a", 2, "b")], PERSON_DDL).write.format("avro").save(where("a"))
        stream = S.stream_avro(spark, where("a"), PERSON_DDL)
        run_available(append_writer(stream, where("out"), where("checkpoint")))
        assert spark.read.parquet(where("out")).count() == 1
    else:
        with pytest.raises(MissingConnector, match="spark-avro"):
            S.stream_avro(spark, where("a"), PERSON_DDL)

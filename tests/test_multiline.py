"""Multiline CSV read by blocks against Spark's own reader, with blocks of any size."""

import os
import random

import pytest
from conftest import rows

from signalmill.sources.multiline import Quoting, read_csv_blocks

PARTS = ["a", "word", '"', '""', "\\", "\\\\", ",", "\n", "\n\n", "\r\n", " ", "ö", "😀", "|", "\\n", '\\"', "x" * 30]


def some_rows(seed, n=120):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8))) or None, f"k{i % 3}", rng.choice(["", None, "z"])) for i in range(n)]


def in_blocks(set_conf, size):
    set_conf("spark.sql.files.maxPartitionBytes", str(size))
    set_conf("spark.sql.files.openCostInBytes", "1")


def reference(spark, path, **options):
    return spark.read.csv(path, header=True, multiLine=True, **options)


@pytest.mark.parametrize("escape", ['"', "\\"])
@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_equals_sparks_reader(spark, where, set_conf, escape, size):
    df = spark.createDataFrame(some_rows(size), "id int, text string, `a,b` string, last string")
    df.coalesce(2).write.option("escape", escape).csv(where("in"), header=True)
    in_blocks(set_conf, size)
    found = read_csv_blocks(spark, where("in"), escape=escape)
    assert found.columns == ["id", "text", "a,b", "last"]
    assert rows(found) == rows(reference(spark, where("in"), escape=escape))
    largest = max(os.path.getsize(where(f"in/{f}")) for f in os.listdir(where("in")) if f.endswith(".csv"))
    if size < largest:
        assert spark.read.text(where("in")).rdd.getNumPartitions() > 2


def by_hand(where, text):
    with open(where("x.csv"), "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return where("x.csv")


@pytest.mark.parametrize("size", [1, 9, 100])
@pytest.mark.parametrize(
    "text",
    [
        'a,b\n1,"x\ny"\n\n2,"q\r\nr"\r\n"3","""\n"""\n',
        '"a\nb",c\n1,2\n\n"3\n\n4",5',
        'a,b\r\n1,2\r\n\r\n"3\r\n\r\n4",5',
        '"a\nb",c\r\n1,2\r\n\r\n3,4\n',
        'a,b\n1,mid"quote\n2,"long\n' + "line\n" * 40 + 'end"\n3,4\n',
        "a,b\n",
        'a,b\n"only\n\n\none",',
        "a,b\n1\n1,2,3\n",
    ],
)
def test_borders_anywhere(spark, where, set_conf, text, size):
    path = by_hand(where, text)
    wanted = rows(reference(spark, path, escape='"'))
    in_blocks(set_conf, size)
    assert rows(read_csv_blocks(spark, path, escape='"')) == wanted


def test_schema_separator_and_no_header(spark, where, set_conf):
    path = by_hand(where, "1;'a;\nb';2.5\n2;'it''s';\n")
    in_blocks(set_conf, 4)
    found = read_csv_blocks(spark, path, header=False, sep=";", quote="'", escape="'", schema="n int, `t x` string, v double")
    assert rows(found) == [(1, "a;\nb", 2.5), (2, "it's", None)]
    assert read_csv_blocks(spark, path, header=False, sep=";", quote="'", escape="'").columns == ["_c0", "_c1", "_c2"]


def test_lines_are_followed_through_quotes():
    plain, doubled = Quoting(), Quoting(escape='"')
    for line, inside, ends in [
        ('a,"b', False, True), ('b"', True, False), ('b\\"', True, True), ('b\\\\"', True, False), ('x,y"z', False, False),
        ('"a","b', False, True), ('"a",b"', False, False), ("no quote", True, True), ("", True, True), ('","', True, True), ('b\\', True, True),
    ]:
        assert plain.ends_inside(line, inside) == ends, line
    assert doubled.ends_inside('a""', True) and not doubled.ends_inside('a"""', True) and not doubled.ends_inside('"",x', False)
    with pytest.raises(ValueError):
        Quoting(sep="||")


def test_many_tasks_read_one_file_and_only_crossing_records_are_shuffled(spark, where, set_conf):
    text = "a,b\n" + "".join(f'{i},"{"w " * 10}\n{i}"\n' for i in range(2000))
    path = by_hand(where, text)
    in_blocks(set_conf, 8000)
    found = read_csv_blocks(spark, path)
    assert found.count() == 2000
    assert spark.read.text(path).rdd.getNumPartitions() > 5

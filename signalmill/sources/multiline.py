"""CSV whose records go over several lines, read by many tasks.

Files are read as lines, block by block. Whether a line ends inside a quoted field depends on how it began, so each block
is first read as a function from "begins inside quotes" to "ends inside quotes". These functions, one small row per block,
are put together in file order, which tells how every block begins. The second read cuts each block into records;
a record that goes over the end of a block is put together from its pieces. Spark's own CSV parser then parses the records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Quoting:
    """Follows quoted fields through lines."""

    def __init__(self, sep: str = ",", quote: str = '"', escape: str = "\\") -> None:
        if any(len(sign) != 1 for sign in (sep, quote, escape)):
            raise ValueError("separator, quote and escape are one sign each")
        self.sep, self.quote = sep, quote
        q, e = re.escape(quote), re.escape(escape)
        # the rest of a quoted field up to its closing quote
        inner = f"(?:[^{q}]++|{q}{q})*+{q}" if quote == escape else f"(?:[^{q}{e}]++|{e}.)*+{q}"
        self.rest = re.compile(inner)

    def ends_inside(self, line: str, inside: bool) -> bool:
        """Whether a quoted field is open at the end of a line. Fields are quoted from their first sign on."""
        if self.quote not in line:
            return inside
        at = 0
        while True:
            if not inside and line.startswith(self.quote, at):
                at, inside = at + 1, True
            if inside:
                closed = self.rest.match(line, at)
                if not closed:
                    return True
                at, inside = closed.end(), False
            at = line.find(self.sep, at) + 1
            if not at:
                return False


class _Begin(NamedTuple):
    """How a block begins: inside a record or not, and in which block that record began. How its file's lines end."""

    inside: bool
    origin: int
    returns: bool


def read_csv_blocks(
    spark: SparkSession,
    path: str,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    schema: str | StructType | None = None,
) -> DataFrame:
    """A multiline CSV file or folder in UTF-8, each file read by as many tasks as it has blocks.

    Gives what Spark's reader gives with ``multiLine`` for files whose quoted fields are well formed. A file whose first line
    ends in ``\\r\\n`` has these read as ``\\n`` everywhere; in other files ``\\r`` is a sign like others. Columns
    are text, named by the first file's header or ``_c0`` and so on, unless a schema
    is given. The driver gets one row per block, as it holds one task per block anyway. Files are read twice,
    and a third time if a record goes over the end of a block.
    """
    quoting = Quoting(sep, quote, escape)
    options = {"sep": sep, "quote": quote, "escape": escape, "multiLine": "true"}
    if schema is None:
        schema = spark.read.options(header=header, **options).csv(path).schema  # takes one record
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    record = F.from_csv("record", F.lit(ddl), options).alias("row")
    return records(spark, path, quoting, header).select(record).select(*[F.col("row").getField(f.name).alias(f.name) for f in schema])


def records(spark: SparkSession, path: str, quoting: Quoting, header: bool = False) -> DataFrame:
    """The records of a file or folder as texts, without headers and empty lines."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )
    begins, pieces_left = _beginnings(lines, quoting)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Pieces()
        for (file, block), rows in _blocks(batches):
            if (file, block) not in begins:
                raise RuntimeError("files were split in another way than in the read before; their blocks changed")
            inside, origin, returns = begins[file, block]
            at_head, piece = header and block == 0, []
            began = origin if inside else None
            for line in rows:
                line = line.removesuffix("\r") if returns else line
                piece.append(line)
                inside = quoting.ends_inside(line, inside)
                if not inside:
                    text = "\n".join(piece)
                    if began is not None or (text and not at_head):
                        out.add(file, began, block, False, text)
                    at_head, began, piece = at_head and began is not None, None, []
                    yield from out.full()
            if piece:  # it goes on in the next block, or its quote is never closed
                out.add(file, block if began is None else began, block, at_head and began is None, "\n".join(piece))
        yield from out.full(1)

    pieces = lines.mapInArrow(cut, "file string, origin long, block long, head boolean, record string")
    whole = pieces.where("origin IS NULL").select("record")
    if not pieces_left:
        return whole
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    joined = pieces.where("origin IS NOT NULL").groupBy("file", "origin").agg(parts.alias("parts"), F.max("head").alias("head"))
    return whole.unionByName(joined.where(~F.col("head")).select(F.array_join("parts.record", "\n").alias("record")))


def _beginnings(lines: DataFrame, quoting: Quoting) -> tuple[dict[tuple[str, int], _Begin], bool]:
    """How each block begins, and whether any record is open at the end of a block."""

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), rows in _blocks(batches):
            from_out, from_in, all_in, returns = False, True, True, None
            for line in rows:
                returns = line.endswith("\r") if returns is None else returns
                from_out, from_in = quoting.ends_inside(line, from_out), quoting.ends_inside(line, from_in)
                all_in = all_in and from_in
            columns = [pa.array([x]) for x in (file, block, from_out, from_in, all_in, returns)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "from_out", "from_in", "all_in", "returns"])

    shape = "file string, block long, from_out boolean, from_in boolean, all_in boolean, returns boolean"
    begins, left = {}, False
    for file, blocks in groupby(sorted(lines.mapInArrow(functions, shape).collect()), lambda r: r["file"]):
        inside, origin, returns = False, 0, None
        for r in blocks:
            returns = r["returns"] if returns is None else returns
            begins[file, r["block"]] = _Begin(inside, origin, returns)
            if not (inside and r["all_in"]):
                origin = r["block"]
            inside = r["from_in"] if inside else r["from_out"]
            left = left or inside
    return begins, left


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The blocks of a task with their lines, one after the other."""

    def each() -> Iterator[tuple[tuple[str, int], str]]:
        for batch in batches:
            files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, line in zip(zip(files, blocks, strict=True), batch.column(2), strict=True):
                yield key, line.as_py()

    for key, rows in groupby(each(), lambda r: r[0]):
        yield key, (line for _, line in rows)


class _Pieces:
    """Records and pieces of records on their way out of a task."""

    NAMES, KINDS = ["file", "origin", "block", "head", "record"], [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, *row: object) -> None:
        self.rows.append(row)

    def full(self, least: int = 1000) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = [pa.array(c, k) for c, k in zip(zip(*self.rows, strict=True), self.KINDS, strict=True)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, names=self.NAMES)

"""Line dedup over all documents, equal and nearly equal lines, by a segment-partition edit join.

Of lines within ``edits`` edits of each other, one of ``edits`` + 1 segments is left
untouched. So every distinct line is indexed under its segments and looks up, for each
length that a partner may have, its own substrings where that partner's segments may
lie. Lines that meet are verified by a banded bit-parallel edit distance.

A key at which many lines meet gives no pairs. For one edit, the rest of such lines is partitioned once
more, and again, until few are left or the edit has nowhere else to lie. That is exact
and grows with the lines, not with pairs of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import staged, text_or_empty
from signalmill.llm.components import components

#: Lines shorter than this are compared as they are only.
LEAST_CHARS = 20
#: Up to so many lines at a key are verified pair by pair; above, keys are refined.
CROWD = 16
#: Up to so many lines of 16 bytes are broadcast to find their texts; more are joined.
BROADCAST_LINES = 500_000


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Starts and sizes of edits + 1 segments, the longer ones last."""
    size, longer = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        n = size + (i > edits - longer)
        out.append((at, n))
        at += n
    return out


def _key(length: int, segment: int, part: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{length}:{segment}:{part}".encode()) - (1 << 63)


def index_keys(line: str, edits: int) -> list[int]:
    return [_key(len(line), i, line[p : p + n]) for i, (p, n) in enumerate(segments(len(line), edits))]


def probe_keys(line: str, edits: int) -> list[int]:
    """Keys under which an equally long or shorter partner may stand.

    A segment's place in the longer line is limited from the left by the edits before it and from the right by
    those after it.
    """
    out = []
    for length in range(max(len(line) - edits, edits + 1), len(line) + 1):
        longer = len(line) - length
        for i, (p, n) in enumerate(segments(length, edits)):
            first = max(0, p - i, p + longer - (edits - i))
            last = min(len(line) - n, p + i, p + longer + (edits - i))
            out.extend(_key(length, i, line[q : q + n]) for q in range(first, last + 1))
    return out


def within(a: str, b: str, edits: int) -> bool:
    """Whether two strings are at most ``edits`` edits apart: bit-parallel, in a band of the matrix.

    One machine-sized word holds the 2 * edits + 1 diagonals; row by row it notes for each number of
    edits how far along the diagonals the strings can be matched.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    width = 2 * edits + 1
    full = (1 << width) - 1
    # bit d of reach[e]: a[:i] and b[:i + d - edits] are at most e edits apart
    reach = []
    for e in range(edits + 1):
        reach.append(sum(1 << d for d in range(edits, min(edits + e, width - 1, edits + len(b)) + 1)))
    for i, c in enumerate(a):
        same = 0
        for d in range(width):
            j = i + d - edits
            if 0 <= j < len(b) and b[j] == c:
                same |= 1 << d
        inside = full & ~((1 << max(0, edits - i - 1)) - 1)
        if (over := i + 1 + edits - len(b)) > 0:
            inside &= full >> over
        after = []
        for e in range(edits + 1):
            row = reach[e] & same
            if e:
                row |= reach[e - 1] | (reach[e - 1] >> 1) | (after[e - 1] << 1)
            after.append(row & inside)
        reach = after
    return bool(reach[edits] >> (len(b) - len(a) + edits) & 1)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row, text; rows of one id and text count as one, and have one ``row``."""
    return docs.select(
        F.col(id_col).alias("id"), _row_mark(id_col, text_col).alias("row"), text_or_empty(text_col).alias("text")
    )


def line_table(docs: DataFrame, edits: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row, line (number), mark (16 bytes of its content), keys: lines with a character that is no blank.

    ``keys`` is null for short lines and for lines seen before in the same task; its first
    ``edits`` + 1 are the index keys.
    """
    rows = _texts(docs, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            doc, number, marks, keys = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for j, line in enumerate(text.split("\n")):
                    if not line.strip(" \t\x0b\x0c\r"):
                        continue
                    mark = hashlib.blake2b(line.encode(), digest_size=16).digest()
                    doc.append(i)
                    number.append(j)
                    marks.append(mark)
                    if len(line) < LEAST_CHARS or mark in seen:
                        keys.append(None)
                        continue
                    if len(seen) < 1_000_000:  # only saves work; what is sent twice is made distinct later
                        seen.add(mark)
                    keys.append(index_keys(line, edits) + probe_keys(line, edits))
            at = pa.array(doc, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.list_(pa.int64()))], names=["id", "row", "line", "mark", "keys"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {id_type}, row binary, line int, mark binary, keys array<bigint>")


def near_lines(docs: DataFrame, lines: DataFrame, edits: int = 1, text_col: str = "text") -> DataFrame:
    """a, b: marks of different lines that are at most ``edits`` edits apart; of a crowd, enough to connect it."""
    n = edits + 1
    # a crowd is no skew: a line meets it once per task at most, and distinct() leaves one row
    dealt = lines.where("keys IS NOT NULL").select("mark", F.posexplode("keys").alias("place", "key"))
    dealt = dealt.select("key", "mark", "place").repartition("key").distinct()
    probes = F.col("place") >= n
    sizes = dealt.groupBy("key").agg(
        F.min("mark").alias("_low"), F.max("mark").alias("_high"), F.count("*").alias("size"),
        F.max(~probes).alias("_indexed"),
    )
    live = sizes.where("_low <> _high AND _indexed").select(F.col("key").alias("k"), "size")
    met = dealt.join(live, F.col("key") == F.col("k")).select("key", "mark", "place", probes.alias("probes"), "size")
    met = staged(met, "met-lines")
    pairs = _pairs_at_keys(met.where(F.col("size") <= 2 * CROWD))
    crowded = met.where(F.col("size") > 2 * CROWD)
    marks = pairs.select(F.explode(F.array("a", "b")).alias("w")).unionByName(crowded.select(F.col("mark").alias("w")))
    wanted = staged(marks.distinct(), "wanted-lines")
    texts = staged(_line_texts(docs, wanted, text_col), "line-texts")
    if edits == 1:
        pairs = pairs.unionByName(_crowd_pairs_by_halving(crowded, texts))
    else:
        pairs = pairs.unionByName(_crowd_pairs_by_length(crowded, texts, edits))
    left = texts.select(F.col("mark").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("mark").alias("b"), F.col("text").alias("text_b"))
    pairs = staged(pairs.distinct(), "line-pairs")
    return pairs.join(left, "a").join(right, "b").where(_within(edits)("text_a", "text_b")).select("a", "b")


def _pairs_at_keys(met: DataFrame) -> DataFrame:
    """a, b of rows key, mark, probes: each indexed line with all others at its key."""
    index = met.where("NOT probes").select("key", F.col("mark").alias("a"))
    pairs = index.join(met.select("key", F.col("mark").alias("b")), "key").where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _within(edits: int):
    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within(x, y, edits) for x, y in zip(a, b, strict=True)])

    return close


def _line_texts(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """mark, text of the wanted lines."""
    rows = docs.select(text_or_empty(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [x for t in batch.column(0).to_pylist() for x in t.split("\n") if len(x) >= LEAST_CHARS]
            lines = list(dict.fromkeys(lines))
            marks = [hashlib.blake2b(x.encode(), digest_size=16).digest() for x in lines]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(lines, pa.string())], names=["mark", "text"])

    found = rows.mapInArrow(cut, "mark binary, text string")
    if wanted.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    return found.join(wanted, found["mark"] == wanted["w"], "left_semi").groupBy("mark").agg(F.first("text").alias("text"))


def _crowd_pairs_by_halving(crowded: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: pairs of crowded lines that hold all lines one edit apart, up to what connects them.

    Lines at a key agree in a beginning and an end, and the edit lies in the window between. Of the window's
    halves one is untouched as well, so the key is refined by each half in turn. Lines whose edits lie at different
    places part, and a key with few lines gives its pairs. At a window of one character, all indexed lines are one
    edit apart; at an empty one, all others are so from the only indexed line.
    """
    # places 0 and 1 index a line's halves, 2 and 3 look for a partner with one character less
    sized = texts.select(F.col("mark").alias("m"), F.length("text").alias("n"))
    met = crowded.where("place < 4").join(sized, F.col("mark") == F.col("m"))
    size = F.col("n") - F.col("probes").cast("int")
    half = F.floor(size / 2).cast("int")
    first = F.col("place") % 2 == 0
    level = met.select(
        "mark", "probes", size.alias("l"), F.when(first, half).otherwise(0).alias("p"), F.when(first, 0).otherwise(size - half).alias("s")
    ).distinct()
    found = level.select(F.col("mark").alias("a"), F.col("mark").alias("b")).limit(0)
    while True:
        rows = level.join(texts, "mark").mapInArrow(_refine, "key long, mark binary, probes boolean, l int, p int, s int")
        rows = staged(rows.distinct(), "refined-lines")
        groups = rows.groupBy("key").agg(
            F.count("*").alias("size"), F.min(F.when(~F.col("probes"), F.col("mark"))).alias("hub"),
            F.min("mark").alias("_low"), F.max("mark").alias("_high"),
        ).where("hub IS NOT NULL AND _low <> _high").select(F.col("key").alias("k"), "size", "hub")
        live = staged(rows.join(groups, F.col("key") == F.col("k")).drop("k"), "refined-groups")
        few, many = live.where(F.col("size") <= CROWD), live.where(F.col("size") > CROWD)
        narrow = many.where("l - p - s = 0 OR (l - p - s = 1 AND NOT probes)").where("mark <> hub")
        stars = narrow.select(F.least("hub", "mark").alias("a"), F.greatest("hub", "mark").alias("b"))
        found = staged(found.unionByName(_pairs_at_keys(few)).unionByName(stars).distinct(), "crowd-pairs")
        level = many.where("l - p - s > 0").select("mark", "probes", "l", "p", "s").distinct()
        if level.isEmpty():
            return found


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From mark, probes, l, p, s, text: the keys of a beginning or an end that is longer by half of the window."""
    for batch in batches:
        out = []
        for mark, probes, size, p, s, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            window = size - p - s
            half = window // 2
            for q, t in ((p + max(half, 1), s), (p, s + window - half)):
                part = f"{size}:{q}:{t}:{text[:q]}\0{text[len(text) - t :]}"
                out.append((xxhash.xxh3_64_intdigest(part.encode()) - (1 << 63), mark, probes, size, q, t))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        types = [pa.int64(), pa.binary(), pa.bool_(), pa.int32(), pa.int32(), pa.int32()]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "mark", "probes", "l", "p", "s"])


def _crowd_pairs_by_length(crowded: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """All lines of crowds against each other by length; exact for any ``edits``, but as costly as its square."""
    lines = crowded.select(F.col("mark").alias("m")).distinct().join(texts, F.col("m") == F.col("mark"))
    left = lines.select(F.col("mark").alias("a"), F.length("text").alias("n"))
    lengths = F.sequence(F.length("text") - edits, F.length("text"))
    right = lines.select(F.col("mark").alias("b"), F.explode(lengths).alias("n"))
    pairs = left.join(right, "n").where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def repeated_lines(docs: DataFrame, edits: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row, line, near: lines to take out, that is all but the first of each class.

    A class is what equality and near equality connect. The first is that of the smallest id, then row, then line number.
    """
    lines = staged(line_table(docs, edits, id_col, text_col), "lines")
    links = near_lines(docs, lines, edits, text_col)
    groups = staged(components(links), "line-groups")
    marks = lines.select("id", "row", "line", "mark")
    classed = marks.join(groups, F.col("mark") == F.col("node"), "left")
    classed = classed.select("id", "row", "line", "mark", F.coalesce("component", "mark").alias("class"))
    place = F.struct("id", "row", "line")
    first = classed.groupBy("class").agg(F.min(F.struct(place.alias("place"), "mark")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("class").alias("c"), "first")
    again = classed.join(first, F.col("class") == F.col("c")).where(~place.eqNullSafe(F.col("first.place")))
    return again.select("id", "row", "line", (F.col("mark") != F.col("first.mark")).alias("near"))


def without(text: Column, lines: Column) -> Column:
    """The text without the lines of these numbers."""
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(lines, i))
    return F.when(lines.isNull(), text).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, edits: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and ``_removed``, ``_near``: how many went, and how many
    of them for a line that is not equal but near.

    The first line of each class stays. Blank lines are no repeats and stay. Null text stays
    null. Rows of one id and text count as one row and keep the same lines; a null id comes before others. Other
    columns are kept as they are; input columns named like the two counts are replaced.
    """
    again = repeated_lines(docs, edits, id_col, text_col)
    # a row that stands twice gives its lines twice, so they are made distinct
    gone = again.groupBy("row").agg(
        F.collect_set("line").alias("_lines"), F.count_distinct(F.when(F.col("near"), F.col("line"))).alias("_near")
    ).withColumnRenamed("row", "_of")
    # input columns travel as one, so that none is taken for a helper
    kept = [c for c in docs.columns if c not in ("_removed", "_near")]
    own = docs.select(F.struct(*kept).alias("_doc"), _row_mark(id_col, text_col).alias("_row"))
    joined = own.join(gone, F.col("_row") == F.col("_of"), "left")
    old = F.col("_doc").getField(text_col)
    text = F.when(old.isNotNull(), without(old, F.col("_lines")))
    removed = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    columns = [text.alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in kept]
    return joined.select(*columns, removed.alias("_removed"), F.coalesce("_near", F.lit(0)).alias("_near"))


def _row_mark(id_col: str, text_col: str) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_or_empty(text_col))))

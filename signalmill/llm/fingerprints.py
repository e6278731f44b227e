"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the smallest of its inner s-mers is its
first or its last. That depends on the k-mer alone, so an anchor survives any
edit outside of it. A fingerprint holds the anchors with the smallest hashes
and where in the text each first stands; two fingerprints match where the same
anchor stands at nearly the same place, seen from the start, from the end or after the shift that
most of their common anchors have made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import text_or_empty

K, S = 20, 6
ANCHORS = 48
#: An anchor may have moved by so many 256ths of the shorter text's length in code points.
MOVED = 16
#: Hex digits of an anchor's hash, and of a place or length.
_HASH, _PLACE = 8, 8

_P = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_P), n, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _joined(left: np.ndarray, right: np.ndarray, gap: int, size: int) -> np.ndarray:
    """Hashes of spans made of ``left`` and, ``gap`` code points later, ``right`` of ``size`` code points."""
    n = min(len(left), len(right) - gap)
    return left[:n] * _power(size) + right[gap : gap + n]


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and offsets of a text's closed syncmers, in the order of the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    two = _joined(codes, codes, 1, 1)
    four = _joined(two, two, 2, 2)
    inner = _mixed(_joined(four, two, 4, 2))  # 6 code points
    eight = _joined(four, four, 4, 4)
    whole = _joined(_joined(eight, eight, 8, 8), four, 16, 4)  # 20 code points
    span = K - S + 1
    least = inner
    for step in (1, 2, 4):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: -(span - 8)], least[span - 8 :])
    n = len(whole)
    at = np.flatnonzero((inner[:n] == least[:n]) | (inner[span - 1 : span - 1 + n] == least[:n]))
    return _mixed(whole[at]), at


def fingerprint(text: str) -> str:
    """Hex digits: 8 of the text's length, then per anchor 8 of its hash and 8 of its offset, by hash; empty for an empty text.

    Length and offsets are in code points.
    A text that is too short for an anchor is one anchor as a whole.
    """
    if not text:
        return ""
    hashes, at = anchors(text) if len(text) >= K else (np.empty(0, np.uint64), np.empty(0, np.int64))
    if not len(hashes):
        hashes = np.frombuffer(hashlib.blake2b(text.encode(), digest_size=8).digest(), dtype="<u8")
        at = np.zeros(1, np.int64)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * ANCHORS:  # the smallest are all that count
        few = short <= np.partition(short, 4 * ANCHORS - 1)[4 * ANCHORS - 1]
        short, at = short[few], at[few]
    values, first = np.unique(short, return_index=True)
    while len(values) < ANCHORS and len(hashes) > len(at):  # they were repeats of a few
        short, at = (hashes >> np.uint64(32)).astype(np.uint32), anchors(text)[1]
        values, first = np.unique(short, return_index=True)
    places = at[first[:ANCHORS]]
    return f"{len(text):08x}" + "".join(f"{h:08x}{p:08x}" for h, p in zip(values[:ANCHORS].tolist(), places.tolist(), strict=True))


def _read(mark: str) -> tuple[int, dict[int, int]]:
    """A fingerprint's length and the places of its anchors by hash."""
    size = _HASH + _PLACE
    places = {int(mark[i : i + _HASH], 16): int(mark[i + _HASH : i + size], 16) for i in range(_PLACE, len(mark), size)}
    return int(mark[:_PLACE] or "0", 16), places


def _main_shift(shifts: list[int], most: int) -> int:
    """The middle of the stretch of ``2 * most`` that holds the largest number of shifts."""
    shifts, best, at, j = sorted(shifts), 0, 0, 0
    for i, low in enumerate(shifts):
        while j < len(shifts) and shifts[j] <= low + 2 * most:
            j += 1
        if j - i > best:
            best, at = j - i, (low + shifts[j - 1]) // 2
    return at


def likeness(a: str, b: str) -> float:
    """Share of two texts' anchors that match, estimated from their fingerprints (0 to 1).

    Of the smallest hashes of both together, those in both at nearly the same place
    give the Jaccard index J of the anchors; the result is 2 J / (1 + J), the shared part of
    two texts of equal length. Equal fingerprints give 1, an empty one and another 0.

    Places agree if they differ by 0 (counted from the start), by the difference of the lengths (from the end) or by
    the common anchors' main shift, each within ``MOVED`` 256ths of the shorter text.
    """
    if a == b:
        return 1.0
    (n, left), (m, right) = _read(a), _read(b)
    full = [max(x) for x in (left, right) if len(x) == ANCHORS]
    union = sorted(left.keys() | right.keys())
    # beyond the largest hash of a full fingerprint, that text's anchors are not known
    union = [h for h in union if not full or h <= min(full)]
    shifts = [right[h] - left[h] for h in union if h in left and h in right]
    most = max(1, MOVED * min(n, m) // 256)
    allowed = (0, m - n, _main_shift(shifts, most))
    same = sum(any(abs(s - x) <= most for x in allowed) for s in shifts)
    return 2 * same / (len(union) + same) if union else 0.0


@dataclass(frozen=True)
class _Ranges:
    """Ranges of ids in descending order, where each range's followers come from, and the range that ends the order.

    The last range holds the null ids too. Without an id it holds all rows, and its own first row follows its last.
    """

    cuts: np.ndarray
    also: dict[int, int]
    last: int

    def number(self, ids: np.ndarray) -> np.ndarray:
        return len(self.cuts) - np.searchsorted(self.cuts, ids, side="right")


def _ranges(ids: DataFrame, parts: int) -> _Ranges:
    """Ranges of about equal size.

    Only one id per range comes to the driver. ``also`` maps the first id of a range to the
    range before it, whose last document it follows; the first of all follows the last.
    """
    steps = [i / parts for i in range(1, parts)] or [0.5]
    marks = ids.agg(F.percentile_approx("id", F.array(*map(F.lit, steps)), F.lit(max(1000, 20 * parts)))).first()[0]
    plain = _Ranges(np.unique(np.array(marks or [], dtype=np.int64)), {}, 0)
    number = F.pandas_udf(lambda s: pd.Series(plain.number(s.to_numpy(np.int64))), "int")
    tops = ids.where("id IS NOT NULL").groupBy(number("id").alias("part")).agg(F.max("id").alias("top")).collect()
    tops = sorted((r["part"], r["top"]) for r in tops)
    if not tops:
        return plain
    last = tops[-1][0]  # cuts may leave ranges empty, so not always the one below all cuts
    before = [last] + [p for p, _ in tops[:-1]]
    return _Ranges(plain.cuts, {top: b for b, (_, top) in zip(before, tops, strict=True)}, last)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, bool]:
    """Rows id, text, part, follows, so placed that each is followed by the next document, by descending id.

    Texts move once, into ranges of ids; a row with ``follows`` is a copy of the next range's first
    document and has no result of its own. Equal ids are ordered by text, null ids are last. If all ids are
    null (the second value), there are no copies, and the first row follows the last one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = _ranges(rows.select("id"), parts)

    @F.pandas_udf("array<struct<part:int,follows:boolean>>")
    def places(ids: pd.Series) -> pd.Series:
        own, also = ranges.number(ids.to_numpy(np.int64)).tolist(), map(ranges.also.get, ids.tolist())
        return pd.Series([[(p, False)] if a is None else [(p, False), (a, True)] for p, a in zip(own, also, strict=True)])

    # a null among them would turn a batch's ids into floating-point numbers
    known = places(F.coalesce("id", F.lit(0)))
    alone = F.array(F.struct(F.lit(ranges.last).alias("part"), F.lit(False).alias("follows")))
    placed = rows.select("id", "text", F.inline(F.when(F.col("id").isNull(), alone).otherwise(known)))
    order = ["part", "follows", F.col("id").desc_nulls_last(), "text"]
    return placed.repartition(parts, "part").sortWithinPartitions(*order), not ranges.also


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Ids are integers. The next document is that with the next smaller id; after the last comes the
    first. A document that is alone follows itself. Null text counts as empty. Rows with the same id follow
    each other by text, and null ids come last; other columns are ignored.
    """

    placed, ring = with_next(docs, id_col, text_col)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = first = None
        for batch in batches:
            out = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for number, text, part, follows in zip(*columns, strict=True):
                mark = fingerprint(text)
                if held is not None and held[2] == part:
                    out.append(_row(*held[:2], held[3], text, mark))
                # a copy may stand twice if its id does; only the first follows
                held = None if follows else (number, text, part, mark)
                first = first or held
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
        if ring and held is not None:
            yield pa.RecordBatch.from_pylist([_row(*held[:2], held[3], first[1], first[3])], schema=_SCHEMA)

    return placed.mapInArrow(walk, _SHAPE)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_SHAPE = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _row(number: int, text: str, mark: str, following: str, following_mark: str) -> dict:
    changed = edited(text, following)
    changed_mark = mark if changed == text else fingerprint(changed)
    return {
        "doc_id": number,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
        "fingerprint": mark,
        "edited_fingerprint": changed_mark,
        "near_edited": likeness(mark, changed_mark),
        "near_next": likeness(mark, following_mark),
    }

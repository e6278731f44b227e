"""Phrases that stand together more often than their parts would, by set-oriented mining of occurrence relations.

Level k is a relation of occurrences (piece, position, group) of phrases of k words, in order of
position. The next level is its merge join with itself on the same piece and adjacent positions. Groups are counted, and a semi-join
with those that are frequent takes out all other occurrences before the next join. Relations are written to the shared folder,
but for that of two words: it is the largest, and joining the first one once more costs less than keeping it.

The relation lies in blocks of texts, so that joining adjacent positions moves nothing. A break between two pieces takes a
position of its own; neighbours in position are thus neighbours in a piece. What travels is one entry per block and distinct group: entries
are dealt to shares by a hash of their group, packed, and counted share by share. The number of shares grows with that of the entries.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalmill.llm.blocks import pack, unpack
from signalmill.llm.common import staged, text_or_empty

#: A block is closed once it has this many words, or this many distinct ones.
BLOCK_WORDS, BLOCK_DISTINCT = 2_000_000, 300_000

#: A group of one block is numbered by the block (task and sequence) and its place there, in one long.
_PLACES, _SEQUENCES = 28, 12

#: Entries that are counted together.
SHARE_ENTRIES = 1_000_000

#: Texts are cut into words in slices of about this many bytes.
SLICE = 1 << 20

_UPPER = bytes(range(65, 91))
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_UPPER + b"\t" + _BREAKS, _UPPER.lower() + b" " + b"\n" * len(_BREAKS))
#: No text in UTF-8 holds this byte.
_BREAK = b"\xff"
_GAP = re.compile(rb"[ \n]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case words and breaks of a text in UTF-8, slice by slice."""
    plain = text.translate(_PLAIN)
    begin, size = 0, len(plain)
    while begin < size:
        end = begin + SLICE
        if end < size:
            end = max(plain.rfind(b" ", begin, end), plain.rfind(b"\n", begin, end)) + 1
            if end == 0:
                gap = _GAP.search(plain, begin + SLICE)
                end = gap.end() if gap else size
        yield plain[begin:end].replace(b"\n", b" \xff ").split()
        begin = end


class _Numbers(dict):
    """Numbers of one language's words; new words get the block's next number."""

    def __init__(self, lang: str, all_words: list[tuple[str, bytes]]) -> None:
        self.lang, self.all_words = lang, all_words
        self[_BREAK] = -1

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.all_words)
        self.all_words.append((self.lang, word))
        return number


class _Block:
    def __init__(self) -> None:
        self.words: list[tuple[str, bytes]] = []
        self.numbers: dict[str, _Numbers] = {}
        self.stream: list[np.ndarray] = []
        self.size = 0

    @property
    def full(self) -> bool:
        return self.size >= BLOCK_WORDS or len(self.words) >= BLOCK_DISTINCT

    def add(self, lang: str, words: list[bytes]) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(lang, self.words)
        self.stream.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def end_text(self) -> None:
        self.stream.append(np.array([-1], dtype=np.int32))

    def row(self, number: int) -> pa.RecordBatch:
        stream = np.concatenate(self.stream)
        at = np.flatnonzero(stream >= 0)
        group = stream[at]
        counts = np.bincount(group, minlength=len(self.words))
        langs, words = zip(*self.words, strict=True) if self.words else ((), ())
        columns = [
            pa.array([number], pa.int64()), pa.array([pack(np.diff(at, prepend=0), group)], pa.binary()),
            pa.array([langs], pa.list_(pa.string())), pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
            pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "packed", "lang", "word", "n"])


def _block_number(sequence: int) -> int:
    if sequence >= 1 << _SEQUENCES:
        raise OverflowError("a task has too many blocks; use more partitions")
    return (TaskContext.get().partitionId() << _SEQUENCES) + sequence


def occurrences(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The first relation, written once: block, packed (positions and words), and the block's distinct lang, word and count n."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sequence = _Block(), 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1), strict=True):
                for words in words_of(text.as_py()):
                    if block.full and _BREAK in words:
                        # a long text goes on in another block, from one piece to the next
                        cut = words.index(_BREAK)
                        block.add(lang, words[:cut])
                        yield block.row(_block_number(sequence))
                        block, sequence, words = _Block(), sequence + 1, words[cut:]
                    block.add(lang, words)
                block.end_text()
                if block.full:
                    yield block.row(_block_number(sequence))
                    block, sequence = _Block(), sequence + 1
        if block.words:
            yield block.row(_block_number(sequence))

    shape = "block long, packed binary, lang array<string>, word array<string>, n array<int>"
    return staged(rows.mapInArrow(gather, shape), "occurrences", "zstd")


def _shares(spark: SparkSession, entries: int) -> int:
    """Number of shares, of about ``SHARE_ENTRIES`` entries each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // SHARE_ENTRIES))


_DEALT = "share int, block long, lang string, words binary, numbers binary"
_DEALT_KINDS = [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]


def _dealt_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 5, _DEALT_KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["share", "block", "lang", "words", "numbers"])


def _parts(share: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each share with the places of its entries, in order."""
    order = np.argsort(share, kind="stable")
    begins = np.flatnonzero(np.diff(share[order], prepend=-1))
    for begin, end in zip(begins, [*begins[1:], len(order)], strict=False):
        yield int(share[order[begin]]), order[begin:end]


def _dealt_words(relation: DataFrame, shares: int) -> DataFrame:
    """Entries of single words by share: one row per block, language and share."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                langs = np.array(batch.column("lang")[row].as_py(), dtype=object)
                words = batch.column("word")[row].values.cast(pa.binary()).to_pylist()
                n = batch.column("n")[row].values.to_numpy()
                hashed = np.fromiter(map(crc32, words), np.uint32, len(words)) % shares
                out = []
                for share, places in _parts(hashed.astype(np.int64)):
                    for lang in sorted(set(langs[places])):
                        own = places[langs[places] == lang]
                        joined = _BREAK.join(words[i] for i in own)
                        out.append((share, batch.column("block")[row].as_py(), lang, compress(joined, 3), pack(np.diff(own, prepend=0), n[own])))
                yield _dealt_batch(out)

    return relation.select("block", "lang", "word", "n").mapInArrow(deal, _DEALT)


def _dealt_pairs(block: int, left: np.ndarray, right: np.ndarray, n: np.ndarray, shares: int) -> list[tuple]:
    """Entries of pairs of groups by share, in the order of their places in the block."""
    mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    out = []
    for share, own in _parts(((mixed >> np.uint64(33)) % np.uint64(shares)).astype(np.int64)):
        sides = [half for side in (left[own], right[own]) for half in _halves(side)]
        out.append((share, block, None, None, pack(np.diff(own, prepend=0), n[own], *sides)))
    return out


def _halves(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(numbers, dtype="<i8").view("<i4").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.stack([low, high], axis=1).astype("<i4").copy().view("<i8").ravel()


def _frequent(dealt: DataFrame, least: int) -> DataFrame:
    """Groups that occur ``least`` times or more over all blocks, in two kinds of rows.

    Rows with a block hold its frequent groups, as arrays of place and id. Rows without one hold the groups themselves:
    arrays of id, total f, and lang and word or left and right. A group's id is the number of its first entry.
    """
    shape = "block long, place array<int>, id array<long>, f array<long>, lang array<string>, word array<string>, left array<long>, right array<long>"
    names = [c.split()[0] for c in shape.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.string())] * 2, *[pa.list_(pa.int64())] * 2]

    def count(share: pa.Table) -> pa.Table:
        blocks, places, ns, keys = [], [], [], []
        for row in share.to_pylist():
            steps, n, *sides = unpack(row["numbers"])
            blocks.append(np.full(len(n), row["block"]))
            places.append(np.cumsum(steps, dtype=np.int64))
            ns.append(n.astype(np.int64))
            if row["words"] is None:
                keys.append([_whole(*sides[:2]), _whole(*sides[2:])])
            else:
                words = decompress(row["words"]).split(_BREAK)
                keys.append([np.full(len(n), row["lang"], dtype=object), np.array(words, dtype=object)])
        block, place = np.concatenate(blocks), np.concatenate(places)
        texts = keys[0][0].dtype == object
        sides = [pa.array(np.concatenate(side), pa.string() if texts and i == 0 else pa.binary() if texts else pa.int64()) for i, side in enumerate(zip(*keys, strict=True))]
        entries = pa.table({"a": sides[0], "b": sides[1], "n": np.concatenate(ns), "own": (block << _PLACES) + place, "block": block, "place": place})
        groups = entries.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum"), ("own", "min")])
        groups = groups.filter(pc.greater_equal(groups["n_sum"], least))
        if not groups.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        kept = entries.select(["a", "b", "block", "place"]).join(groups, ["a", "b"], join_type="inner", use_threads=False)
        block, place, ids = (kept[c].to_numpy() for c in ("block", "place", "own_min"))
        order = np.lexsort((place, block))
        block, place, ids = block[order], place[order], ids[order]
        begins = np.flatnonzero(np.diff(block, prepend=-1))
        ends = [*begins[1:], len(block)]
        spans = list(zip(begins, ends, strict=True))
        none = [None] * len(spans)
        own, a, b = groups["own_min"].to_pylist(), groups["a"].to_pylist(), groups["b"].to_pylist()
        f = groups["n_sum"].to_pylist()
        a_b = [a, [w.decode() for w in b], None, None] if texts else [None, None, a, b]
        columns = [
            [*block[begins].tolist(), None], [*[place[x:y] for x, y in spans], None], [*[ids[x:y] for x, y in spans], own],
            [*none, f], *[[*none, c] for c in a_b],
        ]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return staged(dealt.groupBy("share").applyInArrow(count, shape), "frequent", "zstd")


def _hits(frequent: DataFrame, level: int) -> DataFrame:
    return frequent.where("block IS NOT NULL").select(F.col("block").alias("of"), F.lit(level).alias("level"), "place", "id")


def _kept(at: np.ndarray, group: np.ndarray, hits: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Semi-join: positions and ids of the occurrences of frequent groups."""
    own = hits.filter(pc.equal(hits["level"], level))
    place = own["place"].combine_chunks().flatten().to_numpy()
    ids = own["id"].combine_chunks().flatten().to_numpy()
    known = np.full(max(int(group.max(initial=-1)), int(place.max(initial=-1))) + 1, -1, dtype=np.int64)
    known[place] = ids
    found = known[group]
    return at[found >= 0], found[found >= 0]


def _adjacent(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join: groups at adjacent positions. Position and pair of each, and the distinct pairs with their counts."""
    known, number = np.unique(ids, return_inverse=True)
    next_to = np.diff(at) == 1
    key = number[:-1][next_to].astype(np.int64) * len(known) + number[1:][next_to]
    pairs, pair, n = np.unique(key, return_inverse=True, return_counts=True)
    left, right = np.divmod(pairs, max(len(known), 1))
    return at[:-1][next_to], pair, known[left], known[right], n


def _met(relation: DataFrame, hits: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], shape: str) -> DataFrame:
    """Each block with what is frequent of it."""
    left = relation.select(F.col("block"), "packed").groupBy("block")
    return left.cogroup(hits.groupBy("of")).applyInArrow(use, shape)


def _dealt_second(relation: DataFrame, hits: DataFrame, shares: int) -> DataFrame:
    """Entries of adjacent frequent words by share."""

    def join(block: pa.Table, hits: pa.Table) -> pa.Table:
        out = []
        if block.num_rows and hits.num_rows:
            steps, group = unpack(block["packed"][0].as_py())
            _, _, left, right, n = _adjacent(*_kept(np.cumsum(steps, dtype=np.int64), group, hits, 1))
            out = _dealt_pairs(block["block"][0].as_py(), left, right, n, shares)
        return pa.Table.from_batches([_dealt_batch(out)])

    return _met(relation, hits, join, _DEALT)


def _joined(relation: DataFrame, hits: DataFrame, levels: list[int]) -> DataFrame:
    """The next relation, written once: semi-joins and merge joins of the ``levels`` one after the other.

    block, packed (positions and groups), and the block's distinct left group, right group and count n.
    """
    names, shape = ["block", "packed", "left", "right", "n"], "block long, packed binary, left array<long>, right array<long>, n array<int>"
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def join(block: pa.Table, hits: pa.Table) -> pa.Table:
        rows: list[list] = [[] for _ in names]
        if block.num_rows and hits.num_rows:
            steps, group = unpack(block["packed"][0].as_py())
            at = np.cumsum(steps, dtype=np.int64)
            for level in levels:
                at, group, left, right, n = _adjacent(*_kept(at, group, hits, level))
            if len(at):
                rows = [[block["block"][0].as_py()], [pack(np.diff(at, prepend=0), group)], [left], [right], [n]]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)

    return staged(_met(relation, hits, join, shape), "occurrences", "zstd")


def _dealt_later(relation: DataFrame, shares: int) -> DataFrame:
    """Entries of a written relation's groups by share."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right, n = (batch.column(c)[row].values.to_numpy() for c in ("left", "right", "n"))
                yield _dealt_batch(_dealt_pairs(batch.column("block")[row].as_py(), left, right, n, shares))

    return relation.select("block", "left", "right", "n").mapInArrow(deal, _DEALT)


def _named(frequent: DataFrame, shorter: DataFrame | None) -> DataFrame:
    """Each frequent group once: id, lang, phrase, last word, f, and f of its beginnings and endings by length.

    A group of the next level is made of two that overlap, so it takes its words from both.
    """
    columns = ["id", "f", "lang", "word"] if shorter is None else ["id", "f", "left", "right"]
    groups = frequent.where("block IS NULL").select(F.explode(F.arrays_zip(*columns)).alias("group"))
    once = groups.select(*[f"group.{c}" for c in columns])
    if shorter is None:
        none = F.array().cast("array<long>")
        return staged(
            once.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("begins"), none.alias("ends")),
            "phrases",
        )
    a, b = (shorter.select(*[F.col(c).alias(f"{side}_{c}") for c in shorter.columns]) for side in "ab")
    met = once.select("id", "f", "left", "right").join(a, F.col("left") == F.col("a_id")).join(b, F.col("right") == F.col("b_id"))
    return staged(
        met.select(
            "id", F.col("a_lang").alias("lang"), F.concat_ws(" ", "a_phrase", "b_last").alias("phrase"), F.col("b_last").alias("last"),
            "f", F.concat("a_begins", F.array("a_f")).alias("begins"), F.concat("b_ends", F.array("b_f")).alias("ends"), "left", "right",
        ),
        "phrases",
    )


def _weakest_cut(words: int, a: Column, n: Column) -> Column:
    """score, k, l and r of the cut with the lowest score; the first of equal ones."""
    top = a.cast("decimal(13,0)") * n.cast("decimal(16,0)") * F.lit(1000).cast("decimal(4,0)")
    cuts = []
    for k in range(1, words):
        l, r = F.get("begins", F.lit(k - 1)), F.get("ends", F.lit(words - k - 1))  # noqa: E741
        bottom = l.cast("decimal(13,0)") * r.cast("decimal(13,0)")
        score = F.call_function("div", top, bottom).cast("long")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``longest`` words and occur ``least`` times or more within pieces, overlaps included. A phrase
    inside a longer one that occurs as often is left out; such a phrase always lies in one that is a single word longer.

    A null text is empty and a null language is ``und``; texts without words add nothing. Repeated rows count again, an empty
    table gives no row, and other columns are ignored. Equal scores are in order of falling a, then of the phrase's bytes.
    """
    if longest < 2:
        raise ValueError("phrases have two words at least")
    spark = docs.sparkSession
    words = occurrences(docs, lang_col, text_col)
    size = words.agg(F.sum(F.size("n")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    frequent = _frequent(_dealt_words(words, _shares(spark, size[0] or 0)), least)
    named, hits, relation, levels = _named(frequent, None), _hits(frequent, 1), words, []
    for k in range(2, longest + 1):
        if k == 2:
            dealt = _dealt_second(words, hits, _shares(spark, size[1] or 0))
        else:
            relation = _joined(relation, hits, [1, 2] if k == 3 else [k - 1])
            dealt = _dealt_later(relation, _shares(spark, relation.agg(F.sum(F.size("n"))).first()[0] or 0))
        frequent = _frequent(dealt, least)
        hits = hits.unionByName(_hits(frequent, 2)) if k == 2 else _hits(frequent, k)
        named = _named(frequent, named)
        levels.append(named)
    counted = words.select(F.explode(F.arrays_zip("lang", "n")).alias("word")).select("word.lang", "word.n")
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    kept = []
    for words, (level, longer) in enumerate(zip(levels, [*levels[1:], None], strict=True), 2):
        if longer is not None:
            sides = longer.select("f", F.explode(F.array("left", "right")).alias("part"))
            around = sides.groupBy("part").agg(F.max("f").alias("around"))
            level = level.join(around, F.col("id") == F.col("part"), "left").where("coalesce(around, 0) < f")
        best = _weakest_cut(words, F.col("f"), F.col("n"))
        kept.append(level.join(sizes, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", best.alias("cut")))
    scored = reduce(DataFrame.unionByName, kept).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
    return _leading(scored, top)


def _leading(scored: DataFrame, top: int) -> DataFrame:
    """The first phrases of each language; first among those of each share of its phrases, so that none is sorted as a whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    among = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    first = scored.withColumn("share", share).withColumn("among", among).where(F.col("among") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = first.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

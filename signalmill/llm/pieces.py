"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece can cross, and each distinct unit is encoded
once. Its substrings up to the longest piece are joined to the piece table; the
matches are the edges of its lattice. Edges are gathered by unit and folded by Spark's
higher-order ``aggregate``: by Viterbi for a unigram model, and for a BPE
model, whose result is not the best path, by merging the best-ranked pair again and again.
The ids then come back to the blocks of texts, where they are put in line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.llm.blocks import BLOCK_WORDS, blocks_of, finish, pack, packed_by_block, terms_of, unpack, unpacked
from signalmill.llm.common import bound

SPACE = "▁"
#: Units up to this length are folded in SQL with one long as the set of boundaries; the few longer
#: ones, which would cost the square of their length, are merged from a heap with the same result.
FOLDED = 40
#: Code points below this, the Latin ones, are told by a table within the row; others by edges.
PLAIN = 0x250
#: Texts are numbered together once they have about so many bytes.
BATCH_BYTES = 2_000_000
#: Ids of texts with about so many units are put in line together.
AT_ONCE = 100_000


@dataclass(frozen=True)
class Pieces:
    """A model's piece table: ordinary pieces with ids and scores, ids of the 256 bytes, and the kind of model."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]
    kind: str = "bpe"

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    @property
    def pairs(self) -> set[str]:
        """Neighbouring characters inside any piece; between others lies a certain boundary."""
        return {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}


@lru_cache(maxsize=4)
def load_pieces(path: str) -> Pieces:
    """The piece table of a SentencePiece model that keeps blanks, marks them and falls back to bytes."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    normal, trainer = model.normalizer_spec, model.trainer_spec
    plain = normal.name == "identity" and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
    if not plain or not trainer.byte_fallback or trainer.model_type not in (1, 2):
        raise ValueError("needs a unigram or BPE model with plain normalization, a leading blank and byte fallback")
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    bytes_at = tuple(pieces.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    ordinary = [p for p in enumerate(model.pieces) if p[1].type == 1]
    return Pieces(
        {p.piece: i for i, p in ordinary}, {p.piece: p.score for _, p in ordinary}, bytes_at,
        "bpe" if trainer.model_type == 2 else "unigram",
    )


class _Pairs:
    """Which characters may stand side by side within a piece, told for many at once."""

    def __init__(self, pairs: set[str]) -> None:
        signs = sorted({c for p in pairs for c in p})
        self.number = np.zeros(0x110000, dtype=np.int32)
        self.number[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.inside = np.zeros((len(signs) + 1, len(signs) + 1), dtype=bool)
        for first, second in pairs:
            self.inside[self.number[ord(first)], self.number[ord(second)]] = True

    def cut(self, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Cuts words of at least one character at their certain boundaries: the number of units of each, and all units."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        text = words.buffers()[2][offsets[0] : offsets[-1]].to_pybytes().decode().replace(" ", SPACE)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        begins = np.cumsum(sizes) - sizes
        signs = self.number[codes]
        begun = np.ones(len(codes), dtype=bool)
        begun[1:] = ~self.inside[signs[:-1], signs[1:]]
        begun[begins] = True
        widths = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
        ends = np.cumsum(widths, dtype=np.int32)
        units = strings_at(np.append((ends - widths)[begun], ends[-1]), text.encode())
        return np.add.reduceat(begun, begins, dtype=np.int32), units


def strings_at(cuts: np.ndarray, data: bytes) -> pa.Array:
    """The strings between neighbouring cuts of UTF-8 bytes."""
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))


def units_of(word: str, pairs: set[str]) -> list[str]:
    """Cuts a word at its certain boundaries."""
    return _Pairs(pairs).cut(pa.array([word]))[1].to_pylist() if word else [word]


class _Streams:
    """The block of texts as streams of unit numbers, frequent units first.

    Texts are cut into words, which begin at runs of blanks and, if no piece holds them, at new lines. Words
    and units are numbered as Arrow strings; none is ever an object of its own, but the long ones.
    """

    def __init__(self, path: str) -> None:
        self.pieces = load_pieces(path)
        self.by_hand = merge_long if self.pieces.kind == "bpe" else path_long
        self.pairs = _pairs_of(path)
        self.breaks = not any("\n" in p for p in self.pieces.ids)
        self.words = pa.array([], pa.string())
        #: Numbers of all words, batch by batch, and how many each text has.
        self.numbers: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.hashes: list[bytes] = []

    def add(self, text: str) -> None:
        raw = text.encode()
        self.hashes.append(hashlib.sha256(raw).digest())
        self.waiting.append(b" " + raw if raw else raw)
        self.waiting_bytes += len(raw)
        if self.waiting_bytes >= BATCH_BYTES:
            self._number()

    def _number(self) -> None:
        """Numbers the words of the texts that wait."""
        ends = np.cumsum([0, *map(len, self.waiting)])
        data = b"".join(self.waiting)
        self.waiting, self.waiting_bytes = [], 0
        signs = np.frombuffer(data, np.uint8)
        begun = signs == 32
        begun[1:] &= signs[:-1] != 32
        if self.breaks:
            lines = signs == 10
            begun |= lines
            begun[1:] |= lines[:-1]
        begun[ends[:-1][np.diff(ends) > 0]] = True
        cuts = np.append(np.flatnonzero(begun), len(data))
        found = strings_at(cuts, data).dictionary_encode()
        self.words = pc.unique(pa.concat_arrays([self.words, found.dictionary]))  # known ones keep their numbers
        number = pc.index_in(found.dictionary, value_set=self.words).to_numpy(zero_copy_only=False).astype(np.int32)
        self.numbers.append(number[found.indices.to_numpy()])
        self.sizes.append(np.diff(np.searchsorted(cuts[:-1], ends)))

    def full(self) -> bool:
        return len(self.words) >= BLOCK_WORDS

    def packed(self) -> tuple[bytes, pa.Array]:
        # forms of a block give way one by one, so that no two are held at once
        self._number()
        cut = [self.pairs.cut(self.words.slice(at, 50_000)) for at in range(0, len(self.words), 50_000)]
        self.words = pa.array([], pa.string())
        lengths = np.concatenate([np.empty(0, np.int32), *(n for n, _ in cut)])
        units = pa.chunked_array([u for _, u in cut], pa.string()).dictionary_encode().combine_chunks()
        del cut
        terms, flat = units.dictionary, units.indices.to_numpy()
        del units
        begins = np.cumsum(lengths, dtype=np.int32) - lengths
        per_batch = [int(lengths[x].sum()) for x in self.numbers]
        stream, used = np.empty(sum(per_batch), dtype=np.int32), np.zeros(len(terms), dtype=np.int64)
        per_doc, end = [np.empty(0, np.int64)], 0
        self.numbers.reverse()
        for sizes, size in zip(self.sizes, per_batch, strict=True):
            words, end = self.numbers.pop(), end + size
            own = lengths[words]
            per_doc.append(np.diff(np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(sizes)])]))
            stream[end - size : end] = flat[_spread(begins[words], own)]
        per_doc = np.concatenate(per_doc)
        del flat, begins, lengths
        for part in _chunks(stream):
            used += np.bincount(part, minlength=len(terms))
        by_use = np.argsort(-used, kind="stable").astype(np.int32)
        rank = np.empty(len(terms), dtype=np.int32)
        rank[by_use] = np.arange(len(terms), dtype=np.int32)
        # neighbours with a common beginning compress well; long units come last and are encoded here
        order, is_long = pc.array_sort_indices(terms).to_numpy(), pc.greater(pc.utf8_length(terms), FOLDED).to_numpy(zero_copy_only=False)
        order = np.concatenate([order[~is_long[order]], order[is_long[order]]])
        place = np.empty(len(terms), dtype=np.int32)
        place[order] = np.arange(len(terms), dtype=np.int32)
        terms, first_long = terms.take(pa.array(order)), len(terms) - int(is_long.sum())
        encoded = [self.by_hand(u, self.pieces) for u in terms.slice(first_long).to_pylist()]
        for part in _chunks(stream):
            part[:] = rank[part]
        planes = np.empty(4 * stream.size, dtype=np.uint8)
        for k in range(4):  # low bytes first, then the next
            planes[k * stream.size : (k + 1) * stream.size] = stream.astype("<i4", copy=False).view(np.uint8)[k::4]
        del stream
        marks = np.frombuffer(b"".join(self.hashes), dtype="<i4")
        return pack(
            per_doc, place[by_use], marks, [len(x) for x in encoded], [i for x in encoded for i in x], planes.view("<i4")
        ), terms.slice(0, first_long)


@lru_cache(maxsize=4)
def _pairs_of(path: str) -> _Pairs:
    return _Pairs(load_pieces(path).pairs)


def _chunks(numbers: np.ndarray) -> list[np.ndarray]:
    """Views of an array, small enough that a copy of one does not count."""
    return [numbers[at : at + 500_000] for at in range(0, len(numbers), 500_000)]


def _spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all runs that begin at ``begins``, one run after another."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """piece, id, score as a table; as large as the model's vocabulary, whatever the data."""
    rows = [(p, i, float(pieces.scores[p])) for p, i in pieces.ids.items()]
    table = pa.table({"piece": [r[0] for r in rows], "id": pa.array([r[1] for r in rows], pa.int32()), "score": [r[2] for r in rows]})
    return spark.createDataFrame(table)


def lattice(units: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """unit, n, edges: every substring that is a piece, as struct<cost, s, t, id> from s to t, cheapest first.

    Single characters that :func:`plain_ids` knows have no edge.
    """
    # grouping compares the number first, which is cheaper than the unit
    numbered = units.select(F.xxhash64("unit").alias("key"), "unit", F.length("unit").alias("n"))
    starts = numbered.select("key", "unit", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("at"))
    most = F.least(F.lit(longest), F.col("n") - F.col("at") + 1)
    # a single character has no edge if it is told by a table; each unit keeps its first one, and so a row
    alone = (F.col("at") == 1) | (F.ascii(F.substring("unit", F.col("at"), F.lit(1))) >= PLAIN)
    least = F.when(alone, 1).otherwise(2)
    spans = starts.where(alone | (most > 1)).select("key", "unit", "n", "at", F.explode(F.sequence(least, most)).alias("size"))
    named = spans.withColumn("piece", F.substring("unit", F.col("at"), F.col("size")))
    # the piece table is bounded by the model's vocabulary
    edges = named.join(F.broadcast(table), "piece", "left")
    told = F.col("id").isNotNull() & ((F.col("size") > 1) | (F.ascii("piece") >= PLAIN))
    edges = edges.where(told | ((F.col("at") == 1) & (F.col("size") == 1)))  # each unit keeps a row
    begin = F.col("at") - 1
    edge = F.struct(
        (-F.col("score")).alias("cost"), begin.alias("s"), (begin + F.col("size")).alias("t"), F.col("id").alias("id")
    )
    return edges.groupBy("key", "unit", "n").agg(F.sort_array(F.collect_list(F.when(told, edge))).alias("edges"))


def plain_ids(pieces: Pieces) -> Column:
    """Ids of the pieces of one character, by code point, for the first ``PLAIN`` code points; null for others."""
    return F.array(*[F.lit(pieces.ids.get(chr(c))).cast("int") for c in range(PLAIN)])


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def _span(e: Column) -> Column:
    """Bits of an edge's boundaries and of all between them."""
    return (_bit(e["t"] + 1) - 1) - (_bit(e["s"]) - 1)


def merged(edges: Column, n: Column) -> Column:
    """Boundaries that BPE leaves in a unit of n characters, as bits of a long.

    In each step the cheapest edge that joins exactly two neighbouring symbols, the leftmost of
    equal ones, loses the boundary inside it.
    """
    spans = F.transform(
        F.filter(edges, lambda e: e["t"] - e["s"] > 1),
        lambda e: F.struct(_span(e).alias("all"), (_bit(e["s"]) + _bit(e["t"])).alias("ends")),
    )

    def fold(spans: Column) -> Column:
        def step(cuts: Column, _: Column) -> Column:
            def joins(e: Column) -> Column:
                inside = cuts.bitwiseAND(e["all"])
                return (F.bit_count(inside) == 3) & (inside.bitwiseAND(e["ends"]) == e["ends"])

            def drop(found: Column) -> Column:
                best = F.get(found, F.lit(0))
                kept = cuts.bitwiseAND(F.bitwise_not(best["all"])).bitwiseOR(best["ends"])
                return F.when(best.isNull(), cuts).otherwise(kept)

            return bound(F.filter(spans, joins), drop)

        steps = F.when(F.size(spans) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), n))
        return F.aggregate(steps, _bit(n + 1) - 1, step)

    return bound(spans, fold)


def viterbi(unit: Column, edges: Column, n: Column, pieces: Pieces) -> Column:
    """Boundaries of the cheapest path through a unit's lattice, as bits of a long.

    A character that is no piece costs 10 more than the dearest piece. Of equal paths, that whose last edge is
    longest wins.
    """
    none = F.struct(F.lit(0.0).alias("cost"), F.lit(1).cast("long").alias("cuts"))
    unknown = _unknown(pieces)
    plain = F.array(*[F.lit(float(-pieces.scores.get(chr(c), -unknown))) for c in range(PLAIN)])

    def reach(best: Column, end: Column) -> Column:
        def over(e: Column) -> Column:
            before = F.get(best, e["s"])
            return F.struct((before["cost"] + e["cost"]).alias("cost"), e["s"].alias("s"), before["cuts"].alias("cuts"))

        cost = F.coalesce(F.get(plain, F.ascii(F.substring(unit, end, F.lit(1)))), F.lit(unknown))
        alone = F.struct(cost.alias("cost"), (end - 1).alias("s"), end.alias("t"), F.lit(None).cast("int").alias("id"))
        into = F.filter(edges, lambda e: e["t"] == end)
        into = bound(into, lambda x: F.when(F.exists(x, lambda e: e["s"] == end - 1), x).otherwise(F.concat(x, F.array(alone))))
        cheapest = F.array_min(F.transform(into, over))
        at = bound(cheapest, lambda c: F.struct(c["cost"].alias("cost"), c["cuts"].bitwiseOR(_bit(end)).alias("cuts")))
        return F.concat(best, F.array(at))

    paths = F.aggregate(F.sequence(F.lit(1), n), F.array(none), reach)
    return F.get(paths, n)["cuts"]


def _unknown(pieces: Pieces) -> float:
    return 10.0 - min(pieces.scores.values(), default=0.0)


def ids_between(unit: Column, edges: Column, cuts: Column, pieces: Pieces) -> Column:
    """Ids of the pieces between the boundaries; a character that is no piece gives its bytes."""
    starts = F.filter(F.sequence(F.lit(0), F.length(unit) - 1), lambda i: cuts.bitwiseAND(_bit(i)) != 0)
    used = F.filter(edges, lambda e: cuts.bitwiseAND(_span(e)) == _bit(e["s"]) + _bit(e["t"]))
    of_bytes, plain = F.array(*map(F.lit, pieces.byte_ids)), plain_ids(pieces)

    def alone(i: Column) -> Column:
        sign = F.substring(unit, i + 1, F.lit(1))
        raw = F.encode(sign, "UTF-8")
        codes = F.sequence(F.lit(1), F.octet_length(raw))
        spelled = F.transform(codes, lambda k: F.get(of_bytes, F.conv(F.hex(F.substring(raw, k, F.lit(1))), 16, 10).cast("int")))
        known = F.get(plain, F.ascii(sign))
        return F.when(known.isNotNull(), F.array(known)).otherwise(spelled)

    def ids(used: Column) -> Column:
        def at(i: Column) -> Column:
            found = F.filter(used, lambda e: e["s"] == i)
            return bound(found, lambda f: F.when(F.size(f) > 0, F.array(F.get(f, F.lit(0))["id"])).otherwise(alone(i)))

        return F.flatten(F.transform(starts, at))

    return bound(used, ids)


def encoded_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """unit, ids for distinct units of at most ``FOLDED`` characters; each is encoded by itself."""
    short = lattice(units, piece_table(units.sparkSession, pieces), pieces.longest)
    unit, edges, n = F.col("unit"), F.col("edges"), F.col("n")
    cuts = merged(edges, n) if pieces.kind == "bpe" else viterbi(unit, edges, n, pieces)
    return short.withColumn("cuts", cuts).select("unit", ids_between(unit, edges, F.col("cuts"), pieces).alias("ids"))


def _named(parts: list[str], pieces: Pieces) -> list[int]:
    out: list[int] = []
    for p in parts:
        found = pieces.ids.get(p)
        out.extend([pieces.byte_ids[b] for b in p.encode()] if found is None else [found])
    return out


def merge_long(unit: str, pieces: Pieces) -> list[int]:
    """BPE of one long unit from a heap of neighbouring pairs."""
    import heapq

    n = len(unit)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b < n and (p := unit[a : end[b]]) in pieces.ids:
            heapq.heappush(heap, (-pieces.scores[p], a, b, end[b]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if end[a] != b or end[b] != stop:
            continue
        end[a], end[b] = stop, -1
        if stop < n:
            before[stop] = a
        offer(before[a], a)
        if stop < n:
            offer(a, stop)
    starts = [0]
    while end[starts[-1]] < n:
        starts.append(end[starts[-1]])
    return _named([unit[s : end[s]] for s in starts], pieces)


def path_long(unit: str, pieces: Pieces) -> list[int]:
    """Viterbi of one long unit."""
    unknown = _unknown(pieces)
    best: list[tuple[float, int]] = [(0.0, 0)]
    for t in range(1, len(unit) + 1):
        options = []
        for s in range(max(0, t - pieces.longest), t):
            score = pieces.scores.get(unit[s:t])
            if score is not None or s == t - 1:
                options.append((best[s][0] + (unknown if score is None else -score), s))
        best.append(min(options))
    parts, t = [], len(unit)
    while t:
        parts.append(unit[best[t][1] : t])
        t = best[t][1]
    return _named(parts[::-1], pieces)


def decode(ids: Sequence[int], pieces: Pieces) -> str:
    """The text of ids: pieces in line, bytes put together, the leading blank taken off."""
    return _decoder(pieces)(ids)


def _bytes_of(pieces: Pieces) -> list[bytes]:
    spelled = [b""] * (max([*pieces.ids.values(), *pieces.byte_ids], default=0) + 1)
    for p, i in pieces.ids.items():
        spelled[i] = p.replace(SPACE, " ").encode()
    for b, i in enumerate(pieces.byte_ids):
        spelled[i] = bytes([b])
    return spelled


@lru_cache(maxsize=4)
def _spelled(path: str) -> pa.Array:
    """The bytes of each id."""
    return pa.array(_bytes_of(load_pieces(path)), pa.binary())


def _decoder(pieces: Pieces):
    spelled = _bytes_of(pieces)
    return lambda ids: b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")[1:]


def decoded(pieces_path: str, ids: Column | str) -> Column:
    """The text of an array of ids."""

    @F.pandas_udf("string")
    def texts(values: pd.Series) -> pd.Series:
        text = _decoder(load_pieces(pieces_path))
        return values.map(lambda v: None if v is None else text(v.tolist()))

    return texts(ids)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, n_ids, n_byte_ids, ids_sha256, round_trip.

    ``path`` names a SentencePiece model that every executor has. ``ids`` are those of the
    library without begin and end; ``ids_sha256`` is over them as 4-byte little-endian numbers; ``round_trip`` says
    whether decoding them gives the text again.

    Null and empty texts have no ids. Repeated rows and null ids are encoded row by row; other columns
    are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    pieces = load_pieces(path)
    blocks = blocks_of(docs, lambda: _Streams(path), id_col, text_col)
    # Terms are dealt out once: they are made distinct, encoded and joined back where they are. No term is hot, as
    # it has a row per block. The two minima make both readers of the exchange ask for the same columns.
    terms = terms_of(blocks).repartition("term")
    distinct = terms.groupBy("term").agg(F.min("block").alias("b"), F.min("place").alias("p")).where("b >= 0 AND p >= 0")
    values = encoded_units(distinct.select(F.col("term").alias("unit")), pieces)
    # as bytes, which are half of an array's row
    width = 2 if max([*pieces.ids.values(), *pieces.byte_ids]) < 1 << 16 else 4
    digits = F.transform("ids", lambda i: F.lpad(F.hex(i), 2 * width, "0"))
    values = values.select("unit", F.unhex(F.array_join(digits, "")).alias("ids"))
    valued = packed_by_block(terms.join(values, F.col("term") == F.col("unit")).select("block", "place", "ids"))

    def line_up(block: dict, values: pa.Table) -> pa.Table:
        per_doc, places, marks, long_sizes, long_flat, planes = unpack(block["packed"])
        n = int(per_doc.sum())
        planes = planes.view(np.uint8)[: 4 * n].reshape(4, n)
        where, found, data = unpacked(values)
        found, flat = found // width, np.frombuffer(data, f">u{width}").astype(np.int32)
        at, sizes = np.zeros((2, len(places)), dtype=np.int32)
        at[where], sizes[where] = np.cumsum(found) - found, found
        first_long = len(places) - len(long_sizes)
        at[first_long:] = len(flat) + np.cumsum(long_sizes) - long_sizes
        sizes[first_long:] = long_sizes
        flat = np.concatenate([flat, long_flat])
        hashes, spelled = marks.tobytes(), _spelled(path)
        in_byte = np.zeros(len(spelled), dtype=np.int64)
        in_byte[list(pieces.byte_ids)] = 1
        ids, counts, in_bytes, digests, same = [], [], [], [], []
        ends = np.cumsum([0, *per_doc])
        doc = 0
        while doc < len(per_doc):  # some texts at a time
            last = max(int(np.searchsorted(ends, ends[doc] + AT_ONCE, "right")) - 1, doc + 1)
            own = np.ascontiguousarray(planes[:, ends[doc] : ends[last]].T).view("<i4").ravel()
            unit = places[own]
            mine = flat[_spread(at[unit], sizes[unit])].astype(np.int32)
            cuts = np.concatenate([[0], np.cumsum(sizes[unit])])[ends[doc : last + 1] - ends[doc]]
            ids.append(mine)
            counts.extend(np.diff(cuts).tolist())
            in_bytes.extend(np.diff(np.concatenate([[0], np.cumsum(in_byte[mine])])[cuts]).tolist())
            texts = spelled.take(pa.array(mine))
            raw = memoryview(texts.buffers()[2] or b"")
            marked = np.frombuffer(texts.buffers()[1], np.int32)[cuts].tolist() if len(mine) else [0] * len(cuts)
            numbers, cuts = memoryview(mine.astype("<i4").tobytes()), cuts.tolist()
            for i in range(last - doc):
                digests.append(hashlib.sha256(numbers[4 * cuts[i] : 4 * cuts[i + 1]]).hexdigest())
                again = hashlib.sha256(raw[marked[i] : marked[i + 1]][1:]).digest()  # without the leading blank
                same.append(again == hashes[32 * (doc + i) : 32 * (doc + i + 1)])
            doc = last
        ends = np.cumsum([0, *counts])
        ids_array = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
        doc_ids = pa.array(block["ids"], type={"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(id_type))
        columns = [doc_ids, ids_array, pa.array(counts, pa.int64()), pa.array(in_bytes, pa.int64()), pa.array(digests), pa.array(same)]
        return pa.table(columns, names=["doc_id", "ids", "n_ids", "n_byte_ids", "ids_sha256", "round_trip"])

    shape = f"doc_id {id_type}, ids array<int>, n_ids long, n_byte_ids long, ids_sha256 string, round_trip boolean"
    return finish(blocks, valued, line_up, shape)

"""Work once per distinct term, for texts that stay where they were read.

Texts are gathered into blocks of bounded size. A block keeps its texts as
packed numbers and lists its distinct terms once. Only the terms travel: they
are made distinct over all blocks, valued, and joined back to each block. A
term that occurs in every text is one row per block, so none is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import bucketed, text_or_empty

#: A block is closed once its texts have this many characters, or its form says that it is full.
BLOCK_CHARS = 12_000_000
#: Forms that number their words are full with so many distinct ones, however short the texts.
BLOCK_WORDS = 400_000

#: So many values are put together by block before they travel.
PACKED_ROWS = 300_000

_CODEC = "zstd"


class Block(Protocol):
    def add(self, text: str) -> None: ...

    def full(self) -> bool: ...

    def packed(self) -> tuple[bytes, pa.Array]:
        """What the texts become, and the distinct terms by number."""


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed bytes."""
    plain = np.concatenate([[len(arrays), *map(len, arrays)], *arrays], dtype="<i4", casting="unsafe")
    return plain.nbytes.to_bytes(8, "little") + pa.compress(plain, codec=_CODEC, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec=_CODEC, asbytes=True)
    numbers = np.frombuffer(plain, dtype="<i4")
    ends = np.cumsum(numbers[1 : numbers[0] + 1]) + numbers[0] + 1
    return [numbers[a:b] for a, b in zip([numbers[0] + 1, *ends[:-1]], ends, strict=True)]


def blocks_of(docs: DataFrame, make: Callable[[], Block], id_col: str, text_col: str) -> DataFrame:
    """Table of blocks: block, ids, packed, terms; written once, bucketed by block.

    Bucketing lets values come to the blocks without moving the blocks.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kind = TaskContext.get().partitionId() << 32, pa.null()
        block, ids, chars = make(), [], 0
        for batch in batches:
            batch_ids, kind = batch.column(0).to_pylist(), batch.schema.field(0).type
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                block.add(text)
                ids.append(batch_ids[i])
                chars += len(text)
                if chars >= BLOCK_CHARS or block.full():
                    yield _row(number, ids, block, kind)
                    number, block, ids, chars = number + 1, make(), [], 0
                    pa.default_memory_pool().release_unused()
        if ids:
            yield _row(number, ids, block, kind)

    shape = f"block long, ids array<{id_type}>, packed binary, terms array<string>"
    made = rows.mapInArrow(gather, shape)
    return bucketed(made, "block", "blocks")


def _row(number: int, ids: list, block: Block, kind: pa.DataType) -> pa.RecordBatch:
    packed, terms = block.packed()
    columns = [
        pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)),
        pa.array([packed], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "packed", "terms"])


def terms_of(blocks: DataFrame) -> DataFrame:
    """block, place, term: the distinct terms of each block."""
    return blocks.select("block", F.posexplode("terms").alias("place", "term"))


def dealt_terms(blocks: DataFrame) -> DataFrame:
    """As :func:`terms_of`, with equal terms in one task and one after another; no term is hot, as it has a row per block."""
    return terms_of(blocks).repartition("term").sortWithinPartitions("term")


def packed_by_block(valued: DataFrame) -> DataFrame:
    """block, places, sizes, data: the bytes (third column) of many places of a block in one row.

    ``valued`` has block, place and bytes. Rows are put together as they come, ``PACKED_ROWS`` at a time, so that few and
    small ones travel to the blocks, and none has to be sorted there.
    """

    def put(rows: pa.Table) -> pa.RecordBatch:
        block, place = rows["block"].to_numpy(), rows["place"].to_numpy()
        order = np.lexsort((place, block))
        block, place = block[order], place[order]
        found = rows.column(2).combine_chunks().take(pa.array(order))
        ends = np.frombuffer(found.buffers()[1], "<i4")[found.offset : found.offset + len(found) + 1]
        data, sizes = memoryview(found.buffers()[2]), np.diff(ends)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        runs = list(zip(cuts[:-1], cuts[1:], strict=True))
        columns = [
            pa.array(block[cuts[:-1]]),
            pa.array([pack(np.diff(place[a:b], prepend=0)) for a, b in runs], pa.binary()),
            pa.array([pack(sizes[a:b]) for a, b in runs], pa.binary()),
            pa.array([_squeezed(data[ends[a] : ends[b]]) for a, b in runs], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "places", "sizes", "data"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PACKED_ROWS:
                yield put(pa.Table.from_batches(held))
                held, n = [], 0
        if held:
            yield put(pa.Table.from_batches(held))
        pa.default_memory_pool().release_unused()

    return valued.mapInArrow(gather, "block long, places binary, sizes binary, data binary")


def unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Places, sizes in bytes, and bytes of all rows that :func:`packed_by_block` made of a block."""
    places, sizes, data = [np.empty(0, np.int32)], [np.empty(0, np.int32)], []
    for gaps, own, held in zip(*(rows[c].to_pylist() for c in ("places", "sizes", "data")), strict=True):
        places.append(np.cumsum(unpack(gaps)[0], dtype=np.int32))
        sizes.append(unpack(own)[0])
        data.append(pa.decompress(held[8:], int.from_bytes(held[:8], "little"), codec=_CODEC, asbytes=True))
    return np.concatenate(places), np.concatenate(sizes), b"".join(data)


def _squeezed(data: memoryview) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec=_CODEC, asbytes=True)


def finish(
    blocks: DataFrame,
    valued: DataFrame,
    use: Callable[[dict, pa.Table], pa.Table],
    shape: str,
) -> DataFrame:
    """Brings the values of its terms to each block.

    ``valued`` has block, place and further columns. ``use`` gets a block's row
    and its values, and makes the rows of its texts.
    """

    def meet(block: pa.Table, values: pa.Table) -> pa.Table:
        return use(block.to_pylist()[0], values)

    left = blocks.select(F.col("block").alias("own"), "ids", "packed").groupBy("own")
    return left.cogroup(valued.groupBy("block")).applyInArrow(meet, shape)

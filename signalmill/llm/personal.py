"""Personal data: fixed patterns, and spans that a semi-Markov conditional random field adds.

The patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers. The
random field looks at islands: stretches of text that hold a digit or an @ and in which a blank
only stands between parts of a number. An island is cut into atoms; candidate segments are
runs of up to 16 atoms, each described as a whole (its digits, marks, checksum, neighbours and
the word before it). Dynamic programming over the atoms chooses segments and types together. It is
trained on islands in which the patterns, or an assignment of a long quoted value to a word such as
``token``, show what is there.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmill.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone", "secret")
#: Longest segment in atoms.
LONGEST = 16
#: Islands per kind (and without any) that the field is trained on; the one bound of the training.
SAMPLE_ISLANDS = 150

# The patterns of the four base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The same matches as EMAIL and IP, without a new start inside a run that has failed.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
_IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")

_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api_?key|key)\s*[=:]\s*[\"']([^\s\"']{16,})[\"']")
_TRIGGER = re.compile(r"[0-9@]")
_ISLAND = re.compile(r"\S+(?:(?<=[0-9)]) (?=[0-9(])\S+)*")
_ATOM = re.compile(r"[A-Za-z0-9]+|[^\W0-9A-Za-z_]+|[^\s\w]|_")
_LAST_WORD = re.compile(r"([A-Za-z_]+)[^A-Za-z_]*$")
_HEX = re.compile(r"[0-9a-fA-F]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    value = digits.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of ``EMAIL``, found from each @ outwards, so that a long run of letters is walked once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by kind, then start; matches that fail their test are dropped.

    The time grows with the text's length, whatever runs it holds.
    """
    out: list[Span] = [("email", *span) for span in _emails(text)]
    if not re.search("[0-9]", text):
        return out
    if "." in text:
        out += [("ip", *m.span()) for m in _IP_RUNS.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in CARD.finditer(text):
        found = m.group()
        if 13 <= len(found) - found.count(" ") - found.count("-") <= 19 and luhn(_digits(found)):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Starts and ends of the stretches that may hold personal data, in order."""
    end = 0
    for m in _TRIGGER.finditer(text):
        at = m.start()
        if at < end:
            continue
        while at > end and not text[at - 1].isspace():
            at -= 1
        end = _ISLAND.match(text, at).end()
        yield at, end


def _bucket(n: int) -> int:
    return n if n < 6 else 6 + (n - 6) // 4 if n < 46 else 16


def _beside(c: str) -> str:
    return "end" if not c or c.isspace() else "quote" if c in "\"'" else "word" if c.isalnum() else c


def features(text: str, a: int, b: int, word: str) -> tuple[str, ...]:
    """What describes a segment as a whole; ``word`` is the last word before its island."""
    s = text[a:b]
    digits = _digits(s)
    letters = sum(c.isalpha() for c in s)
    parts = s.split(".")
    found = [
        f"digits {_bucket(len(digits))}", f"letters {_bucket(letters)}", f"length {_bucket(len(s))}",
        f"dots {min(s.count('.'), 4)}", f"hyphens {min(s.count('-'), 3)}", f"blanks {min(s.count(' '), 4)}",
        f"ats {min(s.count('@'), 2)}", f"first {_beside(s[0])}", f"last {_beside(s[-1])}",
        f"left {_beside(text[a - 1 : a])}", f"right {_beside(text[b : b + 1])}",
        f"others {min(sum(not c.isalnum() and c not in '.-@ ()+' for c in s), 3)}",
    ]
    if s[0] == "+":
        found.append("plus")
    if "(" in s and ")" in s:
        found.append("parentheses")
    if 13 <= len(digits) <= 19 and not letters:
        found.append("checksum" if luhn(digits) else "no checksum")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts):
        found.append("octets")
    if "@" in s and len(parts[-1]) > 1 and parts[-1].isalpha() and s[0].isalnum():
        found.append("domain")
    if len(s) >= 16 and _HEX.fullmatch(s):
        found.append("hex")
    if word:
        found.append(f"after {word}")
    return tuple(found)


@dataclass(frozen=True)
class Lattice:
    """Atoms' starts and ends in a text, and the candidate segments: (first atom, atom after, features)."""

    starts: list[int]
    ends: list[int]
    segments: list[tuple[int, int, tuple[str, ...]]]


def _word_before(text: str, start: int) -> str:
    m = _LAST_WORD.search(text[max(0, start - 40) : start])
    return m.group(1).lower() if m and len(m.group(1)) < 12 else ""


def lattice(text: str, start: int, end: int) -> Lattice:
    atoms = [m.span() for m in _ATOM.finditer(text, start, end)]
    word = _word_before(text, start)
    segments = []
    for i, (a, _) in enumerate(atoms):
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        telling = False
        for j in range(i, min(i + LONGEST, len(atoms))):
            b = atoms[j][1]
            telling = telling or bool(_TRIGGER.search(text, atoms[j][0], b))
            if telling and text[b - 1].isalnum():
                segments.append((i, j + 1, features(text, a, b, word)))
    return Lattice([a for a, _ in atoms], [b for _, b in atoms], segments)


class Field:
    """Weights per feature and kind; a segment's score for a kind is the sum of its features' weights."""

    def __init__(self, names: dict[str, int], weights: np.ndarray) -> None:
        self.names, self.weights = names, weights

    def scores(self, found: Lattice) -> np.ndarray:
        names = self.names
        rows = [self.weights[[names[f] for f in fs if f in names]].sum(0) for _, _, fs in found.segments]
        return np.array(rows).reshape(-1, len(KINDS))

    def best(self, text: str, start: int, end: int) -> list[Span]:
        """The likeliest segmentation's spans; an atom outside of spans scores 0.

        The same as ``_path`` over the island's lattice, but atom by atom: it holds the last ``LONGEST`` atoms with the
        best score before each and the spans that gave it, which share their beginnings.
        """
        word, names = _word_before(text, start), self.names
        total, path, telling = 0.0, None, -1
        recent: deque[tuple[int, float, tuple | None]] = deque(maxlen=LONGEST)
        for j, m in enumerate(_ATOM.finditer(text, start, end)):
            a, b = m.span()
            recent.append((a, total, path))
            if _TRIGGER.search(text, a, b):
                telling = j
            if not text[b - 1].isalnum():
                continue
            # a segment holds the last telling atom
            first = j + 1 - len(recent)
            for i in range(first, telling + 1):
                at, before, spans = recent[i - first]
                if not (text[at].isalnum() or text[at] in "+("):
                    continue
                row = self.weights[[names[f] for f in features(text, at, b, word) if f in names]].sum(0)
                k = int(row.argmax())
                if row[k] > 0 and before + float(row[k]) > total:
                    total, path = before + float(row[k]), (spans, KINDS[k], at, b)
        found: list[Span] = []
        while path:
            found.append(path[1:])
            path = path[0]
        return found[::-1]

    def _path(self, grid: Lattice) -> list[Span]:
        n = len(grid.starts)
        into: list[list[tuple[float, int, int]]] = [[] for _ in range(n + 1)]
        for (i, j, _), row in zip(grid.segments, self.scores(grid), strict=True):
            k = int(row.argmax())
            if row[k] > 0:
                into[j].append((float(row[k]), i, k))
        total, back = [0.0] * (n + 1), [(-1, -1)] * (n + 1)
        for j in range(1, n + 1):
            total[j], back[j] = total[j - 1], (j - 1, -1)
            for score, i, k in into[j]:
                if total[i] + score > total[j]:
                    total[j], back[j] = total[i] + score, (i, k)
        spans, j = [], n
        while j:
            i, k = back[j]
            if k >= 0:
                spans.append((KINDS[k], grid.starts[i], grid.ends[j - 1]))
            j = i
        return spans[::-1]


def train_field(examples: list[tuple[str, int, int, list[Span]]], rounds: int = 25, rate: float = 0.5) -> Field:
    """Maximum likelihood by forward and backward sums over the islands, with adaptive steps.

    An example is a text, an island's start and end, and its spans. Spans that are not made of whole atoms are left
    out. The result depends on the examples and their order only.
    """
    names: dict[str, int] = {}
    prepared = []
    for text, start, end, spans in examples:
        grid = lattice(text, start, end)
        if not grid.segments:
            continue
        feats = [np.array([names.setdefault(f, len(names)) for f in fs]) for _, _, fs in grid.segments]
        at = {(grid.starts[i], grid.ends[j - 1]): s for s, (i, j, _) in enumerate(grid.segments)}
        gold = [(at[a, b], KINDS.index(k)) for k, a, b in spans if (a, b) in at]
        prepared.append((len(grid.starts), [(i, j) for i, j, _ in grid.segments], feats, gold))
    weights = np.full((len(names), len(KINDS)), -0.05)
    squares = np.full_like(weights, 1e-2)
    for _ in range(rounds):
        for n, bounds, feats, gold in prepared:
            scores = np.array([weights[f].sum(0) for f in feats])
            chances = _chances(n, bounds, scores)
            for s, k in gold:
                chances[s, k] -= 1
            for f, row in zip(feats, chances, strict=True):
                if np.abs(row).max() > 1e-3:
                    squares[f] += row**2
                    weights[f] -= rate * row / np.sqrt(squares[f])
    return Field(names, weights)


def _chances(n: int, bounds: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """Of each segment and kind: the probability of being part of the segmentation."""
    joint = np.logaddexp.reduce(scores, axis=1)
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for s, (i, j) in enumerate(bounds):
        by_end[j].append(s)
        by_start[i].append(s)
    ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[bounds[s][0]] + joint[s] for s in by_end[j])])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[bounds[s][1]] + joint[s] for s in by_start[i])])
    outside = np.array([ahead[i] + behind[j] for i, j in bounds]) - ahead[n]
    return np.exp(np.minimum(scores + outside[:, None], 0))


def _shown(text: str, spans: list[Span]) -> list[Span]:
    """What is known of a text for training: base spans and values assigned to words such as token."""
    return spans + [("secret", *m.span(1)) for m in _SECRET.finditer(text)] if ('"' in text or "'" in text) else spans


def train(docs: DataFrame, islands_per_kind: int = SAMPLE_ISLANDS, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fits the field on at most ``islands_per_kind`` islands of each kind and as many without any.

    All texts are looked at; a hash of the island with its surroundings decides which are drawn. Phone numbers
    count a second time without their country code.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[tuple]] = {}
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                spans = None
                for a, b in islands(text):
                    spans = _shown(text, base_spans(text)) if spans is None else spans
                    inside = [s for s in spans if a <= s[1] and s[2] <= b]
                    kind = inside[0][0] if inside else "none"
                    begin, stop = max(0, a - 40), min(len(text), b + 4)
                    if stop - begin > 1000:
                        continue
                    piece = text[begin:stop]
                    rank = hashlib.blake2b(piece.encode(), digest_size=8).hexdigest()
                    labels = ",".join(f"{k}:{s - begin}:{e - begin}" for k, s, e in inside)
                    rows = kept.setdefault(kind, [])
                    rows.append((kind, rank, piece, a - begin, b - begin, labels))
                    if len(rows) > 4 * islands_per_kind:
                        kept[kind] = sorted(set(rows))[:islands_per_kind]
        rows = [r for own in kept.values() for r in sorted(set(own))[:islands_per_kind]]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = [pa.string()] * 3 + [pa.int32()] * 2 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=_DRAWN)

    shape = "kind string, rank string, piece string, start int, stop int, labels string"
    drawn = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(draw, shape).distinct()
    first = F.row_number().over(Window.partitionBy("kind").orderBy("rank", "start"))  # a bounded number per task
    rows = drawn.withColumn("_n", first).where(F.col("_n") <= islands_per_kind).orderBy("rank", "start").collect()
    examples = []
    for r in rows:
        labels = [x.split(":") for x in r["labels"].split(",") if x]
        spans = [(k, int(a), int(b)) for k, a, b in labels]
        examples.append((r["piece"], r["start"], r["stop"], spans))
        if r["kind"] == "phone" and len(spans) == 1 and (m := re.match(r"\+[0-9]+ ", r["piece"][spans[0][1] :])):
            cut, at = len(m.group()), spans[0][1]
            piece = r["piece"][:at] + r["piece"][at + cut :]
            if piece[at : at + 1] and not piece[at].isspace():
                examples.append((piece, at, r["stop"] - cut, [("phone", at, spans[0][2] - cut)]))
    return train_field(examples)


_DRAWN = ["kind", "rank", "piece", "start", "stop", "labels"]


def all_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Base spans and those of the field that touch none of them, by kind as listed, then start."""
    taken = sorted((a, b) for _, a, b in base)
    starts, furthest = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    added = []
    for a, b in islands(text):
        for span in field.best(text, a, b):
            before = bisect_left(starts, span[2])
            if not before or furthest[before - 1] <= span[1]:
                added.append(span)
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (of the patterns), base_sha256, spans, n_added.

    ``spans`` are ``kind:start:end`` in code points, end exclusive, comma-joined. Null and empty texts have none.
    Repeated rows and null ids are treated row by row; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((field.names, field.weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS[:4]]
            marks, spans, added = [], [], []
            for text in batch.column(1):
                text = text.as_py()
                base = base_spans(text)
                found = all_spans(text, base, own)
                for i, k in enumerate(KINDS[:4]):
                    counts[i].append(sum(s[0] == k for s in base))
                marks.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
                added.append(len(found) - len(base))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(marks, pa.string())]
            columns += [pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", "n_added"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS[:4])
    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, n_added long"
    return rows.mapInArrow(search, shape)

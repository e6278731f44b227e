"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed
letter n-grams learns to tell the languages whose bit is set from the others. A text
gets the language whose codeword costs the least, each bit's logistic loss weighted by how
well its classifier did in training. A near tie between two codewords is flagged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import TEXTS_PER_BATCH

WIDTH = 4096
UNKNOWN = "und"
#: Rows that the model is fitted on, in equal parts per language; the one bound of the training.
SAMPLE_ROWS = 2400
#: Below this score a prediction is flagged as ambiguous.
SURE = 0.6


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    codes: np.ndarray  # languages x bits, -1 and 1
    weights: np.ndarray  # n-grams x bits
    bias: np.ndarray
    trust: np.ndarray  # per bit


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point of all planes is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str) -> np.ndarray | None:
    """Square roots of the shares of a text's hashed 1-, 2- and 3-grams; None without a letter.

    Letters are lower-cased, and each run of other characters is one blank.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    codes = codes[letter | np.append(letter[1:], True)].astype(np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    one = codes * np.uint32(2654435761)
    two = (one[:-1] ^ (codes[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two[:-1] ^ (codes[2:] * np.uint32(668265263))) * np.uint32(374761393)
    counts = sum(np.bincount(h >> np.uint32(20), minlength=WIDTH) for h in (one, two, three))
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Codewords of n languages: all distinct splits for up to 5, else the best of seeded random codes."""
    if n < 2:
        return np.ones((n, 0), dtype=np.float32)
    if n <= 5:
        bits = [[1 if i == 0 or (b >> (i - 1)) & 1 else -1 for b in range(2 ** (n - 1) - 1)] for i in range(n)]
        return np.array(bits, dtype=np.float32)
    rng = np.random.default_rng(seed)
    size = int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1.0
    for _ in range(50):
        codes = rng.choice([-1.0, 1.0], (n, size)).astype(np.float32)
        split = np.abs(codes.sum(0)) < n
        codes = codes[:, split]
        near = (codes @ codes.T - 2 * size * np.eye(n)).max()
        if -near > apart or best is None:
            best, apart = codes, -near
    return best


def fit(x: np.ndarray, labels: list[str], rounds: int = 300, decay: float = 1e-5) -> Model:
    """Logistic classifiers for all bits at once, by accelerated gradient steps; the same for the same rows."""
    languages = tuple(sorted(set(labels)))
    codes = codewords(len(languages))
    y = codes[[languages.index(v) for v in labels]] if labels else codes[:0]
    bits = codes.shape[1]
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros((x.shape[1], bits), np.float32)
    ahead, rate = w.copy(), np.float32(2.0)
    share = np.array([1.0 / max(labels.count(v), 1) for v in labels], np.float32)  # languages weigh alike
    share /= max(share.sum(), 1e-9)
    for i in range(rounds if bits and labels else 0):
        push = -y / (1 + np.exp(np.clip(y * (x @ ahead), -30, 30)))
        step = ahead - rate * (x.T @ (push * share[:, None]) + decay * ahead)
        ahead = step + np.float32(i / (i + 3)) * (step - w)
        w = step
    right = (np.sign(x @ w) == y).mean(0) if len(labels) else np.zeros(bits)
    trust = np.clip(2 * right - 1, 0.05, 1)
    return Model(languages, codes, w[:-1], w[-1], trust.astype(np.float32))


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float, bool]]:
    """Language, score and whether the two nearest codewords are close."""
    out: list[tuple[str, float, bool]] = []
    for at in range(0, len(texts), TEXTS_PER_BATCH):  # a text's n-grams take 16 KB, whatever its length
        out += _predicted(model, texts[at : at + TEXTS_PER_BATCH])
    return out


def _predicted(model: Model, texts: list[str | None]) -> list[tuple[str, float, bool]]:
    out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
    found = [(i, f) for i, t in enumerate(texts) if t and (f := features(t)) is not None]
    if not found or not model.languages:
        return out
    margins = np.array([f for _, f in found]) @ model.weights + model.bias
    losses = np.logaddexp(0, -margins[:, None, :] * model.codes[None]) @ model.trust
    chances = np.exp(losses.min(1, keepdims=True) - losses)
    chances /= chances.sum(1, keepdims=True)
    for (i, _), row in zip(found, chances, strict=True):
        k = int(row.argmax())
        out[i] = (model.languages[k], float(row[k]), bool(row[k] < SURE))
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: the checksum of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def train(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """Fits on whole texts of at most about ``sample_rows`` labelled rows that are not held out.

    Languages are counted over all rows; each then gives an equal number, drawn by a
    hash of the id. Only feature vectors of drawn rows reach the driver.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~F.coalesce(held_out(id_col), F.lit(True)))
    known = {r["lang"]: r["n"] for r in usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not known:
        return fit(np.empty((0, WIDTH), np.float32), [])
    each = max(1, sample_rows // len(known))
    rates = F.create_map(*[F.lit(v) for lang, n in sorted(known.items()) for v in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64(F.lit("language"), id_col), F.lit(1 << 30)) / float(1 << 30)

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if (f := features(t)) is None else f.astype(np.float16).tobytes())

    vector = vector.asNondeterministic()  # else the filter below makes Spark compute it twice
    drawn = usable.where(draw < F.element_at(rates, F.col(lang_col)))
    rows = drawn.select(F.col(lang_col).alias("lang"), vector(text_col).alias("v")).where("v IS NOT NULL").collect()
    rows = sorted((r["lang"], bytes(r["v"])) for r in rows)
    x = np.array([np.frombuffer(v, np.float16) for _, v in rows], dtype=np.float32).reshape(len(rows), WIDTH)
    return fit(x, [lang for lang, _ in rows])


def identified(model: Model, text: Column | str) -> Column:
    """struct<lang_pred, score, ambiguous> of a text column.

    It is declared nondeterministic, though equal texts get equal results: Spark would push a filter on
    the result below the column and classify every text twice, in two Python workers at once.
    """

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def identify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(model, texts.tolist()), columns=["lang_pred", "score", "ambiguous"])

    return identify.asNondeterministic()(text)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    Null texts and texts without a letter are ``und`` with score 0. Without any labelled row
    all are. Repeated rows get the same result each; a null id is not held out; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
        identified(model, text_col).alias("_found"),
    )
    return rows.select("doc_id", "held_out", "_found.*")

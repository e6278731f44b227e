"""Quality rules as a ledger of failure bits, without Python in tasks.

``ledger`` measures every text and evaluates every rule once. It stores the
measurements and one bit per failed rule. Policies are then masks over the
bits: applying another one, or asking what a rule costs, reads the ledger and no text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import BLANKS, WORD, bound, text_or_empty

WINDOW = 8

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_letters", "n_upper", "n_exclaims",
)


@dataclass(frozen=True)
class QualityRule:
    """A bit, and when a measured text fails. ``fails`` is Spark SQL over the measurements, on integers."""

    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A version and the bits of the rules that it enforces."""

    version: str
    bits: tuple[int, ...]

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)


RULES = (
    QualityRule(0, "few_words", "n_words < 20"),
    QualityRule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    QualityRule(2, "symbols", "10 * n_symbols > n_words"),
    QualityRule(3, "duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    QualityRule(4, "little_variety", "100 * n_distinct_words < 35 * n_words"),
    QualityRule(5, "few_letters", "100 * n_letters < 50 * word_chars"),
    QualityRule(6, "shouting", "100 * n_upper > 30 * n_letters"),
    QualityRule(7, "exclamations", "2 * n_exclaims > n_words"),
    QualityRule(8, "word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
)
BASE = Policy("base", (0, 1))
POLICIES = (
    BASE,
    Policy("v1", (0, 1, 2, 3, 4, 5)),
    Policy("v2", tuple(r.bit for r in RULES)),
)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of 8 words found twice or more in the text.

    Windows are told apart by 64-bit hashes within one text. Texts without a
    repeat, which are most, stop after the hash set.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(n < WINDOW, F.lit(0)).otherwise(
        bound(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))
    )


def _covered(hashes: Column) -> Column:
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        def same(k: Column, e: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))

        return F.filter(s, lambda e, k: same(k - 1, e) | same(k + 1, e))

    starts = F.sort_array(F.transform(bound(by_hash, twice), lambda e: e["i"]))
    nothing = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last"))

    def add(total: Column, at: Column) -> Column:
        gained = F.least(F.lit(WINDOW), at - total["last"])
        return F.struct((total["words"] + gained).alias("words"), at.alias("last"))

    return F.aggregate(starts, nothing, add, lambda total: total["words"])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements as longs."""
    text = F.col("_text")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    counts = {
        "n_words": lambda w: F.size(w),
        "n_repeat_words": _repeated_words,
        "n_distinct_words": lambda w: F.size(F.array_distinct(w)),
    }
    of_words = bound(words, lambda w: F.struct(*[f(w).cast("long").alias(n) for n, f in counts.items()]))
    of_lines = bound(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    chars = {
        "word_chars": F.length(F.regexp_replace(text, BLANKS, "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_exclaims": F.regexp_count(text, F.lit("!")),
    }
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    rows = rows.select(
        "doc_id", of_words.alias("_w"), of_lines.alias("_l"), *[c.cast("long").alias(n) for n, c in chars.items()]
    )
    columns = {n: F.col(n) for n in chars} | {n: F.col(f"_w.{n}") for n in counts}
    columns |= {"n_lines": F.col("_l.n").cast("long"), "n_dup_lines": F.col("_l.again").cast("long")}
    return rows.select("doc_id", *[columns[n].alias(n) for n in MEASURES])


def ledger(
    docs: DataFrame, rules: Sequence[QualityRule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measurements, and ``fail_bits`` (long).

    Null text counts as empty: all measurements are 0 and the rule on few words
    fails. Repeated rows have an entry each; other columns are ignored.
    """
    bits = sum(F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(0) for r in rules)
    return measured(docs, id_col, text_col).withColumn("fail_bits", bits)


def kept(policy: Policy) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(
    entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[QualityRule] = RULES
) -> DataFrame:
    """Per policy and rule: documents, kept, failing the rule, and kept if the rule were dropped.

    The ledger is first counted by failure bits; everything else works on those few rows.
    """
    histogram = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    asked = [
        F.struct(F.lit(p.version).alias("version"), F.lit(p.mask).cast("long").alias("mask"),
                 F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
        for p in policies for r in rules if r.bit in p.bits
    ]
    rows = histogram.select("fail_bits", "n", F.inline(F.array(*asked)))
    bits, mask, bit = F.col("fail_bits"), F.col("mask"), F.col("bit")
    every = bits.bitwiseAND(mask) == 0
    without = bits.bitwiseAND(mask.bitwiseXOR(bit)) == 0
    return rows.groupBy("version", "rule").agg(
        F.sum("n").alias("docs"),
        F.sum(F.when(every, F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(bits.bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(without, F.col("n")).otherwise(0)).alias("kept_without"),
    )

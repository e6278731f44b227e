"""Encoding, parsing and banding of signal records as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.schemas import (
    DATE_TIME,
    GENERATION_BANDS,
    SIGNALS,
)


# The shape of READ_TIME_PATTERN; 60 seconds are refused as they would roll over.
_TIME_SHAPE = r"^[0-9]{2} [0-9]{2} [0-9]{4}( [0-9]{2}:[0-9]{2}(:[0-5][0-9])?)?\z"


def csv_line(columns: Sequence[str | Column]) -> Column:
    """All columns joined by commas; NULL is written as the text ``null``.

    Nothing is quoted, so a comma inside a field shifts the fields after it.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])


def signal_line(when: Column, signals: Sequence[Column]) -> Column:
    """One signal record as text: minute-precise time, then the four signals."""
    if len(signals) != len(SIGNALS):
        raise ValueError(f"a signal line has {len(SIGNALS)} signals, got {len(signals)}")
    parts = [(F.day(when), 2), (F.month(when), 2), (F.year(when), 4), (F.hour(when), 2), (F.minute(when), 2)]
    day, month, year, hour, minute = (F.lpad(p.cast("string"), n, "0") for p, n in parts)
    # from its parts, as formatting would first turn a zone-less time into one of the session's zone
    text = F.concat(day, F.lit(" "), month, F.lit(" "), year, F.lit(" "), hour, F.lit(":"), minute)
    return csv_line([text, *signals])


def signal_time(text: Column) -> Column:
    """Zone-less timestamp of a date/time text; NULL where it does not parse.

    Its parts are put in ISO order and cast once, so the session's zone and its clock changes have no say.
    """
    iso = F.concat(
        F.substring(text, 7, 4), F.lit("-"), F.substring(text, 4, 2), F.lit("-"), F.substring(text, 1, 2), F.substr(text, F.lit(11))
    )
    return F.when(text.rlike(_TIME_SHAPE), iso.try_cast("timestamp_ntz"))


def number(text: Column) -> Column:
    """Double value of a text; NULL where it is not a number."""
    return text.try_cast("double")


def split_signal_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Five text fields under their file labels; absent fields are NULL, extra ones ignored."""
    parts = F.split(F.col(value).cast("string"), ",")
    labels = [DATE_TIME, *[s.label for s in SIGNALS]]
    return lines.select(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(labels)])


def typed_signals(fields: DataFrame) -> DataFrame:
    """Wide form: date, timestamp, four doubles and the number of rejected fields.

    A field is rejected when it is absent or does not convert; the text ``null``
    stands for a missing value and is accepted.
    """
    when = signal_time(_field(DATE_TIME))
    values = [number(_field(s.label)) for s in SIGNALS]
    texts = [_field(DATE_TIME), *[_field(s.label) for s in SIGNALS]]
    rejected = [
        (text.isNull() | ((text != "null") & parsed.isNull())).cast("int")
        for text, parsed in zip(texts, [when, *values], strict=True)
    ]
    return fields.select(
        when.cast("date").alias("signal_date"),
        when.alias("signal_ts"),
        *[v.alias(s.column) for v, s in zip(values, SIGNALS, strict=True)],
        reduce(Column.__add__, rejected).alias("bad_fields"),
    )


def parse_signals(lines: DataFrame, value: str = "value") -> DataFrame:
    """Signal lines to the wide form."""
    return typed_signals(split_signal_lines(lines, value))


#: Why a field is rejected, in the order of its bits.
REASONS = ("absent", "not convertible")


def parse_with_ledger(lines: DataFrame, value: str = "value") -> DataFrame:
    """The wide form with a ledger of rejected fields: ``reject_bits``, and the ``line`` itself where a bit is set.

    Each field has one bit per reason of :data:`REASONS`, the first field the lowest ones. The bits come from the same decode as
    the values. A line that is null lacks all of its fields.
    """
    parts = F.split(F.col(value).cast("string"), ",")
    labels = [DATE_TIME, *[s.label for s in SIGNALS]]
    texts = [F.get(parts, F.lit(i)) for i in range(len(labels))]
    fields = lines.select(F.col(value).cast("string").alias("line"), *[t.alias(label) for t, label in zip(texts, labels, strict=True)])
    decoded = [signal_time(_field(DATE_TIME)), *[number(_field(s.label)) for s in SIGNALS]]
    columns = ["signal_ts", *[s.column for s in SIGNALS]]
    bits = [
        F.when(_field(label).isNull(), 1 << (2 * i))
        .when((_field(label) != "null") & value_of.isNull(), 2 << (2 * i))
        .otherwise(0)
        for i, (label, value_of) in enumerate(zip(labels, decoded, strict=True))
    ]
    typed = fields.select("line", *[d.alias(c) for d, c in zip(decoded, columns, strict=True)], reduce(Column.bitwiseOR, bits).alias("reject_bits"))
    return typed.select(
        F.col("signal_ts").cast("date").alias("signal_date"), *columns,
        F.bit_count("reject_bits").alias("bad_fields"), "reject_bits", F.when(F.col("reject_bits") != 0, F.col("line")).alias("line"),
    )


def rejected_lines(ledger: DataFrame) -> DataFrame:
    """Lines with a rejected field: line, reject_bits, and reasons as text, such as ``Date/Time absent``."""
    labels = [DATE_TIME, *[s.label for s in SIGNALS]]
    said = [
        F.when(F.col("reject_bits").bitwiseAND(1 << (2 * i + j)) != 0, f"{label} {reason}")
        for i, label in enumerate(labels)
        for j, reason in enumerate(REASONS)
    ]
    rejected = ledger.where(F.col("reject_bits") != 0)
    return rejected.select("line", "reject_bits", F.concat_ws("; ", *said).alias("reasons"))


def typed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Signal lines to the typed form that keeps the date/time as text."""
    fields = split_signal_lines(lines, value)
    return fields.select(
        _field(DATE_TIME).alias("DateTime"),
        *[number(_field(s.label)).alias(s.column) for s in SIGNALS],
    )


def map_form(signals: DataFrame) -> DataFrame:
    """Wide form to date, timestamp and a map from signal label to value."""
    entries = [x for s in SIGNALS for x in (F.lit(s.label), F.col(s.column))]
    return signals.select("signal_date", "signal_ts", F.create_map(*entries).alias("signals"))


def load_stamped(df: DataFrame) -> DataFrame:
    """Adds the processing date and time of the load."""
    return df.withColumns({"create_date": F.current_date(), "create_ts": F.current_timestamp()})


def band(value: Column, bands: Sequence[tuple[float | None, str]] = GENERATION_BANDS) -> Column:
    """Name of the first band whose upper limit exceeds the value; NULL stays NULL."""
    result = None
    for limit, name in bands:
        inside = value.isNotNull() if limit is None else value < limit
        result = F.when(inside, name) if result is None else result.when(inside, name)
    if result is None:
        raise ValueError("at least one band is needed")
    return result


def _field(label: str) -> Column:
    return F.col(f"`{label}`")

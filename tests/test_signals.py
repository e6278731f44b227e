import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalmill.functions import signals as S
from signalmill.schemas import SIGNALS


def parsed(spark, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    return [r.asDict() for r in S.parse_signals(df).collect()]


def test_a_good_line(spark):
    (r,) = parsed(spark, "03 02 2018 14:20,380.05,5.31,416.33,259.99")
    assert r["signal_date"] == dt.date(2018, 2, 3)
    assert r["signal_ts"] == dt.datetime(2018, 2, 3, 14, 20)
    assert [r[s.column] for s in SIGNALS] == [380.05, 5.31, 416.33, 259.99]
    assert r["bad_fields"] == 0


@pytest.mark.parametrize(
    ("text", "when"),
    [
        ("03 02 2018 14:20", dt.datetime(2018, 2, 3, 14, 20)),
        ("03 02 2018 14:20:59", dt.datetime(2018, 2, 3, 14, 20, 59)),
        ("03 02 2018", dt.datetime(2018, 2, 3)),
        ("03 02 2018 24:20", None),
        ("30 02 2018 14:20", None),
        ("2018-02-03 14:20", None),
        ("03 02 2018 14:2x", None),
        ("", None),
    ],
)
def test_times(spark, text, when):
    (r,) = parsed(spark, f"{text},1,2,3,4")
    assert r["signal_ts"] == when
    assert r["bad_fields"] == (when is None)


def test_dirty_lines_do_not_fail_and_are_counted(spark):
    got = parsed(
        spark,
        "03 02 2018 14:20,1,2",  # too few fields
        "03 02 2018 14:20,1,2,3,4,5",  # too many
        "03 02 2018 14:20,x,2,3,",  # not numbers
        "03 02 2018 14:20,null,2,3,4",  # missing value
        None,
    )
    assert [r["bad_fields"] for r in got] == [2, 0, 2, 0, 5]
    assert got[0]["Theoretical_Power_Curve"] is None
    assert got[1]["Wind_Direction"] == 4
    assert got[3]["LV_ActivePower"] is None


def test_a_comma_inside_a_field_shifts_the_rest(spark):
    (r,) = parsed(spark, "03 02 2018 14:20,1,5,2,3,4")
    assert [r[s.column] for s in SIGNALS] == [1, 5, 2, 3]


def test_encoding_writes_null_as_text_and_round_trips(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 2, 3, 14, 20), 1.5, None, 3.0, 4.0)],
        "t timestamp, a double, b double, c double, d double",
    )
    line = df.select(S.signal_line(F.col("t"), [F.col(c) for c in "abcd"]).alias("value"))
    assert line.first()["value"] == "03 02 2018 14:20,1.5,null,3.0,4.0"
    r = S.parse_signals(line).first()
    assert (r["LV_ActivePower"], r["Wind_Speed"], r["bad_fields"]) == (1.5, None, 0)


def test_a_signal_line_needs_four_signals():
    with pytest.raises(ValueError, match="4 signals"):
        S.signal_line(None, [])


def test_typed_lines_keep_the_text_of_the_time(spark):
    df = spark.createDataFrame([("not a date,1,2,3,x",)], "value string")
    assert rows(S.typed_lines(df)) == [("not a date", 1.0, 2.0, 3.0, None)]


def test_map_form_has_the_file_labels(spark):
    df = spark.createDataFrame([("03 02 2018 14:20,1,2,3,4",)], "value string")
    r = S.map_form(S.parse_signals(df)).first()
    assert r["signals"] == {
        "LV ActivePower (kW)": 1.0,
        "Wind Speed (m/s)": 2.0,
        "Theoretical_Power_Curve (KWh)": 3.0,
        "Wind Direction (°)": 4.0,
    }
    absent = S.map_form(S.parse_signals(df)).select(F.col("signals")["none"].alias("v")).first()
    assert absent["v"] is None


def test_load_stamps(spark):
    r = S.load_stamped(spark.range(1)).first()
    assert abs(r["create_ts"] - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)
    assert isinstance(r["create_date"], dt.date)


def test_bands_have_exclusive_upper_limits_and_keep_null(spark):
    df = spark.createDataFrame(
        [(199.9,), (200.0,), (599.9,), (600.0,), (999.9,), (1000.0,), (-5.0,), (None,)], "v double"
    )
    got = [r["b"] for r in df.select(S.band(F.col("v")).alias("b")).collect()]
    assert got == [
        "Low", "Medium", "Medium", "High", "High", "Exceptional", "Low", None
    ]


def test_unused_fields_are_pruned(spark, folder):
    from conftest import plan

    from signalmill.plans.signal_data import event_signals

    text = plan(event_signals(spark, folder).select("signal_date"))
    assert "as double" not in text


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_sessions_zone(spark, folder, set_conf, zone):
    from signalmill.plans import all_queries

    set_conf("spark.sql.session.timeZone", zone)
    lines = spark.createDataFrame([("10 03 2024 02:30,1,2,3,4",)], "value string")
    found = S.parse_signals(lines).select(F.col("signal_ts").cast("string"), "bad_fields").first()
    assert tuple(found) == ("2024-03-10 02:30:00", 0)
    for name in ("signal_parse", "stream_watermark_append", "sliding_window_collect"):
        text = all_queries()[name](spark, folder)
        text = text.select([F.col(c).cast("string").alias(c) for c in text.columns])
        key = (name, folder)
        assert _SEEN.setdefault(key, sorted(map(tuple, text.collect()), key=repr)) == sorted(map(tuple, text.collect()), key=repr)


_SEEN: dict = {}


def test_ledger_tells_fields_and_reasons_apart(spark):
    lines = ["01 01 2024 10:00,1,2,3,4", "30 02 2024,x,null,,1", "null,1", "", None, "01 01 2024,1,2,3,4,5", "a,b,c,d,e"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    ledger = S.parse_with_ledger(df)
    plain = S.parse_signals(df)
    assert rows(ledger.select(plain.columns)) == rows(plain)
    bits = {r["line"]: r["reject_bits"] for r in ledger.collect() if r["reject_bits"]}
    assert bits == {"30 02 2024,x,null,,1": 0b0010001010, "null,1": 0b0101010000, "": 0b0101010110, None: 0b0101010101, "a,b,c,d,e": 0b1010101010}
    reasons = {r["line"]: r["reasons"] for r in S.rejected_lines(ledger).collect()}
    assert reasons["30 02 2024,x,null,,1"].split("; ") == [
        "Date/Time not convertible", "LV ActivePower (kW) not convertible", "Theoretical_Power_Curve (KWh) not convertible",
    ]
    assert len(reasons) == 5

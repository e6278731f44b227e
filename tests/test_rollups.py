import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from signalmill.functions.signals import map_form, parse_signals
from signalmill.operators import rollups as R
from signalmill.plans.signal_data import event_signals
from signalmill.schemas import SIGNALS
from signalmill.sources.files import table

LINES = [
    "01 01 2018 00:10,100,1,10,5",
    "01 01 2018 01:10,0.5,2,20,6",
    "01 01 2018 01:10,0,3,30,7",
    "15 02 2018 02:00,-4,4,40,8",
    "15 02 2019 02:00,6,5,50,9",
    "30 06 2019 03:00,bad,6,60,10",
    "garbage,9,9,9,9",
]


@pytest.fixture
def signals(spark):
    return parse_signals(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_days_with_bad_dates_in_the_null_group(signals):
    got = {r["date"]: r for r in R.rollup(signals, "day").collect()}
    assert got[dt.date(2018, 1, 1)]["count"] == 3
    assert got[dt.date(2018, 1, 1)]["total_LV_ActivePower"] == 100.5
    assert got[None]["count"] == 1
    assert got[dt.date(2019, 6, 30)]["total_LV_ActivePower"] is None
    assert got[dt.date(2019, 6, 30)]["total_Wind_Speed"] == 6


def test_months_of_all_years_fall_together_unless_asked(signals):
    together = {r["month"]: r["count"] for r in R.rollup(signals, "month").collect()}
    assert together == {1: 3, 2: 2, 6: 1, None: 1}
    apart = {(r["year"], r["month"]): r["count"] for r in R.rollup(signals, "month", by_year=True).collect()}
    assert apart[2018, 2] == apart[2019, 2] == 1


def test_quarters(signals):
    got = {r["quarter"]: r["total_Wind_Direction"] for r in R.rollup(signals, "quarter").collect()}
    assert got == {1: 35, 2: 10, None: 9}


def test_mixed_style_averages_speed_and_direction(signals):
    got = {r["month"]: r for r in R.rollup(signals, "month", "mixed").collect()}
    assert got[1]["avg_Wind_Speed"] == 2
    assert got[1]["avg_Wind_Direction"] == 6
    assert got[1]["total_Theoretical_Power_Curve"] == 60


def test_positive_power_keeps_fractions_and_drops_zero_negative_and_missing(signals):
    kept = sorted(r["LV_ActivePower"] for r in R.positive_power(signals).collect())
    assert kept == [0.5, 6, 9, 100]


def test_positive_power_counts_small_values_of_the_dataset(spark):
    folder = "/root/testdata/sf0.01"
    events = table(spark, folder, "events")
    fractions = events.where("value > 0 AND value < 1").count()
    assert fractions > 0
    kept = R.positive_power(event_signals(spark, folder))
    assert kept.where("LV_ActivePower < 1").count() == fractions


@pytest.mark.parametrize("grain", ["day", "month", "quarter"])
@pytest.mark.parametrize("style", ["sum", "mixed"])
@pytest.mark.parametrize("by_year", [False, True])
def test_partials_of_two_loads_merge_to_the_whole(spark, signals, grain, style, by_year):
    first = signals.where("Wind_Speed < 4")
    second = signals.where("Wind_Speed >= 4")
    partials = R.day_partials(first).unionByName(R.day_partials(second))
    coarse = R.coarser_partials(partials, grain)
    assert rows(R.merge_partials(coarse, grain, style, by_year)) == rows(
        R.rollup(signals, grain, style, by_year=by_year)
    )


def test_unknown_grain_and_style(signals):
    with pytest.raises(ValueError, match="grain"):
        R.rollup(signals, "week")
    with pytest.raises(ValueError, match="style"):
        R.rollup(signals, "day", "median")


def test_hourly_average_leaves_out_hour_zero(signals):
    got = R.hourly_signal_avg(map_form(signals)).collect()
    assert [r["hour"] for r in got] == [1, 2, 3]
    assert got[0]["LV ActivePower (kW)"] == 0.25
    assert rows(R.hourly_signal_avg(signals)) == rows(R.hourly_signal_avg(map_form(signals)))


def test_datapoints_are_distinct_times(signals):
    got = {r["signal_date"]: r["datapoints"] for r in R.datapoints_per_day(signals).collect()}
    assert got[dt.date(2018, 1, 1)] == 2


def test_rollup_aggregates_before_the_shuffle_and_reads_needed_columns(spark, folder):
    text = plan(R.rollup(event_signals(spark, folder), "day", ordered=False))
    assert "partial_sum" in text
    assert "event_type" not in text


def test_hours_are_decoded_once_and_not_filtered_below_the_aggregate(spark, folder):
    text = plan(R.hourly_signal_avg(map_form(event_signals(spark, folder))))
    assert not re.search(r"\bFilter \(", text[text.index("partial_avg") : text.index("Initial Plan")])


def wide(spark, values):
    cols = ", ".join(f"{s.column} double" for s in SIGNALS)
    data = [(dt.date(2024, 1, 1 + i % 3), v, v, -v if v is not None else None, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"signal_date date, {cols}")


def test_sums_are_the_same_bits_for_any_partitioning(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-9, 12) for _ in range(6000)]
    given = wide(spark, values)
    found = set()
    for style in ("sum", "mixed"):
        for parts in (1, 5, 16):
            shuffled = given.orderBy(F.rand(parts)).repartition(parts)
            loads = R.day_partials(shuffled.where("LV_ActivePower < 0")).unionByName(R.day_partials(shuffled.where("LV_ActivePower >= 0")))
            for rolled in (R.rollup(shuffled, "day", style), R.merge_partials(R.merge_days(loads), "day", style)):
                found.add((style, tuple(rows(rolled))))
    assert len(found) == 2
    exact = {}
    for i, v in enumerate(values):
        exact[i % 3 + 1] = exact.get(i % 3 + 1, 0) + Decimal(repr(v)).quantize(Decimal("1e-15"))
    got = {r["date"].day: r["total_LV_ActivePower"] for r in R.rollup(given, "day").collect()}
    assert got == {d: float(x) for d, x in exact.items()}


def test_large_and_odd_values_are_summed_as_doubles(spark):
    nan, inf = float("nan"), float("inf")
    got = {r["date"].day: r for r in R.rollup(wide(spark, [1e20, nan, None, 0.5, 1.0, None, inf, 2.0, None]), "day", "mixed").collect()}
    assert got[1]["total_LV_ActivePower"] == inf and str(got[2]["total_LV_ActivePower"]) == "nan"
    assert got[3]["total_LV_ActivePower"] is None and got[3]["avg_Wind_Speed"] is None and got[3]["count"] == 3
    twice = {r["date"].day: r["total_LV_ActivePower"] for r in R.rollup(wide(spark, [1e20, 1.0, 1.0, 3e15, 1.0, 1.0]), "day").collect()}
    assert twice == {1: 1e20 + 3e15, 2: 2.0, 3: 2.0}


def test_datapoints_of_minutes_seconds_and_fractions(spark):
    base = dt.datetime(2024, 1, 1, 23, 58)
    steps = [0, 0, 60, 60, 61, 61, 61.5, 61.5, 61.25, 119.999999, 120, 121, 86_400, -3_000_000_000]
    times = [base + dt.timedelta(seconds=s) for s in steps] + [None]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(t.date() if t else None, t) for t in times], f"signal_date date, signal_ts {kind}")
        wanted = df.groupBy("signal_date").agg(F.count_distinct("signal_ts").alias("n"))
        assert rows(R.datapoints_per_day(df)) == rows(wanted)
        halves = R.point_partials(df.limit(7)).unionByName(R.point_partials(df))
        assert rows(R.count_points(halves)) == rows(wanted)


def test_no_timestamp_is_shuffled_for_datapoints(spark, folder):
    text = plan(R.datapoints_per_day(event_signals(spark, folder)))
    shuffles = [x for x in text.splitlines() if "hashpartitioning" in x]
    assert shuffles and not any("signal_ts" in x for x in shuffles)


def test_a_day_holding_most_rows_shuffles_one_row_per_task(spark):
    hot = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, "01 01 2018 05:00").otherwise(
            F.concat(F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit(" 03 2018 05:00"))
        ).alias("t")
    )
    lines = hot.select(F.concat("t", F.lit(",1,1,1,1")).alias("value"))
    rolled = R.rollup(parse_signals(lines), "day", ordered=False)
    assert {r["date"]: r["count"] for r in rolled.collect()}[dt.date(2018, 1, 1)] == 60_000

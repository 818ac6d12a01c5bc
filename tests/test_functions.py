import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from millrace.functions import weather as wx
from millrace.functions.calendar import calendar_columns, date_key
from millrace.functions.cleaning import bounded, ladder, lookup, null_outside
from millrace.functions.numbers import decimal_average, decimal_ratio, percent, ratio, round_half_away, settled_mean, settled_sum


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_rounding_scales_the_binary_value(spark):
    got = column(spark, [1.005, 0.285, 2.675, -1.5, None], "double", lambda v: round_half_away(v, 2))
    assert got == [1.0, 0.28, 2.68, -1.5, None]
    assert column(spark, [0.5, 1.5, -0.5], "double", lambda v: round_half_away(v, 0)) == [1.0, 2.0, -1.0]


def test_sum_does_not_depend_on_row_order(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(-5e5, 5e5), 4) for _ in range(5000)] + [0.1] * 2500
    exact = float(sum(Decimal(str(v)) for v in values))
    for _ in range(3):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(rng.randint(1, 9))
        assert df.agg(settled_sum(F.col("v"), 4)).first()[0] == exact


def test_no_value_is_cut(spark):
    def sums(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(settled_sum(F.col("v")), settled_mean(F.col("v"))).first()

    assert sums(0.00001, 0.00002) == (0.00003, 0.000015)
    assert sums(*[0.00004] * 1000)[0] == 0.04
    assert sums(1e15, 1e15, 0.5)[0] == 2e15 + 0.5
    assert sums(*[5e14] * 6)[0] == 3e15
    assert math.isnan(sums(1.0, float("nan"))[0])
    assert sums(1.0, float("inf")) == (math.inf, math.inf)
    assert sums(1.0, None, 2.0) == (3.0, 1.5)
    assert sums(None, None) == (None, None)


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0)], "a double, b double")
    rows = df.select(ratio(F.col("a"), F.col("b")), percent(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [(None, None), (1 / 3, 33.33)]


def test_decimal_ratio_rounds_once(spark):
    rng = random.Random(5)
    pairs = [(Decimal(rng.randint(-10**7, 10**7)).scaleb(-2), rng.randint(1, 400)) for _ in range(400)]
    pairs += [(Decimal("10.01"), 2), (Decimal("-10.01"), 2), (Decimal("0.00"), 7)]
    # just below a tie, by less than Spark's usual six decimals
    pairs += [(Decimal(9 * 10**9 + 44), 10**10), (Decimal("44999999999.99"), 9 * 10**12)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a decimal(22,2), b bigint")
    got = [r[0] for r in df.orderBy("i").select(decimal_average(F.col("a"), F.col("b"), DecimalType(10, 2))).collect()]
    assert got == [(a / b).quantize(Decimal("0.01"), ROUND_HALF_UP) for a, b in pairs]
    zero = spark.createDataFrame([(Decimal("1.00"), Decimal("0.00"))], "a decimal(10,2), b decimal(10,2)")
    assert zero.select(decimal_ratio(F.col("a"), F.col("b"), 2, DecimalType(10, 2))).first()[0] is None


def test_cleaning(spark):
    values = [None, 9.99, 10.0, 50.0, 50.01]
    assert column(spark, values, "double", lambda v: null_outside(v, 10, 50)) == [None, None, 10.0, 50.0, None]
    clamp = lambda v: bounded(v, default=70, low=0, high=100)
    assert column(spark, [None, -1.0, 55.5, 101.0], "double", clamp) == [70.0, 0.0, 55.5, 100.0]
    steps = ((5.0, "b"), (10.0, "c"))
    got = column(spark, [None, 4.9, 5.0, 10.0], "double", lambda v: ladder(v, steps, "a"))
    assert got == ["a", "a", "b", "c"]
    assert column(spark, ["x", "y", None], "string", lambda v: lookup(v, {"x": 1}, 9)) == [1, 9, 9]


def test_calendar_by_month(spark):
    days = spark.createDataFrame([(dt.date(2026, m, 15),) for m in range(1, 13)], "day date")
    rows = days.orderBy("day").withColumns(calendar_columns(F.col("day"))).collect()
    assert [r.quarter for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert [r.quarter_rounded for r in rows] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5]
    assert [r.season for r in rows] == ["Hujan"] * 3 + ["Kemarau"] * 7 + ["Hujan"] * 2
    assert [r.monsoon_phase for r in rows] == (
        ["Puncak Hujan"] * 2
        + ["Akhir Hujan"] * 2
        + ["Awal Kemarau"] * 2
        + ["Puncak Kemarau"] * 3
        + ["Awal Hujan"] * 2
        + ["Puncak Hujan"]
    )
    assert [r.is_el_nino_period for r in rows] == [False] * 3 + [True] * 9
    assert [m + 1 for m, r in enumerate(rows) if r.is_peak_dry] == [7, 8, 9]
    assert [m + 1 for m, r in enumerate(rows) if r.is_peak_wet] == [1, 2, 12]


@pytest.mark.parametrize("day", [dt.date(2024, 1, 7), dt.date(2024, 12, 30), dt.date(2025, 2, 28), dt.date(2026, 4, 1)])
def test_calendar_of_a_day(spark, day):
    df = spark.createDataFrame([(day,)], "day date")
    row = df.withColumns({**calendar_columns(F.col("day")), "key": date_key(F.col("day"))}).first()
    assert row.day_of_week == day.isoweekday() % 7
    assert row.week_of_year == day.isocalendar()[1]
    assert row.key == int(day.strftime("%Y%m%d"))


def _round(value, places):
    scaled = abs(value) * 10**places
    return (int(scaled + 0.5) if scaled % 1 else int(scaled)) / 10**places * (1 if value >= 0 else -1)


def test_indices_against_plain_python(spark):
    rng = random.Random(7)

    def maybe(low, high):
        return None if rng.random() < 0.15 else round(rng.uniform(low, high), 2)

    rows = [(maybe(0, 200), maybe(10, 50), maybe(0, 100), maybe(0, 160)) for _ in range(300)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p double, t double, h double, w double")
    p, t, h, w = (F.col(c) for c in "pthw")
    out = df.withColumns({"drought": wx.drought_index(p, t, h), "fire": wx.fire_index(t, h, w)})
    out = out.withColumns(
        {
            "risk": wx.risk_code(p, F.col("drought"), F.col("fire")),
            "label": wx.condition_label(p),
            "stress": wx.crop_stress(F.col("drought"), F.col("t")),
            **wx.alert_flags(p, t, F.col("drought"), F.col("fire")),
        }
    )
    for row, (precip, temp, hum, wind) in zip(out.orderBy("i").collect(), rows):
        rain = precip or 0.0
        hot = 30.0 if temp is None else temp
        damp = 70.0 if hum is None else hum
        drought = max(0, 1 - rain / 20) * 0.5 + min(1, max(0, (hot - 28) / 12)) * 0.3 + max(0, 1 - damp / 100) * 0.2
        fire = hot / 40 * 0.35 + (100 - damp) / 100 * 0.4 + (wind or 0.0) / 80 * 0.25
        assert row.drought == pytest.approx(_round(drought, 4), abs=1.01e-4)
        assert row.fire == pytest.approx(_round(fire, 4), abs=1.01e-4)
        assert 0 <= row.drought <= 1
        worst = max(row.drought, row.fire)
        level = 3 if rain >= 150 or worst >= 0.75 else 2 if rain >= 100 or worst >= 0.55 else 1 if rain >= 50 or worst >= 0.35 else 0
        assert row.risk == ["R_LOW", "R_MODERATE", "R_HIGH", "R_EXTREME"][level]
        names = ["CLEAR", "DRIZZLE", "LIGHT_RAIN", "MODERATE_RAIN", "HEAVY_RAIN", "VERY_HEAVY", "EXTREME_RAIN"]
        assert row.label == names[sum(rain >= step for step in (1, 5, 20, 50, 100, 150))]
        assert row.is_flood_alert == (rain >= 100)
        assert row.is_drought_alert == (row.drought >= 0.55)
        assert row.is_fire_alert == (row.fire >= 0.55)
        assert row.is_extreme_weather == (rain >= 100 or (temp or 0) > 38 or row.fire > 0.7)
        if row.drought <= 0.3:
            assert row.stress == 0
        elif temp is not None:
            assert row.stress == pytest.approx(row.drought * 0.6 + max(0, (temp - 30) / 10) * 0.4, abs=1e-4)

"""Scalar and aggregate expressions: calendar, fixed-point rounding, correlation."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import dates, fixedpoint, stats


def _one(df):
    return df.collect()[0]


@pytest.mark.parametrize(
    "day,week",
    [
        ("2016-01-01", 1),
        ("2016-01-02", 1),
        ("2016-01-03", 2),
        ("2016-12-31", 53),
        ("2017-01-01", 1),
        ("2000-12-31", 54),
    ],
)
def test_week_of_year_starts_jan1_and_sunday(spark, day, week):
    r = _one(spark.range(1).select(dates.week_of_year_sun(F.to_date(F.lit(day))).alias("w")))
    assert r.w == week


def test_weekday_weekend_quarter_key(spark):
    rows = (
        spark.createDataFrame([(dt.date(2024, 3, 3),), (dt.date(2024, 3, 4),), (dt.date(2024, 12, 7),)], "d date")
        .select(
            dates.weekday_sun1("d").alias("wd"),
            dates.is_weekend_sun1("d").alias("we"),
            dates.quarter_int_div("d").alias("q"),
            dates.date_key_of("d").alias("k"),
        )
        .collect()
    )
    assert [(r.wd, r.we, r.q, r.k) for r in rows] == [(1, 1, 1, 20240303), (2, 0, 1, 20240304), (7, 1, 4, 20241207)]


def test_year_month_label(spark):
    r = _one(spark.range(1).select(dates.year_month_label(F.lit(2019), F.lit(3)).alias("l")))
    assert r.l == "2019-03"


def _half_up(x: Decimal, digits: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


def test_exact_sum_and_avg_match_decimal_arithmetic(spark):
    rnd = random.Random(7)
    groups = []
    for g in range(40):
        n = rnd.randint(1, 30)
        vals = [round(rnd.uniform(-500, 5000), 2) for _ in range(n)]
        groups.append((g, vals))
    rows = [(g, v) for g, vs in groups for v in vs]
    df = spark.createDataFrame(rows, "g int, v double")
    out = {
        r.g: r
        for r in df.groupBy("g")
        .agg(
            fixedpoint.exact_round_sum("v", 2, 2).alias("s"),
            fixedpoint.exact_round_sum("v", 2, 1).alias("s1"),
            fixedpoint.exact_round_avg("v", 2, 2).alias("a2"),
            fixedpoint.exact_round_avg("v", 2, 6).alias("a6"),
        )
        .collect()
    }
    for g, vs in groups:
        exact = sum(Decimal(str(v)) for v in vs)
        mean = exact / len(vs)
        assert out[g].s == float(exact)
        assert out[g].s1 == float(_half_up(exact, 1))
        assert out[g].a2 == float(_half_up(mean, 2)), (g, vs)
        assert out[g].a6 == float(_half_up(mean, 6))


def test_exact_avg_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 0.01), (1, 0.02), (2, -0.01), (2, -0.02)], "g int, v double")
    out = {r.g: r.a for r in df.groupBy("g").agg(fixedpoint.exact_round_avg("v", 2, 2).alias("a")).collect()}
    # 0.015 -> 0.02 and -0.015 -> -0.02 (a binary double 0.015 would round down)
    assert out == {1: 0.02, 2: -0.02}


def test_exact_avg_ignores_nulls_and_empty_is_null(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, None)], "g int, v double")
    out = {r.g: r.a for r in df.groupBy("g").agg(fixedpoint.exact_round_avg("v", 2, 2).alias("a")).collect()}
    assert out == {1: 1.0, 2: None}


def test_safe_corr_constant_single_and_normal(spark):
    rows = [("const", float(i), 5.0) for i in range(5)]
    rows += [("single", 1.0, 2.0)]
    xs = [1.0, 2.0, 3.0, 4.0, 10.0]
    ys = [2.0, 1.0, 4.0, 3.0, 9.0]
    rows += [("normal", x, y) for x, y in zip(xs, ys)]
    rows += [("normal", None, 100.0), ("normal", 100.0, None)]  # pairs with a NULL are ignored
    df = spark.createDataFrame(rows, "k string, x double, y double")
    out = {r.k: r.c for r in df.groupBy("k").agg(stats.safe_corr("x", "y").alias("c")).collect()}
    assert out["const"] is None
    assert out["single"] is None
    mx, my = sum(xs) / 5, sum(ys) / 5
    cov = sum((a - mx) * (b - my) for a, b in zip(xs, ys))
    expect = cov / math.sqrt(sum((a - mx) ** 2 for a in xs) * sum((b - my) ** 2 for b in ys))
    assert out["normal"] == pytest.approx(expect, abs=1e-12)


@pytest.mark.parametrize("r,band", [(0.3, "weak"), (0.31, "positive"), (-0.3, "weak"), (-0.31, "negative"), (None, "weak")])
def test_corr_band(spark, r, band):
    out = _one(spark.createDataFrame([(r,)], "r double").select(stats.corr_band("r").alias("b")))
    assert out.b == band


def test_pct_change_first_null_and_sign_flag(spark):
    df = spark.createDataFrame([(2019, 100.0), (2020, 50.0), (2021, 75.0)], "year int, x double")
    rows = df.select("year", stats.pct_change("x", "year").alias("g")).withColumn("d", stats.sign_flag("g")).orderBy("year").collect()
    assert [r.g for r in rows] == [None, -50.0, 50.0]
    assert [r.d for r in rows] == ["down", "down", "up"]

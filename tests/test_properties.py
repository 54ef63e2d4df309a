"""Property tests for the arithmetic identities the exact aggregation relies on."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import fixedpoint
from strata.operators.cleanse import add_duration_minutes


def test_duration_formula_equals_half_up_rounding_for_whole_seconds():
    # floor((10 s + 3) / 6) / 100 == round_half_up(s / 60, 2) for every whole second
    for s in range(-200_000, 200_001):
        want = (Decimal(s) / 60).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert Decimal(math.floor((10 * s + 3) / 6)) / 100 == want, s


def test_duration_matches_spark_round_on_sample(spark):
    import datetime as dt

    base = dt.datetime(2020, 1, 1)
    secs = [0, 1, 2, 29, 30, 31, 59, 60, 61, 599, 10799, 10800, 10801, 86399]
    df = spark.createDataFrame([(base, base + dt.timedelta(seconds=s)) for s in secs], "a timestamp_ntz, b timestamp_ntz")
    out = add_duration_minutes(df, "a", "b").withColumn(
        "ref", F.round((F.unix_timestamp("b") - F.unix_timestamp("a")) / 60.0, 2)
    )
    assert all(r.trip_duration_minutes == r.ref for r in out.collect())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=40))
def test_exact_sum_and_avg_equal_decimal(spark, cents):
    vals = [c / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = df.agg(
        fixedpoint.exact_round_sum("v", 2, 2).alias("s"),
        fixedpoint.exact_round_avg("v", 2, 2).alias("a2"),
        fixedpoint.exact_round_avg("v", 2, 5).alias("a5"),
    ).collect()[0]
    exact = sum(Decimal(c) for c in cents) / 100
    mean = exact / len(cents)

    def half_up(x: Decimal, d: int) -> float:
        return float(x.quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP))

    assert r.s == float(exact)
    assert r.a2 == half_up(mean, 2)
    assert r.a5 == half_up(mean, 5)

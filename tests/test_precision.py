"""Nothing is rounded before it has been summed; odd values do not end a job."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.config import PollutantChoice
from strata.functions.fixedpoint import SOURCE_SCALE, exact_round_avg, exact_round_sum
from strata.operators import cleanse
from strata.plans import reports, silver
from strata.sinks import writers


def test_sums_and_means_round_once(spark):
    df = spark.createDataFrame([(0.004,)] * 10, "x double")
    assert df.agg(exact_round_sum("x", SOURCE_SCALE, 2)).first()[0] == 0.04
    df = spark.createDataFrame([(0.00006,), (0.00006,), (0.00002,), (0.00002,)], "x double")
    assert df.agg(exact_round_avg("x", SOURCE_SCALE, 4)).first()[0] == 0.0
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    assert df.agg(exact_round_sum("x", SOURCE_SCALE, 2)).first()[0] == 1.5


def test_monthly_rate_keeps_its_decimals(spark):
    fx = spark.createDataFrame([(2020, 1, 1.1215), (2020, 1, 1.1234)], "fx_year int, fx_month int, usd_eur_rate double")
    assert reports.fx_monthly(fx).first()["usd_eur_rate"] == 1.12245


def test_malformed_dates_become_null(spark):
    fx = spark.createDataFrame([("2020-01-02", "1.1", "USD", "EUR"), ("no date", "x", "USD", "EUR")], "TIME_PERIOD string, OBS_VALUE string, CURRENCY string, CURRENCY_DENOM string")
    got = {(str(r.date), r.usd_eur_rate) for r in silver.silver_fx(fx).collect()}
    assert got == {("2020-01-02", 1.1), ("None", None)}


def test_missing_name_is_never_the_fallback(spark):
    cut = spark.createDataFrame([(None,), (None,), (None,), ("o3",), ("o3",), ("no2",)], "parameter_name string")
    got = reports.pollutant_candidates(cut, PollutantChoice(pattern="pm25", label="PM2.5")).filter("selected").collect()
    assert [(r.parameter_name, r.label) for r in got] == [("o3", "o3")]


def test_nan_amounts_are_rejected(spark):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (2.0,)], "fare_amount double").withColumns({c: F.lit(1.0) for c in ("total_amount", "trip_distance")})
    rule = next(r for r in cleanse.trip_rules() if r.name == "fare_non_negative")
    assert [r.fare_amount for r in df.filter(rule.predicate).collect()] == [2.0]


def test_strict_overwrite_does_not_replace_what_it_cannot_read(spark, tmp):
    path = f"{tmp}/broken"
    spark.range(3).write.parquet(path)
    import glob

    for f in glob.glob(f"{path}/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark says about the footer
        writers.overwrite(spark.range(3), path, allow_schema_change=False)
    assert glob.glob(f"{path}/*.parquet")


def test_limbs_hold_what_decimals_hold(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    random.seed(5)
    values = [random.choice((-1, 1)) * round(random.random() * 10 ** random.randint(0, 8), random.randint(0, 6)) for _ in range(3000)]
    values += [0.005, -0.005, 0.015, -0.015, 1e-10, -1e-10, 0.0, -0.0, 2.5, -2.5]
    rows = [(i % 37, v) for i, v in enumerate(values)] + [(99, float("nan")), (99, None), (99, float("inf")), (98, -0.004), (98, -0.001), (97, -0.0049999999)]
    df = spark.createDataFrame(rows, "g int, x double")
    known = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < 1e18)
    want, counts = {}, {}
    for g, v in rows:
        if v is not None and v == v and abs(v) < 1e18:
            want[g] = want.get(g, 0) + Decimal(v).quantize(Decimal("1e-10"), ROUND_HALF_UP)
            counts[g] = counts.get(g, 0) + 1
    for digits in (0, 1, 2, 3, 4, 6):
        got = df.filter(known).groupBy("g").agg(exact_round_sum("x", SOURCE_SCALE, digits).alias("s"), exact_round_avg("x", SOURCE_SCALE, digits).alias("a")).collect()
        unit = Decimal(1).scaleb(-digits)
        assert {r.g: r.s for r in got} == {g: float(s.quantize(unit, ROUND_HALF_UP)) for g, s in want.items()}
        for r in got:
            exact = (want[r.g] * 10**digits).copy_abs() * 10**10
            n = int(exact) * 2 + counts[r.g] * 10**10
            assert abs(r.a) * 10**digits == pytest.approx(n // (2 * counts[r.g] * 10**10), abs=1e-3)
    odd = df.filter("g = 99").agg(exact_round_sum("x", SOURCE_SCALE, 2).alias("s")).first()
    assert odd.s is None


def test_trips_of_both_flavours_come_from_one_scan(spark):
    from strata.plans.lakehouse import Lakehouse

    from .conftest import SF_SMALL

    lh = Lakehouse(spark, SF_SMALL)
    plan = lh.fact_taxi._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linestatus#") and plan.count("Relation [l_orderkey") == 1 and "Union" not in plan
    two = silver.silver_trips_from(lh.yellow_bronze, lh.green_bronze, lh.rules)
    assert two.exceptAll(lh.silver_trips).isEmpty() and lh.silver_trips.exceptAll(two).isEmpty()


def test_tagged_rows_keep_their_types(spark):
    from strata.config import SourceField, TripSourceSpec
    from strata.operators.standardize import MissingColumnError, standardize_tagged

    a = TripSourceSpec("A", (SourceField("n", "double", "n"), SourceField("at", "timestamp_ntz", "t"), SourceField("fee", "double", "Fee", required=False)))
    b = TripSourceSpec("B", (SourceField("n", "double", "m"), SourceField("at", "timestamp_ntz", "t"), SourceField("fee", "double", None, required=False)))
    day = dt.datetime(2020, 1, 1)
    rows = [("x", (1, day, 2.5), (7.5, "bad")), ("y", (2, day, 3.5), (8.5, "2020-02-03 04:05:06")), ("y", None, (9.5, "bad")), ("z", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "tag string, x struct<n:int,t:timestamp_ntz,fee:double>, y struct<m:double,t:string>")
    got = standardize_tagged(df, {"x": a, "y": b}, "tag").collect()
    assert [(r.n, str(r["at"]), r.fee, r.taxi_type) for r in got] == [(1.0, "2020-01-01 00:00:00", 2.5, "A"), (8.5, "2020-02-03 04:05:06", None, "B"), (9.5, "None", None, "B")]
    with pytest.raises(MissingColumnError):
        standardize_tagged(df, {"x": b, "y": a}, "tag")

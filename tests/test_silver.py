"""Silver layer: standardisation, validity rules, fills, enrichment, dedup."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.config import GREEN, YELLOW, TripRules
from strata.operators import cleanse
from strata.operators.standardize import MissingColumnError, standardize
from strata.plans import silver

YELLOW_COLS = (
    "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
    "trip_distance double, RatecodeID double, store_and_fwd_flag string, PULocationID long, DOLocationID long, "
    "payment_type long, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double"
)


def _trip(pu, do, fare=10.0, dist=1.0, total=12.0, passengers=1.0):
    return (1, pu, do, passengers, dist, 1.0, "N", 1, 2, 1, fare, 0.5, 0.5, 1.0, 0.0, 0.3, total)


def _ts(s):
    return dt.datetime.fromisoformat(s)


def _yellow(spark, rows, extra_schema="", extra=()):
    schema = YELLOW_COLS + extra_schema
    return spark.createDataFrame([r + extra for r in rows], schema)


def test_optional_columns_missing_become_typed_null(spark):
    df = _yellow(spark, [_trip(_ts("2020-01-01 10:00:00"), _ts("2020-01-01 10:10:00"))])
    out = standardize(df, YELLOW).collect()[0]
    assert out.congestion_surcharge is None and out.Airport_fee is None and out.ehail_fee is None
    assert out.trip_type is None and out.taxi_type == "yellow"
    assert standardize(df, YELLOW).schema["trip_type"].dataType.simpleString() == "bigint"


def test_lower_case_optional_column_resolved_unless_case_sensitive(spark):
    df = _yellow(
        spark,
        [_trip(_ts("2020-01-01 10:00:00"), _ts("2020-01-01 10:10:00"))],
        ", airport_fee double",
        (1.25,),
    )
    assert standardize(df, YELLOW).collect()[0].Airport_fee == 1.25
    assert standardize(df, YELLOW, case_sensitive=True).collect()[0].Airport_fee is None


def test_type_drift_text_timestamps_and_int_passengers(spark):
    schema = YELLOW_COLS.replace("tpep_pickup_datetime timestamp_ntz", "tpep_pickup_datetime string")
    schema = schema.replace("tpep_dropoff_datetime timestamp_ntz", "tpep_dropoff_datetime string")
    schema = schema.replace("passenger_count double", "passenger_count int")
    rows = [
        (1, "2020-01-01 10:00:00", "2020-01-01 10:10:00", 2, 1.0, 1.0, "N", 1, 2, 1, 10.0, 0.5, 0.5, 1.0, 0.0, 0.3, 12.0),
        (1, "garbage", "2020-01-01 10:10:00", 2, 1.0, 1.0, "N", 1, 2, 1, 10.0, 0.5, 0.5, 1.0, 0.0, 0.3, 12.0),
    ]
    std = standardize(spark.createDataFrame(rows, schema), YELLOW)
    got = std.collect()
    assert got[0].pickup_datetime == _ts("2020-01-01 10:00:00") and got[0].passenger_count == 2.0
    assert got[1].pickup_datetime is None  # unparsable -> NULL, then dropped by the rules
    assert silver.clean_trips(std).count() == 1


def test_missing_required_column_raises(spark):
    df = _yellow(spark, [_trip(_ts("2020-01-01 10:00:00"), _ts("2020-01-01 10:10:00"))]).drop("fare_amount")
    with pytest.raises(MissingColumnError):
        standardize(df, YELLOW)


def test_green_flavour_maps_lpep_columns(spark):
    schema = YELLOW_COLS.replace("tpep_", "lpep_") + ", ehail_fee double, trip_type long"
    df = spark.createDataFrame([_trip(_ts("2020-01-01 10:00:00"), _ts("2020-01-01 10:10:00")) + (None, 2)], schema)
    r = standardize(df, GREEN).collect()[0]
    assert r.taxi_type == "green" and r.trip_type == 2 and r.Airport_fee is None


@pytest.mark.parametrize(
    "pu,minutes_secs,fare,dist,kept",
    [
        ("2014-12-31 23:59:59", (10, 0), 10.0, 1.0, False),
        ("2015-01-01 00:00:00", (10, 0), 10.0, 1.0, True),
        ("2024-12-31 23:59:59", (10, 0), 10.0, 1.0, True),
        ("2025-01-01 00:00:00", (10, 0), 10.0, 1.0, False),
        ("2020-06-01 12:00:00", (10, 0), -0.01, 1.0, False),
        ("2020-06-01 12:00:00", (10, 0), 0.0, 1.0, True),
        ("2020-06-01 12:00:00", (10, 0), 10.0, 0.0, True),
        ("2020-06-01 12:00:00", (10, 0), 10.0, 500.0, True),
        ("2020-06-01 12:00:00", (10, 0), 10.0, 500.01, False),
        ("2020-06-01 12:00:00", (0, 0), 10.0, 1.0, False),  # 0 s
        ("2020-06-01 12:00:00", (0, 1), 10.0, 1.0, True),  # 1 s -> 0.02 min
        ("2020-06-01 12:00:00", (180, 0), 10.0, 1.0, True),
        ("2020-06-01 12:00:00", (180, 1), 10.0, 1.0, False),  # 180.02 min
        ("2020-06-01 12:00:00", (-5, 0), 10.0, 1.0, False),
        ("2020-06-01 12:00:00", (10, 0), None, 1.0, False),  # NULL fare drops the row
    ],
)
def test_validity_rule_boundaries(spark, pu, minutes_secs, fare, dist, kept):
    p = _ts(pu)
    do = p + dt.timedelta(minutes=minutes_secs[0], seconds=minutes_secs[1])
    df = _yellow(spark, [_trip(p, do, fare=fare, dist=dist, total=12.0)])
    out = silver.silver_trips([(df, YELLOW)], TripRules())
    assert out.count() == (1 if kept else 0)


def test_duration_rounding_and_enrichment(spark):
    p = _ts("2016-01-03 07:15:00")  # a Sunday
    df = _yellow(spark, [_trip(p, p + dt.timedelta(seconds=61))])
    r = silver.silver_trips([(df, YELLOW)]).collect()[0]
    assert r.trip_duration_minutes == 1.02
    assert (r.pickup_year, r.pickup_month, r.pickup_day, r.pickup_hour, r.pickup_dayofweek) == (2016, 1, 3, 7, 1)


def test_fill_happens_after_filter_and_duplicates_survive(spark):
    p = _ts("2020-06-01 12:00:00")
    row = _trip(p, p + dt.timedelta(minutes=5), passengers=None)
    df = _yellow(spark, [row, row])
    rows = silver.silver_trips([(df, YELLOW)]).collect()
    assert len(rows) == 2  # identical trips are not de-duplicated
    assert all(r.passenger_count == 1.0 and r.RatecodeID == 1.0 and r.store_and_fwd_flag == "N" for r in rows)
    assert all(r.congestion_surcharge == 0.0 and r.Airport_fee == 0.0 and r.ehail_fee is None for r in rows)


def test_reject_counts_add_up(spark):
    p = _ts("2020-06-01 12:00:00")
    rows = [
        _trip(p, p + dt.timedelta(minutes=5)),
        _trip(p, p + dt.timedelta(minutes=5), fare=-1.0),
        _trip(p, p + dt.timedelta(minutes=500)),
        _trip(_ts("2010-01-01 00:00:00"), _ts("2010-01-01 00:05:00")),
    ]
    df = _yellow(spark, rows)
    r = silver.trip_reject_counts([(df, YELLOW)], TripRules()).collect()[0]
    assert r.input_rows == 4 and r.kept == 1
    assert r.rejected_fare_non_negative == 1 and r.rejected_duration_max == 1 and r.rejected_pickup_from == 1


def test_silver_measurements_filter_and_dedup(spark):
    schema = (
        "date string, datetime_utc string, location_id long, location_name string, latitude double, longitude double, "
        "sensor_id long, parameter_id long, parameter_name string, parameter_units string, value double, timezone string"
    )
    base = ("2020-02-29", "2020-02-29T00:00:00Z", 1, "A", 40.5, -74.0, 11, 1, "pm25", "ug/m3")
    rows = [base + (5.0, "UTC"), base + (5.0, "UTC"), base + (-1.0, "UTC"), base + (None, "UTC"), base + (0.0, "UTC")]
    out = silver.silver_measurements(spark.createDataFrame(rows, schema)).orderBy("value").collect()
    assert [r.value for r in out] == [0.0, 5.0]
    assert (out[0].measurement_year, out[0].measurement_month, out[0].measurement_day, out[0].measurement_dayofweek) == (2020, 2, 29, 7)


def test_silver_fx_and_gdp(spark):
    fx = spark.createDataFrame(
        [("2020-01-02", 1.1, "USD", "EUR"), ("2020-01-02", 1.1, "USD", "EUR"), ("2020-01-03", None, "USD", "EUR")],
        "TIME_PERIOD string, OBS_VALUE double, CURRENCY string, CURRENCY_DENOM string",
    )
    rows = silver.silver_fx(fx).orderBy("date").collect()
    assert len(rows) == 2 and rows[0].usd_eur_rate == 1.1 and rows[0].fx_day == 2 and rows[1].usd_eur_rate is None
    gdp = spark.createDataFrame([("USA", "2020", 1.0), ("USA", "2020", 1.0), ("USA", "x", 2.0)], "countryiso3code string, date string, value double")
    g = silver.silver_gdp(gdp).orderBy(F.col("year").asc_nulls_last()).collect()
    assert [(r.country_code, r.year, r.gdp_usd) for r in g] == [("USA", 2020, 1.0), ("USA", None, 2.0)]


def test_rule_failures_count_null_as_rejected(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "x double")
    rules = [cleanse.Rule("x_pos", F.col("x") >= 0)]
    r = df.agg(*cleanse.rule_failures(rules)).collect()[0]
    assert r.rejected_x_pos == 2

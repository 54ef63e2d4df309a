"""Gold facts/dimensions, reports and layer invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.config import PollutantChoice, ReportOptions
from strata.operators import dims, facts
from strata.plans import reports
from strata.plans.lakehouse import Lakehouse

from .conftest import SF_SMALL

CUT = (
    "year int, month int, taxi_type string, pickup_zone_id bigint, dropoff_zone_id bigint, trip_count bigint, "
    "total_passengers bigint, total_distance double, total_fare double, total_tips double, total_revenue double, "
    "avg_trip_duration double"
)
AIR_CUT = (
    "year int, month int, location_id bigint, location_name string, parameter_name string, parameter_units string, "
    "measurement_count bigint, avg_value double, min_value double, max_value double"
)


def test_fact_taxi_daily_aggregates(spark):
    silver = spark.createDataFrame(
        [
            (2020, 1, 5, 1, 2, "yellow", 2.0, 1.5, 10.01, 1.0, 12.0, 10.0),
            (2020, 1, 5, 1, 2, "yellow", 1.0, 2.5, 20.02, 2.0, 23.0, 10.01),
            (2020, 1, 5, 3, 2, "green", 1.0, 1.0, 5.0, 0.0, 6.0, 1.0),
        ],
        "pickup_year int, pickup_month int, pickup_day int, PULocationID long, DOLocationID long, taxi_type string, "
        "passenger_count double, trip_distance double, fare_amount double, tip_amount double, total_amount double, "
        "trip_duration_minutes double",
    )
    f = schemas.conform(facts.fact_taxi_daily(silver), schemas.FACT_TAXI_DAILY)
    assert [x.name for x in f.schema.fields] == [x.name for x in schemas.FACT_TAXI_DAILY.fields]
    r = f.filter("taxi_type = 'yellow'").collect()[0]
    assert (r.date_key, r.trip_count, r.total_passengers) == (20200105, 2, 3)
    assert (r.total_distance, r.total_fare, r.total_tips, r.total_revenue) == (4.0, 30.03, 3.0, 35.0)
    assert r.avg_trip_duration == 10.01  # 10.005 rounds half up


def test_fact_air_quality_daily(spark):
    s = spark.createDataFrame(
        [(2021, 3, 1, 7, "A", "pm25", "ug/m3", v) for v in (1.00005, 2.0, 3.0)],
        "measurement_year int, measurement_month int, measurement_day int, location_id long, location_name string, "
        "parameter_name string, parameter_units string, value double",
    )
    r = facts.fact_air_quality_daily(s).collect()[0]
    assert (r.date_key, r.measurement_count, r.min_value, r.max_value) == (20210301, 3, 1.0001, 3.0)
    assert r.avg_value == 2.0


def test_dim_date_from_union_of_dates(spark):
    a = spark.createDataFrame([(dt.date(2016, 1, 1),), (dt.date(2016, 1, 3),)], "d date")
    b = spark.createDataFrame([(dt.datetime(2016, 1, 3, 15, 0),), (dt.datetime(2017, 1, 1, 1, 0),)], "t timestamp_ntz")
    d = dims.dim_date(dims.distinct_dates([(a, "d"), (b, "t")])).orderBy("date").collect()
    assert [(r.date_key, r.day_of_week, r.is_weekend, r.week_of_year, r.quarter) for r in d] == [
        (20160101, 6, 0, 1, 1),
        (20160103, 1, 1, 2, 1),
        (20170101, 1, 1, 1, 1),
    ]


def test_top_zones_null_unknown_and_ties(spark):
    cut = spark.createDataFrame(
        [
            (2020, 1, "yellow", None, 1, 100, 0, 0.0, 0.0, 0.0, 0.0, 0.0),
            (2020, 1, "yellow", 9, 1, 5, 0, 0.0, 0.0, 0.0, 0.0, 0.0),
            (2020, 1, "yellow", 2, 1, 5, 0, 0.0, 0.0, 0.0, 0.0, 0.0),
            (2020, 2, "green", 3, 1, 7, 0, 0.0, 0.0, 0.0, 0.0, 0.0),
        ],
        CUT,
    )
    zone = spark.createDataFrame([(2, "B", "Two", "x"), (3, "B", "Three", "x")], "zone_id bigint, borough string, zone_name string, service_zone string")
    out = reports.top_zones(cut, zone, ReportOptions(top_n=2)).collect()
    assert [(r.pickup_zone_id, r.zone_name, r.trip_count) for r in out] == [(3, "Three", 7), (2, "Two", 5)]
    out3 = reports.top_zones(cut, zone, ReportOptions(top_n=3)).collect()
    assert out3[2].zone_name == "Unknown" and out3[2].pickup_zone_id == 9


def _air(spark, rows):
    return spark.createDataFrame(
        [(y, m, 1, loc, p, "u", 1, v, v, v) for (y, m, loc, p, v) in rows],
        AIR_CUT,
    )


def test_pollutant_pick_matches_and_falls_back(spark):
    air = _air(spark, [(2020, 1, "A", "PM2.5", 1.0), (2020, 2, "A", "pm2x5", 2.0), (2020, 1, "A", "o3", 3.0), (2020, 2, "B", "o3", 3.0), (2020, 3, "B", "o3", 3.0), (2020, 3, "B", None, 3.0)])
    c = {r.parameter_name: r for r in reports.pollutant_candidates(air, PollutantChoice()).collect()}
    assert c["PM2.5"].selected and c["pm2x5"].selected and not c["o3"].selected and c["o3"].label == "PM2.5"
    fb = {r.parameter_name: r for r in reports.pollutant_candidates(air, PollutantChoice(pattern="zzz")).collect()}
    assert fb["o3"].selected and not fb["PM2.5"].selected and fb["o3"].label == "o3"
    # a tie on frequency is broken by the smallest name
    tie = _air(spark, [(2020, 1, "A", "b", 1.0), (2020, 1, "A", "a", 1.0)])
    sel = [r.parameter_name for r in reports.pollutant_candidates(tie, PollutantChoice(pattern="zzz")).collect() if r.selected]
    assert sel == ["a"]
    # nothing but missing names: nothing is picked
    none = reports.pollutant_candidates(_air(spark, [(2020, 1, "A", None, 1.0)]), PollutantChoice(pattern="zzz")).collect()
    assert [(r.selected, r.label) for r in none] == [(False, None)]


def test_row_counts_of_rows_and_sums(spark):
    fact = spark.createDataFrame([(2,), (3,)], "trip_count int")
    got = {r.table_name: r.row_count for r in reports.row_counts({"fact": fact, "trips": (fact, "trip_count"), "none": (fact.limit(0), "trip_count")}).collect()}
    assert got == {"fact": 2, "trips": 5, "none": 0}


def test_pollutant_reports_mean_of_means(spark):
    pm = _air(spark, [(2020, 1, "A", "pm25", 1.0), (2020, 1, "B", "pm25", 2.0), (2021, 1, "A", "pm25", 4.0), (2021, 1, None, "pm25", 8.0)])
    m = {(r.year, r.month): r.avg_value for r in reports.pollutant_monthly(pm).collect()}
    assert m == {(2020, 1): 1.5, (2021, 1): 6.0}
    loc = reports.pollutant_by_location(pm).collect()
    assert [r.location_name for r in loc] == ["A", "B"]  # NULL name dropped
    k = reports.pollutant_kpis(pm).collect()[0]
    assert (k.avg_value, k.max_value, k.min_value, k.n_locations) == (3.75, 8.0, 1.0, 2)


def test_revenue_fx_fill_with_mean_of_matched_months(spark):
    cut = spark.createDataFrame(
        [(2020, m, "yellow", 1, 1, 10, 10, 0.0, 100.0, 0.0, 110.0, 1.0) for m in (1, 2, 3)],
        CUT,
    )
    fx = spark.createDataFrame(
        [(20200101, dt.date(2020, 1, 1), 1.1, 2020, 1, 1), (20200201, dt.date(2020, 2, 1), 1.3, 2020, 2, 1)],
        "date_key int, fx_date date, usd_eur_rate double, fx_year int, fx_month int, fx_day int",
    )
    out = {r.month: r for r in reports.revenue_fx_monthly(cut, reports.fx_monthly(fx)).collect()}
    assert out[3].usd_eur_rate == 1.2
    assert out[1].total_revenue_eur == pytest.approx(110.0 / 1.1)


def test_yearly_corr_needs_three_months(spark):
    rows = []
    for y, months in ((2019, 2), (2020, 3)):
        for m in range(1, months + 1):
            rows.append((y, m, m * 10, float(m) * 2.0))
    monthly = spark.createDataFrame(rows, "year int, month int, trip_count bigint, avg_value double")
    out = reports.trip_pollution_corr_yearly(monthly).collect()
    assert [(r.year, r.correlation, r.direction) for r in out] == [(2020, 1.0, "up")]


def test_economic_kpis_and_growth(spark):
    rev = spark.createDataFrame([(2020, 1, 1, 100.0, 2.0, 50.0), (2021, 1, 1, 150.0, 2.0, 75.0)], "year int, month int, trip_count bigint, total_revenue double, usd_eur_rate double, total_revenue_eur double")
    gdp = spark.createDataFrame([("USA", 2020, 2e12)], "country_code string, year int, gdp_usd double")
    g = reports.revenue_gdp_yearly(rev, gdp).collect()
    assert [(r.year, r.revenue_growth, r.growth_direction, r.gdp_trillions) for r in g] == [(2020, None, "down", 2.0), (2021, 50.0, "up", None)]


@pytest.fixture(scope="module")
def lh(spark):
    return Lakehouse(spark, SF_SMALL)


def test_invariants_day_month_year_and_types(lh):
    silver_n = lh.silver_trips.count()
    fact_sum = lh.fact_taxi.agg(F.sum("trip_count")).collect()[0][0]
    cut_sum = lh.taxi_cut.agg(F.sum("trip_count")).collect()[0][0]
    by_type_year = reports.counts_by_type_year(lh.silver_trips).agg(F.sum("row_count")).collect()[0][0]
    yearly = lh.taxi_cut.groupBy("year").agg(F.sum("trip_count").alias("n")).agg(F.sum("n")).collect()[0][0]
    assert silver_n == fact_sum == cut_sum == by_type_year == yearly
    assert lh.fact_air.agg(F.sum("measurement_count")).collect()[0][0] == lh.silver_measurements.count()


def test_invariants_rejected_plus_kept_and_dedup_idempotent(spark, lh):
    from strata.plans.registry import QUERIES

    rc = QUERIES["reject_counts"](spark, SF_SMALL).agg(F.sum("kept"), F.sum("input_rows")).collect()[0]
    assert rc[0] == lh.silver_trips.count()
    bronze_n = lh.yellow_bronze.count() + lh.green_bronze.count()
    assert rc[1] == bronze_n
    m = lh.silver_measurements
    assert m.dropDuplicates().count() == m.count()


def test_gold_schemas_match_declared(lh):
    for df, sch in ((lh.fact_taxi, schemas.FACT_TAXI_DAILY), (lh.fact_air, schemas.FACT_AIR_QUALITY_DAILY), (lh.dim_date, schemas.DIM_DATE), (lh.dim_zone, schemas.DIM_ZONE), (lh.dim_fx, schemas.DIM_FX), (lh.dim_gdp, schemas.DIM_GDP)):
        assert schemas.same_schema(df.schema, sch)


def test_conform_rejects_missing_and_null_in_not_null(spark):
    with pytest.raises(schemas.SchemaMismatchError):
        schemas.conform(spark.createDataFrame([(1,)], "date_key int"), schemas.DIM_DATE)
    bad = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2020, 1, 1, 1, 1, None, 1)], "date_key int, date date, year int, quarter int, month int, day_of_month int, day_of_week int, is_weekend int, week_of_year int")
    with pytest.raises(Exception):
        schemas.conform(bad, schemas.DIM_DATE).collect()


def test_weighted_versus_unweighted_month_means(spark):
    fact = spark.createDataFrame(
        [(2020, 1, "yellow", 1, 2, 1, 10.0), (2020, 1, "yellow", 1, 2, 3, 20.0)],
        "year int, month int, taxi_type string, pickup_zone_id bigint, dropoff_zone_id bigint, trip_count int, avg_trip_duration double",
    ).withColumn("total_passengers", F.lit(0).cast("bigint"))
    for c in ("total_distance", "total_fare", "total_tips", "total_revenue"):
        fact = fact.withColumn(c, F.lit(0.0))
    assert facts.taxi_month_cut(fact).collect()[0].avg_trip_duration == 15.0
    assert facts.taxi_month_cut(fact, weighted=True).collect()[0].avg_trip_duration == 17.5
    pm = spark.createDataFrame(
        [(2020, 1, 1, "A", "pm25", "u", 1, 1.0, 1.0, 1.0), (2020, 1, 2, "B", "pm25", "u", 3, 3.0, 3.0, 3.0)], AIR_CUT
    )
    assert reports.pollutant_kpis(pm).collect()[0].avg_value == 2.0
    assert reports.pollutant_kpis(pm, ReportOptions(weighted=True)).collect()[0].avg_value == 2.5

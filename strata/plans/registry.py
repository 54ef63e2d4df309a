"""Named queries over a data root: one per operator group of the inventory.

Each entry is ``(spark, root) -> DataFrame``.  Most build a lazy plan; those that land files, write tables
or read the daily fact in several arms (``with_written_fact``) write below the scratch folder first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import YELLOW
from ..operators import dims, facts, standardize
from ..session import scratch_path
from ..sources import bindings
from . import ingest, landed, questions, reports, silver, warehouse
from .lakehouse import BINDING_FALLBACK, Lakehouse

Query = Callable[[SparkSession, str], DataFrame]


def _lh(spark: SparkSession, root: str) -> Lakehouse:
    return Lakehouse(spark, root)


def _silver_trips(spark, root):
    return _lh(spark, root).silver_trips


def _reject_counts(spark, root):
    std = standardize.standardize_tagged(bindings.trips_bronze(spark, root), silver.FLAVOURS, "flavour")
    return silver.reject_counts(std, Lakehouse(spark, root).rules)


def _reject_counts_written(spark, root):
    std = standardize.standardize_tagged(bindings.trips_bronze(spark, root), silver.FLAVOURS, "flavour")
    _, counts = silver.write_counted_trips(std, scratch_path(spark, "counted"), tuple(silver.FLAVOURS), Lakehouse(spark, root).rules)
    return spark.createDataFrame([(t, m, n) for t, ms in counts.items() for m, n in ms.items()], "taxi_type string, metric string, n long")


def _fact_events(spark, root):
    std = standardize.standardize(bindings.event_trips_bronze(spark, root), YELLOW)
    return schemas.conform(facts.fact_taxi_daily(silver.clean_trips(std)), schemas.FACT_TAXI_DAILY)


def _pollutant_pick(spark, root):
    lh = _lh(spark, root)
    a = reports.pollutant_candidates(lh.air_cut, lh.options.pollutant).withColumn(
        "pattern", F.lit(lh.options.pollutant.pattern)
    )
    b = reports.pollutant_candidates(lh.air_cut, BINDING_FALLBACK).withColumn("pattern", F.lit(BINDING_FALLBACK.pattern))
    return a.unionByName(b)


def _star(spark, root):
    lh = _lh(spark, root).with_written_fact()
    return dims.star_trips(lh.fact_taxi, lh.dim_date, lh.dim_zone, lh.dim_fx)


def _row_counts(spark, root):
    lh = _lh(spark, root).with_written_fact()
    return reports.row_counts(
        {
            "silver_taxi_trips": (lh.fact_taxi, "trip_count"),
            "silver_air_quality": lh.silver_measurements,
            "silver_fx_rates": lh.silver_fx,
            "silver_gdp": lh.silver_gdp,
            "FactTaxiDaily": lh.fact_taxi,
            "FactAirQualityDaily": lh.fact_air,
            "DimDate": lh.dim_date,
            "DimZone": lh.dim_zone,
            "DimFX": lh.dim_fx,
            "DimGDP": lh.dim_gdp,
        }
    )


def _summary(spark, root):
    lh = _lh(spark, root).with_written_fact()
    return reports.summary(lh.taxi_cut, lh.air_cut, lh.dim_date, lh.dim_zone, lh.dim_fx, lh.dim_gdp)


QUERIES: dict[str, Query] = {
    # silver (R01-R03)
    "silver_trips": _silver_trips,
    "silver_measurements": lambda s, r: _lh(s, r).silver_measurements,
    "silver_gdp": lambda s, r: _lh(s, r).silver_gdp,
    "silver_fx": lambda s, r: _lh(s, r).silver_fx,
    "reject_counts": _reject_counts,
    "reject_counts_written": _reject_counts_written,
    # gold (A01, A02, R04, P20-P22, J05)
    "fact_trips_daily": lambda s, r: _lh(s, r).fact_taxi,
    "fact_events_daily": _fact_events,
    "fact_measurements_daily": lambda s, r: _lh(s, r).fact_air,
    "dim_date": lambda s, r: _lh(s, r).dim_date,
    "dim_zone": lambda s, r: _lh(s, r).dim_zone,
    "dim_fx": lambda s, r: _lh(s, r).dim_fx,
    "dim_gdp": lambda s, r: _lh(s, r).dim_gdp,
    "star_trips": _star,
    # month cuts
    "trips_month_cut": lambda s, r: _lh(s, r).taxi_cut,
    "measurements_month_cut": lambda s, r: _lh(s, r).air_cut,
    # R05 mobility
    "monthly_trips": lambda s, r: reports.monthly_trips(_lh(s, r).taxi_cut),
    "monthly_avg_fare": lambda s, r: reports.monthly_avg_fare(_lh(s, r).taxi_cut),
    "top_zones": lambda s, r: (lambda lh: reports.top_zones(lh.taxi_cut, lh.dim_zone, lh.options))(_lh(s, r)),
    "type_compare": lambda s, r: reports.type_compare(_lh(s, r).taxi_cut),
    "mobility_kpis": lambda s, r: reports.mobility_kpis(_lh(s, r).taxi_cut),
    # R06 air quality
    "pollutant_pick": _pollutant_pick,
    "pollutant_monthly": lambda s, r: reports.pollutant_monthly(_lh(s, r).pollutant),
    "pollutant_by_location": lambda s, r: reports.pollutant_by_location(_lh(s, r).pollutant),
    "pollutant_seasonal": lambda s, r: reports.pollutant_seasonal(_lh(s, r).pollutant),
    "pollutant_yearly": lambda s, r: reports.pollutant_yearly(_lh(s, r).pollutant),
    "pollutant_kpis": lambda s, r: reports.pollutant_kpis(_lh(s, r).pollutant),
    # R07 correlation
    "trip_pollution_monthly": lambda s, r: _lh(s, r).trip_pollution,
    "trip_pollution_corr": lambda s, r: reports.trip_pollution_corr(_lh(s, r).trip_pollution),
    "trip_pollution_corr_yearly": lambda s, r: reports.trip_pollution_corr_yearly(_lh(s, r).trip_pollution),
    "trips_seasonal": lambda s, r: reports.trips_seasonal(_lh(s, r).taxi_cut),
    # R08 economic
    "fx_monthly": lambda s, r: _lh(s, r).fx_monthly,
    "revenue_fx_monthly": lambda s, r: _lh(s, r).revenue_fx,
    "economic_kpis": lambda s, r: (lambda lh: reports.economic_kpis(lh.revenue_fx, lh.dim_fx))(_lh(s, r)),
    "revenue_gdp_yearly": lambda s, r: (lambda lh: reports.revenue_gdp_yearly(lh.revenue_fx, lh.dim_gdp, lh.options))(
        _lh(s, r)
    ),
    # R09 summary
    "row_counts": _row_counts,
    "counts_by_type_year": lambda s, r: reports.counts_by_type_year(_lh(s, r).silver_trips),
    "measurements_by_year": lambda s, r: reports.counts_by_year(_lh(s, r).silver_measurements, "measurement_year"),
    "summary": _summary,
    # advertised questions
    "daily_corr": lambda s, r: (lambda lh: questions.daily_corr(lh.fact_taxi, lh.fact_air, lh.air_cut, lh.options))(
        _lh(s, r)
    ),
    "zone_hour_link": lambda s, r: (
        lambda lh: questions.zone_hour_link(lh.silver_trips, lh.fact_air, lh.air_cut, lh.options)
    )(_lh(s, r)),
    "revenue_per_trip": lambda s, r: (lambda lh: questions.revenue_per_trip(lh.revenue_fx, lh.dim_fx, lh.options))(
        _lh(s, r)
    ),
    "three_domain_trend": lambda s, r: (
        lambda lh: questions.three_domain_trend(lh.taxi_cut, lh.pollutant, lh.dim_gdp, lh.options)
    )(_lh(s, r)),
    # sources and sinks
    "month_manifest": ingest.month_manifest,
    "locations_in_box": ingest.locations_in_box,
    "locations_flat": ingest.locations_flat,
    "measurements_flat": ingest.measurements_flat,
    "gdp_json": ingest.gdp_json,
    "zone_csv": ingest.zone_csv,
    "fx_csv": ingest.fx_csv,
    "files_drift": ingest.files_drift,
    "sink_roundtrip": ingest.sink_roundtrip,
    # landed files and SQL text
    "files_rejected": landed.files_rejected,
    "rejects_by_reason": landed.rejects_by_reason,
    "zone_csv_file": landed.zone_csv_file,
    "fx_csv_file": landed.fx_csv_file,
    "gdp_json_file": landed.gdp_json_file,
    "locations_file": landed.locations_file,
    "measurements_file": landed.measurements_file,
    "sql_monthly_fares": landed.sql_monthly_fares,
    # tables by name
    "gold_tables": warehouse.gold_tables,
    "guarded_writes": warehouse.guarded_writes,
    "partitioned_fact": warehouse.partitioned_fact,
}

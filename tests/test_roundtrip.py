"""Layer round trip: bronze -> silver -> gold written to storage and read back;
SQL over registered views; CTAS and DROP TABLE."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from strata import schemas
from strata.plans import reports
from strata.plans.lakehouse import Lakehouse
from strata.sinks import writers
from strata.sources.tables import register_views
from tools.check_oracle import canon

from .conftest import SF_SMALL


def _rows(df):
    return canon([tuple(r) for r in df.collect()], df.columns)


def test_materialized_layers_give_same_reports(spark, tmp):
    lazy = Lakehouse(spark, SF_SMALL)
    stored = Lakehouse(spark, SF_SMALL).materialize(os.path.join(tmp, "wh"))
    for name in ("fact_taxi", "fact_air", "dim_date", "dim_zone", "dim_fx", "dim_gdp"):
        df = getattr(stored, name)
        assert df.inputFiles()  # read back from the written table
        assert schemas.same_schema(df.schema, schemas.GOLD_SCHEMAS[{
            "fact_taxi": "FactTaxiDaily", "fact_air": "FactAirQualityDaily", "dim_date": "DimDate",
            "dim_zone": "DimZone", "dim_fx": "DimFX", "dim_gdp": "DimGDP"}[name]])
    assert _rows(reports.monthly_trips(stored.taxi_cut)) == _rows(reports.monthly_trips(lazy.taxi_cut))
    # counts observed during the writes equal counts of the lazy plans
    assert stored.written_rows["silver_trips"] == lazy.silver_trips.count()
    assert stored.written_rows["fact_taxi"] == lazy.fact_taxi.count()
    assert _rows(stored.trip_pollution) == _rows(lazy.trip_pollution)


def test_sql_over_registered_views_matches_dataframe(spark):
    register_views(spark, SF_SMALL, ["nation", "region"])
    lh = Lakehouse(spark, SF_SMALL)
    lh.fact_taxi.createOrReplaceTempView("FactTaxiDaily")
    # month cut written in SQL, grouping by select aliases (valid Spark SQL)
    sql = spark.sql(
        """SELECT year, month, taxi_type, pickup_zone_id AS pz, SUM(trip_count) AS trip_count
           FROM FactTaxiDaily GROUP BY year, month, taxi_type, pz"""
    )
    df = lh.taxi_cut.select("year", "month", "taxi_type", F.col("pickup_zone_id").alias("pz"), "trip_count")
    df = df.groupBy("year", "month", "taxi_type", "pz").agg(F.sum("trip_count").alias("trip_count"))
    assert _rows(sql) == _rows(df)
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").collect()[0][0] == 25


def test_ctas_and_drop_table(spark, tmp):
    spark.range(5).createOrReplaceTempView("src_view")
    t = writers.create_table_as(spark, "strata_ctas_test", "SELECT id * 2 AS x FROM src_view", location=os.path.join(tmp, "ctas"))
    assert sorted(r.x for r in t.collect()) == [0, 2, 4, 6, 8]
    writers.drop_table(spark, "strata_ctas_test")
    assert not spark.catalog.tableExists("strata_ctas_test")

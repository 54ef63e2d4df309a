"""The gold tables as SQL statements over catalog tables, and queries over tables by name.

The statements are plain Spark SQL: a warehouse that holds the silver tables and the zone lookup can run them as
they are.  Sums are taken over decimals and rounded once, as everywhere in the library.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import GREEN, YELLOW
from ..operators.standardize import standardize
from ..schemas import SchemaMismatchError
from ..session import scratch_path
from ..sinks import catalog
from ..sources import bindings
from . import silver
from .lakehouse import Lakehouse


def _total(x: str, digits: int) -> str:
    return f"CAST(round(sum(CAST({x} AS DECIMAL(28, 10))), {digits}) AS DOUBLE)"


def _mean(x: str, digits: int) -> str:
    """The exact sum in 1e-10 units over the count, rounded half away from zero once."""
    units = f"CAST(sum(CAST({x} AS DECIMAL(28, 10))) * 10000000000 AS DECIMAL(38, 0))"
    parts = f"CAST(count({x}) * {10 ** (10 - digits)} AS DECIMAL(30, 0))"
    return f"sign({units}) * ((2 * abs({units}) + {parts}) div (2 * {parts})) / {10**digits}D"


def _key(y: str, m: str, d: str) -> str:
    return f"{y} * 10000 + {m} * 100 + {d}"


#: name -> select over ``silver_taxi_trips silver_air_quality silver_fx_rates silver_gdp zone_lookup``
GOLD_SQL = {
    "FactTaxiDaily": f"""
        SELECT pickup_year AS year, pickup_month AS month, pickup_day AS day, {_key("pickup_year", "pickup_month", "pickup_day")} AS date_key,
               PULocationID AS pickup_zone_id, DOLocationID AS dropoff_zone_id, taxi_type, CAST(count(*) AS INT) AS trip_count,
               CAST(sum(passenger_count) AS BIGINT) AS total_passengers, {_total("trip_distance", 2)} AS total_distance,
               {_total("fare_amount", 2)} AS total_fare, {_total("tip_amount", 2)} AS total_tips,
               {_total("total_amount", 2)} AS total_revenue, {_mean("trip_duration_minutes", 2)} AS avg_trip_duration
        FROM {{db}}.silver_taxi_trips GROUP BY pickup_year, pickup_month, pickup_day, PULocationID, DOLocationID, taxi_type""",
    "FactAirQualityDaily": f"""
        SELECT measurement_year AS year, measurement_month AS month, measurement_day AS day,
               {_key("measurement_year", "measurement_month", "measurement_day")} AS date_key, location_id, location_name, parameter_name, parameter_units,
               CAST(count(*) AS INT) AS measurement_count, {_mean("value", 4)} AS avg_value,
               round(min(value), 4) AS min_value, round(max(value), 4) AS max_value
        FROM {{db}}.silver_air_quality
        GROUP BY measurement_year, measurement_month, measurement_day, location_id, location_name, parameter_name, parameter_units""",
    "DimDate": f"""
        SELECT {_key("year(d)", "month(d)", "day(d)")} AS date_key, d AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
               day(d) AS day_of_month, dayofweek(d) AS day_of_week, CAST(dayofweek(d) IN (1, 7) AS INT) AS is_weekend,
               CAST((dayofyear(d) + dayofweek(trunc(d, 'YEAR')) - 2) div 7 + 1 AS INT) AS week_of_year
        FROM (SELECT make_date(year, month, day) AS d FROM {{db}}.FactTaxiDaily
              UNION SELECT date FROM {{db}}.silver_fx_rates
              UNION SELECT measurement_date FROM {{db}}.silver_air_quality)""",
    "DimZone": "SELECT LocationID AS zone_id, Borough AS borough, Zone AS zone_name, service_zone FROM {db}.zone_lookup",
    "DimFX": f"SELECT {_key('fx_year', 'fx_month', 'fx_day')} AS date_key, date AS fx_date, usd_eur_rate, fx_year, fx_month, fx_day FROM {{db}}.silver_fx_rates",
    "DimGDP": "SELECT country_code, year, gdp_usd FROM {db}.silver_gdp",
}


def build_silver(spark: SparkSession, root: str, db: str) -> None:
    """Silver and the zone lookup as tables of ``db``; each flavour's trips pass through a staging table."""
    lh = Lakehouse(spark, root)
    staging = f"{db}.staging_trips"
    catalog.drop(spark, staging)
    catalog.replace(standardize(lh.yellow_bronze, YELLOW), staging, strict=True)
    catalog.append(standardize(lh.green_bronze, GREEN), staging)
    catalog.replace(silver.clean_trips(spark.table(staging), lh.rules), f"{db}.silver_taxi_trips")
    catalog.drop(spark, staging)
    catalog.replace(lh.silver_measurements, f"{db}.silver_air_quality")
    catalog.replace(lh.silver_fx, f"{db}.silver_fx_rates", strict=True)
    catalog.replace(lh.silver_gdp, f"{db}.silver_gdp", strict=True)
    catalog.replace(bindings.zones_bronze(spark, root), f"{db}.zone_lookup")


def build_gold(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    """The six gold tables of ``db`` by their statements, in an order in which each finds what it reads."""
    return {name: catalog.create_as(spark, f"{db}.{name}", select.format(db=db)) for name, select in GOLD_SQL.items()}


def gold_tables(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all six tables made by CTAS over catalog tables."""
    db = catalog.database(spark, scratch_path(spark, "warehouse"))
    build_silver(spark, root, db)
    made = build_gold(spark, db)
    for name, df in made.items():
        if not schemas.same_schema(schemas.conform(df, schemas.GOLD_SCHEMAS[name]).schema, schemas.GOLD_SCHEMAS[name]):
            raise SchemaMismatchError(f"{name} has other columns than declared")
    rows = [df.select(F.lit(name).alias("table_name"), "*") for name, df in made.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def guarded_writes(spark: SparkSession, root: str) -> DataFrame:
    """What each kind of write did to a table, and how many rows it had after."""
    db = catalog.database(spark, scratch_path(spark, "guards"))
    name = f"{db}.gdp"
    gdp = Lakehouse(spark, root).silver_gdp
    other = gdp.withColumn("gdp_usd", F.col("gdp_usd").cast("decimal(20, 2)"))
    last = F.col("year") == gdp.agg(F.max("year")).scalar()
    dies = gdp.withColumn("gdp_usd", F.when(last, F.raise_error("this write dies half-way").cast("double")).otherwise(F.col("gdp_usd")))
    steps = [
        ("strict overwrite of no table", lambda: catalog.replace(gdp, name, strict=True)),
        ("strict overwrite, same columns", lambda: catalog.replace(gdp, name, strict=True)),
        ("strict overwrite, other columns", lambda: catalog.replace(other, name, strict=True)),
        ("append, same columns", lambda: catalog.append(gdp, name)),
        ("append, other columns", lambda: catalog.append(other, name)),
        ("overwrite that dies", lambda: catalog.replace(dies, name)),
        ("overwrite with itself, each row once", lambda: catalog.replace(spark.table(name).distinct(), name)),
        ("overwrite, other columns", lambda: catalog.replace(other, name)),
        ("drop", lambda: catalog.drop(spark, name)),
        ("drop of no table", lambda: catalog.drop(spark, name)),
    ]
    out = []
    for i, (step, write) in enumerate(steps):
        outcome = "done"
        try:
            write()
        except SchemaMismatchError:
            outcome = "refused"
        except Exception as e:  # noqa: BLE001 - only the planned death is an outcome
            if "dies half-way" not in str(e):
                raise
            outcome = "died"
        out.append((i + 1, step, outcome, spark.table(name).count() if catalog.exists(spark, name) else None))
    return spark.createDataFrame(out, "no int, step string, outcome string, row_count long")


def partitioned_fact(spark: SparkSession, root: str) -> DataFrame:
    """Trips of the second quarters, from a fact laid out by year and month; months come from the calendar,
    and the scan of the fact opens only those that the join asks for."""
    db = catalog.database(spark, scratch_path(spark, "parts"))
    lh = Lakehouse(spark, root)
    fact = catalog.replace(lh.fact_taxi.hint("rebalance", "year", "month"), f"{db}.fact", partition_by=("year", "month"))
    lh.__dict__["fact_taxi"] = fact.select(*schemas.FACT_TAXI_DAILY.names)
    months = catalog.replace(lh.dim_date.select("year", "month", "quarter").distinct(), f"{db}.months")
    return (
        fact.join(months.filter("quarter = 2"), ["year", "month"])
        .groupBy("year", "month", "taxi_type")
        .agg(F.sum("trip_count").cast("long").alias("trip_count"), F.sum("total_passengers").alias("total_passengers"))
    )

"""Queries exercising the sources and sinks end to end over data derived from
the benchmark tables (S01-S12, K01-K08, P15-P19, J06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import GREEN, YELLOW, BoundingBox
from ..session import scratch_path
from ..sinks import writers
from ..operators.standardize import union_all
from ..sources import bindings, files, payloads
from . import silver
from .lakehouse import BINDING_RULES, Lakehouse


def month_manifest(spark: SparkSession, root: str) -> DataFrame:
    """S12 + S02: expected monthly files of both flavours over the binding's date window, held against a
    listing of the landing; no trip is read for it."""
    prefixes = ["yellow_tripdata_", "green_tripdata_\n"]  # a stray newline is trimmed
    base = scratch_path(spark, "months")

    def land(df: DataFrame, prefix: str, col: str) -> None:
        month = F.date_format(F.col(col).cast("string").try_cast("timestamp_ntz"), "yyyy-MM")
        names = df.select(F.concat(F.lit(prefix), F.coalesce(month, F.lit("unknown")), F.lit(".parquet")).alias("file_name"), col, "fare_amount")
        names.hint("rebalance", "file_name").write.partitionBy("file_name").parquet(f"{base}/{prefix}")

    land(bindings.yellow_trips_bronze(spark, root), "yellow_tripdata_", "tpep_pickup_datetime")
    land(bindings.green_trips_bronze(spark, root), "green_tripdata_", "lpep_pickup_datetime")
    return files.month_manifest(spark, "1996-01", "2000-12", prefixes, files.landed_names(spark, base))


def _locations(spark: SparkSession, root: str) -> DataFrame:
    return payloads.parse_locations(bindings.location_pages_text(spark, root))


def locations_in_box(spark: SparkSession, root: str) -> DataFrame:
    """S08 + P17: parsed location pages filtered to the bounding box."""
    box = payloads.in_box(_locations(spark, root), BoundingBox())
    return box.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.size("sensors").alias("n_sensors"),
    )


def locations_flat(spark: SparkSession, root: str) -> DataFrame:
    """Flattened attributes of the in-box locations."""
    return payloads.flatten_locations(payloads.in_box(_locations(spark, root), BoundingBox()))


def measurements_flat(spark: SparkSession, root: str) -> DataFrame:
    """S09 + J06 + P18: in-box locations x sensors x daily readings."""
    locs = payloads.in_box(_locations(spark, root), BoundingBox())
    days = payloads.parse_sensor_days(bindings.sensor_days_text(spark, root))
    return payloads.flatten_measurements(locs, days)


def gdp_json(spark: SparkSession, root: str) -> DataFrame:
    """S06 + S07 + U02 + P15 + P16: country documents -> GDP records."""
    return payloads.gdp_records(bindings.gdp_documents_text(spark, root))


def zone_csv(spark: SparkSession, root: str) -> DataFrame:
    """Zone lookup lines typed by the 4-column schema."""
    return payloads.parse_csv_lines(bindings.zone_csv_lines(spark, root), payloads.ZONE_CSV)


def fx_csv(spark: SparkSession, root: str) -> DataFrame:
    """S05 + R03: 32-column FX lines typed, then the silver FX step."""
    return silver.silver_fx(payloads.parse_csv_lines(bindings.fx_csv_lines(spark, root), payloads.FX_CSV))


def files_drift(spark: SparkSession, root: str) -> DataFrame:
    """S01 + S02 + S03: land the two trip flavours as monthly parquet files with
    different column types, read the folders back with the drift-tolerant loader
    and run the silver step on the result (equals ``silver_trips``)."""
    base = scratch_path(spark, "landing")
    yellow = bindings.yellow_trips_bronze(spark, root)
    odd = F.year("tpep_pickup_datetime") % 2 == 1
    # odd years land with an older layout: text timestamps, integer passenger count
    older = yellow.filter(odd).withColumns(
        {
            "tpep_pickup_datetime": F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss"),
            "tpep_dropoff_datetime": F.date_format("tpep_dropoff_datetime", "yyyy-MM-dd HH:mm:ss"),
            "passenger_count": F.col("passenger_count").cast("int"),
        }
    )
    landings = (
        (yellow.filter(~odd), "yellow/current", "tpep_pickup_datetime"),
        (older, "yellow/older", "tpep_pickup_datetime"),
        (bindings.green_trips_bronze(spark, root), "green", "lpep_pickup_datetime"),
    )
    for df, folder, col in landings:
        month = F.coalesce(F.date_format(F.col(col).cast("string").try_cast("timestamp_ntz"), "yyyy-MM"), F.lit("unknown"))
        # files per month, as the monthly drops arrive; a large month has several
        df.withColumn("_month", month).hint("rebalance", "_month").write.mode("overwrite").partitionBy("_month").parquet(
            f"{base}/{folder}"
        )
    loaded = [files.load_parquet_set(spark, f"{base}/{flavour}", spec).data for flavour, spec in (("yellow", YELLOW), ("green", GREEN))]
    return silver.clean_trips(union_all(loaded), BINDING_RULES)


def sink_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Write the gold tables (schema-checked), append
    one of them twice, read everything back and count rows per table."""
    lh = Lakehouse(spark, root).with_written_fact()
    base = scratch_path(spark, "gold")
    gold = {
        "FactTaxiDaily": lh.fact_taxi,
        "FactAirQualityDaily": lh.fact_air,
        "DimDate": lh.dim_date,
        "DimZone": lh.dim_zone,
        "DimFX": lh.dim_fx,
        "DimGDP": lh.dim_gdp,
    }
    for name, df in gold.items():
        conformed = schemas.conform(df, schemas.GOLD_SCHEMAS[name])
        writers.overwrite(conformed, f"{base}/{name}", allow_schema_change=False)
    writers.append(schemas.conform(lh.dim_zone, schemas.DIM_ZONE), f"{base}/DimZone")
    writers.write_mapped(lh.dim_gdp, f"{base}/GDP_mapped", {"country_code": "countryiso3code", "year": "date", "gdp_usd": "value"})
    writers.write_if_any(lh.dim_gdp.filter(F.lit(False)), f"{base}/never_written")
    names = list(gold) + ["GDP_mapped"]
    arms = [
        spark.read.parquet(f"{base}/{n}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    out = arms[0]
    for a in arms[1:]:
        out = out.unionByName(a)
    return out

"""Queries that land files derived from the tables and read them with the file readers.

The landing folders lie below the scratch folder; their contents grow with the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import YELLOW, BoundingBox
from ..session import scratch_path
from ..sources import bindings, files, payloads
from . import silver
from .lakehouse import Lakehouse

# the window of days that ``measurements_file`` asks for
WINDOW_FROM, WINDOW_TO = "1996-01-01", "1997-12-31"


def _damaged(df: DataFrame, base: str) -> None:
    """Files of ``df`` with a sound footer and overwritten page headers, below ``base``/damaged.

    A parquet file begins and ends with the same four bytes; here they are the line ends of files of one line.
    """
    spark = df.sparkSession
    df.write.option("maxRecordsPerFile", 100_000).parquet(f"{base}_whole")
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{base}_whole")
    body = F.overlay("content", F.lit(b"\xff" * 400), F.lit(5), F.lit(400))
    line = F.expr("cast(substr(body, 1, length(body) - 4) as string)")
    lines = whole.select(body.alias("body")).select(line.alias("value"))
    lines.write.options(lineSep="PAR1", maxRecordsPerFile=1).text(f"{base}/damaged")


def files_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Verdict per landing: good files next to mistyped, incomplete, corrupt and damaged ones."""
    base = scratch_path(spark, "rejects")
    yellow = bindings.yellow_trips_bronze(spark, root)
    yellow.write.parquet(f"{base}/current")
    yellow.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").isNotNull()).write.parquet(f"{base}/mistyped")
    yellow.drop("fare_amount").write.parquet(f"{base}/incomplete")
    bindings.zone_csv_lines(spark, root).write.text(f"{base}/corrupt")
    _damaged(yellow, base)
    got = files.load_parquet_set(spark, base, YELLOW, pattern="part-*")
    read = got.data.agg(F.count(F.lit(1)).alias("n")).scalar()
    verdicts = got.manifest.select(F.element_at(F.split("path", "/"), -2).alias("landing"), "status").distinct()
    return verdicts.withColumn("n_rows", F.when(F.col("status") == "accepted", read).otherwise(F.lit(0).cast("bigint")))


def rejects_by_reason(spark: SparkSession, root: str) -> DataFrame:
    """Landed texts with faults: rows taken, and records set apart by reason."""
    base = scratch_path(spark, "faulty")
    for name, text in bindings.faulty_text(spark, root).items():
        text.write.option("maxRecordsPerFile", 1 if name == "gdp" else 0).text(f"{base}/{name}")
    checked = {
        "zones": payloads.checked_csv(payloads.read_lines(spark, f"{base}/zones", payloads.ZONE_CSV, col="line"), payloads.ZONE_CSV),
        "rates": payloads.checked_csv(payloads.read_lines(spark, f"{base}/rates", payloads.FX_CSV, col="line"), payloads.FX_CSV),
        "locations": payloads.checked_locations(payloads.read_lines(spark, f"{base}/locations")),
        "readings": payloads.checked_sensor_days(payloads.read_lines(spark, f"{base}/readings")),
        "gdp": payloads.checked_gdp(payloads.read_lines(spark, f"{base}/gdp", whole=True)),
    }
    reasons = []
    for name, c in checked.items():
        reasons += [c.rejects.select(F.lit(name).alias("source"), "reason"), c.rows.select(F.lit(name).alias("source"), F.lit("accepted").alias("reason"))]
    return reduce(lambda a, b: a.unionByName(b), reasons).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


def zone_csv_file(spark: SparkSession, root: str) -> DataFrame:
    """The zone lookup as CSV files with a header line."""
    path = f"{scratch_path(spark, 'zones')}/zones.csv"
    bindings.zones_bronze(spark, root).write.option("header", True).csv(path)
    return payloads.read_csv(spark, path, payloads.ZONE_CSV)


def fx_csv_file(spark: SparkSession, root: str) -> DataFrame:
    """S05 + R03: the 32-column FX export as CSV files with a header line, then the silver step."""
    path = f"{scratch_path(spark, 'fx')}/fx.csv"
    export = payloads.parse_csv_lines(bindings.fx_csv_lines(spark, root), payloads.FX_CSV)
    export.write.options(header=True, emptyValue="").csv(path)
    return silver.silver_fx(payloads.read_csv(spark, path, payloads.FX_CSV))


def gdp_json_file(spark: SparkSession, root: str) -> DataFrame:
    """S06 + S07 + U02: one document per country and file, all read at once."""
    path = f"{scratch_path(spark, 'gdp')}/gdp"
    bindings.gdp_documents_text(spark, root).write.option("maxRecordsPerFile", 1).text(path)
    return payloads.read_gdp_json(spark, path)


def _landed_locations(spark: SparkSession, root: str, base: str) -> DataFrame:
    bindings.location_pages_text(spark, root).select("value").write.text(f"{base}/locations")
    return payloads.in_box(payloads.read_locations(spark, f"{base}/locations"), BoundingBox())


def locations_file(spark: SparkSession, root: str) -> DataFrame:
    """S08 + P17 + P19: landed location pages, flattened."""
    return payloads.flatten_locations(_landed_locations(spark, root, scratch_path(spark, "locations")))


def measurements_file(spark: SparkSession, root: str) -> DataFrame:
    """S08 + S09 + J06 + P18: landed pages and readings, for a window of days."""
    base = scratch_path(spark, "sensors")
    bindings.sensor_days_text(spark, root).write.text(f"{base}/sensor_days")
    days = payloads.read_sensor_days(spark, f"{base}/sensor_days", WINDOW_FROM, WINDOW_TO)
    return payloads.flatten_measurements(_landed_locations(spark, root, base), days)


def sql_monthly_fares(spark: SparkSession, root: str) -> DataFrame:
    """SQL text over the daily fact."""
    return spark.sql(
        """
        SELECT taxi_type, year, month, SUM(trip_count) AS trips, CAST(SUM(CAST(total_fare AS DECIMAL(28, 2))) AS DOUBLE) AS fares
        FROM {fact} GROUP BY taxi_type, year, month""",
        fact=Lakehouse(spark, root).fact_taxi,
    )

"""Gold facts and their month cuts.

Sums and averages are exact and rounded once at the end (see
``functions.fixedpoint``): source values keep their decimals until then.  The hash aggregates are
partial + final, so a hot key contributes one row per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.fixedpoint import SOURCE_SCALE, exact_round_avg, exact_round_ratio, exact_round_sum, to_units, units_sum, units_to_double

MONEY_SCALE = 2  # decimals of the fact's own money and distance sums
DURATION_SCALE = 2  # trip_duration_minutes is rounded to 2 digits in silver
VALUE_SCALE = 4  # decimals of the fact's own means


def fact_taxi_daily(silver_trips: DataFrame) -> DataFrame:
    """One row per (day, pickup zone, dropoff zone, taxi type)."""
    return (
        silver_trips.groupBy(
            F.col("pickup_year").alias("year"),
            F.col("pickup_month").alias("month"),
            F.col("pickup_day").alias("day"),
            F.col("PULocationID").alias("pickup_zone_id"),
            F.col("DOLocationID").alias("dropoff_zone_id"),
            "taxi_type",
        )
        .agg(
            F.count(F.lit(1)).cast("int").alias("trip_count"),
            F.sum("passenger_count").cast("bigint").alias("total_passengers"),
            exact_round_sum("trip_distance", SOURCE_SCALE, 2).alias("total_distance"),
            exact_round_sum("fare_amount", SOURCE_SCALE, 2).alias("total_fare"),
            exact_round_sum("tip_amount", SOURCE_SCALE, 2).alias("total_tips"),
            exact_round_sum("total_amount", SOURCE_SCALE, 2).alias("total_revenue"),
            exact_round_avg("trip_duration_minutes", DURATION_SCALE, 2).alias("avg_trip_duration"),
        )
        .withColumn("date_key", date_key("year", "month", "day"))
    )


def fact_air_quality_daily(silver_measurements: DataFrame) -> DataFrame:
    """One row per (day, location, parameter, unit); means rounded to 4 digits at the end."""
    v = F.col("value")
    return (
        silver_measurements.groupBy(
            F.col("measurement_year").alias("year"),
            F.col("measurement_month").alias("month"),
            F.col("measurement_day").alias("day"),
            "location_id",
            "location_name",
            "parameter_name",
            "parameter_units",
        )
        .agg(
            F.count(F.lit(1)).cast("int").alias("measurement_count"),
            exact_round_avg(v, SOURCE_SCALE, 4).alias("avg_value"),
            F.round(F.min(v), 4).alias("min_value"),
            F.round(F.max(v), 4).alias("max_value"),
        )
        .withColumn("date_key", date_key("year", "month", "day"))
    )


def weighted_mean(col: str, weight: str, scale: int, digits: int) -> F.Column:
    """Aggregate: mean of ``col`` weighted by ``weight``, exact, rounded to ``digits``."""
    return exact_round_ratio(F.sum(to_units(col, scale) * F.col(weight)), F.sum(weight), scale, digits)


def taxi_month_cut(fact: DataFrame, digits: int = 6, weighted: bool = False) -> DataFrame:
    """Month re-aggregation keeping zones and type.

    ``avg_trip_duration`` is the unweighted mean of the daily means (the original
    semantics) or, with ``weighted``, the mean weighted by the daily trip counts;
    computed exactly and rounded to ``digits``.
    """
    return fact.groupBy("year", "month", "taxi_type", "pickup_zone_id", "dropoff_zone_id").agg(
        F.sum("trip_count").cast("bigint").alias("trip_count"),
        F.sum("total_passengers").cast("bigint").alias("total_passengers"),
        units_to_double(units_sum("total_distance", MONEY_SCALE), MONEY_SCALE).alias("total_distance"),
        units_to_double(units_sum("total_fare", MONEY_SCALE), MONEY_SCALE).alias("total_fare"),
        units_to_double(units_sum("total_tips", MONEY_SCALE), MONEY_SCALE).alias("total_tips"),
        units_to_double(units_sum("total_revenue", MONEY_SCALE), MONEY_SCALE).alias("total_revenue"),
        (
            weighted_mean("avg_trip_duration", "trip_count", DURATION_SCALE, digits)
            if weighted
            else exact_round_avg("avg_trip_duration", DURATION_SCALE, digits)
        ).alias("avg_trip_duration"),
    )


def air_month_cut(fact: DataFrame, digits: int = 6, weighted: bool = False) -> DataFrame:
    """Month re-aggregation: sum of counts, mean of daily means, min of mins, max of maxes."""
    return fact.groupBy("year", "month", "location_id", "location_name", "parameter_name", "parameter_units").agg(
        F.sum("measurement_count").cast("bigint").alias("measurement_count"),
        (
            weighted_mean("avg_value", "measurement_count", VALUE_SCALE, digits)
            if weighted
            else exact_round_avg("avg_value", VALUE_SCALE, digits)
        ).alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )

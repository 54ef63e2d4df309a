"""Gold dimensions and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import (
    date_key_of,
    is_weekend_sun1,
    quarter_int_div,
    week_of_year_sun,
    weekday_sun1,
)
from .joins import join_dimension



def distinct_dates(frames_and_cols: list[tuple[DataFrame, str]]) -> DataFrame:
    """Set union of the distinct calendar dates of several tables.

    Each arm is reduced to its distinct dates first (partial aggregation on the
    executors), so the union shuffles at most one row per date per task.
    """
    arms = [df.select(F.to_date(F.col(c)).alias("day")).distinct() for df, c in frames_and_cols]
    out = arms[0]
    for a in arms[1:]:
        out = out.unionByName(a)
    return out.distinct()


def dim_date(dates: DataFrame, col: str = "day") -> DataFrame:
    """Calendar attributes with Sunday-based weekdays and weeks."""
    d = F.col(col)
    return dates.select(
        date_key_of(d).alias("date_key"),
        d.alias("date"),
        F.year(d).cast("int").alias("year"),
        quarter_int_div(d).alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        weekday_sun1(d).alias("day_of_week"),
        is_weekend_sun1(d).alias("is_weekend"),
        week_of_year_sun(d).alias("week_of_year"),
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    """P20: zone lookup -> DimZone."""
    return zones.select(
        F.col("LocationID").cast("bigint").alias("zone_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )


def dim_fx(silver_fx: DataFrame) -> DataFrame:
    """Silver FX -> DimFX with an integer date key."""
    return silver_fx.select(
        (F.col("fx_year") * 10000 + F.col("fx_month") * 100 + F.col("fx_day")).cast("int").alias("date_key"),
        F.col("date").alias("fx_date"),
        "usd_eur_rate",
        "fx_year",
        "fx_month",
        "fx_day",
    )


def dim_gdp(silver_gdp: DataFrame) -> DataFrame:
    """Silver GDP -> DimGDP."""
    return silver_gdp.select("country_code", "year", "gdp_usd")


def star_trips(fact: DataFrame, dim_dt: DataFrame, zone: DataFrame, fx: DataFrame) -> DataFrame:
    """Trip fact joined to its dimensions; DimZone plays two roles.

    Dimensions are joined with ``join_dimension``: broadcast while their measured
    size is bounded, shuffle join beyond that.  All joins are left joins so no
    fact row is lost to a missing dimension member.
    """
    pu = zone.select(
        F.col("zone_id").alias("pu_zone_id"),
        F.col("zone_name").alias("pickup_zone_name"),
        F.col("borough").alias("pickup_borough"),
    )
    do = zone.select(
        F.col("zone_id").alias("do_zone_id"),
        F.col("zone_name").alias("dropoff_zone_name"),
        F.col("borough").alias("dropoff_borough"),
    )
    dd = dim_dt.select(
        F.col("date_key").alias("dd_date_key"), "quarter", "day_of_week", "is_weekend", "week_of_year"
    )
    fxd = fx.select(F.col("date_key").alias("fx_date_key"), "usd_eur_rate")
    # DimDate holds one row per distinct calendar day (a proven bound): broadcast.
    # DimFX is one row per day only by convention of the source, so its join is
    # left to the measured-size decision of Catalyst/AQE.
    out = join_dimension(fact, dd, F.col("date_key") == F.col("dd_date_key"))
    out = join_dimension(out, fxd, F.col("date_key") == F.col("fx_date_key"))
    out = join_dimension(out, pu, F.col("pickup_zone_id") == F.col("pu_zone_id"))
    out = join_dimension(out, do, F.col("dropoff_zone_id") == F.col("do_zone_id"))
    return out.drop("dd_date_key", "fx_date_key", "pu_zone_id", "do_zone_id")

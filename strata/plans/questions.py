"""The four analytical questions the project advertises (Q01-Q04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PollutantChoice, ReportOptions
from ..functions.fixedpoint import SOURCE_SCALE, exact_round_avg, exact_round_ratio
from ..functions.stats import corr_band, pct_change, safe_corr
from ..operators.facts import MONEY_SCALE, VALUE_SCALE
from ..operators.joins import join_dimension
from . import reports



def daily_pollutant(fact_air: DataFrame, air_cut: DataFrame, choice: PollutantChoice, digits: int) -> DataFrame:
    """Mean daily value of the selected pollutant, one row per date_key."""
    pick = reports.pollutant_candidates(air_cut, choice).filter("selected").select("parameter_name")
    # the pick has one row per selected parameter; its join strategy is left to
    # the measured-size decision of Catalyst/AQE (no proven bound on parameters)
    pm = fact_air.join(pick, "parameter_name", "left_semi")
    return pm.groupBy("date_key").agg(exact_round_avg("avg_value", VALUE_SCALE, digits).alias("pollutant"))


def daily_corr(fact_taxi: DataFrame, fact_air: DataFrame, air_cut: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Q01: correlation of daily trips with the daily pollutant level."""
    trips = fact_taxi.groupBy("date_key").agg(F.sum("trip_count").cast("bigint").alias("trip_count"))
    pol = daily_pollutant(fact_air, air_cut, opts.pollutant, opts.digits)
    j = join_dimension(trips, pol, "date_key", "inner")
    return j.agg(
        F.round(safe_corr("trip_count", "pollutant"), 6).alias("correlation"),
        F.count(F.lit(1)).alias("n_days"),
    ).withColumn("band", corr_band("correlation", opts.corr_band))


def zone_hour_link(
    silver_trips: DataFrame, fact_air: DataFrame, air_cut: DataFrame, opts: ReportOptions = ReportOptions()
) -> DataFrame:
    """Q02: pickup zones and pickup hours whose daily demand moves most with the
    daily pollutant level (top ``top_n`` of each by absolute correlation)."""
    pol = daily_pollutant(fact_air, air_cut, opts.pollutant, opts.digits)
    # one pass over the trips: each trip contributes a (zone) key and an (hour)
    # key, so both dimensions share one scan and one partial aggregation
    keys = F.array(
        F.struct(F.lit("zone").alias("dimension"), F.col("PULocationID").cast("long").alias("key")),
        F.struct(F.lit("hour").alias("dimension"), F.col("pickup_hour").cast("long").alias("key")),
    )
    date_key = (F.col("pickup_year") * 10000 + F.col("pickup_month") * 100 + F.col("pickup_day")).cast("int")
    daily = (
        silver_trips.select(F.explode(keys).alias("k"), date_key.alias("date_key"))
        .select("k.dimension", "k.key", "date_key")
        .filter(F.col("key").isNotNull())
        .groupBy("dimension", "key", "date_key")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    j = join_dimension(daily, pol, "date_key", "inner")
    both = j.groupBy("dimension", "key").agg(
        F.round(safe_corr("trips", "pollutant"), 6).alias("correlation"),
        F.count(F.lit(1)).alias("n_days"),
    )
    # at most (#zones + 24) rows: partition by dimension is bounded
    w = Window.partitionBy("dimension").orderBy(F.abs("correlation").desc_nulls_last(), F.col("key").asc())
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= opts.top_n)


def revenue_per_trip(revenue_fx: DataFrame, dim_fx: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Q03: revenue per trip in USD and EUR per month, and the exchange-rate effect
    (EUR at the month's rate minus EUR at the period's mean daily rate)."""
    mean_rate = dim_fx.agg(exact_round_avg("usd_eur_rate", SOURCE_SCALE, opts.digits)).scalar()
    usd_units = F.rint(F.col("total_revenue") * 100).cast("long")
    per_trip = exact_round_ratio(usd_units, F.col("trip_count"), MONEY_SCALE, opts.digits)
    return (
        revenue_fx.select(
            "year",
            "month",
            "trip_count",
            per_trip.alias("usd_per_trip"),
            "usd_eur_rate",
        )
        .withColumn("eur_per_trip", F.col("usd_per_trip") / F.col("usd_eur_rate"))
        .withColumn("eur_per_trip_at_mean_rate", F.col("usd_per_trip") / mean_rate)
        .withColumn("fx_effect", F.col("eur_per_trip") - F.col("eur_per_trip_at_mean_rate"))
        .orderBy("year", "month")
    )


def three_domain_trend(taxi_cut: DataFrame, pm: DataFrame, dim_gdp: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Q04: yearly trips, pollutant level and GDP side by side with their growth."""
    trips = taxi_cut.groupBy("year").agg(F.sum("trip_count").cast("bigint").alias("trip_count"))
    air = pm.groupBy("year").agg(exact_round_avg("avg_value", reports.CUT_DIGITS, opts.digits).alias("pollutant"))
    gdp = dim_gdp.filter(F.col("country_code") == opts.country).select("year", "gdp_usd")
    j = trips.join(air, "year", "full").join(gdp, "year", "full")
    return (
        j.withColumn("trips_growth", pct_change("trip_count", "year"))
        .withColumn("pollutant_growth", pct_change("pollutant", "year"))
        .withColumn("gdp_growth", pct_change("gdp_usd", "year"))
        .orderBy("year")
    )


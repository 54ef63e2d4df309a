"""Report frames built on the gold layer.

Every report stays a DataFrame; nothing is collected to build it.  Reports start
from the month cuts (A03/A04), which are bounded by months x zones x types, so
the un-partitioned windows used here (share of total, fill with the mean,
percent change) run on frames of at most a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PollutantChoice, ReportOptions
from ..functions.dates import year_month_label
from ..functions.fixedpoint import SOURCE_SCALE, exact_round_avg, exact_round_ratio, units_sum, units_to_double
from ..functions.stats import corr_band, pct_change, safe_corr, sign_flag
from ..operators.facts import MONEY_SCALE
from ..operators.joins import join_dimension

# The month cut keeps report averages to this many digits (ReportOptions.digits).
CUT_DIGITS = 6


def _money_sum(col: str) -> F.Column:
    return units_to_double(units_sum(col, MONEY_SCALE), MONEY_SCALE)


def _mean(col: str, opts: ReportOptions, scale: int = CUT_DIGITS) -> F.Column:
    """Mean of month-cut means: unweighted (original semantics) or weighted by
    the number of measurements behind each mean (``opts.weighted``)."""
    if opts.weighted:
        return exact_round_ratio(
            F.sum(F.rint(F.col(col) * 10**scale).cast("long") * F.col("measurement_count")),
            F.sum("measurement_count"),
            scale,
            opts.digits,
        )
    return exact_round_avg(col, scale, opts.digits)


# ---------------------------------------------------------------- R05 mobility


def monthly_trips(taxi_cut: DataFrame) -> DataFrame:
    """A05 + P31 + O01: trips per month with a 'YYYY-MM' label."""
    return (
        taxi_cut.groupBy("year", "month")
        .agg(F.sum("trip_count").cast("bigint").alias("trip_count"))
        .withColumn("year_month", year_month_label("year", "month"))
        .orderBy("year", "month")
    )


def monthly_avg_fare(taxi_cut: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Average fare per trip = sum of fares / sum of trips, per month."""
    return (
        taxi_cut.groupBy("year", "month")
        .agg(
            _money_sum("total_fare").alias("total_fare"),
            F.sum("trip_count").cast("bigint").alias("trip_count"),
            exact_round_ratio(units_sum("total_fare", MONEY_SCALE), F.sum("trip_count"), MONEY_SCALE, opts.digits).alias(
                "avg_fare"
            ),
        )
        .withColumn("year_month", year_month_label("year", "month"))
        .orderBy("year", "month")
    )


def top_zones(taxi_cut: DataFrame, zone: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A07 + J01 + O02 + P26: busiest pickup zones.

    NULL zone ids are dropped (as a pandas group-by does); ids without a zone
    row are kept with the name 'Unknown'; ties are broken by zone id.
    """
    per_zone = (
        taxi_cut.filter(F.col("pickup_zone_id").isNotNull())
        .groupBy("pickup_zone_id")
        .agg(F.sum("trip_count").cast("bigint").alias("trip_count"))
    )
    z = zone.select(F.col("zone_id"), F.col("zone_name"), F.col("borough"))
    joined = join_dimension(per_zone, z, per_zone.pickup_zone_id == z.zone_id, "left")
    return (
        joined.select(
            "pickup_zone_id",
            F.coalesce(F.col("zone_name"), F.lit("Unknown")).alias("zone_name"),
            F.coalesce(F.col("borough"), F.lit("Unknown")).alias("borough"),
            "trip_count",
        )
        .orderBy(F.col("trip_count").desc(), F.col("pickup_zone_id").asc())
        .limit(opts.top_n)
    )


def type_compare(taxi_cut: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A08 + W02: trips and revenue per taxi type with their shares of the total."""
    per_type = taxi_cut.groupBy("taxi_type").agg(
        F.sum("trip_count").cast("bigint").alias("trip_count"),
        units_sum("total_revenue", MONEY_SCALE).alias("_rev_units"),
    )
    everything = Window.partitionBy()  # one row per taxi type: bounded
    return per_type.select(
        "taxi_type",
        "trip_count",
        units_to_double(F.col("_rev_units"), MONEY_SCALE).alias("total_revenue"),
        exact_round_ratio(F.col("trip_count") * 100, F.sum("trip_count").over(everything), 0, opts.digits).alias(
            "trip_share_pct"
        ),
        exact_round_ratio(F.col("_rev_units") * 100, F.sum("_rev_units").over(everything), 0, opts.digits).alias(
            "revenue_share_pct"
        ),
    )


def mobility_kpis(taxi_cut: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Total trips, revenue, passengers and the average fare."""
    return taxi_cut.agg(
        F.sum("trip_count").cast("bigint").alias("total_trips"),
        _money_sum("total_revenue").alias("total_revenue"),
        exact_round_ratio(units_sum("total_fare", MONEY_SCALE), F.sum("trip_count"), MONEY_SCALE, opts.digits).alias(
            "avg_fare"
        ),
        F.sum("total_passengers").cast("bigint").alias("total_passengers"),
    )


# ------------------------------------------------------------- R06 air quality


def pollutant_candidates(air_cut: DataFrame, choice: PollutantChoice) -> DataFrame:
    """P23 + P24 + A26 + A27: one row per parameter with its row count, whether it
    matches the pollutant pattern, and whether it is selected.

    Selected = every matching parameter; when none matches, the most frequent
    parameter of the monthly frame (ties: smallest name).  Decided inside the plan,
    no driver-side branch.  The frame has one row per distinct parameter.
    """
    counts = (
        air_cut.groupBy("parameter_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn(
            "matched",
            F.coalesce(F.lower(F.col("parameter_name")).rlike(choice.pattern), F.lit(False)),
        )
    )
    # a missing name is never the most frequent one
    rank = F.when(F.col("parameter_name").isNotNull(), F.struct(-F.col("row_count"), F.col("parameter_name")))
    pick = counts.agg(F.struct(F.bool_or("matched").alias("any"), F.min_by("parameter_name", rank).alias("first")).alias("pick")).scalar()
    picked = counts.select("*", pick.alias("pick"))
    selected = F.when(F.col("pick.any"), F.col("matched")).otherwise(F.col("parameter_name").eqNullSafe(F.col("pick.first")) & F.col("parameter_name").isNotNull())
    label = F.when(F.col("pick.any"), F.lit(choice.label)).otherwise(F.col("pick.first"))
    return picked.select("parameter_name", "row_count", "matched", selected.alias("selected"), label.alias("label"))


def pollutant_frame(air_cut: DataFrame, choice: PollutantChoice) -> DataFrame:
    """Month-cut rows of the selected pollutant (semi-join to the pick; AQE picks
    a broadcast at run time when the measured pick is small)."""
    pick = pollutant_candidates(air_cut, choice).filter("selected").select("parameter_name")
    return air_cut.join(pick, "parameter_name", "left_semi")


def pollutant_monthly(pm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A10: monthly mean of the daily means."""
    return (
        pm.groupBy("year", "month")
        .agg(_mean("avg_value", opts).alias("avg_value"))
        .withColumn("year_month", year_month_label("year", "month"))
        .orderBy("year", "month")
    )


def pollutant_by_location(pm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A11 + O02: locations with the highest mean (NULL names dropped, ties by name)."""
    return (
        pm.filter(F.col("location_name").isNotNull())
        .groupBy("location_name")
        .agg(_mean("avg_value", opts).alias("avg_value"))
        .orderBy(F.col("avg_value").desc(), F.col("location_name").asc())
        .limit(opts.top_n)
    )


def pollutant_seasonal(pm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Mean by month of year."""
    return pm.groupBy("month").agg(_mean("avg_value", opts).alias("avg_value")).orderBy("month")


def pollutant_yearly(pm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Yearly mean and maximum."""
    return (
        pm.groupBy("year")
        .agg(_mean("avg_value", opts).alias("avg_value"), F.max("max_value").alias("max_value"))
        .orderBy("year")
    )


def pollutant_kpis(pm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Overall mean, max, min and number of distinct locations."""
    return pm.agg(
        _mean("avg_value", opts).alias("avg_value"),
        F.max("max_value").alias("max_value"),
        F.min("min_value").alias("min_value"),
        F.countDistinct("location_name").alias("n_locations"),
    )


# ------------------------------------------------------------- R07 correlation


def taxi_monthly_totals(taxi_cut: DataFrame) -> DataFrame:
    """Trips and revenue per month (revenue kept in cents for exact sums)."""
    return taxi_cut.groupBy("year", "month").agg(
        F.sum("trip_count").cast("bigint").alias("trip_count"),
        _money_sum("total_revenue").alias("total_revenue"),
    )


def trip_pollution_monthly(taxi_cut: DataFrame, pm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A15 + A16 + J02: monthly trips and pollutant joined on (year, month)."""
    air = pm.groupBy("year", "month").agg(_mean("avg_value", opts).alias("avg_value"))
    return (
        taxi_monthly_totals(taxi_cut)
        .join(air, ["year", "month"], "inner")
        .withColumn("year_month", year_month_label("year", "month"))
    )


def trip_pollution_corr(monthly: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A17 + P33: overall correlation of trips with the pollutant, and its band."""
    r = F.round(safe_corr("trip_count", "avg_value"), 6)
    return monthly.agg(r.alias("correlation"), F.count(F.lit(1)).alias("n_months")).withColumn(
        "band", corr_band("correlation", opts.corr_band)
    )


def trip_pollution_corr_yearly(monthly: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A18 + P32: per-year correlation for years with enough common months."""
    return (
        monthly.groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("n_months"),
            F.round(safe_corr("trip_count", "avg_value"), 6).alias("correlation"),
        )
        .filter(F.col("n_months") >= opts.min_months_per_year)
        .withColumn("direction", sign_flag("correlation"))
        .orderBy("year")
    )


def trips_seasonal(taxi_cut: DataFrame) -> DataFrame:
    """Trips by month of year."""
    return taxi_cut.groupBy("month").agg(F.sum("trip_count").cast("bigint").alias("trip_count")).orderBy("month")


# ---------------------------------------------------------------- R08 economic

def fx_monthly(dim_fx: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Monthly mean rate (computed once and shared by its users)."""
    return dim_fx.groupBy(F.col("fx_year").alias("year"), F.col("fx_month").alias("month")).agg(
        exact_round_avg("usd_eur_rate", SOURCE_SCALE, opts.digits).alias("usd_eur_rate")
    )


def revenue_fx_monthly(taxi_cut: DataFrame, fxm: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A21 + J03 + P27 + P30: monthly revenue in USD and EUR.

    Months without a rate get the mean of the monthly rates that did join
    (mean over the report rows, not over the FX table).  EUR = USD / rate.
    """
    j = join_dimension(taxi_monthly_totals(taxi_cut), fxm, ["year", "month"], "left")
    everything = Window.partitionBy()
    u = F.rint(F.col("usd_eur_rate") * 10**opts.digits).cast("long")
    fill = exact_round_ratio(F.sum(u).over(everything), F.count(u).over(everything), opts.digits, opts.digits)
    rate = F.coalesce(F.col("usd_eur_rate"), fill)
    return (
        j.withColumn("usd_eur_rate", rate)
        .withColumn("total_revenue_eur", F.try_divide(F.col("total_revenue"), F.col("usd_eur_rate")))
        .orderBy("year", "month")
    )


def economic_kpis(revenue_fx: DataFrame, dim_fx_df: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """Total revenue in USD and EUR and the mean daily rate, as (metric, value)
    rows: a union of one-row aggregates rather than a cross join of them."""
    # both revenue totals from one aggregate over the monthly frame, as two rows
    totals = revenue_fx.agg(
        _money_sum_double("total_revenue").alias("usd"), F.round(F.sum("total_revenue_eur"), 2).alias("eur")
    ).select(
        F.explode(
            F.array(
                F.struct(F.lit("total_revenue_usd").alias("metric"), F.col("usd").alias("value")),
                F.struct(F.lit("total_revenue_eur").alias("metric"), F.col("eur").alias("value")),
            )
        ).alias("m")
    ).select("m.metric", "m.value")
    rate = dim_fx_df.agg(exact_round_avg("usd_eur_rate", SOURCE_SCALE, opts.digits).alias("value"))
    return totals.unionByName(rate.select(F.lit("avg_usd_eur_rate").alias("metric"), "value"))


def _money_sum_double(col: str) -> F.Column:
    return units_to_double(units_sum(col, MONEY_SCALE), MONEY_SCALE)


def revenue_gdp_yearly(revenue_fx: DataFrame, dim_gdp: DataFrame, opts: ReportOptions = ReportOptions()) -> DataFrame:
    """A22 + P25 + J04 + W01 + P28 + P29: yearly revenue with the chosen country's
    GDP, year-over-year growth and its direction."""
    yearly = revenue_fx.groupBy("year").agg(_money_sum_double("total_revenue").alias("total_revenue"))
    gdp = dim_gdp.filter(F.col("country_code") == opts.country).select("year", "gdp_usd")
    # several rows per (country, year) are possible in the source: no proven bound
    j = join_dimension(yearly, gdp, "year", "left")
    growth = pct_change("total_revenue", "year")
    return (
        j.withColumn("gdp_trillions", F.col("gdp_usd") / 1e12)
        .withColumn("revenue_millions", F.col("total_revenue") / 1e6)
        .withColumn("revenue_growth", growth)
        .withColumn("growth_direction", sign_flag("revenue_growth"))
        .orderBy("year")
    )


# ----------------------------------------------------------------- R09 summary


def row_counts(frames: dict[str, DataFrame | tuple[DataFrame, str]]) -> DataFrame:
    """A24 + A30: one (table_name, row_count) row per table, as a union of counts.

    A (frame, column) pair gives the count of a table that the frame aggregates: the sum of the column.
    """

    def arm(name: str, of: DataFrame | tuple[DataFrame, str]) -> DataFrame:
        df, counted = of if isinstance(of, tuple) else (of, None)
        count = F.coalesce(F.sum(counted), F.lit(0)).cast("bigint") if counted else F.count(F.lit(1))
        return df.agg(count.alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    arms = [arm(n, of) for n, of in frames.items()]
    out = arms[0]
    for a in arms[1:]:
        out = out.unionByName(a)
    return out


def counts_by_type_year(silver_trips: DataFrame) -> DataFrame:
    """A25 + O03: trips per taxi type and pickup year, ordered."""
    return (
        silver_trips.groupBy("taxi_type", "pickup_year")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("taxi_type", "pickup_year")
    )


def counts_by_year(df, year_col: str) -> DataFrame:
    """Rows per year of a silver table, ordered (e.g. measurements per year)."""
    return df.groupBy(year_col).agg(F.count(F.lit(1)).alias("row_count")).orderBy(year_col)


def summary(taxi_cut: DataFrame, air_cut: DataFrame, dim_date_df: DataFrame, zone: DataFrame, fx: DataFrame, gdp: DataFrame) -> DataFrame:
    """Project summary as (metric, value) rows — a union of one-row
    aggregates instead of a cross join of them."""
    parts = [
        taxi_cut.agg(F.sum("trip_count").cast("bigint").alias("value")).select(F.lit("taxi_trips").alias("metric"), "value"),
        air_cut.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit("air_quality_rows").alias("metric"), "value"),
        # first and last year from one aggregate, emitted as two rows
        dim_date_df.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
        .select(
            F.explode(
                F.array(
                    F.struct(F.lit("first_year").alias("metric"), F.col("lo").cast("bigint").alias("value")),
                    F.struct(F.lit("last_year").alias("metric"), F.col("hi").cast("bigint").alias("value")),
                )
            ).alias("m")
        )
        .select("m.metric", "m.value"),
        zone.agg(F.countDistinct("zone_id").cast("bigint").alias("value")).select(F.lit("zones").alias("metric"), "value"),
        fx.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit("fx_rows").alias("metric"), "value"),
        gdp.agg(F.countDistinct("country_code").cast("bigint").alias("value")).select(F.lit("countries").alias("metric"), "value"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Silver layer: one lazy plan per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import GREEN, TRIP_FILLS, YELLOW, TripRules, TripSourceSpec
from ..operators import cleanse
from ..operators.standardize import standardize, standardize_tagged, union_all
from ..sinks.writers import overwrite

#: the flavours of a tagged landing frame
FLAVOURS = {"yellow": YELLOW, "green": GREEN}


def silver_trips(
    frames: list[tuple[DataFrame, TripSourceSpec]],
    rules: TripRules = TripRules(),
    case_sensitive: bool = False,
    fills: dict[str, object] = TRIP_FILLS,
) -> DataFrame:
    """Standardise each landing frame, union, validate, fill, enrich, validate duration.

    No de-duplication: identical trips are kept (the original "deduplicate" step
    never dropped anything).
    """
    std = union_all([standardize(df, spec, case_sensitive) for df, spec in frames])
    return clean_trips(std, rules, fills)


def clean_trips(std: DataFrame, rules: TripRules = TripRules(), fills: dict[str, object] = TRIP_FILLS) -> DataFrame:
    """R01 after standardisation: validate, fill, enrich, validate duration."""
    df = cleanse.apply_rules(std, cleanse.trip_rules(rules))
    df = cleanse.fill_defaults(df, fills)
    df = cleanse.add_calendar(df, "pickup_datetime", "pickup", with_hour=True)
    df = cleanse.add_duration_minutes(df, "pickup_datetime", "dropoff_datetime")
    return cleanse.apply_rules(df, cleanse.duration_rules(rules))


def silver_trips_from(yellow: DataFrame, green: DataFrame, rules: TripRules = TripRules(), **kw) -> DataFrame:
    return silver_trips([(yellow, YELLOW), (green, GREEN)], rules, **kw)


def silver_trips_tagged(bronze: DataFrame, rules: TripRules = TripRules(), case_sensitive: bool = False) -> DataFrame:
    """R01 over a frame that holds both flavours, read once."""
    return clean_trips(standardize_tagged(bronze, FLAVOURS, "flavour", case_sensitive), rules)


def trip_reject_counts(
    frames: list[tuple[DataFrame, TripSourceSpec]],
    rules: TripRules = TripRules(),
    case_sensitive: bool = False,
) -> DataFrame:
    """Per-rule reject counts of R01 in one pass (one row per taxi type)."""
    return reject_counts(union_all([standardize(df, spec, case_sensitive) for df, spec in frames]), rules)


def reject_counts(std: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Per-rule reject counts of R01 over standardised trips.

    Counts are independent (a row failing two rules counts in both); ``kept`` is
    the number of rows passing every rule, ``input_rows`` the number read.
    """
    std = cleanse.add_duration_minutes(std, "pickup_datetime", "dropoff_datetime")
    all_rules = cleanse.trip_rules(rules) + cleanse.duration_rules(rules)
    keep = None
    for r in all_rules:
        keep = r.predicate if keep is None else keep & r.predicate
    return std.groupBy("taxi_type").agg(
        F.count(F.lit(1)).alias("input_rows"),
        *cleanse.rule_failures(all_rules),
        F.count(F.when(F.coalesce(keep, F.lit(False)), 1)).alias("kept"),
    )


def write_counted_trips(std: DataFrame, path: str, types: tuple[str, ...], rules: TripRules = TripRules(), fills: dict[str, object] = TRIP_FILLS) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """R01 + A24, A25: write silver and return (the written table, type -> metric -> count) of that one job.

    The metrics (rows read, rejected per rule, kept, written per year) are observed while the rows pass on their way to the
    files: nothing is read or judged twice.  All rows pass the first counter, so no rule is pushed below it.
    """
    all_rules = cleanse.trip_rules(rules) + cleanse.duration_rules(rules)
    years = range(int(rules.date_from[:4]), int(rules.date_to[:4]) + (rules.date_to[4:] > "-01-01"))
    keep = reduce(lambda a, b: a & b, (r.predicate for r in all_rules))

    def count(t: str, metric: str, test: Column) -> Column:
        return F.count_if((F.col("taxi_type") == t) & F.coalesce(test, F.lit(False))).alias(f"{t}|{metric}")

    before, after = Observation(), Observation()
    df = cleanse.add_duration_minutes(std, "pickup_datetime", "dropoff_datetime").observe(
        before,
        *[count(t, "input_rows", F.lit(True)) for t in types],
        *[count(t, f"rejected_{r.name}", ~F.coalesce(r.predicate, F.lit(False))) for t in types for r in all_rules],
        *[count(t, "kept", keep) for t in types],
    )
    df = clean_trips(df.drop("trip_duration_minutes"), rules, fills)
    df = df.observe(after, *[count(t, f"rows_{y}", F.col("pickup_year") == y) for t in types for y in years])
    overwrite(df, path)
    counts: dict[str, dict[str, int]] = {t: {} for t in types}
    for name, n in {**before.get, **after.get}.items():
        t, metric = name.split("|")
        counts[t][metric] = int(n)
    return std.sparkSession.read.schema(df.schema).parquet(path), counts


def silver_measurements(bronze: DataFrame) -> DataFrame:
    """Date parts, value filter, whole-row de-duplication."""
    df = bronze.withColumn("measurement_date", F.col("date").try_cast("date"))
    df = cleanse.add_calendar(df, "measurement_date", "measurement", with_hour=False)
    df = cleanse.valid_measurements(df)
    return cleanse.dedup_rows(df)


def silver_gdp(bronze: DataFrame) -> DataFrame:
    """R03 (GDP): rename, integer year, whole-row de-duplication."""
    return cleanse.dedup_rows(
        bronze.select(
            F.col("countryiso3code").alias("country_code"),
            F.col("date").try_cast("int").alias("year"),
            F.col("value").cast("double").alias("gdp_usd"),
        )
    )


def silver_fx(bronze: DataFrame) -> DataFrame:
    """R03 (FX): typed date and rate, currency names, date parts, de-duplication."""
    df = bronze.select(
        F.col("TIME_PERIOD").try_cast("date").alias("date"),
        F.col("OBS_VALUE").try_cast("double").alias("usd_eur_rate"),
        F.col("CURRENCY").alias("currency_from"),
        F.col("CURRENCY_DENOM").alias("currency_to"),
    )
    df = df.withColumns(
        {
            "fx_year": F.year("date").cast("int"),
            "fx_month": F.month("date").cast("int"),
            "fx_day": F.dayofmonth("date").cast("int"),
        }
    )
    return cleanse.dedup_rows(df)

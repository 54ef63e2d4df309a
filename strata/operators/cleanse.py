"""Silver-layer row operators: validity rules, NULL fills, calendar parts,
duration, measurement filter, whole-row de-duplication (P06-P12, A28)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TRIP_FILLS, TripRules
from ..functions.dates import calendar_parts


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column  # rows where this is NULL or false are rejected


def trip_rules(rules: TripRules = TripRules()) -> list[Rule]:
    """Row rules applied before enrichment (P06), in the original order."""
    p = F.col("pickup_datetime")
    return [
        Rule("pickup_from", p >= F.lit(rules.date_from).cast("timestamp_ntz")),
        Rule("pickup_to", p < F.lit(rules.date_to).cast("timestamp_ntz")),
        # NaN compares above every number: it is rejected with the negative values
        Rule("fare_non_negative", (F.col("fare_amount") >= 0) & ~F.isnan("fare_amount")),
        Rule("total_non_negative", (F.col("total_amount") >= 0) & ~F.isnan("total_amount")),
        Rule("distance_non_negative", (F.col("trip_distance") >= 0) & ~F.isnan("trip_distance")),
        Rule("distance_max", F.col("trip_distance") <= rules.max_distance),
    ]


def duration_rules(rules: TripRules = TripRules()) -> list[Rule]:
    """Rules on the derived duration (P11): (0, max] minutes, after rounding."""
    d = F.col("trip_duration_minutes")
    return [
        Rule("duration_positive", d > 0),
        Rule("duration_max", d <= rules.max_duration_minutes),
    ]


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep rows for which every rule is true (SQL three-valued logic: NULL drops)."""
    cond = None
    for r in rules:
        cond = r.predicate if cond is None else (cond & r.predicate)
    return df if cond is None else df.filter(cond)


def rule_failures(rules: list[Rule]) -> list[Column]:
    """Aggregates counting, per rule, the rows it rejects (NULL counts as rejected)."""
    return [
        F.count(F.when(~F.coalesce(r.predicate, F.lit(False)), 1)).alias(f"rejected_{r.name}")
        for r in rules
    ]


def fill_defaults(df: DataFrame, fills: dict[str, object] = TRIP_FILLS) -> DataFrame:
    """Replace NULL by a default in the given columns."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def add_calendar(df: DataFrame, ts: str, prefix: str, with_hour: bool = True) -> DataFrame:
    """Append ``{prefix}_year/month/day[/hour]/dayofweek``."""
    return df.withColumns(calendar_parts(ts, prefix, with_hour))


def add_duration_minutes(df: DataFrame, start: str, end: str, name: str = "trip_duration_minutes") -> DataFrame:
    """Elapsed minutes between two timestamps, rounded to 2 digits (P10).

    Differences are taken between whole epoch seconds, as ``unix_timestamp`` does.
    Rounding is done on integers, hundredths = floor((10 * secs + 3) / 6): the
    same value as ``round(secs / 60, 2)`` because ``secs / 60`` never falls on
    a half hundredth for whole seconds, and without a BigDecimal per row.  The
    seconds expression is used once, so filters that Catalyst pushes below this
    projection do not repeat it.
    """
    secs = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return df.withColumn(name, F.floor((secs * 10 + 3) / 6) / 100.0)


def valid_measurements(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep measurements with a non-NULL, non-negative value."""
    return df.filter(F.col(value).isNotNull() & (F.col(value) >= 0) & ~F.isnan(value))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication.

    One hash aggregate over all columns with map-side partial de-duplication, so a
    heavily repeated row costs one row per task in the shuffle, not one per copy.
    """
    return df.dropDuplicates()

"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(y: Column | str, m: Column | str, d: Column | str) -> Column:
    """``CAST(y*10000 + m*100 + d AS INT)`` — the yyyymmdd surrogate key."""
    return (_c(y) * 10000 + _c(m) * 100 + _c(d)).cast("int")


def date_key_of(d: Column | str) -> Column:
    """yyyymmdd key of a date/timestamp."""
    return date_key(F.year(_c(d)), F.month(_c(d)), F.dayofmonth(_c(d)))


def quarter_int_div(d: Column | str) -> Column:
    """``(MONTH - 1) / 3 + 1`` with integer division (F14); equals ``quarter``."""
    return F.quarter(_c(d)).cast("int")


def weekday_sun1(d: Column | str) -> Column:
    """Weekday number with Sunday = 1 … Saturday = 7."""
    return F.dayofweek(_c(d)).cast("int")


def is_weekend_sun1(d: Column | str) -> Column:
    """1 when the weekday (Sunday = 1) is 1 or 7, else 0 (F16)."""
    return F.when(weekday_sun1(d).isin(1, 7), F.lit(1)).otherwise(F.lit(0)).cast("int")


def week_of_year_sun(d: Column | str) -> Column:
    """Week number where week 1 starts on January 1 and weeks start on Sunday.

    This is the calendar the warehouse's ``DATEPART(week, d)`` uses; ISO
    ``weekofyear`` differs around New Year (2016-01-01 is week 1 here, 53 in ISO).
    """
    dd = _c(d)
    jan1_weekday = F.dayofweek(F.trunc(dd, "year"))
    return (F.floor((F.dayofyear(dd) + jan1_weekday - 2) / 7) + 1).cast("int")


def year_month_label(y: Column | str, m: Column | str) -> Column:
    """``'YYYY-MM'`` label with a zero-padded month."""
    return F.format_string("%d-%02d", _c(y).cast("int"), _c(m).cast("int"))


def calendar_parts(ts: Column | str, prefix: str, with_hour: bool = True) -> dict[str, Column]:
    """year/month/day[/hour]/dayofweek of a date or timestamp, as int columns."""
    t = _c(ts)
    parts = {
        f"{prefix}_year": F.year(t),
        f"{prefix}_month": F.month(t),
        f"{prefix}_day": F.dayofmonth(t),
    }
    if with_hour:
        parts[f"{prefix}_hour"] = F.hour(t)
    parts[f"{prefix}_dayofweek"] = F.dayofweek(t)
    return {k: v.cast("int") for k, v in parts.items()}

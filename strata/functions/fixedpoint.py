"""Exact, engine-independent rounding of sums and averages.

Summing doubles is order-dependent.  Instead every value is turned into an integer
count of units (``rint(x * 10^scale)``), summed exactly, and only the final aggregate is
rounded, once.  Source values (money, distances, rates, readings) are counted at
``SOURCE_SCALE`` decimals, as two longs with one carry at the end; values this library has rounded itself (durations, daily
sums and means) at the decimals they have.  Rounding half away from zero is done
with integer division, so the result is exact and identical on any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"  # width for scaled numerators of the final rounding step


# Decimals kept of a source value whose own precision is not declared: nothing is
# rounded to the result's digits before it has been summed.
SOURCE_SCALE = 10
# Decimals of the coarser of the two longs such a value is summed as, its largest size in those units, and
# the decimals up to which one long holds a value.
COARSE = 3
LIMIT = 9.0e18
LONG_SCALE = 6


def to_units(col: Column | str, scale: int) -> Column:
    """``x`` as a count of ``10^-scale`` units (NULL and NaN give NULL): a long for the few
    decimals of derived values, ``decimal(38,0)`` at the precision of source values."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c * (10**scale)).try_cast("long" if scale <= LONG_SCALE else _WIDE)


def units_sum(col: Column | str, scale: int) -> Column:
    """Aggregate: exact sum of ``x`` in ``10^-scale`` units."""
    return F.sum(to_units(col, scale))


def units_to_double(units: Column, scale: int) -> Column:
    """Scale a unit count back to a double (correctly rounded)."""
    return units.cast("double") / float(10**scale)


def round_div_half_up(num: Column, den: Column) -> Column:
    """``round(num / den)`` half away from zero as a long, for integral ``num`` and
    positive integral ``den``.  Evaluated in ``decimal(38,0)`` so scaled numerators
    cannot overflow; used on aggregated rows only."""
    n = num.cast(_WIDE)
    d = den.cast(_WIDE)
    q = F.abs(n) * 2 + d
    return (F.signum(n).cast("long") * idiv(q, d * 2)).cast("long")


def idiv(a: Column, b: Column) -> Column:
    """Integral division of non-negative integral values (exact)."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def _div(a: Column, b: Column) -> Column:
    """Integral division of longs, towards zero."""
    return F.call_function("div", a, b)


def limbs(col: Column | str) -> tuple[Column, Column]:
    """``x`` as two longs: whole units of ``10^-COARSE`` and what is left over, in ``10^-SOURCE_SCALE``.

    Sums of both stay exact in 64 bits (for some 9 * 10^11 rows a group, and values of 9 * 10^15 in all), where one
    count of ``10^-SOURCE_SCALE`` units needs a wide decimal.  NULL, NaN and values beyond that give NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("double") * 10**COARSE
    whole = F.floor(c)
    rest = F.rint((c - whole.cast("double")) * 10 ** (SOURCE_SCALE - COARSE)).cast("long")
    known = F.abs(c) < LIMIT  # NaN is larger than any number
    return F.when(known, whole), F.when(known, rest)


def _round_limbs(whole: Column, rest: Column, unit: int, den: Column) -> Column:
    """``round((whole * unit + rest) / (den * unit))`` half away from zero, in longs."""
    u = F.lit(unit).cast("long")
    left = F.pmod(rest, u)
    whole = whole + _div(rest - left, u)
    below = whole < 0  # what is left is never negative
    size = F.when(below & (left > 0), -whole - 1).otherwise(F.abs(whole))
    left = F.when(below & (left > 0), u - left).otherwise(left)
    over = (size % den) * u + left
    n = _div(size, den) + F.when(over >= den * u - over, 1).otherwise(0)
    return F.when(below, -n).otherwise(n)


def _round_div(num: Column, den: Column) -> Column:
    """``round(num / den)`` half away from zero, in longs, for positive ``den``."""
    size = F.abs(num)
    over = size % den
    n = _div(size, den) + F.when(over >= den - over, 1).otherwise(0)
    return F.when(num < 0, -n).otherwise(n)


def _round_aggregate(c: Column, scale: int, digits: int, den: Column | None) -> Column:
    """Aggregate: the sum of ``c`` (over ``den``) in ``10^-digits`` units."""
    if scale > LONG_SCALE:
        whole, rest = limbs(c)
        more = max(digits - COARSE, 0)  # the whole units are made as fine as the result
        least = F.lit(10 ** max(COARSE - digits, 0)).cast("long")
        return _round_limbs(F.sum(whole) * 10**more, F.sum(rest), 10 ** (SOURCE_SCALE - COARSE - more), least if den is None else den * least)
    s = units_sum(c, scale)
    one = F.lit(1).cast("long") if den is None else den
    if digits <= scale:
        return _round_div(s, one * 10 ** (scale - digits))
    finer = F.lit(10 ** (digits - scale)).cast("long")
    return _div(s, one) * finer + _round_div((s % one) * finer, one)


def exact_round_sum(col: Column | str, scale: int, digits: int) -> Column:
    """Aggregate: ``ROUND(SUM(x), digits)`` for values with ``scale`` decimals."""
    c = F.col(col) if isinstance(col, str) else col
    if scale <= LONG_SCALE and digits >= scale:
        return units_to_double(units_sum(c, scale), scale)
    return units_to_double(_round_aggregate(c, scale, digits, None), digits)


def exact_round_avg(col: Column | str, scale: int, digits: int) -> Column:
    """Aggregate: ``ROUND(AVG(x), digits)`` for values with ``scale`` decimals."""
    c = F.col(col) if isinstance(col, str) else col
    n = F.count(c)
    return F.when(n > 0, units_to_double(_round_aggregate(c, scale, digits, F.when(n > 0, n)), digits))


def exact_round_ratio(num_units: Column, den: Column, num_scale: int, digits: int) -> Column:
    """``ROUND(num / den, digits)`` where ``num_units`` counts ``10^-num_scale`` units."""
    if digits >= num_scale:
        num = num_units.cast(_WIDE) * (10 ** (digits - num_scale))
        d = den
    else:
        num = num_units
        d = den.cast(_WIDE) * (10 ** (num_scale - digits))
    return F.when(den > 0, units_to_double(round_div_half_up(num, d), digits))

"""Map a landing frame with drifting column types onto the common trip schema
(P01-P04, P05, U01)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TripSourceSpec


_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
}


class MissingColumnError(ValueError):
    """A required source column is absent: the frame (file) cannot be standardised."""


def _resolve(columns: list[str], name: str, case_sensitive: bool) -> str | None:
    if case_sensitive:
        return name if name in columns else None
    by_lower = {c.lower(): c for c in columns}
    return by_lower.get(name.lower())


def typed(df: DataFrame, column: str, dtype: str) -> Column:
    """Cast ``column`` to ``dtype`` without failing the job on a bad value.

    Strings that do not parse become NULL (``try_cast``) and are then removed by
    the validity rules, as a non-ANSI cast would do.  A column that already has the
    target type is passed through untouched, so parquet filter pushdown still
    reaches it.
    """
    return _as_type(F.col(f"`{column}`"), df.schema[column].dataType, dtype)


def _as_type(c: Column, src_type: T.DataType, dtype: str) -> Column:
    target = _TYPES[dtype]
    if src_type == target:
        return c
    if isinstance(src_type, T.StringType):
        return c.try_cast(target)
    return c.cast(target) if _is_safe_cast(src_type, target) else c.try_cast(target)


def _is_safe_cast(src: T.DataType, dst: T.DataType) -> bool:
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    if isinstance(dst, T.DoubleType) and isinstance(src, numeric):
        return True
    if isinstance(dst, T.TimestampNTZType) and isinstance(src, (T.TimestampType, T.DateType)):
        return True
    if isinstance(dst, T.StringType):
        return True
    return False


def standardize(df: DataFrame, spec: TripSourceSpec, case_sensitive: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto the trip schema described by ``spec``.

    * required source column missing -> ``MissingColumnError`` (at plan time);
    * optional column missing -> typed NULL (P03);
    * optional-column lookup ignores case unless ``case_sensitive`` (a file that
      spells ``airport_fee`` in lower case still contributes its values);
    * timestamps come out as ``timestamp_ntz`` (wall-clock, no zone), parsed from
      strings when a file stores them as text (P05);
    * a constant ``taxi_type`` tag is appended (P04), then the columns of ``keep`` as they are.
    """
    out = [c.alias(f.target) for f, c in zip(spec.fields, _fields(df.schema, spec, case_sensitive))]
    out.append(F.lit(spec.taxi_type).alias("taxi_type"))
    return df.select(*out, *keep)


def _fields(schema: T.StructType, spec: TripSourceSpec, case_sensitive: bool, prefix: str = "") -> list[Column]:
    """The columns of ``spec`` in order, out of a frame's columns or (with ``prefix``) a struct's fields."""
    out = []
    for f in spec.fields:
        src = _resolve(schema.names, f.source, case_sensitive) if f.source else None
        if src is not None:
            out.append(_as_type(F.col(f"{prefix}`{src}`"), schema[src].dataType, f.dtype))
        elif f.required:
            raise MissingColumnError(f"{spec.taxi_type}: required column {f.source!r} missing")
        else:
            out.append(F.lit(None).cast(f.dtype))
    return out


def standardize_tagged(df: DataFrame, specs: dict[str, TripSourceSpec], tag: str, case_sensitive: bool = False) -> DataFrame:
    """Several flavours of one frame in one pass (P01, P02, U01): no scan and no union per flavour.

    ``tag`` names a row's flavour, and its values lie in the struct column of that name; types may
    differ between the structs, and each target column is built from the row's own.  Rows of no
    known flavour go.
    """
    arms = {t: _fields(df.schema[t].dataType, spec, case_sensitive, f"`{t}`.") for t, spec in specs.items()}
    out = []
    for i, f in enumerate(next(iter(specs.values())).fields):
        c = None
        for t in specs:
            c = F.when(F.col(tag) == t, arms[t][i]) if c is None else c.when(F.col(tag) == t, arms[t][i])
        out.append(c.alias(f.target))
    names = F.create_map(*[F.lit(x) for t, spec in specs.items() for x in (t, spec.taxi_type)])
    return df.filter(F.col(tag).isin(*specs)).select(*out, names[F.col(tag)].alias("taxi_type"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)

"""Declared gold schemas (K07) and a conform step that casts, orders and checks a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _schema(spec: str, not_null: tuple[str, ...] = ()) -> T.StructType:
    fields = []
    for part in spec.split(","):
        name, dtype = part.split()
        fields.append(T.StructField(name, _TYPES[dtype], name not in not_null))
    return T.StructType(fields)


# Column names and types of the six gold tables.
FACT_TAXI_DAILY = _schema(
    "year int, month int, day int, date_key int, pickup_zone_id bigint, dropoff_zone_id bigint, "
    "taxi_type string, trip_count int, total_passengers bigint, total_distance double, "
    "total_fare double, total_tips double, total_revenue double, avg_trip_duration double"
)
FACT_AIR_QUALITY_DAILY = _schema(
    "year int, month int, day int, date_key int, location_id bigint, location_name string, "
    "parameter_name string, parameter_units string, measurement_count int, avg_value double, "
    "min_value double, max_value double"
)
DIM_DATE = _schema(
    "date_key int, date date, year int, quarter int, month int, day_of_month int, "
    "day_of_week int, is_weekend int, week_of_year int",
    not_null=("is_weekend",),
)
DIM_ZONE = _schema("zone_id bigint, borough string, zone_name string, service_zone string")
DIM_FX = _schema("date_key int, fx_date date, usd_eur_rate double, fx_year int, fx_month int, fx_day int")
DIM_GDP = _schema("country_code string, year int, gdp_usd double")

GOLD_SCHEMAS = {
    "FactTaxiDaily": FACT_TAXI_DAILY,
    "FactAirQualityDaily": FACT_AIR_QUALITY_DAILY,
    "DimDate": DIM_DATE,
    "DimZone": DIM_ZONE,
    "DimFX": DIM_FX,
    "DimGDP": DIM_GDP,
}


class SchemaMismatchError(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast each to its declared type.

    Raises when a declared column is missing.  NOT NULL columns are guarded with
    ``assert_true`` so a violating row fails the write instead of landing.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaMismatchError(f"missing columns {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.cast(f.dataType)
        if not f.nullable:
            c = F.when(F.assert_true(c.isNotNull(), f"{f.name} is NULL").isNull(), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    """Names and types equal, position by position (nullability ignored)."""
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]

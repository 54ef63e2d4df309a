"""Typed readers for landed API payloads and CSV exports, and the flatteners
that turn them into bronze rows (S04-S09, P15-P19, J06, U02).

Every reader has two entry points with one schema: ``read_*`` for files
(``spark.read.schema(...).json/csv``) and ``parse_*`` for a string column that
holds the same text (``from_json`` / ``from_csv``).  Nested records are
flattened with ``explode`` (a lateral view), never with driver-side loops.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BoundingBox

# --------------------------------------------------------------------- schemas
# Field names of the upstream payloads.

PARAMETER = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("units", T.StringType())]
)
SENSOR = T.StructType([T.StructField("id", T.LongType()), T.StructField("parameter", PARAMETER)])
LOCATION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("isMobile", T.BooleanType()),
        T.StructField(
            "coordinates",
            T.StructType([T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]),
        ),
        T.StructField("entity", T.StructType([T.StructField("type", T.StringType())])),
        T.StructField("sensors", T.ArrayType(SENSOR)),
    ]
)
LOCATIONS_PAGE = T.StructType([T.StructField("results", T.ArrayType(LOCATION))])

DAILY_VALUE = T.StructType(
    [
        T.StructField("value", T.DoubleType()),
        T.StructField(
            "period",
            T.StructType(
                [T.StructField("datetimeFrom", T.StructType([T.StructField("utc", T.StringType())]))]
            ),
        ),
    ]
)
# one landed record per sensor request: the sensor id and its result list
SENSOR_DAYS = T.StructType(
    [T.StructField("sensor_id", T.LongType()), T.StructField("results", T.ArrayType(DAILY_VALUE))]
)

GDP_RECORD = T.StructType(
    [
        T.StructField("indicator", T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])),
        T.StructField("country", T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])),
        T.StructField("countryiso3code", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("obs_status", T.StringType()),
        T.StructField("decimal", T.LongType()),
    ]
)

ZONE_CSV = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# The 32 columns of the exchange-rate export, in file order, with
# their types (TIME_FORMAT, a duration upstream, is never used and read as text).
_FX_COLUMNS = [
    ("KEY", "string"), ("FREQ", "string"), ("CURRENCY", "string"), ("CURRENCY_DENOM", "string"),
    ("EXR_TYPE", "string"), ("EXR_SUFFIX", "string"), ("TIME_PERIOD", "date"), ("OBS_VALUE", "double"),
    ("OBS_STATUS", "string"), ("OBS_CONF", "string"), ("OBS_PRE_BREAK", "string"), ("OBS_COM", "string"),
    ("TIME_FORMAT", "string"), ("BREAKS", "string"), ("COLLECTION", "string"), ("COMPILING_ORG", "string"),
    ("DISS_ORG", "string"), ("DOM_SER_IDS", "string"), ("PUBL_ECB", "string"), ("PUBL_MU", "string"),
    ("PUBL_PUBLIC", "string"), ("UNIT_INDEX_BASE", "string"), ("COMPILATION", "string"), ("COVERAGE", "string"),
    ("DECIMALS", "long"), ("NAT_TITLE", "string"), ("SOURCE_AGENCY", "string"), ("SOURCE_PUB", "string"),
    ("TITLE", "string"), ("TITLE_COMPL", "string"), ("UNIT", "string"), ("UNIT_MULT", "long"),
]
_CSV_TYPES = {"string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(), "long": T.LongType()}
FX_CSV = T.StructType([T.StructField(n, _CSV_TYPES[t]) for n, t in _FX_COLUMNS])

# Unquoted CSV: a quote character is ordinary text and a line break ends a row.
CSV_OPTIONS = {"header": "true", "quote": "\u0000", "multiLine": "false", "mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd"}


# --------------------------------------------------------------------- CSV


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header line, comma, declared column types, no quoting."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def parse_csv_lines(lines: DataFrame, schema: T.StructType, col: str = "line") -> DataFrame:
    """Same typing for CSV text already in a string column (header lines removed)."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")}
    return lines.select(F.from_csv(F.col(col), schema.simpleString(), opts).alias("r")).select("r.*")


# --------------------------------------------------------------------- faulty records

_RAW = "_record"
EMPTY, NOT_JSON, NO_RECORDS, OTHER_TYPE = "empty", "not JSON", "no records", "a value of another type"


@dataclass
class Checked:
    """What a reader could take as declared, and the records it could not: nothing is cut, nulled or dropped silently.

    ``rejects`` holds the text as ``record``, its ``reason``, and the other columns of the frame it came in (a file's path).
    """

    rows: DataFrame
    rejects: DataFrame


def _checked(records: DataFrame, col: str, parsed: Column, unreadable: Column, reason: Column, rows: Callable[[DataFrame], DataFrame]) -> Checked:
    """Split ``records`` by ``unreadable``, a test of the column ``_parsed``."""
    others = [c for c in records.columns if c != col]
    df = records.withColumn("_parsed", parsed)
    bad = F.coalesce(unreadable, F.lit(True))
    why = F.when(F.coalesce(F.trim(col), F.lit("")) == "", EMPTY).otherwise(reason)
    return Checked(rows(df.filter(~bad)), df.filter(bad).select(*others, F.col(col).alias("record"), why.alias("reason")))


def _with_raw(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])


def _json_reason(col: str) -> Column:
    return F.when(F.try_parse_json(col).isNull(), NOT_JSON).otherwise(OTHER_TYPE)


def checked_csv(lines: DataFrame, schema: T.StructType, col: str = "line") -> Checked:
    """Lines with another number of fields, or a field that is not of its type, are set apart."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")} | {"columnNameOfCorruptRecord": _RAW}
    n = F.size(F.split(F.col(col), ","))
    reason = F.when(n != len(schema), F.concat(n.cast("string"), F.lit(f" fields instead of {len(schema)}"))).otherwise(OTHER_TYPE)
    parsed = F.from_csv(F.col(col), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _with_raw(schema)), opts)
    unreadable = (n != len(schema)) | F.col(f"_parsed.{_RAW}").isNotNull() | (F.trim(col) == "")
    return _checked(lines, col, parsed, unreadable, reason, lambda df: df.select(*[F.col(f"_parsed.{f.name}") for f in schema]))


def checked_json(records: DataFrame, schema: T.StructType, explode: Callable[[DataFrame], DataFrame], col: str = "value") -> Checked:
    """A broken record, or one with a value of another type anywhere inside, is set apart as a whole."""
    parsed = F.from_json(F.col(col), _with_raw(schema), {"columnNameOfCorruptRecord": _RAW})
    unreadable = F.col("_parsed").isNull() | F.col(f"_parsed.{_RAW}").isNotNull() | (F.trim(col) == "")
    rows = lambda df: explode(df.select(*[F.col(f"_parsed.{f.name}") for f in schema]))
    return _checked(records, col, parsed, unreadable, _json_reason(col), rows)


def checked_locations(pages: DataFrame, col: str = "value") -> Checked:
    return checked_json(pages, LOCATIONS_PAGE, explode_locations, col)


def checked_sensor_days(records: DataFrame, col: str = "value") -> Checked:
    return checked_json(records, SENSOR_DAYS, explode_sensor_days, col)


def checked_gdp(docs: DataFrame, col: str = "value") -> Checked:
    """Documents that are broken, hold no array of records, or hold a value of another type are set apart."""
    wrapped = F.concat(F.lit('{"r":'), F.get_json_object(F.col(col), "$[1]"), F.lit("}"))
    parsed = F.from_json(wrapped, _with_raw(T.StructType([T.StructField("r", T.ArrayType(GDP_RECORD))])), {"columnNameOfCorruptRecord": _RAW})
    broken = F.try_parse_json(col).isNull()
    none = F.get_json_object(F.col(col), "$[1]").isNull() | (F.coalesce(F.size("_parsed.r"), F.lit(-1)) < 0)
    unreadable = broken | none | F.col(f"_parsed.{_RAW}").isNotNull()
    typed = F.col(f"_parsed.{_RAW}").isNull()
    reason = F.when(broken, NOT_JSON).when(none & typed, NO_RECORDS).otherwise(OTHER_TYPE)
    return _checked(docs, col, parsed, unreadable, reason, lambda df: _gdp_rows(df.select(F.explode("_parsed.r").alias("r"))))


def read_lines(spark: SparkSession, path: str, header: T.StructType | None = None, whole: bool = False, col: str = "value") -> DataFrame:
    """Landed text as (file, ``col``): lines, or whole documents; lines that repeat the names of ``header`` go."""
    lines = spark.read.text(path, wholetext=whole).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias(col))
    return lines if header is None else lines.filter(F.rtrim(F.col(col)) != ",".join(header.names))


# --------------------------------------------------------------------- GDP JSON


def gdp_records(docs: DataFrame, col: str = "value") -> DataFrame:
    """``[metadata, [record, ...]]`` documents -> one row per record.

    Element 0 (metadata) is skipped, element 1 parsed as an array of records and
    exploded; the five unused fields are dropped (P15) and the rest typed (P16).
    """
    recs = F.from_json(F.get_json_object(F.col(col), "$[1]"), T.ArrayType(GDP_RECORD))
    return _gdp_rows(docs.select(F.explode(recs).alias("r")))


def _gdp_rows(records: DataFrame) -> DataFrame:
    return (
        records.select("r.*")
        .drop("indicator", "country", "unit", "obs_status", "decimal")
        .select(
            F.col("countryiso3code").cast("string"),
            F.col("date").cast("string"),
            F.col("value").cast("double"),
        )
    )


def read_gdp_json(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S06 + S07 + U02: every country file of a folder in one read (one document per file)."""
    return gdp_records(spark.read.text(paths, wholetext=True))


# --------------------------------------------------------------------- locations and sensors


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Landed location pages -> one row per location (struct columns kept)."""
    return explode_locations(spark.read.schema(LOCATIONS_PAGE).json(path))


def parse_locations(pages: DataFrame, col: str = "value") -> DataFrame:
    return explode_locations(pages.select(F.from_json(F.col(col), LOCATIONS_PAGE).alias("p")).select("p.*"))


def explode_locations(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("results").alias("loc")).select("loc.*")


def read_sensor_days(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Landed per-sensor daily results -> one row per (sensor, day).

    A sensor with an empty or missing result list yields no row; a sensor with no
    file at all simply has nothing to join to.  ``date_from`` and ``date_to`` (yyyy-MM-dd, both
    included) keep the days of a window; a reading without a stamp is in no window.
    """
    days = explode_sensor_days(spark.read.schema(SENSOR_DAYS).json(path))
    day = F.substring("datetime_utc", 1, 10)
    if date_from is not None:
        days = days.filter(day >= date_from)
    if date_to is not None:
        days = days.filter(day <= date_to)
    return days


def parse_sensor_days(records: DataFrame, col: str = "value") -> DataFrame:
    return explode_sensor_days(records.select(F.from_json(F.col(col), SENSOR_DAYS).alias("s")).select("s.*"))


def explode_sensor_days(records: DataFrame) -> DataFrame:
    return records.select("sensor_id", F.explode("results").alias("m")).select(
        "sensor_id",
        F.col("m.value").alias("value"),
        F.col("m.period.datetimeFrom.utc").alias("datetime_utc"),
    )


def _nonzero(c: Column) -> Column:
    # a missing or zero coordinate counts as absent (the original test was truthiness)
    return c.isNotNull() & (c != 0)


def in_box(locations: DataFrame, box: BoundingBox = BoundingBox()) -> DataFrame:
    """Keep locations whose coordinates lie in ``box`` (inclusive)."""
    lat = F.col("coordinates.latitude")
    lon = F.col("coordinates.longitude")
    return locations.filter(
        _nonzero(lat)
        & _nonzero(lon)
        & lat.between(box.min_lat, box.max_lat)
        & lon.between(box.min_lon, box.max_lon)
    )


def flatten_locations(locations: DataFrame) -> DataFrame:
    """Location attributes with defaults (0.0, 'UTC', False, 'Unknown')."""
    lat = F.col("coordinates.latitude")
    lon = F.col("coordinates.longitude")
    etype = F.col("entity.type")
    return locations.select(
        F.col("id").alias("location_id"),
        F.coalesce(F.col("name"), F.lit("Unknown")).alias("location_name"),
        F.when(_nonzero(lat), lat).otherwise(F.lit(0.0)).alias("latitude"),
        F.when(_nonzero(lon), lon).otherwise(F.lit(0.0)).alias("longitude"),
        F.coalesce(F.col("timezone"), F.lit("UTC")).alias("timezone"),
        F.coalesce(F.col("isMobile"), F.lit(False)).alias("is_mobile"),
        F.when(etype.isNotNull() & (etype != ""), etype).otherwise(F.lit("Unknown")).alias("entity_type"),
    )


def sensors_of(locations: DataFrame) -> DataFrame:
    """J06 (first level): one row per (location, sensor) with the location's attributes."""
    return locations.select(
        F.col("id").alias("location_id"),
        F.coalesce(F.col("name"), F.lit("Unknown")).alias("location_name"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.coalesce(F.col("timezone"), F.lit("UTC")).alias("timezone"),
        F.explode("sensors").alias("s"),
    ).select(
        "location_id",
        "location_name",
        "latitude",
        "longitude",
        "timezone",
        F.col("s.id").alias("sensor_id"),
        F.col("s.parameter.id").alias("parameter_id"),
        F.col("s.parameter.name").alias("parameter_name"),
        F.col("s.parameter.units").alias("parameter_units"),
    )


def flatten_measurements(locations: DataFrame, sensor_days: DataFrame) -> DataFrame:
    """P18 + J06: location x sensor x day -> the 12-column bronze measurement row.

    The nested loop of the original becomes an explode of the sensors and an
    equi-join on ``sensor_id`` (shuffle join sized by AQE).  ``date`` is the first
    10 characters of the UTC stamp.
    """
    sensors = sensors_of(locations)
    j = sensor_days.join(sensors, "sensor_id", "inner")
    return j.select(
        F.substring("datetime_utc", 1, 10).alias("date"),
        "datetime_utc",
        "location_id",
        "location_name",
        "latitude",
        "longitude",
        "sensor_id",
        "parameter_id",
        "parameter_name",
        "parameter_units",
        "value",
        "timezone",
    )

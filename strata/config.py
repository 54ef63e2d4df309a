"""Configuration objects.  Every operator takes one of these instead of a constant,
so the same code runs the reference's parameters and any other binding."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceField:
    """One target column of a standardised trip frame."""

    target: str
    dtype: str
    source: str | None = None  # None: the column never exists for this source
    required: bool = True


@dataclass(frozen=True)
class TripSourceSpec:
    """How one landing-file flavour maps onto the common trip schema."""

    taxi_type: str
    fields: tuple[SourceField, ...]


def _trip_fields(pickup: str, dropoff: str, optional: dict[str, str]) -> tuple[SourceField, ...]:
    common = [
        SourceField("VendorID", "long", "VendorID"),
        SourceField("pickup_datetime", "timestamp_ntz", pickup),
        SourceField("dropoff_datetime", "timestamp_ntz", dropoff),
        SourceField("passenger_count", "double", "passenger_count"),
        SourceField("trip_distance", "double", "trip_distance"),
        SourceField("RatecodeID", "double", "RatecodeID"),
        SourceField("store_and_fwd_flag", "string", "store_and_fwd_flag"),
        SourceField("PULocationID", "long", "PULocationID"),
        SourceField("DOLocationID", "long", "DOLocationID"),
        SourceField("payment_type", "long", "payment_type"),
        SourceField("fare_amount", "double", "fare_amount"),
        SourceField("extra", "double", "extra"),
        SourceField("mta_tax", "double", "mta_tax"),
        SourceField("tip_amount", "double", "tip_amount"),
        SourceField("tolls_amount", "double", "tolls_amount"),
        SourceField("improvement_surcharge", "double", "improvement_surcharge"),
        SourceField("total_amount", "double", "total_amount"),
    ]
    tail = [
        ("congestion_surcharge", "double"),
        ("Airport_fee", "double"),
        ("ehail_fee", "double"),
        ("trip_type", "long"),
    ]
    for name, dtype in tail:
        common.append(SourceField(name, dtype, optional.get(name), required=False))
    return tuple(common)


# Source column names of the two landing-file flavours, and which
# optional columns each flavour may carry.
YELLOW = TripSourceSpec(
    "yellow",
    _trip_fields(
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        {"congestion_surcharge": "congestion_surcharge", "Airport_fee": "Airport_fee"},
    ),
)
GREEN = TripSourceSpec(
    "green",
    _trip_fields(
        "lpep_pickup_datetime",
        "lpep_dropoff_datetime",
        {"congestion_surcharge": "congestion_surcharge", "ehail_fee": "ehail_fee", "trip_type": "trip_type"},
    ),
)

TRIP_COLUMNS = tuple(f.target for f in YELLOW.fields) + ("taxi_type",)


@dataclass(frozen=True)
class TripRules:
    """Validity bounds of the silver trip table.

    Fixed values (defaults): pickup in [2015-01-01, 2025-01-01), fare and total
    >= 0, distance in [0, 500], duration (minutes, 2 decimals) in (0, 180].
    """

    date_from: str = "2015-01-01"
    date_to: str = "2025-01-01"
    max_distance: float = 500.0
    max_duration_minutes: float = 180.0


# NULL replacements applied after the validity filter.
TRIP_FILLS: dict[str, object] = {
    "passenger_count": 1.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "congestion_surcharge": 0.0,
    "Airport_fee": 0.0,
}


@dataclass(frozen=True)
class BoundingBox:
    """Inclusive latitude/longitude box (P17).  Fixed values: the New York City box."""

    min_lat: float = 40.4
    max_lat: float = 41.0
    min_lon: float = -74.3
    max_lon: float = -73.7


@dataclass(frozen=True)
class PollutantChoice:
    """Which measurement parameter the air-quality reports use.

    Fixed values: the pattern is matched against the lower-cased parameter name;
    the dot is a regex wildcard, as in the original pattern.
    """

    pattern: str = "pm25|pm2.5|pm 2.5"
    label: str = "PM2.5"


@dataclass(frozen=True)
class ReportOptions:
    """Knobs shared by the report builders."""

    pollutant: PollutantChoice = field(default_factory=PollutantChoice)
    top_n: int = 10
    country: str = "USA"
    corr_band: float = 0.3
    min_months_per_year: int = 3  # "more than 2 months" per year for a yearly correlation
    weighted: bool = False  # False: mean of daily means (reference parity)
    digits: int = 6  # rounding of report-level averages and ratios

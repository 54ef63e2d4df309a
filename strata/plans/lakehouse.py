"""Assemble silver and gold frames over one data root.

All attributes are lazy DataFrames; building them runs no job.  Within one
query, shared sub-plans (e.g. the month cut used by two report arms) are the
same DataFrame objects, so Spark can reuse their exchanges.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import PollutantChoice, ReportOptions, TripRules
from ..operators import dims, facts
from ..sources import bindings
from . import reports, silver

# Rules for the benchmark-table binding: only the date window moves (the
# derived trips span 1995-2001); distance, fare and duration bounds are the
# original ones.
BINDING_RULES = TripRules(date_from=bindings.TRIP_DATE_FROM, date_to=bindings.TRIP_DATE_TO)

# Pollutant choice for the binding: parameter names are order priorities.
BINDING_POLLUTANT = PollutantChoice(pattern="1-urgent|2-high", label="URGENT+HIGH")
BINDING_FALLBACK = PollutantChoice(pattern="zzz", label="PM2.5")
BINDING_OPTIONS = ReportOptions(pollutant=BINDING_POLLUTANT, country="NATION_1")


class Lakehouse:
    """Bronze -> silver -> gold over the benchmark tables under ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rules: TripRules = BINDING_RULES,
        options: ReportOptions = BINDING_OPTIONS,
    ):
        self.spark = spark
        self.root = root
        self.rules = rules
        self.options = options

    # bronze -----------------------------------------------------------------
    @cached_property
    def yellow_bronze(self) -> DataFrame:
        return bindings.yellow_trips_bronze(self.spark, self.root)

    @cached_property
    def green_bronze(self) -> DataFrame:
        return bindings.green_trips_bronze(self.spark, self.root)

    @cached_property
    def trips_bronze(self) -> DataFrame:
        return bindings.trips_bronze(self.spark, self.root)

    @cached_property
    def measurements_bronze(self) -> DataFrame:
        return bindings.measurements_bronze(self.spark, self.root)

    # silver -----------------------------------------------------------------
    @cached_property
    def silver_trips(self) -> DataFrame:
        return silver.silver_trips_tagged(self.trips_bronze, self.rules)

    @cached_property
    def silver_measurements(self) -> DataFrame:
        return silver.silver_measurements(self.measurements_bronze)

    @cached_property
    def locations(self) -> DataFrame:
        """Silver copy of the stations (flattened attributes)."""
        return bindings.locations_bronze(self.spark, self.root)

    @cached_property
    def silver_fx(self) -> DataFrame:
        return silver.silver_fx(bindings.fx_bronze(self.spark, self.root))

    @cached_property
    def silver_gdp(self) -> DataFrame:
        return silver.silver_gdp(bindings.gdp_bronze(self.spark, self.root))

    # gold -------------------------------------------------------------------
    @cached_property
    def fact_taxi(self) -> DataFrame:
        return schemas.conform(facts.fact_taxi_daily(self.silver_trips), schemas.FACT_TAXI_DAILY)

    @cached_property
    def fact_air(self) -> DataFrame:
        return schemas.conform(facts.fact_air_quality_daily(self.silver_measurements), schemas.FACT_AIR_QUALITY_DAILY)

    @cached_property
    def dim_date(self) -> DataFrame:
        # the fact has every pickup day and far fewer rows than the trips
        pickup_days = self.fact_taxi.select(F.make_date("year", "month", "day").alias("pickup_day"))
        dates = dims.distinct_dates(
            [
                (self.silver_fx, "date"),
                (pickup_days, "pickup_day"),
                (self.silver_measurements, "measurement_date"),
            ]
        )
        return schemas.conform(dims.dim_date(dates), schemas.DIM_DATE)

    @cached_property
    def dim_zone(self) -> DataFrame:
        return schemas.conform(dims.dim_zone(bindings.zones_bronze(self.spark, self.root)), schemas.DIM_ZONE)

    @cached_property
    def dim_fx(self) -> DataFrame:
        return schemas.conform(dims.dim_fx(self.silver_fx), schemas.DIM_FX)

    @cached_property
    def dim_gdp(self) -> DataFrame:
        return schemas.conform(dims.dim_gdp(self.silver_gdp), schemas.DIM_GDP)

    # month cuts and shared report inputs -------------------------------------
    @cached_property
    def taxi_cut(self) -> DataFrame:
        return facts.taxi_month_cut(self.fact_taxi, self.options.digits, self.options.weighted)

    @cached_property
    def air_cut(self) -> DataFrame:
        return facts.air_month_cut(self.fact_air, self.options.digits, self.options.weighted)

    @cached_property
    def pollutant(self) -> DataFrame:
        return reports.pollutant_frame(self.air_cut, self.options.pollutant)

    @cached_property
    def fx_monthly(self) -> DataFrame:
        return reports.fx_monthly(self.dim_fx, self.options)

    @cached_property
    def known_fx(self) -> DataFrame:
        """Monthly rates as the revenue report gets them: the bindings leave two months out, so that gaps are filled."""
        return self.fx_monthly.filter(~((F.col("year") == 1999) & F.col("month").isin(6, 7)))

    @cached_property
    def revenue_fx(self) -> DataFrame:
        return reports.revenue_fx_monthly(self.taxi_cut, self.known_fx, self.options)

    @cached_property
    def trip_pollution(self) -> DataFrame:
        return reports.trip_pollution_monthly(self.taxi_cut, self.pollutant, self.options)

    # materialisation ----------------------------------------------------------
    def with_written_fact(self) -> "Lakehouse":
        """Write the daily trip fact to the scratch folder and go on from it: a query that counts, joins and
        dates trips in several arms then reads the trips once."""
        from ..session import scratch_path
        from ..sinks.writers import write_and_reload

        self.__dict__["fact_taxi"] = write_and_reload(self.fact_taxi, scratch_path(self.spark, "fact"))
        return self

    def materialize(self, warehouse: str, fmt: str = "parquet") -> "Lakehouse":
        """Write silver, then gold, and continue from the written tables.

        Each layer is read back from storage before the next is built, so the
        lineage is cut per layer: a lost executor costs a re-read of files, not
        a recomputation from the landing data.  Row counts per table are
        observed during the writes (``written_rows``), not recomputed.
        """
        from ..sinks.writers import write_counted

        self.written_rows: dict[str, int] = {}

        def put(name: str, df: DataFrame, strict: bool = False) -> DataFrame:
            back, n = write_counted(df, f"{warehouse.rstrip('/')}/{name}", fmt, allow_schema_change=not strict)
            self.written_rows[name] = n
            return back

        for name in ("silver_trips", "silver_measurements", "locations"):
            self.__dict__[name] = put(name, getattr(self, name))
        for name in ("silver_fx", "silver_gdp"):  # K02: these two keep their schema
            self.__dict__[name] = put(name, getattr(self, name), strict=True)
        for name in ("fact_taxi", "fact_air", "dim_date", "dim_zone", "dim_fx", "dim_gdp"):
            self.__dict__[name] = put(name, getattr(self, name))
        for name in ("taxi_cut", "air_cut", "pollutant", "fx_monthly", "revenue_fx", "trip_pollution"):
            self.__dict__.pop(name, None)
        return self


class LandedLakehouse(Lakehouse):
    """The same layers over real landed files, with the original parameters.

    ``landing`` holds ``yellow/`` and ``green/`` monthly parquet folders,
    ``locations/`` (location pages JSON), ``sensor_days/`` (per-sensor daily
    results JSON), ``fx.csv``, ``gdp/`` (one JSON document per country) and
    ``zones.csv``.  Validity rules and report options default to the original
    values (2015-2024 window, PM2.5 pattern, USA GDP).
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        rules: TripRules = TripRules(),
        options: ReportOptions = ReportOptions(),
        case_sensitive: bool = False,
    ):
        super().__init__(spark, landing, rules, options)
        self.case_sensitive = case_sensitive

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @cached_property
    def known_fx(self) -> DataFrame:
        return self.fx_monthly

    @cached_property
    def landing_manifest(self) -> DataFrame:
        return self._loaded[1]

    @cached_property
    def _loaded(self) -> tuple[DataFrame, DataFrame]:
        from ..config import GREEN, YELLOW
        from ..operators.standardize import union_all
        from ..sources.files import load_parquet_set

        y = load_parquet_set(self.spark, self._p("yellow"), YELLOW, self.case_sensitive)
        g = load_parquet_set(self.spark, self._p("green"), GREEN, self.case_sensitive)
        return union_all([y.data, g.data]), y.manifest.unionByName(g.manifest)

    @cached_property
    def silver_trips(self) -> DataFrame:
        return silver.clean_trips(self._loaded[0], self.rules)

    @cached_property
    def measurements_bronze(self) -> DataFrame:
        from ..sources import payloads

        locs = payloads.in_box(payloads.read_locations(self.spark, self._p("locations")))
        days = payloads.read_sensor_days(self.spark, self._p("sensor_days"))
        return payloads.flatten_measurements(locs, days)

    @cached_property
    def locations(self) -> DataFrame:
        """Silver copy of the in-box locations (flattened attributes)."""
        from ..sources import payloads

        return payloads.flatten_locations(payloads.in_box(payloads.read_locations(self.spark, self._p("locations"))))

    @cached_property
    def silver_fx(self) -> DataFrame:
        from ..sources import payloads

        return silver.silver_fx(payloads.read_csv(self.spark, self._p("fx.csv"), payloads.FX_CSV))

    @cached_property
    def silver_gdp(self) -> DataFrame:
        from ..sources import payloads

        return silver.silver_gdp(payloads.read_gdp_json(self.spark, self._p("gdp")))

    @cached_property
    def dim_zone(self) -> DataFrame:
        from ..sources import payloads

        zones = payloads.read_csv(self.spark, self._p("zones.csv"), payloads.ZONE_CSV)
        return schemas.conform(dims.dim_zone(zones), schemas.DIM_ZONE)

"""Bronze-shaped frames derived from the supplied benchmark tables.

The library's operators consume landing data with the original column names
(trip files, sensor readings, exchange rates, GDP, zones).  The benchmark tables
carry none of those, so this module derives each bronze input from them with
plain projections and equi-joins; the derivation is part of every query plan, so
query work grows with the tables.

Binding (the mapping is ours; only the target column names are fixed values):

* trips  <- lineitem (+ supplier for the pickup zone).  l_linestatus 'O' rows
  form a "yellow" frame, 'F' rows a "green" frame with drifted types (text
  timestamps, integer passenger count, lower-case airport_fee on yellow).
  pickup = l_shipdate + ((7*l_orderkey + 131*l_linenumber) mod 1440) minutes,
  dropoff = pickup + 240*l_quantity + 7*l_linenumber seconds.
* measurements <- orders: station = o_custkey mod 7 + 1, parameter =
  o_orderpriority, value = floor(o_totalprice / 10000) - 2 (NULL for status 'P').
* locations <- customer stations (same station id rule).
* FX <- distinct order dates, a rate of four decimals from the day of the year;
  the revenue report leaves out 1999-06 and 1999-07 so that month gaps exist.
* GDP <- orders x customer x nation: yearly sum of o_totalprice per nation name.
* zones <- nation x region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load

TRIP_DATE_FROM = "1996-01-01"
TRIP_DATE_TO = "2001-01-01"


def _trip_base(spark: SparkSession, root: str, *linestatus: str) -> DataFrame:
    li = load(spark, root, "lineitem").filter(F.col("l_linestatus").isin(*linestatus))
    sup = load(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    # supplier is a dimension; Catalyst/AQE broadcast it only while its measured
    # size is under the broadcast threshold, sort-merge join otherwise.
    j = li.join(sup, li.l_suppkey == sup.s_suppkey, "left")
    pickup = F.expr(
        "timestampadd(MINUTE, pmod(7 * l_orderkey + 131 * l_linenumber, 1440), l_shipdate)"
    )
    j = j.withColumn("_pickup", pickup)
    dropoff = F.expr("timestampadd(SECOND, CAST(240 * l_quantity + 7 * l_linenumber AS INT), _pickup)")
    price_c = F.rint(F.col("l_extendedprice") * 100).cast("long")  # cents
    disc_c = F.rint(F.col("l_discount") * 100).cast("long")  # hundredths
    fare_c = F.when(F.col("l_discount") == 0, -price_c).otherwise(price_c)
    # tip = price * discount rounded half up to cents, in integer arithmetic
    tip_c = F.floor((price_c * disc_c + 50) / 100).cast("long")
    return j.select(
        "*",
        (F.col("l_suppkey") % 2 + 1).alias("_vendor"),
        F.col("_pickup").alias("_pu_ts"),
        dropoff.alias("_do_ts"),
        (fare_c / 100.0).alias("_fare"),
        (tip_c / 100.0).alias("_tip"),
        ((fare_c + tip_c + 130) / 100.0).alias("_total"),
    )


def _common_trip_cols() -> list:
    return [
        F.col("_vendor").cast("long").alias("VendorID"),
        F.when(F.col("l_tax") != 0, F.col("l_linenumber").cast("double")).alias("RatecodeID"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END").alias("store_and_fwd_flag"),
        F.col("s_nationkey").cast("long").alias("PULocationID"),
        F.pmod(F.col("l_partkey"), F.lit(25)).cast("long").alias("DOLocationID"),
        (F.pmod(F.col("l_linenumber"), F.lit(4)) + 1).cast("long").alias("payment_type"),
        (F.pmod(F.col("l_partkey"), F.lit(53)) * 10).cast("double").alias("trip_distance"),
        F.col("_fare").alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("_tip").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.col("_total").alias("total_amount"),
        F.when(F.col("l_returnflag") == "R", F.lit(2.5)).alias("congestion_surcharge"),
    ]


def _yellow_cols() -> list:
    return [
        *_common_trip_cols(),
        F.col("_pu_ts").alias("tpep_pickup_datetime"),
        F.col("_do_ts").alias("tpep_dropoff_datetime"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("double")).alias("passenger_count"),
        F.when(F.col("l_linenumber") == 1, F.lit(1.25)).alias("airport_fee"),
    ]


def _green_cols() -> list:
    pu_txt = F.when(
        F.pmod(F.col("l_orderkey"), F.lit(997)) == 0, F.lit("not a timestamp")
    ).otherwise(F.col("_pu_ts").cast("string"))
    return [
        *_common_trip_cols(),
        pu_txt.alias("lpep_pickup_datetime"),
        F.col("_do_ts").cast("string").alias("lpep_dropoff_datetime"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("int")).alias("passenger_count"),
        (F.pmod(F.col("l_orderkey"), F.lit(2)) + 1).cast("long").alias("trip_type"),
    ]


def yellow_trips_bronze(spark: SparkSession, root: str) -> DataFrame:
    """'Yellow' landing frame: typed timestamps, lower-case ``airport_fee``."""
    return _trip_base(spark, root, "O").select(*_yellow_cols())


def green_trips_bronze(spark: SparkSession, root: str) -> DataFrame:
    """'Green' landing frame: text timestamps (some unparsable), integer passengers."""
    return _trip_base(spark, root, "F").select(*_green_cols())


def trips_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Both flavours in one scan: ``flavour`` says which of the structs ``yellow`` and ``green`` holds the row."""
    b = _trip_base(spark, root, "O", "F")
    flavour = F.when(F.col("l_linestatus") == "O", "yellow").otherwise("green")
    return b.select(flavour.alias("flavour"), F.struct(*_yellow_cols()).alias("yellow"), F.struct(*_green_cols()).alias("green"))


def event_trips_bronze(spark: SparkSession, root: str) -> DataFrame:
    """'Yellow' landing frame from events: about a dozen trips per day and zone pair, amounts of three and
    distances of five decimals, some dropoffs before their pickup, too long or too far trips and negative fares."""
    e = load(spark, root, "events")
    cents = F.rint(F.col("value") * 100).cast("long")
    none = F.lit(None).cast("double")
    return e.select(
        (F.pmod("user_id", F.lit(2)) + 1).cast("long").alias("VendorID"),
        F.col("ts").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(SECOND, CAST(45 * pmod(event_id, 300) - 60 AS INT), CAST(ts AS TIMESTAMP_NTZ))").alias("tpep_dropoff_datetime"),
        F.when(F.pmod("event_id", F.lit(4)) != 0, F.pmod("event_id", F.lit(4)).cast("double")).alias("passenger_count"),
        F.when(F.pmod("event_id", F.lit(499)) == 0, F.lit(501.0)).otherwise(cents / 100000.0).alias("trip_distance"),
        none.alias("RatecodeID"),
        F.lit(None).cast("string").alias("store_and_fwd_flag"),
        F.pmod("event_id", F.lit(5)).cast("long").alias("PULocationID"),
        F.pmod("user_id", F.lit(5)).cast("long").alias("DOLocationID"),
        F.lit(1).cast("long").alias("payment_type"),
        ((cents - 500) / 100.0).alias("fare_amount"),
        F.lit(0.0).alias("extra"),
        F.lit(0.0).alias("mta_tax"),
        (F.pmod(cents, F.lit(1000)) / 1000.0).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.333).alias("improvement_surcharge"),
        ((cents * 10 - 5000 + 333) / 1000.0).alias("total_amount"),
        none.alias("congestion_surcharge"),
        none.alias("Airport_fee"),
    )


def measurements_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Flat daily sensor readings, the 12-column bronze measurement shape (P18 output)."""
    o = load(spark, root, "orders")
    loc = (F.pmod(F.col("o_custkey"), F.lit(7)) + 1).cast("long")
    pid = F.substring("o_orderpriority", 1, 1).cast("long")
    utc = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    # six decimals, so that a mean of rounded readings differs from the rounded mean
    micro = (F.floor(F.col("o_totalprice") / 10000).cast("long") - 2) * 1_000_000 + F.pmod(F.col("o_orderkey") * 7919, F.lit(1_000_000))
    value = F.when(F.col("o_orderstatus") != "P", micro.cast("double") / 1_000_000)
    return o.select(
        F.substring(utc, 1, 10).alias("date"),
        utc.alias("datetime_utc"),
        loc.alias("location_id"),
        F.concat(F.lit("Station "), loc.cast("string")).alias("location_name"),
        ((F.lit(4040) + loc * 9).cast("double") / 100).alias("latitude"),
        (-(F.lit(7430) - loc * 9).cast("double") / 100).alias("longitude"),
        (loc * 10 + pid).alias("sensor_id"),
        pid.alias("parameter_id"),
        F.col("o_orderpriority").alias("parameter_name"),
        F.when(pid <= 2, F.lit("ug/m3")).otherwise(F.lit("ppm")).alias("parameter_units"),
        value.alias("value"),
        F.lit("America/New_York").alias("timezone"),
    )


def fx_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Exchange-rate CSV shape (the used columns of the 32), one row per order."""
    o = load(spark, root, "orders")
    d = F.to_date("o_orderdate")
    rate = (F.lit(10000) + F.pmod(F.dayofyear(d) * 137, F.lit(4001))).cast("double") / 10000
    return o.select(
        F.lit("EXR.D.USD.EUR.SP00.A").alias("KEY"),
        F.lit("D").alias("FREQ"),
        F.lit("USD").alias("CURRENCY"),
        F.lit("EUR").alias("CURRENCY_DENOM"),
        F.date_format(d, "yyyy-MM-dd").alias("TIME_PERIOD"),
        rate.alias("OBS_VALUE"),
    )


def gdp_bronze(spark: SparkSession, root: str) -> DataFrame:
    """GDP records (countryiso3code, date as text, value): yearly order value per nation.

    Orders are first reduced to one row per (customer, year) in exact cents, so the
    join to customer and nation sees customers x years rows instead of every order
    and a customer with a huge share of orders cannot skew the join.
    """
    from ..functions.fixedpoint import units_sum, units_to_double

    o = load(spark, root, "orders")
    per_cust = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(units_sum("o_totalprice", 2).alias("cents"))
    c = load(spark, root, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, root, "nation").select("n_nationkey", "n_name")
    j = per_cust.join(c, per_cust.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy(
        F.col("n_name").alias("countryiso3code"),
        F.col("yr").cast("string").alias("date"),
    ).agg(units_to_double(F.sum("cents"), 2).alias("value"))


def zones_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Zone lookup shape (LocationID, Borough, Zone, service_zone)."""
    n = load(spark, root, "nation")
    r = load(spark, root, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("long").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit("Yellow Zone")).otherwise(F.lit("Boro Zone")).alias("service_zone"),
    )


def locations_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Flat station attributes (P19 output shape), one row per station."""
    c = load(spark, root, "customer")
    loc = (F.pmod(F.col("c_custkey"), F.lit(7)) + 1).cast("long")
    stations = c.select(loc.alias("location_id")).distinct()
    lid = F.col("location_id")
    return stations.select(
        lid,
        F.concat(F.lit("Station "), lid.cast("string")).alias("location_name"),
        ((F.lit(4040) + lid * 9).cast("double") / 100).alias("latitude"),
        (-(F.lit(7430) - lid * 9).cast("double") / 100).alias("longitude"),
        F.lit("America/New_York").alias("timezone"),
        F.lit(False).alias("is_mobile"),
        F.when(lid != 3, F.lit("government")).otherwise(F.lit("Unknown")).alias("entity_type"),
    )


# --------------------------------------------------------------------------
# Landed payload text derived from the tables (what an API or export would have
# delivered).  Each builder returns a single string column ``value`` (or
# ``line`` for CSV) that the readers in ``payloads`` parse with their schemas.

# Fixed values of the binding: the five order priorities double as sensor parameters.
PRIORITY_NAMES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LOCATION_PAGE_SIZE = 1000


def location_pages_text(spark: SparkSession, root: str) -> DataFrame:
    """Location pages: ``{"results": [location, ...]}`` with at most 1000 locations
    per page (customers grouped by key range, so a page never grows with skew)."""
    c = load(spark, root, "customer")
    key = F.col("c_custkey")
    names = F.array(*[F.lit(n) for n in PRIORITY_NAMES])
    sensors = F.when(F.pmod(key, F.lit(17)) == 0, F.array().cast("array<struct<id:bigint,parameter:struct<id:bigint,name:string,units:string>>>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.lit(5)),
            lambda k: F.struct(
                (key * 10 + k).cast("long").alias("id"),
                F.struct(
                    k.cast("long").alias("id"),
                    F.element_at(names, k).alias("name"),
                    F.when(k <= 2, F.lit("ug/m3")).otherwise(F.lit("ppm")).alias("units"),
                ).alias("parameter"),
            ),
        )
    )
    loc = F.struct(
        key.alias("id"),
        F.when(F.pmod(key, F.lit(50)) != 0, F.col("c_name")).alias("name"),
        F.when(F.pmod(key, F.lit(11)) != 0, F.lit("America/New_York")).alias("timezone"),
        (F.col("c_mktsegment") == "AUTOMOBILE").alias("isMobile"),
        F.struct(
            F.when(F.pmod(key, F.lit(97)) != 0, (F.lit(4030) + F.pmod(key, F.lit(80))).cast("double") / 100).alias("latitude"),
            ((F.lit(-7440) + F.pmod(F.col("c_nationkey") * 7, F.lit(80))).cast("double") / 100).alias("longitude"),
        ).alias("coordinates"),
        F.when(F.pmod(key, F.lit(13)) != 0, F.struct(F.col("c_mktsegment").alias("type"))).alias("entity"),
        sensors.alias("sensors"),
    )
    page = F.floor(key / LOCATION_PAGE_SIZE)
    return c.groupBy(page.alias("page")).agg(
        F.to_json(F.struct(F.sort_array(F.collect_list(loc)).alias("results"))).alias("value")
    )


def faulty_text(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The landed texts (a column ``value`` each) with faults that follow from their keys: lines cut short or too long, broken
    JSON, text where a number belongs, documents without records."""
    zone, line = F.split("line", ",")[0].cast("int") % 5, F.col("line")
    zones = F.when(zone == 1, F.regexp_replace(line, ",[^,]*$", "")).when(zone == 2, F.concat(line, F.lit(",more"))).when(zone == 3, F.concat(F.lit("no "), line))
    day = F.split("line", ",")[6].substr(9, 2)
    rates = F.when(day == "05", F.regexp_replace(line, r"[0-9]{4}-[0-9]{2}-05", "no date")).when(day == "06", F.regexp_replace(line, ",[^,]*$", ""))
    value, cut = F.col("value"), F.expr("substr(value, 1, length(value) - 9)")
    no_id = F.regexp_replace(value, '"sensor_id":[0-9]+', '"sensor_id":"none"')
    days = F.when(F.col("o_orderkey") % 97 == 0, cut).when(F.col("o_orderkey") % 89 == 0, no_id)
    code = F.get_json_object("value", "$[1][0].countryiso3code").substr(-1, 1)
    docs = F.when(code == "3", cut).when(code == "7", F.lit('[{"page":1}]'))
    return {
        "zones": zone_csv_lines(spark, root).select(F.coalesce(zones, line).alias("value")),
        "rates": fx_csv_lines(spark, root).select(F.coalesce(rates, line).alias("value")),
        "locations": location_pages_text(spark, root).select(F.when(F.col("page") % 2 == 1, cut).otherwise(value).alias("value")),
        "readings": sensor_days_text(spark, root, "o_orderkey").select(F.coalesce(days, value).alias("value")),
        "gdp": gdp_documents_text(spark, root).select(F.coalesce(docs, value).alias("value")),
    }


def sensor_days_text(spark: SparkSession, root: str, *keep: str) -> DataFrame:
    """Per-sensor daily results, one landed record per reading, after the order's columns ``keep``."""
    o = load(spark, root, "orders")
    pid = F.substring("o_orderpriority", 1, 1).cast("long")
    utc = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    value = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 10000).cast("double") - 2)
    period = F.when(F.pmod(F.col("o_orderkey"), F.lit(101)) != 0, F.struct(F.struct(utc.alias("utc")).alias("datetimeFrom")))
    rec = F.struct(
        (F.col("o_custkey") * 10 + pid).alias("sensor_id"),
        F.array(F.struct(value.alias("value"), period.alias("period"))).alias("results"),
    )
    return o.select(*keep, F.to_json(rec).alias("value"))


def gdp_documents_text(spark: SparkSession, root: str) -> DataFrame:
    """One ``[metadata, [record, ...]]`` document per country (records: one per year,
    so a document is bounded by the number of years)."""
    g = gdp_bronze(spark, root)
    rec = F.struct(
        F.struct(F.lit("NY.GDP.MKTP.CD").alias("id"), F.lit("GDP (current US$)").alias("value")).alias("indicator"),
        F.struct(F.col("countryiso3code").alias("id"), F.col("countryiso3code").alias("value")).alias("country"),
        F.col("countryiso3code"),
        F.col("date"),
        F.col("value"),
        F.lit("").alias("unit"),
        F.lit("").alias("obs_status"),
        F.lit(0).alias("decimal"),
    )
    per_country = g.groupBy("countryiso3code").agg(
        F.sort_array(F.collect_list(F.struct("date", rec.alias("r")))).alias("rs"), F.count(F.lit(1)).alias("n")
    )
    meta = F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"), F.lit(100).alias("per_page"), F.col("n").alias("total"))
    return per_country.select(
        F.concat(F.lit("["), F.to_json(meta), F.lit(","), F.to_json(F.transform("rs", lambda x: x["r"])), F.lit("]")).alias("value")
    )


def zone_csv_lines(spark: SparkSession, root: str) -> DataFrame:
    z = zones_bronze(spark, root)
    return z.select(F.concat_ws(",", "LocationID", "Borough", "Zone", "service_zone").alias("line"))


def fx_csv_lines(spark: SparkSession, root: str) -> DataFrame:
    """32-column exchange-rate export lines; OBS_VALUE is empty on the 13th of a month."""
    from .payloads import FX_CSV

    b = fx_bronze(spark, root)
    values = {
        "KEY": F.col("KEY"),
        "FREQ": F.col("FREQ"),
        "CURRENCY": F.col("CURRENCY"),
        "CURRENCY_DENOM": F.col("CURRENCY_DENOM"),
        "EXR_TYPE": F.lit("SP00"),
        "EXR_SUFFIX": F.lit("A"),
        "TIME_PERIOD": F.col("TIME_PERIOD"),
        "OBS_VALUE": F.when(F.substring("TIME_PERIOD", 9, 2) != "13", F.format_string("%.4f", F.col("OBS_VALUE"))).otherwise(F.lit("")),
        "OBS_STATUS": F.lit("A"),
        "OBS_CONF": F.lit("F"),
        "TIME_FORMAT": F.lit("P1D"),
        "COLLECTION": F.lit("A"),
        "DECIMALS": F.lit("4"),
        "TITLE": F.lit("US dollar/Euro"),
        "UNIT": F.lit("USD"),
        "UNIT_MULT": F.lit("0"),
    }
    cols = [values.get(f.name, F.lit("")) for f in FX_CSV.fields]
    return b.select(F.concat_ws(",", *cols).alias("line"))

"""Reference SQL for every registered query, in the ANSI/DuckDB dialect.

Each statement recomputes its result from the base tables (region nation
customer supplier part orders lineitem events ...) so it can be run by an
independent engine and compared with the Spark result.  Shared steps are CTEs
resolved by dependency; the SQL is written for clarity, not for speed.

Fixed-point arithmetic mirrors ``functions.fixedpoint``: values are summed as
integer units and rounded half away from zero with integer division.
"""

from __future__ import annotations


def units(x: str, scale: int) -> str:
    return f"CAST(round(({x}) * {10**scale}) AS BIGINT)"


def rdiv(num: str, den: str) -> str:
    """round(num/den) half away from zero, integral operands, den > 0."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def exact_sum(x: str, scale: int, digits: int) -> str:
    s = f"sum({units(x, scale)})"
    if digits >= scale:
        return f"(CAST({s} AS DOUBLE) / {10**scale})"
    return f"(CAST({rdiv(s, str(10 ** (scale - digits)))} AS DOUBLE) / {10**digits})"


def exact_avg(x: str, scale: int, digits: int) -> str:
    s = f"CAST(sum({units(x, scale)}) AS HUGEINT)"
    n = f"count({x})"
    if digits >= scale:
        num, den = f"({s} * {10 ** (digits - scale)})", n
    else:
        num, den = s, f"({n} * {10 ** (scale - digits)})"
    return f"(CASE WHEN {n} > 0 THEN CAST({rdiv(num, den)} AS DOUBLE) / {10**digits} END)"


def exact_ratio(num_units: str, den: str, num_scale: int, digits: int) -> str:
    if digits >= num_scale:
        num, d = f"(CAST({num_units} AS HUGEINT) * {10 ** (digits - num_scale)})", den
    else:
        num, d = f"CAST({num_units} AS HUGEINT)", f"(({den}) * {10 ** (num_scale - digits)})"
    return f"(CASE WHEN ({den}) > 0 THEN CAST({rdiv(num, d)} AS DOUBLE) / {10**digits} END)"


def plain_sum(x: str, digits: int) -> str:
    """ROUND(SUM(x), digits) over exact decimals: no input is rounded first."""
    return f"CAST(round(sum(CAST({x} AS DECIMAL(28, 10))), {digits}) AS DOUBLE)"


def plain_avg(x: str, digits: int) -> str:
    """ROUND(AVG(x), digits) over exact decimals: the decimal sum is divided once, half away from zero."""
    n = f"count({x})"
    whole = f"CAST(replace(CAST(sum(CAST({x} AS DECIMAL(28, 10))) AS VARCHAR), '.', '') AS HUGEINT)"
    return f"(CASE WHEN {n} > 0 THEN CAST({rdiv(whole, f'({n} * {10 ** (10 - digits)})')} AS DOUBLE) / {10**digits} END)"


def money_sum(x: str) -> str:
    return exact_sum(x, 2, 2)


def corr(x: str, y: str) -> str:
    """Pearson correlation, NULL for a constant series or a single pair, 6 digits."""
    xo = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    yo = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    den = f"(stddev_pop({xo}) * stddev_pop({yo}))"
    return f"round(CASE WHEN {den} = 0 THEN NULL ELSE covar_pop({xo}, {yo}) / {den} END, 6)"


def ym(y: str, m: str) -> str:
    return f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0'))"


def sign_flag(x: str) -> str:
    return f"CASE WHEN coalesce({x}, 0) > 0 THEN 'up' ELSE 'down' END"


def band(x: str, t: float = 0.3) -> str:
    return f"CASE WHEN {x} > {t} THEN 'positive' WHEN {x} < -{t} THEN 'negative' ELSE 'weak' END"


DIGITS = 6
POLLUTANT_PATTERN = "1-urgent|2-high"
POLLUTANT_LABEL = "URGENT+HIGH"
FALLBACK_PATTERN = "zzz"
FALLBACK_LABEL = "PM2.5"
COUNTRY = "NATION_1"

# --------------------------------------------------------------------- CTEs
# name -> (sql body, dependencies)
CTE: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (body, deps)


def _trip_base(status: str) -> str:
    return f"""
    SELECT l.*, s.s_nationkey,
           l.l_shipdate + to_minutes(CAST((7 * l.l_orderkey + 131 * l.l_linenumber) % 1440 AS BIGINT)) AS pu_ts,
           CASE WHEN l.l_discount = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS fare,
           CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS DOUBLE) AS tip
    FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    WHERE l.l_linestatus = '{status}'"""


def _trip_std(base: str, taxi_type: str) -> str:
    yellow = taxi_type == "yellow"
    pu = "pu_ts" if yellow else "CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE pu_ts END"
    return f"""
    SELECT CAST(l_suppkey % 2 + 1 AS BIGINT) AS VendorID,
           {pu} AS pickup_datetime,
           pu_ts + to_seconds(CAST(240 * l_quantity + 7 * l_linenumber AS BIGINT)) AS dropoff_datetime,
           CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count,
           CAST((l_partkey % 53) * 10 AS DOUBLE) AS trip_distance,
           CASE WHEN l_tax <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS RatecodeID,
           CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS store_and_fwd_flag,
           CAST(s_nationkey AS BIGINT) AS PULocationID,
           CAST(l_partkey % 25 AS BIGINT) AS DOLocationID,
           CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
           fare AS fare_amount, 0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax, tip AS tip_amount,
           0.0::DOUBLE AS tolls_amount, 0.3::DOUBLE AS improvement_surcharge,
           CAST(CAST(fare AS DECIMAL(12,2)) + CAST(tip AS DECIMAL(12,2)) + 1.30 AS DOUBLE) AS total_amount,
           CASE WHEN l_returnflag = 'R' THEN 2.5::DOUBLE END AS congestion_surcharge,
           {"CASE WHEN l_linenumber = 1 THEN 1.25::DOUBLE END" if yellow else "CAST(NULL AS DOUBLE)"} AS Airport_fee,
           CAST(NULL AS DOUBLE) AS ehail_fee,
           {"CAST(NULL AS BIGINT)" if yellow else "CAST(l_orderkey % 2 + 1 AS BIGINT)"} AS trip_type,
           '{taxi_type}' AS taxi_type
    FROM {base}"""


cte("trip_base_y", [], _trip_base("O"))
cte("trip_base_g", [], _trip_base("F"))
cte("trips_std", ["trip_base_y", "trip_base_g"], _trip_std("trip_base_y", "yellow") + "\nUNION ALL\n" + _trip_std("trip_base_g", "green"))
cte(
    "trips_valid",
    ["trips_std"],
    """
    SELECT * REPLACE (coalesce(passenger_count, 1.0) AS passenger_count, coalesce(RatecodeID, 1.0) AS RatecodeID,
                      coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag,
                      coalesce(congestion_surcharge, 0.0) AS congestion_surcharge, coalesce(Airport_fee, 0.0) AS Airport_fee),
           round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 2) AS trip_duration_minutes
    FROM trips_std
    WHERE pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '2001-01-01'
      AND fare_amount >= 0 AND total_amount >= 0 AND trip_distance >= 0 AND trip_distance <= 500""",
)
cte(
    "silver_trips",
    ["trips_valid"],
    """
    SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year, CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
           CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek
    FROM trips_valid WHERE trip_duration_minutes > 0 AND trip_duration_minutes <= 180""",
)
cte(
    "meas_bronze",
    [],
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date,
           strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS datetime_utc,
           CAST(o_custkey % 7 + 1 AS BIGINT) AS location_id,
           'Station ' || CAST(o_custkey % 7 + 1 AS VARCHAR) AS location_name,
           CAST(4040 + (o_custkey % 7 + 1) * 9 AS DOUBLE) / 100 AS latitude,
           -CAST(7430 - (o_custkey % 7 + 1) * 9 AS DOUBLE) / 100 AS longitude,
           CAST((o_custkey % 7 + 1) * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS BIGINT) AS sensor_id,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS parameter_id,
           o_orderpriority AS parameter_name,
           CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) <= 2 THEN 'ug/m3' ELSE 'ppm' END AS parameter_units,
           CASE WHEN o_orderstatus <> 'P' THEN CAST((CAST(floor(o_totalprice / 10000) AS BIGINT) - 2) * 1000000 + (o_orderkey * 7919) % 1000000 AS DOUBLE) / 1000000 END AS value,
           'America/New_York' AS timezone
    FROM orders""",
)
cte(
    "silver_measurements",
    ["meas_bronze"],
    """
    SELECT DISTINCT *, CAST(date AS DATE) AS measurement_date,
           CAST(year(CAST(date AS DATE)) AS INTEGER) AS measurement_year,
           CAST(month(CAST(date AS DATE)) AS INTEGER) AS measurement_month,
           CAST(day(CAST(date AS DATE)) AS INTEGER) AS measurement_day,
           CAST(dayofweek(CAST(date AS DATE)) + 1 AS INTEGER) AS measurement_dayofweek
    FROM meas_bronze WHERE value IS NOT NULL AND value >= 0""",
)
cte(
    "silver_fx",
    [],
    """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
           CAST(10000 + (dayofyear(o_orderdate) * 137) % 4001 AS DOUBLE) / 10000 AS usd_eur_rate,
           'USD' AS currency_from, 'EUR' AS currency_to,
           CAST(year(o_orderdate) AS INTEGER) AS fx_year, CAST(month(o_orderdate) AS INTEGER) AS fx_month,
           CAST(day(o_orderdate) AS INTEGER) AS fx_day
    FROM orders""",
)
cte(
    "silver_gdp",
    [],
    f"""
    SELECT n_name AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year, {money_sum("o_totalprice")} AS gdp_usd
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, year(o_orderdate)""",
)
cte(
    "fact_taxi",
    ["silver_trips"],
    f"""
    SELECT pickup_year AS year, pickup_month AS month, pickup_day AS day,
           CAST(pickup_year * 10000 + pickup_month * 100 + pickup_day AS INTEGER) AS date_key,
           PULocationID AS pickup_zone_id, DOLocationID AS dropoff_zone_id, taxi_type,
           CAST(count(*) AS INTEGER) AS trip_count,
           CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
           {plain_sum("trip_distance", 2)} AS total_distance,
           {plain_sum("fare_amount", 2)} AS total_fare,
           {plain_sum("tip_amount", 2)} AS total_tips,
           {plain_sum("total_amount", 2)} AS total_revenue,
           {exact_avg("trip_duration_minutes", 2, 2)} AS avg_trip_duration
    FROM silver_trips
    GROUP BY pickup_year, pickup_month, pickup_day, PULocationID, DOLocationID, taxi_type""",
)
cte(
    "fact_air",
    ["silver_measurements"],
    f"""
    SELECT measurement_year AS year, measurement_month AS month, measurement_day AS day,
           CAST(measurement_year * 10000 + measurement_month * 100 + measurement_day AS INTEGER) AS date_key,
           location_id, location_name, parameter_name, parameter_units,
           CAST(count(*) AS INTEGER) AS measurement_count,
           {plain_avg("value", 4)} AS avg_value,
           CAST(round(CAST(min(value) AS DECIMAL(28, 10)), 4) AS DOUBLE) AS min_value, CAST(round(CAST(max(value) AS DECIMAL(28, 10)), 4) AS DOUBLE) AS max_value
    FROM silver_measurements
    GROUP BY measurement_year, measurement_month, measurement_day, location_id, location_name, parameter_name, parameter_units""",
)
# every day between the first and the last one of three tables that at least one of them has
_DAYS = {"silver_fx": "date", "silver_trips": "pickup_datetime", "silver_measurements": "measurement_date"}
cte(
    "busy_days",
    list(_DAYS),
    f"""
    SELECT CAST(t.d AS DATE) AS day
    FROM (SELECT unnest(generate_series(least({", ".join(f"(SELECT min({c}) FROM {t})" for t, c in _DAYS.items())})::DATE,
                                        greatest({", ".join(f"(SELECT max({c}) FROM {t})" for t, c in _DAYS.items())})::DATE, INTERVAL 1 DAY)) AS d) t
    WHERE {" OR ".join(f"CAST(t.d AS DATE) IN (SELECT CAST({c} AS DATE) FROM {t})" for t, c in _DAYS.items())}""",
)
cte(
    "dim_date",
    ["busy_days"],
    """
    SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day AS date, CAST(date_part('year', day) AS INTEGER) AS year,
           CAST(date_part('quarter', day) AS INTEGER) AS quarter, CAST(date_part('month', day) AS INTEGER) AS month,
           CAST(date_part('day', day) AS INTEGER) AS day_of_month, CAST(isodow(day) % 7 + 1 AS INTEGER) AS day_of_week,
           CAST(isodow(day) >= 6 AS INTEGER) AS is_weekend,
           -- Sundays so far this year; the days before the first one are week 1
           CAST(strftime(day, '%U') AS INTEGER) + CAST(isodow(date_trunc('year', day)) <> 7 AS INTEGER) AS week_of_year
    FROM busy_days""",
)
cte(
    "dim_zone",
    [],
    """
    SELECT CAST(n_nationkey AS BIGINT) AS zone_id, r_name AS borough, n_name AS zone_name,
           CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
)
cte(
    "dim_fx",
    ["silver_fx"],
    """
    SELECT CAST(fx_year * 10000 + fx_month * 100 + fx_day AS INTEGER) AS date_key, date AS fx_date,
           usd_eur_rate, fx_year, fx_month, fx_day
    FROM silver_fx""",
)
cte("dim_gdp", ["silver_gdp"], "SELECT country_code, year, gdp_usd FROM silver_gdp")
cte(
    "taxi_cut",
    ["fact_taxi"],
    f"""
    SELECT year, month, taxi_type, pickup_zone_id, dropoff_zone_id,
           CAST(sum(trip_count) AS BIGINT) AS trip_count, CAST(sum(total_passengers) AS BIGINT) AS total_passengers,
           {money_sum("total_distance")} AS total_distance, {money_sum("total_fare")} AS total_fare,
           {money_sum("total_tips")} AS total_tips, {money_sum("total_revenue")} AS total_revenue,
           {exact_avg("avg_trip_duration", 2, DIGITS)} AS avg_trip_duration
    FROM fact_taxi GROUP BY year, month, taxi_type, pickup_zone_id, dropoff_zone_id""",
)
cte(
    "air_cut",
    ["fact_air"],
    f"""
    SELECT year, month, location_id, location_name, parameter_name, parameter_units,
           CAST(sum(measurement_count) AS BIGINT) AS measurement_count,
           {exact_avg("avg_value", 4, DIGITS)} AS avg_value,
           min(min_value) AS min_value, max(max_value) AS max_value
    FROM fact_air GROUP BY year, month, location_id, location_name, parameter_name, parameter_units""",
)


def _candidates(pattern: str, label: str) -> str:
    return f"""
    WITH c AS (
        SELECT parameter_name, count(*) AS row_count,
               coalesce(regexp_matches(lower(parameter_name), '{pattern}'), false) AS matched
        FROM air_cut GROUP BY parameter_name),
    r AS (
        SELECT *, max(CAST(matched AS INTEGER)) OVER () = 1 AS any_match,
               row_number() OVER (ORDER BY parameter_name IS NULL, row_count DESC, parameter_name ASC NULLS LAST) AS rn,
               first_value(parameter_name) OVER (ORDER BY parameter_name IS NULL, row_count DESC, parameter_name ASC NULLS LAST
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS top_name
        FROM c)
    SELECT parameter_name, row_count, matched,
           CASE WHEN any_match THEN matched ELSE (rn = 1 AND parameter_name IS NOT NULL) END AS selected,
           CASE WHEN any_match THEN '{label}' ELSE top_name END AS label
    FROM r"""


cte("pick", ["air_cut"], _candidates(POLLUTANT_PATTERN, POLLUTANT_LABEL))
cte("pm", ["air_cut", "pick"], "SELECT * FROM air_cut WHERE parameter_name IN (SELECT parameter_name FROM pick WHERE selected)")
cte(
    "taxi_monthly",
    ["taxi_cut"],
    f"""SELECT year, month, CAST(sum(trip_count) AS BIGINT) AS trip_count, {money_sum("total_revenue")} AS total_revenue
    FROM taxi_cut GROUP BY year, month""",
)
cte(
    "trip_pollution",
    ["taxi_monthly", "pm"],
    f"""
    SELECT t.year, t.month, t.trip_count, t.total_revenue, a.avg_value, {ym("t.year", "t.month")} AS year_month
    FROM taxi_monthly t
    JOIN (SELECT year, month, {exact_avg("avg_value", DIGITS, DIGITS)} AS avg_value FROM pm GROUP BY year, month) a
      ON t.year = a.year AND t.month = a.month""",
)
cte(
    "fx_monthly",
    ["dim_fx"],
    f"SELECT fx_year AS year, fx_month AS month, {plain_avg('usd_eur_rate', DIGITS)} AS usd_eur_rate FROM dim_fx GROUP BY fx_year, fx_month",
)
cte(
    "revenue_fx",
    ["taxi_monthly", "fx_monthly"],
    f"""
    WITH j AS (SELECT t.year, t.month, t.trip_count, t.total_revenue, f.usd_eur_rate
               FROM taxi_monthly t LEFT JOIN fx_monthly f ON t.year = f.year AND t.month = f.month AND NOT (f.year = 1999 AND f.month IN (6, 7))),
    m AS (SELECT {exact_ratio(f"sum({units('usd_eur_rate', DIGITS)})", f"count({units('usd_eur_rate', DIGITS)})", DIGITS, DIGITS)} AS fill FROM j)
    SELECT year, month, trip_count, total_revenue, coalesce(usd_eur_rate, m.fill) AS usd_eur_rate,
           total_revenue / coalesce(usd_eur_rate, m.fill) AS total_revenue_eur
    FROM j, m""",
)
cte(
    "daily_pollutant",
    ["fact_air", "pick"],
    f"""SELECT date_key, {exact_avg("avg_value", 4, DIGITS)} AS pollutant FROM fact_air
    WHERE parameter_name IN (SELECT parameter_name FROM pick WHERE selected) GROUP BY date_key""",
)


def with_ctes(needs: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return select
    head = "WITH " + ",\n".join(f"{n} AS ({CTE[n][0]}\n)" for n in order)
    body = select.lstrip()
    if body[:4].upper() == "WITH":
        return head + ",\n" + body[4:]
    return head + "\n" + body


SQL: dict[str, str] = {}


def q(name: str, needs: list[str], select: str) -> None:
    SQL[name] = with_ctes(needs, select)


q("silver_trips", ["silver_trips"], "SELECT * FROM silver_trips")
q("silver_measurements", ["silver_measurements"], "SELECT * FROM silver_measurements")
q("silver_gdp", ["silver_gdp"], "SELECT * FROM silver_gdp")
q("silver_fx", ["silver_fx"], "SELECT * FROM silver_fx")
q(
    "reject_counts",
    ["trips_std"],
    """
    SELECT taxi_type, count(*) AS input_rows,
      count(*) FILTER (WHERE NOT coalesce(pickup_datetime >= TIMESTAMP '1996-01-01', false)) AS rejected_pickup_from,
      count(*) FILTER (WHERE NOT coalesce(pickup_datetime < TIMESTAMP '2001-01-01', false)) AS rejected_pickup_to,
      count(*) FILTER (WHERE NOT coalesce(fare_amount >= 0, false)) AS rejected_fare_non_negative,
      count(*) FILTER (WHERE NOT coalesce(total_amount >= 0, false)) AS rejected_total_non_negative,
      count(*) FILTER (WHERE NOT coalesce(trip_distance >= 0, false)) AS rejected_distance_non_negative,
      count(*) FILTER (WHERE NOT coalesce(trip_distance <= 500, false)) AS rejected_distance_max,
      count(*) FILTER (WHERE NOT coalesce(round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 2) > 0, false)) AS rejected_duration_positive,
      count(*) FILTER (WHERE NOT coalesce(round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 2) <= 180, false)) AS rejected_duration_max,
      count(*) FILTER (WHERE coalesce(pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '2001-01-01'
          AND fare_amount >= 0 AND total_amount >= 0 AND trip_distance >= 0 AND trip_distance <= 500
          AND round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 2) > 0
          AND round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 2) <= 180, false)) AS kept
    FROM trips_std GROUP BY taxi_type""",
)
q("fact_trips_daily", ["fact_taxi"], "SELECT * FROM fact_taxi")
q("fact_measurements_daily", ["fact_air"], "SELECT * FROM fact_air")
q("dim_date", ["dim_date"], "SELECT * FROM dim_date")
q("dim_zone", ["dim_zone"], "SELECT * FROM dim_zone")
q("dim_fx", ["dim_fx"], "SELECT * FROM dim_fx")
q("dim_gdp", ["dim_gdp"], "SELECT * FROM dim_gdp")
q(
    "star_trips",
    ["fact_taxi", "dim_date", "dim_fx", "dim_zone"],
    """
    SELECT f.*, d.quarter, d.day_of_week, d.is_weekend, d.week_of_year, x.usd_eur_rate,
           pz.zone_name AS pickup_zone_name, pz.borough AS pickup_borough,
           dz.zone_name AS dropoff_zone_name, dz.borough AS dropoff_borough
    FROM fact_taxi f
    LEFT JOIN dim_date d ON f.date_key = d.date_key
    LEFT JOIN dim_fx x ON f.date_key = x.date_key
    LEFT JOIN dim_zone pz ON f.pickup_zone_id = pz.zone_id
    LEFT JOIN dim_zone dz ON f.dropoff_zone_id = dz.zone_id""",
)
q("trips_month_cut", ["taxi_cut"], "SELECT * FROM taxi_cut")
q("measurements_month_cut", ["air_cut"], "SELECT * FROM air_cut")
q(
    "monthly_trips",
    ["taxi_cut"],
    f"SELECT year, month, CAST(sum(trip_count) AS BIGINT) AS trip_count, {ym('year', 'month')} AS year_month FROM taxi_cut GROUP BY year, month ORDER BY year, month",
)
q(
    "monthly_avg_fare",
    ["taxi_cut"],
    f"""SELECT year, month, {money_sum("total_fare")} AS total_fare, CAST(sum(trip_count) AS BIGINT) AS trip_count,
           {exact_ratio(f"sum({units('total_fare', 2)})", "sum(trip_count)", 2, DIGITS)} AS avg_fare,
           {ym('year', 'month')} AS year_month
    FROM taxi_cut GROUP BY year, month ORDER BY year, month""",
)
q(
    "top_zones",
    ["taxi_cut", "dim_zone"],
    """
    SELECT t.pickup_zone_id, coalesce(z.zone_name, 'Unknown') AS zone_name, coalesce(z.borough, 'Unknown') AS borough, t.trip_count
    FROM (SELECT pickup_zone_id, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM taxi_cut
          WHERE pickup_zone_id IS NOT NULL GROUP BY pickup_zone_id) t
    LEFT JOIN dim_zone z ON t.pickup_zone_id = z.zone_id
    ORDER BY t.trip_count DESC, t.pickup_zone_id ASC LIMIT 10""",
)
q(
    "type_compare",
    ["taxi_cut"],
    f"""
    WITH p AS (SELECT taxi_type, CAST(sum(trip_count) AS BIGINT) AS trip_count, sum({units('total_revenue', 2)}) AS ru
               FROM taxi_cut GROUP BY taxi_type)
    SELECT taxi_type, trip_count, CAST(ru AS DOUBLE) / 100 AS total_revenue,
           {exact_ratio("trip_count * 100", "sum(trip_count) OVER ()", 0, DIGITS)} AS trip_share_pct,
           {exact_ratio("ru * 100", "sum(ru) OVER ()", 0, DIGITS)} AS revenue_share_pct
    FROM p""",
)
q(
    "mobility_kpis",
    ["taxi_cut"],
    f"""SELECT CAST(sum(trip_count) AS BIGINT) AS total_trips, {money_sum("total_revenue")} AS total_revenue,
           {exact_ratio(f"sum({units('total_fare', 2)})", "sum(trip_count)", 2, DIGITS)} AS avg_fare,
           CAST(sum(total_passengers) AS BIGINT) AS total_passengers
    FROM taxi_cut""",
)
q(
    "pollutant_pick",
    ["air_cut"],
    f"SELECT *, '{POLLUTANT_PATTERN}' AS pattern FROM ({_candidates(POLLUTANT_PATTERN, POLLUTANT_LABEL)})\nUNION ALL\n"
    f"SELECT *, '{FALLBACK_PATTERN}' AS pattern FROM ({_candidates(FALLBACK_PATTERN, FALLBACK_LABEL)})",
)
q(
    "pollutant_monthly",
    ["pm"],
    f"SELECT year, month, {exact_avg('avg_value', DIGITS, DIGITS)} AS avg_value, {ym('year', 'month')} AS year_month FROM pm GROUP BY year, month ORDER BY year, month",
)
q(
    "pollutant_by_location",
    ["pm"],
    f"""SELECT location_name, {exact_avg('avg_value', DIGITS, DIGITS)} AS avg_value FROM pm WHERE location_name IS NOT NULL
    GROUP BY location_name ORDER BY avg_value DESC, location_name ASC LIMIT 10""",
)
q("pollutant_seasonal", ["pm"], f"SELECT month, {exact_avg('avg_value', DIGITS, DIGITS)} AS avg_value FROM pm GROUP BY month ORDER BY month")
q(
    "pollutant_yearly",
    ["pm"],
    f"SELECT year, {exact_avg('avg_value', DIGITS, DIGITS)} AS avg_value, max(max_value) AS max_value FROM pm GROUP BY year ORDER BY year",
)
q(
    "pollutant_kpis",
    ["pm"],
    f"""SELECT {exact_avg('avg_value', DIGITS, DIGITS)} AS avg_value, max(max_value) AS max_value, min(min_value) AS min_value,
           count(DISTINCT location_name) AS n_locations FROM pm""",
)
q("trip_pollution_monthly", ["trip_pollution"], "SELECT * FROM trip_pollution")
q(
    "trip_pollution_corr",
    ["trip_pollution"],
    f"SELECT {corr('trip_count', 'avg_value')} AS correlation, count(*) AS n_months, {band(corr('trip_count', 'avg_value'))} AS band FROM trip_pollution",
)
q(
    "trip_pollution_corr_yearly",
    ["trip_pollution"],
    f"""SELECT year, count(*) AS n_months, {corr('trip_count', 'avg_value')} AS correlation,
           {sign_flag(corr('trip_count', 'avg_value'))} AS direction
    FROM trip_pollution GROUP BY year HAVING count(*) > 2 ORDER BY year""",
)
q("trips_seasonal", ["taxi_cut"], "SELECT month, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM taxi_cut GROUP BY month ORDER BY month")
q("fx_monthly", ["fx_monthly"], "SELECT * FROM fx_monthly")
q("revenue_fx_monthly", ["revenue_fx"], "SELECT * FROM revenue_fx ORDER BY year, month")
q(
    "economic_kpis",
    ["revenue_fx", "dim_fx"],
    f"""SELECT 'total_revenue_usd' AS metric, {money_sum("total_revenue")} AS value FROM revenue_fx
    UNION ALL SELECT 'total_revenue_eur', round(sum(total_revenue_eur), 2) FROM revenue_fx
    UNION ALL SELECT 'avg_usd_eur_rate', {plain_avg('usd_eur_rate', DIGITS)} FROM dim_fx""",
)
q(
    "revenue_gdp_yearly",
    ["revenue_fx", "dim_gdp"],
    f"""
    WITH y AS (SELECT year, {money_sum("total_revenue")} AS total_revenue FROM revenue_fx GROUP BY year),
    j AS (SELECT y.year, y.total_revenue, g.gdp_usd FROM y LEFT JOIN (SELECT year, gdp_usd FROM dim_gdp WHERE country_code = '{COUNTRY}') g ON y.year = g.year),
    w AS (SELECT *, (total_revenue / lag(total_revenue) OVER (ORDER BY year) - 1) * 100 AS revenue_growth FROM j)
    SELECT year, total_revenue, gdp_usd, gdp_usd / 1e12 AS gdp_trillions, total_revenue / 1e6 AS revenue_millions,
           revenue_growth, {sign_flag('revenue_growth')} AS growth_direction
    FROM w ORDER BY year""",
)
q(
    "row_counts",
    ["silver_trips", "silver_measurements", "silver_fx", "silver_gdp", "fact_taxi", "fact_air", "dim_date", "dim_zone", "dim_fx", "dim_gdp"],
    "\nUNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {t}"
        for label, t in [
            ("silver_taxi_trips", "silver_trips"),
            ("silver_air_quality", "silver_measurements"),
            ("silver_fx_rates", "silver_fx"),
            ("silver_gdp", "silver_gdp"),
            ("FactTaxiDaily", "fact_taxi"),
            ("FactAirQualityDaily", "fact_air"),
            ("DimDate", "dim_date"),
            ("DimZone", "dim_zone"),
            ("DimFX", "dim_fx"),
            ("DimGDP", "dim_gdp"),
        ]
    ),
)
q(
    "counts_by_type_year",
    ["silver_trips"],
    "SELECT taxi_type, pickup_year, count(*) AS row_count FROM silver_trips GROUP BY taxi_type, pickup_year ORDER BY taxi_type, pickup_year",
)
q(
    "summary",
    ["taxi_cut", "air_cut", "dim_date", "dim_zone", "dim_fx", "dim_gdp"],
    """SELECT 'taxi_trips' AS metric, CAST(sum(trip_count) AS BIGINT) AS value FROM taxi_cut
    UNION ALL SELECT 'air_quality_rows', count(*) FROM air_cut
    UNION ALL SELECT 'first_year', min(year) FROM dim_date
    UNION ALL SELECT 'last_year', max(year) FROM dim_date
    UNION ALL SELECT 'zones', count(DISTINCT zone_id) FROM dim_zone
    UNION ALL SELECT 'fx_rows', count(*) FROM dim_fx
    UNION ALL SELECT 'countries', count(DISTINCT country_code) FROM dim_gdp""",
)
q(
    "daily_corr",
    ["fact_taxi", "daily_pollutant"],
    f"""
    WITH t AS (SELECT date_key, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM fact_taxi GROUP BY date_key),
    j AS (SELECT t.trip_count, p.pollutant FROM t JOIN daily_pollutant p ON t.date_key = p.date_key)
    SELECT {corr('trip_count', 'pollutant')} AS correlation, count(*) AS n_days, {band(corr('trip_count', 'pollutant'))} AS band FROM j""",
)
q(
    "zone_hour_link",
    ["silver_trips", "daily_pollutant"],
    f"""
    WITH t AS (SELECT PULocationID AS zone, pickup_hour AS hour,
                      CAST(pickup_year * 10000 + pickup_month * 100 + pickup_day AS INTEGER) AS date_key FROM silver_trips),
    z AS (SELECT zone, date_key, count(*) AS trips FROM t WHERE zone IS NOT NULL GROUP BY zone, date_key),
    h AS (SELECT hour, date_key, count(*) AS trips FROM t WHERE hour IS NOT NULL GROUP BY hour, date_key),
    both_ AS (
        SELECT 'zone' AS dimension, CAST(z.zone AS BIGINT) AS key, {corr('trips', 'pollutant')} AS correlation, count(*) AS n_days
        FROM z JOIN daily_pollutant p ON z.date_key = p.date_key GROUP BY z.zone
        UNION ALL
        SELECT 'hour', CAST(h.hour AS BIGINT), {corr('trips', 'pollutant')}, count(*)
        FROM h JOIN daily_pollutant p ON h.date_key = p.date_key GROUP BY h.hour),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY dimension ORDER BY abs(correlation) DESC NULLS LAST, key ASC) AS INTEGER) AS rank FROM both_)
    SELECT * FROM r WHERE rank <= 10""",
)
q(
    "revenue_per_trip",
    ["revenue_fx", "dim_fx"],
    f"""
    WITH m AS (SELECT {plain_avg('usd_eur_rate', DIGITS)} AS mean_rate FROM dim_fx),
    b AS (SELECT year, month, trip_count,
                 {exact_ratio(units('total_revenue', 2), 'trip_count', 2, DIGITS)} AS usd_per_trip, usd_eur_rate
          FROM revenue_fx)
    SELECT b.*, usd_per_trip / usd_eur_rate AS eur_per_trip, usd_per_trip / m.mean_rate AS eur_per_trip_at_mean_rate,
           usd_per_trip / usd_eur_rate - usd_per_trip / m.mean_rate AS fx_effect
    FROM b, m ORDER BY year, month""",
)
q(
    "three_domain_trend",
    ["taxi_cut", "pm", "dim_gdp"],
    f"""
    WITH t AS (SELECT year, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM taxi_cut GROUP BY year),
    a AS (SELECT year, {exact_avg('avg_value', DIGITS, DIGITS)} AS pollutant FROM pm GROUP BY year),
    g AS (SELECT year, gdp_usd FROM dim_gdp WHERE country_code = '{COUNTRY}'),
    j AS (SELECT coalesce(t.year, a.year) AS year, t.trip_count, a.pollutant FROM t FULL OUTER JOIN a ON t.year = a.year),
    k AS (SELECT coalesce(j.year, g.year) AS year, j.trip_count, j.pollutant, g.gdp_usd FROM j FULL OUTER JOIN g ON j.year = g.year)
    SELECT year, trip_count, pollutant, gdp_usd,
           (trip_count / lag(trip_count) OVER (ORDER BY year) - 1) * 100 AS trips_growth,
           (pollutant / lag(pollutant) OVER (ORDER BY year) - 1) * 100 AS pollutant_growth,
           (gdp_usd / lag(gdp_usd) OVER (ORDER BY year) - 1) * 100 AS gdp_growth
    FROM k ORDER BY year""",
)

# ------------------------------------------------------------- sources and sinks

cte(
    "loc",
    [],
    """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS name,
           CASE WHEN c_custkey % 11 <> 0 THEN 'America/New_York' END AS timezone,
           c_mktsegment = 'AUTOMOBILE' AS is_mobile,
           CASE WHEN c_custkey % 97 <> 0 THEN CAST(4030 + c_custkey % 80 AS DOUBLE) / 100 END AS lat,
           CAST(-7440 + (c_nationkey * 7) % 80 AS DOUBLE) / 100 AS lon,
           CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS etype,
           CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE 5 END AS n_sensors
    FROM customer""",
)
cte(
    "box",
    ["loc"],
    """
    SELECT * FROM loc
    WHERE lat IS NOT NULL AND lat <> 0 AND lon IS NOT NULL AND lon <> 0
      AND lat BETWEEN 40.4 AND 41.0 AND lon BETWEEN -74.3 AND -73.7""",
)
q(
    "month_manifest",
    ["trip_base_y", "trip_base_g"],
    """
    WITH months AS (SELECT strftime(m, '%Y-%m') AS month
                    FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-12-01', INTERVAL 1 MONTH) t(m)),
    expected AS (SELECT p.prefix, months.month, p.prefix || months.month || '.parquet' AS file_name
                 FROM months, (VALUES ('yellow_tripdata_'), ('green_tripdata_')) p(prefix)),
    present AS (SELECT DISTINCT 'yellow_tripdata_' || strftime(pu_ts, '%Y-%m') || '.parquet' AS file_name FROM trip_base_y
                UNION
                SELECT DISTINCT 'green_tripdata_' || strftime(pu_ts, '%Y-%m') || '.parquet' FROM trip_base_g
                WHERE l_orderkey % 997 <> 0)
    SELECT e.prefix, e.month, e.file_name, (p.file_name IS NOT NULL) AS present
    FROM expected e LEFT JOIN present p ON e.file_name = p.file_name""",
)
q(
    "locations_in_box",
    ["box"],
    "SELECT id AS location_id, name AS location_name, lat AS latitude, lon AS longitude, n_sensors FROM box",
)
q(
    "locations_flat",
    ["box"],
    """SELECT id AS location_id, coalesce(name, 'Unknown') AS location_name, lat AS latitude, lon AS longitude,
           coalesce(timezone, 'UTC') AS timezone, coalesce(is_mobile, false) AS is_mobile,
           coalesce(etype, 'Unknown') AS entity_type
    FROM box""",
)
q(
    "measurements_flat",
    ["box"],
    """
    WITH o AS (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS pid,
                      CASE WHEN o_orderkey % 101 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END AS utc
               FROM orders)
    SELECT substr(utc, 1, 10) AS date, utc AS datetime_utc, b.id AS location_id, coalesce(b.name, 'Unknown') AS location_name,
           b.lat AS latitude, b.lon AS longitude, o.o_custkey * 10 + o.pid AS sensor_id, o.pid AS parameter_id,
           list_extract(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], CAST(o.pid AS INTEGER)) AS parameter_name,
           CASE WHEN o.pid <= 2 THEN 'ug/m3' ELSE 'ppm' END AS parameter_units,
           CASE WHEN o.o_orderstatus <> 'P' THEN CAST(floor(o.o_totalprice / 10000) AS DOUBLE) - 2 END AS value,
           coalesce(b.timezone, 'UTC') AS timezone
    FROM o JOIN box b ON o.o_custkey = b.id
    WHERE b.n_sensors > 0""",
)
q(
    "gdp_json",
    ["silver_gdp"],
    "SELECT country_code AS countryiso3code, CAST(year AS VARCHAR) AS date, gdp_usd AS value FROM silver_gdp",
)
q(
    "zone_csv",
    ["dim_zone"],
    "SELECT zone_id AS LocationID, borough AS Borough, zone_name AS Zone, service_zone FROM dim_zone",
)
q(
    "fx_csv",
    ["silver_fx"],
    """SELECT DISTINCT date, CASE WHEN fx_day <> 13 THEN usd_eur_rate END AS usd_eur_rate, currency_from, currency_to,
           fx_year, fx_month, fx_day FROM silver_fx""",
)
q("files_drift", ["silver_trips"], "SELECT * FROM silver_trips")
q(
    "sink_roundtrip",
    ["fact_taxi", "fact_air", "dim_date", "dim_zone", "dim_fx", "dim_gdp"],
    """SELECT 'FactTaxiDaily' AS table_name, count(*) AS row_count FROM fact_taxi
    UNION ALL SELECT 'FactAirQualityDaily', count(*) FROM fact_air
    UNION ALL SELECT 'DimDate', count(*) FROM dim_date
    UNION ALL SELECT 'DimZone', 2 * count(*) FROM dim_zone
    UNION ALL SELECT 'DimFX', count(*) FROM dim_fx
    UNION ALL SELECT 'DimGDP', count(*) FROM dim_gdp
    UNION ALL SELECT 'GDP_mapped', count(*) FROM dim_gdp""",
)
q(
    "measurements_by_year",
    ["silver_measurements"],
    "SELECT measurement_year, count(*) AS row_count FROM silver_measurements GROUP BY measurement_year ORDER BY measurement_year",
)
cte(
    "event_trips",
    [],
    """
    SELECT ts, CAST(event_id % 5 AS BIGINT) AS pu, CAST(user_id % 5 AS BIGINT) AS dropoff_zone,
           CASE WHEN event_id % 4 <> 0 THEN event_id % 4 ELSE 1 END AS passengers,
           CASE WHEN event_id % 499 = 0 THEN 501.0 ELSE CAST(round(value * 100) AS BIGINT) / 100000.0 END AS distance,
           (CAST(round(value * 100) AS BIGINT) - 500) / 100.0 AS fare, (CAST(round(value * 100) AS BIGINT) % 1000) / 1000.0 AS tip,
           (CAST(round(value * 100) AS BIGINT) * 10 - 4667) / 1000.0 AS total, round((45 * (event_id % 300) - 60) / 60.0, 2) AS minutes
    FROM events""",
)
q(
    "fact_events_daily",
    ["event_trips"],
    f"""
    SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_key,
           pu AS pickup_zone_id, dropoff_zone AS dropoff_zone_id, 'yellow' AS taxi_type,
           CAST(count(*) AS INTEGER) AS trip_count, CAST(sum(passengers) AS BIGINT) AS total_passengers,
           {plain_sum("distance", 2)} AS total_distance, {plain_sum("fare", 2)} AS total_fare,
           {plain_sum("tip", 2)} AS total_tips, {plain_sum("total", 2)} AS total_revenue, {exact_avg("minutes", 2, 2)} AS avg_trip_duration
    FROM event_trips
    WHERE ts >= TIMESTAMP '2015-01-01' AND ts < TIMESTAMP '2025-01-01' AND fare >= 0 AND total >= 0
      AND distance BETWEEN 0 AND 500 AND minutes > 0 AND minutes <= 180
    GROUP BY ALL""",
)
q(
    "files_rejected",
    ["trip_base_y"],
    """
    SELECT 'current' AS landing, 'accepted' AS status, count(*) AS n_rows FROM trip_base_y
    UNION ALL SELECT 'mistyped', 'rejected', 0
    UNION ALL SELECT 'incomplete', 'rejected', 0
    UNION ALL SELECT 'corrupt', 'rejected', 0
    UNION ALL SELECT 'damaged', 'rejected', 0""",
)
q(
    "sql_monthly_fares",
    ["fact_taxi"],
    """SELECT taxi_type, year, month, CAST(sum(trip_count) AS BIGINT) AS trips, CAST(sum(CAST(total_fare AS DECIMAL(28, 2))) AS DOUBLE) AS fares
    FROM fact_taxi GROUP BY taxi_type, year, month""",
)
q(
    "reject_counts_written",
    ["trips_std", "silver_trips"],
    f"""
    WITH c AS ({SQL["reject_counts"]})
    SELECT taxi_type, metric, CAST(n AS BIGINT) AS n FROM (UNPIVOT c ON COLUMNS(* EXCLUDE (taxi_type)) INTO NAME metric VALUE n)
    UNION ALL
    SELECT t.taxi_type, 'rows_' || y, count(s.taxi_type)
    FROM (VALUES ('yellow'), ('green')) t(taxi_type) CROSS JOIN generate_series(1996, 2000) g(y)
    LEFT JOIN silver_trips s ON s.taxi_type = t.taxi_type AND s.pickup_year = y GROUP BY ALL""",
)
q(
    "rejects_by_reason",
    ["dim_zone", "silver_gdp"],
    """
    SELECT 'zones' AS source, CASE zone_id % 5 WHEN 1 THEN '3 fields instead of 4' WHEN 2 THEN '5 fields instead of 4'
           WHEN 3 THEN 'a value of another type' ELSE 'accepted' END AS reason, count(*) AS n FROM dim_zone GROUP BY ALL
    UNION ALL
    SELECT 'rates', CASE day(o_orderdate) WHEN 5 THEN 'a value of another type' WHEN 6 THEN '31 fields instead of 32' ELSE 'accepted' END, count(*) FROM orders GROUP BY ALL
    UNION ALL
    SELECT 'readings', CASE WHEN o_orderkey % 97 = 0 THEN 'not JSON' WHEN o_orderkey % 89 = 0 THEN 'a value of another type' ELSE 'accepted' END, count(*) FROM orders GROUP BY ALL
    UNION ALL
    SELECT 'locations', 'accepted', count(*) FROM customer WHERE c_custkey // 1000 % 2 = 0 HAVING count(*) > 0
    UNION ALL
    SELECT 'locations', 'not JSON', count(DISTINCT c_custkey // 1000) FROM customer WHERE c_custkey // 1000 % 2 = 1 HAVING count(*) > 0
    UNION ALL
    SELECT 'gdp', CASE right(country_code, 1) WHEN '3' THEN 'not JSON' WHEN '7' THEN 'no records' ELSE 'accepted' END,
           CASE WHEN any_value(right(country_code, 1)) IN ('3', '7') THEN count(DISTINCT country_code) ELSE count(*) END FROM silver_gdp GROUP BY 2""",
)
GOLD_CTES = {"FactTaxiDaily": "fact_taxi", "FactAirQualityDaily": "fact_air", "DimDate": "dim_date", "DimZone": "dim_zone", "DimFX": "dim_fx", "DimGDP": "dim_gdp"}
q("gold_tables", list(GOLD_CTES.values()), " UNION ALL BY NAME ".join(f"SELECT '{name}' AS table_name, * FROM {c}" for name, c in GOLD_CTES.items()))
q(
    "guarded_writes",
    ["silver_gdp"],
    """
    SELECT t.no, t.step, t.outcome, CASE WHEN t.times > 0 THEN t.times * (SELECT count(*) FROM silver_gdp) END AS row_count
    FROM (VALUES (1, 'strict overwrite of no table', 'done', 1), (2, 'strict overwrite, same columns', 'done', 1),
          (3, 'strict overwrite, other columns', 'refused', 1), (4, 'append, same columns', 'done', 2),
          (5, 'append, other columns', 'refused', 2), (6, 'overwrite that dies', 'died', 2),
          (7, 'overwrite with itself, each row once', 'done', 1), (8, 'overwrite, other columns', 'done', 1),
          (9, 'drop', 'done', 0), (10, 'drop of no table', 'done', 0)) AS t(no, step, outcome, times)""",
)
q(
    "partitioned_fact",
    ["fact_taxi"],
    """SELECT year, month, taxi_type, CAST(sum(trip_count) AS BIGINT) AS trip_count, CAST(sum(total_passengers) AS BIGINT) AS total_passengers
    FROM fact_taxi WHERE month BETWEEN 4 AND 6 GROUP BY year, month, taxi_type""",
)
# landed files hold the same rows as the parsed text
for _file, _text in (("zone_csv_file", "zone_csv"), ("fx_csv_file", "fx_csv"), ("gdp_json_file", "gdp_json"), ("locations_file", "locations_flat")):
    SQL[_file] = SQL[_text]
SQL["measurements_file"] = f"SELECT * FROM ({SQL['measurements_flat']}) WHERE date BETWEEN '1996-01-01' AND '1997-12-31'"

"""DuckDB statements computing each registered query independently.

Written from the model definitions, not from the Spark code: every
statement re-derives the flight rows from ``lineitem`` with its own CTEs,
so a mistake in one engine's text cannot hide in both. Counts are cast to
BIGINT (DuckDB's ``count_if`` and ``sum`` of BIGINT widen to HUGEINT), date
parts to the Spark types.
"""

from __future__ import annotations

# Fixed values, written here once more rather than imported: a wrong label, code or
# parameter on the Spark side must not be able to match itself.
_CARRIER_CODES = """['AA', 'AS', 'B6', 'DL', 'F9', 'G4', 'HA', 'NK', 'OH', 'OO',
              'QX', 'UA', 'WN', 'YV', 'YX', '9E', 'MQ', 'ZZ', 'XX']"""
_AIRPORTS = "['LAX', 'JFK', 'ORD', 'ATL', 'DFW', 'SEA', 'DEN']"
_CANCEL = "['A', 'B', 'C', 'D']"
_NULL_KEY = "'_dbt_utils_surrogate_key_null_'"
_DIM_VALUES = """('AA', 'American Airlines'),
        ('AS', 'Alaska Airlines'),
        ('B6', 'JetBlue Airways'),
        ('DL', 'Delta Air Lines'),
        ('F9', 'Frontier Airlines'),
        ('G4', 'Allegiant Air'),
        ('HA', 'Hawaiian Airlines'),
        ('NK', 'Spirit Airlines'),
        ('OH', 'PSA Airlines'),
        ('OO', 'SkyWest Airlines'),
        ('QX', 'Horizon Air'),
        ('UA', 'United Airlines'),
        ('WN', 'Southwest Airlines'),
        ('YV', 'Mesa Airlines'),
        ('YX', 'Republic Airways'),
        ('9E', 'Endeavor Air'),
        ('MQ', 'Envoy Air')"""
_BUCKETS = "'On time', 'Minor (1-15 min)', 'Moderate (16-60 min)', 'Severe (1-3 hrs)', 'Extreme (>3 hrs)'"
_RUN_DATE = "2001-06-05"
_PAST_AS_OF = "2001-06-01"
_RANGE = "fl_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND carrier_code = 'AA' "

RAW_CTE = f"""
li AS (
    SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln,
           l_returnflag AS rf, l_shipdate AS sd
    FROM lineitem
),
raw AS (
    SELECT
        CASE WHEN ok % 1009 = 7 THEN CAST(year(sd) AS VARCHAR) || '-13-40'
             ELSE strftime(CAST(sd AS DATE), '%Y-%m-%d') END                          AS FlightDate,
        CASE WHEN sk % 41 = 40 THEN NULL
             ELSE {_CARRIER_CODES}[CAST(sk % 19 AS INTEGER) + 1] END                  AS Reporting_Airline,
        CASE WHEN pk % 13 = 0 THEN CAST(CAST(pk % 900 + 100 AS DOUBLE) AS VARCHAR)
             ELSE CAST(pk % 900 + 100 AS VARCHAR) END                                 AS Flight_Number_Reporting_Airline,
        CASE WHEN ok % 211 = 0 THEN NULL
             ELSE {_AIRPORTS}[CAST(ok % 7 AS INTEGER) + 1] END                        AS Origin,
        {_AIRPORTS}[CAST((pk + ln) % 7 AS INTEGER) + 1]                               AS Dest,
        CASE WHEN ok % 29 = 0 THEN NULL
             WHEN ok % 31 = 5 THEN 'n/a'
             ELSE CAST(CAST((ok * 5 + ln * 17) % 90 - 20 AS DOUBLE) AS VARCHAR) END   AS DepDelay,
        CASE WHEN ok % 23 = 0 THEN NULL
             WHEN ok % 499 = 1 THEN '2000.0'
             ELSE CAST(CAST((ok * 7 + ln * 31 + pk * 13) % 260 - 40 AS DOUBLE) AS VARCHAR) END AS ArrDelay,
        CASE WHEN rf = 'R' AND ok % 11 = 0 THEN '1.0' ELSE '0.0' END                 AS Cancelled,
        CASE WHEN rf = 'R' AND ok % 11 = 0
             THEN {_CANCEL}[CAST(ok % 4 AS INTEGER) + 1] END                          AS CancellationCode,
        CASE WHEN ok % 3 = 0 THEN NULL ELSE CAST(CAST(ok % 37 AS DOUBLE) AS VARCHAR) END AS CarrierDelay,
        CASE WHEN ok % 3 = 0 THEN NULL ELSE CAST(CAST(pk % 31 AS DOUBLE) AS VARCHAR) END AS WeatherDelay,
        CASE WHEN ok % 3 = 0 THEN NULL ELSE CAST(CAST(sk % 29 AS DOUBLE) AS VARCHAR) END AS NASDelay,
        CASE WHEN ok % 3 = 0 THEN NULL ELSE CAST(CAST((ok + pk) % 17 AS DOUBLE) AS VARCHAR) END AS SecurityDelay,
        CASE WHEN ok % 3 = 0 THEN NULL ELSE CAST(CAST((pk + ln) % 35 AS DOUBLE) AS VARCHAR) END AS LateAircraftDelay,
        CAST(CAST(60 + pk % 300 AS DOUBLE) AS VARCHAR)                                AS ActualElapsedTime,
        CAST(CAST(100 + pk % 1900 AS DOUBLE) AS VARCHAR)                              AS Distance,
        lpad(CAST((ok % 24) * 100 + pk % 60 AS VARCHAR), 4, '0')                      AS DepTime,
        lpad(CAST(((ok + 3) % 24) * 100 + (pk + 17) % 60 AS VARCHAR), 4, '0')         AS ArrTime
    FROM li
)"""

TYPED_CTE = """
typed AS (
    SELECT
        CAST(TRY_STRPTIME(FlightDate, '%Y-%m-%d') AS DATE)                     AS fl_date,
        Reporting_Airline                                                      AS mkt_carrier,
        TRY_CAST(trunc(TRY_CAST(Flight_Number_Reporting_Airline AS DOUBLE)) AS INTEGER) AS mkt_carrier_fl_num,
        Origin AS origin,
        Dest AS dest,
        DepTime AS dep_time,
        ArrTime AS arr_time,
        CancellationCode AS cancellation_code,
        TRY_CAST(DepDelay AS FLOAT)          AS dep_delay,
        TRY_CAST(ArrDelay AS FLOAT)          AS arr_delay,
        TRY_CAST(Cancelled AS FLOAT)         AS cancelled,
        TRY_CAST(CarrierDelay AS FLOAT)      AS carrier_delay,
        TRY_CAST(WeatherDelay AS FLOAT)      AS weather_delay,
        TRY_CAST(NASDelay AS FLOAT)          AS nas_delay,
        TRY_CAST(SecurityDelay AS FLOAT)     AS security_delay,
        TRY_CAST(LateAircraftDelay AS FLOAT) AS late_aircraft_delay,
        TRY_CAST(ActualElapsedTime AS FLOAT) AS actual_elapsed_time,
        TRY_CAST(Distance AS FLOAT)          AS distance
    FROM raw
)"""

CLEAN_CTE = """
complete AS (
    SELECT *,
           greatest(coalesce(carrier_delay, 0), coalesce(weather_delay, 0), coalesce(nas_delay, 0),
                    coalesce(security_delay, 0), coalesce(late_aircraft_delay, 0)) AS top_cause
    FROM typed
    WHERE fl_date IS NOT NULL AND origin IS NOT NULL AND dest IS NOT NULL AND mkt_carrier IS NOT NULL
),
clean AS (
    SELECT fl_date, mkt_carrier, mkt_carrier_fl_num, origin, dest, dep_time, arr_time, cancellation_code,
           dep_delay, arr_delay, cancelled, carrier_delay, weather_delay, nas_delay, security_delay,
           late_aircraft_delay, actual_elapsed_time, distance,
           coalesce(CAST(arr_delay AS DOUBLE), 0.0) AS total_delay,
           coalesce(arr_delay > 15, false) AS is_delayed,
           CASE WHEN arr_delay <= 0 THEN 'On time'
                WHEN arr_delay <= 15 THEN 'Minor (1-15 min)'
                WHEN arr_delay <= 60 THEN 'Moderate (16-60 min)'
                WHEN arr_delay <= 180 THEN 'Severe (1-3 hrs)'
                ELSE 'Extreme (>3 hrs)' END AS delay_bucket,
           CASE WHEN carrier_delay = top_cause THEN 'Carrier'
                WHEN weather_delay = top_cause THEN 'Weather'
                WHEN nas_delay = top_cause THEN 'NAS'
                WHEN late_aircraft_delay = top_cause THEN 'Late Aircraft'
                ELSE 'Unknown' END AS primary_delay_cause,
           CAST(year(fl_date) AS INTEGER) AS year,
           CAST(month(fl_date) AS INTEGER) AS month
    FROM complete
)"""

RENAMED_CTE = f"""
renamed AS (
    SELECT
        md5(coalesce(CAST(fl_date AS VARCHAR), {_NULL_KEY}) || '-' ||
            coalesce(mkt_carrier, {_NULL_KEY}) || '-' ||
            coalesce(CAST(mkt_carrier_fl_num AS VARCHAR), {_NULL_KEY}) || '-' ||
            coalesce(origin, {_NULL_KEY}) || '-' ||
            coalesce(dest, {_NULL_KEY}))             AS flight_id,
        fl_date,
        mkt_carrier AS carrier_code,
        mkt_carrier_fl_num AS flight_number,
        origin AS origin_airport,
        dest AS dest_airport,
        dep_delay, arr_delay, carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay,
        actual_elapsed_time, distance,
        total_delay, is_delayed, delay_bucket, primary_delay_cause,
        CAST(year AS BIGINT) AS flight_year,
        CAST(month AS BIGINT) AS flight_month,
        CAST(cancelled AS DOUBLE) AS cancelled,
        cancellation_code
    FROM clean
)"""

STG_CTE = """
stg AS (
    SELECT * FROM renamed
    WHERE (cancelled IS NULL OR cancelled = 0)
      AND fl_date < current_date
      AND (arr_delay IS NULL OR abs(arr_delay) <= 1440)
      AND (dep_delay IS NULL OR abs(dep_delay) <= 1440)
)"""

DIM_CTE = f"""
dim AS (
    SELECT * FROM (VALUES
        {_DIM_VALUES}
    ) AS t(carrier_code, carrier_name)
)"""

FCT_CTE = """
fct AS (
    SELECT s.flight_id, s.fl_date, s.flight_year, s.flight_month,
           strftime(s.fl_date, '%Y-%m') AS year_month,
           s.carrier_code,
           coalesce(d.carrier_name, s.carrier_code) AS carrier_name,
           s.origin_airport, s.dest_airport,
           concat(s.origin_airport, ' → ', s.dest_airport) AS route,
           s.distance, s.dep_delay, s.arr_delay, s.carrier_delay, s.weather_delay, s.nas_delay,
           s.security_delay, s.late_aircraft_delay, s.total_delay, s.is_delayed, s.delay_bucket,
           s.primary_delay_cause, s.actual_elapsed_time
    FROM stg s LEFT JOIN dim d ON s.carrier_code = d.carrier_code
)"""

RC_CTE = """
rc AS (
    SELECT carrier_code, carrier_name,
           count(*) AS total_flights,
           count(CASE WHEN is_delayed THEN 1 END) AS delayed_flights,
           round(count(CASE WHEN is_delayed THEN 1 END) / count(*) * 100, 2) AS delay_pct,
           round(avg(arr_delay), 2) AS avg_arr_delay_min,
           round(avg(dep_delay), 2) AS avg_dep_delay_min,
           round(avg(CASE WHEN is_delayed THEN arr_delay END), 2) AS avg_delay_when_delayed,
           round(avg(carrier_delay), 2) AS avg_carrier_delay,
           round(avg(weather_delay), 2) AS avg_weather_delay,
           round(avg(nas_delay), 2) AS avg_nas_delay,
           round(avg(late_aircraft_delay), 2) AS avg_late_aircraft_delay,
           round(avg(distance), 1) AS avg_distance_miles,
           min(fl_date) AS earliest_date,
           max(fl_date) AS latest_date
    FROM fct
    GROUP BY carrier_code, carrier_name
)"""

RT_CTE = """
rt AS (
    SELECT year_month, flight_year, flight_month,
           make_date(flight_year, flight_month, 1) AS month_start_date,
           count(*) AS total_flights,
           count(CASE WHEN is_delayed THEN 1 END) AS delayed_flights,
           round(count(CASE WHEN is_delayed THEN 1 END) / count(*) * 100, 2) AS delay_pct,
           round(avg(arr_delay), 2) AS avg_arr_delay_min,
           round(avg(dep_delay), 2) AS avg_dep_delay_min,
           round(avg(coalesce(carrier_delay, 0)), 2) AS avg_carrier_delay,
           round(avg(coalesce(weather_delay, 0)), 2) AS avg_weather_delay,
           round(avg(coalesce(nas_delay, 0)), 2) AS avg_nas_delay,
           round(avg(coalesce(late_aircraft_delay, 0)), 2) AS avg_late_aircraft_delay,
           round(avg(avg(arr_delay)) OVER (ORDER BY flight_year, flight_month
                                           ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS avg_delay_3mo_rolling
    FROM fct
    GROUP BY year_month, flight_year, flight_month
)"""

_LAYERS = [
    ("raw", RAW_CTE),
    ("typed", TYPED_CTE),
    ("clean", CLEAN_CTE),
    ("renamed", RENAMED_CTE),
    ("stg", STG_CTE),
    ("dim", DIM_CTE),
    ("fct", FCT_CTE),
    ("rc", RC_CTE),
    ("rt", RT_CTE),
]


def _with(upto: str, body: str) -> str:
    """``WITH`` every layer up to and including ``upto``, then ``body``."""
    ctes = []
    for name, text in _LAYERS:
        if name == "dim" and upto in ("raw", "typed", "clean", "renamed", "stg"):
            break
        ctes.append(text.strip())
        if name == upto:
            break
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


_FATES_CTE = f""",
judged AS (
    SELECT CASE WHEN day IS NULL OR Reporting_Airline IS NULL OR Origin IS NULL OR Dest IS NULL THEN 'dropped'
                WHEN day >= CAST(date_trunc('month', DATE '{_RUN_DATE}') - INTERVAL 1 MONTH AS DATE)
                 AND day < CAST(date_trunc('month', DATE '{_RUN_DATE}') AS DATE) THEN 'accepted'
                ELSE 'unexpected' END AS fate, *
    FROM (SELECT CAST(TRY_STRPTIME(FlightDate, '%Y-%m-%d') AS DATE) AS day, * FROM raw)
)
"""


def _refused(field: str, text: str, parsed: str) -> str:
    return f"SELECT fate, 'malformed:{field}' AS reason FROM judged WHERE {text} IS NOT NULL AND {parsed} IS NULL"


_REASONS = " UNION ALL ".join(
    [
        "SELECT fate, 'missing:fl_date' AS reason FROM judged WHERE FlightDate IS NULL",
        "SELECT fate, 'missing:mkt_carrier' FROM judged WHERE Reporting_Airline IS NULL",
        "SELECT fate, 'missing:origin' FROM judged WHERE Origin IS NULL",
        "SELECT fate, 'missing:dest' FROM judged WHERE Dest IS NULL",
        _refused("fl_date", "FlightDate", "day"),
        _refused(
            "mkt_carrier_fl_num",
            "Flight_Number_Reporting_Airline",
            "TRY_CAST(trunc(TRY_CAST(Flight_Number_Reporting_Airline AS DOUBLE)) AS INTEGER)",
        ),
        *[
            _refused(field, text, f"TRY_CAST({text} AS FLOAT)")
            for field, text in [
                ("dep_delay", "DepDelay"),
                ("arr_delay", "ArrDelay"),
                ("cancelled", "Cancelled"),
                ("carrier_delay", "CarrierDelay"),
                ("weather_delay", "WeatherDelay"),
                ("nas_delay", "NASDelay"),
                ("security_delay", "SecurityDelay"),
                ("late_aircraft_delay", "LateAircraftDelay"),
                ("actual_elapsed_time", "ActualElapsedTime"),
                ("distance", "Distance"),
            ]
        ],
    ]
)

_IDENT = "fl_date, mkt_carrier, mkt_carrier_fl_num, origin, dest"
_RC_COLS = (
    "carrier_code, carrier_name, total_flights, delayed_flights, delay_pct, avg_arr_delay_min, "
    "avg_carrier_delay, avg_weather_delay, avg_nas_delay, avg_late_aircraft_delay"
)
_RT_COLS = (
    "year_month, month_start_date, total_flights, delayed_flights, delay_pct, avg_arr_delay_min, "
    "avg_carrier_delay, avg_weather_delay, avg_nas_delay, avg_late_aircraft_delay, avg_delay_3mo_rolling"
)
_TOP_N_ORDER = "ORDER BY avg_arr_delay_min DESC NULLS LAST, carrier_code LIMIT 10"
_CAUSE_UNION = """
    SELECT {id}, 'Carrier' AS cause, avg_carrier_delay AS minutes FROM {src}
    UNION ALL SELECT {id}, 'Weather', avg_weather_delay FROM {src}
    UNION ALL SELECT {id}, 'NAS', avg_nas_delay FROM {src}
    UNION ALL SELECT {id}, 'Late Aircraft', avg_late_aircraft_delay FROM {src}
"""
_YEARS = "1996, 1998, 2000"


def _check(check: str, model: str, column: str, failures: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{model}' AS model, '{column}' AS column_name, "
        f"CAST({failures} AS BIGINT) AS failures FROM {source}"
    )


def _unique(model: str, column: str, source: str) -> str:
    inner = f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    return _check("unique", model, column, "count(*)", inner)


def _not_null(model: str, column: str, source: str) -> str:
    return _check("not_null", model, column, f"count(*) FILTER (WHERE {column} IS NULL)", source)


STATEMENTS: dict[str, str] = {
    "clean_flights": _with("clean", "SELECT * FROM clean"),
    "cast_types": _with("typed", "SELECT * FROM typed"),
    "required_fields": _with(
        "typed",
        f"SELECT {_IDENT} FROM typed "
        "WHERE fl_date IS NOT NULL AND mkt_carrier IS NOT NULL AND origin IS NOT NULL AND dest IS NOT NULL",
    ),
    "total_delay": _with("clean", f"SELECT {_IDENT}, arr_delay, total_delay FROM clean"),
    "is_delayed": _with("clean", f"SELECT {_IDENT}, arr_delay, is_delayed FROM clean"),
    "delay_bucket": _with("clean", f"SELECT {_IDENT}, arr_delay, delay_bucket FROM clean"),
    "primary_delay_cause": _with(
        "clean",
        f"SELECT {_IDENT}, carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay, "
        "primary_delay_cause FROM clean",
    ),
    "date_parts": _with("clean", f"SELECT {_IDENT}, year, month FROM clean"),
    "merge_deliveries": _with(
        "clean", "SELECT *, CASE WHEN mkt_carrier < 'D' THEN 'a' ELSE 'b' END AS delivery FROM clean"
    ),
    "conform_staging": _with("clean", "SELECT * EXCLUDE (dep_time, arr_time) FROM clean"),
    "row_audit": _with(
        "typed",
        "SELECT CAST(count(*) AS BIGINT) AS raw_rows, "
        "CAST(count(*) FILTER (WHERE fl_date IS NOT NULL AND mkt_carrier IS NOT NULL "
        "AND origin IS NOT NULL AND dest IS NOT NULL) AS BIGINT) AS clean_rows FROM typed",
    ),
    "rejected_reasons": _with("raw", "")
    + _FATES_CTE
    + f"SELECT fate, reason, CAST(count(*) AS BIGINT) AS n_rows FROM ({_REASONS}) GROUP BY fate, reason",
    "row_fates": _with("raw", "") + _FATES_CTE + "SELECT fate, CAST(count(*) AS BIGINT) AS n_rows FROM judged GROUP BY fate",
    "cancelled_flights": _with(
        "clean",
        "SELECT cancellation_code, CAST(count(*) AS BIGINT) AS cancelled_flights FROM clean "
        "WHERE cancelled IS NOT NULL AND cancelled <> 0 GROUP BY cancellation_code",
    ),
    "previous_month": _with(
        "clean",
        f"SELECT {_IDENT}, arr_delay, year, month FROM clean "
        f"WHERE fl_date >= CAST(date_trunc('month', DATE '{_RUN_DATE}') - INTERVAL 1 MONTH AS DATE) "
        f"AND fl_date < CAST(date_trunc('month', DATE '{_RUN_DATE}') AS DATE)",
    ),
    "stg_flights": _with("stg", "SELECT * FROM stg"),
    "surrogate_key": _with(
        "stg", "SELECT flight_id, fl_date, carrier_code, flight_number, origin_airport, dest_airport FROM stg"
    ),
    "operated_only": _with(
        "renamed",
        "SELECT flight_id, carrier_code, cancelled, cancellation_code FROM renamed "
        "WHERE cancelled IS NULL OR cancelled = 0",
    ),
    "past_dates": _with(
        "renamed", f"SELECT flight_id, fl_date FROM renamed WHERE fl_date < DATE '{_PAST_AS_OF}'"
    ),
    "outlier_filter": _with(
        "renamed",
        "SELECT flight_id, arr_delay, dep_delay FROM renamed "
        "WHERE (arr_delay IS NULL OR abs(arr_delay) <= 1440) AND (dep_delay IS NULL OR abs(dep_delay) <= 1440)",
    ),
    "dedupe_flights": _with(
        "stg",
        """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY flight_id
        ORDER BY fl_date ASC NULLS FIRST, carrier_code ASC NULLS FIRST, flight_number ASC NULLS FIRST,
                 origin_airport ASC NULLS FIRST, dest_airport ASC NULLS FIRST, dep_delay ASC NULLS FIRST,
                 arr_delay ASC NULLS FIRST, carrier_delay ASC NULLS FIRST, weather_delay ASC NULLS FIRST,
                 nas_delay ASC NULLS FIRST, security_delay ASC NULLS FIRST,
                 late_aircraft_delay ASC NULLS FIRST, actual_elapsed_time ASC NULLS FIRST,
                 distance ASC NULLS FIRST, cancelled ASC NULLS FIRST, cancellation_code ASC NULLS FIRST,
                 total_delay ASC NULLS FIRST, is_delayed ASC NULLS FIRST, delay_bucket ASC NULLS FIRST,
                 primary_delay_cause ASC NULLS FIRST, flight_year ASC NULLS FIRST, flight_month ASC NULLS FIRST
    ) AS rn
    FROM stg
) WHERE rn = 1
""",
    ),
    "carrier_lookup": _with("fct", "SELECT flight_id, carrier_code, carrier_name FROM fct"),
    "year_month_route": _with(
        "fct", "SELECT flight_id, fl_date, year_month, origin_airport, dest_airport, route FROM fct"
    ),
    "fct_flights": _with("fct", "SELECT * FROM fct"),
    "delay_by_carrier": _with("rc", "SELECT * FROM rc ORDER BY avg_arr_delay_min DESC NULLS LAST, carrier_code"),
    "delay_trend": _with("rt", "SELECT * FROM rt ORDER BY month_start_date"),
    # The incremental path must give the same reports as the direct one.
    "delay_by_carrier_incremental": _with(
        "rc", "SELECT * FROM rc ORDER BY avg_arr_delay_min DESC NULLS LAST, carrier_code"
    ),
    "delay_trend_incremental": _with("rt", "SELECT * FROM rt ORDER BY month_start_date"),
    "report_carrier_view": _with(
        "rc", f"SELECT {_RC_COLS} FROM rc ORDER BY avg_arr_delay_min DESC NULLS LAST, carrier_code"
    ),
    "report_trend_view": _with("rt", f"SELECT {_RT_COLS} FROM rt ORDER BY month_start_date"),
    "top_n_carriers": _with("rc", f"SELECT * FROM rc {_TOP_N_ORDER}"),
    "severity_band": _with(
        "rc",
        "SELECT carrier_code, carrier_name, avg_arr_delay_min, "
        "CASE WHEN avg_arr_delay_min > 20 THEN 'high' WHEN avg_arr_delay_min > 10 THEN 'medium' "
        "ELSE 'low' END AS severity FROM rc",
    ),
    "kpis": _with(
        "rc",
        """
SELECT CAST(sum(total_flights) AS BIGINT) AS total_flights,
       CAST(sum(delayed_flights) AS BIGINT) AS delayed_flights,
       CASE WHEN sum(total_flights) > 0
            THEN CAST(sum(delayed_flights) AS BIGINT) / CAST(sum(total_flights) AS BIGINT) * 100
            ELSE 0.0 END AS delay_pct,
       CAST(sum(CAST(round(avg_arr_delay_min * 100) AS BIGINT)) AS BIGINT)
           / count(avg_arr_delay_min) / 100 AS avg_arr_delay_min,
       CAST(sum(CAST(round(avg_arr_delay_min * 100) AS BIGINT) * total_flights) AS DOUBLE)
           / CAST(sum(CASE WHEN avg_arr_delay_min IS NOT NULL THEN total_flights END) AS DOUBLE) / 100
           AS weighted_avg_arr_delay_min,
       (SELECT carrier_name FROM rc ORDER BY avg_arr_delay_min DESC NULLS LAST, carrier_code LIMIT 1)
           AS worst_carrier
FROM rc
""",
    ),
    "cause_breakdown": _with(
        "rc",
        ", top AS (SELECT * FROM rc " + _TOP_N_ORDER + ")\n"
        + _CAUSE_UNION.format(id="carrier_name", src="top"),
    ),
    "cause_trend": _with("rt", _CAUSE_UNION.format(id="month_start_date", src="rt")),
    "trend_year_filter": _with("rt", f"SELECT * FROM rt WHERE year(month_start_date) IN ({_YEARS})"),
    "trend_years": _with(
        "rt", "SELECT DISTINCT CAST(year(month_start_date) AS INTEGER) AS year FROM rt ORDER BY year"
    ),
    "range_carrier_avg": _with(
        "fct",
        f"SELECT carrier_name, avg(arr_delay) AS avg_arr_delay FROM fct "
        f"WHERE {_RANGE}"
        "GROUP BY carrier_name",
    ),
    "dq_unique": _with(
        "rt",
        "\nUNION ALL\n".join(
            [
                _unique("fct_flights", "flight_id", "fct"),
                _unique("dim_carriers", "carrier_code", "dim"),
                _unique("rpt_delay_by_carrier", "carrier_code", "rc"),
                _unique("rpt_delay_trend", "year_month", "rt"),
            ]
        ),
    ),
    "dq_unique_by_hash": _with(
        "fct",
        _unique("fct_flights", "flight_id", "fct") + "\nUNION ALL\n" + _unique("fct_flights", "route", "fct"),
    ),
    "dq_not_null": _with(
        "rt",
        "\nUNION ALL\n".join(
            [
                *[
                    _not_null("fct_flights", c, "fct")
                    for c in ["flight_id", "fl_date", "carrier_code", "origin_airport", "dest_airport"]
                ],
                _not_null("dim_carriers", "carrier_code", "dim"),
                _not_null("dim_carriers", "carrier_name", "dim"),
                _not_null("rpt_delay_by_carrier", "carrier_code", "rc"),
                _not_null("rpt_delay_by_carrier", "total_flights", "rc"),
                _not_null("rpt_delay_trend", "year_month", "rt"),
                _not_null("rpt_delay_trend", "month_start_date", "rt"),
            ]
        ),
    ),
    "dq_source_not_null": _with(
        "clean",
        "\nUNION ALL\n".join(
            _not_null("raw_flights", c, "clean") for c in ["fl_date", "mkt_carrier", "origin", "dest"]
        ),
    ),
    "dq_accepted_values": _with(
        "fct",
        "\nUNION ALL\n".join(
            [
                _check(
                    "accepted_values",
                    "fct_flights",
                    "is_delayed",
                    "count(*) FILTER (WHERE is_delayed IS NOT NULL AND is_delayed NOT IN (true, false))",
                    "fct",
                ),
                _check(
                    "accepted_values",
                    "fct_flights",
                    "delay_bucket",
                    "count(*) FILTER (WHERE delay_bucket IS NOT NULL AND delay_bucket NOT IN ("
                    + _BUCKETS
                    + "))",
                    "fct",
                ),
            ]
        ),
    ),
    "dq_expression": _with(
        "rt",
        "\nUNION ALL\n".join(
            [
                _check(
                    "expression_is_true",
                    "rpt_delay_by_carrier",
                    "delay_pct",
                    "count(*) FILTER (WHERE NOT (delay_pct >= 0 AND delay_pct <= 100))",
                    "rc",
                ),
                _check(
                    "expression_is_true",
                    "rpt_delay_trend",
                    "total_flights",
                    "count(*) FILTER (WHERE NOT (total_flights > 0))",
                    "rt",
                ),
            ]
        ),
    ),
}

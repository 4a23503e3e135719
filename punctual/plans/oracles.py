"""The named analyses once more, as plain SQL for an independent engine (DuckDB dialect).

Written from the definitions of the results, not from the Spark plans.
"""

from __future__ import annotations


def rnd(expression: str, digits: int = 2) -> str:
    """Round half away from zero on the printed decimal value, which is what Spark's ``round`` does."""
    return (
        f"CAST(round(CAST(CAST(CAST(({expression}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
    )


LEGS = """
legs AS (
  SELECT
    l_orderkey * 1000003 + l_partkey * 8191 + l_suppkey * 131 + l_linenumber * 17 + CAST(l_quantity AS BIGINT) AS leg_id,
    CAST(l_shipdate AS DATE) AS leg_date,
    CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(day(l_shipdate) AS INTEGER) AS day_of_month,
    CAST(isodow(l_shipdate) AS INTEGER) AS day_of_week,
    CAST((l_partkey % 24) * 100 + l_suppkey % 60 AS INTEGER) AS dep_hhmm,
    CAST(((l_partkey + 2) % 24) * 100 + l_suppkey % 60 AS INTEGER) AS arr_hhmm,
    lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || '00-' || lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || '59' AS time_block,
    date_trunc('day', l_shipdate) + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60) AS dep_time,
    date_trunc('day', l_shipdate) + to_hours((l_partkey + 2) % 24) + to_minutes(l_suppkey % 60) AS arr_time,
    l_quantity - 20 AS dep_delay,
    l_quantity - 25 AS arr_delay,
    greatest(l_quantity - 20, 0.0) AS dep_delay_minutes,
    greatest(l_quantity - 25, 0.0) AS arr_delay_minutes,
    CASE WHEN l_quantity >= 40 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS arr_del15,
    CAST(l_linenumber * 10 + 60 AS DOUBLE) AS elapsed,
    CASE WHEN l_quantity >= 40 THEN round(l_discount * 100) + 0.0 END AS weather_delay,
    CASE WHEN l_quantity >= 40 THEN round(l_tax * 100) + 0.0 END AS carrier_delay,
    CASE WHEN l_quantity >= 40 THEN CAST(l_linenumber AS DOUBLE) END AS nas_delay,
    CASE WHEN l_quantity >= 40 THEN CAST(l_linenumber % 2 AS DOUBLE) END AS security_delay,
    CASE WHEN l_quantity >= 40 THEN CAST(p_size % 5 AS DOUBLE) END AS late_aircraft_delay,
    CAST(l_returnflag = 'R' AS INTEGER) AS diverted,
    CAST(o_orderstatus = 'P' AS INTEGER) AS cancelled,
    CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN l_quantity >= 35 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS dep_del15,
    o_orderpriority AS carrier,
    c_mktsegment AS operator,
    dn.n_name AS dest_city,
    orn.n_name AS origin_city,
    c_nationkey AS dest_key,
    s_nationkey AS origin_key,
    CASE WHEN p_size % 10 <> 0 THEN p_size % 30 END AS origin_wind_speed,
    CASE WHEN p_size % 10 <> 0 THEN (p_size * 7) % 30 END AS dest_wind_speed,
    CASE WHEN p_size % 10 <> 0 THEN (p_size * 10) % 360 END AS origin_wind_direction,
    CASE WHEN p_size % 10 <> 0 THEN (p_size * 70) % 360 END AS dest_wind_direction,
    CASE WHEN p_size % 4 = 0 THEN p_size % 30 + 10 END AS origin_wind_gusts,
    CASE WHEN p_size % 4 = 1 THEN (p_size * 7) % 30 + 10 END AS dest_wind_gusts,
    CASE WHEN p_size % 7 <> 0 THEN CAST(p_size % 12 AS DOUBLE) END AS origin_visibility,
    CASE WHEN p_size % 7 <> 1 THEN CAST((p_size * 5) % 12 AS DOUBLE) END AS dest_visibility,
    CAST(p_size % 41 - 10 AS DOUBLE) AS origin_temperature,
    CAST((p_size * 3) % 41 - 10 AS DOUBLE) AS dest_temperature,
    CAST(p_size % 41 - 13 AS DOUBLE) AS origin_dew_point,
    CAST((p_size * 3) % 41 - 13 AS DOUBLE) AS dest_dew_point,
    CASE p_type WHEN 'PROMO' THEN CAST([] AS VARCHAR[]) WHEN 'LARGE' THEN NULL ELSE string_split(p_name, ' ') END AS origin_clouds,
    CASE p_type WHEN 'PROMO' THEN CAST([] AS VARCHAR[]) WHEN 'LARGE' THEN NULL ELSE list_reverse(string_split(p_name, ' ')) END AS dest_clouds,
    CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 3 = 0 THEN CAST([] AS VARCHAR[]) ELSE [p_type] END AS origin_precipitation,
    CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 3 = 0 THEN CAST([] AS VARCHAR[]) ELSE [p_type] END AS dest_precipitation
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation dn ON c_nationkey = dn.n_nationkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation orn ON s_nationkey = orn.n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
)
"""

AIRLINE = (
    "CASE carrier WHEN '1-URGENT' THEN 'Urgent Air' WHEN '2-HIGH' THEN 'High Air' "
    "WHEN '3-MEDIUM' THEN 'Medium Air' ELSE carrier END"
)
DELAYED_PCT = "(CAST(sum(CASE WHEN arr_del15 = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)) * 100"
WEATHER_PCT = "(CAST(sum(CASE WHEN weather_delay > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)) * 100"
DELAYED = "CAST(sum(CASE WHEN arr_del15 = 1 THEN 1 ELSE 0 END) AS BIGINT)"
TOUCHING = "(contains(origin_city, '_1') OR contains(dest_city, '_1'))"
ONE = "origin_city = 'NATION_7'"


def _legs(body: str) -> str:
    return f"WITH {LEGS} {body}"


def _label(column: str, separator: str) -> str:
    return f"CASE WHEN len({column}) = 0 THEN 'None' ELSE array_to_string({column}, '{separator}') END"


def _combination(role: str) -> str:
    plain = [
        f"{role}_{c}"
        for c in ("wind_direction", "wind_speed", "wind_gusts", "visibility", "temperature", "dew_point")
    ]
    lists = [f"{role}_{c}" for c in ("precipitation", "clouds")]
    shown = ", ".join([*plain, *[f"{_label(c, ',')} AS {c}" for c in lists]])
    return _legs(
        f"""SELECT {shown}, avg(weather_delay) AS avg_weather_delay, count(*) AS num_weather_delays
        FROM legs WHERE weather_delay > 0 GROUP BY {', '.join([*plain, *lists])}"""
    )


def _bucket(case: str, name: str) -> str:
    return _legs(
        f"""SELECT {case} AS {name}, count(*) AS num_legs, {rnd('avg(weather_delay)')} AS avg_weather_delay,
        {rnd(WEATHER_PCT)} AS weather_delay_pct FROM legs GROUP BY 1"""
    )


def _knots(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 'Unknown' WHEN {column} < 5 THEN '<5 kt' WHEN {column} < 10 THEN '5-10 kt' "
        f"WHEN {column} < 15 THEN '10-15 kt' ELSE '15+ kt' END"
    )


MEASURES = (
    "dep_hhmm", "arr_hhmm", "dep_delay", "dep_delay_minutes", "arr_delay", "arr_delay_minutes", "elapsed",
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
)
_KINDS = {
    "bigint": "leg_id",
    "date": "leg_date",
    "int": "year month day_of_month day_of_week dep_hhmm arr_hhmm diverted cancelled dest_key origin_key origin_wind_speed "
    "dest_wind_speed origin_wind_direction dest_wind_direction origin_wind_gusts dest_wind_gusts",
    "string": "time_block carrier operator dest_city origin_city",
    "timestamp_ntz": "dep_time arr_time",
    "double": "dep_delay arr_delay dep_delay_minutes arr_delay_minutes arr_del15 elapsed weather_delay carrier_delay "
    "nas_delay security_delay dep_del15 late_aircraft_delay origin_visibility dest_visibility origin_temperature "
    "dest_temperature origin_dew_point dest_dew_point",
    "array<string>": "origin_clouds dest_clouds origin_precipitation dest_precipitation",
}
PROFILED = {column: kind for kind, columns in _KINDS.items() for column in columns.split()}
FEATURE_NUMBERS = (
    "year", "month", "day_of_month", "day_of_week", "origin_wind_direction", "origin_wind_speed",
    "origin_visibility", "dest_wind_direction", "dest_wind_speed", "dest_visibility",
)


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _correlations() -> str:
    cells = []
    for x in MEASURES:
        for y in MEASURES:
            value = f"corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))"
            value = f"CASE WHEN isnan({value}) THEN NULL ELSE {rnd(value, 6)} END"
            cells.append(f"SELECT '{x}' AS x, '{y}' AS y, {value} AS corr FROM one")
    return _legs(f", one AS MATERIALIZED (SELECT {', '.join(MEASURES)} FROM legs WHERE {ONE}) {_union(cells)}")


def _extreme(function: str, column: str, kind: str) -> str:
    return "CAST(NULL AS VARCHAR)" if kind.startswith("array") else f"CAST({function}({column}) AS VARCHAR)"


FRAMES = """
frames AS (
  SELECT station, role, window_start, window_start + INTERVAL 60 DAY AS window_end,
         min(dep_time) AS start_date, max(dep_time) AS end_date, count(*) AS records
  FROM (
    SELECT origin_city AS station, 'Origin' AS role, dep_time,
           time_bucket(INTERVAL 60 DAY, dep_time, TIMESTAMP '1970-01-01') AS window_start FROM legs
    UNION ALL
    SELECT dest_city, 'Destination', dep_time,
           time_bucket(INTERVAL 60 DAY, dep_time, TIMESTAMP '1970-01-01') FROM legs
  ) GROUP BY station, role, window_start
)
"""
SECONDS = "'%Y-%m-%d %H:%M:%S'"
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"

SIDES = """
WITH l AS (SELECT event_id, user_id AS station, ts AS leg_time FROM events WHERE event_type = 'purchase'),
     o AS (SELECT user_id AS station, ts AS obs_time, value FROM events WHERE event_type = 'view')
"""


def _asof(keep: str = "TRUE") -> str:
    return f"""{SIDES}, j AS (
      SELECT l.*, CASE WHEN {keep} THEN o.obs_time END AS obs_time, CASE WHEN {keep} THEN o.value END AS obs_value
      FROM l ASOF LEFT JOIN o ON l.station = o.station AND l.leg_time >= o.obs_time)
    SELECT event_id, station, strftime(leg_time, {MICROS}) AS leg_time, strftime(obs_time, {MICROS}) AS obs_time,
           obs_value FROM j"""


ROLLING = [("15 minutes", "15 MINUTE", None), ("1 hour", "1 HOUR", None), ("1 day", "1 DAY", None)]


def _rolling() -> str:
    parts = [
        f"""SELECT event_type, '{name}' AS width,
        strftime(time_bucket(INTERVAL {interval}, ts, TIMESTAMP '1970-01-01'), {SECONDS}) AS window_start,
        count(*) AS num_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM events GROUP BY 1, 3"""
        for name, interval, _ in ROLLING
    ]
    parts.append(
        f"""SELECT event_type, '1 hour / 15 minutes' AS width, strftime(slot - k * INTERVAL 15 MINUTE, {SECONDS}),
        count(*), CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
        FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS slot FROM events),
             (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY 1, 3"""
    )
    return _union(parts)


SPLIT_BUCKET = "CAST('0x' || substr(md5('42:' || CAST(leg_id AS VARCHAR)), 1, 7) AS BIGINT) % 100"


def _hashed_features(width: int) -> str:
    categories = ["carrier", "operator", "origin_city", "dest_city"]
    lists = ["origin_precipitation", "origin_clouds", "dest_precipitation", "dest_clouds"]
    tokens = [f"SELECT leg_id, '{c}=' || coalesce({c}, 'None') AS token FROM legs" for c in categories]
    tokens += [f"SELECT leg_id, '{c}=' || unnest(string_split(coalesce({_label(c, ',')}, 'None'), ',')) FROM legs" for c in lists]
    return _legs(
        f""", t AS ({' UNION ALL '.join(tokens)}),
        s AS (SELECT leg_id, CAST('0x' || substr(md5(token), 1, 7) AS BIGINT) % {width} AS slot, count(*) AS n FROM t GROUP BY 1, 2)
        SELECT leg_id, string_agg(slot || ':' || n, ',' ORDER BY slot) AS slots FROM s GROUP BY 1"""
    )


def _feature_table() -> str:
    numbers = [*FEATURE_NUMBERS, "DepHour", "ArrHour", "DepMinute", "ArrMinute", "is_weekend"]
    categories = ["carrier", "operator", "origin_city", "dest_city"]
    lists = ["origin_precipitation", "origin_clouds", "dest_precipitation", "dest_clouds"]
    labels = ", ".join(f"coalesce({_label(c, ',')}, 'None') AS {c}" for c in lists)
    plain = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_NUMBERS)
    medians = ", ".join(f"coalesce(median({c}), 0.0) AS m_{c}" for c in numbers)
    filled = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in numbers)
    return _legs(
        f""", raw AS (
          SELECT leg_id, strftime(leg_date, '%Y-%m-%d') AS leg_day, {', '.join(categories)}, {labels}, {plain},
            CAST(dep_hhmm // 100 AS DOUBLE) AS DepHour, CAST(arr_hhmm // 100 AS DOUBLE) AS ArrHour,
            CAST(dep_hhmm % 100 AS DOUBLE) AS DepMinute, CAST(arr_hhmm % 100 AS DOUBLE) AS ArrMinute,
            CASE WHEN day_of_week IN (6, 7) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
            CAST(dep_hhmm // 100 * 60 + dep_hhmm % 100 AS INTEGER) AS dep_minute_of_day,
            CAST(dep_del15 AS INTEGER) AS label
          FROM legs),
        m AS (SELECT {medians} FROM raw WHERE label IS NOT NULL AND {SPLIT_BUCKET} < 80)
        SELECT leg_id, leg_day, {', '.join(categories)}, {', '.join(lists)}, {filled}, dep_minute_of_day, label
        FROM raw, m"""
    )


RULE = """, r AS (
  SELECT carrier, leg_date, CAST(dep_hhmm // 100 AS INTEGER) AS dep_hour, CAST(dep_del15 AS INTEGER) AS label,
         CASE WHEN dep_hhmm >= 1200 THEN 1 ELSE 0 END AS prediction
  FROM legs WHERE dep_del15 IS NOT NULL)"""


def _metrics(week: str = "") -> str:
    """Accuracy and the two classes' scores from the four cell counts."""
    group = "GROUP BY week" if week else ""
    picked = f"strftime(week, {SECONDS}) AS week, " if week else ""
    return f"""{RULE}, c AS (SELECT {week}
        CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
        CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
        CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
        CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM r {group})
    SELECT {picked} CAST(n AS BIGINT) AS rows, (tp + tn) / n AS accuracy,
      coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
      (coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) * (tp + fn)
       + coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0.0) * (tn + fp)) / n AS f1
    FROM c"""


SCORED = """, s AS (
  SELECT leg_id, origin_city, dest_city, leg_date, CAST(dep_hhmm // 100 * 60 + dep_hhmm % 100 AS INTEGER) AS minute,
         CAST(dep_del15 AS INTEGER) AS label FROM legs),
  p AS (SELECT *, CASE WHEN minute >= 720 THEN 1 ELSE 0 END AS prediction,
               CAST(round(CAST(CAST(minute / 1440 AS VARCHAR) AS DECIMAL(38,18)), 3) AS DOUBLE) AS probability FROM s)"""


VALID_EVENT = "event_id % 97 <> 96"
STATION = "'K' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0')"

DECODED = f"""
        SELECT event_id, {STATION} AS station, date_trunc('minute', ts) AS obs_time,
          CAST(CASE WHEN event_id % 13 <> 0 THEN event_id % 36 * 10 END AS INTEGER) AS wind_direction,
          CAST(event_id % 40 AS INTEGER) AS wind_speed,
          CAST(CASE WHEN event_id % 4 = 0 THEN event_id % 40 + 10 END AS INTEGER) AS wind_gusts,
          CASE WHEN event_id % 11 = 0 THEN 0.5::DOUBLE WHEN event_id % 11 = 1 THEN 1.5::DOUBLE
               ELSE CAST(event_id % 10 + 1 AS DOUBLE) END AS visibility,
          ['', 'rain', 'thunderstorm rain', 'fog', 'rain,mist', '', ''][event_id % 7 + 1] AS precipitation,
          ['few', 'scattered', 'broken', 'overcast', 'clear'][event_id % 5 + 1] AS clouds,
          CAST(event_id % 41 - 10 AS DOUBLE) AS temperature, CAST(event_id % 41 - 13 AS DOUBLE) AS dew_point
        FROM events WHERE {VALID_EVENT}"""
WEATHER = "wind_direction wind_speed wind_gusts visibility precipitation clouds temperature dew_point".split()


def _enriched() -> str:
    """Both roles by an as-of join in UTC with a tolerance of two days."""
    greatest = ", ".join(f"{c} DESC NULLS LAST" for c in WEATHER)
    picked = ", ".join(
        f"CASE WHEN {r}.obs_time >= {t} - INTERVAL 2 DAY THEN {r}.{c} END AS {role}_{c}"
        for role, r, t in (("origin", "a", "dep_utc"), ("dest", "b", "arr_utc"))
        for c in WEATHER
    )
    return f"""
        WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, obs_time ORDER BY {greatest}) AS place
                                  FROM ({DECODED})) WHERE place = 1),
        f AS (SELECT CAST(l_orderkey AS INTEGER) AS order_key, CAST(l_linenumber AS INTEGER) AS line, l_quantity - 25 AS arr_delay,
            'K' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS origin, 'K' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS dest,
            s_nationkey % 4 + 5 AS ow, c_nationkey % 4 + 5 AS dw,
            TIMESTAMP '2024-01-01' + to_days(CAST(l_orderkey % 30 AS INTEGER)) AS day,
            to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60) AS dep, to_hours((l_partkey + 2) % 24) + to_minutes(l_suppkey % 60) AS arr
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber <> 7),
        g AS (SELECT *, day + dep AS departure, day + dep + to_hours(ow) AS dep_utc,
                CASE WHEN day + arr + to_hours(dw) < day + dep + to_hours(ow) THEN day + arr + INTERVAL 1 DAY ELSE day + arr END AS arrival
              FROM f),
        h AS (SELECT *, arrival + to_hours(dw) AS arr_utc FROM g)
        SELECT order_key, line, origin, dest, strftime(departure, {SECONDS}) AS departure, strftime(arrival, {SECONDS}) AS arrival,
          arr_delay, {picked}
        FROM h ASOF LEFT JOIN o a ON h.origin = a.station AND h.dep_utc >= a.obs_time
        ASOF LEFT JOIN o b ON h.dest = b.station AND h.arr_utc >= b.obs_time"""


ORACLES: dict[str, str] = {
    "dest_delay_avg": _legs(
        "SELECT dest_city, count(*) AS num_legs, avg(dep_delay) AS avg_dep_delay, avg(arr_delay) AS avg_arr_delay "
        "FROM legs GROUP BY dest_city"
    ),
    "dest_delay_top10": _legs(
        "SELECT dest_city, count(*) AS num_legs, avg(dep_delay) AS avg_dep_delay, avg(arr_delay) AS avg_arr_delay "
        "FROM legs GROUP BY dest_city ORDER BY avg_arr_delay DESC NULLS LAST, dest_city LIMIT 10"
    ),
    "carrier_worst_dest_top3": _legs(
        f"""SELECT {AIRLINE} AS airline, dest_city, num_legs, avg_arr_delay, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY carrier ORDER BY avg_arr_delay DESC NULLS LAST, dest_city)
                    AS INTEGER) AS rank
          FROM (SELECT carrier, dest_city, count(*) AS num_legs, avg(arr_delay) AS avg_arr_delay
                FROM legs WHERE cancelled = 0 GROUP BY carrier, dest_city)) WHERE rank <= 3"""
    ),
    "carrier_summary": _legs(
        f"""SELECT {AIRLINE} AS airline, count(*) AS total_legs, avg(arr_delay) AS overall_avg_arr_delay
        FROM legs WHERE cancelled = 0 GROUP BY carrier"""
    ),
    "carrier_cause_share": _legs(
        f""", t AS (SELECT carrier, sum(carrier_delay) AS carrier_total, sum(weather_delay) AS weather_total,
          sum(nas_delay) AS nas_total, sum(security_delay) AS security_total,
          sum(late_aircraft_delay) AS late_aircraft_total, sum(arr_delay) AS arr_delay_total
          FROM legs WHERE cancelled = 0 AND diverted = 0 GROUP BY carrier)
        SELECT {AIRLINE} AS airline, carrier_total, weather_total, nas_total, security_total, late_aircraft_total,
          arr_delay_total, """
        + ", ".join(
            f"{rnd(f'{c}_total / nullif(arr_delay_total, 0) * 100', 1)} AS {c}_pct"
            for c in ("carrier", "weather", "nas", "security", "late_aircraft")
        )
        + " FROM t"
    ),
    "carrier_delay_per_leg": _legs(
        f"""SELECT {AIRLINE} AS airline, sum(carrier_delay) AS carrier_delay_total, count(*) AS total_legs,
        {rnd('sum(carrier_delay) / count(*)')} AS carrier_delay_per_leg
        FROM legs WHERE cancelled = 0 AND diverted = 0 GROUP BY carrier"""
    ),
    "weekday_delay": _legs(
        f"""SELECT ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][day_of_week] AS weekday,
        count(*) AS total_legs, {rnd('avg(arr_delay)')} AS avg_arr_delay,
        {rnd('(sum(arr_del15) / count(*)) * 100')} AS pct_delayed_15
        FROM legs WHERE cancelled = 0 AND diverted = 0 GROUP BY day_of_week"""
    ),
    "weather_month_dest": _legs(
        f"""SELECT month, dest_city, count(*) AS num_weather_delays, {rnd('avg(weather_delay)')} AS avg_weather_delay,
        array_to_string(list_sort(list(DISTINCT weekofyear(leg_date))), ',') AS weeks
        FROM legs WHERE weather_delay > 0 GROUP BY month, dest_city"""
    ),
    "weather_time_block": _legs(
        f""", b AS (SELECT DISTINCT time_block FROM legs),
        d AS (SELECT time_block, count(*) AS n, {rnd('avg(weather_delay)')} AS a FROM legs WHERE weather_delay > 0 GROUP BY 1)
        SELECT b.time_block, coalesce(n, 0) AS num_weather_delays, coalesce(a, 0.0) AS avg_weather_delay
        FROM b LEFT JOIN d ON b.time_block = d.time_block"""
    ),
    "weather_time_block_domain": _legs(
        f""", b AS (SELECT DISTINCT lpad(CAST(arr_hhmm // 100 AS VARCHAR), 2, '0') || '00-' ||
                    lpad(CAST(arr_hhmm // 100 AS VARCHAR), 2, '0') || '59' AS time_block FROM legs),
        d AS (SELECT time_block, count(*) AS n, {rnd('avg(weather_delay)')} AS a FROM legs
              WHERE weather_delay > 0 GROUP BY 1)
        SELECT b.time_block, coalesce(n, 0) AS num_weather_delays, coalesce(a, 0.0) AS avg_weather_delay
        FROM b LEFT JOIN d ON b.time_block = d.time_block"""
    ),
    "origin_counts": _legs("SELECT origin_city, count(*) AS num_legs FROM legs GROUP BY 1"),
    "region_pair_counts": _legs(
        f"SELECT origin_city, dest_city, count(*) AS num_legs, avg(elapsed) AS avg_duration FROM legs "
        f"WHERE {TOUCHING} GROUP BY 1, 2"
    ),
    "region_origin_counts": _legs(
        "SELECT origin_city, count(*) AS num_legs FROM legs WHERE contains(origin_city, '_1') GROUP BY 1"
    ),
    "region_origin_delay": _legs(
        f"SELECT origin_city, avg(arr_delay_minutes) AS avg_arr_delay FROM legs WHERE {TOUCHING} GROUP BY 1"
    ),
    "region_month_counts": _legs(
        f"SELECT year, month, origin_city, count(*) AS num_legs FROM legs WHERE {TOUCHING} GROUP BY 1, 2, 3"
    ),
    "monthly_delay_pct": _legs(
        f"""SELECT year, month, count(*) AS total_legs,
        CAST(sum(CASE WHEN arr_delay_minutes > 15 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_legs,
        CAST(sum(CASE WHEN arr_delay_minutes > 15 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100 AS delay_percentage
        FROM legs WHERE {ONE} GROUP BY 1, 2"""
    ),
    "season_counts": _legs(
        f"""SELECT year, CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
        WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season, count(*) AS num_legs
        FROM legs WHERE {ONE} GROUP BY 1, 2"""
    ),
    "date_range": _legs(
        "SELECT strftime(min(leg_date), '%Y-%m-%d') AS first_date, strftime(max(leg_date), '%Y-%m-%d') AS last_date FROM legs"
    ),
    "month_delay_total": _legs(
        f"SELECT month, sum(dep_delay_minutes) AS total_delay_minutes FROM legs WHERE {ONE} GROUP BY 1"
    ),
    "carrier_delay_describe": _legs(
        f"""SELECT carrier, count(dep_delay_minutes) AS count, {rnd('avg(dep_delay_minutes)', 6)} AS mean,
        {rnd('stddev_samp(dep_delay_minutes)', 6)} AS std, min(dep_delay_minutes) AS min,
        quantile_cont(dep_delay_minutes, 0.25) AS p25, quantile_cont(dep_delay_minutes, 0.5) AS p50,
        quantile_cont(dep_delay_minutes, 0.75) AS p75, max(dep_delay_minutes) AS max
        FROM legs WHERE {ONE} GROUP BY 1"""
    ),
    "route_baseline": _legs(
        """, d AS (SELECT origin_city, dest_city, carrier, leg_date, sum(arr_delay) AS s, count(*) AS n
                   FROM legs GROUP BY ALL)
        SELECT origin_city, dest_city, carrier, strftime(leg_date, '%Y-%m-%d') AS leg_day, n AS day_rows,
          sum(s) OVER w / sum(n) OVER w AS prior_avg
        FROM d WINDOW w AS (PARTITION BY origin_city, dest_city, carrier ORDER BY leg_date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    ),
    "rolling_delay": _legs(
        """, d AS (SELECT origin_city, leg_date, sum(arr_delay) AS s, count(*) AS n FROM legs GROUP BY ALL)
        SELECT origin_city, strftime(leg_date, '%Y-%m-%d') AS leg_day, n AS day_rows,
          sum(s) OVER w / sum(n) OVER w AS rolling_avg
        FROM d WINDOW w AS (PARTITION BY origin_city ORDER BY leg_date
                            RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"""
    ),
    "delay_distribution": _legs(
        """, b AS (SELECT min(arr_delay) AS lo, max(arr_delay) AS hi FROM legs)
        SELECT carrier, CAST(least(floor((arr_delay - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, count(*) AS num_legs
        FROM legs, b GROUP BY 1, 2"""
    ),
    "weather_combo_origin": _combination("origin"),
    "weather_combo_dest": _combination("dest"),
    "wind_bucket_mph": _legs(
        """SELECT CASE WHEN origin_wind_speed < 5 THEN '<5 mph' WHEN origin_wind_speed < 15 THEN '5-15 mph'
        WHEN origin_wind_speed < 25 THEN '15-25 mph' ELSE '25+ mph' END AS wind_bucket,
        avg(weather_delay) AS avg_weather_delay, count(*) AS num_weather_delays
        FROM legs WHERE weather_delay > 0 GROUP BY 1"""
    ),
    "visibility_bucket": _bucket(
        "CASE WHEN origin_visibility IS NULL THEN 'Unknown' WHEN origin_visibility < 1 THEN '<1 mile' "
        "WHEN origin_visibility < 3 THEN '1-3 miles' WHEN origin_visibility < 5 THEN '3-5 miles' ELSE '>5 miles' END",
        "visibility_bucket",
    ),
    "cloud_delay_dest": _legs(
        """SELECT cloud, count(*) AS num_weather_delays, avg(weather_delay) AS avg_weather_delay FROM (
          SELECT unnest(dest_clouds) AS cloud, weather_delay FROM legs WHERE weather_delay > 0) GROUP BY 1"""
    ),
    "cloud_delay_origin": _legs(
        f"""SELECT cloud, count(*) AS total_legs, {DELAYED} AS delayed_legs, {rnd(DELAYED_PCT)} AS delay_pct,
        {rnd('avg(weather_delay)')} AS avg_weather_delay FROM (
          SELECT unnest(origin_clouds) AS cloud, arr_del15, weather_delay FROM legs) GROUP BY 1"""
    ),
    "wind_bucket_origin_kt": _bucket(_knots("origin_wind_speed"), "wind_bucket"),
    "wind_bucket_dest_kt": _bucket(_knots("dest_wind_speed"), "wind_bucket"),
    "dest_wind_delay": _legs(
        f"""SELECT dest_city, count(*) AS total_legs, {DELAYED} AS delayed_legs,
        {rnd('avg(dest_wind_speed)')} AS avg_wind_speed, {rnd(DELAYED_PCT)} AS delay_rate_pct FROM legs GROUP BY 1"""
    ),
    "precip_delay": _legs(
        f"""SELECT {_label('origin_precipitation', ', ')} AS precipitation, count(*) AS total_legs,
        {DELAYED} AS delayed_legs, {rnd(DELAYED_PCT)} AS delay_rate_pct, {rnd('avg(arr_delay)')} AS avg_arr_delay
        FROM legs GROUP BY 1"""
    ),
    "dest_precip_frequency": _legs(
        f"""SELECT dest_city, count(*) AS total_legs,
        CAST(sum(CASE WHEN len(dest_precipitation) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS legs_with_precip,
        {rnd('(CAST(sum(CASE WHEN len(dest_precipitation) > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)) * 100')}
          AS precip_frequency_pct,
        {DELAYED} AS delayed_legs, {rnd(DELAYED_PCT)} AS delay_rate_pct FROM legs GROUP BY 1"""
    ),
    "delay_corr_matrix": _correlations(),
    "null_profile": _legs(
        "SELECT * FROM ("
        + _union(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM legs" for c in PROFILED)
        + ") WHERE nulls > 0"
    ),
    "column_medians": _legs(
        _union(
            f"SELECT '{c}' AS \"column\", coalesce(CAST(median({c}) AS DOUBLE), 0.0) AS median FROM legs"
            for c in FEATURE_NUMBERS
        )
    ),
    "table_profile": _legs(
        _union(
            f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls,
            {_extreme('min', c, kind)} AS min, {_extreme('max', c, kind)} AS max FROM legs"""
            for c, kind in PROFILED.items()
        )
    ),
    "exact_route_quantiles": _legs(
        """, v AS (SELECT dest_city, leg_id / 1000003.0::DOUBLE AS share FROM legs), q AS (
          SELECT dest_city, share FROM v UNION ALL SELECT 'all', share FROM v)
        SELECT dest_city, """
        + ", ".join(f"{rnd(f'quantile_cont(share, 0.{n})', 6)} AS p{n}" for n in ("10", "25", "50", "75", "90"))
        + " FROM q GROUP BY 1"
    ),
    "sketch_rank_error": _legs(
        """SELECT carrier, quantile, count(*) AS rows, TRUE AS within_bound
        FROM legs, (VALUES ('p10'), ('p25'), ('p50'), ('p75'), ('p90')) AS q(quantile) GROUP BY 1, 2"""
    ),
    "station_timeframes": _legs(
        f""", {FRAMES} SELECT station, role, strftime(window_start, {SECONDS}) AS window_start,
        strftime(window_end, {SECONDS}) AS window_end, strftime(start_date, {SECONDS}) AS start_date,
        strftime(end_date, {SECONDS}) AS end_date, records FROM frames"""
    ),
    "observation_requests": _legs(
        f""", utc AS (SELECT origin_city, dest_city, dep_time + to_hours(origin_key % 4 + 5) AS dep_time FROM legs), {FRAMES.replace('FROM legs', 'FROM utc')}, r AS (
          SELECT station, role, start_date - INTERVAL 1 DAY AS s, end_date + INTERVAL 1 DAY AS e FROM frames)
        SELECT station, role, CAST(year(s) AS INTEGER) AS year1, CAST(month(s) AS INTEGER) AS month1,
          CAST(day(s) AS INTEGER) AS day1, CAST(year(e) AS INTEGER) AS year2, CAST(month(e) AS INTEGER) AS month2,
          CAST(day(e) AS INTEGER) AS day2,
          format('station={{}}&data=metar&year1={{}}&month1={{}}&day1={{}}&year2={{}}&month2={{}}&day2={{}}&tz=Etc/UTC&format=onlytdf&latlon=no&elev=no&missing=M&trace=T&direct=no&report_type=2',
                 station, year(s), month(s), day(s), year(e), month(e), day(e)) AS query
        FROM r"""
    ),
    "legs_in_timeframes": _legs(
        f""", {FRAMES}, responses AS (
          SELECT station, role, strftime(window_start, {SECONDS}) AS window_start, start_date - INTERVAL 1 DAY AS s,
                 end_date + INTERVAL 1 DAY AS e FROM frames
          UNION ALL SELECT n_name, 'all', '', TIMESTAMP '1960-01-01', TIMESTAMP '2010-01-01' FROM nation)
        SELECT r.station, role, window_start, count(*) AS num_legs, sum(arr_delay) AS arr_delay_total,
          strftime(min(dep_time), {SECONDS}) AS first_departure, strftime(max(dep_time), {SECONDS}) AS last_departure
        FROM legs JOIN responses r ON origin_city = r.station AND dep_time >= s AND dep_time <= e GROUP BY 1, 2, 3"""
    ),
    "sched_timestamps": f"""
        WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d,
                          CAST(l_partkey % 26 * 100 + l_suppkey % 70 AS INTEGER) AS hhmm FROM lineitem),
        p AS (SELECT *, try_strptime(strftime(d, '%Y-%m-%d') || ' ' || lpad(CAST(hhmm AS VARCHAR), 4, '0'),
                                     '%Y-%m-%d %H%M') AS s FROM t)
        SELECT l_orderkey, l_linenumber, hhmm, strftime(s, {SECONDS}) AS scheduled,
          strftime(CASE WHEN hhmm = 2400 THEN CAST(d + 1 AS TIMESTAMP) ELSE s END, {SECONDS}) AS scheduled_rolled
        FROM p""",
    "asof_weather": _asof(),
    "asof_weather_within_day": _asof("o.obs_time >= l.leg_time - INTERVAL 1 DAY"),
    "nearest_observation": f"""{SIDES},
        b AS (SELECT l.*, o.obs_time AS t1, o.value AS v1 FROM l ASOF LEFT JOIN o
              ON l.station = o.station AND l.leg_time >= o.obs_time),
        f AS (SELECT l.event_id, o.obs_time AS t2, o.value AS v2 FROM l ASOF LEFT JOIN o
              ON l.station = o.station AND l.leg_time <= o.obs_time),
        j AS (SELECT b.*, t2, v2, t1 IS NULL OR (t2 IS NOT NULL AND t2 - leg_time < leg_time - t1) AS later
              FROM b JOIN f ON b.event_id = f.event_id)
        SELECT event_id, station, strftime(leg_time, {MICROS}) AS leg_time,
          strftime(CASE WHEN later THEN t2 ELSE t1 END, {MICROS}) AS obs_time,
          CASE WHEN later THEN v2 ELSE v1 END AS obs_value FROM j""",
    "asof_two_roles": f"""{SIDES},
        m AS (SELECT *, station + 1 AS other_station FROM l),
        a AS (SELECT m.*, o.value AS origin_value FROM m ASOF LEFT JOIN o
              ON m.station = o.station AND m.leg_time >= o.obs_time)
        SELECT a.event_id, a.station, a.other_station, a.origin_value, o.value AS dest_value
        FROM a ASOF LEFT JOIN o ON a.other_station = o.station AND a.leg_time >= o.obs_time""",
    "decode_observations": f"""
        SELECT event_id, {STATION} AS station, strftime(date_trunc('minute', ts), {SECONDS}) AS obs_time,
          CAST(CASE WHEN event_id % 13 <> 0 THEN event_id % 36 * 10 END AS INTEGER) AS wind_direction,
          CAST(event_id % 40 AS INTEGER) AS wind_speed,
          CAST(CASE WHEN event_id % 4 = 0 THEN event_id % 40 + 10 END AS INTEGER) AS wind_gusts,
          CASE WHEN event_id % 11 = 0 THEN 0.5::DOUBLE WHEN event_id % 11 = 1 THEN 1.5::DOUBLE
               ELSE CAST(event_id % 10 + 1 AS DOUBLE) END AS visibility,
          ['', 'rain', 'thunderstorm rain', 'fog', 'rain,mist', '', ''][event_id % 7 + 1] AS precipitation,
          ['few', 'scattered', 'broken', 'overcast', 'clear'][event_id % 5 + 1] AS clouds,
          CAST(event_id % 41 - 10 AS DOUBLE) AS temperature, CAST(event_id % 41 - 13 AS DOUBLE) AS dew_point
        FROM events WHERE {VALID_EVENT}""",
    "observation_rejects": """
        SELECT event_id, '??' || CAST(event_id AS VARCHAR) AS line, 'no time' AS reason
        FROM events WHERE event_id % 97 = 96""",
    "role_dim_join": """
        SELECT o.n_name AS origin, d.n_name AS dest, o.n_regionkey AS origin_region, d.n_regionkey AS dest_region,
          count(*) AS num_legs, sum(l_quantity - 25) AS arr_delay_total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation o ON s_nationkey = o.n_nationkey
        JOIN nation d ON c_nationkey = d.n_nationkey GROUP BY ALL""",
    "dest_catalog": _legs("SELECT DISTINCT dest_city FROM legs"),
    "dates_by_dest": _legs(
        "SELECT dest_city, array_to_string(list_sort(list(DISTINCT strftime(leg_date, '%Y-%m-%d'))), ',') AS dates "
        "FROM legs GROUP BY 1"
    ),
    "legs_by_dest_date": _legs(
        """, k AS (SELECT dest_city, strftime(leg_date, '%Y-%m-%d') AS leg_day, leg_id,
                   dep_hhmm // 100 * 60 + dep_hhmm % 100 AS dep, arr_hhmm // 100 * 60 + arr_hhmm % 100 AS arr,
                   CAST(ceil(count(*) OVER (PARTITION BY dest_city, leg_date) / 1000.0) AS BIGINT) AS pages FROM legs)
        SELECT dest_city, leg_day, leg_id % pages AS page, pages, count(*) AS num_records,
          string_agg(leg_id || ':' || dep || ':' || arr, ',' ORDER BY leg_id, dep, arr) AS legs
        FROM k GROUP BY dest_city, leg_day, leg_id % pages, pages"""
    ),
    "legs_of_one_day": _legs(
        """SELECT leg_id, dep_hhmm // 100 * 60 + dep_hhmm % 100 AS departure_minute FROM legs
        WHERE dest_city = 'NATION_10' AND leg_date = DATE '1998-03-17'"""
    ),
    "replay_envelopes": f"""
        SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01'), {SECONDS}) AS window_start,
        count(*) AS num_records FROM events GROUP BY 1""",
    "stream_flatten": f"SELECT event_id, strftime(ts, {MICROS}) AS ts, user_id, event_type, value, props FROM events",
    "stream_rolling": _rolling(),
    "stream_distinct": f"""
        SELECT DISTINCT user_id, event_type, strftime(date_trunc('hour', ts), {SECONDS}) AS hour FROM events""",
    "stream_enrich": f"""{SIDES}
        SELECT l.event_id, l.station, CASE WHEN o.obs_time >= l.leg_time - INTERVAL 7 DAY THEN o.value END AS obs_value
        FROM l ASOF LEFT JOIN o ON l.station = o.station AND l.leg_time >= o.obs_time""",
    "stream_live_enrich": f"""{SIDES}, w AS (
          SELECT least((SELECT max(leg_time) FROM l), (SELECT max(obs_time) FROM o)) - INTERVAL 2 DAY AS mark)
        SELECT l.event_id, l.station,
          CASE WHEN o.obs_time >= l.leg_time - INTERVAL 7 DAY THEN strftime(o.obs_time, {MICROS}) END AS obs_time,
          CASE WHEN o.obs_time >= l.leg_time - INTERVAL 7 DAY THEN o.value END AS obs_value
        FROM l ASOF LEFT JOIN o ON l.station = o.station AND l.leg_time >= o.obs_time
        WHERE l.leg_time <= (SELECT mark FROM w)""",
    "feature_table": _feature_table(),
    "hashed_features": _hashed_features(64),
    "word_flag_features": _legs(
        "SELECT leg_id, "
        + ", ".join(
            f"CASE WHEN list_contains({c}, '{w}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_{w}"
            for c, w in (("origin_precipitation", "PROMO"), ("origin_precipitation", "LARGE"),
                         ("dest_precipitation", "PROMO"), ("dest_precipitation", "ECONOMY"))
        )
        + " FROM legs"
    ),
    "split_sample": _legs(
        """SELECT CASE WHEN CAST('0x' || substr(md5('42:' || CAST(leg_id AS VARCHAR)), 1, 7) AS BIGINT) % 100 < 80
           THEN 'train' ELSE 'test' END AS split, count(*) AS rows FROM legs GROUP BY 1"""
    ),
    "rule_metrics": _legs(_metrics()),
    "rule_confusion": _legs(f"{RULE} SELECT label, prediction, count(*) AS rows FROM r GROUP BY 1, 2"),
    "rule_segment_error": _legs(
        f"""{RULE} SELECT carrier, dep_hour, count(*) AS rows, count(*) FILTER (label <> prediction) AS errors,
        CAST(count(*) FILTER (label <> prediction) AS DOUBLE) / count(*) AS error_rate,
        avg(CAST(prediction AS DOUBLE)) AS avg_delay_probability FROM r GROUP BY 1, 2"""
    ),
    "rule_performance_over_time": _legs(
        _metrics("time_bucket(INTERVAL 7 DAY, CAST(leg_date AS TIMESTAMP), TIMESTAMP '1970-01-01') AS week,")
    ),
    "rule_rolling_ranges": _legs(
        _metrics("(m // 12) || '-' || lpad(CAST(m % 12 + 1 AS VARCHAR), 2, '0') AS week,")
        .replace("FROM legs WHERE", "FROM legs WHERE", 1)
        .replace(", c AS (SELECT", ", q AS (SELECT r.*, unnest(range(year(leg_date) * 12 + month(leg_date) - 6, "
                 "year(leg_date) * 12 + month(leg_date))) AS m FROM r), c AS (SELECT", 1)
        .replace("FROM r GROUP BY week", "FROM q GROUP BY week")
        .replace(f"strftime(week, {SECONDS}) AS week", "week AS range_start")
    ),
    "rule_curve_metrics": _legs(
        f"""{SCORED}, g AS (SELECT probability, sum(label) AS pos, sum(1 - label) AS neg FROM p WHERE label IS NOT NULL GROUP BY 1),
        t AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS allp, sum(neg) OVER () AS alln
              FROM g WINDOW w AS (ORDER BY probability DESC)),
        u AS (SELECT *, tp / (tp + fp) AS prec, coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), tp / (tp + fp)) AS before FROM t)
        SELECT round(CAST(sum(neg * (tp + tp - pos) / 2) / max(allp) / max(alln) AS DOUBLE), 9) AS roc_auc,
               round(CAST(sum(pos * (prec + before) / 2) / max(allp) AS DOUBLE), 9) AS pr_auc FROM u"""
    ),
    "rule_score_date": _legs(
        f"""{SCORED} SELECT origin_city, dest_city, leg_id, minute AS dep_minute_of_day, prediction,
        CASE WHEN prediction = 1 THEN 'DELAYED' ELSE 'On Time' END AS status, printf('%.3f', probability) AS probability
        FROM p WHERE leg_date = DATE '1998-03-17'"""
    ),
    "rule_score_ids": _legs(
        f"""{SCORED} SELECT leg_id, prediction AS delay, probability AS delay_probability
        FROM p WHERE leg_id IN (SELECT leg_id FROM s WHERE leg_date = DATE '1998-03-17')"""
    ),
    "rule_permutation_importance": _legs(
        """, p AS (SELECT leg_id, CAST(dep_hhmm // 100 * 60 + dep_hhmm % 100 AS INTEGER) AS minute, CAST(dep_del15 AS INTEGER) AS label
                 FROM legs WHERE dep_del15 IS NOT NULL),
        a AS (SELECT label, row_number() OVER (ORDER BY md5('7:' || leg_id)) AS place FROM p),
        b AS (SELECT minute, row_number() OVER (ORDER BY md5('7:dep_minute_of_day:' || leg_id)) AS place FROM p),
        base AS (SELECT avg(CAST(label = CAST(minute >= 720 AS INTEGER) AS INTEGER)) AS accuracy, count(*) AS rows FROM p),
        c AS (SELECT avg(CAST(label = CAST(minute >= 720 AS INTEGER) AS INTEGER)) AS accuracy FROM a JOIN b USING (place))
        SELECT 'dep_minute_of_day' AS feature, rows, c.accuracy, base.accuracy - c.accuracy AS importance FROM base, c
        UNION ALL SELECT f.feature, rows, accuracy, 0.0::DOUBLE FROM base, (VALUES ('origin_city'), ('dest_city')) AS f(feature)"""
    ),
    "rule_segments": _legs(
        f""", r AS (SELECT carrier, dest_city, CAST(dep_hhmm // 100 AS INTEGER) AS dep_hour, CAST(dep_del15 AS INTEGER) AS label
                 FROM legs WHERE dep_del15 IS NOT NULL),
        s AS (SELECT carrier, dest_city, dep_hour, GROUPING(carrier) AS gc, GROUPING(dest_city) AS gd, GROUPING(dep_hour) AS gh,
                count(*) AS rows, count(*) FILTER (label <> CAST(dep_hour >= 12 AS INTEGER)) AS errors
              FROM r GROUP BY CUBE (carrier, dest_city, dep_hour) HAVING count(*) >= 30),
        t AS (SELECT *, CAST(errors AS DOUBLE) / rows AS rate FROM s)
        SELECT concat_ws('+', CASE WHEN c.gc = 0 THEN 'carrier' END, CASE WHEN c.gd = 0 THEN 'dest_city' END,
                         CASE WHEN c.gh = 0 THEN 'dep_hour' END) AS level,
          c.carrier, c.dest_city, c.dep_hour, c.rows, c.errors, {rnd('c.rate', 9)} AS error_rate,
          {rnd('c.rate / NULLIF(p.rate, 0)', 9)} AS lift
        FROM t c LEFT JOIN t p ON c.gc + c.gd + c.gh < 3
          AND p.gh = 1
          AND p.gd = CASE WHEN c.gh = 0 THEN c.gd ELSE 1 END
          AND p.gc = CASE WHEN c.gh = 0 OR c.gd = 0 THEN c.gc ELSE 1 END
          AND (p.gd = 1 OR p.dest_city IS NOT DISTINCT FROM c.dest_city)
          AND (p.gc = 1 OR p.carrier IS NOT DISTINCT FROM c.carrier)"""
    ),
    "rule_typed_rows": _legs(
        """, t AS (SELECT l_orderkey * 1000003 + l_partkey * 8191 + l_suppkey * 131 + l_linenumber * 17 + CAST(l_quantity AS BIGINT) AS leg_id,
                    l_returnflag, l_partkey % 25 AS h, l_suppkey % 60 AS m FROM lineitem)
        SELECT leg_id, l_returnflag AS network,
          CASE WHEN h < 24 AND h * 60 + m >= 720 THEN 1 ELSE 0 END AS prediction,
          CASE WHEN h < 24 THEN round(CAST(CAST(CAST((h * 60 + m) / 1440 AS VARCHAR) AS DECIMAL(38,18)) AS DECIMAL(38,18)), 3)::DOUBLE END AS delay_probability
        FROM t"""
    ),
    "stable_ids": """
        SELECT l_orderkey, l_linenumber, md5(concat_ws('|', """
    + ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || '=' || CAST({c} AS VARCHAR), '-')" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"))
    + """)) AS leg_digest FROM lineitem""",
    "enrich_legs": _enriched(),
    "stream_late_rows": f"""
        WITH e AS (SELECT *, least((day(ts) - 1) // 8, 3) AS week, event_id % 50 = 0 AS late,
                          time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS slot FROM events),
        w AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM e WHERE NOT late AND week <= 2)
        SELECT event_type, strftime(slot, {SECONDS}) AS window_start, count(*) AS num_events
        FROM e, w WHERE NOT late OR slot + INTERVAL 15 MINUTE > mark GROUP BY 1, 2""",
    "stream_late_kept": f"""
        WITH e AS (SELECT *, event_id % 50 = 0 AS delayed, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS slot FROM events),
        w AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM e WHERE NOT delayed)
        SELECT 'merged' AS part, event_type, strftime(slot, {SECONDS}) AS window_start, count(*) AS num_events FROM e GROUP BY 1, 2, 3
        UNION ALL
        SELECT 'late', event_type, strftime(slot, {SECONDS}), count(*) FROM e, w
        WHERE delayed AND slot + INTERVAL 15 MINUTE <= mark GROUP BY 1, 2, 3""",
    "stream_mean_scores": """
        SELECT user_id AS station, strftime(ts, '%Y-%m-%d') AS day, count(*) AS num_legs,
          round(CAST(sum(CAST(round(CAST(CAST((hour(ts) * 60 + minute(ts)) / 1440 AS VARCHAR) AS DECIMAL(38,18)), 3) AS DECIMAL(18,3))) AS DOUBLE)
                / count(*), 6) AS mean_probability
        FROM events GROUP BY 1, 2""",
    "shaped_legs": """
        SELECT l_orderkey, l_linenumber AS leg_line, l_tax AS LegTax, l_discount AS LegDiscount, 7.0::DOUBLE AS bonus,
          strftime(l_shipdate, '%Y-%m-%d') || ' 0' || (l_suppkey % 10) || ':52:00' AS at,
          CAST(l_partkey % 24 * 60 + l_suppkey % 60 AS INTEGER) AS minutes,
          CASE WHEN l_linenumber = 1 THEN 'None' ELSE l_returnflag || ',' || l_linestatus END AS flags,
          CASE WHEN isodow(l_shipdate) >= 6 THEN 1 ELSE 0 END AS weekend FROM lineitem""",
    "stored_splits": _legs(
        f"""SELECT CASE WHEN {SPLIT_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split, CAST(dep_del15 AS INTEGER) AS label,
        count(*) AS rows FROM legs WHERE dep_del15 IS NOT NULL GROUP BY 1, 2"""
    ),
    "archived_raw": """
        SELECT CASE WHEN event_id % 2 = 0 THEN '2024-02-01' ELSE '2024-02-02' END AS load_day, count(*) AS lines,
          min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY 1""",
    "time_sorted_rows": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS wrong FROM events",
    "filled_from_file": _legs(
        "SELECT "
        + ", ".join(
            f"sum(coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM legs))) AS {c}"
            for c in ("origin_wind_speed", "origin_visibility", "dest_wind_speed")
        )
        + " FROM legs"
    ),
    "scan_slice": "SELECT least(count(*), 1000) AS rows, 'event_id,ts' AS columns FROM events",
    "complete_leg_counts": _legs(
        "SELECT carrier, count(*) AS num_legs FROM legs WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in [*FEATURE_NUMBERS, "leg_date", "dep_hhmm", "arr_hhmm", "dep_del15", "carrier", "operator",
                       "origin_city", "dest_city", "origin_precipitation", "origin_clouds", "dest_precipitation", "dest_clouds"])
        + " GROUP BY 1"
    ),
    "hash_sample": _legs(f"SELECT leg_id, arr_delay FROM legs WHERE {SPLIT_BUCKET.replace('42:', '7:')} < 10"),
    "scaled_numbers": _legs(
        """, s AS (SELECT avg(dep_delay) AS a, stddev_samp(dep_delay) AS b, avg(elapsed) AS c, stddev_samp(elapsed) AS d FROM legs)
        SELECT leg_id, round((dep_delay - a) / b, 6) AS dep_delay, round((elapsed - c) / d, 6) AS elapsed FROM legs, s"""
    ),
    "class_weights": _legs(
        """SELECT CAST(dep_del15 AS INTEGER) AS label,
        CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
        FROM legs WHERE dep_del15 IS NOT NULL GROUP BY dep_del15"""
    ),
}

# The same results by other ways.
ORACLES["incremental_rolling_delay"] = ORACLES["rolling_delay"]
ORACLES["dates_by_dest_bitmaps"] = ORACLES["dates_by_dest"]
ORACLES["bucketed_score_ids"] = f"""WITH a AS ({ORACLES["rule_score_ids"]})
    SELECT 'all' AS asked, * FROM a UNION ALL SELECT 'greatest', * FROM a WHERE leg_id = (SELECT max(leg_id) FROM a)"""

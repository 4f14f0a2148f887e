"""The registered queries once more as plain SQL over the test tables, for comparison."""

from ridemart.queries import (
    BATCH_ARRIVALS, BATCH_FEED_BEFORE, CAPPED_ARRIVALS, STREAM_ARRIVALS, STREAM_FEED_FROM,
)


def _coordinates(a: str, b: str, c: str, d: str) -> str:
    return f"""
        40.55::double + ((({a}) * 7919) % 1000)::double * 0.00035::double AS start_lat,
        (-74.05)::double + ((({b}) * 6101) % 1000)::double * 0.0003::double AS start_lon,
        40.55::double + ((({c}) * 3571) % 1000)::double * 0.00035::double AS end_lat,
        (-74.05)::double + ((({d}) * 2741) % 1000)::double * 0.0003::double AS end_lon"""


RIDES_EVENTS = f"""
    rides_events AS (
      SELECT 'E' || (event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END)::varchar AS trip_id,
             CASE WHEN event_id % 53 = 0 THEN NULL ELSE start_lat END AS start_lat, start_lon, end_lat,
             CASE WHEN event_id % 59 = 0 THEN NULL ELSE end_lon END AS end_lon,
             st AS start_time,
             CASE WHEN event_id % 61 = 0 THEN st
                  WHEN event_id % 67 = 0 THEN st - to_seconds(sec)
                  ELSE st + to_seconds(sec) END AS end_time,
             value AS distance
      FROM (SELECT event_id, date_trunc('second', ts) AS st, value, floor(value * 60)::bigint + 1 AS sec,
                   {_coordinates('user_id', 'event_id', 'event_id % 97', 'user_id + event_id % 13')}
            FROM events))"""

RIDES_ORDERS = f"""
    rides_orders AS (
      SELECT 'O' || l_orderkey::varchar || '-' || l_linenumber::varchar AS trip_id,
             start_lat, start_lon, end_lat, end_lon,
             st AS start_time, st + to_seconds(sec) AS end_time, l_quantity AS distance
      FROM (SELECT l_orderkey, l_linenumber, l_quantity,
                   o_orderdate + to_seconds((l_partkey * 37 + l_suppkey * 101) % 86400) AS st,
                   (l_partkey * 13 + l_linenumber * 97 + floor(l_extendedprice)::bigint) % 5400 AS sec,
                   {_coordinates('l_suppkey', 'l_partkey', 'l_partkey % 89', 'l_suppkey + l_linenumber')}
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"""

def _fixed(name: str) -> str:
    return f"coalesce({name}::decimal(12,5)::varchar, '')"


_id_number = "substring(trip_id, 2)::bigint"
_first_fields = f"""CASE WHEN {_id_number} % 83 = 0 THEN '' ELSE trip_id END || ',' ||
    CASE WHEN {_id_number} % 79 = 0 THEN 'zz' ELSE {_fixed('start_lat')} END || ',' || {_fixed('start_lon')}"""
_whole_line = f"""{_first_fields} || ',' || {_fixed('end_lat')} || ',' || {_fixed('end_lon')} || ',' ||
    strftime(start_time, '%Y-%m-%d %H:%M:%S') || ',' || strftime(end_time, '%Y-%m-%d %H:%M:%S') || ',' ||
    distance::decimal(12,2)::varchar"""
RIDE_LINES = f"""
    ride_lines AS (
      SELECT *, CASE WHEN {_id_number} % 71 = 0 THEN {_first_fields}
                     WHEN {_id_number} % 73 = 0 THEN {_whole_line} || ',more,' ELSE {_whole_line} END AS line
      FROM rides_events)"""

VALID = """trip_id IS NOT NULL AND end_time > start_time AND start_lat IS NOT NULL
    AND start_lon IS NOT NULL AND end_lat IS NOT NULL AND end_lon IS NOT NULL"""

BAND = """CASE WHEN trip_duration_sec < 300 THEN 1 WHEN trip_duration_sec < 900 THEN 2
    WHEN trip_duration_sec < 1800 THEN 3 WHEN trip_duration_sec < 3600 THEN 4
    WHEN trip_duration_sec IS NOT NULL THEN 5 END::int"""


def _cell(lat: str, lon: str, level: int = 15) -> str:
    """Cell digits one by one, from the interleaved bits of the two axis buckets."""
    x = f"least(floor(({lon} + 180) / 360 * {1 << level})::bigint, {(1 << level) - 1})"
    y = f"least(floor((90 - {lat}) / 180 * {1 << level})::bigint, {(1 << level) - 1})"
    digits = f"[((({x}) >> i) & 1) + 2 * ((({y}) >> i) & 1) for i in range({level - 1}, -1, -1)]"
    return (
        f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 "
        f"THEN array_to_string({digits}, '') END"
    )


def _axis_bucket(cell: str, heavy: str) -> str:
    """The bucket number on one axis: the sum of powers of two where a digit has the axis' bit."""
    return (
        f"list_sum([CASE WHEN contains('{heavy}', {cell}[i]) THEN 1::bigint << (length({cell}) - i) ELSE 0 END "
        f"for i in range(1, length({cell}) + 1)])"
    )


LAT = f"90 - (({_axis_bucket('geo_hash', '23')})::double + 0.5) / pow(2.0, length(geo_hash)) * 180"
LON = f"(({_axis_bucket('geo_hash', '13')})::double + 0.5) / pow(2.0, length(geo_hash)) * 360 - 180"


def _clean(name: str, rides: str, condition: str = "true") -> str:
    return f"""
    {name} AS (
      SELECT trip_id, start_time, {_cell('start_lat', 'start_lon')} AS start_geo_hash,
             {_cell('end_lat', 'end_lon')} AS end_geo_hash,
             date_diff('second', start_time, end_time)::bigint AS trip_duration_sec
      FROM {rides} WHERE {VALID} AND {condition})"""


def _first(name: str, rows: str, order: str = "start_time, trip_duration_sec, start_geo_hash, end_geo_hash") -> str:
    return f"""
    {name} AS (
      SELECT * FROM {rows}
      QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY {order}) = 1)"""


def _fact(name: str, silver: str) -> str:
    return f"""
    {name} AS (
      SELECT trip_id, strftime(start_time, '%Y%m%d')::int AS date_key, hour(start_time)::int AS time_key,
             start_geo_hash AS start_geo_key, end_geo_hash AS end_geo_key,
             {BAND} AS duration_bucket_key, start_time, trip_duration_sec, 1::int AS trip_count,
             CASE WHEN start_geo_hash = end_geo_hash THEN 1 ELSE 0 END::int AS is_same_cell
      FROM {silver})"""


DATE_ATTRIBUTES = """strftime(d, '%Y%m%d')::int AS date_key, d AS full_date, day(d)::int AS day,
    dayname(d) AS day_name, (dayofweek(d) + 1)::int AS day_of_week,
    CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END::int AS is_weekend,
    weekofyear(d)::int AS week_of_year, month(d)::int AS month, monthname(d) AS month_name,
    quarter(d)::int AS quarter, year(d)::int AS year"""

CELL_ATTRIBUTES = f"""geo_hash, {LAT} AS lat, {LON} AS lon,
    substring(geo_hash, 1, 12) AS parent_geo_res6, substring(geo_hash, 1, 11) AS parent_geo_res5"""

HOURS = """
    hours AS (
      SELECT h::int AS hour,
             CASE WHEN h BETWEEN 6 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 16 THEN 'Afternoon'
                  WHEN h BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS period,
             CASE WHEN h IN (7, 8, 9, 16, 17, 18, 19) THEN 1 ELSE 0 END::int AS is_rush_hour
      FROM range(24) AS r(h))"""

BANDS = """
    bands(duration_bucket_key, bucket_label, min_seconds, max_seconds) AS (
      VALUES (1::int, '0-5 min', 0::int, 300::int), (2, '5-15 min', 300, 900), (3, '15-30 min', 900, 1800),
             (4, '30-60 min', 1800, 3600), (5, '60+ min', 3600, 999999999))"""

RUSH = "CASE WHEN time_key IN (7, 8, 9, 16, 17, 18, 19) THEN 'Rush Hour' ELSE 'Non-Rush' END"
DAY_TYPE = "CASE WHEN dayofweek(start_time) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END"


def _with(*steps: str) -> str:
    return "WITH " + ",".join(steps)


EVENTS_SILVER = (RIDES_EVENTS, _clean("silver", "rides_events"))
ORDERS_SILVER = (RIDES_ORDERS, _clean("silver", "rides_orders"))
ORDERS_FACT = _with(*ORDERS_SILVER, _first("kept", "silver"), _fact("fact", "kept"))
EVENTS_KEPT = _with(*EVENTS_SILVER, _first("kept", "silver"))

_before = f"start_time < timestamp '{BATCH_FEED_BEFORE}'"
_since = f"start_time >= timestamp '{STREAM_FEED_FROM}'"
TWO_FEEDS = _with(
    RIDES_EVENTS, _clean("stored", "rides_events", _before), _clean("arrived", "rides_events", _since),
    _first("kept", "arrived"),
)
KNOWN_AND_ARRIVED = _with(
    RIDES_EVENTS,
    _clean("known", "rides_events", f"start_time < timestamp '{STREAM_FEED_FROM}'"),
    _clean("arrived", "rides_events", _since),
)
NEW_TRIPS = f"{TWO_FEEDS} SELECT * FROM kept WHERE trip_id NOT IN (SELECT trip_id FROM stored)"

TRIPS = "count(*)::bigint AS total_trips"
SHARE = "round(count(*) / sum(count(*)) OVER (), 6) AS share"
AVG_MIN = "round(avg(trip_duration_sec) / 60, 6) AS avg_duration_min"
START_REGION, END_REGION = "substring(start_geo_key, 1, 12)", "substring(end_geo_key, 1, 12)"


def _batch_number(days: tuple[str, ...]) -> str:
    return " + ".join(["0::bigint"] + [f"(start_time >= timestamp '{day}')::bigint" for day in days])


def _top_ten(region: str, name: str) -> str:
    return f"{ORDERS_FACT} SELECT {region} AS {name}, {TRIPS} FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"


TOP_ROUTES = f"""{ORDERS_FACT}
    SELECT * FROM (SELECT {START_REGION} || ' -> ' || {END_REGION} AS route_region, {TRIPS}
                   FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) ORDER BY 1"""

RAW_COLUMNS = "trip_id, start_lat, start_lon, end_lat, end_lon, start_time, end_time, distance"
SILVER_COLUMNS = "trip_id, start_time, start_geo_hash, end_geo_hash, trip_duration_sec"

def _field(position: int) -> str:
    """A field of a landed line: NULL where the line has none, or an empty one."""
    return f"nullif(list_extract(string_split(line, ','), {position}), '')"


def _grid_cell(lat: str, lon: str, size: int) -> str:
    """A cell of the other grid, or the region of ten by ten of them."""
    return " || 'x' || ".join(f"floor(floor({x} * 100)::bigint / {size}.0)::bigint::varchar" for x in (lat, lon))


OTHER_REGIONS = _with(
    RIDES_EVENTS, f"""
    kept AS (
      SELECT * FROM rides_events WHERE {VALID}
      QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY start_time, end_time) = 1),
    regions AS (
      SELECT {_grid_cell('start_lat', 'start_lon', 10)} AS a, {_grid_cell('end_lat', 'end_lon', 10)} AS b FROM kept)""",
)

ORACLE: dict[str, str] = {
    "parse_lines": f"{_with(RIDES_EVENTS)} SELECT {RAW_COLUMNS} FROM rides_events",
    "landed_rides": f"{_with(RIDES_EVENTS)} SELECT {RAW_COLUMNS} FROM rides_events",
    "landed_text": f"""{_with(RIDES_EVENTS, RIDE_LINES)}
        SELECT {', '.join(f"{_field(k + 1)} AS {name}" for k, name in enumerate(RAW_COLUMNS.split(', ')))},
               CASE WHEN {_id_number} % 73 = 0 AND {_id_number} % 71 <> 0 THEN 'more,' END AS extra
        FROM ride_lines""",
    "silver_csv_permuted": f"{_with(*EVENTS_SILVER)} SELECT {SILVER_COLUMNS} FROM silver",
    "top_routes_other_grid": f"""{OTHER_REGIONS}
        SELECT * FROM (SELECT a || ' -> ' || b AS route_region, {TRIPS} FROM regions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
        ORDER BY 1""",
    "pct_same_region_other_grid": f"""{OTHER_REGIONS}
        SELECT round(avg(CASE WHEN a = b THEN 1 ELSE 0 END), 6) AS pct_same_region_res6 FROM regions""",
    "valid_rides": f"{_with(RIDES_EVENTS)} SELECT {RAW_COLUMNS} FROM rides_events WHERE {VALID}",
    "reject_reasons": f"""{_with(RIDES_EVENTS)}
        SELECT * FROM (
          SELECT trip_id, start_time, end_time,
                 CASE WHEN end_time <= start_time THEN 'end not after start'
                      WHEN start_lat IS NULL OR end_lon IS NULL THEN 'no coordinate' END AS reject_reason
          FROM rides_events) WHERE reject_reason IS NOT NULL""",
    "ride_duration": f"""{_with(RIDES_ORDERS)}
        SELECT trip_id, start_time, trip_duration_sec, {BAND} AS duration_bucket_key
        FROM (SELECT *, date_diff('second', start_time, end_time)::bigint AS trip_duration_sec
              FROM rides_orders)""",
    "silver_rides": f"{_with(*EVENTS_SILVER)} SELECT {SILVER_COLUMNS} FROM silver",
    "geo_cells": f"""{_with(RIDES_EVENTS)}
        SELECT start_lat, start_lon, {_cell('start_lat', 'start_lon')} AS cell,
               {_cell('start_lat', 'start_lon', 12)} AS region_cell,
               {_cell('start_lat', 'start_lon', 11)} AS district_cell
        FROM rides_events""",
    "cell_centroids": f"""{_with(*ORDERS_SILVER)}
        SELECT geo_hash, {LAT} AS lat, {LON} AS lon
        FROM (SELECT start_geo_hash AS geo_hash FROM silver UNION SELECT end_geo_hash FROM silver)""",
    "cell_parents": f"""{_with(
            RIDES_ORDERS, f'''
    points AS (SELECT start_lat AS lat, start_lon AS lon FROM rides_orders WHERE {VALID}
               UNION SELECT end_lat, end_lon FROM rides_orders WHERE {VALID})''')}
        SELECT DISTINCT {_cell('lat', 'lon')} AS geo_hash, {_cell('lat', 'lon', 12)} AS parent_geo_res6,
               {_cell('lat', 'lon', 11)} AS parent_geo_res5
        FROM points""",
    "dedup_first_rides": f"{_with(*ORDERS_SILVER, _first('kept', 'silver'))} SELECT {SILVER_COLUMNS} FROM kept",
    "new_trips_anti": NEW_TRIPS,
    "new_trips_small_batch": NEW_TRIPS,
    "silver_union": f"""{_with(
            RIDES_EVENTS, _clean('batch', 'rides_events', _before), _clean('stream', 'rides_events', _since), '''
    both_feeds AS (SELECT *, 'batch' AS source FROM batch UNION ALL SELECT *, 'stream' FROM stream)''',
            _first('kept', 'both_feeds', 'start_time, trip_duration_sec, source'))}
        SELECT {SILVER_COLUMNS}, source FROM kept""",
    "new_files": f"{_with(RIDES_EVENTS)} SELECT {RAW_COLUMNS} FROM rides_events WHERE {_since}",
    "new_content": f"{_with(RIDES_EVENTS)} SELECT {RAW_COLUMNS} FROM rides_events WHERE {_since}",
    "price_ranges": """
        WITH ranges AS (
          SELECT o_orderkey AS range_key, floor(o_totalprice)::double AS low,
                 floor(o_totalprice)::double + CASE WHEN o_orderkey % 97 = 0 THEN 5000.0::double
                                                    ELSE (o_orderkey % 40 + 1) / 2.0::double END AS high FROM orders)
        SELECT range_key, count(*)::bigint AS lines, min(l_extendedprice) AS least, max(l_extendedprice) AS most
        FROM ranges JOIN lineitem ON l_extendedprice >= low AND l_extendedprice < high GROUP BY range_key""",
    "fact_trip": f"{ORDERS_FACT} SELECT * FROM fact",
    "dim_date": f"""{ORDERS_FACT}
        SELECT {DATE_ATTRIBUTES} FROM (SELECT DISTINCT start_time::date AS d FROM fact)""",
    "dim_geography": f"""{ORDERS_FACT}
        SELECT {CELL_ATTRIBUTES}
        FROM (SELECT start_geo_key AS geo_hash FROM fact UNION SELECT end_geo_key FROM fact)""",
    "dim_time": f"""{_with(RIDES_EVENTS, HOURS)}
        SELECT hour AS time_key, hour, 0::int AS minute, period, is_rush_hour,
               (SELECT count(*) FROM rides_events WHERE hour(start_time) = hours.hour)::bigint AS rides
        FROM hours""",
    "dim_duration_bucket": f"""{_with(*EVENTS_SILVER, BANDS)}
        SELECT duration_bucket_key, bucket_label, min_seconds, max_seconds, count(trip_id)::bigint AS rides
        FROM bands LEFT JOIN silver ON trip_duration_sec >= min_seconds AND trip_duration_sec < max_seconds
        GROUP BY ALL""",
    "band_range_join": f"""{_with(*ORDERS_SILVER, BANDS)}
        SELECT bucket_label, duration_bucket_key, duration_bucket_key AS case_key, count(*)::bigint AS rides
        FROM silver LEFT JOIN bands ON trip_duration_sec >= min_seconds AND trip_duration_sec < max_seconds
        GROUP BY ALL""",
    "new_dates": f"""{KNOWN_AND_ARRIVED}
        SELECT {DATE_ATTRIBUTES}
        FROM (SELECT start_time::date AS d FROM {{arrived}} EXCEPT SELECT start_time::date FROM {{known}})""",
    "new_cells": f"""{KNOWN_AND_ARRIVED}
        SELECT {CELL_ATTRIBUTES}
        FROM ((SELECT start_geo_hash AS geo_hash FROM {{arrived}} UNION SELECT end_geo_hash FROM {{arrived}})
              EXCEPT (SELECT start_geo_hash FROM {{known}} UNION SELECT end_geo_hash FROM {{known}}))""",
    "total_trips": f"{ORDERS_FACT} SELECT {TRIPS} FROM fact",
    "count_all_sql": f"{ORDERS_FACT} SELECT {TRIPS} FROM fact",
    "avg_duration_min": f"{ORDERS_FACT} SELECT {AVG_MIN} FROM fact",
    "pct_same_region": f"{ORDERS_FACT} SELECT round(avg(is_same_cell), 6) AS pct_same_region FROM fact",
    "pct_same_region_res6": f"""{ORDERS_FACT}
        SELECT round(avg(CASE WHEN {START_REGION} = {END_REGION} THEN 1 ELSE 0 END), 6) AS pct_same_region_res6
        FROM fact""",
    "trips_by_day_name": f"{ORDERS_FACT} SELECT dayname(start_time) AS day_name, {TRIPS} FROM fact GROUP BY 1",
    "trips_by_month": f"""{ORDERS_FACT}
        SELECT monthname(start_time) AS month_name, {TRIPS} FROM fact GROUP BY 1 ORDER BY 2 DESC, 1""",
    "trips_by_day_type": f"""{ORDERS_FACT}
        SELECT {DAY_TYPE} AS day_type, {TRIPS}, {SHARE} FROM fact GROUP BY 1 ORDER BY 2 DESC, 1""",
    "trips_by_hour": f"{ORDERS_FACT} SELECT time_key AS hour, {TRIPS} FROM fact GROUP BY 1 ORDER BY 2 DESC, 1",
    "trips_by_rush": f"{ORDERS_FACT} SELECT {RUSH} AS rush_label, {TRIPS}, {SHARE} FROM fact GROUP BY 1",
    "trips_by_bucket": f"""{ORDERS_FACT}, {BANDS}
        SELECT bucket_label, {TRIPS}, {SHARE} FROM fact JOIN bands USING (duration_bucket_key) GROUP BY 1""",
    "avg_duration_by_bucket": f"""{ORDERS_FACT}, {BANDS}
        SELECT bucket_label, {AVG_MIN} FROM fact JOIN bands USING (duration_bucket_key) GROUP BY 1""",
    "trips_by_start_cell": f"""{ORDERS_FACT}
        SELECT {LON} AS start_lon, {LAT} AS start_lat, sum(trips)::bigint AS total_trips
        FROM (SELECT start_geo_key AS geo_hash, count(*) AS trips FROM fact GROUP BY 1) GROUP BY 1, 2""",
    "top_start_regions": _top_ten(START_REGION, "start_region"),
    "top_end_regions": _top_ten(END_REGION, "end_region"),
    "top_start_regions_ties": f"""{ORDERS_FACT}
        SELECT {START_REGION} AS start_region, {TRIPS} FROM fact GROUP BY 1
        QUALIFY rank() OVER (ORDER BY count(*) DESC) <= 10""",
    "top_routes": TOP_ROUTES,
    "top_routes_role_join": TOP_ROUTES,
    "pivot_day_hour": f"""{ORDERS_FACT}
        SELECT dayname(start_time) AS day_name, {', '.join(
            f"nullif(count(*) FILTER (WHERE time_key = {hour}), 0)::bigint AS h{hour:02d}" for hour in range(24))}
        FROM fact GROUP BY 1""",
    "pivot_totals": f"""{ORDERS_FACT}
        SELECT dayname(start_time) AS day_name, time_key AS hour,
               (grouping(dayname(start_time)) * 2 + grouping(time_key))::int AS level, {TRIPS}
        FROM fact GROUP BY CUBE (dayname(start_time), time_key)""",
    "heat_intensity": f"""{ORDERS_FACT}, {HOURS},
    cells AS (
      SELECT day_name, hour,
             (SELECT count(*) FROM fact WHERE dayname(start_time) = day_name AND time_key = hour)::bigint AS trips
      FROM (SELECT DISTINCT dayname(start_time) AS day_name FROM fact), hours)
        SELECT day_name, hour, trips,
               round((trips - min(trips) OVER ()) / nullif(max(trips) OVER () - min(trips) OVER (), 0), 6)
               AS intensity
        FROM cells""",
    "slice_weekend_rush": f"""{ORDERS_FACT}, {BANDS}
        SELECT bucket_label, {TRIPS}, {AVG_MIN} FROM fact JOIN bands USING (duration_bucket_key)
        WHERE {DAY_TYPE} = 'Weekend' AND {RUSH} = 'Rush Hour' AND year(start_time) >= 1998
        GROUP BY 1""",
    "slice_places": f"""{ORDERS_FACT}
        SELECT time_key AS hour, {TRIPS}, {AVG_MIN}
        FROM (SELECT *, {LON} AS lon FROM (SELECT *, start_geo_key AS geo_hash FROM fact)) AS f
        JOIN (SELECT geo_hash AS end_geo_key, {LAT} AS lat FROM (SELECT DISTINCT end_geo_key AS geo_hash FROM fact)) AS e
        ON f.end_geo_key = e.end_geo_key
        WHERE lon < -73.9 AND lat >= 40.7 GROUP BY 1""",
    "slice_wide": f"""{ORDERS_FACT}
        SELECT year(start_time)::int AS year, {TRIPS} FROM fact
        WHERE substring(start_geo_key, 1, 11) = substring(end_geo_key, 1, 11) GROUP BY 1""",
    "sql_script": f"""{ORDERS_FACT}, {HOURS}
        SELECT year(start_time)::int AS year, period || ';' AS period, {TRIPS}
        FROM fact JOIN hours ON time_key = hour GROUP BY 1, 2""",
    "export_counts": f"""{ORDERS_FACT}
        SELECT 'silver_unified_rides' AS table_name, count(*)::bigint AS row_count FROM fact
        UNION ALL SELECT 'gold_fact_trip', count(*) FROM fact
        UNION ALL SELECT 'gold_dim_date', count(DISTINCT date_key) FROM fact
        UNION ALL SELECT 'gold_dim_time', 24
        UNION ALL SELECT 'gold_dim_duration_bucket', 5
        UNION ALL SELECT 'gold_dim_geography',
          (SELECT count(*) FROM (SELECT start_geo_key FROM fact UNION SELECT end_geo_key FROM fact))""",
    "stream_silver": f"{EVENTS_KEPT} SELECT {SILVER_COLUMNS} FROM kept",
    "stream_replay_silver": f"{EVENTS_KEPT} SELECT {SILVER_COLUMNS} FROM kept",
    "stream_state_dedup": f"{EVENTS_KEPT} SELECT trip_id FROM kept",
    "stream_rejects": f"""{_with(RIDES_EVENTS)}
        SELECT trip_id, start_time, reject_reason, source, batch_id FROM (
          SELECT *, CASE WHEN end_time <= start_time THEN 'end not after start'
                         WHEN start_lat IS NULL OR end_lon IS NULL THEN 'no coordinate' END AS reject_reason
          FROM (SELECT *, 'batch-1' AS source, {_batch_number(BATCH_ARRIVALS)} AS batch_id
                FROM rides_events WHERE {_before}
                UNION ALL
                SELECT *, 'stream-1', {_batch_number(STREAM_ARRIVALS)} FROM rides_events WHERE {_since}))
        WHERE reject_reason IS NOT NULL""",
    "stream_reject_text": f"""{_with(RIDES_EVENTS, RIDE_LINES)}
        SELECT line, reject_reason, batch_id, 1::int AS has_place FROM (
          SELECT line, {_batch_number(STREAM_ARRIVALS)} AS batch_id,
                 CASE WHEN {_id_number} % 83 = 0 THEN 'no trip id' WHEN {_id_number} % 71 = 0 THEN 'no time'
                      WHEN end_time <= start_time THEN 'end not after start'
                      WHEN {_id_number} % 79 = 0 OR start_lat IS NULL OR end_lon IS NULL THEN 'no coordinate' END AS reject_reason
          FROM ride_lines)
        WHERE reject_reason IS NOT NULL""",
    "stream_state_metrics": f"""{EVENTS_KEPT},
    arrived AS (
      SELECT *, {_batch_number(STREAM_ARRIVALS)} AS batch_id FROM rides_events
      UNION ALL SELECT *, {len(STREAM_ARRIVALS) + 1}::bigint FROM rides_events),
    survivors AS (SELECT {_batch_number(STREAM_ARRIVALS)} AS batch_id, count(*) AS written FROM kept GROUP BY 1)
        SELECT count(*)::bigint AS rows_in, (count(*) - count(*) FILTER (WHERE {VALID}))::bigint AS rejected,
               (count(*) FILTER (WHERE {VALID}) - coalesce(any_value(written), 0))::bigint AS duplicates,
               coalesce(any_value(written), 0)::bigint AS written, 'state-1' AS source, batch_id
        FROM arrived LEFT JOIN survivors USING (batch_id) GROUP BY batch_id""",
    "fact_two_runs": f"""{EVENTS_KEPT}, {_fact('fact', 'kept')}
        SELECT *, CASE WHEN {_before} THEN 1 ELSE 2 END::bigint AS run_id FROM fact""",
    "dim_date_two_runs": f"""{EVENTS_KEPT}
        SELECT {DATE_ATTRIBUTES} FROM (SELECT DISTINCT start_time::date AS d FROM kept)""",
    "dim_geography_two_runs": f"""{EVENTS_KEPT}
        SELECT {CELL_ATTRIBUTES}
        FROM (SELECT start_geo_hash AS geo_hash FROM kept UNION SELECT end_geo_hash FROM kept)""",
    "star_overlapping_loads": f"""{EVENTS_KEPT}
        SELECT 'fact_trip' AS table_name, trip_id AS key, 1::bigint AS row_count FROM kept
        UNION ALL SELECT DISTINCT 'dim_date', strftime(start_time, '%Y%m%d'), 1::bigint FROM kept
        UNION ALL SELECT 'dim_geography', geo_hash, 1::bigint
        FROM (SELECT start_geo_hash AS geo_hash FROM kept UNION SELECT end_geo_hash FROM kept)""",
    "stream_capped": f"""{EVENTS_KEPT},
    arrived AS (SELECT *, {_batch_number(CAPPED_ARRIVALS)} AS batch_id FROM rides_events),
    survivors AS (SELECT {_batch_number(CAPPED_ARRIVALS)} AS batch_id, count(*) AS written FROM kept GROUP BY 1)
        SELECT count(*)::bigint AS rows_in, (count(*) - count(*) FILTER (WHERE {VALID}))::bigint AS rejected,
               (count(*) FILTER (WHERE {VALID}) - coalesce(any_value(written), 0))::bigint AS duplicates,
               coalesce(any_value(written), 0)::bigint AS written, 'capped-1' AS source, batch_id
        FROM arrived LEFT JOIN survivors USING (batch_id) GROUP BY batch_id""",
    "mart_compacted": f"""{EVENTS_KEPT}
        SELECT table_name, trip_id, 1::bigint AS row_count
        FROM kept, (VALUES ('feed'), ('unified'), ('fact_trip')) t(table_name)""",
    "stream_metrics": f"""{EVENTS_KEPT},
    feeds AS (
      SELECT *, 'batch-1' AS source, {_batch_number(BATCH_ARRIVALS)} AS batch_id FROM rides_events WHERE {_before}
      UNION ALL
      SELECT *, 'stream-1', {_batch_number(STREAM_ARRIVALS)} FROM rides_events WHERE {_since}),
    survivors AS (
      SELECT CASE WHEN {_before} THEN 'batch-1' ELSE 'stream-1' END AS source,
             CASE WHEN {_before} THEN {_batch_number(BATCH_ARRIVALS)} ELSE {_batch_number(STREAM_ARRIVALS)} END
             AS batch_id, count(*) AS written
      FROM kept GROUP BY 1, 2)
        SELECT count(*)::bigint AS rows_in, (count(*) - count(*) FILTER (WHERE {VALID}))::bigint AS rejected,
               (count(*) FILTER (WHERE {VALID}) - any_value(written))::bigint AS duplicates,
               any_value(written)::bigint AS written, source, batch_id
        FROM feeds JOIN survivors USING (source, batch_id) GROUP BY source, batch_id""",
}

# Rides kept from each side first, as the star does, before their dates and cells are compared.
_sides = {"arrived": "arrived_kept", "known": "known_kept"}
_kept = "," + ",".join(_first(kept, side) for side, kept in _sides.items())
for _name in ("new_dates", "new_cells"):
    _head, _tail = KNOWN_AND_ARRIVED, ORACLE[_name][len(KNOWN_AND_ARRIVED):]
    ORACLE[_name] = _head + _kept + _tail.format(**_sides)

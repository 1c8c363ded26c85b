"""The same queries as SQL for DuckDB, with its own parse of the same lines."""

from __future__ import annotations

LINES = """
base AS (
  SELECT *, event_id % 41 AS k, user_id % 29 AS place, epoch_us(ts) // 1000000 AS ep,
    CASE WHEN value >= 75 AND user_id % 29 <> 2 THEN 'VIP' ELSE 'PKG' END || (event_id % 1000) AS pkg
  FROM events),
fields AS (
  SELECT *,
    CASE k WHEN 1 THEN '01' WHEN 2 THEN '+1' WHEN 3 THEN '-0' WHEN 4 THEN '2'
      ELSE CASE WHEN event_type IN ('purchase', 'signup') THEN '1' ELSE '0' END END AS flag,
    CASE k WHEN 10 THEN '' ELSE 'L' || place END AS loc,
    CASE k WHEN 7 THEN '253402300800' WHEN 8 THEN '99999999999999999999' ELSE ep::VARCHAR END AS time,
    CASE k WHEN 9 THEN '2147483648' ELSE (user_id * 4)::VARCHAR END AS truck,
    CASE k WHEN 11 THEN ' ' ELSE pkg END AS package,
    CASE k WHEN 5 THEN chr(9) || ',' || chr(9) ELSE ', ' END AS sep
  FROM base),
lines AS (
  SELECT event_id, ts, CASE
    WHEN event_type = 'error' THEN
      CASE event_id % 4 WHEN 1 THEN ',,,' WHEN 2 THEN '' WHEN 3 THEN '1, L3, 17, x4, P' ELSE 'no record here' END
    WHEN value < 10 THEN flag || sep || loc || sep || time || sep || truck || '######'
    ELSE flag || sep || loc || sep || time || sep || truck || sep || package || CASE k WHEN 6 THEN ',,' ELSE '' END
    END AS line
  FROM fields),
pieces AS (
  SELECT *, list_transform(string_split(rtrim(line, ','), ','),
    lambda x: trim(x, array_to_string(list_transform(range(1, 33), lambda c: chr(c::INTEGER)), ''))) AS p
  FROM lines),
numbers AS (
  SELECT *,
    CASE WHEN regexp_full_match(p[1], '[+-]?[0-9]+') THEN TRY_CAST(ltrim(p[1], '+') AS INTEGER) END AS f,
    CASE WHEN regexp_full_match(p[3], '[+-]?[0-9]+') THEN TRY_CAST(p[3] AS BIGINT) END AS e,
    CASE WHEN regexp_full_match(p[4], '[+-]?[0-9]+') THEN TRY_CAST(p[4] AS INTEGER) END AS t
  FROM pieces),
checked AS (
  SELECT *, coalesce(len(p) = 5 AND f IN (0, 1) AND t IS NOT NULL
    AND e BETWEEN -62135596800 AND 253402300799, false) AS ok
  FROM numbers),
act AS (
  SELECT f = 1 AS is_arrival, p[2] AS location, e AS event_epoch, t AS truck_id,
    p[5] AS package_id
  FROM checked WHERE ok)
"""

LEGACY = """
old AS (
  SELECT event_id % 17 AS m, CASE event_id % 17 WHEN 3 THEN '253402300800' ELSE ep::VARCHAR END || ', ' ||
    CASE event_id % 17 WHEN 2 THEN '2147483648' ELSE (user_id * 4)::VARCHAR END ||
    CASE event_id % 17 WHEN 0 THEN '' WHEN 1 THEN ', ' || pkg || ', more' ELSE ', ' || pkg END AS line,
    ep, user_id, pkg
  FROM base),
legacy AS (
  SELECT false AS is_arrival, 'AR' AS location, ep AS event_epoch, (user_id * 4)::INTEGER AS truck_id, pkg AS package_id
  FROM old WHERE m > 3),
both_logs AS (SELECT * FROM act UNION ALL SELECT * FROM legacy)
"""

CALLS = """
rung AS (
  SELECT CASE WHEN place = 0 THEN 'C0' ELSE 'L' || place END AS loc, ep,
    CASE WHEN place = 1 OR event_id % 13 = 0 THEN '' WHEN event_id % 13 = 1 THEN ' soon'
      WHEN event_id % 13 = 2 THEN ' 99999999999999999999' END AS broken
  FROM base WHERE event_type = 'error'),
calls AS (SELECT loc AS location, ep AS call_epoch FROM rung WHERE broken IS NULL),
called AS (SELECT location, count(*) AS calls FROM calls GROUP BY location),
names AS (
  SELECT 'L' || n_nationkey AS location, n_name AS name FROM nation
  WHERE n_nationkey <> 3 AND n_name IS NOT NULL),
totals AS (
  SELECT location, count(*) AS events, count(*) FILTER (WHERE is_arrival) AS arrivals
  FROM act GROUP BY location),
joined AS (
  SELECT location, coalesce(events, 0) AS events, coalesce(arrivals, 0) AS arrivals,
    coalesce(calls, 0) AS calls, name
  FROM totals FULL OUTER JOIN called USING (location) LEFT JOIN names USING (location))
"""

REPORT = """
report AS (
  SELECT location, 0 AS section, concat(location, repeat('*', 10)) AS line FROM joined
  UNION ALL SELECT location, 1, concat('Location: ', coalesce(name, 'null')) FROM joined
  UNION ALL SELECT location, 2, concat('Total # Support Calls: ', calls) FROM joined
  UNION ALL SELECT location, 3,
    concat(CASE WHEN is_arrival THEN 'Arrived: ' ELSE 'Departed: ' END, package_id) FROM act
  UNION ALL SELECT location, 4, concat('End ', location, repeat('*', 6)) FROM joined)
"""

# Name -> (blocks after LINES, final SELECT).
_TAILS: dict[str, tuple[list[str], str]] = {
    "parse_activity": ([], "SELECT * FROM act"),
    "parse_legacy_activity": ([LEGACY], "SELECT * FROM legacy"),
    "rejected_lines": (
        [],
        """SELECT line AS value, CASE WHEN coalesce(len(p) <> 5 OR NOT regexp_full_match(p[1], '[+-]?[0-9]+')
             OR NOT regexp_full_match(p[3], '[+-]?[0-9]+')
             OR NOT regexp_full_match(p[4], '[+-]?[0-9]+'), true)
             THEN 'malformed' WHEN coalesce(f NOT IN (0, 1), true) THEN 'flag'
             WHEN coalesce(e NOT BETWEEN -62135596800 AND 253402300799, true) THEN 'time range'
             ELSE 'truck range' END AS reject_reason
           FROM checked WHERE NOT ok""",
    ),
    "rejected_other_lines": (
        [LEGACY, CALLS],
        """SELECT 'legacy' AS log, line AS value,
             CASE m WHEN 3 THEN 'time range' WHEN 2 THEN 'truck range' ELSE 'malformed' END AS reject_reason
           FROM old WHERE m <= 3
           UNION ALL SELECT 'calls', loc || broken, CASE WHEN broken LIKE ' 9%' THEN 'time range' ELSE 'malformed' END
           FROM rung WHERE broken IS NOT NULL
           UNION ALL SELECT 'names', 'L3', 'malformed' FROM nation WHERE n_nationkey = 3""",
    ),
    "invalid_line_metric": (
        [],
        "SELECT count(*) FILTER (WHERE NOT ok) AS invalid, count(*) FILTER (WHERE ok) AS written FROM checked",
    ),
    "invalid_line_count": ([], "SELECT count(*) FILTER (WHERE NOT ok) AS n FROM checked"),
    "parse_support_calls": ([CALLS], "SELECT location, call_epoch FROM calls"),
    "parse_location_names": ([CALLS], "SELECT location, name FROM names"),
    "arrivals_table": (
        [],
        """SELECT package_id AS "packageId", location, truck_id AS "truckId", event_epoch
           FROM act WHERE is_arrival""",
    ),
    "vip_activity": ([], "SELECT * FROM act WHERE starts_with(package_id, 'VIP')"),
    "activity_text": (
        [],
        """SELECT concat('PackageActivityInfo [isArrival=', is_arrival, ', location=', location,
             ', packageId=', package_id, ']') AS line FROM act""",
    ),
    "activity_epoch_millis": ([], "SELECT location, package_id, event_epoch * 1000 AS event_millis FROM act"),
    "par_do_tags": (
        [],
        """SELECT package_id, 'arrival' AS tag FROM act WHERE is_arrival
           UNION ALL SELECT package_id, 'vip' FROM act WHERE starts_with(package_id, 'VIP')""",
    ),
    "count_per_location": ([], "SELECT location, count(*) AS n FROM act GROUP BY location"),
    "count_text": ([], "SELECT concat(location, ': ', count(*)) AS line FROM act GROUP BY location"),
    "unique_vip_per_location": (
        [],
        """SELECT location,
             count(DISTINCT package_id) FILTER (WHERE starts_with(package_id, 'VIP')) AS n
           FROM act GROUP BY location""",
    ),
    "vip_count_per_location": (
        [],
        """SELECT location, count(*) AS n FROM act WHERE starts_with(package_id, 'VIP')
           GROUP BY location""",
    ),
    "mean_vip_per_location": (
        [],
        """SELECT avg(n) AS mean FROM (SELECT count(*) AS n FROM act
           WHERE starts_with(package_id, 'VIP') GROUP BY location)""",
    ),
    "packages_per_truck": (
        [],
        "SELECT truck_id, package_id, count(*) AS copies FROM act GROUP BY truck_id, package_id",
    ),
    "packages_per_truck_text": ([], "SELECT concat(truck_id, ': ', package_id) AS line FROM act"),
    "support_calls_per_location": ([CALLS], "SELECT location, calls AS n FROM called"),
    "union_with_legacy": ([LEGACY], "SELECT * FROM both_logs"),
    "partition_old_new": (
        [LEGACY],
        "SELECT *, CASE WHEN truck_id < 200 THEN 0 ELSE 1 END AS part FROM both_logs",
    ),
    "partitions_from_one_pass": ([LEGACY], "SELECT *, (truck_id % 16 // 4)::INTEGER AS part FROM both_logs"),
    "hourly_counts": (
        [],
        """SELECT event_epoch // 3600 * 3600 AS hour_epoch, count(*) AS n FROM act GROUP BY 1""",
    ),
    "hourly_counts_half_hour_zone": (
        [],
        """SELECT (event_epoch + 19800) // 3600 * 3600 - 19800 AS hour_epoch, count(*) AS n
           FROM act GROUP BY 1""",
    ),
    "hourly_count_text": (
        [],
        """SELECT concat(strftime(make_timestamp(h * 1000000), '%a %b %d %H:%M:%S UTC %Y'), ': ', n) AS line
           FROM (SELECT event_epoch // 3600 * 3600 AS h, count(*) AS n FROM act GROUP BY 1)""",
    ),
    "hourly_count_text_half_hour_zone": (
        [],
        """SELECT concat(strftime(make_timestamp(h * 1000000), '%a %b %d %H:%M:%S IST %Y'), ': ', n) AS line
           FROM (SELECT (event_epoch + 19800) // 3600 * 3600 AS h, count(*) AS n FROM act GROUP BY 1)""",
    ),
    "windowed_counts_60m": (
        [],
        """SELECT location, event_epoch // 3600 * 3600 AS window_epoch, count(*) AS n
           FROM act GROUP BY 1, 2""",
    ),
    "windowed_counts_1m": (
        [],
        """SELECT location, event_epoch // 60 * 60 AS window_epoch, count(*) AS n
           FROM act GROUP BY 1, 2""",
    ),
    "windowed_count_text": (
        [],
        """SELECT concat(location, ': ', n, ' ',
             strftime(make_timestamp(w * 1000000), '%Y-%m-%dT%H:%M:%S'), '.000Z') AS line
           FROM (SELECT location, event_epoch // 3600 * 3600 AS w, count(*) AS n
                 FROM act GROUP BY 1, 2)""",
    ),
    "activity_with_location_name": (
        [CALLS],
        "SELECT act.*, name FROM act LEFT JOIN names USING (location)",
    ),
    "location_activity_with_calls": ([CALLS], "SELECT * FROM joined"),
    "activity_numbered_with_calls": (
        [
            CALLS,
            """bag AS (
                 SELECT location, call_epoch AS secs, 0 AS side, NULL AS package_id, NULL AS truck_id, NULL AS is_arrival FROM calls
                 UNION ALL SELECT location, event_epoch, 1, package_id, truck_id, is_arrival FROM act),
               numbered AS (SELECT *, (sum(side) OVER w)::BIGINT AS number, (sum(1 - side) OVER w)::BIGINT AS calls_so_far FROM bag
                 WINDOW w AS (PARTITION BY location ORDER BY secs, side, package_id, truck_id, is_arrival ROWS UNBOUNDED PRECEDING))""",
        ],
        """SELECT is_arrival, location, secs AS event_epoch, truck_id, package_id, number, calls_so_far FROM numbered WHERE side = 1""",
    ),
    "location_report_lines": ([CALLS, REPORT], "SELECT * FROM report"),
    "location_report_text": ([CALLS, REPORT], "SELECT line FROM report"),
    "location_files": (
        [CALLS],
        """SELECT location, calls AS n, name || ' Warehouse' AS name
           FROM called LEFT JOIN names USING (location)""",
    ),
    "count_table_append": (
        [],
        """SELECT location, count(*) AS count, event_epoch // w * w AS window_epoch
           FROM act CROSS JOIN (VALUES (3600), (60)) AS widths(w) GROUP BY location, w, 3""",
    ),
    "records_and_rejects_text": (
        [],
        """SELECT ok::VARCHAR AS ok, CASE WHEN ok THEN concat('PackageActivityInfo [isArrival=', f = 1, ', location=', p[2],
             ', packageId=', p[5], ']') ELSE line END AS line FROM checked""",
    ),
    "old_new_text": (
        [LEGACY],
        """SELECT CASE WHEN truck_id < 200 THEN 0 ELSE 1 END AS part, concat('PackageActivityInfo [isArrival=', is_arrival,
             ', location=', location, ', packageId=', package_id, ']') AS line FROM both_logs""",
    ),
    "routed_lines": ([], "SELECT ok::VARCHAR AS ok, line AS value FROM checked"),
    "several_sinks": (
        [
            """vips AS (SELECT location, count(*) AS n FROM act
                 WHERE starts_with(package_id, 'VIP') GROUP BY location)"""
        ],
        """SELECT concat(location, ': ', n) AS line, NULL::DOUBLE AS mean FROM vips
           UNION ALL SELECT 'mean', avg(n) FROM vips""",
    ),
    "stream_counts_1m_append": (
        [],
        """SELECT location, w AS window_epoch, n FROM (
             SELECT location, event_epoch // 60 * 60 AS w, count(*) AS n FROM act GROUP BY 1, 2)
           WHERE w + 60 <= (SELECT max(event_epoch) FROM act) - 5""",
    ),
    "stream_open_windows": (
        [],
        """SELECT location, w AS window_epoch, n FROM (
             SELECT location, event_epoch // 60 * 60 AS w, count(*) AS n FROM act GROUP BY 1, 2)
           WHERE w + 60 > (SELECT max(event_epoch) FROM act) - 5""",
    ),
    "stream_metrics": (
        [
            """half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half_at FROM events),
               lots AS (SELECT e // 60 * 60 AS w, e, ok, (ts < half_at AND event_id % 10 <> 0) AS early FROM checked, half),
               seen AS (SELECT max(e) FILTER (WHERE early AND ok) - 5 AS first FROM lots)"""
        ],
        """SELECT CASE WHEN early THEN 1 ELSE 2 END AS lot, count(*) AS lines, count(*) FILTER (WHERE NOT ok) AS invalid,
             bool_or(ok AND NOT early AND w + 60 <= first) AS late
           FROM lots, seen GROUP BY early""",
    ),
    "stream_counts_late": (
        [
            """half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half_at FROM events),
               lots AS (SELECT p[2] AS location, e, e // 60 * 60 AS w, (ts < half_at AND event_id % 10 <> 0) AS early
                 FROM checked, half WHERE ok),
               seen AS (SELECT max(e) FILTER (WHERE early) - 5 AS first, max(e) - 5 AS last FROM lots)"""
        ],
        """SELECT location, w AS window_epoch, count(*) AS n FROM lots, seen
           WHERE (early OR w + 60 > first) AND w + 60 <= last GROUP BY 1, 2""",
    ),
}

# Written and read back, or computed another way: the rows are those of the query named.
_SAME_ROWS = {
    "text_log_files": "parse_activity",
    "legacy_log_files": "parse_legacy_activity",
    "activity_text_files": "activity_text",
    "record_files": "parse_activity",
    "package_table_truncate": "arrivals_table",
    "package_table_replaced": "arrivals_table",
    "stream_counts_resumed": "stream_counts_1m_append",
    "stream_counts_replayed": "stream_counts_1m_append",
    "stream_counts_by_clock": "windowed_counts_1m",
}


def oracle_sql() -> dict[str, str]:
    tails = _TAILS | {name: _TAILS[same] for name, same in _SAME_ROWS.items()}
    return {
        name: "WITH " + ",".join([LINES, *blocks]) + select
        for name, (blocks, select) in tails.items()
    }

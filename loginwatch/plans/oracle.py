"""DuckDB SQL for the registered queries, over the same Parquet tables.

Written from the semantics, mostly in another shape than the Spark plans: the tests and
the driver compare both. ``_VIEWS`` are common table expressions in dependency order;
each query is prefixed with the ones it needs.
"""

from __future__ import annotations

import ipaddress
import re

from loginwatch.plans import queries
from loginwatch.sources import demo, reference
from loginwatch.sources.demo import DEMO_CONFIG as CFG

_START = f"DATE '{CFG.detection_start}'"
_BASE_END = f"DATE '{CFG.baseline_end}'"
_ASOF = f"TIMESTAMP '{queries.ASOF:%Y-%m-%d %H:%M:%S}'"
_SINCE = f"({_ASOF} - INTERVAL {queries.LOOKBACK.days} DAY)"
_SPLIT = f"({_ASOF} - INTERVAL {queries.SPLIT_AGE.days} DAY)"


def _values(rows: list[tuple]) -> str:
    def literal(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _numbered_ranges() -> list[tuple]:
    rows = []
    for _, cidr, *intel in reference.IP_RANGES + demo.EXTRA_RANGES:
        try:
            net = ipaddress.ip_network(cidr, strict=False)
        except ValueError:
            continue
        rows.append((net.version, str(int(net.network_address)), str(int(net.broadcast_address)), cidr, *intel))
    return rows


def _account(n: str) -> str:
    return f"CASE WHEN {n} % 37 = 36 THEN 'svc_' ELSE 'U' END || lpad(CAST({n} AS VARCHAR), 6, '0')"


def _stamp(d: str, t: str) -> str:
    return f"CAST({d} AS VARCHAR) || ' ' || {t}"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


_VIEWS: dict[str, str] = {
    # Demo tables
    "origin": f"""
        SELECT event_id, {_account('user_id')} AS username, CAST(ts AS DATE) AS login_date,
               strftime(ts, '%H:%M:%S') AS login_time,
               CASE WHEN k < 70 THEN 'US' WHEN k < 82 THEN 'CA' WHEN k < 90 THEN 'DE'
                    WHEN k < 95 THEN 'CN' ELSE 'RU' END AS country,
               CASE WHEN event_type = 'error' THEN 0
                    WHEN user_id % 11 = 10 AND CAST(ts AS DATE) < {_START} THEN 0 ELSE 1 END AS success,
               CASE WHEN k = 93 THEN NULL WHEN k = 94 THEN '2001:db8::' || (user_id % 16)
                    WHEN event_type = 'error' OR k = 92 THEN '45.33.32.' || (user_id % 4)
                    WHEN k >= 95 THEN '185.220.101.' || (k % 7)
                    ELSE '10.' || (user_id % 8) || '.1.' || (user_id % 50) END AS source_ip,
               user_id AS n, k, date_trunc('second', ts) AS ts,
               CAST(date_part('hour', ts) AS INTEGER) AS login_hour
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "logins": """
        SELECT event_id, username, login_date, login_time, country, success, source_ip, ts, login_hour
        FROM origin""",
    "people": f"""
        SELECT {_account('c_custkey')} AS employee_id,
               split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'IT Security'
                    WHEN 'HOUSEHOLD' THEN 'IT Infrastructure' ELSE c_mktsegment END AS department,
               CASE WHEN c_custkey % 43 = 42 THEN NULL WHEN c_custkey % 7 = 6 THEN 'Terminated'
                    WHEN c_custkey % 41 = 40 THEN 'On Leave' ELSE 'Active' END AS status,
               c_custkey
        FROM customer""",
    "devices": f"""
        SELECT 'DEV-' || o_orderkey AS device_id,
               CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'X' || o_orderkey
                    ELSE {_account('own')} END AS employee_id,
               o_orderpriority AS operating_system, CAST(o_orderdate AS DATE) AS os_patch_date, o_orderkey
        FROM (SELECT *, CASE WHEN o_custkey % 10 = 9 THEN o_custkey - 1 ELSE o_custkey END AS own FROM orders)""",
    "devices_backup": f"""
        SELECT CASE WHEN o_orderkey % 53 = 52 THEN 'OLD-' ELSE 'DEV-' END || o_orderkey AS device_id,
               CASE WHEN o_orderkey % 50 = 0 THEN {_account('(own + 1)')} ELSE {_account('own')} END AS employee_id
        FROM (SELECT *, CASE WHEN o_custkey % 10 = 9 THEN o_custkey - 1 ELSE o_custkey END AS own FROM orders)""",
    "feed": f"""
        SELECT * FROM (VALUES {_values(reference.IP_RANGES)})
            AS f(ip_prefix, cidr, is_malicious, confidence, source, tags)""",
    # Ranges as whole numbers, by Python's own address module; rows that are no range are left out.
    "listed": f"""
        SELECT * FROM (VALUES {_values(_numbered_ranges())})
            AS f(family, low, high, cidr, is_malicious, confidence, source, tags)""",
    "spots": """
        SELECT source_ip, CASE WHEN contains(source_ip, ':') THEN 6 ELSE 4 END AS family,
               CASE WHEN contains(source_ip, ':')
                    THEN CAST('42540766411282592856903984951653826560' AS HUGEINT)
                         + list_sum([(strpos('0123456789abcdef', c) - 1) * CAST(power(16, length(tail) - i) AS BIGINT)
                                     FOR c, i IN string_split(tail, '')])
                    ELSE CAST(list_sum([CAST(o AS BIGINT) * CAST(power(256, 4 - i) AS BIGINT)
                                        FOR o, i IN string_split(source_ip, '.')]) AS HUGEINT) END AS number
        FROM (SELECT DISTINCT source_ip, split_part(source_ip, '::', 2) AS tail FROM logins WHERE source_ip IS NOT NULL)""",
    "matched": """
        SELECT s.source_ip, f.cidr, f.is_malicious, f.confidence, f.source, f.tags
        FROM spots s JOIN listed f ON f.family = s.family AND s.number BETWEEN CAST(f.low AS HUGEINT) AND CAST(f.high AS HUGEINT)""",
    "km": f"SELECT * FROM (VALUES {_values(reference.COUNTRY_DISTANCES)}) AS d(country_a, country_b, distance_km)",
    "excused": f"SELECT * FROM (VALUES {_values(reference.TRAVEL_EXCEPTIONS)}) AS x(country_a, country_b, rationale)",
    "centroid": "SELECT * FROM (VALUES " + _values(
        [(c, lat, lon) for c, (lat, lon) in reference.CENTROIDS.items()]
    ) + ") AS c(country, lat, lon)",
    "truth": f"""
        SELECT event_id, CAST(is_malicious AS INTEGER) AS is_malicious, anomaly_class,
               CAST(is_anchor AS INTEGER) AS is_anchor, campaign_id, 'demo ' || anomaly_class AS notes
        FROM (
            SELECT event_id, 1 AS is_malicious, 'unfamiliar_country' AS anomaly_class,
                   CASE WHEN k >= 97 THEN 1 ELSE 0 END AS is_anchor, CAST(NULL AS VARCHAR) AS campaign_id
            FROM origin WHERE success = 1 AND login_date >= {_START} AND k BETWEEN 90 AND 99
            UNION ALL SELECT event_id, 1, 'impossible_travel', 1, NULL FROM origin
            WHERE success = 1 AND login_date >= {_START} AND k IN (91, 97, 99)
            UNION ALL SELECT event_id, 1, 'after_hours', 1, NULL FROM origin
            WHERE success = 1 AND login_date >= {_START} AND k >= 95 AND login_hour = 3
            UNION ALL SELECT event_id, 1, 'brute_force_success', 1, NULL FROM origin
            WHERE success = 1 AND login_date >= {_START} AND k % 20 = 19
            UNION ALL SELECT event_id, 1, 'brute_force_failed', 0, 'bf-' || username || '-' || login_date
            FROM origin WHERE success = 0 AND login_date >= {_START} AND starts_with(source_ip, '45.33.32.') AND n % 3 = 0
            UNION ALL SELECT event_id, 1, 'password_spray', 0, 'spray-' || source_ip || '-' || login_date
            FROM origin WHERE success = 0 AND login_date >= {_START} AND starts_with(source_ip, '45.33.32.') AND n % 4 <> 2
            UNION ALL SELECT event_id, 1, 'terminated_account', 1, NULL FROM origin WHERE n % 7 = 6
            UNION ALL SELECT event_id, 0, 'benign_no_baseline', 0, NULL FROM origin WHERE k = 50
        )""",
    "asset_truth": f"""
        SELECT device_id AS asset_id, 'orphan_device' AS anomaly_class FROM devices WHERE o_orderkey % 97 = 0
        UNION ALL SELECT device_id, 'inventory_mismatch' FROM devices WHERE o_orderkey % 150 = 0
        UNION ALL SELECT device_id, 'critical_patch_age' FROM devices WHERE os_patch_date < DATE '2000-01-01'
        UNION ALL SELECT employee_id, 'user_without_device' FROM people WHERE c_custkey % 10 = 9""",
    # Baselines
    "wins": "SELECT * FROM logins WHERE success = 1",
    "known": f"""
        SELECT username, string_agg(country, ',' ORDER BY country) AS known_countries,
               count(*) AS country_count, list(country) AS known_list
        FROM (SELECT DISTINCT username, country FROM wins WHERE login_date < {_BASE_END}) GROUP BY username""",
    "user_hours": f"""
        SELECT username, count(*) AS baseline_logins, min(login_hour) AS min_hour, max(login_hour) AS max_hour
        FROM wins WHERE login_date < {_BASE_END} GROUP BY username""",
    "dept_hours": f"""
        SELECT p.department, count(*) AS baseline_logins, min(w.login_hour) AS min_hour, max(w.login_hour) AS max_hour
        FROM wins w JOIN people p ON p.employee_id = w.username
        WHERE w.login_date < {_BASE_END} AND NOT w.username ILIKE 'svc_%' GROUP BY p.department""",
    "windows": f"""
        SELECT employee_id AS username, tier AS baseline_source,
               CAST(CASE tier WHEN 'user' THEN u_min - {CFG.hour_tolerance} WHEN 'department' THEN d_min - {CFG.hour_tolerance} ELSE 6 END AS INTEGER) AS window_start,
               CAST(CASE tier WHEN 'user' THEN u_max + {CFG.hour_tolerance} WHEN 'department' THEN d_max + {CFG.hour_tolerance} ELSE 20 END AS INTEGER) AS window_end
        FROM (SELECT p.employee_id, u.min_hour AS u_min, u.max_hour AS u_max, d.min_hour AS d_min, d.max_hour AS d_max,
                     CASE WHEN u.baseline_logins >= {CFG.hour_baseline_min_samples} THEN 'user'
                          WHEN d.baseline_logins >= {CFG.hour_baseline_min_samples} THEN 'department'
                          ELSE 'global-default' END AS tier
              FROM people p LEFT JOIN user_hours u ON u.username = p.employee_id
                            LEFT JOIN dept_hours d ON d.department = p.department)""",
    "patches": f"""
        SELECT d.device_id, d.employee_id, p.full_name AS owner_name, p.department, d.operating_system,
               CAST(d.os_patch_date AS VARCHAR) AS os_patch_date,
               CAST(DATE '{CFG.asof_date}' - d.os_patch_date AS INTEGER) AS days_since_patch,
               CASE WHEN DATE '{CFG.asof_date}' - d.os_patch_date > 180 THEN 'CRITICAL'
                    WHEN DATE '{CFG.asof_date}' - d.os_patch_date > 90 THEN 'WARNING' ELSE 'OK' END AS patch_risk
        FROM devices d LEFT JOIN people p USING (employee_id)""",
    # Detections
    "det_unfamiliar": f"""
        SELECT w.event_id, w.username, p.full_name AS user_name, p.department,
               {_stamp('w.login_date', 'w.login_time')} AS timestamp, w.country AS anomaly_country,
               b.known_countries AS baseline_countries, w.source_ip,
               CASE WHEN b.username IS NULL THEN 'no_baseline' ELSE 'baseline' END AS baseline_state,
               CASE WHEN w.country IN ('RU', 'CN', 'KP', 'IR') THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               CASE WHEN b.username IS NULL
                    THEN 'No geographic baseline (new or dormant account): first observed success from ' || w.country
                    ELSE 'Unfamiliar login location: ' || w.country || ' not in baseline [' || b.known_countries || ']'
               END AS reason
        FROM (SELECT *, min(ts) OVER (PARTITION BY username) AS debut FROM wins) w
        LEFT JOIN known b USING (username) LEFT JOIN people p ON p.employee_id = w.username
        WHERE w.login_date >= {_START}
          AND CASE WHEN b.username IS NULL THEN w.ts = w.debut ELSE NOT list_contains(b.known_list, w.country) END""",
    "legs": """
        SELECT *, lag(event_id) OVER o AS p_id, lag(country) OVER o AS p_country, lag(ts) OVER o AS p_ts,
               lag(source_ip) OVER o AS p_ip, lag(login_date) OVER o AS p_date, lag(login_time) OVER o AS p_time
        FROM wins WINDOW o AS (PARTITION BY username ORDER BY ts, event_id)""",
    "det_travel": f"""
        SELECT event_id, p_id AS prev_event_id, username, full_name AS user_name, department,
               {_stamp('p_date', 'p_time')} AS timestamp_1, p_country AS country_1, p_ip AS ip_1,
               {_stamp('login_date', 'login_time')} AS timestamp_2, country AS country_2, source_ip AS ip_2,
               hours_apart, distance_km, required_kmh,
               CASE WHEN rationale IS NULL THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               'Impossible travel: ' || p_country || ' -> ' || country || ' in ' || hours_apart || 'h requires ~'
                   || required_kmh || ' km/h (gate: {CFG.speed_text()} km/h)'
                   || coalesce(' [exception: ' || rationale || ']', '') AS reason
        FROM (SELECT l.*, k.distance_km, x.rationale, p.full_name, p.department,
                     round(h, 1) AS hours_apart, k.distance_km / greatest(h, 1.0 / 60) AS kmh,
                     CAST(round(k.distance_km / greatest(h, 1.0 / 60)) AS INTEGER) AS required_kmh
              FROM (SELECT *, (epoch(ts) - epoch(p_ts)) / 3600 AS h FROM legs
                    WHERE country <> p_country AND login_date >= {_START}) l
              JOIN km k ON k.country_a = least(l.country, l.p_country) AND k.country_b = greatest(l.country, l.p_country)
              LEFT JOIN excused x ON x.country_a = k.country_a AND x.country_b = k.country_b
              LEFT JOIN people p ON p.employee_id = l.username)
        WHERE kmh > {CFG.max_travel_speed_kmh}""",
    "det_hours": f"""
        SELECT w.event_id, w.username, p.full_name AS user_name, p.department,
               {_stamp('w.login_date', 'w.login_time')} AS timestamp, w.login_hour, w.country, w.source_ip,
               o.baseline_source, o.window_start, o.window_end,
               CASE WHEN p.department LIKE 'IT %' THEN 'LOW' ELSE 'MEDIUM' END AS severity,
               'Login at ' || w.login_time || ' UTC outside ' || o.baseline_source || ' hour window ['
                   || o.window_start || ':00-' || o.window_end || ':59]' AS reason
        FROM wins w JOIN people p ON p.employee_id = w.username JOIN windows o USING (username)
        WHERE w.login_date >= {_START} AND NOT w.username ILIKE 'svc_%'
          AND w.login_hour NOT BETWEEN o.window_start AND o.window_end""",
    "win_points": """
        SELECT username, ts, lag(ts) OVER (PARTITION BY username ORDER BY ts) AS earlier
        FROM (SELECT DISTINCT username, ts FROM wins)""",
    "det_guess": f"""
        SELECT s.event_id, s.username, p.full_name AS user_name, p.department,
               {_text('r.first_ts')} AS first_failure, {_stamp('s.login_date', 's.login_time')} AS success_time,
               r.failure_count, s.source_ip AS success_ip, 'HIGH' AS severity,
               'Brute force: ' || r.failure_count || ' uninterrupted failures within {CFG.bf_window_minutes} min preceding success from '
                   || s.source_ip AS reason
        FROM (SELECT q.username, q.ts, count(*) AS failure_count, min(f.ts) AS first_ts
              FROM win_points q JOIN logins f ON f.username = q.username AND f.success = 0
               AND f.ts BETWEEN greatest(coalesce(q.earlier, q.ts - INTERVAL {CFG.bf_window_minutes} MINUTE),
                                         q.ts - INTERVAL {CFG.bf_window_minutes} MINUTE) AND q.ts
              GROUP BY q.username, q.ts HAVING count(*) >= {CFG.bf_min_failures}) r
        JOIN wins s USING (username, ts) LEFT JOIN people p ON p.employee_id = s.username
        WHERE s.login_date >= {_START}""",
    "det_spray": f"""
        SELECT source_ip, login_date, accounts_targeted, total_failures, successes, CAST(0 AS BIGINT) AS page, usernames,
               first_attempt, last_attempt, source_ip || '|' || login_date AS campaign_key,
               CASE WHEN successes > 0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               'Password spray: ' || accounts_targeted || ' accounts, ' || total_failures || ' failures from '
                   || source_ip || ' on ' || login_date
                   || CASE WHEN successes > 0 THEN ' - INCLUDES ' || successes || ' SUCCESS(ES)' ELSE '' END AS reason
        FROM (SELECT source_ip, login_date, count(DISTINCT username) FILTER (WHERE success = 0) AS accounts_targeted,
                     count(*) FILTER (WHERE success = 0) AS total_failures, CAST(sum(success) AS BIGINT) AS successes,
                     string_agg(DISTINCT username, ',' ORDER BY username) AS usernames,
                     min(login_time) AS first_attempt, max(login_time) AS last_attempt
              FROM logins WHERE login_date >= {_START} GROUP BY source_ip, login_date)
        WHERE accounts_targeted >= {CFG.spray_min_accounts}""",
    "det_failed": f"""
        SELECT g.username, p.full_name AS user_name, p.department, g.login_date, g.source_ip, g.failure_count,
               g.first_attempt, g.last_attempt,
               g.username || '|' || g.source_ip || '|' || g.login_date AS campaign_key, 'MEDIUM' AS severity,
               'Failed brute force: ' || g.failure_count || ' failures on one account from ' || g.source_ip
                   || ' on ' || g.login_date || ', no success from that source' AS reason
        FROM (SELECT username, source_ip, login_date, count(*) AS failure_count,
                     min(login_time) AS first_attempt, max(login_time) AS last_attempt
              FROM logins WHERE success = 0 AND login_date >= {_START} GROUP BY ALL
              HAVING count(*) >= {CFG.bf_failed_min_failures}) g
        ANTI JOIN wins w ON w.username = g.username AND w.source_ip = g.source_ip AND w.login_date = g.login_date
        LEFT JOIN people p ON p.employee_id = g.username""",
    "det_inactive": f"""
        SELECT l.event_id, l.username, p.full_name AS user_name, p.department, p.status AS account_status,
               {_stamp('l.login_date', 'l.login_time')} AS timestamp, l.country, l.source_ip,
               CASE l.success WHEN 1 THEN 'SUCCESS' ELSE 'FAILED' END AS outcome, 'HIGH' AS severity,
               CASE l.success WHEN 1 THEN 'CRITICAL: Successful login on ' ELSE 'Login attempt on ' END
                   || p.status || ' account from ' || l.country AS reason
        FROM logins l JOIN people p ON p.employee_id = l.username WHERE p.status <> 'Active'""",
    # Triage
    "findings": f"""
        SELECT 1 AS rule_no, 'UNFAMILIAR_COUNTRY' AS detection_type, event_id, CAST(NULL AS VARCHAR) AS campaign_key,
               username, user_name, department, timestamp, source_ip, severity, 'T1078' AS mitre_technique, reason
        FROM det_unfamiliar
        UNION ALL SELECT 2, 'IMPOSSIBLE_TRAVEL', event_id, NULL, username, user_name, department, timestamp_2, ip_2,
               severity, 'T1078', reason FROM det_travel
        UNION ALL SELECT 3, 'AFTER_HOURS', event_id, NULL, username, user_name, department, timestamp, source_ip,
               severity, 'T1078', reason FROM det_hours
        UNION ALL SELECT 4, 'BRUTE_FORCE', event_id, NULL, username, user_name, department, success_time, success_ip,
               severity, 'T1110.001', reason FROM det_guess
        UNION ALL SELECT 5, 'PASSWORD_SPRAY', NULL, campaign_key, NULL, NULL, NULL,
               {_stamp('login_date', 'first_attempt')}, source_ip, severity, 'T1110.003', reason FROM det_spray
        UNION ALL SELECT 6, 'BRUTEFORCE_FAILED', NULL, campaign_key, username, user_name, department,
               {_stamp('login_date', 'first_attempt')}, source_ip, severity, 'T1110.001', reason FROM det_failed
        UNION ALL SELECT 7, 'INACTIVE_ACCOUNT', event_id, NULL, username, user_name, department, timestamp, source_ip,
               severity, 'T1078.002', reason FROM det_inactive""",
    "queue": """
        SELECT q.*, f.source AS intel_source, f.tags AS intel_tags, CAST(f.confidence AS DOUBLE) AS intel_confidence
        FROM findings q LEFT JOIN matched f ON f.source_ip = q.source_ip""",
    # Integrity
    "orphans": """
        SELECT device_id, employee_id AS listed_owner, operating_system, CAST(os_patch_date AS VARCHAR) AS os_patch_date,
               'Device has no valid owner in employee directory' AS issue
        FROM devices d WHERE NOT EXISTS (SELECT 1 FROM people p WHERE p.employee_id = d.employee_id)""",
    "mismatches": """
        SELECT d.device_id, d.employee_id AS primary_owner, p.full_name AS primary_owner_name,
               b.employee_id AS backup_owner, q.full_name AS backup_owner_name,
               'Ownership conflict between inventories' AS issue
        FROM devices d JOIN devices_backup b ON b.device_id = d.device_id AND b.employee_id <> d.employee_id
        LEFT JOIN people p ON p.employee_id = d.employee_id LEFT JOIN people q ON q.employee_id = b.employee_id""",
    "deviceless": """
        SELECT employee_id, full_name AS employee_name, department, status,
               'Active employee has no assigned device' AS issue
        FROM people p WHERE status = 'Active' AND NOT employee_id ILIKE 'svc_%'
          AND employee_id NOT IN (SELECT employee_id FROM devices WHERE employee_id IS NOT NULL)""",
    # Hunts
    "recent": f"SELECT * FROM logins WHERE ts > {_SINCE}",
    "recent_known": f"""
        SELECT username, list(DISTINCT country ORDER BY country) AS known FROM recent
        WHERE success = 1 AND ts < {_SPLIT} GROUP BY username""",
    # Correlations
    "losses": "SELECT * FROM logins WHERE success = 0",
    "rolling_events": f"""
        SELECT DISTINCT username, ts, n AS event_count FROM (
            SELECT username, ts, count(*) OVER (PARTITION BY username ORDER BY ts
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n FROM losses)
        WHERE n >= {queries.BURST}""",
    "hops": """
        SELECT l.*, make_timestamp((CAST(epoch(ts) AS BIGINT) // 1200 - i) * 1200 * 1000000) AS window_start
        FROM losses l, range(3) AS r(i)""",
    "hop_events": f"""
        SELECT username, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS event_count
        FROM hops GROUP BY ALL HAVING count(*) >= {queries.BURST}""",
    "hop_values": f"""
        SELECT source_ip, window_start, window_start + INTERVAL 1 HOUR AS window_end,
               count(DISTINCT username) AS value_count
        FROM hops GROUP BY ALL HAVING count(DISTINCT username) >= {queries.BURST}""",
    "watermark": "SELECT max(ts) - INTERVAL 30 MINUTE AS closed_until FROM losses",
    # Detection quality
    "rule_list": """
        SELECT * FROM (VALUES
            ('unfamiliar_country', 'Unfamiliar Country', 'event', 'unfamiliar_country', 'T1078'),
            ('impossible_travel', 'Impossible Travel', 'event', 'impossible_travel', 'T1078'),
            ('after_hours', 'After-Hours Login', 'event', 'after_hours', 'T1078'),
            ('brute_force', 'Brute Force (success)', 'event', 'brute_force_success', 'T1110.001'),
            ('password_spray', 'Password Spray', 'campaign', 'password_spray', 'T1110.003'),
            ('bruteforce_failed', 'Failed Brute Force', 'campaign', 'brute_force_failed', 'T1110.001'),
            ('inactive_account', 'Inactive Account', 'event', 'terminated_account', 'T1078.002'))
            AS r(rule, label, grain, designed_class, technique)""",
    "flags": """
        SELECT lower(detection_type) AS rule, event_id FROM findings WHERE event_id IS NOT NULL""",
    "bad_events": "SELECT event_id, max(is_malicious) AS bad FROM truth GROUP BY event_id",
    "event_scores": """
        SELECT r.rule,
               (SELECT count(*) FROM flags f WHERE f.rule = r.rule) AS flagged,
               (SELECT count(*) FROM flags f JOIN bad_events b USING (event_id) WHERE f.rule = r.rule AND b.bad = 1) AS tp,
               (SELECT count(*) FROM flags f LEFT JOIN bad_events b USING (event_id)
                WHERE f.rule = r.rule AND coalesce(b.bad, 0) = 0) AS fp,
               (SELECT count(*) FROM truth t WHERE t.anomaly_class = r.designed_class AND t.is_anchor = 1
                  AND t.event_id IN (SELECT event_id FROM flags f WHERE f.rule = r.rule)) AS tp_designed,
               (SELECT count(*) FROM truth t WHERE t.anomaly_class = r.designed_class AND t.is_anchor = 1
                  AND t.event_id NOT IN (SELECT event_id FROM flags f WHERE f.rule = r.rule)) AS fn
        FROM rule_list r WHERE r.grain = 'event'""",
    "campaign_rows": """
        SELECT s.rule, s.campaign_key, s.username, s.source_ip, s.login_date, t.campaign_id, coalesce(t.is_malicious, 0) AS bad
        FROM (SELECT 'password_spray' AS rule, campaign_key, source_ip, login_date, NULL AS username FROM det_spray
              UNION ALL SELECT 'bruteforce_failed', campaign_key, source_ip, login_date, username FROM det_failed) s
        LEFT JOIN losses l ON l.source_ip IS NOT DISTINCT FROM s.source_ip AND l.login_date = s.login_date
              AND (s.username IS NULL OR l.username = s.username)
        LEFT JOIN truth t ON t.event_id = l.event_id""",
    "campaign_keys": """
        SELECT rule, campaign_key, username, source_ip, login_date, max(bad) AS bad FROM campaign_rows GROUP BY ALL""",
    "covered": """
        SELECT DISTINCT c.rule, c.campaign_id FROM campaign_rows c JOIN campaign_keys k
            ON k.rule = c.rule AND k.username IS NOT DISTINCT FROM c.username
               AND k.source_ip IS NOT DISTINCT FROM c.source_ip AND k.login_date = c.login_date AND k.bad = 1
        WHERE c.campaign_id IS NOT NULL""",
    "expected": """
        SELECT DISTINCT r.rule, t.campaign_id FROM truth t JOIN rule_list r ON r.designed_class = t.anomaly_class
        WHERE r.grain = 'campaign' AND t.campaign_id IS NOT NULL""",
    "campaign_scores": """
        SELECT r.rule, (SELECT count(*) FROM campaign_keys k WHERE k.rule = r.rule) AS flagged,
               (SELECT count(*) FROM campaign_keys k WHERE k.rule = r.rule AND k.bad = 1) AS tp,
               (SELECT count(*) FROM campaign_keys k WHERE k.rule = r.rule AND k.bad = 0) AS fp,
               (SELECT count(*) FROM expected e SEMI JOIN covered c USING (rule, campaign_id) WHERE e.rule = r.rule) AS tp_designed,
               (SELECT count(*) FROM expected e ANTI JOIN covered c USING (rule, campaign_id) WHERE e.rule = r.rule) AS fn
        FROM rule_list r WHERE r.grain = 'campaign'""",
    "all_scores": """
        SELECT r.rule, r.label, r.technique, r.grain, s.flagged, s.tp, s.fp, s.fn, s.tp_designed,
               CASE WHEN s.flagged > 0 THEN s.tp / s.flagged ELSE 1.0 END AS precision,
               CASE WHEN s.tp_designed + s.fn > 0 THEN s.tp_designed / (s.tp_designed + s.fn) ELSE 1.0 END AS recall
        FROM (SELECT * FROM event_scores UNION ALL BY NAME SELECT * FROM campaign_scores) s JOIN rule_list r USING (rule)""",
    # Hand-off
    "user_rules": """
        SELECT username, detection_type, any_value(rule_no) AS rule_no, any_value(mitre_technique) AS technique,
               min(CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END) AS sev
        FROM queue WHERE username IS NOT NULL GROUP BY username, detection_type""",
    "user_places": """
        SELECT username, detection_type, max(timestamp) AS newest
        FROM (SELECT *, CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS sev FROM queue) q
        JOIN user_rules u USING (username, detection_type) WHERE q.sev = u.sev GROUP BY ALL""",
    "by_user": """
        SELECT username, CASE min(sev) WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
               string_agg(detection_type, ',' ORDER BY sev, newest DESC, rule_no) AS detections,
               string_agg(DISTINCT technique, ',' ORDER BY technique) AS techniques
        FROM user_rules JOIN user_places USING (username, detection_type) GROUP BY username""",
    "case_events": f"""
        SELECT * FROM logins WHERE login_date >= {_START} AND username IN (SELECT username FROM by_user)""",
    "hops_km": """
        SELECT e.username, e.event_id, (epoch(e.ts) - epoch(e.p_ts)) AS secs,
               2 * 6371 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2)
                   + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS km
        FROM (SELECT *, lag(country) OVER o AS p_country, lag(ts) OVER o AS p_ts FROM case_events
              WINDOW o AS (PARTITION BY username ORDER BY ts, event_id)) e
        JOIN centroid a ON a.country = e.p_country JOIN centroid b ON b.country = e.country""",
    "signals": f"""
        SELECT username,
               CASE WHEN coalesce((SELECT max(km * 3600 / greatest(secs, 60)) FROM hops_km k
                                   WHERE k.username = u.username), 0) > {queries.SIGNAL_WEIGHTS.travel_kmh} THEN 30.0 ELSE 0.0 END AS impossible_travel,
               CASE WHEN (SELECT min(b.ts) FROM (
                              SELECT f.ts, count(*) OVER (ORDER BY f.ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING
                                                          AND CURRENT ROW) AS n
                              FROM case_events f WHERE f.username = u.username AND f.success = 0) b
                          WHERE b.n >= {queries.SIGNAL_WEIGHTS.burst_failures})
                         < (SELECT max(w.ts) FROM case_events w WHERE w.username = u.username AND w.success = 1)
                    THEN 25.0 ELSE 0.0 END AS mfa_fatigue,
               CASE WHEN EXISTS (SELECT 1 FROM case_events c JOIN matched f ON f.source_ip = c.source_ip
                                 WHERE c.username = u.username AND f.is_malicious = 1 AND f.{queries.SIGNAL_FEED}) THEN 20.0 ELSE 0.0 END AS ip_reputation,
               7.5 AS device_novelty,
               (SELECT round(10.0 * count(*) FILTER (WHERE login_hour NOT BETWEEN 7 AND 18) / count(*), 1)
                FROM case_events c WHERE c.username = u.username) AS login_hour_anomaly
        FROM by_user u""",
    "sig": """
        SELECT username, CAST(impossible_travel AS DOUBLE) AS impossible_travel, CAST(mfa_fatigue AS DOUBLE) AS mfa_fatigue,
               CAST(ip_reputation AS DOUBLE) AS ip_reputation, CAST(device_novelty AS DOUBLE) AS device_novelty,
               CAST(login_hour_anomaly AS DOUBLE) AS login_hour_anomaly FROM signals""",
    "bands": """
        SELECT *, CASE WHEN risk_score < 30 THEN 'low_risk' WHEN risk_score > 70 THEN 'high_risk' ELSE 'medium_risk' END AS verdict
        FROM (SELECT *, CAST(round_even(impossible_travel + mfa_fatigue + ip_reputation + device_novelty
                                        + login_hour_anomaly, 0) AS INTEGER) AS risk_score FROM sig)""",
    "firing": """
        SELECT username, string_agg(name || ' ' || regexp_replace(CAST(score AS VARCHAR), '\\.0$', ''), '; '
                                    ORDER BY score DESC, i) AS firing_signals
        FROM (SELECT username, 0 AS i, 'impossible_travel' AS name, impossible_travel AS score FROM sig
              UNION ALL SELECT username, 1, 'mfa_fatigue', mfa_fatigue FROM sig
              UNION ALL SELECT username, 2, 'ip_reputation', ip_reputation FROM sig
              UNION ALL SELECT username, 3, 'device_novelty', device_novelty FROM sig
              UNION ALL SELECT username, 4, 'login_hour_anomaly', login_hour_anomaly FROM sig)
        WHERE score > 0 GROUP BY username""",
    "records": f"""
        SELECT 'INC-' || c.username AS incident_id,
               row_number() OVER (PARTITION BY c.username ORDER BY c.ts, c.event_id) AS seq, c.event_id,
               {_text('c.ts')} AS ts, c.source_ip AS ip_address, CAST(g.lat AS DOUBLE) AS lat, CAST(g.lon AS DOUBLE) AS lon,
               c.country, CASE c.success WHEN 1 THEN 'success' ELSE 'failure' END AS auth_status
        FROM case_events c LEFT JOIN centroid g ON g.country = c.country""",
}

_QUEUE_COLUMNS = (
    "detection_type, event_id, campaign_key, username, user_name, department, timestamp, source_ip, severity, "
    "mitre_technique, reason, intel_source, intel_tags, intel_confidence"
)
_EVENT_COLUMNS = (
    "event_id, username, CAST(login_date AS VARCHAR) AS login_date, login_time, country, "
    "CAST(success AS INTEGER) AS success, source_ip, " + _text("ts") + " AS ts, login_hour"
)
_SPRAY = "SELECT * REPLACE (CAST(login_date AS VARCHAR) AS login_date) FROM det_spray"
_SCORE_TOTALS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("flagged", "tp", "fp", "fn", "tp_designed"))

_BODIES: dict[str, str] = {
    "login_events": f"SELECT {_EVENT_COLUMNS} FROM logins",
    "ip_enrichment": """
        SELECT l.event_id, l.source_ip, f.cidr, f.is_malicious, CAST(f.confidence AS DOUBLE) AS confidence, f.source, f.tags
        FROM logins l JOIN matched f ON f.source_ip = l.source_ip""",
    "classify_source": """
        SELECT l.event_id, l.username, CAST(l.login_date AS VARCHAR) AS login_date, l.source_ip, l.country,
               CASE WHEN l.source_ip LIKE '10.%' THEN 'INTERNAL' WHEN f.tags IS NOT NULL THEN f.tags
                    ELSE 'EXTERNAL (no intel match)' END AS ip_classification,
               f.source AS intel_source, CAST(f.confidence AS DOUBLE) AS confidence
        FROM logins l LEFT JOIN matched f ON f.source_ip = l.source_ip""",
    "account_status": f"""
        SELECT {_EVENT_COLUMNS}, p.status AS account_status FROM logins l LEFT JOIN people p ON p.employee_id = l.username""",
    "user_country_baseline": f"SELECT DISTINCT username, country FROM wins WHERE login_date < {_BASE_END}",
    "user_country_baseline_display": "SELECT username, known_countries, country_count FROM known",
    "hourly_distribution": """
        SELECT login_hour, count(*) AS login_count,
               CAST(round(100.0 * count(*) / (SELECT count(*) FROM wins), 1) AS DOUBLE) AS pct
        FROM wins GROUP BY login_hour""",
    "user_hour_baseline": "SELECT * FROM user_hours",
    "dept_hour_baseline": "SELECT * FROM dept_hours",
    "hour_windows": "SELECT * FROM windows",
    "patch_status": "SELECT * FROM patches",
    "account_history": f"""
        SELECT username, country, {_text('min(ts)')} AS first_ts, count(*) AS baseline_logins,
               min(login_hour) AS min_hour, max(login_hour) AS max_hour,
               max_by(event_id, (ts, event_id)) AS last_event_id
        FROM wins WHERE login_date < {_START} GROUP BY username, country""",
    "detect_unfamiliar_country": "SELECT * FROM det_unfamiliar",
    "travel_transitions": f"""
        SELECT event_id, username, CAST(login_date AS VARCHAR) AS login_date, login_time, country, source_ip,
               {_text('ts')} AS ts, p_id AS prev_event_id, p_country AS prev_country, {_text('p_ts')} AS prev_ts,
               p_ip AS prev_ip, CAST(p_date AS VARCHAR) AS prev_login_date, p_time AS prev_login_time
        FROM legs""",
    "detect_impossible_travel": "SELECT * FROM det_travel",
    "detect_after_hours": "SELECT * FROM det_hours",
    "detect_brute_force": "SELECT * FROM det_guess",
    "detect_password_spray": _SPRAY,
    "spray_accounts": """
        SELECT l.source_ip, CAST(l.login_date AS VARCHAR) AS login_date, l.username,
               count(*) FILTER (WHERE success = 0) AS failures, count(*) FILTER (WHERE success = 1) AS wins
        FROM logins l JOIN det_spray s ON s.source_ip IS NOT DISTINCT FROM l.source_ip AND s.login_date = l.login_date
        GROUP BY ALL""",
    "detect_bruteforce_failed": "SELECT * REPLACE (CAST(login_date AS VARCHAR) AS login_date) FROM det_failed",
    "detect_inactive_account": "SELECT * FROM det_inactive",
    "triage_queue": f"SELECT {_QUEUE_COLUMNS} FROM queue",
    "triage_queue_from_history": f"SELECT {_QUEUE_COLUMNS} FROM queue",
    "triage_queue_nightly": f"SELECT {_QUEUE_COLUMNS} FROM queue",
    "queue_head": f"""
        SELECT row_number() OVER (ORDER BY CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, timestamp DESC,
                   detection_type, event_id NULLS FIRST, campaign_key NULLS FIRST, intel_source NULLS FIRST) AS place,
               detection_type, event_id, campaign_key, username, severity, timestamp, intel_source
        FROM queue QUALIFY place <= {queries.QUEUE_HEAD}""",
    "queue_places": """
        SELECT row_number() OVER (ORDER BY CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, timestamp DESC,
                   detection_type, event_id NULLS FIRST, campaign_key NULLS FIRST, intel_source NULLS FIRST) AS place,
               detection_type, event_id, campaign_key, username, severity, timestamp, intel_source
        FROM queue""",
    "stored_queue": f"SELECT {_QUEUE_COLUMNS}, substr(timestamp, 1, 10) AS detection_day FROM queue",
    "account_timeline": f"""
        SELECT row_number() OVER (ORDER BY ts, event_id) AS place, event_id, CAST(login_date AS VARCHAR) AS login_date, login_time,
               CAST(success AS INTEGER) AS success, source_ip
        FROM logins WHERE login_date >= {_START} AND username = '{queries.ACCOUNT}'""",
    "detect_brute_force_from_config": "SELECT * FROM det_guess",
    "triage_summary": """
        SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'HIGH') AS high,
               count(*) FILTER (WHERE severity = 'MEDIUM') AS medium, count(*) FILTER (WHERE severity = 'LOW') AS low
        FROM queue""",
    "high_severity_findings": """
        SELECT detection_type, mitre_technique, coalesce(username, source_ip) AS subject, timestamp,
               coalesce(intel_tags, '-') AS intel, substr(reason, 1, 60) AS summary
        FROM queue WHERE severity = 'HIGH'""",
    "user_timeline": f"""
        SELECT username, event_id, CAST(login_date AS VARCHAR) AS login_date, login_time,
               CAST(success AS INTEGER) AS success, source_ip
        FROM logins WHERE login_date >= {_START} AND username IN (SELECT username FROM det_guess)""",
    "spray_campaigns": """
        SELECT source_ip, CAST(login_date AS VARCHAR) AS login_date, accounts_targeted, total_failures, successes, page, usernames
        FROM det_spray""",
    "live_compromise_sprays": _SPRAY + " WHERE successes > 0",
    "orphan_devices": "SELECT * FROM orphans",
    "inventory_mismatch": "SELECT * FROM mismatches",
    "users_without_devices": "SELECT * FROM deviceless",
    "containment_preflight": """
        SELECT d.device_id, d.employee_id AS username, p.status, p.department,
               d.device_id IN (SELECT device_id FROM mismatches) AS ownership_mismatch,
               d.device_id IN (SELECT device_id FROM orphans) AS orphan_device,
               (d.device_id IN (SELECT device_id FROM mismatches) OR d.device_id IN (SELECT device_id FROM orphans)
                OR p.status IS NULL) AS stop
        FROM devices d LEFT JOIN people p USING (employee_id)""",
    "mismatch_live_subjects": """
        SELECT device_id, primary_owner, backup_owner FROM mismatches
        WHERE backup_owner IN (SELECT username FROM det_travel)""",
    "dataset_invariants": """
        WITH kept AS (SELECT event_id, CASE WHEN event_id % 101 = 7 THEN '25:00:00' WHEN event_id % 103 = 8
                             THEN left(login_time, 5) ELSE login_time END AS login_time
                      FROM logins WHERE event_id % 97 <> 5),
        flawed AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE event_id % 49 = 3),
        pairs AS (SELECT left(n_name, 1) AS country_a, 'M' AS country_b FROM nation)
        SELECT 'non_contiguous_ids' AS "check", max(event_id) + 1 - count(DISTINCT event_id) AS value FROM flawed
        UNION ALL SELECT 'duplicate_event_ids', count(*) FROM (SELECT event_id FROM flawed GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'total_events', count(*) FROM flawed
        UNION ALL SELECT 'malformed_times', count(*) FROM flawed
                  WHERE try_strptime(login_time, '%H:%M:%S') IS NULL AND try_strptime(login_time, '%H:%M') IS NULL
        UNION ALL SELECT 'unlabelled_events', count(*) FROM flawed WHERE event_id NOT IN (SELECT event_id FROM truth)
        UNION ALL SELECT 'malicious_events', count(DISTINCT event_id) FROM truth WHERE is_malicious = 1
        UNION ALL SELECT 'missing_config_keys', 2
        UNION ALL SELECT 'rejected_feed_ranges', 2
        UNION ALL SELECT 'country_distance_unordered_pairs', count(*) FROM pairs WHERE country_a >= country_b
        UNION ALL SELECT 'country_distance_duplicate_pairs', count(*)
                  FROM (SELECT 1 FROM pairs GROUP BY country_a, country_b HAVING count(*) > 1)
        UNION ALL SELECT 'travel_exceptions_unordered_pairs', count(*) FROM excused WHERE country_a >= country_b
        UNION ALL SELECT 'travel_exceptions_duplicate_pairs', count(*)
                  FROM (SELECT 1 FROM excused GROUP BY country_a, country_b HAVING count(*) > 1)""",
    "rejected_feed_ranges": """
        SELECT * FROM (VALUES ('1.2.3.0/40', 'demo-bad', 'bad-width'), ('nonsense', 'demo-bad', 'no-address')) AS r(cidr, source, tags)""",
    "hunt_after_hours": f"""
        SELECT r.event_id, r.username, {_text('r.ts')} AS ts, r.login_hour, b.min_hour, b.max_hour, r.source_ip
        FROM recent r JOIN (SELECT username, min(login_hour) AS min_hour, max(login_hour) AS max_hour FROM recent
                            WHERE success = 1 AND ts < {_SPLIT} GROUP BY username) b USING (username)
        WHERE r.success = 1 AND r.ts >= {_SPLIT} AND NOT starts_with(lower(r.username), 'svc_')
          AND r.login_hour NOT BETWEEN b.min_hour - 2 AND b.max_hour + 2""",
    "hunt_unfamiliar_country": f"""
        SELECT r.event_id, r.username, r.country AS detect_country, coalesce(array_to_string(b.known, ','), '') AS baseline,
               r.source_ip, CASE WHEN r.country IN ('RU', 'CN', 'KP', 'IR') THEN 'HIGH' ELSE 'MEDIUM' END AS severity
        FROM (SELECT * FROM recent WHERE success = 1 AND ts >= {_SPLIT}
              QUALIFY row_number() OVER (PARTITION BY username ORDER BY ts DESC, event_id DESC) = 1) r
        LEFT JOIN recent_known b USING (username) WHERE NOT coalesce(list_contains(b.known, r.country), false)""",
    "hunt_unfamiliar_country_all": f"""
        SELECT r.event_id, r.username, r.country AS detect_country, coalesce(array_to_string(b.known, ','), '') AS baseline,
               r.source_ip, CASE WHEN r.country IN ('RU', 'CN', 'KP', 'IR') THEN 'HIGH' ELSE 'MEDIUM' END AS severity
        FROM recent r LEFT JOIN recent_known b USING (username)
        WHERE r.success = 1 AND r.ts >= {_SPLIT} AND NOT coalesce(list_contains(b.known, r.country), false)""",
    "hunt_impossible_travel": f"""
        SELECT event_id, username, p_country AS prev_country, country, CAST(secs / 3600.0 AS DOUBLE) AS hours,
               CAST(CASE WHEN secs > 0 THEN round(distance_km / (secs / 3600.0)) END AS BIGINT) AS required_kmh
        FROM (SELECT *, epoch(ts) - epoch(p_ts) AS secs FROM (
                  SELECT *, lag(country) OVER o AS p_country, lag(ts) OVER o AS p_ts FROM recent WHERE success = 1
                  WINDOW o AS (PARTITION BY username ORDER BY ts, event_id))) l
        JOIN km k ON k.country_a = least(l.country, l.p_country) AND k.country_b = greatest(l.country, l.p_country)
        WHERE l.country <> l.p_country AND (secs = 0 OR round(distance_km / (secs / 3600.0)) > 900)""",
    "hunt_failures_since_success": f"""
        SELECT event_id, username, {_text('ts')} AS ts, source_ip, since AS failures_since_success,
               {_text('first_ts')} AS first_failure,
               CAST(round((epoch(ts) - epoch(first_ts)) / 60.0, 1) AS DOUBLE) AS time_window_minutes
        FROM (SELECT *, count(*) FILTER (WHERE success = 0) OVER s AS since,
                     min(ts) FILTER (WHERE success = 0) OVER s AS first_ts
              FROM (SELECT *, coalesce(sum(success) OVER (PARTITION BY username ORDER BY ts, success, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM recent)
              WINDOW s AS (PARTITION BY username, run))
        WHERE success = 1 AND since >= {queries.HUNT_RUN}""",
    "hunt_failed_bruteforce": f"""
        SELECT username, source_ip, CAST(login_date AS VARCHAR) AS day, count(*) FILTER (WHERE success <> 1) AS failures,
               count(*) FILTER (WHERE success = 1) AS successes
        FROM recent GROUP BY username, source_ip, login_date HAVING failures >= {queries.HUNT_FAILED} AND successes = 0""",
    "hunt_password_spray": f"""
        SELECT source_ip, CAST(login_date AS VARCHAR) AS day, count(DISTINCT username) AS accounts_targeted,
               count(*) AS total_failures
        FROM recent WHERE success = 0 GROUP BY source_ip, login_date HAVING accounts_targeted >= {queries.HUNT_ACCOUNTS}""",
    "hunt_password_spray_names": f"""
        SELECT source_ip, CAST(login_date AS VARCHAR) AS day, count(DISTINCT username) AS accounts_targeted,
               count(*) AS total_failures, CAST(0 AS BIGINT) AS page, string_agg(DISTINCT username, ',' ORDER BY username) AS usernames
        FROM recent WHERE success = 0 GROUP BY source_ip, login_date HAVING accounts_targeted >= {queries.HUNT_ACCOUNTS}""",
    "hunt_password_spray_estimate": f"""
        SELECT source_ip, CAST(login_date AS VARCHAR) AS day, count(DISTINCT username) AS accounts_targeted,
               count(*) AS total_failures, true AS close
        FROM recent WHERE success = 0 GROUP BY source_ip, login_date HAVING accounts_targeted >= {queries.HUNT_ACCOUNTS}""",
    "source_breadth": f"""
        SELECT source_ip, count(DISTINCT login_date) AS days, count(*) AS failures, count(DISTINCT username) AS accounts,
               true AS same_failures, true AS within
        FROM losses WHERE login_date BETWEEN CAST({_ASOF} AS DATE) - {queries.BREADTH_SPAN.days} AND CAST({_ASOF} AS DATE)
        GROUP BY source_ip""",
    "hunt_inactive_account": f"""
        SELECT r.event_id, r.username, p.status AS account_status, {_text('r.ts')} AS ts,
               CAST(r.success AS INTEGER) AS success, r.source_ip, r.country,
               CASE r.success WHEN 1 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
        FROM recent r JOIN people p ON p.employee_id = r.username AND p.status <> 'Active'""",
    "correlate_event_count": f"SELECT username, {_text('ts')} AS ts, event_count FROM rolling_events",
    "correlate_value_count": f"""
        SELECT DISTINCT source_ip, {_text('ts')} AS ts, n AS value_count FROM (
            SELECT source_ip, ts, count(DISTINCT username) OVER (PARTITION BY source_ip ORDER BY ts
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n FROM losses)
        WHERE n >= {queries.BURST}""",
    "merge_event_count_alerts": f"""
        SELECT username, {_text('min(ts)')} AS first_alert, {_text('max(ts)')} AS last_alert, count(*) AS instants,
               max(event_count) AS event_count
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY username ORDER BY ts) AS burst
              FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY username ORDER BY ts) <= INTERVAL 1 HOUR
                                   THEN 0 ELSE 1 END AS fresh FROM rolling_events))
        GROUP BY username, burst""",
    "select_terminated": f"""
        SELECT {_EVENT_COLUMNS}, p.status AS account_status FROM logins l JOIN people p ON p.employee_id = l.username
        WHERE p.status IN ('Terminated', 'Disabled', 'Suspended')""",
    "hopping_event_count": f"""
        SELECT username, {_text('window_start')} AS window_start, {_text('window_end')} AS window_end, event_count FROM hop_events""",
    "hopping_value_count": f"""
        SELECT source_ip, {_text('window_start')} AS window_start, {_text('window_end')} AS window_end, value_count FROM hop_values""",
    "merge_hopping_alerts": f"""
        SELECT source_ip, {_text('min(window_start)')} AS first_window_start, {_text('max(window_end)')} AS last_window_end,
               count(*) AS windows, max(value_count) AS value_count
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY source_ip ORDER BY window_start) AS burst
              FROM (SELECT *, CASE WHEN window_start <= lag(window_end) OVER (PARTITION BY source_ip ORDER BY window_start)
                                   THEN 0 ELSE 1 END AS fresh FROM hop_values))
        GROUP BY source_ip, burst""",
    "stream_event_count": f"""
        SELECT username, {_text('ts')} AS ts, event_count FROM rolling_events
        WHERE ts + INTERVAL 1 SECOND <= (SELECT closed_until FROM watermark)""",
    "stream_value_count": f"""
        SELECT DISTINCT source_ip, {_text('ts')} AS ts, n AS value_count FROM (
            SELECT source_ip, ts, count(DISTINCT username) OVER (PARTITION BY source_ip ORDER BY ts
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n FROM losses)
        WHERE n >= {queries.BURST} AND ts + INTERVAL 1 SECOND <= (SELECT closed_until FROM watermark)""",
    "stream_early_event_count": f"""
        SELECT username, {_text('ts')} AS ts, event_count, CAST(0 AS BIGINT) AS first_batch, CAST(0 AS BIGINT) AS confirmed_batch
        FROM rolling_events WHERE ts + INTERVAL 1 SECOND <= (SELECT closed_until FROM watermark)""",
    "stream_missed_events": f"""
        SELECT username, {_text('ts')} AS ts, event_count FROM rolling_events WHERE false""",
    "stream_hopping_event_count": f"""
        SELECT username, {_text('window_start')} AS window_start, {_text('window_end')} AS window_end, event_count
        FROM hop_events WHERE window_end <= (SELECT closed_until FROM watermark)""",
    "stream_hopping_value_count": f"""
        SELECT source_ip, {_text('window_start')} AS window_start, {_text('window_end')} AS window_end, value_count
        FROM hop_values WHERE window_end <= (SELECT closed_until FROM watermark)""",
    "stream_terminated": f"""
        SELECT l.event_id, l.username, p.status AS account_status, {_text('l.ts')} AS ts,
               CAST(l.success AS INTEGER) AS success, l.source_ip, l.country
        FROM logins l JOIN people p ON p.employee_id = l.username WHERE p.status IN ('Terminated', 'Disabled', 'Suspended')""",
    "complete_labels": """
        SELECT event_id, is_malicious, anomaly_class, is_anchor, campaign_id, notes FROM truth
        UNION ALL SELECT event_id, CAST(0 AS INTEGER), 'benign', CAST(0 AS INTEGER), NULL, NULL FROM logins
        WHERE event_id NOT IN (SELECT event_id FROM truth)""",
    "label_campaign": """
        SELECT event_id, CAST(1 AS INTEGER) AS is_malicious, 'password_spray' AS anomaly_class,
               CAST(0 AS INTEGER) AS is_anchor, 'spray-' || login_date AS campaign_id, 'scanner failures' AS notes
        FROM losses WHERE starts_with(source_ip, '45.33.32.')""",
    "event_metrics": "SELECT rule, flagged, tp, fp, tp_designed, fn FROM event_scores",
    "event_errors": """
        SELECT DISTINCT f.rule, 'FP' AS error, f.event_id FROM flags f LEFT JOIN bad_events b USING (event_id)
        WHERE coalesce(b.bad, 0) = 0
        UNION ALL SELECT r.rule, 'FN', t.event_id FROM truth t JOIN rule_list r ON r.designed_class = t.anomaly_class
        WHERE r.grain = 'event' AND t.is_anchor = 1
          AND NOT EXISTS (SELECT 1 FROM flags f WHERE f.rule = r.rule AND f.event_id = t.event_id)""",
    "campaign_metrics": "SELECT rule, flagged, tp, fp, tp_designed, fn FROM campaign_scores",
    "campaign_errors": """
        SELECT rule, 'FP' AS error, campaign_key AS item, username, source_ip, CAST(login_date AS VARCHAR) AS login_date
        FROM campaign_keys WHERE bad = 0
        UNION ALL SELECT e.rule, 'FN', e.campaign_id, NULL, NULL, NULL FROM expected e ANTI JOIN covered c USING (rule, campaign_id)""",
    "campaign_findings_counted": """
        SELECT 'password_spray' AS rule, count(*) AS findings, count(*) AS flagged FROM det_spray
        UNION ALL SELECT 'bruteforce_failed', count(*), count(*) FROM det_failed""",
    "rule_scores": "SELECT * FROM all_scores",
    "micro_average": f"""
        SELECT {_SCORE_TOTALS}, sum(tp) / sum(flagged) AS precision, sum(tp_designed) / (sum(tp_designed) + sum(fn)) AS recall
        FROM all_scores""",
    "dataset_summary": """
        SELECT (SELECT count(*) FROM logins) AS events,
               (SELECT count(DISTINCT event_id) FROM truth WHERE is_malicious = 1) AS malicious_events,
               (SELECT count(*) FROM people) AS employees, (SELECT count(*) FROM devices) AS devices,
               (SELECT count(*) FROM queue) AS triage_rows,
               (SELECT count(*) FROM queue WHERE severity = 'HIGH') AS high,
               (SELECT count(*) FROM queue WHERE severity = 'MEDIUM') AS medium,
               (SELECT count(*) FROM queue WHERE severity = 'LOW') AS low,
               (SELECT count(*) FROM orphans) + (SELECT count(*) FROM mismatches) + (SELECT count(*) FROM deviceless)
                   AS integrity_issues,
               (SELECT count(*) FROM patches WHERE patch_risk = 'CRITICAL') AS critical_patch""",
    "asset_metrics": """
        WITH found AS (
            SELECT 'orphan_device' AS anomaly_class, device_id AS asset_id FROM orphans
            UNION ALL SELECT 'inventory_mismatch', device_id FROM mismatches
            UNION ALL SELECT 'user_without_device', employee_id FROM deviceless
            UNION ALL SELECT 'critical_patch_age', device_id FROM patches WHERE patch_risk = 'CRITICAL'),
        counts AS (
            SELECT c.anomaly_class,
                   (SELECT count(*) FROM found f WHERE f.anomaly_class = c.anomaly_class) AS flagged,
                   (SELECT count(*) FROM found f SEMI JOIN asset_truth t USING (anomaly_class, asset_id)
                    WHERE f.anomaly_class = c.anomaly_class) AS tp,
                   (SELECT count(*) FROM asset_truth t ANTI JOIN found f USING (anomaly_class, asset_id)
                    WHERE t.anomaly_class = c.anomaly_class) AS fn
            FROM (SELECT DISTINCT anomaly_class FROM asset_truth) c)
        SELECT anomaly_class, flagged, tp, flagged - tp AS fp, tp AS tp_designed, fn,
               tp / flagged AS precision, tp / (tp + fn) AS recall FROM counts""",
    "findings_by_user": "SELECT * FROM by_user",
    "assemble_incidents": f"""
        SELECT 'INC-' || u.username AS incident_id, u.username, lower(u.username) || '@example.org' AS principal,
               u.severity, u.detections, u.techniques AS technique_ids, count(c.event_id) AS event_count,
               count(c.event_id) FILTER (WHERE c.success = 0) AS failure_count, {_text('max(c.ts)')} AS created_time
        FROM by_user u LEFT JOIN case_events c USING (username)
        GROUP BY u.username, u.severity, u.detections, u.techniques""",
    "incident_events": "SELECT * FROM records",
    "flagged_prefilter": f"""
        SELECT count(DISTINCT username) AS accounts, count(*) AS attempts,
               count(DISTINCT username) FILTER (WHERE username IN (SELECT username FROM by_user)) AS flagged,
               count(*) FILTER (WHERE username IN (SELECT username FROM by_user)) AS flagged_rows, true AS within_share
        FROM logins WHERE login_date >= {_START} AND username IS NOT NULL""",
    "incident_signals": "SELECT * FROM sig",
    "incident_pages": f"""
        SELECT incident_id, (seq - 1) // {queries.RECORDS_PER_PAGE} AS page,
               CAST(to_json(list(struct_pack(seq := seq, ts := ts, ip_address := ip_address, lat := lat, lon := lon,
                                             country := country, auth_status := auth_status) ORDER BY seq)) AS VARCHAR) AS events
        FROM records GROUP BY ALL""",
    "handoff_records": f"""
        SELECT username, CAST(to_json(struct_pack(
            username := username, incident_id := 'INC-' || username, principal := lower(username) || '@example.org',
            created_time := created_time,
            lab := struct_pack(severity := severity, detections := string_split(detections, ','), techniques := string_split(techniques, ',')),
            risk := struct_pack(risk_score := risk_score, verdict := verdict, firing_signals := firing_signals,
                rationale := [struct_pack(signal := 'impossible_travel', score := impossible_travel),
                              struct_pack(signal := 'mfa_fatigue', score := mfa_fatigue),
                              struct_pack(signal := 'ip_reputation', score := ip_reputation),
                              struct_pack(signal := 'device_novelty', score := device_novelty),
                              struct_pack(signal := 'login_hour_anomaly', score := login_hour_anomaly)]))) AS VARCHAR) AS record
        FROM by_user JOIN (SELECT username, {_text('max(ts)')} AS created_time FROM case_events GROUP BY username) USING (username)
        JOIN bands USING (username) JOIN firing USING (username)""",
    "risk_band": "SELECT * FROM bands",
    "signal_summary": "SELECT * FROM firing",
    "country_distances": """
        SELECT p.country_a, p.country_b, p.legs,
               CAST(50 * round(2 * 6371 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat))
                    * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) / 50) AS INTEGER) AS distance_km
        FROM (SELECT least(country, p_country) AS country_a, greatest(country, p_country) AS country_b, count(*) AS legs
              FROM legs WHERE country <> p_country GROUP BY ALL) p
        JOIN centroid a ON a.country = p.country_a JOIN centroid b ON b.country = p.country_b""",
    "report_triage_queue": """
        SELECT detection_type, mitre_technique, severity, coalesce(username, source_ip) AS subject, timestamp,
               coalesce(intel_tags, '-') AS intel FROM queue""",
    "report_unfamiliar_country": "SELECT event_id, username, anomaly_country, baseline_state, severity FROM det_unfamiliar",
    "report_impossible_travel": """
        SELECT event_id, username, country_1, country_2, hours_apart, required_kmh, severity FROM det_travel""",
    "report_after_hours": "SELECT event_id, username, login_hour, baseline_source, window_start, window_end FROM det_hours",
    "report_brute_force": "SELECT event_id, username, failure_count, success_ip FROM det_guess",
    "report_password_spray": """
        SELECT source_ip, CAST(login_date AS VARCHAR) AS login_date, accounts_targeted, total_failures, severity FROM det_spray""",
    "report_bruteforce_failed": "SELECT username, source_ip, failure_count FROM det_failed",
    "report_inactive_account": "SELECT event_id, username, outcome, country FROM det_inactive",
    "report_orphan_devices": "SELECT device_id, listed_owner, issue FROM orphans",
    "report_inventory_mismatch": "SELECT device_id, primary_owner, backup_owner FROM mismatches",
    "report_users_without_devices": "SELECT employee_id, employee_name, department FROM deviceless",
    "report_critical_patch": """
        SELECT device_id, owner_name, days_since_patch, patch_risk FROM patches WHERE patch_risk = 'CRITICAL'""",
}
_BODIES["travel_transitions_settled"] = _BODIES["travel_transitions"]
_BODIES["detect_brute_force_settled"] = _BODIES["detect_brute_force"]
_BODIES["user_timeline_thinned"] = _BODIES["user_timeline"]
_BODIES["incident_events_thinned"] = _BODIES["incident_events"]
_BODIES["hunt_impossible_travel_csv"] = _BODIES["hunt_impossible_travel"]
_BODIES["account_history_merged"] = _BODIES["account_history_late_days"] = _BODIES["account_history"]
_BODIES["ip_enrichment_by_prefix"] = """
        SELECT l.event_id, l.source_ip, f.cidr, f.is_malicious, CAST(f.confidence AS DOUBLE) AS confidence, f.source, f.tags
        FROM logins l JOIN feed f ON starts_with(l.source_ip, f.ip_prefix)"""
_BODIES["classify_source_shuffled"] = _BODIES["classify_source_swept"] = _BODIES["classify_source"]


def _with_views(body: str) -> str:
    """Prefix ``body`` with the views it mentions, directly or through others."""
    needed: set[str] = set()
    for name in reversed(_VIEWS):
        users = [body] + [_VIEWS[n] for n in needed]
        if any(re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text) for text in users):
            needed.add(name)
    views = ", ".join(f"{n} AS ({sql})" for n, sql in _VIEWS.items() if n in needed)
    if not views:
        return body
    inner = body.strip()
    if inner.startswith("WITH "):
        return f"WITH {views}, {inner[5:]}"
    return f"WITH {views} {inner}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(body) for name, body in _BODIES.items()}

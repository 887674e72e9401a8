"""SQL twins of the queries, for DuckDB over the same tables.

They share the fixed value lists with the Spark side and nothing else: lines are
rendered, parsed, counted and sampled again in SQL.
"""

from __future__ import annotations

from hitwatch.functions.log_line import LOG_PATTERN
from hitwatch.sources.derived import (
    ERROR_STATUS,
    GOOD_STATUS,
    METHODS,
    SHORT_FORM_URLS,
    URLS,
)
from hitwatch.schema import CLIENT_RSD

_PATTERN = LOG_PATTERN


def _parsed_from(lines: str) -> str:
    time = f"regexp_extract(value, '{_PATTERN}', 2)"
    return f"""
    SELECT * EXCLUDE (value),
           regexp_extract(value, '{_PATTERN}', 1) AS ip,
           CAST(try_strptime({time}, '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC' AS TIMESTAMP)
               AS "timestamp",
           regexp_extract(value, '{_PATTERN}', 3) AS method,
           regexp_extract(value, '{_PATTERN}', 4) AS url,
           TRY_CAST(regexp_extract(value, '{_PATTERN}', 5) AS INTEGER) AS status
    FROM {lines}"""


def _instant(sec: str) -> str:
    return f"make_timestamp(CAST({sec} AS BIGINT) * 1000000)"


_ISO = "'%Y-%m-%dT%H:%M:%S'"
_BATCH_END = _instant("1704067200 + (batch_id * 200 + 199) // 50")



def _alerts_from(stats: str, number: str, raised: str) -> str:
    return f"""
    SELECT strftime({raised}, {_ISO}) AS "timestamp", scope || '_ERROR_RATE' AS type,
           words || coalesce(url, ip, '') || ' too high: '
               || format('{{:.2f}}%', errors / total * 100) AS message,
           {number} AS batch_id, url, ip, total AS total_requests, errors AS error_requests,
           errors / total AS value, above AS thresholds
    FROM {stats} JOIN limits USING (scope)
    WHERE total >= min_total AND errors / total > above"""


# Named steps; a query lists the last one it needs and gets all before it.
_STEPS: dict[str, str] = {
    "base": f"""
    SELECT event_id, event_id // 200 AS batch_id, 1704067200 + event_id // 50 AS sec,
           '192.168.10.' || (user_id % 254 + 1) AS ip,
           {METHODS}[event_id % 4 + 1] AS method,
           {URLS}[event_id % 19 + 1] AS url,
           event_type = 'error' AND (event_id % 19 < 3 OR user_id % 10 = 0) AS fails,
           CAST(200 + event_id * 7919 % 4801 AS INTEGER) AS size
    FROM events""",
    "records": f"""
    SELECT *, CASE WHEN fails THEN {ERROR_STATUS}[event_id % 7 + 1]
                   ELSE {GOOD_STATUS}[event_id % 4 + 1] END AS status,
           strftime({_instant("sec")}, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS time_text
    FROM base""",
    "lines": """
    SELECT event_id, batch_id, sec,
           CASE WHEN event_id % 97 = 0 THEN 'malformed ' || event_id
                ELSE ip || ' - ['
                     || CASE WHEN event_id % 101 = 0 THEN '99' || substr(time_text, 3)
                             ELSE time_text END
                     || '] "' || method || ' ' || url || ' '
                     || CASE WHEN event_id % 89 = 0 THEN 'HTTP/2' ELSE 'HTTP/1.1' END
                     || '" ' || status || ' ' || size END AS value
    FROM records""",
    "parsed": _parsed_from("lines"),
    "errors": "SELECT * FROM parsed WHERE status >= 400",
    "stats": """
    SELECT batch_id, url, ip,
           CASE WHEN grouping(url) = 1 AND grouping(ip) = 1 THEN 'GLOBAL'
                WHEN grouping(ip) = 1 THEN 'URL' ELSE 'IP' END AS scope,
           count(*) AS total, count(*) FILTER (WHERE status >= 400) AS errors
    FROM parsed GROUP BY GROUPING SETS ((batch_id), (batch_id, url), (batch_id, ip))""",
    "limits": """
    SELECT * FROM (VALUES ('GLOBAL', 1, 0.025::DOUBLE, 'Global error rate'),
                          ('URL', 5, 0.3::DOUBLE, 'Error rate for URL '),
                          ('IP', 3, 0.4::DOUBLE, 'Error rate for IP '))
           AS l(scope, min_total, above, words)""",
    "alerts": _alerts_from("stats", "batch_id", _BATCH_END),
    "timed_stats": """
    SELECT span, url, ip,
           CASE WHEN grouping(url) = 1 AND grouping(ip) = 1 THEN 'GLOBAL'
                WHEN grouping(ip) = 1 THEN 'URL' ELSE 'IP' END AS scope,
           count(*) AS total, count(*) FILTER (WHERE status >= 400) AS errors
    FROM (SELECT *, CAST(floor(epoch("timestamp") / 10) AS BIGINT) AS span
          FROM parsed WHERE "timestamp" IS NOT NULL)
    GROUP BY GROUPING SETS ((span), (span, url), (span, ip))""",
    "timed_alerts": _alerts_from("timed_stats", "span", _instant("(span + 1) * 10")),
    "windowed": """
    SELECT time_bucket(INTERVAL 10 SECOND, "timestamp", TIMESTAMP '2000-01-01')
               - to_seconds(back) AS window_start,
           window_start + INTERVAL 30 SECOND AS window_end, status, url, ip
    FROM errors, (VALUES (0), (10), (20)) AS b(back)
    WHERE "timestamp" IS NOT NULL""",
    "windows": """
    SELECT window_start, window_end, status, count(*) AS count_error,
           count(DISTINCT ip) AS count_distinct_ip
    FROM windowed GROUP BY ALL""",
    "sketched": f"""
    SELECT window_start, window_end, status, count(*) AS count_error,
           count(DISTINCT ip) AS count_distinct_ip, approx_count_distinct(ip) AS sketch,
           abs(sketch - count_distinct_ip) <= greatest(1, count_distinct_ip * {3 * CLIENT_RSD})
               AS within_bound
    FROM windowed GROUP BY ALL""",
    "alert_messages": f"""
    SELECT 'alerts' AS topic, 0 AS partition,
           row_number() OVER (ORDER BY batch_id, CASE type WHEN 'GLOBAL_ERROR_RATE' THEN 0
                              WHEN 'URL_ERROR_RATE' THEN 1 ELSE 2 END, url, ip) - 1 AS "offset",
           epoch({_BATCH_END}) AS sec
    FROM alerts""",
    "messages": """
    SELECT topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset", sec
    FROM lines, (VALUES ('http-logs'), ('http-logs-monitoring')) AS t(topic)
    UNION ALL SELECT * FROM alert_messages""",
}


def _samples_from(messages: str) -> dict[str, str]:
    return {
        "reached": f"""
    SELECT topic, partition, CAST(ceil(sec / 15.0) * 15 AS BIGINT) AS sample_sec,
           max("offset") + 1 AS reached
    FROM {messages} GROUP BY ALL""",
        "grid": f"""
    SELECT topic, partition, unnest(range(lo, hi + 15, 15)) AS sample_sec
    FROM (SELECT DISTINCT topic, partition FROM {messages}),
         (SELECT CAST(floor(min(sec) / 15.0) * 15 AS BIGINT) AS lo,
                 CAST(ceil(max(sec) / 15.0) * 15 AS BIGINT) AS hi FROM {messages})""",
        "samples": """
    SELECT sample_sec, topic, partition,
           coalesce(max(reached) OVER (PARTITION BY topic, partition ORDER BY sample_sec), 0)
               AS current_offset
    FROM grid LEFT JOIN reached USING (topic, partition, sample_sec)""",
        "steps": """
    SELECT *, current_offset - lag(current_offset)
               OVER (PARTITION BY topic, partition ORDER BY sample_sec) AS step
    FROM samples""",
        "minutes": """
    SELECT *, sum(step) OVER (PARTITION BY topic, partition ORDER BY sample_sec
                              RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS change
    FROM steps""",
        "five_minutes": """
    SELECT *, sum(step) OVER (PARTITION BY topic, partition ORDER BY sample_sec
                              RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS change
    FROM steps""",
        "rates": """
    SELECT sample_sec, topic, sum(change) / 60 AS value FROM minutes GROUP BY ALL""",
    }


def _with(body: str, until: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind all steps up to ``until`` and the ``extra`` ones."""
    steps: dict[str, str] = {}
    for name, text in _STEPS.items():
        steps[name] = text
        if name == until:
            break
    steps.update(extra or {})
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in steps.items()) + "\n" + body


def _sampled(body: str, messages: str = "messages") -> str:
    return _with(body, messages, _samples_from(messages))


_CLOSED = """window_end <= (SELECT max("timestamp") FROM errors) - INTERVAL 30 SECOND"""
_CLOSED_SPAN = """(batch_id + 1) * 10 <= (SELECT epoch(max("timestamp")) FROM parsed) - 30"""
_TOP_URLS = """SELECT window_start, window_end, status, url, occurrences,
           CAST(floor(total * 3.5 / 128) AS BIGINT) AS most_off
    FROM (SELECT *, sum(occurrences) OVER same_window AS total,
                 rank() OVER (same_window ORDER BY occurrences DESC) AS place
          FROM (SELECT window_start, window_end, status, url, count(*) AS occurrences
                FROM windowed GROUP BY ALL)
          WINDOW same_window AS (PARTITION BY window_start, status))
    WHERE place <= 3"""
_ERROR_JSON = """'{' || concat_ws(',', '"ip":' || to_json(ip),
    '"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.') || '000Z"',
    '"method":' || to_json(method), '"url":' || to_json(url), '"status":' || status) || '}'"""
_RECORD_JSON = """to_json(struct_pack(ip := ip, "timestamp" := time_text, method := method,
    url := url, status := status, size := size))"""
_URL_ROWS = """SELECT window_start, window_end, status, url, count(*) AS occurrences
    FROM windowed GROUP BY ALL"""
# a whole number, as any Python number may be written, in front of a blank or the end
_LENIENT = r"""regexp_replace(coalesce(
    nullif(regexp_extract(trim(coalesce(string_split(value, '"')[3], ''), E' \t\n\r\f\x0b'),
    '^(\S+)', 1), ''), 'none'), '^\+', '')"""
_FLAG = f"coalesce(TRY_CAST({_LENIENT} AS HUGEINT) >= 400, false)"


def oracle_sql() -> dict[str, str]:
    short_lines = f"""
    SELECT event_id,
           concat_ws('.', (user_id + event_id) % 256, (user_id * 3 + event_id) % 256,
                     (user_id * 5 + event_id) % 256, (user_id * 7 + event_id) % 256)
           || ' - [' || strftime({_instant("1704067200 + event_id // 50")}, '%d/%b/%Y:%H:%M:%S')
           || ' +0000] "' || {METHODS}[event_id % 4 + 1] || ' http://localhost'
           || {SHORT_FORM_URLS}[event_id % 7 + 1] || ' HTTP/1.1" '
           || {GOOD_STATUS + ERROR_STATUS}[event_id % 11 + 1] AS value
    FROM events"""
    counts = "count(*) AS total, count(*) FILTER (WHERE status >= 400) AS errors"
    alerts = "SELECT * FROM alerts"
    return {
        "access_log_lines": _with("SELECT event_id, batch_id, value FROM lines", "lines"),
        "short_log_lines": short_lines,
        "parse_access_log": _with("SELECT * EXCLUDE (batch_id, sec) FROM parsed", "parsed"),
        "parse_short_log": f"WITH short AS ({short_lines}) {_parsed_from('short')}",
        "error_requests": _with("SELECT * EXCLUDE (batch_id, sec) FROM errors", "errors"),
        "errors_json": _with(f"SELECT event_id, {_ERROR_JSON} AS value FROM errors", "errors"),
        "monitoring_json": _with(
            f"SELECT event_id, CAST({_RECORD_JSON} AS VARCHAR) AS value FROM records", "records"
        ),
        "monitoring_records": _with(
            'SELECT event_id, ip, time_text AS "timestamp", method, url, status, size FROM records',
            "records",
        ),
        "monitoring_fanout": _with(
            f"""SELECT event_id, 'http-logs' AS topic, value FROM lines
            UNION ALL SELECT event_id, 'http-logs-monitoring', CAST({_RECORD_JSON} AS VARCHAR)
            FROM records""",
            "lines",
        ),
        "batch_summary": _with(
            f"SELECT batch_id, {counts}, errors / total AS rate FROM parsed GROUP BY batch_id",
            "parsed",
        ),
        "url_error_stats": _with(
            f"SELECT batch_id, url, {counts} FROM parsed GROUP BY batch_id, url", "parsed"
        ),
        "ip_error_stats": _with(
            f"SELECT batch_id, ip, {counts} FROM parsed GROUP BY batch_id, ip", "parsed"
        ),
        "error_stats_grouping_sets": _with("SELECT * FROM stats", "stats"),
        "alerts_all": _with(alerts, "alerts"),
        "global_error_rate_alerts": _with(
            "SELECT * EXCLUDE (url, ip) FROM alerts WHERE type = 'GLOBAL_ERROR_RATE'", "alerts"
        ),
        "url_error_rate_alerts": _with(
            "SELECT * EXCLUDE (ip) FROM alerts WHERE type = 'URL_ERROR_RATE'", "alerts"
        ),
        "ip_error_rate_alerts": _with(
            "SELECT * EXCLUDE (url) FROM alerts WHERE type = 'IP_ERROR_RATE'", "alerts"
        ),
        "alerts_json": _with(
            """SELECT *, 'timestamp,type,message,batch_id,'
                   || CASE WHEN url IS NOT NULL THEN 'url,' WHEN ip IS NOT NULL THEN 'ip,'
                           ELSE '' END
                   || 'total_requests,error_requests,value,thresholds' AS keys
            FROM alerts""",
            "alerts",
        ),
        "alerts_dedup": _with(alerts, "alerts"),
        "error_windows": _with("SELECT * FROM windows", "windows"),
        "approx_clients_deviation": _with(
            f"""SELECT count(*) AS windows,
                   sqrt(avg(pow((sketch - count_distinct_ip) / count_distinct_ip, 2))) <= {CLIENT_RSD}
                       AS within_rsd
            FROM sketched""",
            "sketched",
        ),
        "error_windows_approx": _with("SELECT * EXCLUDE (sketch) FROM sketched", "sketched"),
        "error_windows_panes": _with("SELECT * FROM windows", "windows"),
        "window_top_urls": _with(_TOP_URLS, "windowed"),
        "alerts_by_time": _with("SELECT * FROM timed_alerts", "timed_alerts"),
        "error_window_urls": _with(_URL_ROWS, "windowed"),
        "window_alerts": _with(
            """SELECT *, 'Alerte: trop d''erreurs' AS alert FROM windows WHERE count_error > 10""",
            "windows",
        ),
        "window_alert_urls": _with(
            f"""SELECT u.* FROM ({_URL_ROWS}) u
            JOIN (SELECT * FROM windows WHERE count_error > 10) USING (window_start, status)""",
            "windows",
        ),
        "report_error_flag": _with(f"SELECT event_id, {_FLAG} AS is_error FROM lines", "lines"),
        "error_rate_report": _with(
            f"""SELECT {_instant("(sec // 10 + 1) * 10")} AS reported_at, count(*) AS total,
                   count(*) FILTER (WHERE {_FLAG}) AS errors, errors / total * 100 AS error_rate,
                   strftime(reported_at, '%Y-%m-%d %H:%M:%S') || ', total=' || total
                   || ', errors=' || errors || ', error_rate='
                   || format('{{:.2f}}%', error_rate) AS line
            FROM lines GROUP BY sec // 10""",
            "lines",
        ),
        "topic_messages": _with(
            f"""SELECT topic, partition, "offset", {_instant("sec")} AS "timestamp"
            FROM messages""",
            "messages",
        ),
        "topic_offsets": _sampled("SELECT * FROM samples"),
        "topic_offsets_recent": _sampled(
            """SELECT * FROM samples
            WHERE sample_sec >= (SELECT max(sample_sec) FROM samples) - 60"""
        ),
        "alert_count_series": _sampled("SELECT * FROM samples", "alert_messages"),
        "topic_rate_1m": _sampled("SELECT * FROM rates"),
        "topic_rate_selected": _sampled("SELECT * FROM rates WHERE topic IN ('http-logs', 'alerts')"),
        "topic_delta_5m": _sampled(
            """SELECT sample_sec, topic, sum(change) / 5 AS value FROM five_minutes
            GROUP BY sample_sec, topic"""
        ),
        "consumer_delta_5m": _sampled(
            """SELECT sample_sec, CAST(NULL AS VARCHAR) AS consumergroup, topic,
                   sum(change) / 5 AS value
            FROM five_minutes GROUP BY sample_sec, topic"""
        ),
        "partitions_per_topic": _with(
            "SELECT topic, count(DISTINCT partition) AS partitions FROM messages GROUP BY topic",
            "messages",
        ),
        "topic_values": _with("SELECT DISTINCT topic FROM messages ORDER BY topic", "messages"),
        "job_values": _with(
            """SELECT DISTINCT CASE topic WHEN 'alerts' THEN 'kafka-exporter-alerts'
                   ELSE 'kafka-exporter' END AS job
            FROM messages ORDER BY job""",
            "messages",
        ),
        "instance_values": _with(
            """SELECT DISTINCT 'kafka-exporter-' || partition % 2 || ':9308' AS instance
            FROM messages WHERE topic <> 'alerts' ORDER BY instance""",
            "messages",
        ),
        "topic_delta_legend": _sampled(
            """SELECT topic, arg_max(value, sample_sec) AS last_value, max(value) AS max_value
            FROM (SELECT sample_sec, topic, sum(change) / 5 AS value FROM five_minutes
                  GROUP BY sample_sec, topic)
            WHERE value IS NOT NULL GROUP BY topic"""
        ),
        "consumer_delta_legend": _sampled(
            """SELECT CAST(NULL AS VARCHAR) AS consumergroup, topic,
                   arg_max(value, sample_sec) AS last_value, max(value) AS max_value
            FROM (SELECT sample_sec, topic, sum(change) / 5 AS value FROM five_minutes
                  GROUP BY sample_sec, topic)
            WHERE value IS NOT NULL GROUP BY topic"""
        ),
        "topic_rate_legend": _sampled(
            """SELECT topic, arg_max(value, sample_sec) AS last_value, max(value) AS max_value
            FROM rates WHERE value IS NOT NULL GROUP BY topic"""
        ),
        "new_alert_rule": _sampled(
            """SELECT sample_sec, topic, partition, CAST(change AS BIGINT) AS increase,
                   'New alert message detected' AS summary, 'critical' AS severity
            FROM minutes WHERE sample_sec % 60 = 0 AND change > 0""",
            "alert_messages",
        ),
        "latest_alerts": _with(
            """SELECT row_number() OVER (ORDER BY batch_id, CASE type
                   WHEN 'GLOBAL_ERROR_RATE' THEN 0 WHEN 'URL_ERROR_RATE' THEN 1 ELSE 2 END,
                   url, ip) - 1 AS "offset", *
            FROM alerts ORDER BY "offset" DESC LIMIT 20""",
            "alerts",
        ),
        "alert_rule_spans": _sampled(
            """SELECT topic, partition, state, min(sample_sec) AS since_sec,
                   max(sample_sec) AS until_sec, count(*) AS evaluations
            FROM (SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY sample_sec)
                         - row_number() OVER (PARTITION BY topic, partition, state
                                              ORDER BY sample_sec) AS stretch
                  FROM (SELECT topic, partition, sample_sec,
                               CASE WHEN change IS NULL THEN 'NoData' WHEN change > 0 THEN 'Alerting'
                                    ELSE 'Normal' END AS state
                        FROM (SELECT DISTINCT topic, partition FROM samples) CROSS JOIN
                             (SELECT unnest(range(CAST(ceil(min(sample_sec) / 60.0) AS BIGINT) * 60,
                                                  max(sample_sec) + 121, 60)) AS sample_sec
                              FROM samples)
                             LEFT JOIN minutes USING (topic, partition, sample_sec)))
            GROUP BY topic, partition, state, stretch""",
            "alert_messages",
        ),
        "stream_error_windows_update": _with(
            "SELECT * EXCLUDE (sketch) FROM sketched", "sketched"
        ),
        "stream_error_windows_append": _with(
            f"SELECT * EXCLUDE (sketch) FROM sketched WHERE {_CLOSED}", "sketched"
        ),
        "stream_open_windows": _with(f"SELECT * FROM windows WHERE NOT ({_CLOSED})", "windows"),
        "stream_window_top_urls": _with(f"SELECT * FROM ({_TOP_URLS}) WHERE {_CLOSED}", "windowed"),
        "stream_alerts_by_time": _with(
            f"SELECT * FROM timed_alerts WHERE {_CLOSED_SPAN}", "timed_alerts"
        ),
        "stream_alerts_dedup": _with(alerts, "alerts"),
        "stream_topic_rate": _sampled(
            """SELECT * FROM rates WHERE topic <> 'alerts' AND sample_sec <=
                   (SELECT max(sample_sec) FROM reached WHERE topic <> 'alerts') - 30"""
        ),
        "stream_late_errors": _with(
            """SELECT * EXCLUDE (part, seen),
                   least(3, CAST(floor((epoch(seen) - 30 - floor(epoch("timestamp") / 10) * 10) / 10)
                                 AS INTEGER)) AS windows_missed
            FROM delivered
            JOIN (SELECT part, max(max("timestamp")) OVER (
                             ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
                  FROM delivered GROUP BY part) USING (part)
            WHERE seen IS NOT NULL AND "timestamp" IS NOT NULL AND windows_missed > 0""",
            "errors",
            {"delivered": """
    SELECT ip, "timestamp", method, url, status,
           (sec - 1704067200 + CASE WHEN event_id % 53 = 0 THEN 150 ELSE 0 END) // 100 AS part
    FROM errors"""},
        ),
        "stream_window_alert_urls": _with(
            f"""SELECT u.* FROM ({_URL_ROWS}) u
            JOIN (SELECT * FROM windows WHERE count_error > 10) w USING (window_start, status)
            WHERE u.{_CLOSED}""",
            "windows",
        ),
        "stream_error_window_urls": _with(
            f"SELECT * FROM ({_URL_ROWS}) WHERE {_CLOSED}", "windowed"
        ),
        "stream_window_alerts": _with(
            f"""SELECT * EXCLUDE (count_distinct_ip), 'Alerte: trop d''erreurs' AS alert
            FROM windows WHERE count_error > 10 AND {_CLOSED}""",
            "windows",
        ),
        "stream_errors_json": _with(f"SELECT {_ERROR_JSON} AS value FROM errors", "errors"),
        "stream_offset_steps": _sampled(
            """SELECT topic, partition, sample_sec AS tick, reached AS offset_after FROM reached
            WHERE topic <> 'alerts'"""
        ),
        "stream_alerts": _with(
            """SELECT * EXCLUDE ("timestamp") FROM alerts""",
            "alerts",
        ),
        "stream_report": _with(
            f"""SELECT 'total=' || count(*) || ', errors=' || count(*) FILTER (WHERE {_FLAG})
                   || ', error_rate='
                   || format('{{:.2f}}%', count(*) FILTER (WHERE {_FLAG}) / count(*) * 100) AS line
            FROM lines GROUP BY batch_id""",
            "lines",
        ),
    }

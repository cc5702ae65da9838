"""Expected results as SQL straight over ``events``, without any JSON.

Each statement restates a query from the numbers of the events, so parsing,
rules and aggregation are checked against an independent computation.
"""

from gaugeline.plans.lens import AS_OF, DEEP, DOCUMENT_ROWS, MANY_BATCHES, PAGE_AFTER

NOW = f"TIMESTAMP '{AS_OF}'"


def _log(name: str, second: bool) -> str:
    """Flag columns of one log as common table expressions ``<name>_env`` and ``<name>``."""
    warmer = " + 1" if second else ""
    later = " + INTERVAL 1 MINUTE" if second else ""
    return f"""
{name}_env AS (
  SELECT event_id AS n, event_type AS source, ts, ts{later} AS ingested_ts,
    strftime(ts{later}, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at,
    CASE WHEN event_id % 97 = 0 THEN 'bad-id' WHEN event_id % 101 = 0 THEN NULL
         ELSE '00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') END AS event_id,
    CASE WHEN event_id % 103 = 0 THEN 'broken' WHEN event_id % 107 = 0 THEN 'text'
         ELSE 'full' END AS shape,
    value - 60{warmer} AS temperature, CAST(user_id AS DOUBLE) AS humidity
  FROM events),
{name}_rules AS (
  SELECT *, event_id IS NULL AS is_null_violation,
    event_id = 'bad-id' AS is_format_violation,
    shape <> 'broken' AS is_json_valid,
    CASE shape WHEN 'broken' THEN FALSE WHEN 'text' THEN NULL
      ELSE temperature < -50 OR temperature > 100 OR humidity < 0 OR humidity > 100
    END AS is_range_violation
  FROM {name}_env),
{name} AS (
  SELECT *, NOT is_null_violation AND is_json_valid AND NOT is_range_violation
    AND NOT is_format_violation AS is_valid
  FROM {name}_rules)"""


def _records(name: str, log: str) -> str:
    return f"""
{name} AS (
  SELECT event_id, source, ingested_ts AS ingested_at, n AS record_id, ts AS event_timestamp,
    temperature, humidity, temperature * 9 / 5 + 32 AS temperature_f,
    ts + to_seconds(CAST(n % 30 AS DOUBLE)) AS processed_at
  FROM {log} WHERE is_valid)"""


def _aggregates(name: str, records: str) -> str:
    return f"""
{name} AS (
  SELECT source, time_bucket(INTERVAL 5 MINUTES, event_timestamp) AS window_start,
    time_bucket(INTERVAL 5 MINUTES, event_timestamp) + INTERVAL 5 MINUTES AS window_end,
    avg(temperature) AS avg_temperature, avg(humidity) AS avg_humidity, count(*) AS record_count
  FROM {records} GROUP BY ALL)"""


def _metrics(name: str, log: str) -> str:
    return f"""
{name} AS (
  SELECT source, time_bucket(INTERVAL 5 MINUTES, ingested_ts) AS run_timestamp,
    count(*) AS total_records, count(*) FILTER (is_valid) AS valid_records,
    count(*) FILTER (NOT is_valid) AS invalid_records, CAST(0 AS BIGINT) AS duplicate_records,
    count(*) FILTER (is_null_violation) AS null_violations,
    count(*) FILTER (is_range_violation) AS range_violations, CAST(0 AS BIGINT) AS freshness_violations,
    count(*) FILTER (is_valid) / count(*) * 100.0 AS quality_rate
  FROM {log} GROUP BY ALL)"""


LOG = _log("log", second=False)
RECORDS = f"{LOG}, {_records('records', 'log')}"
AGGREGATES = f"{RECORDS}, {_aggregates('aggregates', 'records')}"
METRICS = f"{LOG}, {_metrics('metrics', 'log')}"
RECORDS_AND_METRICS = f"{RECORDS}, {_metrics('metrics', 'log')}"
BOTH_LOGS = f"{LOG}, {_log('late', second=True)}"
BOTH_RECORDS = f"{BOTH_LOGS}, {_records('records', 'log')}, {_records('late_records', 'late')}"
BOTH_AGGREGATES = (
    f"{BOTH_RECORDS}, {_aggregates('aggregates', 'records')}, "
    f"{_aggregates('late_aggregates', 'late_records')}"
)
SLICE = f"""{RECORDS_AND_METRICS},
recent AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY processed_at DESC, event_id) AS rank
  FROM records QUALIFY rank <= 500),
slice AS (
  SELECT *, count(*) OVER (PARTITION BY source) - rank + 1 AS seq,
    count(*) OVER (PARTITION BY source) AS size
  FROM recent),
points AS (
  SELECT source, 'temperature' AS field, seq, size, temperature AS v FROM slice
  UNION ALL SELECT source, 'humidity', seq, size, humidity FROM slice),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY source, field ORDER BY v) AS place FROM points),
quartiles AS (
  SELECT source, field, max(size) AS size, avg(v) AS avg_value, min(v) AS min_value,
    max(v) AS max_value,
    avg(v) FILTER (seq <= size // 2) AS first_mean, avg(v) FILTER (seq > size // 2) AS second_mean,
    max(v) FILTER (place = size // 4 + 1) AS q1, max(v) FILTER (place = (3 * size) // 4 + 1) AS q3
  FROM ordered GROUP BY source, field),
outliers AS (
  SELECT p.source, p.field, count(*) FILTER (
      v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS anomalies
  FROM points p JOIN quartiles q ON p.source = q.source AND p.field = q.field GROUP BY ALL),
trends AS (
  SELECT source, field,
    CASE WHEN size >= 4 AND first_mean <> 0
      THEN (second_mean - first_mean) / first_mean * 100 END AS change
  FROM quartiles),
summary AS (
  SELECT source, field, round(round(avg_value, 9), 2) AS avg_value,
    round(min_value, 2) AS min_value, round(max_value, 2) AS max_value,
    CASE WHEN change > 1 THEN 'Increasing' WHEN change < -1 THEN 'Decreasing' ELSE 'Stable' END AS direction,
    coalesce(round(round(change, 9), 1), 0) AS percentage,
    CASE WHEN size < 4 THEN 0 ELSE anomalies END AS anomalies
  FROM quartiles JOIN outliers USING (source, field) JOIN trends USING (source, field))"""
CARDS = f"""{RECORDS_AND_METRICS},
counts AS (SELECT source, count(*) AS valid FROM records GROUP BY source),
newest AS (
  SELECT * FROM metrics
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_timestamp DESC) = 1),
cards AS (
  SELECT source, coalesce(valid, 0) AS valid_records, coalesce(invalid_records, 0) AS invalid_records,
    CAST(0 AS BIGINT) AS duplicate_records, coalesce(null_violations, 0) AS null_violations,
    coalesce(range_violations, 0) AS range_violations
  FROM counts FULL JOIN newest USING (source)),
quality AS (
  SELECT *, valid_records + invalid_records AS total_records,
    greatest(0, invalid_records - null_violations - range_violations) AS format_violations,
    CASE WHEN valid_records + invalid_records > 0
      THEN round(valid_records / (valid_records + invalid_records) * 100.0, 2) END AS quality_rate
  FROM cards)"""
REGISTRY = """
registry AS (
  SELECT min(event_id) AS id, event_type AS name, 'http://sources.example/' || event_type AS url,
    CASE WHEN length(event_type) % 2 = 0 THEN NULL ELSE length(event_type) * 10 END AS poll_interval,
    CASE WHEN length(event_type) = 4 THEN 'paused' ELSE 'active' END AS status,
    min(ts) AS created_at, min(ts) AS updated_at
  FROM events GROUP BY event_type)"""

QUIET = "quiet AS (SELECT DISTINCT event_type || '-quiet' AS name FROM events)"
KPIS = f"""spans AS (
    SELECT source, count(*) AS size, min(processed_at) AS first, max(processed_at) AS last
    FROM slice GROUP BY source),
  rates AS (SELECT source, quality_rate FROM metrics
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_timestamp DESC) = 1),
  counts AS (SELECT source, count(*) AS total_records FROM records GROUP BY source)
  SELECT source, coalesce(total_records, 0) AS total_records,
    round(coalesce(quality_rate, 100.0), 6) AS quality_rate,
    CASE WHEN size > 1 AND last > first THEN round(size / epoch(last - first), 2) ELSE 0
      END AS ingestion_rate,
    CAST(trunc(epoch({NOW} - last)) AS BIGINT) AS freshness_seconds
  FROM counts FULL JOIN spans USING (source) FULL JOIN rates USING (source)"""

RECORD_COLUMNS = """event_id, source, ingested_at, record_id, event_timestamp,
  round(temperature, 6) AS temperature, round(humidity, 6) AS humidity,
  round(temperature_f, 6) AS temperature_f, processed_at"""
PAYLOAD_COLUMNS = """record_id AS payload_id, round(temperature, 6) AS payload_temperature,
  round(humidity, 6) AS payload_humidity"""
AGGREGATE_COLUMNS = """source, window_start, window_end, round(avg_temperature, 6) AS avg_temperature,
  round(avg_humidity, 6) AS avg_humidity, record_count"""
METRIC_COLUMNS = """source, run_timestamp, total_records, valid_records, invalid_records,
  duplicate_records, null_violations, range_violations, freshness_violations,
  round(quality_rate, 6) AS quality_rate"""
FLAG_COLUMNS = """source, ingested_ts, event_id, is_null_violation, is_format_violation, is_json_valid"""
LAKE_COLUMNS = """source, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, ingested_at"""
DAILY = """CAST(window_start AS DATE) AS summary_date, source, CAST(sum(record_count) AS BIGINT) AS total_records,
  round(round(avg(avg_temperature), 9), 2) AS avg_temperature,
  round(round(avg(avg_humidity), 9), 2) AS avg_humidity"""
TODAY = f"CAST(window_start AS DATE) = CAST({NOW} AS DATE)"
QUALITY_SUMS = """source, CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(valid_records) AS BIGINT) AS valid_records,
  CAST(sum(invalid_records) AS BIGINT) AS invalid_records, CAST(sum(null_violations) AS BIGINT) AS null_violations,
  CAST(sum(range_violations) AS BIGINT) AS range_violations"""
RATE = "sum(valid_records) / sum(total_records) * 100.0"


def _page(rows: str, order: str) -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY source ORDER BY {order}) AS place
  FROM {rows} QUALIFY place > 5 AND place <= 25)"""


UPSERTED_AGGREGATES = f"""{BOTH_AGGREGATES},
upserted AS (
  SELECT source, window_start, coalesce(a.window_end, b.window_end) AS window_end,
    CASE WHEN b.source IS NULL THEN a.avg_temperature ELSE b.avg_temperature END AS avg_temperature,
    CASE WHEN b.source IS NULL THEN a.avg_humidity ELSE b.avg_humidity END AS avg_humidity,
    CASE WHEN b.source IS NULL THEN a.record_count ELSE b.record_count END AS record_count
  FROM aggregates a FULL JOIN late_aggregates b USING (source, window_start))"""

_QUARANTINED = f"WITH {LOG} SELECT source, event_id, ingested_at FROM log WHERE NOT is_valid"
_PROCESSED = f"""WITH {RECORDS} SELECT event_id, source, ingested_at, record_id AS id,
  event_timestamp AS timestamp, round(temperature, 6) AS temperature, round(humidity, 6) AS humidity,
  round(temperature_f, 6) AS temperature_f, processed_at, year(event_timestamp) AS year,
  month(event_timestamp) AS month, day(event_timestamp) AS day, hour(event_timestamp) AS hour
  FROM records"""
_RAW = f"WITH {LOG} SELECT {LAKE_COLUMNS} FROM log"
_UPSERTED_RECORDS = f"""WITH {BOTH_RECORDS} SELECT event_id,
  coalesce(a.source, b.source) AS source, coalesce(a.ingested_at, b.ingested_at) AS ingested_at,
  coalesce(a.record_id, b.record_id) AS record_id,
  coalesce(a.event_timestamp, b.event_timestamp) AS event_timestamp,
  round(coalesce(b.temperature, a.temperature), 6) AS temperature,
  round(coalesce(b.humidity, a.humidity), 6) AS humidity,
  round(coalesce(a.temperature_f, b.temperature_f), 6) AS temperature_f,
  coalesce(b.processed_at, a.processed_at) AS processed_at,
  coalesce(b.record_id, a.record_id) AS payload_id,
  round(coalesce(b.temperature, a.temperature), 6) AS payload_temperature,
  round(coalesce(b.humidity, a.humidity), 6) AS payload_humidity
  FROM records a FULL JOIN late_records b USING (event_id)"""
_FIRST_RECORDS = f"""WITH {BOTH_RECORDS}, sent AS (FROM records UNION ALL FROM late_records)
SELECT {RECORD_COLUMNS}, {PAYLOAD_COLUMNS} FROM (
  SELECT * FROM sent QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at) = 1)"""
_AGGREGATES = f"WITH {AGGREGATES} SELECT {AGGREGATE_COLUMNS} FROM aggregates"
_METRICS = f"WITH {METRICS} SELECT {METRIC_COLUMNS} FROM metrics"

def _late(known: str) -> str:
    """Windows of the first log and of late records that an earlier batch, ``known``, leaves in time."""
    return f"""WITH {BOTH_RECORDS}, days AS (
        SELECT day, ntile({MANY_BATCHES}) OVER (ORDER BY day) AS span
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)),
      sent AS (
        FROM records UNION ALL SELECT * FROM late_records WHERE event_id NOT IN (SELECT event_id FROM records)
          AND event_timestamp > (SELECT max(event_timestamp) - INTERVAL 10 MINUTES FROM {known})),
      {_aggregates('aggregates', 'sent')} SELECT {AGGREGATE_COLUMNS} FROM aggregates"""


_BOTH_RAW = f"""WITH {BOTH_LOGS}, sent AS (
    SELECT source, ingested_ts, ingested_at FROM log UNION ALL SELECT source, ingested_ts, ingested_at FROM late)
  SELECT source, year(ingested_ts) AS year, month(ingested_ts) AS month, day(ingested_ts) AS day,
    hour(ingested_ts) AS hour, ingested_at FROM sent"""

_INSIGHTS = f"""WITH {SLICE}, sentences AS (
        SELECT source, field, 0 AS part, upper(field[1]) || field[2:] || CASE direction
          WHEN 'Increasing' THEN printf(' increased %.1f%% compared with the previous period.', percentage)
          WHEN 'Decreasing' THEN printf(' decreased %.1f%% compared with the previous period.', abs(percentage))
          ELSE ' remained relatively stable.' END AS insight FROM summary
        UNION ALL SELECT source, field, 1,
          '⚠ ' || anomalies || ' potential anomalies detected in ' || field || '.'
          FROM summary WHERE anomalies > 0)
      SELECT source, row_number() OVER (PARTITION BY source ORDER BY field, part) - 1 AS position, insight
      FROM sentences"""

ORACLES = {
    "parse_envelope": f"""WITH {LOG} SELECT event_id, source, ingested_at, ingested_ts,
        CASE WHEN shape = 'broken' THEN CAST(7 AS BIGINT) END AS broken_length,
        CASE WHEN shape = 'full' THEN n END AS payload_id,
        CASE WHEN shape = 'full' THEN round(temperature, 6) END AS payload_temperature FROM log""",
    "dq_flags": f"WITH {LOG} SELECT {FLAG_COLUMNS}, is_range_violation, is_valid FROM log",
    "dq_flags_strict": f"""WITH {LOG} SELECT {FLAG_COLUMNS},
        coalesce(is_range_violation, FALSE) AS is_range_violation,
        NOT is_null_violation AND is_json_valid AND NOT coalesce(is_range_violation, FALSE)
          AND NOT is_format_violation AND shape <> 'text' AS is_valid,
        shape = 'text' AS is_type_violation FROM log""",
    "quarantine": f"""WITH {LOG} SELECT source, event_id, ingested_at, concat_ws(',',
        CASE WHEN is_null_violation THEN 'null' END, CASE WHEN is_format_violation THEN 'format' END,
        CASE WHEN NOT is_json_valid THEN 'json' END,
        CASE WHEN is_range_violation THEN 'range' END) AS reason FROM log WHERE NOT is_valid""",
    "processed_records": f"WITH {RECORDS} SELECT {RECORD_COLUMNS}, {PAYLOAD_COLUMNS} FROM records",
    "raw_partitions": _RAW,
    "lake_read": f"WITH {LOG} SELECT {LAKE_COLUMNS} FROM log WHERE source = 'click'",
    "constraint_rejects": f"""WITH {LOG}, typed AS (
        SELECT event_id, source, ingested_ts AS ingested_at,
          CASE WHEN shape = 'full' THEN round(temperature, 6) END AS temperature,
          CASE WHEN shape = 'full' THEN round(humidity, 6) END AS humidity FROM log)
      SELECT *, concat_ws(',', CASE WHEN event_id IS NULL THEN 'not_null_event_id' END,
        CASE WHEN event_id IS NULL OR event_id = 'bad-id' THEN 'not_null_processed_at' END,
        CASE WHEN temperature < -50 OR temperature > 100 THEN 'range_temperature' END,
        CASE WHEN humidity < 0 OR humidity > 100 THEN 'range_humidity' END) AS broken_rules FROM typed""",
    "constraint_report": f"""WITH {BOTH_LOGS}, sent AS (
        SELECT event_id, shape, temperature, humidity FROM log
        UNION ALL SELECT event_id, shape, temperature, humidity FROM late),
      full_rows AS (SELECT * FROM sent WHERE shape = 'full')
      SELECT 'range_temperature' AS rule, count(*) AS violations FROM full_rows
        WHERE temperature < -50 OR temperature > 100
      UNION ALL SELECT 'range_humidity', count(*) FROM full_rows WHERE humidity < 0 OR humidity > 100
      UNION ALL SELECT 'not_null_event_id', count(*) FROM sent WHERE event_id IS NULL
      UNION ALL SELECT 'not_null_processed_at', count(*) FILTER (event_id IS NULL OR event_id = 'bad-id') FROM sent
      UNION ALL SELECT 'not_null_source', 0 UNION ALL SELECT 'not_null_ingested_at', 0
      UNION ALL SELECT 'unique_event_id', count(event_id) - count(DISTINCT event_id) FROM sent""",
    "constraint_report_aggregates": f"""WITH {BOTH_AGGREGATES}, sent AS (
        SELECT source, window_start FROM aggregates UNION ALL SELECT source, window_start FROM late_aggregates)
      SELECT 'unique_source_window_start' AS rule,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sent)) AS violations FROM sent
      UNION ALL SELECT unnest(['not_null_source', 'not_null_window_start', 'not_null_window_end']), 0""",
    "constraint_report_metrics": f"""WITH {BOTH_LOGS}, {_metrics('metrics', 'log')},
      {_metrics('late_metrics', 'late')}, sent AS (
        SELECT source, run_timestamp FROM metrics UNION ALL SELECT source, run_timestamp FROM late_metrics)
      SELECT 'unique_source_run_timestamp' AS rule,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sent)) AS violations FROM sent
      UNION ALL SELECT unnest(['not_null_source', 'not_null_run_timestamp']), 0""",
    "normalize_payload": f"""WITH placed AS (
        SELECT event_type AS source, event_id // {DOCUMENT_ROWS} AS run, event_id AS id,
          value - 60 AS temperature, row_number() OVER (
            PARTITION BY event_type, event_id // {DOCUMENT_ROWS} ORDER BY event_id) - 1 AS position
        FROM events)
      SELECT source, run, position, id, round(temperature, 6) AS temperature,
        CASE WHEN run % 4 <> 2 THEN run END AS batch, CAST(NULL AS BIGINT) AS first_id
      FROM placed WHERE run % 4 <> 3
      UNION ALL SELECT source, run, 0, NULL, NULL, run, id FROM placed WHERE run % 4 = 3""",
    "normalize_nested_repeats": """WITH made AS (
        SELECT event_type AS source, event_id, 0 AS position, event_id AS id,
          CASE WHEN event_id % 3 = 1 THEN event_id END AS batch,
          CASE WHEN event_id % 3 = 2 THEN '{"a":' || event_id || '}' END AS meta
        FROM events
        UNION ALL SELECT event_type, event_id, 1, CASE event_id % 3 WHEN 0 THEN -1 ELSE 7 END,
          CASE WHEN event_id % 3 = 1 THEN event_id END,
          CASE WHEN event_id % 3 = 0 THEN '{"a":' || event_id || '}' END
        FROM events WHERE event_id % 3 < 2)
      SELECT source, event_id, CAST(position AS BIGINT) AS position, CAST(id AS BIGINT) AS id, batch, meta FROM made""",
    "normalize_rejects": """SELECT event_type AS source, event_id, CASE
        WHEN event_id % 7 < 2 THEN 'no text' WHEN event_id % 7 = 2 THEN 'no JSON' ELSE 'no object' END AS reason
      FROM events WHERE event_id % 7 < 5""",
    "envelope_build": """SELECT 'telemetry.raw.' || event_type AS topic, event_type AS key,
        CAST(event_id AS VARCHAR) AS event_id, event_type AS source,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at, event_id AS payload_id,
        round(value, 6) AS payload_value FROM events""",
    "infer_schema": f"""WITH {LOG}, fields AS (
        SELECT source, 'temperature' AS field, 'string' AS field_type FROM log WHERE shape = 'text'
        UNION ALL SELECT source, unnest(['id', 'temperature', 'humidity']), 'numeric' FROM log
          WHERE shape = 'full'
        UNION ALL SELECT source, 'timestamp', 'datetime' FROM log WHERE shape = 'full'
        UNION ALL SELECT event_type, 'k', 'numeric' FROM events)
      SELECT source, field, field_type, count(*) AS documents FROM fields GROUP BY ALL""",
    "dedup_events": _FIRST_RECORDS,
    "upsert_records": _UPSERTED_RECORDS,
    "keyed_base_merge": _UPSERTED_RECORDS,
    "purged_table": f"""WITH {RECORDS} SELECT {RECORD_COLUMNS}, {PAYLOAD_COLUMNS} FROM records
      WHERE event_timestamp >= {NOW} - INTERVAL 7 DAYS OR event_timestamp IS NULL""",
    "upsert_aggregates": f"WITH {UPSERTED_AGGREGATES} SELECT {AGGREGATE_COLUMNS} FROM upserted",
    "upsert_metrics": f"""WITH {BOTH_LOGS}, {_metrics('metrics', 'log')},
      {_metrics('late_metrics', 'late')}, sent AS (
        SELECT *, 0 AS batch FROM metrics UNION ALL SELECT *, 1 FROM late_metrics)
      SELECT {METRIC_COLUMNS} FROM (SELECT * FROM sent
        QUALIFY row_number() OVER (PARTITION BY source, run_timestamp ORDER BY batch DESC) = 1)""",
    "upsert_daily": f"""WITH {UPSERTED_AGGREGATES} SELECT {DAILY}, {NOW} AS last_updated
      FROM upserted WHERE {TODAY} GROUP BY source, CAST(window_start AS DATE)""",
    "window_5m": _AGGREGATES,
    "dq_metrics_5m": _METRICS,
    "dq_metrics_duplicates": f"""WITH {METRICS}, repeats AS (
        SELECT source, time_bucket(INTERVAL 5 MINUTES, ingested_ts) AS run_timestamp,
          2 * count(event_id) - count(DISTINCT event_id) AS repeats FROM log GROUP BY ALL)
      SELECT source, run_timestamp, repeats AS duplicate_records
      FROM metrics JOIN repeats USING (source, run_timestamp)""",
    "daily_rollup": f"""WITH {AGGREGATES} SELECT {DAILY}, {NOW} AS last_updated
      FROM aggregates WHERE {TODAY} GROUP BY source, CAST(window_start AS DATE)""",
    "daily_rollup_weighted": f"""WITH {RECORDS} SELECT CAST(event_timestamp AS DATE) AS summary_date,
        source, count(*) AS total_records, round(round(avg(temperature), 9), 2) AS avg_temperature,
        round(round(avg(humidity), 9), 2) AS avg_humidity, {NOW} AS last_updated
      FROM records WHERE CAST(event_timestamp AS DATE) = CAST({NOW} AS DATE)
      GROUP BY source, CAST(event_timestamp AS DATE)""",
    "processing_summary": f"""WITH {RECORDS} SELECT source, max(event_timestamp) AS latest_event_time,
        max(processed_at) AS latest_processing_time, count(*) AS total_records,
        round(epoch({NOW} - max(processed_at)), 6) AS freshness_seconds
      FROM records GROUP BY source""",
    "quality_summary": f"""WITH {METRICS} SELECT {QUALITY_SUMS}, round({RATE}, 6) AS quality_rate
      FROM metrics GROUP BY source""",
    "quality_summary_rounded": f"""WITH {METRICS} SELECT {QUALITY_SUMS}, round({RATE}, 2) AS quality_rate
      FROM metrics GROUP BY source""",
    "stat_panel": f"""WITH {METRICS} SELECT round({RATE}, 6) AS quality_rate
      FROM metrics WHERE source = 'click'""",
    "stat_panel_processing": f"""WITH {RECORDS} SELECT max(event_timestamp) AS latest_event_time
      FROM records WHERE source = 'click'""",
    "latest_metrics": f"WITH {CARDS} SELECT {METRIC_COLUMNS} FROM newest",
    "source_quality": f"WITH {CARDS} SELECT * FROM quality",
    "source_quality_tables": f"WITH {CARDS} SELECT * FROM quality",
    "source_kpis": f"WITH {SLICE}, {KPIS}",
    "source_quality_registered": f"""WITH {CARDS}, {QUIET} SELECT * FROM quality
      UNION ALL SELECT name, 0, 0, 0, 0, 0, 0, 0, NULL FROM quiet""",
    "source_kpis_registered": f"""WITH {SLICE}, {QUIET}, {KPIS} UNION ALL
      SELECT name, 0, 100.0, 0, NULL FROM quiet""",
    "overview_kpis": f"""WITH {CARDS}, {REGISTRY}
      SELECT count(*) FILTER (status = 'active') AS active_sources, count(*) AS configured_sources,
        CAST(coalesce(sum(total_records), 0) AS BIGINT) AS total_records,
        round(avg(quality_rate), 6) AS avg_quality_rate
      FROM registry LEFT JOIN quality ON name = source""",
    "violation_breakdown": f"""WITH {CARDS}, tall AS (
        SELECT source, unnest(['null', 'range', 'format', 'duplicate']) AS violation,
          unnest([null_violations, range_violations, format_violations, duplicate_records]) AS records,
          null_violations + range_violations + format_violations + duplicate_records AS whole
        FROM quality)
      SELECT source, violation, records, round(records / greatest(whole, 1) * 100.0, 6) AS share
      FROM tall""",
    "active_sources": f"WITH {REGISTRY} SELECT * FROM registry WHERE status = 'active'",
    "poll_interval": f"""WITH {REGISTRY} SELECT coalesce(min(coalesce(poll_interval, 60)), 60)
        AS poll_interval FROM registry WHERE status = 'active'""",
    "last_500": f"WITH {SLICE} SELECT source, seq, event_id, event_timestamp, processed_at FROM slice",
    "last_10": f"WITH {SLICE} SELECT source, rank, event_id, processed_at FROM slice WHERE rank <= 10",
    "classify_fields": f"""WITH {SLICE} SELECT source,
        unnest(['id', 'timestamp', 'temperature', 'humidity']) AS field,
        unnest(['identifier', 'dimension', 'metric', 'identifier']) AS role
      FROM slice WHERE rank = 1""",
    "classify_fields_repeated_names": f"""WITH {SLICE} SELECT source,
        unnest(['id', 'timestamp', 'temperature', 'humidity']) AS field,
        unnest(['identifier', 'dimension', 'metric', 'identifier']) AS role
      FROM slice WHERE rank = 1""",
    "metric_summary_repeated_names": f"WITH {SLICE} SELECT * FROM summary",
    "metric_summary": f"WITH {SLICE} SELECT * FROM summary WHERE field = 'temperature'",
    "metric_summary_exact_id": f"WITH {SLICE} SELECT * FROM summary",
    "iqr_anomalies": f"WITH {SLICE} SELECT source, field, anomalies FROM summary",
    "half_trend": f"WITH {SLICE} SELECT source, field, direction, percentage FROM summary",
    "insights": _INSIGHTS,
    "insights_nested_repeats": _INSIGHTS,
    "records_page": f"""WITH {RECORDS} SELECT {RECORD_COLUMNS}
      FROM {_page('records', 'event_timestamp DESC NULLS FIRST, event_id')}""",
    "records_page_one_source": f"""WITH {RECORDS} SELECT {RECORD_COLUMNS} FROM records
      WHERE source = 'click' ORDER BY event_timestamp DESC NULLS FIRST, event_id LIMIT 20 OFFSET 5""",
    "records_page_after": f"""WITH {RECORDS} SELECT {RECORD_COLUMNS} FROM records
      WHERE source = 'click' AND (event_timestamp < TIMESTAMP '{PAGE_AFTER[0]}'
        OR event_timestamp = TIMESTAMP '{PAGE_AFTER[0]}' AND event_id > '{PAGE_AFTER[1]}')
      ORDER BY event_timestamp DESC NULLS FIRST, event_id LIMIT 20""",
    "records_page_deep": f"""WITH {RECORDS} SELECT {RECORD_COLUMNS} FROM records
      WHERE source = 'click' ORDER BY event_timestamp DESC NULLS FIRST, event_id LIMIT 20 OFFSET {DEEP}""",
    "aggregates_page_after": f"""WITH {AGGREGATES} SELECT source, window_start, window_end,
        CASE WHEN avg_temperature <> 0 THEN round(round(avg_temperature, 9), 2) END AS avg_temperature,
        CASE WHEN avg_humidity <> 0 THEN round(round(avg_humidity, 9), 2) END AS avg_humidity, record_count
      FROM aggregates WHERE source = 'click' AND window_start < TIMESTAMP '{PAGE_AFTER[0]}'
      ORDER BY window_start DESC LIMIT 20""",
    "recent_records": f"""WITH {RECORDS} SELECT source, event_id, event_timestamp,
        round(temperature, 6) AS temperature, round(humidity, 6) AS humidity,
        round(temperature, 6) AS payload_temperature FROM records
      QUALIFY row_number() OVER (
        PARTITION BY source ORDER BY event_timestamp DESC NULLS FIRST, event_id) <= 20""",
    "aggregates_page": f"""WITH {AGGREGATES} SELECT source, window_start, window_end,
        CASE WHEN avg_temperature <> 0 THEN round(round(avg_temperature, 9), 2) END AS avg_temperature,
        CASE WHEN avg_humidity <> 0 THEN round(round(avg_humidity, 9), 2) END AS avg_humidity,
        record_count FROM {_page('aggregates', 'window_start DESC NULLS FIRST')}""",
    "ingest_series": f"""WITH {RECORDS} SELECT event_timestamp AS time, CAST(1 AS BIGINT) AS ingested FROM records
      ORDER BY event_timestamp DESC NULLS FIRST, event_id LIMIT 100""",
    "latency_series": f"""WITH {RECORDS} SELECT event_timestamp AS time,
        round(epoch(processed_at - event_timestamp), 6) AS latency FROM records
      ORDER BY event_timestamp DESC NULLS FIRST, event_id LIMIT 100""",
    "trend_series": f"""WITH {AGGREGATES} SELECT window_start AS time,
        round(avg_temperature, 6) AS value, source FROM aggregates
      ORDER BY window_start DESC NULLS FIRST, source LIMIT 100""",
    "trend_series_humidity": f"""WITH {AGGREGATES} SELECT window_start AS time,
        round(avg_humidity, 6) AS value, source FROM aggregates
      ORDER BY window_start DESC NULLS FIRST, source LIMIT 100""",
    "check_freshness": f"""WITH {RECORDS} SELECT 'freshness' AS check_name, max(processed_at) AS value,
        {NOW} - INTERVAL 15 MINUTES AS threshold,
        coalesce(max(processed_at) >= {NOW} - INTERVAL 15 MINUTES, TRUE) AS passed FROM records""",
    "check_quality_rate": f"""WITH {METRICS} SELECT 'quality_rate' AS check_name, source,
        round({RATE}, 6) AS value, CAST(95 AS DOUBLE) AS threshold, {RATE} >= 95.0 AS passed
      FROM metrics GROUP BY source""",
    "retention_purge": f"""WITH {RECORDS} SELECT {RECORD_COLUMNS}, {PAYLOAD_COLUMNS} FROM records
      WHERE event_timestamp >= {NOW} - INTERVAL 7 DAYS OR event_timestamp IS NULL""",
    "freshness_bucket": f"""WITH {RECORDS}, ages AS (
        SELECT source, epoch({NOW} - max(processed_at)) AS age FROM records GROUP BY source)
      SELECT source, CASE WHEN age < 60 THEN 'Live'
        WHEN age < 3600 THEN CAST(CAST(floor(age / 60) AS BIGINT) AS VARCHAR) || 'm ago'
        ELSE CAST(CAST(floor(age / 3600) AS BIGINT) AS VARCHAR) || 'h ago' END AS freshness FROM ages""",
    "stream_late": _late("records"),
    "stream_many_batches": _late(
        f"records JOIN days ON day = CAST(event_timestamp AS DATE) AND span < {MANY_BATCHES}"
    ),
    "stream_chained": _AGGREGATES,
    "lake_compacted": _BOTH_RAW,
    "stream_metrics_late": f"""WITH {BOTH_LOGS}, sent AS (
        FROM log UNION ALL SELECT * FROM late
        WHERE time_bucket(INTERVAL 5 MINUTES, ingested_ts) + INTERVAL 5 MINUTES
          > (SELECT max(ingested_ts) - INTERVAL 5 MINUTES FROM log)),
      {_metrics('metrics', 'sent')} SELECT {METRIC_COLUMNS} FROM metrics""",
    "stream_restart": _UPSERTED_RECORDS,
    "stream_raw": _RAW,
    "stream_quarantine": _QUARANTINED,
    "stream_records": _FIRST_RECORDS,
    "stream_processed": _PROCESSED,
    "stream_aggregates": _AGGREGATES,
    "stream_metrics": _METRICS,
}

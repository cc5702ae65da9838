"""Schemas and fixed values shared by the batch and the streaming jobs."""

ENVELOPE = "event_id STRING, source STRING, ingested_at STRING, payload STRING"

RECORDS = (
    "event_id STRING, source STRING, ingested_at TIMESTAMP, record_id BIGINT, "
    "event_timestamp TIMESTAMP, temperature DOUBLE, humidity DOUBLE, "
    "temperature_f DOUBLE, payload STRING, processed_at TIMESTAMP"
)
AGGREGATES = (
    "source STRING, window_start TIMESTAMP, window_end TIMESTAMP, "
    "avg_temperature DOUBLE, avg_humidity DOUBLE, record_count BIGINT"
)
METRICS = (
    "source STRING, run_timestamp TIMESTAMP, total_records BIGINT, "
    "valid_records BIGINT, invalid_records BIGINT, duplicate_records BIGINT, "
    "null_violations BIGINT, range_violations BIGINT, "
    "freshness_violations BIGINT, quality_rate DOUBLE"
)
DAILY = (
    "summary_date DATE, source STRING, total_records BIGINT, "
    "avg_temperature DECIMAL(5,2), avg_humidity DECIMAL(5,2), last_updated TIMESTAMP"
)
REGISTRY = (
    "id BIGINT, name STRING, url STRING, poll_interval INT, schema STRING, "
    "status STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)

RAW_LAKE = "source STRING, raw_value STRING, year INT, month INT, day INT, hour INT"
PROCESSED_LAKE = (
    "event_id STRING, source STRING, ingested_at TIMESTAMP, payload STRING, id BIGINT, timestamp TIMESTAMP, "
    "temperature DOUBLE, humidity DOUBLE, temperature_f DOUBLE, processed_at TIMESTAMP, "
    "year INT, month INT, day INT, hour INT"
)
QUARANTINE = "source STRING, raw_value STRING"

LAKE_PARTITIONS = ["source", "year", "month", "day", "hour"]
TIME_PARTITIONS = ["year", "month", "day", "hour"]

# Keys, first-write columns and last-write columns of the serving tables.
RECORD_KEYS = ["event_id"]
RECORD_FROZEN = ["source", "ingested_at", "record_id", "event_timestamp", "temperature_f"]
RECORD_MUTABLE = ["temperature", "humidity", "payload", "processed_at"]
AGGREGATE_KEYS = ["source", "window_start"]
AGGREGATE_FROZEN = ["window_end"]
AGGREGATE_MUTABLE = ["avg_temperature", "avg_humidity", "record_count"]
METRIC_KEYS = ["source", "run_timestamp"]
METRIC_FROZEN = ["duplicate_records", "freshness_violations"]
METRIC_MUTABLE = [
    "total_records",
    "valid_records",
    "invalid_records",
    "null_violations",
    "range_violations",
    "quality_rate",
]
DAILY_KEYS = ["summary_date", "source"]
DAILY_FROZEN: list[str] = []
DAILY_MUTABLE = ["total_records", "avg_temperature", "avg_humidity", "last_updated"]

# Columns a stored row must have.
RECORD_REQUIRED = ["event_id", "source", "ingested_at", "processed_at"]
AGGREGATE_REQUIRED = ["source", "window_start", "window_end", "record_count"]
METRIC_REQUIRED = [name.split()[0] for name in METRICS.split(", ")]

# Thresholds, intervals and labels that decide results.
EVENT_ID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
TEMPERATURE_RANGE = (-50.0, 100.0)
HUMIDITY_RANGE = (0.0, 100.0)
WINDOW_LENGTH = "5 minutes"
EVENT_WATERMARK = "10 minutes"
INGEST_WATERMARK = "5 minutes"
SLICE_SIZE = 500
SERIES_SIZE = 100
PAGE_SIZE = 20
PAGE_LIMIT = 1000
DEFAULT_POLL_SECONDS = 60
FRESHNESS_LIMIT = "15 minutes"
RETENTION = "7 days"
QUALITY_THRESHOLD = 95.0
IQR_FACTOR = 1.5
TREND_THRESHOLD = 1.0
MIN_SERIES = 4

# Rows whose source is unknown still need a key in the metrics table.
UNKNOWN_SOURCE = "__unknown__"

"""The registered queries: each operator over the whole ``events`` table."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline import schema
from gaugeline.operators import analytics, checks, normalize, pages, quality, registry, summaries
from gaugeline.operators.parse import parse_envelopes, raw_lake_rows
from gaugeline.operators.ranking import first_per_key
from gaugeline.operators.upsert import merge_batches
from gaugeline.operators.windows import count_duplicates
from gaugeline.plans.lens import DEEP, MANY_BATCHES, PAGE_AFTER, EventsLens, as_of, processing_time
from gaugeline.session import work_folder
from gaugeline.sources.keyed import RECORDS, KeyedTable
from gaugeline.sources.lake import BatchLake
from gaugeline.sources.readers import file_log, read_lake
from gaugeline.sources.writers import write_lake, write_text_log
from gaugeline.streaming.app import TelemetryApp

#: Times of the two compactions of ``lake_compacted``.
CLOSED_BEFORE = [datetime(2024, 1, 10), datetime(2024, 1, 20)]

Query = Callable[[EventsLens], DataFrame]
CATALOGUE: dict[str, Query] = {}


def query(build: Query) -> Query:
    CATALOGUE[build.__name__] = build
    return build


def comparable(rows: DataFrame) -> DataFrame:
    """Zone-free times, one integer and one fractional type, six digits.

    Engines differ in these, and in the last bits of an average.
    """
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(EventsLens(spark, sf_dir)))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        return run

    return {name: runner(build) for name, build in CATALOGUE.items()}


# Parsing, rules and routing


@query
def parse_envelope(lens: EventsLens) -> DataFrame:
    rows = lens.parsed(lens.first_log)
    return rows.select(
        "event_id",
        "source",
        "ingested_at",
        "ingested_ts",
        F.length("payload_broken").alias("broken_length"),
        F.col("payload_id").try_cast("bigint").alias("payload_id"),
        F.col("payload_temperature").try_cast("double").alias("payload_temperature"),
    )


FLAGS = ["is_null_violation", "is_format_violation", "is_json_valid", "is_range_violation", "is_valid"]


@query
def dq_flags(lens: EventsLens) -> DataFrame:
    return lens.flagged(lens.first_log).select("source", "ingested_ts", "event_id", *FLAGS)


@query
def dq_flags_strict(lens: EventsLens) -> DataFrame:
    rows = quality.flag_quality(lens.parsed(lens.first_log), strict_types=True, strict_json=True)
    return rows.select("source", "ingested_ts", "event_id", *FLAGS, "is_type_violation")


@query
def quarantine(lens: EventsLens) -> DataFrame:
    rows = quality.quarantine_rows(lens.flagged(lens.first_log), with_reason=True)
    return _quarantined(rows, "reason")


def _quarantined(rows: DataFrame, *more: str) -> DataFrame:
    """Envelope fields instead of the text, whose number format differs by engine."""
    return rows.select(
        "source",
        F.get_json_object("raw_value", "$.event_id").alias("event_id"),
        F.get_json_object("raw_value", "$.ingested_at").alias("ingested_at"),
        *more,
    )


def _payload_members(rows: DataFrame) -> DataFrame:
    """The members of the stored payload instead of its text, whose number format differs by engine."""
    member = lambda name, kind: F.get_json_object("payload", f"$.{name}").cast(kind)
    return rows.withColumns(
        {
            "payload_id": member("id", "bigint"),
            "payload_temperature": member("temperature", "double"),
            "payload_humidity": member("humidity", "double"),
        }
    ).drop("payload")


@query
def processed_records(lens: EventsLens) -> DataFrame:
    return _payload_members(lens.records)


@query
def raw_partitions(lens: EventsLens) -> DataFrame:
    return _located(raw_lake_rows(parse_envelopes(lens.first_log)))


def _located(rows: DataFrame) -> DataFrame:
    return rows.select(
        *schema.LAKE_PARTITIONS, F.get_json_object("raw_value", "$.ingested_at").alias("ingested_at")
    )


@query
def lake_read(lens: EventsLens) -> DataFrame:
    """Store the raw lake, then read one source of it through its partition."""
    path = work_folder(lens.spark, "raw-lake")
    rows = raw_lake_rows(parse_envelopes(lens.first_log))
    tasks = lens.spark.sparkContext.defaultParallelism
    write_lake(rows, path, schema.LAKE_PARTITIONS, tasks=tasks, split_on="raw_value")
    return _located(read_lake(lens.spark, path, schema.RAW_LAKE, source="click"))


@query
def constraint_rejects(lens: EventsLens) -> DataFrame:
    """Rows of a table whose constraints were enforced on writing, and the rows they kept out with the rules."""
    rows = lens.parsed(lens.first_log).select(
        "event_id",
        "source",
        F.col("ingested_ts").alias("ingested_at"),
        F.col("payload_id").try_cast("bigint").alias("record_id"),
        F.lit(None).cast("timestamp").alias("event_timestamp"),
        F.col("payload_temperature").try_cast("double").alias("temperature"),
        F.col("payload_humidity").try_cast("double").alias("humidity"),
        F.lit(None).cast("double").alias("temperature_f"),
        "payload",
        F.when(F.col("event_id") != "bad-id", as_of()).alias("processed_at"),
    )
    table = KeyedTable(lens.spark, work_folder(lens.spark, "checked"), RECORDS)
    table.upsert(rows, 0)
    table.compact()
    columns = ["event_id", "source", "ingested_at", "temperature", "humidity", "broken_rules"]
    return table.latest().withColumn("broken_rules", F.lit("")).select(columns).unionAll(table.rejects().select(columns))


@query
def constraint_report(lens: EventsLens) -> DataFrame:
    rows = lens.parsed(lens.both_logs).select(
        "event_id",
        "source",
        F.col("ingested_ts").alias("ingested_at"),
        F.col("payload_temperature").try_cast("double").alias("temperature"),
        F.col("payload_humidity").try_cast("double").alias("humidity"),
    ).withColumn("processed_at", F.when(F.col("event_id") != "bad-id", as_of()))
    return quality.constraint_report(
        rows,
        keys=["event_id"],
        required=["event_id", "source", "ingested_at", "processed_at"],
        ranges={"temperature": schema.TEMPERATURE_RANGE, "humidity": schema.HUMIDITY_RANGE},
    )


@query
def constraint_report_aggregates(lens: EventsLens) -> DataFrame:
    """Windows of both batches, so that every window stands there twice."""
    rows = lens.aggregates.unionAll(lens.aggregates_of(lens.second_log))
    return quality.constraint_report(rows, keys=schema.AGGREGATE_KEYS, required=["source", "window_start", "window_end"])


@query
def constraint_report_metrics(lens: EventsLens) -> DataFrame:
    rows = lens.metrics.unionAll(lens.metrics_of(lens.second_log))
    return quality.constraint_report(rows, keys=schema.METRIC_KEYS, required=["source", "run_timestamp"])


# Documents and envelopes


@query
def normalize_payload(lens: EventsLens) -> DataFrame:
    records = normalize.normalize_payload(lens.documents)
    return records.select(
        "source",
        "run",
        "position",
        F.get_json_object("record", "$.id").cast("bigint").alias("id"),
        F.get_json_object("record", "$.temperature").cast("double").alias("temperature"),
        F.get_json_object("record", "$.batch").cast("bigint").alias("batch"),
        F.get_json_object("record", "$.first.id").cast("bigint").alias("first_id"),
    )


@query
def normalize_nested_repeats(lens: EventsLens) -> DataFrame:
    """Records of documents that repeat names in list elements and below the top level."""
    records = normalize.normalize_payload(lens.nested_repeats)
    return records.select(
        "source",
        "event_id",
        "position",
        F.get_json_object("record", "$.id").cast("bigint").alias("id"),
        F.get_json_object("record", "$.batch").cast("bigint").alias("batch"),
        F.get_json_object("record", "$.meta").alias("meta"),
    )


@query
def normalize_rejects(lens: EventsLens) -> DataFrame:
    """Documents without a record, and why."""
    return normalize.rejected_documents(lens.odd_documents).select("source", "event_id", "reason")


@query
def envelope_build(lens: EventsLens) -> DataFrame:
    records = lens.events.select(
        F.col("event_type").alias("source"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_json(F.struct(F.col("event_id").alias("id"), "value")).alias("record"),
    )
    sent = normalize.build_envelopes(records, event_id=F.col("event_id"), ingested_at=F.col("ts"))
    payload = F.get_json_object("value", "$.payload")
    return sent.select(
        "topic",
        "key",
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.source").alias("source"),
        F.get_json_object("value", "$.ingested_at").alias("ingested_at"),
        F.get_json_object(payload, "$.id").cast("bigint").alias("payload_id"),
        F.get_json_object(payload, "$.value").cast("double").alias("payload_value"),
    )


@query
def infer_schema(lens: EventsLens) -> DataFrame:
    """Field types over every payload and property document, counted per source."""
    payloads = parse_envelopes(lens.first_log).select("source", F.col("payload").alias("document"))
    props = lens.events.select(F.col("event_type").alias("source"), F.col("props").alias("document"))
    typed = analytics.infer_schema(payloads.unionByName(props))
    return typed.groupBy("source", "field", "field_type").agg(F.count(F.lit(1)).alias("documents"))


# Copies and upserts


@query
def dedup_events(lens: EventsLens) -> DataFrame:
    records = lens.records_of(lens.both_logs)
    return _payload_members(first_per_key(records, ["event_id"], ["ingested_at", "payload"]))


def _batches(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.withColumn("batch_id", F.lit(0)).unionByName(second.withColumn("batch_id", F.lit(1)))


@query
def upsert_records(lens: EventsLens) -> DataFrame:
    log = _batches(lens.records, lens.records_of(lens.second_log))
    merged = merge_batches(log, schema.RECORD_KEYS, schema.RECORD_FROZEN, schema.RECORD_MUTABLE)
    return _payload_members(merged)


def _records_table(lens: EventsLens) -> KeyedTable:
    table = KeyedTable(lens.spark, work_folder(lens.spark, "keyed"), RECORDS)
    table.upsert(lens.records, 0)
    return table


@query
def keyed_base_merge(lens: EventsLens) -> DataFrame:
    """The first batch folded into a base, the second one merged on reading."""
    table = _records_table(lens)
    table.compact()
    table.upsert(lens.records_of(lens.second_log), 1)
    return _payload_members(table.latest())


@query
def purged_table(lens: EventsLens) -> DataFrame:
    """Stored records after a purge, read back."""
    table = _records_table(lens)
    table.compact(keep=checks.keep_recent(as_of()))
    return _payload_members(table.latest())


def _upserted_aggregates(lens: EventsLens) -> DataFrame:
    log = _batches(lens.aggregates, lens.aggregates_of(lens.second_log))
    return merge_batches(log, schema.AGGREGATE_KEYS, schema.AGGREGATE_FROZEN, schema.AGGREGATE_MUTABLE)


@query
def upsert_aggregates(lens: EventsLens) -> DataFrame:
    return _upserted_aggregates(lens)


@query
def upsert_metrics(lens: EventsLens) -> DataFrame:
    log = _batches(lens.metrics, lens.metrics_of(lens.second_log))
    return merge_batches(log, schema.METRIC_KEYS, schema.METRIC_FROZEN, schema.METRIC_MUTABLE)


@query
def upsert_daily(lens: EventsLens) -> DataFrame:
    log = _batches(
        summaries.daily_rollup(lens.aggregates, as_of()),
        summaries.daily_rollup(_upserted_aggregates(lens), as_of()),
    )
    return merge_batches(log, schema.DAILY_KEYS, schema.DAILY_FROZEN, schema.DAILY_MUTABLE)


# Windows, rollups and cards


@query
def window_5m(lens: EventsLens) -> DataFrame:
    return lens.aggregates


@query
def dq_metrics_5m(lens: EventsLens) -> DataFrame:
    return lens.metrics


@query
def dq_metrics_duplicates(lens: EventsLens) -> DataFrame:
    """Metrics with the optional count of repeated event ids; every event sent twice."""
    flagged = lens.flagged(lens.first_log.unionAll(lens.first_log))
    return count_duplicates(lens.metrics, flagged).select("source", "run_timestamp", "duplicate_records")


@query
def daily_rollup(lens: EventsLens) -> DataFrame:
    return summaries.daily_rollup(lens.aggregates, as_of())


@query
def daily_rollup_weighted(lens: EventsLens) -> DataFrame:
    return summaries.daily_rollup(lens.aggregates, as_of(), weighted=True)


@query
def processing_summary(lens: EventsLens) -> DataFrame:
    return summaries.processing_summary(lens.records, as_of())


@query
def quality_summary(lens: EventsLens) -> DataFrame:
    return summaries.quality_summary(lens.metrics)


@query
def quality_summary_rounded(lens: EventsLens) -> DataFrame:
    return summaries.quality_summary(lens.metrics, rounded=True)


@query
def stat_panel(lens: EventsLens) -> DataFrame:
    return summaries.stat_panel(summaries.quality_summary(lens.metrics), "quality_rate", "click")


@query
def stat_panel_processing(lens: EventsLens) -> DataFrame:
    summary = summaries.processing_summary(lens.records, as_of())
    return summaries.stat_panel(summary, "latest_event_time", "click")


@query
def latest_metrics(lens: EventsLens) -> DataFrame:
    return summaries.latest_metrics(lens.metrics)


@query
def source_quality(lens: EventsLens) -> DataFrame:
    return summaries.quality_cards(lens.facts)


@query
def source_quality_tables(lens: EventsLens) -> DataFrame:
    """The same card from a table of records and one of metrics."""
    return summaries.source_quality(lens.records, lens.metrics)


@query
def source_kpis(lens: EventsLens) -> DataFrame:
    return summaries.kpi_cards(lens.facts, lens.recent, as_of())


@query
def source_quality_registered(lens: EventsLens) -> DataFrame:
    return summaries.quality_cards(lens.facts, lens.silent_registry)


@query
def source_kpis_registered(lens: EventsLens) -> DataFrame:
    return summaries.source_kpis(lens.records, lens.metrics, lens.recent, as_of(), lens.silent_registry)


@query
def overview_kpis(lens: EventsLens) -> DataFrame:
    return summaries.overview_kpis(summaries.quality_cards(lens.facts), lens.registry)


@query
def violation_breakdown(lens: EventsLens) -> DataFrame:
    return summaries.violation_breakdown(summaries.quality_cards(lens.facts))


@query
def active_sources(lens: EventsLens) -> DataFrame:
    return registry.active_sources(lens.registry).drop("schema")


@query
def poll_interval(lens: EventsLens) -> DataFrame:
    return registry.poll_interval(lens.registry)


# Newest slice, metrics and sentences


@query
def last_500(lens: EventsLens) -> DataFrame:
    return lens.recent.select("source", "seq", "event_id", "event_timestamp", "processed_at")


@query
def last_10(lens: EventsLens) -> DataFrame:
    return lens.recent.filter("rank <= 10").select("source", "rank", "event_id", "processed_at")


@query
def classify_fields(lens: EventsLens) -> DataFrame:
    return analytics.classify_fields(lens.recent)


@query
def classify_fields_repeated_names(lens: EventsLens) -> DataFrame:
    return analytics.classify_fields(lens.repeated_names)


@query
def metric_summary_repeated_names(lens: EventsLens) -> DataFrame:
    return analytics.metric_summary(lens.repeated_names, exact_id=True)


@query
def metric_summary(lens: EventsLens) -> DataFrame:
    return analytics.metric_summary(lens.recent)


@query
def metric_summary_exact_id(lens: EventsLens) -> DataFrame:
    return analytics.metric_summary(lens.recent, exact_id=True)


@query
def iqr_anomalies(lens: EventsLens) -> DataFrame:
    metrics = analytics.metric_values(lens.recent, exact_id=True).filter("is_metric")
    return analytics.iqr_anomalies(metrics).select("source", "field", "anomalies")


@query
def half_trend(lens: EventsLens) -> DataFrame:
    metrics = analytics.metric_values(lens.recent, exact_id=True).filter("is_metric")
    return analytics.summarize_metrics(metrics).select("source", "field", "direction", "percentage")


@query
def insights(lens: EventsLens) -> DataFrame:
    return analytics.insights(lens.recent, exact_id=True)


@query
def insights_nested_repeats(lens: EventsLens) -> DataFrame:
    """Sentences over payloads that repeat names below the top level."""
    return analytics.insights(lens.repeated_below, exact_id=True)


# Pages and series


@query
def records_page(lens: EventsLens) -> DataFrame:
    return pages.records_page(lens.records, limit=20, offset=5)


@query
def records_page_one_source(lens: EventsLens) -> DataFrame:
    return pages.records_page(lens.records, source="click", limit=20, offset=5)


@query
def records_page_after(lens: EventsLens) -> DataFrame:
    """The page that follows a given row of one source."""
    after = (F.lit(PAGE_AFTER[0]).cast("timestamp"), F.lit(PAGE_AFTER[1]))
    return pages.records_page_after(lens.records, "click", after)


@query
def records_page_deep(lens: EventsLens) -> DataFrame:
    """A page far behind the newest rows of one source, found by counting."""
    return pages.records_page_at(lens.records, "click", limit=20, offset=DEEP)


@query
def aggregates_page_after(lens: EventsLens) -> DataFrame:
    """The windows of one source behind a given one."""
    return pages.aggregates_page_after(lens.aggregates, "click", F.lit(PAGE_AFTER[0]).cast("timestamp"))


@query
def recent_records(lens: EventsLens) -> DataFrame:
    temperature = F.get_json_object("payload", "$.temperature").cast("double")
    rows = pages.recent_records(lens.records)
    return rows.withColumn("payload_temperature", temperature).drop("payload")


@query
def aggregates_page(lens: EventsLens) -> DataFrame:
    return pages.aggregates_page(lens.aggregates, limit=20, offset=5)


@query
def ingest_series(lens: EventsLens) -> DataFrame:
    return pages.ingest_series(lens.records)


@query
def latency_series(lens: EventsLens) -> DataFrame:
    return pages.latency_series(lens.records)


@query
def trend_series(lens: EventsLens) -> DataFrame:
    return pages.trend_series(lens.aggregates)


@query
def trend_series_humidity(lens: EventsLens) -> DataFrame:
    return pages.trend_series(lens.aggregates, "avg_humidity")


# Scheduled jobs


@query
def check_freshness(lens: EventsLens) -> DataFrame:
    return checks.check_freshness(lens.records, as_of())


@query
def check_quality_rate(lens: EventsLens) -> DataFrame:
    return checks.check_quality_rate(lens.metrics)


@query
def retention_purge(lens: EventsLens) -> DataFrame:
    return _payload_members(checks.retain_recent(lens.records, as_of()))


@query
def freshness_bucket(lens: EventsLens) -> DataFrame:
    rows = summaries.processing_summary(lens.records, as_of())
    return rows.select("source", checks.freshness_label(F.col("freshness_seconds")).alias("freshness"))


# The same operators as streams over a landed log


def _streamed(lens: EventsLens, log: DataFrame) -> TelemetryApp:
    """Land a log as text files in the order of time and open the application on it."""
    folder = work_folder(lens.spark, "stream")
    moment = F.get_json_object("raw_value", "$.ingested_at")
    landed = log.repartitionByRange(lens.spark.sparkContext.defaultParallelism, moment)
    write_text_log(landed.withColumnRenamed("raw_value", "value"), f"{folder}/log")
    return TelemetryApp(
        lens.spark,
        lambda: file_log(lens.spark, f"{folder}/log"),
        f"{folder}/tables",
        processed_at=processing_time(),
        availableNow=True,
    )


def _restarted(lens: EventsLens, start: Callable[[TelemetryApp], StreamingQuery]) -> TelemetryApp:
    """Read the first log to its end, then open the application anew on the same folder and read the second.

    The second log repeats all events: what lies behind the watermark that the
    first run left is late.
    """
    folder = work_folder(lens.spark, "stream")
    for log in (lens.first_log, lens.second_log):
        write_text_log(log.withColumnRenamed("raw_value", "value"), f"{folder}/log")
        app = TelemetryApp(
            lens.spark,
            lambda: file_log(lens.spark, f"{folder}/log"),
            f"{folder}/tables",
            processed_at=processing_time(),
            availableNow=True,
        )
        start(app).awaitTermination()
    return app


@query
def stream_late(lens: EventsLens) -> DataFrame:
    """Windows after a restart with late events; only events not seen before and in time count."""
    return _restarted(lens, TelemetryApp.start_aggregates).aggregates.latest()


@query
def stream_metrics_late(lens: EventsLens) -> DataFrame:
    """Quality metrics after a restart; late rows change only windows that are still open."""
    return _restarted(lens, TelemetryApp.start_metrics).metrics.latest()


BATCH_FILES = 4


@query
def stream_many_batches(lens: EventsLens) -> DataFrame:
    """Windows of one run over several micro-batches in the order of time, the last of them late.

    The events come in ``MANY_BATCHES`` spans of time and are then all sent again.
    A batch is held to the watermark that stood before the batch ahead of it, so
    what lies behind the spans before the last one is dropped within the run, which
    also forgets the ids of events behind it.
    """
    folder = work_folder(lens.spark, "stream")
    moment = F.col("ts").cast("timestamp").cast("double")
    span = F.ntile(MANY_BATCHES).over(Window.orderBy("day"))
    days = lens.events.groupBy(F.floor(moment / 86400).alias("day")).count().withColumn("span", span)  # a row a day
    placed = lens.events.withColumn("day", F.floor(moment / 86400)).join(F.broadcast(days.select("day", "span")), "day")
    placed = placed.select("span", *lens.events.columns)
    parts = [lens.log_of(placed.filter(F.col("span") == k + 1).drop("span")) for k in range(MANY_BATCHES)]
    for part in [*parts, lens.second_log]:  # files are read by age
        files = part.repartition(BATCH_FILES).withColumnRenamed("raw_value", "value")
        write_text_log(files, f"{folder}/log")
    app = TelemetryApp(
        lens.spark,
        lambda: file_log(lens.spark, f"{folder}/log", max_files=BATCH_FILES),
        f"{folder}/tables",
        processed_at=processing_time(),
        availableNow=True,
    )
    app.start_aggregates().awaitTermination()
    return app.aggregates.latest()


@query
def stream_chained(lens: EventsLens) -> DataFrame:
    """Windows of the processed lake, which holds no copies, read as a stream of files."""
    app = _streamed(lens, lens.first_log.unionAll(lens.first_log))
    app.start_processed().awaitTermination()
    app.start_aggregates(chained=True).awaitTermination()
    return app.aggregates.latest()


@query
def lake_compacted(lens: EventsLens) -> DataFrame:
    """A lake by hour after two landings and compactions; the second log is late for the hours closed by then."""
    folder = work_folder(lens.spark, "lake")
    lake = BatchLake(lens.spark, folder, schema.RAW_LAKE, schema.TIME_PARTITIONS)
    for batch_id, log in enumerate([lens.first_log, lens.second_log]):
        rows = raw_lake_rows(parse_envelopes(log))
        lake.write(rows.hint("rebalance", *schema.TIME_PARTITIONS), batch_id)
        lake.compact(CLOSED_BEFORE[batch_id])
    return _located(lake.read())


@query
def stream_restart(lens: EventsLens) -> DataFrame:
    """Records after a restart: late ones are upserts too."""
    return _payload_members(_restarted(lens, lambda app: app.start_landing(["records"])).records.latest())


@query
def stream_raw(lens: EventsLens) -> DataFrame:
    app = _streamed(lens, lens.first_log)
    app.start_landing().awaitTermination()
    return _located(app.raw())


@query
def stream_quarantine(lens: EventsLens) -> DataFrame:
    app = _streamed(lens, lens.first_log)
    app.start_landing(["quarantine"]).awaitTermination()
    return _quarantined(app.quarantine())


@query
def stream_records(lens: EventsLens) -> DataFrame:
    app = _streamed(lens, lens.both_logs)
    app.start_landing(["records"]).awaitTermination()
    return _payload_members(app.records.latest())


@query
def stream_processed(lens: EventsLens) -> DataFrame:
    app = _streamed(lens, lens.first_log.unionAll(lens.first_log))
    app.start_processed().awaitTermination()
    return app.processed().drop("payload")


@query
def stream_aggregates(lens: EventsLens) -> DataFrame:
    app = _streamed(lens, lens.first_log.unionAll(lens.first_log))
    app.start_aggregates().awaitTermination()
    return app.aggregates.latest()


@query
def stream_metrics(lens: EventsLens) -> DataFrame:
    app = _streamed(lens, lens.first_log)
    app.start_metrics().awaitTermination()
    return app.metrics.latest()

"""Jobs for ``spark-submit``: ``python -m gaugeline.jobs <job> --root <folder> ...``.

``ingest`` turns landed API documents into log messages, ``stream`` runs the
streaming application, ``daily``, ``check``, ``purge`` and ``compact`` are for a
scheduler.
"""

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.checks import (
    check_freshness,
    check_quality_rate,
    keep_recent,
    require_passed,
)
from gaugeline.operators.normalize import TOPIC_PREFIX, build_envelopes, normalize_payload, rejected_documents
from gaugeline.operators.registry import active_sources
from gaugeline.operators.summaries import daily_rollup
from gaugeline.session import build_session
from gaugeline.sources.keyed import AGGREGATES, DAILY, METRICS, RECORDS, SNAPSHOTS, KeyedTable
from gaugeline.sources.readers import file_log, kafka_log, landed_documents, read_registry
from gaugeline.sources.writers import write_kafka, write_text_log
from gaugeline.streaming.app import TelemetryApp


#: Bounds of a micro-batch of the streaming job, and of the tasks that read it.
MAX_FILES, MAX_OFFSETS = 1000, 5_000_000
#: An hour of the lake is closed when it ended so long ago; the watermarks are shorter.
CLOSED_AFTER = timedelta(hours=1)


def active_documents(documents: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """The documents of active sources (of all without a registry)."""
    if registry is None:
        return documents
    names = active_sources(registry).select(F.col("name").alias("source"))
    return documents.join(names, "source", "left_semi")


def ingest(documents: DataFrame, registry: DataFrame | None = None, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Log messages for the documents of active sources (of all without a registry)."""
    return build_envelopes(normalize_payload(active_documents(documents, registry)), topic_prefix=prefix)


def daily(spark: SparkSession, root: str, as_of: datetime) -> KeyedTable:
    """Upsert the summary of the day of ``as_of``; a repeated run replaces itself."""
    aggregates = KeyedTable(spark, f"{root}/aggregates", AGGREGATES).latest()
    table = KeyedTable(spark, f"{root}/daily", DAILY)
    table.upsert(daily_rollup(aggregates, _moment(as_of)), int(as_of.timestamp()), unique=True)
    return table


def check(spark: SparkSession, root: str, as_of: datetime, source: str | None = None) -> None:
    """Raise if the records are stale or a quality rate is too low."""
    records = KeyedTable(spark, f"{root}/records", RECORDS).latest()
    metrics = KeyedTable(spark, f"{root}/metrics", METRICS).latest()
    require_passed(check_freshness(records, _moment(as_of)))
    require_passed(check_quality_rate(metrics, source))


def purge(spark: SparkSession, root: str, as_of: datetime, snapshots: int = SNAPSHOTS) -> None:
    """Fold the log of the records table into a new base without expired records.

    Frames opened before stay readable until the next purge; with ``snapshots``
    1 the expired records leave the storage at once.
    """
    KeyedTable(spark, f"{root}/records", RECORDS).compact(keep=keep_recent(_moment(as_of)), snapshots=snapshots)


def compact_lakes(spark: SparkSession, root: str, as_of: datetime, delay: timedelta = CLOSED_AFTER) -> None:
    """Gather the hours of the raw lake that ended ``delay`` before ``as_of``, and the quarantine, into few files."""
    app = TelemetryApp(spark, lambda: None, root)
    app.raw_lake.compact(as_of - delay)
    app.quarantine_lake.compact()


def _moment(as_of: datetime) -> Column:
    return F.timestamp_micros(F.lit(int(as_of.timestamp() * 1_000_000)))


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["ingest", "stream", "daily", "check", "purge", "compact"])
    parser.add_argument("--root", required=True, help="folder of lake, tables and checkpoints")
    parser.add_argument("--log", help="folder of the file log")
    parser.add_argument("--kafka", help="bootstrap servers, instead of --log")
    parser.add_argument("--prefix", default=TOPIC_PREFIX, help="topic prefix")
    parser.add_argument("--documents", help="folder of landed documents")
    parser.add_argument("--registry", help="Parquet table of sources")
    parser.add_argument("--source", help="source to check")
    parser.add_argument("--max-files", type=int, default=MAX_FILES, help="files of the log in a micro-batch")
    parser.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="Kafka offsets in a micro-batch")
    parser.add_argument("--min-partitions", type=int, help="tasks that read a Kafka micro-batch at least")
    parser.add_argument("--snapshots", type=int, default=SNAPSHOTS, help="states of a table that a purge leaves readable")
    parser.add_argument("--once", action="store_true", help="stop when the log is read")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="time of the run, now by default")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"gaugeline-{args.job}")
    as_of = args.as_of or datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    root = args.root.rstrip("/")
    if args.job == "ingest":
        registry = read_registry(spark, args.registry) if args.registry else None
        documents = landed_documents(spark, args.documents)
        messages = ingest(documents, registry, args.prefix)
        write_kafka(messages, args.kafka) if args.kafka else write_text_log(messages, args.log)
        rejected = rejected_documents(active_documents(documents, registry))
        rejected.write.mode("append").parquet(f"{root}/rejected")
    elif args.job == "stream":
        pattern = args.prefix.replace(".", r"\.") + r"\..*"
        trigger = {"availableNow": True} if args.once else {}
        TelemetryApp(
            spark,
            lambda: kafka_log(spark, args.kafka, pattern, args.max_offsets, args.min_partitions)
            if args.kafka
            else file_log(spark, args.log, max_files=args.max_files),
            root,
            **trigger,
        ).run()
    elif args.job == "daily":
        daily(spark, root, as_of)
    elif args.job == "check":
        check(spark, root, as_of, args.source)
    elif args.job == "compact":
        compact_lakes(spark, root, as_of)
    else:
        purge(spark, root, as_of, args.snapshots)


if __name__ == "__main__":
    main()

"""Five-minute windows: telemetry aggregates and quality metrics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.functions.numbers import percentage


def telemetry_windows(events: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Averages and row count by window and source (batch or stream)."""
    grouped = events.groupBy(F.window(moment, schema.WINDOW_LENGTH), "source").agg(
        F.avg("temperature").alias("avg_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return grouped.select(
        "source",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "avg_temperature",
        "avg_humidity",
        "record_count",
    )


def quality_rate(valid: Column, total: Column) -> Column:
    return percentage(valid, total, empty=100.0)


def quality_windows(flagged: DataFrame) -> DataFrame:
    """Rule counters by ingest window and source (batch or stream).

    Rows without a readable ingest time belong to no window. Rows without a
    source are counted under a placeholder. Counters nothing computes are 0.
    """
    named = flagged.withColumn("source", F.coalesce("source", F.lit(schema.UNKNOWN_SOURCE)))
    grouped = named.groupBy(F.window("ingested_ts", schema.WINDOW_LENGTH), "source").agg(
        F.count("raw_value").alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
        F.count_if("is_null_violation").alias("null_violations"),
        F.count_if("is_range_violation").alias("range_violations"),
    )
    return grouped.select(
        "source",
        F.col("window.start").alias("run_timestamp"),
        "total_records",
        "valid_records",
        "invalid_records",
        F.lit(0).cast("bigint").alias("duplicate_records"),
        "null_violations",
        "range_violations",
        F.lit(0).cast("bigint").alias("freshness_violations"),
        quality_rate(F.col("valid_records"), F.col("total_records")).alias("quality_rate"),
    )


def count_duplicates(metrics: DataFrame, flagged: DataFrame) -> DataFrame:
    """Batch option: fill ``duplicate_records`` with repeats of an event id.

    A repeat is any copy but one per (window, source, event id). Copies are
    counted before the shuffle, so a much-copied event stays cheap.
    """
    copies = flagged.filter(F.col("event_id").isNotNull() & F.col("ingested_ts").isNotNull()).groupBy(
        F.window("ingested_ts", schema.WINDOW_LENGTH).getField("start").alias("run_timestamp"),
        F.coalesce("source", F.lit(schema.UNKNOWN_SOURCE)).alias("source"),
        "event_id",
    ).agg((F.count(F.lit(1)) - 1).alias("repeats"))
    repeats = copies.groupBy("source", "run_timestamp").agg(F.sum("repeats").alias("repeats"))
    joined = metrics.join(repeats, ["source", "run_timestamp"], "left")
    return joined.withColumn("duplicate_records", F.coalesce("repeats", F.lit(0))).select(*metrics.columns)

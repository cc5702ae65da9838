"""Scheduled checks, retention and freshness labels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.operators.summaries import quality_summary


def check_freshness(records: DataFrame, as_of: Column, fail_on_empty: bool = False) -> DataFrame:
    """Whether the newest record was processed in the last 15 minutes.

    One row ``(check_name, value, threshold, passed)``. Without records the
    check passes unless ``fail_on_empty``.
    """
    newest = records.agg(F.max("processed_at").alias("value"))
    threshold = as_of - F.expr(f"INTERVAL {schema.FRESHNESS_LIMIT}")
    return newest.select(
        F.lit("freshness").alias("check_name"),
        "value",
        threshold.alias("threshold"),
        F.coalesce(F.col("value") >= threshold, F.lit(not fail_on_empty)).alias("passed"),
    )


def check_quality_rate(
    metrics: DataFrame,
    source: str | None = None,
    threshold: float = schema.QUALITY_THRESHOLD,
    fail_on_empty: bool = False,
) -> DataFrame:
    """Whether the overall rate reaches the threshold, for each source or one.

    For one source there is always one row; a source without metrics passes
    unless ``fail_on_empty``. That also gives a row without a source where
    there are no metrics at all.
    """
    rates = quality_summary(metrics).select("source", F.col("quality_rate").alias("value"))
    if source is not None:
        rates = (
            rates.filter(F.col("source") == source)
            .agg(F.max("value").alias("value"))
            .withColumn("source", F.lit(source))
        )
    elif fail_on_empty:
        none = rates.agg(F.count("*").alias("n")).filter("n = 0")
        rates = rates.unionByName(none.select(F.lit(None).cast("string").alias("source"), F.lit(None).cast("double").alias("value")))
    return rates.select(
        F.lit("quality_rate").alias("check_name"),
        "source",
        "value",
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(F.col("value") >= threshold, F.lit(not fail_on_empty)).alias("passed"),
    )


def require_passed(checks: DataFrame) -> None:
    """Raise if a check failed, for use as a step of a scheduled job."""
    failed = checks.filter(~F.col("passed")).limit(1).collect()
    if failed:
        raise RuntimeError(f"check failed: {failed[0].asDict()}")


def keep_recent(as_of: Column) -> Column:
    """Condition of rows inside the retention time; rows without a time stay."""
    oldest = as_of - F.expr(f"INTERVAL {schema.RETENTION}")
    return F.col("event_timestamp").isNull() | (F.col("event_timestamp") >= oldest)


def retain_recent(records: DataFrame, as_of: Column) -> DataFrame:
    return records.filter(keep_recent(as_of))


def freshness_label(seconds: Column) -> Column:
    """Live, ``Nm ago`` or ``Nh ago``; a dash without a time."""
    return (
        F.when(seconds.isNull(), "—")
        .when(seconds < 60, "Live")
        .when(seconds < 3600, F.concat(F.floor(seconds / 60).cast("string"), F.lit("m ago")))
        .otherwise(F.concat(F.floor(seconds / 3600).cast("string"), F.lit("h ago")))
    )

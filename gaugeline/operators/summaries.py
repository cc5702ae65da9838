"""Rollups and per-source cards."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.numbers import percentage, seconds_between, stable_round
from gaugeline.operators.windows import quality_rate, quality_windows
from gaugeline.operators.ranking import latest_per_key


def daily_rollup(aggregates: DataFrame, as_of: Column, weighted: bool = False) -> DataFrame:
    """Totals and averages of the windows of the day of ``as_of``, per source.

    The average of window averages is unweighted; ``weighted`` counts records.
    """
    today = F.to_date(as_of)
    # A range on the stored column, not a function of it, reaches the scan.
    windows = aggregates.filter(
        (F.col("window_start") >= today.cast("timestamp"))
        & (F.col("window_start") < F.date_add(today, 1).cast("timestamp"))
    )

    def average(name: str) -> Column:
        if not weighted:
            return F.avg(name)
        counted = F.when(F.col(name).isNotNull(), F.col("record_count"))
        return F.sum(F.col(name) * F.col("record_count")) / F.sum(counted)

    return (
        windows.groupBy(F.to_date("window_start").alias("summary_date"), "source")
        .agg(
            F.sum("record_count").alias("total_records"),
            *[
                stable_round(average(name), 2).cast("decimal(5,2)").alias(name)
                for name in ("avg_temperature", "avg_humidity")
            ],
        )
        .withColumn("last_updated", as_of)
    )


def source_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("total_records"))


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The newest metrics row of each source."""
    return latest_per_key(metrics, ["source"], ["run_timestamp"])


def processing_summary(records: DataFrame, as_of: Column) -> DataFrame:
    return records.groupBy("source").agg(
        F.max("event_timestamp").alias("latest_event_time"),
        F.max("processed_at").alias("latest_processing_time"),
        F.count(F.lit(1)).alias("total_records"),
        seconds_between(F.max("processed_at"), as_of).alias("freshness_seconds"),
    )


def quality_summary(metrics: DataFrame, rounded: bool = False) -> DataFrame:
    """Counter sums and rate per source; ``rounded`` gives two digits."""
    names = [
        "total_records",
        "valid_records",
        "invalid_records",
        "null_violations",
        "range_violations",
    ]
    sums = metrics.groupBy("source").agg(*[F.sum(name).alias(name) for name in names])
    rate = quality_rate(F.col("valid_records"), F.col("total_records"))
    return sums.withColumn("quality_rate", F.round(rate, 2) if rounded else rate)


def stat_panel(summary: DataFrame, column: str, source: str | None = None) -> DataFrame:
    """One value column of a summary, for all sources or for one."""
    rows = summary if source is None else summary.filter(F.col("source") == source)
    return rows.select(column)


def _for_sources(cards: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Registered sources only, silent ones included; all known ones without a registry."""
    if registry is None:
        return cards
    return registry.select(F.col("name").alias("source")).join(cards, "source", "left")


def source_facts(records: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per source from the serving tables: its number of records and its newest metrics.

    Both sides are one row per source before they meet.
    """
    newest = F.struct(*[name for name in metrics.columns if name != "source"])
    measured = latest_metrics(metrics).select("source", newest.alias("newest"))
    return source_counts(records).join(measured, "source", "full_outer")


def log_facts(flagged: DataFrame) -> DataFrame:
    """``source_facts`` of a log in which no event is sent twice, from one pass over it.

    The windows of the metrics are the finer grain: a source's records are the
    valid rows of its windows, and its newest metrics the last of them. So two
    aggregations follow one another, and the log is read and parsed once.
    """
    windows = quality_windows(flagged)
    newest = F.struct(*[name for name in windows.columns if name != "source"])
    return windows.groupBy("source").agg(
        F.sum("valid_records").alias("total_records"), F.max_by(newest, "run_timestamp").alias("newest")
    )


def source_quality(
    records: DataFrame, metrics: DataFrame, registry: DataFrame | None = None
) -> DataFrame:
    """Quality card per source: all-time valid count with the newest counters."""
    return quality_cards(source_facts(records, metrics), registry)


def quality_cards(facts: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Quality card per source from ``source_facts`` or ``log_facts``."""
    counters = ["invalid_records", "duplicate_records", "null_violations", "range_violations"]
    cards = facts.select(
        "source",
        "total_records",
        F.col("newest").isNotNull().alias("_measured"),
        *[F.col(f"newest.{name}").alias(name) for name in counters],
    )
    cards = _for_sources(cards, registry)
    zero = F.lit(0).cast("bigint")

    def counter(name: str) -> Column:
        return F.coalesce(F.col(name), zero)

    valid = counter("total_records")
    invalid, nulls, ranges = (
        counter(name) for name in ("invalid_records", "null_violations", "range_violations")
    )
    total = valid + invalid
    measured = F.round(percentage(valid, total, empty=None), 2)
    unmeasured = F.when(valid > 0, 100.0)
    return cards.select(
        "source",
        total.alias("total_records"),
        valid.alias("valid_records"),
        invalid.alias("invalid_records"),
        counter("duplicate_records").alias("duplicate_records"),
        nulls.alias("null_violations"),
        ranges.alias("range_violations"),
        F.greatest(zero, invalid - nulls - ranges).alias("format_violations"),
        F.when(F.col("_measured"), measured).otherwise(unmeasured).alias("quality_rate"),
    )


def source_kpis(
    records: DataFrame,
    metrics: DataFrame,
    recent: DataFrame,
    as_of: Column,
    registry: DataFrame | None = None,
) -> DataFrame:
    """KPI card per source; ``recent`` is the newest slice of its records."""
    return kpi_cards(source_facts(records, metrics), recent, as_of, registry)


def kpi_cards(facts: DataFrame, recent: DataFrame, as_of: Column, registry: DataFrame | None = None) -> DataFrame:
    """KPI card per source from ``source_facts`` or ``log_facts`` and the newest slice of its records."""
    span = recent.groupBy("source").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("processed_at").alias("_first"),
        F.max("processed_at").alias("_last"),
    )
    counts = facts.select("source", "total_records", F.col("newest.quality_rate").alias("quality_rate"))
    cards = _for_sources(counts.join(span, "source", "left"), registry)
    elapsed = seconds_between(F.col("_first"), F.col("_last"))
    rate = F.when((F.col("_rows") > 1) & (elapsed > 0), F.round(F.col("_rows") / elapsed, 2))
    return cards.select(
        "source",
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        F.coalesce("quality_rate", F.lit(100.0)).alias("quality_rate"),
        F.coalesce(rate, F.lit(0.0)).alias("ingestion_rate"),
        seconds_between(F.col("_last"), as_of).cast("bigint").alias("freshness_seconds"),
    )


def overview_kpis(quality: DataFrame, registry: DataFrame) -> DataFrame:
    """One row over all registered sources."""
    joined = registry.join(
        quality.select("source", "total_records", "quality_rate"),
        registry["name"] == F.col("source"),
        "left",
    )
    return joined.agg(
        F.count_if(F.col("status") == "active").alias("active_sources"),
        F.count(F.lit(1)).alias("configured_sources"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.avg("quality_rate").alias("avg_quality_rate"),
    )


def violation_breakdown(quality: DataFrame) -> DataFrame:
    """Violation counts of each source as percentages of their sum."""
    names = {
        "null": "null_violations",
        "range": "range_violations",
        "format": "format_violations",
        "duplicate": "duplicate_records",
    }
    counts = quality.select("source", *[F.col(column).alias(name) for name, column in names.items()])
    whole = sum((F.col(name) for name in names), F.lit(0))
    counts = counts.withColumn("_whole", F.greatest(whole, F.lit(1)))
    tall = counts.unpivot(["source", "_whole"], list(names), "violation", "records")
    return tall.select(
        "source", "violation", "records", (F.col("records") / F.col("_whole") * 100.0).alias("share")
    )

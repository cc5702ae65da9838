"""Pages and newest-N series over the serving tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.functions.numbers import seconds_between, stable_round
from gaugeline.operators.ranking import top_per_key

RECORD_COLUMNS = [
    "event_id",
    "ingested_at",
    "record_id",
    "event_timestamp",
    "temperature",
    "humidity",
    "temperature_f",
    "processed_at",
]
RECENT_COLUMNS = ["event_id", "event_timestamp", "payload", "temperature", "humidity"]
AGGREGATE_COLUMNS = ["window_start", "window_end", "avg_temperature", "avg_humidity", "record_count"]


def _check_bounds(limit: int, offset: int) -> None:
    if not 1 <= limit <= schema.PAGE_LIMIT:
        raise ValueError(f"limit must be between 1 and {schema.PAGE_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def _page(
    rows: DataFrame, order: list[Column], source: str | None, limit: int, offset: int
) -> DataFrame:
    """One page of one source, or the same page of every source."""
    _check_bounds(limit, offset)
    if source is not None:
        return rows.filter(F.col("source") == source).orderBy(*order).offset(offset).limit(limit)
    ranked = top_per_key(rows, ["source"], order, offset + limit)
    return ranked.filter(F.col("rank") > offset).drop("rank")


def _newest(column: str, tie: str) -> list[Column]:
    """Descending with nulls first, as the serving database sorts."""
    return [F.col(column).desc_nulls_first(), F.col(tie).asc()]


def records_page(
    records: DataFrame, source: str | None = None, limit: int = schema.PAGE_SIZE, offset: int = 0
) -> DataFrame:
    order = _newest("event_timestamp", "event_id")
    rows = records.select("source", *RECORD_COLUMNS)
    return _page(rows, order, source, limit, offset)


def records_page_after(
    records: DataFrame, source: str, after: tuple[Column, Column], limit: int = schema.PAGE_SIZE
) -> DataFrame:
    """The page of a source behind the row with (event_timestamp, event_id) ``after``.

    Its cost does not grow with the depth of the page: the time is a filter
    that reaches the scan, and each task sends at most ``limit`` rows. Rows
    without a time come first, so a null time continues among them.
    """
    _check_bounds(limit, 0)
    moment, event_id = after
    column = F.col("event_timestamp")
    older = (column <= moment) & ((column < moment) | (F.col("event_id") > event_id))
    behind_null = moment.isNull() & (column.isNotNull() | (F.col("event_id") > event_id))
    rows = records.select("source", *RECORD_COLUMNS).filter(F.col("source") == source)
    order = _newest("event_timestamp", "event_id")
    return rows.filter(F.coalesce(older, behind_null)).orderBy(*order).limit(limit)


#: Spans of time in which rows are counted to find a page, from coarse to fine.
GRAINS = ("day", "hour", "minute", "second")
#: Rows that may lie before a page in its span without another, finer count.
NEAR_ENOUGH = 10_000
#: Rows without a time come first, before all others.
FIRST = "9999-12-31 00:00:00"


def page_at(
    rows: DataFrame, column: str, order: list[Column], limit: int = schema.PAGE_SIZE, offset: int = 0
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by descending time, by counting instead of sorting what lies before.

    Rows are counted by day; the days that the page touches are counted by hour,
    and so on while much lies before the page. Each count is a small partial
    aggregation, of which three numbers come back; only the rows of the span that
    holds the page are sorted. ``order`` begins with ``column`` descending, nulls first.
    """
    moment = F.coalesce(F.col(column), F.lit(FIRST).cast("timestamp"))
    for grain in GRAINS:
        span = F.date_trunc(grain, moment).alias("span")
        counts = rows.groupBy(span).agg(F.count(F.lit(1)).alias("n"))
        until = F.sum("n").over(Window.orderBy(F.col("span").desc()))  # a row a span
        touched = counts.withColumn("until", until).where((F.col("until") > offset) & (F.col("until") - F.col("n") < offset + limit))
        found = touched.agg(
            F.min("span").alias("last"), F.max("span").alias("first"), F.min(F.col("until") - F.col("n")).alias("before"), F.sum("n").alias("n")
        )
        bounds = found.select(F.unix_micros("last"), F.unix_micros("first"), "before", "n").first()
        if bounds[0] is None:
            return rows.limit(0)
        low, high, before, n = bounds
        end = F.timestamp_micros(F.lit(high)) + F.expr(f"INTERVAL 1 {grain}")
        inside = (F.col(column) >= F.timestamp_micros(F.lit(low))) & (F.col(column) < end)  # reaches the scan
        without = F.col(column).isNull() & (F.lit(FIRST).cast("timestamp") >= F.timestamp_micros(F.lit(low))) & (F.lit(FIRST).cast("timestamp") < end)
        rows, offset = rows.filter(inside | without), offset - before
        if n <= NEAR_ENOUGH + limit:
            break
    return rows.orderBy(*order).offset(offset).limit(limit)


def records_page_at(records: DataFrame, source: str, limit: int = schema.PAGE_SIZE, offset: int = 0) -> DataFrame:
    """``records_page`` of one source at any depth; no task sorts what lies before the page."""
    _check_bounds(limit, offset)
    rows = records.select("source", *RECORD_COLUMNS).filter(F.col("source") == source)
    return page_at(rows, "event_timestamp", _newest("event_timestamp", "event_id"), limit, offset)


def aggregates_page_after(aggregates: DataFrame, source: str, after: Column, limit: int = schema.PAGE_SIZE) -> DataFrame:
    """The page of a source's windows behind the one that starts at ``after``.

    A source has one window a time, so the time alone continues the page; it is a
    filter that reaches the scan. Windows without a start come first.
    """
    _check_bounds(limit, 0)
    column = F.col("window_start")
    behind = F.coalesce(column < after, after.isNull() & column.isNotNull())
    rows = aggregates.select("source", *AGGREGATE_COLUMNS).filter((F.col("source") == source) & behind)
    return _shown(rows.orderBy(column.desc_nulls_first()).limit(limit))


def recent_records(records: DataFrame, source: str | None = None) -> DataFrame:
    """The 20 newest events with their payload."""
    order = _newest("event_timestamp", "event_id")
    rows = records.select("source", *RECENT_COLUMNS)
    return _page(rows, order, source, schema.PAGE_SIZE, 0)


def aggregates_page(
    aggregates: DataFrame, source: str | None = None, limit: int = schema.PAGE_SIZE, offset: int = 0
) -> DataFrame:
    """Newest windows; averages with two digits, an average of zero shows as null."""
    order = [F.col("window_start").desc_nulls_first()]
    rows = aggregates.select("source", *AGGREGATE_COLUMNS)
    return _shown(_page(rows, order, source, limit, offset))


def _shown(page: DataFrame) -> DataFrame:
    return page.withColumns(
        {
            name: F.when(F.col(name) != 0, stable_round(F.col(name), 2))
            for name in ("avg_temperature", "avg_humidity")
        }
    )


def _series(rows: DataFrame, tie: str, size: int) -> DataFrame:
    return rows.orderBy(F.col("time").desc_nulls_first(), F.col(tie)).limit(size)


def ingest_series(records: DataFrame, size: int = schema.SERIES_SIZE) -> DataFrame:
    """Markers at the newest event times."""
    rows = records.select(F.col("event_timestamp").alias("time"), "event_id")
    return _series(rows, "event_id", size).select("time", F.lit(1).alias("ingested"))


def latency_series(records: DataFrame, size: int = schema.SERIES_SIZE) -> DataFrame:
    """Seconds from event to processing for the newest events."""
    rows = records.select(F.col("event_timestamp").alias("time"), "processed_at", "event_id")
    latency = seconds_between(F.col("time"), F.col("processed_at"))
    return _series(rows, "event_id", size).select("time", latency.alias("latency"))


def trend_series(
    aggregates: DataFrame, value: str = "avg_temperature", size: int = schema.SERIES_SIZE
) -> DataFrame:
    """One average over the newest windows."""
    rows = aggregates.select(F.col("window_start").alias("time"), F.col(value).alias("value"), "source")
    return _series(rows, "source", size)

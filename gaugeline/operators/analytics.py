"""Per-source analytics over the newest slice of records, for all sources at once.

Every step after ``recent_slice`` works on at most 500 records per source, so
the value lists built below are bounded however large a source is.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.functions.documents import MARK, NUMBERS, as_map, kind, members, number, parse_document, readable
from gaugeline.functions.numbers import stable_round
from gaugeline.functions.staging import staged
from gaugeline.operators.ranking import top_per_key

# Wording of the insight sentences.
INCREASED = "%s increased %.1f%% compared with the previous period."
DECREASED = "%s decreased %.1f%% compared with the previous period."
STABLE = "%s remained relatively stable."
ANOMALIES = "⚠ %d potential anomalies detected in %s."
NO_TREND = "Not enough data to determine a trend."


def recent_slice(records: DataFrame, size: int = schema.SLICE_SIZE) -> DataFrame:
    """The newest records of each source: ``rank`` 1 is the newest, ``seq`` 1 the oldest."""
    order = [F.col("processed_at").desc_nulls_first(), F.col("event_id").asc()]
    newest = top_per_key(records, ["source"], order, size)
    kept = F.max("rank").over(Window.partitionBy("source"))
    return newest.withColumn("seq", kept - F.col("rank") + 1)


def infer_schema(documents: DataFrame, column: str = "document") -> DataFrame:
    """Field names and types of each document; a list is judged by its first element."""
    rows = staged(documents, _readable=readable(F.col(column)))
    rows = staged(rows, _document=parse_document(F.col("_readable")))
    document = F.col("_document")
    fields = F.coalesce(as_map(document), as_map(document, "$[0]"))
    rows = rows.select(*documents.columns, F.explode(fields).alias("field", "_value"))
    rows = staged(rows, _kind=kind(F.col("_value")))
    text = F.when(F.col("_kind") == "STRING", F.try_variant_get("_value", "$", "string"))
    rows = staged(rows, _text=text)
    text = F.col("_text")
    looks_like_time = (text.contains("T") & text.contains("Z")) | (
        text.contains("-") & text.contains(":")
    )
    field_type = (
        F.when(F.col("_kind") == "BOOLEAN", "boolean")
        .when(F.col("_kind").isin(NUMBERS) | text.startswith(MARK), "numeric")
        .when(looks_like_time, "datetime")
        .otherwise("string")
    )
    return rows.select(*documents.columns, "field", field_type.alias("field_type"))


def field_role(name: Column, value_kind: Column, exact_id: bool = False) -> Column:
    """identifier, metric or dimension.

    Any name containing "id" is an identifier, even ``humidity``; ``exact_id``
    accepts only ``id`` and names ending in ``_id``.
    """
    lowered = F.lower(name)
    is_id = (lowered == "id") | lowered.endswith("_id") if exact_id else lowered.contains("id")
    return (
        F.when(is_id, "identifier")
        .when(value_kind.isin(NUMBERS), "metric")
        .otherwise("dimension")
    )


def classify_fields(recent: DataFrame, exact_id: bool = False) -> DataFrame:
    """Role of each field in the newest payload of each source."""
    newest = recent.filter(F.col("rank") == 1)
    fields = newest.select("source", F.explode(members(F.col("payload"))).alias("field", "value"))
    role = field_role(F.col("field"), kind(F.col("value")), exact_id)
    return fields.select("source", "field", role.alias("role"))


def metric_values(recent: DataFrame, exact_id: bool = False) -> DataFrame:
    """``(source, field, is_metric, values)`` with values in time order.

    A source without payload members keeps one row with a null field. A field
    is a metric if it is one in the newest payload; older values count when
    they are numbers or booleans.
    """
    entries = recent.select(
        "source",
        "rank",
        "seq",
        F.explode_outer(members(F.col("payload"))).alias("field", "value"),
    )
    entries = staged(entries, kind=kind(F.col("value")))
    newest_is_metric = (F.col("rank") == 1) & (
        field_role(F.col("field"), F.col("kind"), exact_id) == "metric"
    )
    entries = entries.select(
        "source",
        "field",
        F.coalesce(newest_is_metric, F.lit(False)).alias("newest_is_metric"),
        F.struct("seq", number(F.col("value"), F.col("kind")).alias("value")).alias("point"),
    )
    points = F.collect_list(F.when(F.col("point.value").isNotNull(), F.col("point")))
    grouped = entries.groupBy("source", "field").agg(
        F.max("newest_is_metric").alias("is_metric"), F.sort_array(points).alias("points")
    )
    return grouped.select(
        "source",
        "field",
        (F.col("is_metric") & (F.size("points") > 0)).alias("is_metric"),
        F.col("points.value").alias("values"),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _mean(values: Column) -> Column:
    return _total(values) / F.nullif(F.size(values), F.lit(0))


def iqr_anomalies(metrics: DataFrame) -> DataFrame:
    """Add ``anomalies``: values outside the quartile fences.

    Quartiles are taken by position, without interpolation. The fences get an
    operator of their own; inside the lambda they would be sorted for every value.
    """
    ordered, count = F.sort_array("values"), F.size("values")
    low = F.get(ordered, F.floor(count / 4).cast("int"))
    high = F.get(ordered, F.floor(count * 3 / 4).cast("int"))
    quartiles = staged(metrics, _low=low, _high=high)
    reach = (F.col("_high") - F.col("_low")) * schema.IQR_FACTOR
    fences = quartiles.withColumns(
        {"_low": F.col("_low") - reach, "_high": F.col("_high") + reach}
    )
    outside = F.filter(
        "values", lambda value: (value < F.col("_low")) | (value > F.col("_high"))
    )
    counted = F.when(count < schema.MIN_SERIES, 0).otherwise(F.size(outside))
    return fences.withColumn("anomalies", counted).drop("_low", "_high")


def half_change(values: Column) -> Column:
    """Percent change from the mean of the first half to that of the rest, or null."""
    count = F.size(values)
    half = F.floor(count / 2).cast("int")
    first = _mean(F.slice(values, F.lit(1), half))
    second = _mean(F.slice(values, half + 1, count - half))
    change = (second - first) / F.nullif(first, F.lit(0.0)) * 100
    return F.when(count >= schema.MIN_SERIES, change)


def trend_direction(change: Column) -> Column:
    return (
        F.when(change > schema.TREND_THRESHOLD, "Increasing")
        .when(change < -schema.TREND_THRESHOLD, "Decreasing")
        .otherwise("Stable")
    )


def summarize_metrics(values: DataFrame) -> DataFrame:
    """Add summary columns to ``metric_values`` rows."""
    measured = staged(iqr_anomalies(values), _change=half_change(F.col("values")))
    return measured.select(
        "source",
        "field",
        "is_metric",
        stable_round(_mean(F.col("values")), 2).alias("avg_value"),
        F.round(F.array_min("values"), 2).alias("min_value"),
        F.round(F.array_max("values"), 2).alias("max_value"),
        trend_direction(F.col("_change")).alias("direction"),
        F.coalesce(stable_round(F.col("_change"), 1), F.lit(0.0)).alias("percentage"),
        "anomalies",
    )


def metric_summary(recent: DataFrame, exact_id: bool = False) -> DataFrame:
    """Average, extremes, trend and anomaly count per source and metric."""
    metrics = metric_values(recent, exact_id).filter("is_metric")
    return summarize_metrics(metrics).drop("is_metric")


def insights(recent: DataFrame, exact_id: bool = False) -> DataFrame:
    """Numbered sentences per source, by metric name; the slice is read once."""
    return write_insights(summarize_metrics(metric_values(recent, exact_id)))


def write_insights(summary: DataFrame) -> DataFrame:
    """Sentences for summarized fields; those that are no metrics are passed over.

    A source has at most two sentences for each metric of its payload, and a
    fallback if there is none.
    """
    name = F.concat(F.upper(F.substring("field", 1, 1)), F.lower(F.substring("field", 2, 2**31 - 1)))
    trend = (
        F.when(F.col("direction") == "Increasing", F.format_string(INCREASED, name, F.col("percentage")))
        .when(
            F.col("direction") == "Decreasing",
            F.format_string(DECREASED, name, F.abs("percentage")),
        )
        .otherwise(F.format_string(STABLE, name))
    )
    warning = F.when(
        F.col("anomalies") > 0, F.format_string(ANOMALIES, F.col("anomalies"), F.col("field"))
    )
    sentences = F.filter(F.array(trend, warning), lambda sentence: sentence.isNotNull())
    told = F.collect_list(F.when(F.col("is_metric"), F.struct("field", sentences.alias("sentences"))))
    per_source = summary.groupBy("source").agg(F.sort_array(told).alias("told"))
    lines = F.flatten(F.col("told.sentences"))
    lines = F.when(F.size(lines) > 0, lines).otherwise(F.array(F.lit(NO_TREND)))
    return per_source.select("source", F.posexplode(lines).alias("position", "insight"))

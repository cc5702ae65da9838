"""Envelope parsing, typed fields and time parts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.functions.documents import PAYLOAD_MEMBERS, first_member, payload_fields
from gaugeline.functions.numbers import to_bigint, to_double


def parse_envelopes(raw: DataFrame) -> DataFrame:
    """``raw_value`` → envelope fields and ``ingested_ts``; broken text gives nulls.

    ``inline`` keeps the JSON parse in an operator of its own, as in ``staged``:
    a plain projection would be copied into the filters of the rules.
    """
    parsed = raw.select(
        *raw.columns, F.inline(F.array(F.from_json("raw_value", schema.ENVELOPE)))
    )
    return parsed.withColumn("ingested_ts", F.col("ingested_at").try_cast("timestamp"))


def parse_payload(envelopes: DataFrame) -> DataFrame:
    """Add the payload members used by rules and records, as ``payload_*`` text.

    A document that breaks off half-way has no members, even where some were
    read before the break. Where a name occurs twice the first one counts.
    """
    names = [f"payload_{name}" for name in PAYLOAD_MEMBERS]
    payload = F.col("payload")
    read = envelopes.select("*", F.inline(F.array(payload_fields(payload))).alias(*names, "payload_broken"))
    whole = F.col("payload_broken").isNull()
    return read.withColumns(
        {
            name: F.when(whole, first_member(payload, member, F.col(name)))
            for name, member in zip(names, PAYLOAD_MEMBERS)
        }
    )


def time_parts(rows: DataFrame, moment: str) -> DataFrame:
    return rows.withColumns(
        {
            "year": F.year(moment),
            "month": F.month(moment),
            "day": F.dayofmonth(moment),
            "hour": F.hour(moment),
        }
    )


def raw_lake_rows(envelopes: DataFrame) -> DataFrame:
    """Rows of the raw lake: every event, valid or not, by ingest hour."""
    return time_parts(envelopes, "ingested_ts").select("source", "raw_value", *schema.TIME_PARTITIONS)


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def typed_events(valid: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Typed event columns of rows that passed the rules.

    The event time is the payload's ``timestamp``, else its ``time``, else the
    ingest time. ``processed_at`` defaults to the time of the batch.
    """
    temperature = to_double(F.col("payload_temperature"))
    return valid.select(
        "event_id",
        "source",
        F.col("ingested_ts").alias("ingested_at"),
        "payload",
        to_bigint(F.col("payload_id")).alias("id"),
        F.coalesce(
            F.col("payload_timestamp").try_cast("timestamp"),
            F.col("payload_time").try_cast("timestamp"),
            F.col("ingested_ts"),
        ).alias("timestamp"),
        temperature.alias("temperature"),
        to_double(F.col("payload_humidity")).alias("humidity"),
        fahrenheit(temperature).alias("temperature_f"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    )


def event_lake_rows(events: DataFrame) -> DataFrame:
    """Typed events plus the partition columns of the processed lake."""
    return time_parts(events, "timestamp")


def serving_records(events: DataFrame) -> DataFrame:
    """Typed events under the column names of the records table."""
    return events.select(
        "event_id",
        "source",
        "ingested_at",
        F.col("id").alias("record_id"),
        F.col("timestamp").alias("event_timestamp"),
        "temperature",
        "humidity",
        "temperature_f",
        "payload",
        "processed_at",
    )

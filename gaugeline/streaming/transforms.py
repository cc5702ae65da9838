"""Streaming forms of the batch operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.operators.parse import parse_envelopes, parse_payload, typed_events
from gaugeline.operators.quality import flag_quality, valid_rows
from gaugeline.operators.windows import quality_windows, telemetry_windows

COPY_SLOTS = 16
SLOT_SEED = 11
#: Tasks that share the rows of an hour when a batch is written to the processed lake.
HOUR_SLOTS = 4


def flagged_log(log: DataFrame, strict_types: bool = False) -> DataFrame:
    return flag_quality(parse_payload(parse_envelopes(log)), strict_types=strict_types)


def watermarked_events(flagged: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return typed_events(valid_rows(flagged), processed_at).withWatermark(
        "timestamp", schema.EVENT_WATERMARK
    )


def drop_copies(events: DataFrame, slots: int = COPY_SLOTS) -> DataFrame:
    """One row per event id; keys are forgotten once the watermark passes them.

    An event sent very often would bring all its copies to one task. They are
    therefore first reduced within ``slots`` slots, dealt out row by row, so
    the second step sees at most ``slots`` copies. ``slots=1`` skips that step.
    The seed is fixed: a repeated task deals the same rows to the same slots.
    """
    if slots > 1:
        slot = F.floor(F.rand(SLOT_SEED) * slots)
        events = (
            events.withColumn("_slot", slot)
            .dropDuplicatesWithinWatermark(["event_id", "_slot"])
            .drop("_slot")
        )
    return events.dropDuplicatesWithinWatermark(["event_id"])


def by_hour(rows: DataFrame, slots: int = HOUR_SLOTS) -> DataFrame:
    """Bring the rows of an hour to at most ``slots`` tasks, so that each hour gets as many files.

    Rows without copies lie by event id: every task would have some of every hour,
    and files would grow with hours times tasks.
    """
    slot = F.pmod(F.xxhash64("event_id"), F.lit(slots))
    return rows.repartition(*schema.TIME_PARTITIONS, slot)


def streaming_aggregates(events: DataFrame, slots: int = COPY_SLOTS) -> DataFrame:
    return telemetry_windows(drop_copies(events, slots))


def streaming_metrics(flagged: DataFrame) -> DataFrame:
    return quality_windows(flagged.withWatermark("ingested_ts", schema.INGEST_WATERMARK))

"""The streaming application: one event log, one lake, three serving tables."""

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeline import schema
from gaugeline.operators.parse import event_lake_rows, raw_lake_rows, serving_records, typed_events
from gaugeline.operators.quality import quarantine_rows, valid_rows
from gaugeline.operators.windows import telemetry_windows
from gaugeline.sources.folders import make_folder
from gaugeline.sources.keyed import AGGREGATES, METRICS, RECORDS, KeyedTable
from gaugeline.sources.lake import BatchLake
from gaugeline.streaming.transforms import (
    COPY_SLOTS,
    by_hour,
    drop_copies,
    flagged_log,
    streaming_aggregates,
    streaming_metrics,
    watermarked_events,
)

LANDED = ("raw", "quarantine", "records")


class TelemetryApp:
    """Starts the streaming queries of one event log under one output folder.

    * ``landing`` reads each micro-batch once and writes the raw lake, the
      quarantine and the records table. It keeps late events, since none of
      these outputs needs state.
    * ``processed`` appends events without copies to the processed lake.
    * ``aggregates`` and ``metrics`` keep the windowed serving tables. Run beside
      ``processed``, the aggregates read its lake, which holds no copies, as a
      stream of files, so that the ids of all events are kept in one state only.

    Every query has its own checkpoint, and every write of a micro-batch can be
    repeated, so a restart continues without loss or repeats. Nothing is
    collected: executors write all outputs.
    """

    def __init__(
        self,
        spark: SparkSession,
        open_log: Callable[[], DataFrame],
        root: str,
        processed_at: Column | None = None,
        strict_types: bool = False,
        copy_slots: int = COPY_SLOTS,
        **trigger,
    ):
        self.spark, self.open_log, self.root = spark, open_log, root.rstrip("/")
        self.processed_at, self.strict_types, self.copy_slots = processed_at, strict_types, copy_slots
        self.trigger = trigger
        self.records = KeyedTable(spark, f"{self.root}/records", RECORDS)
        self.aggregates = KeyedTable(spark, f"{self.root}/aggregates", AGGREGATES)
        self.metrics = KeyedTable(spark, f"{self.root}/metrics", METRICS)
        self.raw_lake = BatchLake(spark, f"{self.root}/raw", schema.RAW_LAKE, schema.LAKE_PARTITIONS)
        self.quarantine_lake = BatchLake(spark, f"{self.root}/quarantine", schema.QUARANTINE, ["source"])

    def raw(self) -> DataFrame:
        return self.raw_lake.read()

    def quarantine(self) -> DataFrame:
        return self.quarantine_lake.read()

    def processed(self) -> DataFrame:
        return self.spark.read.schema(schema.PROCESSED_LAKE).parquet(f"{self.root}/processed")

    def start_landing(self, outputs: Sequence[str] = LANDED) -> StreamingQuery:
        """Write the stateless outputs; leave some out only under a root of their own."""

        def land(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if "raw" in outputs:
                    self.raw_lake.write(raw_lake_rows(batch), batch_id)
                if "quarantine" in outputs:
                    self.quarantine_lake.write(quarantine_rows(batch), batch_id)
                if "records" in outputs:
                    events = typed_events(valid_rows(batch), self.processed_at)
                    self.records.upsert(serving_records(events), batch_id)
            finally:
                batch.unpersist()

        return self._for_each_batch("landing", self._flagged(), "append", land)

    def start_processed(self) -> StreamingQuery:
        events = drop_copies(self._events(), self.copy_slots)
        writer = by_hour(event_lake_rows(events)).writeStream.format("parquet").outputMode("append")
        writer = writer.partitionBy(*schema.TIME_PARTITIONS).option("path", f"{self.root}/processed")
        return self._start("processed", writer)

    def start_aggregates(self, chained: bool = False) -> StreamingQuery:
        """Windows of events without copies: of the log, or ``chained`` of the processed lake.

        The lake leaves out late events already. What a chained run reads is what
        ``processed`` has committed; files of one of its batches may come with
        those of the next, so the watermark is never ahead of the lake's.
        """

        def store(batch: DataFrame, batch_id: int) -> None:
            self.aggregates.upsert(batch, batch_id, unique=True)

        if chained:
            make_folder(self.spark, f"{self.root}/processed")
            lake = self.spark.readStream.schema(schema.PROCESSED_LAKE).parquet(f"{self.root}/processed")
            windows = telemetry_windows(lake.withWatermark("timestamp", schema.EVENT_WATERMARK))
        else:
            windows = streaming_aggregates(self._events(), self.copy_slots)
        return self._for_each_batch("aggregates", windows, "update", store)

    def start_metrics(self) -> StreamingQuery:
        def store(batch: DataFrame, batch_id: int) -> None:
            self.metrics.upsert(batch, batch_id, unique=True)

        return self._for_each_batch("metrics", streaming_metrics(self._flagged()), "update", store)

    def start_all(self) -> list[StreamingQuery]:
        return [
            self.start_landing(),
            self.start_processed(),
            self.start_metrics(),
            self.start_aggregates(chained=True),
        ]

    def run(self) -> None:
        """Run all queries; stop when one of them ends or, with ``availableNow``, when all are done."""
        if self.trigger.get("availableNow"):
            first = [self.start_landing(), self.start_processed(), self.start_metrics()]
            for query in first:
                query.awaitTermination()
            self.start_aggregates(chained=True).awaitTermination()
            return
        queries = self.start_all()
        try:
            self.spark.streams.awaitAnyTermination()
        finally:
            for query in queries:
                query.stop()

    def _flagged(self) -> DataFrame:
        return flagged_log(self.open_log(), self.strict_types)

    def _events(self) -> DataFrame:
        return watermarked_events(self._flagged(), self.processed_at)

    def _for_each_batch(self, name: str, rows: DataFrame, mode: str, sink) -> StreamingQuery:
        return self._start(name, rows.writeStream.outputMode(mode).foreachBatch(sink))

    def _start(self, name: str, writer) -> StreamingQuery:
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoints/{name}")
        if self.trigger:
            writer = writer.trigger(**self.trigger)
        return writer.queryName(name).start()

"""The telemetry view of the ``events`` table, used by the registered queries.

Each event becomes an envelope as JSON text. Fixed shares of the events get a
malformed id, no id, a broken payload or a non-numeric field, so every rule has
rows to act on. A second batch repeats every event a minute later with another
temperature.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.analytics import recent_slice
from gaugeline.operators.parse import parse_envelopes, parse_payload, serving_records, typed_events
from gaugeline.operators.quality import flag_quality, valid_rows
from gaugeline.operators.summaries import log_facts
from gaugeline.operators.windows import quality_windows, telemetry_windows

AS_OF = "2024-01-30 23:59:59"
PAGE_AFTER = ("2024-01-15 12:00:00", "00000000-0000-4000-8000-000000000000")
DEEP = 700
MANY_BATCHES = 3
DOCUMENT_ROWS = 20


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def processing_time() -> Column:
    """A fixed stand-in for the batch clock: up to half a minute after ingest."""
    number = F.substring("event_id", -12, 12).try_cast("bigint")
    return F.timestamp_add("SECOND", F.pmod(number, F.lit(30)).cast("int"), F.col("payload_timestamp").cast("timestamp"))


def _text_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


class EventsLens:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    def _payload(self, warmer: float) -> Column:
        full = F.to_json(
            F.struct(
                F.col("event_id").alias("id"),
                _text_time(F.col("ts")).alias("timestamp"),
                (F.col("value") - 60 + warmer).alias("temperature"),
                F.col("user_id").alias("humidity"),
            )
        )
        number = F.col("event_id")
        return (
            F.when(number % 103 == 0, "{broken")
            .when(number % 107 == 0, '{"temperature":"very hot"}')
            .otherwise(full)
        )

    def _envelopes(self, events: DataFrame, warmer: float, later: str) -> DataFrame:
        number = F.col("event_id")
        padded = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(number.cast("string"), 12, "0"))
        envelope = F.struct(
            F.when(number % 97 == 0, "bad-id").when(number % 101 != 0, padded).alias("event_id"),
            F.col("event_type").alias("source"),
            _text_time(F.col("ts") + F.expr(f"INTERVAL {later}")).alias("ingested_at"),
            self._payload(warmer).alias("payload"),
        )
        return events.select(F.to_json(envelope).alias("raw_value"))

    def log_of(self, events: DataFrame) -> DataFrame:
        """The first log of some of the events."""
        return self._envelopes(events, 0.0, "0 seconds")

    @cached_property
    def first_log(self) -> DataFrame:
        return self.log_of(self.events)

    @cached_property
    def second_log(self) -> DataFrame:
        return self._envelopes(self.events, 1.0, "1 minute")

    @cached_property
    def both_logs(self) -> DataFrame:
        return self.first_log.unionByName(self.second_log)

    def parsed(self, log: DataFrame) -> DataFrame:
        return parse_payload(parse_envelopes(log))

    def flagged(self, log: DataFrame) -> DataFrame:
        return flag_quality(self.parsed(log))

    def typed(self, log: DataFrame) -> DataFrame:
        return typed_events(valid_rows(self.flagged(log)), processing_time())

    def records_of(self, log: DataFrame) -> DataFrame:
        return serving_records(self.typed(log))

    def aggregates_of(self, log: DataFrame) -> DataFrame:
        return telemetry_windows(self.typed(log))

    def metrics_of(self, log: DataFrame) -> DataFrame:
        return quality_windows(self.flagged(log))

    @cached_property
    def records(self) -> DataFrame:
        return self.records_of(self.first_log)

    @cached_property
    def aggregates(self) -> DataFrame:
        return self.aggregates_of(self.first_log)

    @cached_property
    def metrics(self) -> DataFrame:
        return self.metrics_of(self.first_log)

    @cached_property
    def facts(self) -> DataFrame:
        return log_facts(self.flagged(self.first_log))

    @cached_property
    def recent(self) -> DataFrame:
        return recent_slice(self.records)

    @cached_property
    def registry(self) -> DataFrame:
        """One source per event type; its first event gives id and settings."""
        per_type = self.events.groupBy(F.col("event_type").alias("name")).agg(
            F.min("event_id").alias("id"), F.min("ts").alias("created_at")
        )
        number = F.length("name")
        return per_type.select(
            "id",
            "name",
            F.concat(F.lit("http://sources.example/"), "name").alias("url"),
            F.when(number % 2 == 0, F.lit(None)).otherwise(number * 10).cast("int").alias("poll_interval"),
            F.lit(None).cast("string").alias("schema"),
            F.when(number == 4, "paused").otherwise("active").alias("status"),
            F.col("created_at").cast("timestamp").alias("created_at"),
            F.col("created_at").cast("timestamp").alias("updated_at"),
        )

    @cached_property
    def silent_registry(self) -> DataFrame:
        """The registry with a second source beside each, which never sent an event."""
        quiet = self.registry.withColumn("name", F.concat("name", F.lit("-quiet")))
        return self.registry.unionByName(quiet)

    @cached_property
    def documents(self) -> DataFrame:
        """API responses: the events of a source in runs of 20 ids, in four shapes.

        Three shapes hold a run each; in the fourth, every event is a document
        of its own, which repeats a name.
        """
        run = F.floor(F.col("event_id") / DOCUMENT_ROWS).cast("bigint")
        rows = F.sort_array(
            F.collect_list(
                F.struct(F.col("event_id").alias("id"), (F.col("value") - 60).alias("temperature"))
            )
        )
        grouped = self.events.groupBy(F.col("event_type").alias("source"), run.alias("run")).agg(
            rows.alias("rows")
        )
        batch = F.col("run").alias("batch")
        lists = [F.col("rows.id").alias("id"), F.col("rows.temperature").alias("temperature")]
        shape = F.pmod("run", F.lit(4))
        whole = (
            F.when(shape == 0, F.to_json(F.struct(batch, *lists)))
            .when(shape == 1, F.to_json(F.struct(batch, F.struct(*lists).alias("hourly"))))
            .otherwise(F.to_json("rows"))
        )
        apart = F.transform(
            "rows",
            lambda row: F.concat(F.lit('{"batch":-1,'), F.substr(F.to_json(F.struct(batch, row.alias("first"))), F.lit(2))),
        )
        documents = F.when(shape == 3, apart).otherwise(F.array(whole))
        return grouped.select("source", "run", F.explode(documents).alias("document"))

    @cached_property
    def odd_documents(self) -> DataFrame:
        """Every event as a response that gives no record in five of seven cases."""
        number = F.pmod("event_id", F.lit(7))
        text = F.col("event_id").cast("string")
        document = (
            F.when(number == 0, F.lit(None).cast("string"))
            .when(number == 1, F.lit("  "))
            .when(number == 2, F.concat(F.lit('{"id":'), text))
            .when(number == 3, text)
            .when(number == 4, F.concat(F.lit("["), text, F.lit("]")))
            .when(number == 5, F.concat(F.lit('{"a":{"id":1,"id":'), text, F.lit("}}")))
            .otherwise(F.concat(F.lit('{"id":0,"id":'), text, F.lit("}")))
        )
        return self.events.select(F.col("event_type").alias("source"), "event_id", document.alias("document"))

    @cached_property
    def repeated_names(self) -> DataFrame:
        """Records whose payload names its temperature twice, first with a text."""
        payload = F.concat(F.lit('{"temperature":"old",'), F.substr("payload", F.lit(2)))
        return self.recent.withColumn("payload", payload)

    @cached_property
    def nested_repeats(self) -> DataFrame:
        """Every event as a response that repeats a name in a list element or below the top level."""
        number, text = F.pmod("event_id", F.lit(3)), F.col("event_id").cast("string")
        shapes = [
            ['[{"id":0,"id":', text, '},{"id":-1,"meta":{"a":[1],"a":', text, "}}]"],
            ['{"batch":', text, ',"hourly":{"id":[1],"id":[', text, ',-2],"id":[', text, ",7]}}"],
            ['{"id":', text, ',"meta":{"a":{"a":1,"a":2},"a":', text, "}}"],
        ]
        texts = [F.concat(*(F.lit(x) if isinstance(x, str) else x for x in shape)) for shape in shapes]
        document = F.when(number == 0, texts[0]).when(number == 1, texts[1]).otherwise(texts[2])
        return self.events.select(F.col("event_type").alias("source"), "event_id", document.alias("document"))

    @cached_property
    def repeated_below(self) -> DataFrame:
        """Records whose payload repeats names inside a member, two levels down."""
        payload = F.concat(F.lit('{"meta":{"a":1,"a":[{"b":1,"b":2}]},'), F.substr("payload", F.lit(2)))
        return self.recent.withColumn("payload", payload)

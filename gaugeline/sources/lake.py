"""A lake that a stream fills batch by batch and whose closed hours become few files."""

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.sources.folders import numbered, remove
from gaugeline.sources.writers import write_batch, write_lake

#: Snapshots of the lake that stay readable: the newest and those before it.
SNAPSHOTS = 2

_MANIFEST = "part BIGINT, up_to BIGINT, closed_before BIGINT"


class BatchLake:
    """Rows by partition, open hours by batch and closed hours by compaction.

    ``write`` puts a batch into ``open/batch_id=N``, so a replayed batch replaces
    itself. ``compact`` gathers the rows of hours that have ended from the batches
    written so far into few files under ``closed/part=K`` and then names that
    part; from then on ``read`` takes those rows from there. A compaction that
    fails before that leaves nothing in force, and a repeated one replaces its
    part. Rows that come late for a closed hour stand in newer batches and are
    gathered by the next compaction. Batches without open hours are removed once
    the entry that covers them is not the newest, so a frame opened before a
    compaction can be read after it.
    """

    def __init__(self, spark: SparkSession, path: str, layout: str, partitions: list[str]):
        """``layout`` names all columns; hours are told from year, month, day and hour if those are partitions."""
        self.spark, self.path, self.layout, self.partitions = spark, path.rstrip("/"), layout, partitions
        self.hourly = set(schema.TIME_PARTITIONS) <= set(partitions)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{self.path}/open", batch_id, self.partitions)

    def read(self, **where) -> DataFrame:
        """All rows, each once; ``where`` fixes partition columns."""
        entries = self._entries()
        rows = self._open(entries[-1:])
        if entries:
            closed = self._files("closed", "part BIGINT").filter(F.col("part") <= entries[-1].part).drop("part")
            rows = closed.unionByName(rows)
        for column, value in where.items():
            rows = rows.filter(F.col(column) == value)
        return rows

    def compact(self, closed_before: datetime | None = None) -> None:
        """Gather the batches written to their end; hours that end by ``closed_before``, or all rows of a lake without hours.

        Rows without an hour go with the closed ones. Entries never go back: an
        earlier time than before closes what the entry before it closed.
        """
        entries = self._entries()
        last = entries[-1] if entries else None
        done = [number for number, whole in numbered(self.spark, f"{self.path}/open", "batch_id").items() if whole]
        up_to = max([*done, last.up_to if last else -1])
        if self.hourly and closed_before is None:
            raise ValueError("a lake of hours needs the time before which they are closed")
        moment = max(_micros(closed_before) if closed_before else 0, last.closed_before if last else 0)
        part = last.part + 1 if last else 0
        rows = self._open(entries[-1:], self._covered(up_to, moment))
        target = f"{self.path}/closed/part={part}"
        remove(self.spark, target)  # left by a compaction that never ended
        write_lake(rows, target, self.partitions)
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(part).cast("bigint").alias("part"), F.lit(up_to).cast("bigint").alias("up_to"), F.lit(moment).cast("bigint").alias("closed_before")
        )
        entry.write.mode("overwrite").parquet(f"{self.path}/manifest/entry={part}")
        if len(entries) + 1 >= SNAPSHOTS:
            self._remove_covered([*entries, entry.first()][-SNAPSHOTS])

    def batches(self) -> list[int]:
        """The batches that still have a folder of their own."""
        return sorted(numbered(self.spark, f"{self.path}/open", "batch_id"))

    def _covered(self, up_to: int, closed_before: int) -> Column:
        """Whether a compaction up to this batch and time took a row; over partition columns alone."""
        taken = F.col("batch_id") <= up_to
        if not self.hourly:
            return taken
        return taken & F.coalesce(_hour_end() <= F.timestamp_micros(F.lit(closed_before)), F.lit(True))

    def _open(self, newest: list, wanted: Column | None = None) -> DataFrame:
        rows = self._files("open", "batch_id BIGINT")
        for entry in newest:
            rows = rows.filter(~self._covered(entry.up_to, entry.closed_before))
        if wanted is not None:
            rows = rows.filter(wanted)
        return rows.drop("batch_id")

    def _remove_covered(self, entry) -> None:
        """Remove the batches all of whose hours an entry covers; the folder names tell."""
        candidates = [number for number in self.batches() if number <= entry.up_to]
        if self.hourly and candidates:
            hours = self._files("open", "batch_id BIGINT").select("batch_id", *schema.TIME_PARTITIONS)
            left = hours.filter((F.col("batch_id") <= entry.up_to) & ~self._covered(entry.up_to, entry.closed_before))
            open_ones = {row.batch_id for row in left.select("batch_id").distinct().collect()}
            candidates = [number for number in candidates if number not in open_ones]
        for number in candidates:
            remove(self.spark, f"{self.path}/open/batch_id={number}")

    def _entries(self) -> list:
        return sorted(self._table("manifest", _MANIFEST).collect(), key=lambda entry: entry.part)

    def _files(self, part: str, number: str) -> DataFrame:
        return self._table(part, f"{self.layout}, {number}")

    def _table(self, part: str, columns: str) -> DataFrame:
        try:
            return self.spark.read.schema(columns).parquet(f"{self.path}/{part}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], columns)


def _hour_end() -> Column:
    parts = [F.col(name).cast("int") for name in schema.TIME_PARTITIONS]
    return F.make_timestamp(*parts, F.lit(0), F.lit(0)) + F.expr("INTERVAL 1 HOUR")


def _micros(moment: datetime) -> int:
    """Microseconds since 1970; a time without zone is UTC, as in the session."""
    return int((moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp() * 1_000_000)

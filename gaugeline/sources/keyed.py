"""Keyed tables on plain Parquet: a log of batches over a compacted base."""

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.operators.quality import broken_constraints
from gaugeline.operators.ranking import first_per_key
from gaugeline.operators.upsert import merge_batches, merge_into_buckets
from gaugeline.sources.folders import numbered, remove, stored_bytes
from gaugeline.sources.writers import write_batch, write_buckets


@dataclass(frozen=True)
class TableSpec:
    columns: str
    keys: list[str]
    frozen: list[str]
    mutable: list[str]
    first_by: list[str]
    required: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [column.split()[0] for column in self.columns.split(", ")]


RECORDS = TableSpec(
    schema.RECORDS,
    schema.RECORD_KEYS,
    schema.RECORD_FROZEN,
    schema.RECORD_MUTABLE,
    ["ingested_at", "payload"],
    schema.RECORD_REQUIRED,
    {"temperature": schema.TEMPERATURE_RANGE, "humidity": schema.HUMIDITY_RANGE},
)
AGGREGATES = TableSpec(
    schema.AGGREGATES,
    schema.AGGREGATE_KEYS,
    schema.AGGREGATE_FROZEN,
    schema.AGGREGATE_MUTABLE,
    ["window_end"],
    schema.AGGREGATE_REQUIRED,
)
METRICS = TableSpec(
    schema.METRICS,
    schema.METRIC_KEYS,
    schema.METRIC_FROZEN,
    schema.METRIC_MUTABLE,
    ["total_records"],
    schema.METRIC_REQUIRED,
)
DAILY = TableSpec(
    schema.DAILY, schema.DAILY_KEYS, schema.DAILY_FROZEN, schema.DAILY_MUTABLE, ["last_updated"]
)

_MANIFEST = "version BIGINT, up_to BIGINT, buckets INT"

#: A base has a bucket for so many stored bytes, and so many buckets at least.
BUCKET_BYTES, MIN_BUCKETS = 256 * 2**20, 8
#: Snapshots that stay readable: the newest and those before it.
SNAPSHOTS = 2


@dataclass(frozen=True)
class Snapshot:
    """A base version, the last batch folded into it, and its number of buckets."""

    version: int = 0
    up_to: int = -1
    buckets: int = 0


class KeyedTable:
    """Upserts without a table format.

    ``upsert`` writes a batch to ``log/batch_id=N``, so a replayed batch
    replaces itself. The base is stored in buckets of its keys: ``latest`` joins
    it with the merged newer batches, each read once, and shuffles only these.
    ``compact`` writes a new base version and then names it in the manifest; an
    interrupted compaction leaves the old base in force. What a new base
    replaces stays until ``SNAPSHOTS`` newer ones are named, so that a frame
    opened before a compaction can still be read after it.

    Rows that break a constraint of the table (a required column, a range) are
    set apart, with the names of the rules, in the same write and before the batch
    counts; no later step sees them but ``rejects``. Equal rejects of a batch are
    one row.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    def upsert(self, rows: DataFrame, batch_id: int, unique: bool = False) -> None:
        """Log a batch; ``unique`` says that its keys do not repeat."""
        spec = self.spec
        rows = rows.select(*spec.names, broken_constraints(spec.required, spec.ranges).alias("broken_rules"))
        if not unique:
            own = F.when(F.col("broken_rules") != "", F.xxhash64(*spec.names))  # rejects are no copies of a key
            rows = first_per_key(rows.withColumn("_reject", own), [*spec.keys, "_reject"], spec.first_by).drop("_reject")
        rows = rows.withColumn("accepted", F.col("broken_rules") == "")
        write_batch(rows, f"{self.path}/log", batch_id, ["accepted"])

    def latest(self) -> DataFrame:
        return self._merged(self._current(), None)

    def rejects(self) -> DataFrame:
        """All rows that broke a constraint: the table's columns and ``broken_rules``."""
        base = self._current()
        older = self._read("rejects", f"{self.spec.columns}, broken_rules STRING, version BIGINT")
        older = older.filter(F.col("version") <= base.version).drop("version")
        return older.unionByName(self._log(base, None, accepted=False))

    def last_batch(self) -> int:
        """The highest batch that was written to its end, -1 if there is none; from the folder names."""
        batches = numbered(self.spark, f"{self.path}/log", "batch_id")
        return max((number for number, done in batches.items() if done), default=-1)

    def compact(self, up_to: int | None = None, keep: Column | None = None, snapshots: int = SNAPSHOTS) -> None:
        """Fold the batches up to ``up_to`` into a new base, keeping rows that match ``keep``.

        By default all batches that were written to their end; the one that a
        running stream is writing has no end yet. A replay of a folded batch is
        passed over, since its rows are in the base. The old base is not shuffled
        unless the number of buckets has to grow.
        """
        old = self._current()
        if up_to is None:
            up_to = max(old.up_to, self.last_batch())
        if up_to < old.up_to:
            raise ValueError(f"batches up to {old.up_to} are folded already")
        rows = self._merged(old, up_to)
        if keep is not None:
            rows = rows.filter(keep)
        buckets = max(old.buckets, self._buckets(old))
        if buckets != old.buckets:
            rows = rows.repartition(buckets, *self.spec.keys)
        new = Snapshot(old.version + 1, up_to, buckets)
        self._log(old, up_to, accepted=False).write.mode("overwrite").parquet(f"{self.path}/rejects/version={new.version}")
        remove(self.spark, self._base(new))  # left by a compaction that never ended
        write_buckets(rows, self._base(new), buckets, self.spec.keys)
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(new.version).cast("bigint").alias("version"),
            F.lit(up_to).cast("bigint").alias("up_to"),
            F.lit(buckets).alias("buckets"),
        )
        entry.write.mode("overwrite").parquet(f"{self.path}/manifest/entry={new.version}")
        self.vacuum(snapshots)

    def vacuum(self, snapshots: int = SNAPSHOTS) -> None:
        """Remove what the newest ``snapshots`` do not need: batches folded before them and older bases.

        With 1, rows that a purge left out are gone from the storage at once, and
        frames opened before it can no longer be read.
        """
        entries = sorted(self._entries(), key=lambda entry: entry.version)
        oldest = entries[-snapshots] if len(entries) >= snapshots else Snapshot()
        for batch in numbered(self.spark, f"{self.path}/log", "batch_id"):
            if batch <= oldest.up_to:
                remove(self.spark, f"{self.path}/log/batch_id={batch}")
        for part, name in (("base", "version"), ("manifest", "entry")):
            for version in numbered(self.spark, f"{self.path}/{part}", name):
                if version < oldest.version:
                    remove(self.spark, f"{self.path}/{part}/{name}={version}")

    def _merged(self, base: Snapshot, up_to: int | None) -> DataFrame:
        spec = self.spec
        delta = self._log(base, up_to)
        if base.version == 0:
            return merge_batches(delta, spec.keys, spec.frozen, spec.mutable)
        return merge_into_buckets(self._bucketed(base), delta, base.buckets, spec.keys, spec.frozen, spec.mutable)

    def _log(self, base: Snapshot, up_to: int | None, accepted: bool = True) -> DataFrame:
        """Accepted rows of the batches after a base with their batch, or the rejected ones with their rules."""
        rows = self._read("log", f"{self.spec.columns}, broken_rules STRING, batch_id BIGINT, accepted BOOLEAN")
        rows = rows.filter((F.col("batch_id") > base.up_to) & (F.col("accepted") == accepted))
        if up_to is not None:
            rows = rows.filter(F.col("batch_id") <= up_to)
        return rows.select(*self.spec.names, "batch_id" if accepted else "broken_rules")

    def _base(self, snapshot: Snapshot) -> str:
        return f"{self.path}/base/version={snapshot.version}"

    def _bucketed(self, snapshot: Snapshot) -> DataFrame:
        """The rows of a base, known to Spark to lie in buckets.

        Only a table has buckets, so the folder is one for as long as it takes to
        open it; the catalogue keeps nothing.
        """
        name, keys = f"base_{uuid.uuid4().hex}", ", ".join(self.spec.keys)
        place = self._base(snapshot).replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({self.spec.columns}) USING parquet"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {snapshot.buckets} BUCKETS LOCATION '{place}'"
        )
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _buckets(self, old: Snapshot) -> int:
        """Buckets for the bytes that are stored now, a power of two so that growth is rare."""
        size = stored_bytes(self.spark, self._base(old)) + stored_bytes(self.spark, f"{self.path}/log")
        return max(MIN_BUCKETS, 1 << (size // BUCKET_BYTES).bit_length())

    def _entries(self) -> list[Snapshot]:
        """The snapshots that are named: a few small rows."""
        return [Snapshot(*row) for row in self._read("manifest", _MANIFEST).select("version", "up_to", "buckets").collect()]

    def _current(self) -> Snapshot:
        return max(self._entries(), key=lambda entry: entry.version, default=Snapshot())

    def _read(self, part: str, columns: str) -> DataFrame:
        try:
            return self.spark.read.schema(columns).parquet(f"{self.path}/{part}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], columns)

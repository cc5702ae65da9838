"""Keyed upserts as an aggregation over a log of batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_batches(
    log: DataFrame, keys: list[str], frozen: list[str], mutable: list[str], order: str = "batch_id"
) -> DataFrame:
    """The table after all upserts of ``log``.

    Each (key, batch) occurs once. Frozen columns keep the value of the first
    batch of a key, mutable columns take that of its last batch.
    """
    parts = []
    if frozen:
        parts.append(F.min_by(F.struct(*frozen), order).alias("_first"))
    if mutable:
        parts.append(F.max_by(F.struct(*mutable), order).alias("_last"))
    merged = log.groupBy(*keys).agg(*parts)
    wanted = [name for name in log.columns if name in {*keys, *frozen, *mutable}]
    spread = {name: f"_first.{name}" for name in frozen} | {name: f"_last.{name}" for name in mutable}
    return merged.select(*[F.col(spread.get(name, name)).alias(name) for name in wanted])


def merge_into_base(
    base: DataFrame,
    delta: DataFrame,
    keys: list[str],
    frozen: list[str],
    mutable: list[str],
    order: str = "batch_id",
) -> DataFrame:
    """``merge_batches`` of an older base and newer batches, without shuffling the base.

    The base is read once in full, to take over mutable columns, and once for
    its keys alone, to tell new keys from known ones. Both joins leave the
    choice to Spark, which broadcasts the delta's side only when its measured
    size is below the broadcast threshold.
    """
    newer = merge_batches(delta, keys, frozen, mutable, order)
    changes = newer.select(*keys, F.struct(*mutable).alias("_newer"))
    taken_over = {
        name: F.when(F.col("_newer").isNotNull(), F.col(f"_newer.{name}")).otherwise(F.col(name))
        for name in mutable
    }
    updated = base.join(changes, keys, "left").withColumns(taken_over)
    known = base.select(*keys).join(newer.select(*keys), keys, "left_semi")
    added = newer.join(known, keys, "left_anti")
    return updated.select(*newer.columns).unionByName(added)


def merge_into_buckets(
    base: DataFrame,
    delta: DataFrame,
    buckets: int,
    keys: list[str],
    frozen: list[str],
    mutable: list[str],
    order: str = "batch_id",
) -> DataFrame:
    """``merge_batches`` of a base stored in buckets of its keys and newer batches.

    The newer batches are folded, then dealt to the same buckets; the base stays
    where it is, so its size costs a scan and no shuffle, and a delta of any size
    will do. Base and delta are read once. The rows come out by bucket.
    """
    newer = merge_batches(delta, keys, frozen, mutable, order).repartition(buckets, *keys)
    newer = newer.select(*keys, F.struct(*frozen, *mutable).alias("_newer"))
    older = base.select(*keys, F.struct(*frozen, *mutable).alias("_older"))
    joined = older.join(newer, keys, "full_outer")
    first = {name: F.when(F.col("_older").isNotNull(), F.col(f"_older.{name}")).otherwise(F.col(f"_newer.{name}")) for name in frozen}
    last = {name: F.when(F.col("_newer").isNotNull(), F.col(f"_newer.{name}")).otherwise(F.col(f"_older.{name}")) for name in mutable}
    wanted = [name for name in base.columns if name in {*keys, *frozen, *mutable}]
    return joined.select(*[(first | last).get(name, F.col(name)).alias(name) for name in wanted])

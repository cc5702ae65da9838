"""First, latest and top-N rows per key, safe for a key that holds most rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 64


def top_per_key(
    rows: DataFrame,
    keys: list[str],
    order: list[Column],
    count: int,
    rank: str = "rank",
    spread: int = SPREAD,
) -> DataFrame:
    """The ``count`` first rows of each key in ``order``, with their ``rank``.

    Two exact steps. The first ranks within (key, slot), where all rows of an
    input partition share a slot: each input task sends at most ``count`` rows
    per key, since Spark drops the rest before the shuffle, and these rows of a
    hot key go to ``spread`` tasks. The second ranks the at most
    ``spread * count`` rows per key that are left. Which slot a row falls into
    does not change the result.
    """
    slot = F.pmod(F.spark_partition_id(), F.lit(spread))
    within = Window.partitionBy(*keys, "_slot").orderBy(*order)
    overall = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_slot", slot)
        .withColumn(rank, F.row_number().over(within))
        .filter(F.col(rank) <= count)
        .drop(rank, "_slot")
        .withColumn(rank, F.row_number().over(overall))
        .filter(F.col(rank) <= count)
    )


def _pick(rows: DataFrame, keys: list[str], aggregate: Column) -> DataFrame:
    picked = rows.groupBy(*keys).agg(aggregate.alias("_row")).select(*keys, "_row.*")
    return picked.select(*rows.columns)


def _rest(rows: DataFrame, keys: list[str]) -> Column:
    return F.struct(*[name for name in rows.columns if name not in keys])


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The earliest row per key. Copies are folded before the shuffle."""
    return _pick(rows, keys, F.min_by(_rest(rows, keys), F.struct(*order)))


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key. Older rows are folded before the shuffle."""
    return _pick(rows, keys, F.max_by(_rest(rows, keys), F.struct(*order)))

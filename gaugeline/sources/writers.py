"""Partitioned Parquet output and the outgoing event log."""

import uuid

from pyspark.sql import DataFrame

MAX_FILE_ROWS = 5_000_000


def write_lake(
    rows: DataFrame,
    path: str,
    partitions: list[str],
    mode: str = "append",
    tasks: int | None = None,
    split_on: str | None = None,
) -> None:
    """Batch write of a partitioned table.

    The rebalance hint gathers the rows of a folder, so tasks do not each write
    a small file into every folder; AQE splits a folder that holds most rows
    over several tasks and joins small ones. With ``tasks`` the rows are ranged
    over that many tasks instead, for many small folders; ``split_on`` ends the
    sort order so that a hot folder spans several ranges.
    """
    if tasks:
        placed = rows.repartitionByRange(tasks, *partitions, *([split_on] if split_on else []))
    else:
        placed = rows.hint("rebalance", *partitions)
    (
        placed.write.mode(mode)
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_batch(rows: DataFrame, path: str, batch_id: int, partitions: list[str] | None = None) -> None:
    """Write one micro-batch to its own folder; writing it again replaces it.

    Tasks write straight from their input split: a micro-batch spans few hours,
    and no shuffle means no hot task.
    """
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer = writer.option("maxRecordsPerFile", MAX_FILE_ROWS)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/batch_id={batch_id}")


def write_buckets(rows: DataFrame, path: str, buckets: int, keys: list[str]) -> None:
    """Write rows that are partitioned by their keys' buckets, a file a bucket.

    Spark writes buckets only into a table; its name is dropped and the files stay.
    """
    name = f"written_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    try:
        writer.format("parquet").saveAsTable(name)
    finally:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Send ``(topic, key, value)`` messages; needs the Kafka connector."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_text_log(messages: DataFrame, path: str) -> None:
    """The file form of the log: one envelope per line."""
    messages.select("value").write.mode("append").text(path)


def publish_jdbc(
    rows: DataFrame, url: str, table: str, tasks: int | None = None, **options: str
) -> None:
    """Replace the rows of a database table, for instance by a keyed table's latest view.

    ``tasks`` bounds the number of connections. Needs the driver's JDBC jar.
    """
    writer = rows.write.format("jdbc").mode("overwrite").option("truncate", "true")
    if tasks:
        writer = writer.option("numPartitions", tasks)
    writer.option("url", url).option("dbtable", table).options(**options).save()

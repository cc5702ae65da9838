"""Where rows come from: the event log, landed documents and stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import schema


def kafka_log(
    spark: SparkSession,
    servers: str,
    topic_pattern: str = r"telemetry\.raw\..*",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Stream of ``raw_value`` from all topics of a pattern, from the earliest offset.

    ``min_partitions`` splits a topic partition that holds most events over
    several tasks. Needs the Kafka connector on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topic_pattern)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return decode_values(reader.load())


def decode_values(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("raw_value"))


def file_log(
    spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None
) -> DataFrame:
    """``raw_value`` from text files with one envelope per line."""
    if not streaming:
        return decode_values(spark.read.text(path))
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return decode_values(reader.text(path))


def landed_documents(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """``(source, document)`` from ``source=<name>/`` folders, one file per API response."""
    layout = "value STRING, source STRING"
    reader = spark.readStream if streaming else spark.read
    files = reader.schema(layout).option("wholetext", "true").format("text").load(path)
    return files.select("source", F.col("value").alias("document"))


def read_lake(spark: SparkSession, path: str, layout: str, **where) -> DataFrame:
    """A Parquet table; ``where`` fixes partition columns, so other folders are not listed into tasks.

    The layout names the partition columns too: guessed from folder names, a
    source ``007`` would become a number.
    """
    rows = spark.read.schema(layout).parquet(path)
    for column, value in where.items():
        rows = rows.filter(F.col(column) == value)
    return rows


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.REGISTRY).parquet(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    parts: int | None = None,
    **options: str,
) -> DataFrame:
    """A serving table kept in a database, read in ``parts`` ranges of ``split_on``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_on and bounds and parts:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", parts)
        )
    return reader.load()

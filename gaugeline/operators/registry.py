"""The table of configured sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import schema


def active_sources(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("status") == "active")


def poll_interval(registry: DataFrame) -> DataFrame:
    """Shortest interval of the active sources, one row; 60 without any."""
    default = F.lit(schema.DEFAULT_POLL_SECONDS)
    shortest = F.min(F.coalesce("poll_interval", default))
    return active_sources(registry).agg(F.coalesce(shortest, default).alias("poll_interval"))

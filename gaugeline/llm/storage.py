"""Written tables and files in the folder that driver and executors share."""

from __future__ import annotations

import posixpath

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from gaugeline.session import work_folder


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write the rows as a Parquet table in the shared folder and read them again.

    Cuts the lineage: a lost executor costs a reread, and a later step sees
    exactly the rows that were written, however often its tasks are repeated.
    """
    spark = frame.sparkSession
    folder = work_folder(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def shared_folder(spark: SparkSession, label: str) -> str:
    """The name of a new folder for files that tasks write themselves."""
    return work_folder(spark, label)


def open_output(uri: str):
    """A binary output stream for a path or URI that executors share."""
    files, path = pafs.FileSystem.from_uri(uri)
    files.create_dir(posixpath.dirname(path), recursive=True)
    return files.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable binary input for a path or URI that executors share."""
    files, path = pafs.FileSystem.from_uri(uri)
    return files.open_input_file(path)

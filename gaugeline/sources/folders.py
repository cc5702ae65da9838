"""Numbered folders of a table, through the file system of its path."""

from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def numbered(spark: SparkSession, path: str, name: str) -> dict[int, bool]:
    """The numbers N of the folders ``name=N`` and whether each was written to its end."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return {}
    found = {}
    for status in files.listStatus(folder):
        label, _, number = status.getPath().getName().partition("=")
        if label == name and number.isdecimal():
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found[int(number)] = files.exists(done)
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that is gone already is no error, so a repeated call ends alike."""
    files, folder = _files(spark, path)
    files.delete(folder, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of all files below a folder, 0 if there is none; from the file system's own count."""
    files, folder = _files(spark, path)
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder if it is not there, for a stream that may start before its first file."""
    files, folder = _files(spark, path)
    files.mkdirs(folder)

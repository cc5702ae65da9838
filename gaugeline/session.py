"""Session settings and the shared work folder."""

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(name: str = "gaugeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times, AQE and RocksDB streaming state."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """One temporary folder of this process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="gaugeline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` wins. Only a local-mode session without that
    setting falls back to a temporary folder; a cluster session must name one,
    since executors cannot share a machine-local path.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Where intermediate tables and streaming checkpoints go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from datetime import timedelta
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    """One temporary folder per driver process, removed when it ends."""
    root = tempfile.mkdtemp(prefix="relstream-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def _root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder named by `spark.checkpoint.dir`.

    A machine-local folder stands in only for a local master, where driver and tasks share a disk; it goes with the
    driver. In a shared folder paths stay until `clear_scratch`.
    """
    root = _root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/relstream/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, older_than: timedelta = timedelta(days=2)) -> int:
    """Deletes scratch paths that have not changed for a while; returns how many. For a job that runs now and then."""
    jvm = spark.sparkContext._jvm
    root = _root(spark)
    if not root:
        return 0
    folder = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/relstream")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    limit = (time.time() - older_than.total_seconds()) * 1000
    old = [status.getPath() for status in files.listStatus(folder) if status.getModificationTime() <= limit]
    for path in old:
        files.delete(path, True)
    return len(old)

"""Tables that queries write themselves: where they are and when they go."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

_written: set[str] = set()
_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    On one machine a temporary one stands in where none is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="spark-"))
    return _local[0]


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of one's own in the shared one, which goes as Python ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.add(path)
    return path


def _at(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _at(spark, path)
    return system.exists(there)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    system, there = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(there)]


def remove(spark: SparkSession, path: str) -> None:
    system, there = _at(spark, path)
    system.delete(there, True)
    _written.discard(path)


@atexit.register
def _remove_all() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_written) if spark else []:
        with suppress(Exception):  # the session may have ended
            remove(spark, path)

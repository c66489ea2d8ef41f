"""Folders for tables that a job writes on its way to a result.

A result may read them when it runs, so nothing removes them by itself: whoever is done with a session's results calls
``clear``, and a folder that a caller made is the caller's to ``remove``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_made: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see what is written here, so a machine-local folder is used only
    when the setting is missing and the session itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/tallyhouse/{name}-{uuid.uuid4().hex}"
    _made.setdefault(_application(spark), []).append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Removes the folders that this process made for the session's application; the number of them.

    Results that have not run yet, or run again, fail after it.
    """
    paths = _made.pop(_application(spark), [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder wherever Spark can write; false if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()] if files.exists(where) else []


def _application(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", "")

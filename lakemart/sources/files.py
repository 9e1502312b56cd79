"""Folders on any file system Spark writes to."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from lakemart.session import work_dir

_open = threading.local()


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it doesn't exist."""
    files, target = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds."""
    files, target = _hadoop(spark, path)
    files.delete(target, True)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Folders handed out by ``scratch_folder`` inside are removed at the end.

    To be put around the action that reads them. The innermost space counts.
    """
    outer = getattr(_open, "folders", None)
    _open.folders = []
    try:
        yield
    finally:
        for folder in _open.folders:
            delete(spark, folder)
        _open.folders = outer


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate rows, below the shared work folder."""
    folder = f"{work_dir(spark)}/lakemart-scratch/{uuid.uuid4().hex}"
    if getattr(_open, "folders", None) is not None:
        _open.folders.append(folder)
    return folder

"""Cutting lineage with written tables.

A staged table lies in the folder that the cluster names in ``spark.checkpoint.dir``, which all
executors share, so it survives the loss of any of them.  Only a session on one machine (master
``local``), as in tests, may do without that setting: a folder is then made for it.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


class NoSharedFolder(RuntimeError):
    """The session runs on several machines, but names no folder that they share."""


def folder(spark: SparkSession) -> str:
    """The shared folder; on one machine a temporary one where none is set."""
    set_by_cluster = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith(("local[", "local-cluster[")):  # all of these are one machine
        raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    made = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


_scopes: list[list[tuple[SparkSession, str]]] = []


def place(spark: SparkSession) -> str:
    """A new path in the shared folder.  What is written there goes with the enclosing :func:`scope`, else when the program ends."""
    path = f"{folder(spark)}/millrace/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append((spark, path))
    else:
        atexit.register(_remove, spark, path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """``df``, computed once and read back."""
    path = place(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """What is staged inside is removed at the end: for work whose results are written or collected inside."""
    _scopes.append([])
    try:
        yield
    finally:
        for spark, path in _scopes.pop():
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may be gone
        pass

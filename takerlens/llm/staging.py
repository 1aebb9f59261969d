"""Intermediate tables in the shared folder that the cluster names in `spark.checkpoint.dir`."""

from __future__ import annotations

import atexit
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from takerlens.session import scratch_dir

_LEFT: list[tuple[SparkSession, str]] = []
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@atexit.register
def _clear(since: int = 0, until: int | None = None) -> None:
    for spark, path in _LEFT[since:until]:
        try:
            jvm = spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        except Exception:  # the session has ended; the folder is the cluster's to clear
            pass
    del _LEFT[since:until]


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh shared folder, removed when the driver ends."""
    path = scratch_dir(spark, name)
    _LEFT.append((spark, path))
    return path


def staged(rows: DataFrame, name: str) -> DataFrame:
    """`rows` written once as Parquet and read back: later uses neither recompute nor depend on lost executors."""
    path = shared_dir(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def staged_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """`make()` staged; what it staged itself on the way is deleted."""
    since = len(_LEFT)
    out = staged(make(), name)
    _clear(since, -1)
    return out


def with_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package; on a cluster `--py-files` brings it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def for_texts(spark: SparkSession) -> SparkSession:
    """`with_package`, and texts reach Python 4 MB at a time, if the session leaves Spark's limit as it is.

    Under that limit a task's whole split makes one batch, which then lies several times in memory outside the executor's
    heap: in buffers that double as they fill, as the worker's Arrow data and as its Python objects.
    """
    if spark.conf.get(_BATCH) in ("64MB", f"{64 << 20}b"):
        spark.conf.set(_BATCH, "4m")
    return with_package(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    for_texts(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

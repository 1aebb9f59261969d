"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Every job assumes UTC, ANSI errors and runtime re-planning. Skewed shuffle
# partitions of a lookup join (a hot event, or NULL keys) are split by AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A session runs many queries; the default of 100 would compile them again and again.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Call-site capture costs several driver round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_LOCAL: dict[str, str] = {}
_USED: list[str] = []


def build_session(app: str = "takerlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh folder below the cluster's shared `spark.checkpoint.dir`.

    Only a local session may fall back to a machine-local folder: on a cluster
    that folder would be gone with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get("base")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _LOCAL["base"] = tempfile.mkdtemp(prefix="takerlens-")
    path = f"{base.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
    _USED.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def cleared_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are deleted at the end; nothing that is kept may read them."""
    since = len(_USED)
    try:
        yield
    finally:
        for path in _USED[since:]:
            delete(spark, path)
        del _USED[since:]


def staged(rows: DataFrame) -> DataFrame:
    """Rows written to the shared scratch folder: computed once, however often they are read."""
    path = scratch_dir(rows.sparkSession, "staged")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pieces(*inputs: DataFrame, piece_bytes: int, least: int = 1, most: int = 100_000) -> int:
    """How many pieces of bounded size the inputs make, by Catalyst's estimates."""
    total = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    return min(max(least, -(-total // piece_bytes)), most)


def size_shuffles(spark: SparkSession, *inputs: DataFrame, partition_bytes: int = 128 << 20, most: int = 100_000) -> int:
    """Raise `spark.sql.shuffle.partitions` so that shuffling the inputs makes partitions of bounded size.

    Sizes are Catalyst's estimates of the inputs; AQE merges what turns out small.
    """
    n = pieces(*inputs, piece_bytes=partition_bytes, least=int(spark.conf.get("spark.sql.shuffle.partitions")), most=most)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n

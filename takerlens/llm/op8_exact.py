"""Exact deduplication as a stateful stream.

The documents pass once as a stream. Disk-backed state, kept for good, holds per digest the best identifier so far, the
number of rows, and where the content of the best row lies (file and row): contents themselves are not kept. Each trigger
appends the digests it touched to a log. Where a digest was hit, full bytes decide: the texts behind it are compared, and
a digest that stands for two texts is split by text.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from takerlens.llm.staging import shared_dir, staged, with_package

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    # Without this every state partition takes megabytes of disk ahead of its needs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(files: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Each row with its text (NULL: empty), digest and `best`: of two rows of a text the one with the larger stays."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return files.select("doc_id", text.alias("text"), digest(text).alias("digest"), F.struct(
        "doc_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("best"))


def run_stream(spark: SparkSession, path: str, log: str, checkpoint: str, digest: Callable[[Column], Column] = sha256,
               **options) -> None:
    """Takes in the files of `path` that `checkpoint` has not seen, and appends the digests they touch to `log`.

    A trigger that is run again after a failure overwrites its own part of the log.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema).options(**options)
    one = f"{path[:-1]}[{path[-1]}]"  # as a pattern the path may be a single file; a stream takes no file by name
    state = _rows(reader.parquet(one), digest).groupBy("digest").agg(F.max("best").alias("best"),
                                                                     F.count("*").alias("size"))

    def append(touched: DataFrame, batch: int) -> None:
        touched.write.mode("overwrite").parquet(f"{log}/batch={batch}")

    with _settings(spark, _STATE):
        query = (state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                 .foreachBatch(append).trigger(availableNow=True).start())
        query.awaitTermination()


def classes(spark: SparkSession, log: str) -> DataFrame:
    """digest, best, size as the state has them: a digest's count only grows, so its largest is the newest."""
    return spark.read.parquet(log).groupBy("digest").agg(F.max(F.struct("size", "best")).alias("newest")).select(
        "digest", "newest.best", "newest.size")


def deduplicate(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256,
                max_bytes: int = 1 << 30) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of the Parquet files at `path`.

    Of rows with equal texts the one with the largest doc_id stays; of repeated rows with that id the last in file order.
    NULL and empty texts are equal; a NULL doc_id is below all others. An empty table gives no rows; other columns are
    ignored. `max_bytes` bounds what one trigger takes in.
    """
    with_package(spark)
    path = path.rstrip("/")
    base = shared_dir(spark, "exact")
    rows = _rows(spark.read.parquet(path), digest)
    if rows.isEmpty():
        return _result(rows.withColumn("kept_row", F.col("best")).withColumn("size", F.lit(0)))
    run_stream(spark, path, f"{base}/log", f"{base}/stream", digest, maxBytesPerTrigger=max_bytes)
    known = staged(classes(spark, f"{base}/log"), "classes")
    split = staged(_split(rows, known), "split")
    grouped = rows.withColumn("sha", F.sha2("text", 256)).drop("text").join(
        known.withColumnRenamed("best", "kept_row"), "digest")
    if split.isEmpty():
        return _result(grouped)
    # Digests that stand for several texts: their rows are grouped by text.
    apart = rows.join(split.drop("best", "size"), ["digest", "text"], "left_semi").join(
        split.withColumnRenamed("best", "kept_row"), ["digest", "text"]).withColumn("sha", F.sha2("text", 256))
    alone = grouped.join(split.select("digest").distinct(), "digest", "left_anti")
    return _result(alone.unionByName(apart.select(*alone.columns)))


def _split(rows: DataFrame, known: DataFrame) -> DataFrame:
    """digest, text, best, size of each text behind a digest that was hit and stands for more than one text.

    Equal texts combine before the shuffle, so a hot group sends one row per task.
    """
    hits = known.where("size > 1").select("digest")
    texts = rows.join(hits, "digest", "left_semi").groupBy("digest", "text").agg(F.max("best").alias("best"),
                                                                              F.count("*").alias("size"))
    n = F.count("*").over(Window.partitionBy("digest"))
    return texts.withColumn("n", n).where("n > 1").drop("n")


def _result(rows: DataFrame) -> DataFrame:
    sha = F.col("sha") if "sha" in rows.columns else F.sha2("text", 256)
    return rows.select("doc_id", F.col("kept_row.doc_id").alias("keep_id"), F.col("size").cast("long").alias("group_size"),
                       F.col("best").eqNullSafe(F.col("kept_row")).alias("kept"), sha.alias("text_sha256"))


def op8_streaming_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(spark, f"{sf_dir}/documents.parquet")


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

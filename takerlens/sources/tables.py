"""Tables kept as Parquet folders on the cluster's shared file system.

A write commits whole partitions. Log tables take appends keyed by a batch id;
writing a batch again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takerlens.operators.merge import last_wins, upsert
from takerlens.session import delete as _delete
from takerlens.session import scratch_dir


def _children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names below a folder that start with `prefix`, sorted."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith(prefix))


def _rename(spark: SparkSession, path: str, to: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path}")


def _minute(moment: Column) -> Column:
    return F.floor(F.unix_seconds(moment.cast("timestamp")) / 60)


class KeyedTable:
    """One row per key, as Parquet partitioned by a hash of the key.

    An upsert reads and overwrites only the partitions its keys fall in. New rows
    are staged first, so no folder is read and overwritten in one job.
    `parts` must stay what it was when the table was first written.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], parts: int = 64):
        self.spark, self.path, self.schema, self.keys, self.parts = spark, path.rstrip("/"), schema, list(keys), parts

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def _stored(self) -> DataFrame:
        if not _children(self.spark, self.path, "part="):
            return self.spark.createDataFrame([], f"{self.schema}, part int")
        return self.spark.read.schema(f"{self.schema}, part int").parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop("part")

    def upsert(self, rows: DataFrame, order: Sequence[str] | None = None, **options) -> None:
        """Insert or overwrite the rows' keys (see `merge.upsert`); other partitions are not touched."""
        stored = self._stored()
        if order:
            rows = last_wins(rows, self.keys, order).drop(*[c for c in order if c not in stored.columns])
        # Nothing to write leaves the table as it is.
        touched = [r[0] for r in rows.select(self._part()).distinct().collect()]  # at most `parts`
        if not touched:
            return
        known = stored.where(F.col("part").isin(touched)).drop("part")
        staging = scratch_dir(self.spark, "upsert")
        merged = upsert(known, rows, self.keys, **options).withColumn("part", self._part())
        merged.write.parquet(staging)
        (self.spark.read.schema(merged.schema).parquet(staging).hint("rebalance", "part").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.path))
        _delete(self.spark, staging)


class DatedTable:
    """One row per key, as Parquet partitioned by the day of a time column.

    A read of a range opens only its days. An upsert reads and overwrites the days its rows fall on and those their keys lay on
    before; a scan of the key column alone finds these. Days count from 1970 in UTC, whatever the session's
    time zone; rows without a time share a folder. `days` makes folders of several days, for sparse tables.
    """

    UNDATED = -1_000_000

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], moment: str = "settlement_ts",
                 day: str = "settled_day", days: int = 1):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.moment, self.day, self.seconds = moment, day, 86400 * days

    def day_of(self, moment: Column) -> Column:
        return F.coalesce(F.floor(F.unix_seconds(moment.cast("timestamp")) / self.seconds), F.lit(self.UNDATED)).cast("int")

    def _stored(self) -> DataFrame:
        if not _children(self.spark, self.path, f"{self.day}="):
            return self.spark.createDataFrame([], f"{self.schema}, {self.day} int")
        return self.spark.read.schema(f"{self.schema}, {self.day} int").parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(self.day)

    def between(self, low, high=None) -> DataFrame:
        """Rows from `low` to `high`, both included; only the folders of these days are opened."""
        rows, day = self._stored().where(F.col(self.moment) >= F.lit(low)), F.col(self.day)
        rows = rows.where(day >= self.day_of(F.lit(low)))
        if high is not None:
            rows = rows.where((F.col(self.moment) <= F.lit(high)) & (day <= self.day_of(F.lit(high))))
        return rows.drop(self.day)

    def on_days(self, days: DataFrame) -> DataFrame:
        """Rows of the days in `days`. While that side is small and filtered, Spark prunes folders by it at run time."""
        return self._stored().join(days.select(self.day), self.day, "left_semi").drop(self.day)

    def upsert(self, rows: DataFrame, order: Sequence[str] | None = None, **options) -> None:
        """Insert or overwrite the rows' keys (see `merge.upsert`); days they do not touch stay as they are.

        `rows` have the time column; a key whose time changed moves to its new day. What reaches the driver are days.
        """
        stored = self._stored()
        if order:
            rows = last_wins(rows, self.keys, order).drop(*[c for c in order if c not in stored.columns])
        days = {r[0] for r in rows.select(self.day_of(F.col(self.moment))).distinct().collect()}
        if not days:
            return
        there = {int(n.split("=")[1]) for n in _children(self.spark, self.path, f"{self.day}=")}
        held = set()
        if there:
            held = {r[0] for r in stored.join(rows.select(*self.keys), self.keys, "left_semi").select(self.day).distinct().collect()}
        day, fresh = self.day_of(F.col(self.moment)), days - there
        if not held and fresh:
            # No key is known: days without a folder are written as they come, with nothing to merge or to stage.
            some = rows if fresh == days else rows.where(day.isin(sorted(fresh)))
            none = self.spark.createDataFrame([], self.schema).where("false")
            self._replace(upsert(none, some, self.keys, **options).withColumn(self.day, day))
            rows, days = rows.where(day.isin(sorted(days - fresh))), days - fresh
            if not days:
                return
        days |= held
        known = stored.where(F.col(self.day).isin(sorted(days))).drop(self.day)
        staging = scratch_dir(self.spark, "upsert")
        merged = upsert(known, rows, self.keys, **options).withColumn(self.day, day)
        merged.write.parquet(staging)
        new = self.spark.read.schema(merged.schema).parquet(staging)
        self._replace(new)
        # A day that all its rows have left is not among those written.
        for gone in days - {r[0] for r in new.select(self.day).distinct().collect()}:
            _delete(self.spark, f"{self.path}/{self.day}={gone}")
        _delete(self.spark, staging)

    def _replace(self, rows: DataFrame) -> None:
        """Rows in place of the folders of their days."""
        (rows.hint("rebalance", self.day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.day).parquet(self.path))


class BatchLog:
    """Append-only rows below `batch_id=`; a repeated batch overwrites itself."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.partition_by = spark, path.rstrip("/"), schema, list(partition_by)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Written aside and then renamed: a failed write leaves the batch as it was."""
        aside, place = f"{self.path}/_writing-{batch_id}", f"{self.path}/batch_id={batch_id}"
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(aside)
        _delete(self.spark, place)
        _rename(self.spark, aside, place)

    def _settle(self) -> None:
        """Finish a write that stopped between its two last steps: whole, but not in its place."""
        for name in _children(self.spark, self.path, "_writing-"):
            place = f"batch_id={name.split('-', 1)[1]}"
            if "_SUCCESS" in _children(self.spark, f"{self.path}/{name}", "_SUCCESS") \
                    and not _children(self.spark, self.path, place):
                _rename(self.spark, f"{self.path}/{name}", f"{self.path}/{place}")

    def read(self) -> DataFrame:
        """All rows with their `batch_id`."""
        self._settle()
        if not _children(self.spark, self.path, "batch_id="):
            return self.spark.createDataFrame([], f"{self.schema}, batch_id bigint")
        return self.spark.read.schema(f"{self.schema}, batch_id bigint").parquet(self.path)

    def latest(self, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
        """One row per key: the last by batch, then by `order`."""
        return last_wins(self.read(), keys, ["batch_id", *order])

    def batches(self) -> list[int]:
        self._settle()
        return sorted(int(n.split("=")[1]) for n in _children(self.spark, self.path, "batch_id="))

    def compact(self, keys: Sequence[str], until: int, order: Sequence[str] = ()) -> None:
        """Fold the batches up to `until` into that one: a row per key, the last.

        The folded batch is in place before the older ones go. They lose against it meanwhile, so a
        reader of `latest` sees the same rows at any moment, and a stopped compaction can run again.
        """
        old = [b for b in self.batches() if b <= until]
        if len(old) < 2:
            return
        upto = self.read().where(F.col("batch_id") <= F.lit(until))
        self.write(last_wins(upto, keys, ["batch_id", *order]).drop("batch_id"), old[-1])
        for batch in old[:-1]:
            _delete(self.spark, f"{self.path}/batch_id={batch}")

    def partitions(self) -> list[dict[str, str]]:
        """The folders of the log by their columns, from the listing alone."""
        if not self.batches():
            return []
        glob = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, "batch_id=*", *(f"{c}=*" for c in self.partition_by)]))
        found = glob.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(glob)
        depth = 1 + len(self.partition_by)
        return [dict(x.split("=", 1) for x in str(s.getPath()).split("/")[-depth:]) for s in found]


class SnapshotTable:
    """Snapshots partitioned by run, so a window read or a prune touches whole folders.

    `run_minute` (minutes since 1970, whatever the session's time zone) names the
    partition; it sorts like run_ts.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def read(self) -> DataFrame:
        if not _children(self.spark, self.path, "run_minute="):
            return self.spark.createDataFrame([], f"{self.schema}, run_minute bigint")
        return self.spark.read.schema(f"{self.schema}, run_minute bigint").parquet(self.path)

    def since(self, moment) -> DataFrame:
        """Rows from a time on, pruned to the run folders that can hold them."""
        low = _minute(F.lit(moment))
        return self.read().where((F.col("run_minute") >= low) & (F.col("run_ts") >= F.lit(moment)))

    def append(self, rows: DataFrame, staging: str) -> int:
        """Write runs and return the row count; a run already there keeps its other keys.

        Rows are staged first, so the count is a footer read, lineage ends here,
        and no folder is read and overwritten in one job. Only the run numbers
        come to the driver (at most one per minute of the batch); they prune the
        folders read for the merge. `rebalance` sizes the output files and
        splits a large run over several tasks.
        """
        rows.withColumn("run_minute", _minute(F.col("run_ts"))).write.mode("overwrite").parquet(f"{staging}/new")
        new = self.spark.read.schema(f"{self.schema}, run_minute bigint").parquet(f"{staging}/new")
        stored = {int(n.split("=")[1]) for n in _children(self.spark, self.path, "run_minute=")}
        again = [r[0] for r in new.select("run_minute").distinct().collect() if r[0] in stored] if stored else []
        out = new
        if again:
            old = self.read().where(F.col("run_minute").isin(again))
            both = old.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
            merged = last_wins(both, ["ticker", "run_ts", "run_minute"], ["_rank"]).drop("_rank")
            merged.write.mode("overwrite").parquet(f"{staging}/merged")
            out = self.spark.read.schema(new.schema).parquet(f"{staging}/merged")
        (out.hint("rebalance", "run_minute").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_minute").parquet(self.path))
        return new.count()

    def prune(self, before) -> list[str]:
        """Drop whole run folders older than a time; nothing is rewritten."""
        limit = self.spark.range(1).select(_minute(F.lit(before))).first()[0]
        gone = [n for n in _children(self.spark, self.path, "run_minute=") if int(n.split("=")[1]) < limit]
        for name in gone:
            _delete(self.spark, f"{self.path}/{name}")
        return gone

"""Keyed tables by key hash and batch logs."""

import os

from pyspark.sql import functions as F

from takerlens.sources.tables import BatchLog, KeyedTable

SCHEMA = "k string, v int, first string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, v int")


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_upserts_overwrite_only_their_partitions(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], parts=8)
    assert table.read().count() == 0
    table.upsert(rows(spark, ("a", 1), ("b", 2), ("x", 7), ("y", 8)), defaults={"first": F.lit("one")})
    before = {p: os.listdir(tmp_path / "t" / p) for p in os.listdir(tmp_path / "t") if p.startswith("part=")}
    table.upsert(rows(spark, ("b", None), ("c", 3)), defaults={"first": F.lit("two")})
    after = {p: os.listdir(tmp_path / "t" / p) for p in os.listdir(tmp_path / "t") if p.startswith("part=")}
    assert 0 < sum(before[p] != after[p] for p in before) <= 2
    assert content(table) == [("a", 1, "one"), ("b", None, "one"), ("c", 3, "two"), ("x", 7, "one"), ("y", 8, "one")]
    table.upsert(rows(spark, ("b", 9), ("b", 8)).withColumn("n", F.col("v")), order=["n"], defaults={"first": F.lit("no")})
    table.upsert(rows(spark, ("d", 4)), update_cols=[])
    table.upsert(rows(spark, ("d", 5)), update_cols=[])
    assert [r for r in content(table) if r[0] in "bd"] == [("b", 9, "one"), ("d", 4, None)]


def test_batch_log_replaces_a_repeated_batch(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), "k string, v int")
    assert log.read().count() == 0
    log.write(rows(spark, ("a", 1), ("b", 1)), 0)
    log.write(rows(spark, ("a", 2)), 1)
    log.write(rows(spark, ("a", 3)), 1)
    assert sorted((r.k, r.v) for r in log.latest(["k"]).collect()) == [("a", 3), ("b", 1)]

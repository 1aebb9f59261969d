"""The registered queries and the pipeline."""

import os
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from takerlens.llm import op9_isolation
from takerlens.llm.blocks import released
from takerlens.llm.op1_pii import masked
from takerlens.llm.op8_exact import OP8_SQL, op8_streaming_exact_dedup
from takerlens.llm.queries import QUERIES
from takerlens.llm.staging import for_texts
from tests.compare import compare, duck
from tests.llm.conftest import FOLDER, needs_tables
from tests.llm.test_dedup import slow_classes, slow_lines


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "personal_data", "packing"]


@needs_tables
def test_exact_copies_match_sql(spark):
    assert compare(op8_streaming_exact_dedup(spark, FOLDER), duck(FOLDER), OP8_SQL) is None


@needs_tables
def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumnRenamed("n_chars", "block")
    columns = docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    judged = op9_isolation.judge(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    good = {r.doc_id for r in judged if r.kept}
    expected = [r for r in rows if r[0] in good]
    after = [lambda x: x, slow_lines, lambda x: [r for r, c in zip(x, slow_classes(x)) if r[0] == c[1]],
             lambda x: [(i, masked(t)) for i, t in x]]
    for (name, stage), step in zip(corpus_pipeline.STAGES[:-1], after):
        expected = step(expected)
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(expected), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in expected}


@needs_tables
def test_run(spark):
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(corpus_pipeline.run(spark, FOLDER).columns)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_empty_tables_stay_empty(spark, stored, tmp_path, stage):
    docs = stored([(1, "a")], 1).limit(0)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert stage[1](spark, docs, str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_texts_reach_python_a_few_megabytes_at_a_time(spark, stored, tmp_path, stage):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = stored([(i, f"{i} " + "word " * 2000) for i in range(1500)], 1)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    spark.conf.unset(limit)
    stage[1](spark, docs.limit(0), str(tmp_path))
    found = [r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 15_000_000 and max(found) < 5_000_000


def test_a_limit_of_the_session_stays(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(limit, "16m")
    assert for_texts(spark).conf.get(limit) == "16m"
    spark.conf.unset(limit)


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="Linux only")
def test_workers_give_back_what_they_no_longer_need():
    def held():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Anonymous: +(\d+)", f.read())[1]) >> 10

    texts = [bytes(4000) for _ in range(50_000)]
    kept = texts[::1000]  # scattered, so that nothing goes back by itself
    del texts
    before = held()
    released()
    assert len(kept) == 50 and before - held() > 100

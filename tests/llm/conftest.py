import os
import random

import pytest

from takerlens.llm.staging import with_package

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Writes rows (doc_id, text) with two clashing columns as a Parquet table and reads it back."""
    with_package(spark)

    def write(rows, files=3):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        table = spark.createDataFrame(list(rows), "doc_id long, text string")
        table = table.selectExpr("*", "'x' AS block", "1 AS n_tokens", "CAST(NULL AS string) AS kept")
        table.repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture(scope="session")
def samples(spark):
    """Real rows, and NULL, empty, blank, repeated, very long and nameless ones."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()] \
        if os.path.isdir(FOLDER) else [(i, f"some plain words of text number {i}") for i in range(50)]
    return rows + [(9001, None), (9002, ""), (9003, " \n\t "), rows[0], (None, "no id at all"), (None, None),
                   (9004, "word " * 30_000), (9005, "x" * 60_000)]


def babble(alphabet, n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]

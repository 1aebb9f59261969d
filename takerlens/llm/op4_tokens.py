"""Token counts by distinct pre-token: pieces are counted once per distinct pre-token, joined to per-document pre-token
frequencies, and summed. No token ids of a document exist at any point."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.blocks import Vocabulary, answered, cut, finished, id_type
from takerlens.llm.staging import documents
from takerlens.llm.wordpieces import encoder, pretokens, public_path


def _frequencies(ids: pa.Array, texts: list[bytes]) -> tuple[pa.Table, list[str], None]:
    chunks = Vocabulary()
    rows = []
    for text in texts:
        found = Counter(text.split())
        rows.append((chunks.indices(list(found)), np.fromiter(found.values(), np.int32, len(found))))
    words, pairs = pretokens(list(chunks))
    steps, frequency = [], []
    for chunk, times in rows:
        tail = pairs[chunk, 1]
        both, times = np.concatenate([pairs[chunk, 0], tail[tail >= 0]]), np.concatenate([times, times[tail >= 0]])
        order = np.argsort(both)
        steps.append(np.diff(both[order], prepend=0))  # in order and as differences they compress to half
        frequency.append(times[order])
    data = pa.table({"doc_id": ids, "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                     "steps": pa.array(steps, pa.list_(pa.int32())),
                     "frequency": pa.array(frequency, pa.list_(pa.int32()))})
    return data, words, None


def _summed(data: pa.Table, pieces: np.ndarray, _) -> pa.Table:
    steps, frequency = data.column("steps").combine_chunks(), data.column("frequency").combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(steps.value_lengths().to_numpy())])
    so_far = np.concatenate([[0], np.cumsum(steps.flatten().to_numpy(), dtype=np.int64)])
    index = so_far[1:] - np.repeat(so_far[bounds[:-1]], np.diff(bounds))
    total = np.concatenate([[0], np.cumsum(pieces[index] * frequency.flatten().to_numpy())])
    return pa.table({"doc_id": data.column("doc_id"), "n_bytes": data.column("n_bytes"),
                     "n_tokens": pa.array((total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64))})


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of `docs` (doc_id, text).

    Counts equal the library's, without added special tokens. NULL and empty texts have 0 tokens; repeated rows and NULL
    ids give a row each; an empty table gives no rows; other columns are ignored. A chunk of any length is counted whole.
    """
    path = path or public_path("word_bpe_49k.json")
    rows = answered(cut(docs, _frequencies), encoder(path, count_only=True))
    rows = finished(rows, _summed, f"doc_id {id_type(docs)}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_distinct_pretoken_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))

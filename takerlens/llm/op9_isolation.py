"""Quality rules by isolation forest: random splits of rule statistics set anomalous documents apart in few steps.

Trees are grown on a bounded sample of the rows labelled good. The threshold on path length comes from all labelled rows:
their scores are counted per label, and the cut that parts them best is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.blocks import Vocabulary, id_and_bytes, id_type
from takerlens.llm.staging import documents, staged

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = b".,;:!?"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("word_length", "symbols", "dup_lines", "repeated", "capitals", "digits", "marks", "variety", "line_words")
BINS = 2000


def _less(text: bytes, these: bytes) -> int:
    return len(text) - len(text.translate(None, these))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that are found at least twice, the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    index = Vocabulary().indices(words).astype(np.int64)
    pair = np.unique(index[:-1] * (index.max() + 1) + index[1:], return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * (index.max() + 1) + index[2:], return_inverse=True, return_counts=True)
    inside = np.zeros(n + 2, bool)
    again = times[which] > 1
    for k in range(3):
        inside[k:k + n] |= again
    return int(inside.sum())


def statistics(text: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The contract's counts and the features the forest splits on."""
    words = text.split()
    n = len(words)
    chars = len(text.decode()) - _less(text, SPACE)
    symbols = _less(text, SYMBOLS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    counts = (n, chars, symbols, dup_lines, repeated)
    if not n:
        return counts, (0.0,) * len(FEATURES)
    return counts, (chars / n, symbols / n, dup_lines / len(lines), repeated / n, _less(text, CAPITALS) / chars,
                    _less(text, DIGITS) / chars, _less(text, MARKS) / n, np.log1p(len(set(words))) / np.log1p(n),
                    float(np.log(n / len(lines))))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, and the features as float64 bytes, for each row of `docs`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text) for text in batch.column(1).to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            features = pa.array([np.array(f).tobytes() for _, f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in counts.T), features],
                                             ["doc_id", *COUNTS, "features"])

    return id_and_bytes(docs).mapInArrow(
        rows, f"doc_id {id_type(docs)}, {', '.join(f'{c} long' for c in COUNTS)}, features binary")


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of a search that fails among n rows; what is left below a leaf of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    feature: np.ndarray  # (trees, nodes); -1 at a leaf. Children of node i are 2 i + 1 and 2 i + 2
    split: np.ndarray
    length: np.ndarray  # at a leaf, the whole path length
    sample: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path length over its expectation: near 1 for anomalies, near 0.5 or less else."""
        total = np.zeros(len(rows))
        for feature, split, length in zip(self.feature, self.split, self.length):
            node = np.zeros(len(rows), np.int64)
            while (inner := feature[node] >= 0).any():
                at = node[inner]
                node[inner] = 2 * at + 1 + (rows[inner, feature[at]] >= split[at])
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / max(float(_average_path(self.sample)), 1.0))


def grow(rows: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(rows))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    shape = (trees, 2 ** (depth + 1) - 1)
    forest = Forest(np.full(shape, -1), np.zeros(shape), np.zeros(shape), sample)
    for t in range(trees):
        todo = [(0, rng.permutation(len(rows))[:sample], 0)]
        while todo:
            node, members, level = todo.pop()
            if level == depth or len(members) < 2:
                forest.length[t, node] = level + _average_path(len(members))
                continue
            f = int(rng.integers(rows.shape[1]))
            low, high = rows[members, f].min(), rows[members, f].max()
            # Beyond what was seen too, so that a value outside the sample's is set apart even where the sample is constant.
            margin = max((high - low) / 2, 1.0)
            cut = rng.uniform(low - margin, high + margin)
            forest.feature[t, node], forest.split[t, node] = f, cut
            right = rows[members, f] >= cut
            todo += [(2 * node + 1, members[~right], level + 1), (2 * node + 2, members[right], level + 1)]
    return forest


@dataclass
class Model:
    """Features count by how far they lie outside the range of good rows, in widths of that range."""

    low: np.ndarray
    high: np.ndarray
    forest: Forest
    threshold: float = 1.0

    def score(self, features: np.ndarray) -> np.ndarray:
        outside = np.maximum(0, np.maximum(self.low - features, features - self.high))
        return self.forest.score(np.minimum(outside / np.maximum(self.high - self.low, 0.01), 100))

    def keeps(self, features: np.ndarray) -> np.ndarray:
        return self.score(features) <= self.threshold


def model_of(good: np.ndarray, tail: float = 0.005, **forest) -> Model:
    low, high = np.quantile(good, [tail, 1 - tail], axis=0)
    model = Model(low, high, grow(np.zeros((1, good.shape[1])), trees=1))
    outside = np.maximum(0, np.maximum(low - good, good - high)) / np.maximum(high - low, 0.01)
    model.forest = grow(np.minimum(outside, 100), **forest)
    return model


def cut_of(good: np.ndarray, bad: np.ndarray, weight: float) -> float:
    """The score above which to reject, from counts per score bin: most bad rows less `weight` times the good ones, in
    shares; of a stretch of equal cuts the middle."""
    gain = ((bad.sum() - np.cumsum(bad)) / max(bad.sum(), 1) - weight * (good.sum() - np.cumsum(good)) / max(good.sum(), 1))
    first = last = int(gain.argmax())
    while last + 1 < len(gain) and gain[last + 1] == gain[first]:
        last += 1
    return (first + last) / 2 / BINS


def _features(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, len(FEATURES))


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def fit(stats: DataFrame, labels: DataFrame, sample: int = 10_000, good_weight: float = 20.0, **forest) -> Model | None:
    """The forest and its threshold.

    `sample` bounds the good rows that ranges and trees are drawn from (those with the lowest hashes of their ids); counts
    for the threshold cover all labelled rows that the base rules pass. Losing a share of the good rows weighs
    `good_weight` times as much as missing the same share of the bad. Documents labelled both ways count as bad. None
    without labelled good rows.
    """
    quality = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    rows = stats.where(f"NOT ({BASE_FAILED})").select("doc_id", "features").join(quality, "doc_id")
    picked = (rows.where("quality > 0").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample)
              .select("features").toArrow())
    if not picked.num_rows:
        return None
    model = model_of(_features(picked.column(0)), **forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.ceil(model.score(_features(batch.column(1))) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at)], ["good", "bin"])

    counted = (rows.select((F.col("quality") > 0).alias("good"), "features").mapInArrow(score, "good boolean, bin int")
               .groupBy("good", "bin").count().collect())  # at most 2 * (BINS + 1) rows
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for row in counted:
        (good if row["good"] else bad)[row["bin"]] += row["count"]
    model.threshold = cut_of(good, bad, good_weight)
    return model


def _judged(docs: DataFrame, labels: DataFrame, **settings) -> tuple[DataFrame, Model | None]:
    stats = staged(measured(docs), "statistics")
    return stats, fit(stats, labels, **settings)


def _keeps(model: Model | None, features: np.ndarray):
    import pandas as pd

    return pd.Series(np.ones(len(features), bool) if model is None else model.keeps(features))


def judge(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, the counts, base_failed, kept for each row of `docs`.

    NULL and empty texts have no words and fail; repeated rows and NULL ids give a row each; an empty table gives no
    rows; without labels only the base rules reject. Other columns are ignored. `settings` are those of `fit`.
    """
    stats, model = _judged(docs, labels, **settings)

    @F.pandas_udf("boolean")
    def keeps(features):
        return _keeps(model, _features(pa.array(features, pa.binary())))

    return stats.withColumn("base_failed", F.expr(BASE_FAILED)).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & keeps("features")).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns; see `judge`."""
    _, model = _judged(docs, labels, **settings)

    @F.pandas_udf("boolean")
    def keeps(texts):
        found = [statistics((t or "").encode()) for t in texts]
        counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
        base = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
        return _keeps(model, np.array([f for _, f in found]).reshape(-1, len(FEATURES))) & ~base

    return docs.where(keeps("text"))


def op9_isolation_forest(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

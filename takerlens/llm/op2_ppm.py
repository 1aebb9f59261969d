"""Prediction by partial matching over byte contexts.

A text is read as its tokens, lower-cased, with a space between and an end mark; each byte is coded in the context of the
bytes before it. The trie of contexts is a table per order, keyed by the bytes themselves. A byte unseen in a context
escapes to the next shorter one (method D: half a count goes to the escape for each symbol seen), where the symbols of the
longer context are excluded. Shorter contexts count the longer ones a byte was new in.

The probability of a byte depends on its context and itself alone, so it is worked out once per distinct gram. Blocks of
documents send their distinct grams and tokens, get back logarithms and counts, and sum them per document.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.blocks import TOTALS, Vocabulary, answered, by_block, cut, id_type, opened, payloads
from takerlens.llm.staging import documents, staged

ORDER = 5
END = b"\n"
SYMBOLS = 256
BLOCK_BYTES = 14 << 20  # a block comes back with its grams, which are as many again as its tokens
_PART = 1 << 18
SCORED = "n_tokens long, n_known long, logs double, score double"


def held_out(doc_id) -> bool:
    """NULL ids are held out too: nothing is learned from them."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def stream(text: bytes) -> bytes:
    """Lower-cased tokens, each with a space or, the last, the end mark after it."""
    return b" ".join(text.lower().split()) + END


def grams(coded: bytes, order: int) -> np.ndarray:
    """For each byte the number that it and the `order` bytes before it spell; end marks stand before the text."""
    data = np.frombuffer(END * order + coded, np.uint8)
    n = len(coded)
    out = np.zeros(n, np.int64)
    for k in range(order + 1):
        out <<= 8
        out |= data[k:k + n]
    return out


def _texts(ids: pa.Array, texts: list[bytes]) -> tuple[pa.Table, None, None]:
    return pa.table({"doc_id": ids, "coded": pa.array([stream(t) for t in texts], pa.binary())}), None, None


def _tokens(ids: pa.Array, texts: list[bytes]) -> tuple[pa.Table, list[bytes], list[int]]:
    """Distinct tokens in order of first use, with their counts in training texts."""
    learned: Counter = Counter()
    for doc_id, text in zip(ids.to_pylist(), texts):
        words = [*text.lower().split(), END]
        if held_out(doc_id):
            for word in words:
                learned.setdefault(word, 0)
        else:
            learned.update(words)
    return pa.table({"doc_id": ids}), list(learned), list(learned.values())


def counted_grams(ids: pa.Array, texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct grams of a block in rising order with their counts in training texts, some at a time.

    A block takes eight bytes a byte of text: its grams are sorted in place and counted part by part.
    """
    coded = [stream(text) for text in texts]
    found = np.empty(sum(map(len, coded)), np.int64)
    end = 0
    for doc_id, text in zip(ids.to_pylist(), coded):
        # The lowest bit of the number tells training from held-out.
        found[end:end + len(text)] = grams(text, order) * 2 + (not held_out(doc_id))
        end += len(text)
    found.sort()
    lo = 0
    while lo < end:
        hi = int(np.searchsorted(found, found[min(lo + _PART, end) - 1] | 1, "right"))  # where a gram ends
        gram = found[lo:hi] >> 1
        first = np.flatnonzero(np.diff(gram, prepend=-1))
        yield gram[first], np.add.reduceat(found[lo:hi] & 1, first)
        lo = hi


def _grams(docs: DataFrame, order: int) -> DataFrame:
    """block, gram, weight: a block's distinct grams with their counts in training texts."""

    def each(number: int, ids: pa.Array, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for gram, weight in counted_grams(ids, texts, order):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), number, np.int64)), pa.array(gram), pa.array(weight)],
                                             names=["block", "gram", "weight"])

    return by_block(docs, each, "block long, gram long, weight long", BLOCK_BYTES)


def trie(counts: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per order 0 .. `order` its grams (gram, c) and its contexts (context, n, q, n_below, q_below).

    n and q are the count and the number of symbols of a context; n_below and q_below those left in the next shorter
    context once its symbols are excluded. `counts` has (gram, c) of the longest order.
    """
    by_order = [counts.select("gram", F.col("c").cast("double"))]
    for k in range(order - 1, -1, -1):
        by_order.insert(0, staged(by_order[0].groupBy(_suffix("gram", k + 1).alias("gram")).agg(
            F.count("*").cast("double").alias("c")), f"grams{k}"))
    contexts: list[DataFrame] = []
    for k, rows in enumerate(by_order):
        if k == 0:
            found = rows.agg(F.sum("c").alias("n"), F.count("*").cast("double").alias("q")).select(
                F.lit(0).cast("long").alias("context"), "n", "q", F.lit(0.0).alias("n_below"), F.lit(0.0).alias("q_below"))
        else:
            below = by_order[k - 1].select(F.col("gram").alias("short"), F.col("c").alias("low"))
            found = (rows.withColumn("short", _suffix("gram", k)).join(below, "short")
                     .groupBy(F.shiftright("gram", 8).alias("context"))
                     .agg(F.sum("c").alias("n"), F.count("*").cast("double").alias("q"), F.sum("low").alias("low"))
                     .withColumn("short", _suffix("context", k - 1)))
            found = found.join(contexts[k - 1].select(F.col("context").alias("short"), F.col("n").alias("n_all"),
                                                      F.col("q").alias("q_all")), "short").select(
                "context", "n", "q", (F.col("n_all") - F.col("low")).alias("n_below"),
                (F.col("q_all") - F.col("q")).alias("q_below"))
        contexts.append(staged(found, f"contexts{k}"))
    return by_order, contexts


def _suffix(name: str, n_bytes: int):
    return F.col(name).bitwiseAND(F.lit((1 << 8 * n_bytes) - 1))


def logarithms(asked: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """gram, logp (base 10) for each distinct gram of `asked`; training `counts` are (gram, c), all above 0."""
    by_order, contexts = trie(counts, order)
    # State of a gram: logp so far, and the count and symbols left in the next context after exclusion (NULL: none yet).
    pending = asked.select("gram", F.lit(0.0).alias("logp"), *(F.lit(None).cast("double").alias(x) for x in ("left_n", "left_q")))
    done = None
    for k in range(order, -1, -1):
        keyed = pending.withColumn("at", _suffix("gram", k + 1)).withColumn("context", F.shiftright(_suffix("gram", k + 1), 8))
        met = keyed.join(by_order[k].withColumnRenamed("gram", "at"), "at", "left").join(contexts[k], "context", "left")
        n, q = F.coalesce("left_n", "n"), F.coalesce("left_q", "q")
        met = staged(met.select(
            "gram", F.col("c").isNotNull().alias("found"),
            F.when(F.col("c").isNotNull(), F.col("logp") + F.log10((2 * F.col("c") - 1) / (2 * n)))
            .when(F.col("n").isNotNull() & (n > 0), F.col("logp") + F.log10(q / (2 * n)))
            .otherwise(F.col("logp")).alias("logp"),
            F.when(F.col("n").isNotNull(), F.col("n_below")).alias("left_n"),
            F.when(F.col("n").isNotNull(), F.col("q_below")).alias("left_q")), f"met{k}")
        part = met.where("found").select("gram", "logp")
        done = part if done is None else done.unionByName(part)
        pending = met.where("NOT found").drop("found")
    symbols = by_order[0].count()  # at most 256
    return done.unionByName(pending.select("gram", (F.col("logp") - math.log10(max(SYMBOLS - symbols, 1))).alias("logp")))


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of `docs` (doc_id, text).

    Both models learn from the whole texts of documents that are not held out. NULL and empty texts are an end mark alone;
    repeated rows count each time; NULL ids are held out; without training texts every byte is one of 256. `docs` must
    be a stored table; other columns are ignored.
    """
    tokens = staged(answered(cut(docs, _tokens, BLOCK_BYTES, payloads=False), lambda chunks, weights: (weights, None), totals=True), "tokens")
    distinct = train = 0
    for row in tokens.where(F.col("block") == TOTALS).select("size").toLocalIterator():
        part = np.frombuffer(row[0], np.int64)
        distinct, train = distinct + int(part[0]), train + int(part[1])
    found = staged(_grams(docs, order), "grams")
    totals = staged(found.groupBy("gram").agg(F.sum("weight").alias("c")), "totals")
    known = logarithms(totals.select("gram"), totals.where("c > 0"), order)

    def finish(table: pa.Table, logs: pa.Table) -> pa.Table:
        data, counts, _ = opened(table)
        return _summed(data, counts, logs, order)

    logs = found.select("block", "gram").join(known, "gram").select("block", "gram", "logp")
    rows = tokens.where(F.col("block") != TOTALS).unionByName(payloads(docs, _texts, BLOCK_BYTES))
    scored = rows.groupBy("block").cogroup(logs.groupBy("block")).applyInArrow(
        finish, f"doc_id {id_type(docs)}, held_out boolean, {SCORED}")
    each = math.log10(train + 0.1 * (distinct + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * each).alias("base_score"), "score")


def _summed(data: pa.Table, counts: np.ndarray, logs: pa.Table, order: int) -> pa.Table:
    at = np.argsort(logs.column("gram").to_numpy())
    gram, logp = logs.column("gram").to_numpy()[at], logs.column("logp").to_numpy()[at]
    weight = np.log10(counts + 0.1)
    tokens = Vocabulary()
    n_tokens, n_known, base, total = [], [], [], []
    for coded in data.column("coded"):
        coded = coded.as_py()
        index = tokens.indices([*coded.split(), END])
        n_tokens.append(len(index))
        n_known.append(int((counts[index] > 0).sum()))
        base.append(float(weight[index].sum()))
        # Sorted, so that the search stays within a cache line or two of the last place.
        total.append(float(logp[np.searchsorted(gram, np.sort(grams(coded, order)))].sum()))
    if len(tokens) != len(counts):
        raise ValueError("the documents were split in another way when they were read again")
    ids = data.column("doc_id")
    return pa.table({"doc_id": ids, "held_out": pa.array([held_out(i) for i in ids.to_pylist()], pa.bool_()),
                     "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
                     "logs": pa.array(base, pa.float64()), "score": pa.array(total, pa.float64())})


def op2_prediction_by_partial_matching(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))

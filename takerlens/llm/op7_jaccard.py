"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with equal shingle sets are one text. Texts whose MinHash values agree on a band meet in a bucket together with
their size class (a pair over the threshold differs by at most one class). A pair's values are compared a few at a time and
the pair is dropped as soon as the posterior probability of reaching the threshold is below the tolerance; what is left is
verified on the whole sets.

In a bucket texts gather around pivots: what is near a pivot needs no pivot of its own, since by the triangle inequality
of Jaccard distance whatever is similar to it is still within reach of that pivot. So a group of copies costs one pass and
not all pairs, and sends on one row a text. The pivots' stars are joined to components, in which every surviving pair is
verified; components over `BLOCK` texts are dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takerlens.llm.blocks import Vocabulary, id_type
from takerlens.llm.components import components
from takerlens.llm.staging import documents, staged

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5
STEP = 25
TOLERANCE = 1e-6
BLOCK = 2048
ROW = "struct<file:string,at:bigint>"
_RANDOM = np.random.default_rng(1)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_MIX = [np.uint64(x) for x in _RANDOM.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of `words` words; of a shorter text the hash of all its words."""
    import xxhash

    found = Vocabulary()
    split = text.split()
    index = found.indices(split)
    if not len(index):
        return np.empty(0, np.uint64)
    if len(index) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(split))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))[index]
    n = len(index) - words + 1
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total = (total ^ hashes[k:k + n]) * _MIX[k]
        total ^= total >> np.uint64(29)
    return np.unique(total)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values; all ones for an empty set."""
    out = np.full(len(_FACTORS), np.iinfo(np.uint32).max, np.uint32)
    for lo in range(0, len(found), 2048):
        values = (found[lo:lo + 2048, None] * _FACTORS + _SHIFTS) >> np.uint64(32)
        np.minimum(out, values.min(0).astype(np.uint32), out=out)
    return out


def least_matches(threshold: float, tolerance: float = TOLERANCE, values: int = BANDS * ROWS) -> np.ndarray:
    """For each number n of compared values the fewest matches at which P(similarity >= threshold) >= tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose tail is P(Binomial(n + 1, threshold) <= m).
    """
    out = np.zeros(values + 1, np.int64)
    for n in range(1, values + 1):
        m, tail = -1, 0.0
        while tail < tolerance and m < n:
            m += 1
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def survivors(one: np.ndarray, others: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `others` that the posterior does not rule out against `one`, and how many values of each match."""
    alive, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for lo in range(0, others.shape[1], STEP):
        hi = min(lo + STEP, others.shape[1])
        matches = matches + (others[alive, lo:hi] == one[lo:hi]).sum(1)
        stay = matches >= least[hi]
        alive, matches = alive[stay], matches[stay]
        if not len(alive):
            break
    return alive, matches


def sketched(docs: DataFrame) -> DataFrame:
    """row, doc_id, set (digest of the shingle set), n, values (MinHash) for each row of `docs`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sets = [shingles(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int32()), pa.array([signature(s).tobytes() for s in sets], pa.binary())],
                ["row", "doc_id", "set", "n", "values"])

    return numbered(docs).mapInArrow(rows, f"row {ROW}, doc_id {id_type(docs)}, set binary, n int, values binary")


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(place(docs).alias("row"), "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def place(docs: DataFrame) -> Column:
    """Where a row of a stored table lies: the same in every scan, however the scan is split."""
    known = docs.metadataColumn("_metadata")
    return F.struct(known["file_path"].alias("file"), known["row_index"].alias("at"))


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / -math.log(THRESHOLD) + 1e-9).astype(np.int64)


def buckets(texts: DataFrame) -> DataFrame:
    """bucket, set: a text is in its own size class and in the next one, for each band."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            own = size_class(batch.column(1).to_numpy()).tolist()
            keys, at = [], []
            for i, values in enumerate(batch.column(2).to_pylist()):
                width = 4 * ROWS
                for band in range(BANDS):
                    part = values[band * width:(band + 1) * width]
                    for kind in (own[i], own[i] + 1):
                        keys.append(xxhash.xxh3_64_intdigest(part, seed=band * 1000 + kind) - (1 << 63))
                        at.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).take(pa.array(at))],
                                             ["bucket", "set"])

    return texts.where("n > 0").select("set", "n", "values").mapInArrow(rows, "bucket long, set binary")


class Groups:
    """Disjoint sets of 0 .. n - 1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self._parent = list(range(n))

    def root(self, i: int) -> int:
        while self._parent[i] != i:
            self._parent[i] = i = self._parent[self._parent[i]]
        return i

    def link(self, i: int, j: int) -> None:
        x, y = self.root(i), self.root(j)
        self._parent[max(x, y)] = min(x, y)


_REACH = least_matches(0.5, 1e-4)


def _gathered(table: pa.Table) -> pa.Table:
    """Stars (a, b) of a bucket: each text and the first of those that pivots join it to, so one row a text."""
    sets = table.column("set").to_pylist()
    values = np.frombuffer(b"".join(table.column("values").to_pylist()), np.uint32).reshape(len(sets), -1)
    left = np.array(sorted(range(len(sets)), key=sets.__getitem__))
    done = np.zeros(len(sets), bool)
    join = Groups(len(sets))
    for pivot in left.tolist():
        if done[pivot]:
            continue
        near, matches = survivors(values[pivot], values, _REACH)
        done[near[matches >= THRESHOLD * values.shape[1]]] = True
        done[pivot] = True
        for i in near.tolist():
            join.link(pivot, i)
    first = {}
    for i in left.tolist():
        first.setdefault(join.root(i), i)
    pairs = [(sets[i], sets[first[join.root(i)]]) for i in range(len(sets)) if first[join.root(i)] != i]
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.binary()), "b": pa.array([b for _, b in pairs], pa.binary())})


def linked(sets: list[np.ndarray], values: np.ndarray, least: np.ndarray, split: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) over the threshold: i before and j from `split` on, or i < j if split is 0."""
    n = np.array([len(s) for s in sets])
    pairs: list[tuple[int, np.ndarray]] = []
    for i in range(split or len(sets)):
        rest = np.arange(split or i + 1, len(sets))
        rest = rest[np.minimum(n[rest], n[i]) >= THRESHOLD * np.maximum(n[rest], n[i]) - 1e-9]
        if len(rest):
            alive, _ = survivors(values[i], values[rest], least)
            if len(alive):
                pairs.append((i, rest[alive]))
    if sum(len(p) for _, p in pairs) > 8 * len(sets):
        yield from _by_product(sets, n, pairs)
        return
    for i, others in pairs:
        for j in others.tolist():
            same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if same >= THRESHOLD * (n[i] + n[j] - same) - 1e-9:
                yield i, j


def _by_product(sets: list[np.ndarray], n: np.ndarray, pairs: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Many pairs among few texts: all intersections at once, as products of incidence matrices."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    _, which, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    _, column = np.unique(which[shared], return_inverse=True)
    owner = owner[shared]
    same = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, 2048):
        inside = (column >= lo) & (column < lo + 2048)
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[inside], column[inside] - lo] = 1
        same += part @ part.T
    for i, others in pairs:
        s = same[i, others]
        for j in others[s >= THRESHOLD * (n[i] + n[others] - s) - 1e-4].tolist():
            yield i, j


def _verified(table: pa.Table) -> pa.Table:
    """a, b, links: each text of a pair of blocks, the smallest text it is joined to, and how many it is linked to."""
    first = {}
    for key, half, text in zip(*(table.column(c).to_pylist() for c in ("set", "half", "text"))):
        first.setdefault(key, (half, text))
    order = sorted(first, key=lambda k: (first[k][0], k))
    sets = [shingles(first[k][1]) for k in order]
    values = np.array([signature(s) for s in sets])
    split = sum(first[k][0] == 0 for k in order)
    links = np.zeros(len(order), np.int64)
    join = Groups(len(order))
    if split:
        for i, j in linked(sets, values, least_matches(THRESHOLD), split if split < len(order) else 0):
            links[i] += 1
            links[j] += 1
            join.link(i, j)
    return pa.table({"a": pa.array(order, pa.binary()), "b": pa.array([order[join.root(i)] for i in range(len(order))], pa.binary()),
                     "links": pa.array(links)})


def join(docs: DataFrame) -> DataFrame:
    """row, doc_id, class, class_id, n_links, n_copies for each row of `docs` (doc_id, text).

    Words lie between ASCII white space; texts under five words have one shingle, and all rows without words are copies of
    each other. Documents are linked when their sets' similarity is 0.8 or more; `n_links` counts the other texts a
    document is linked to, `n_copies` the rows of its own text. A class is a component of links; its id is its smallest
    doc_id (NULL only if all are), `class` tells classes apart in any case. Repeated rows are copies; NULL ids take part; other columns are ignored; an empty table
    gives no rows. `docs` must be a Parquet table: `row` is the place of a row in it (file, row).
    """
    rows = staged(sketched(docs), "sketches")
    texts = staged(rows.groupBy("set").agg(F.first("n").alias("n"), F.first("values").alias("values"),
                                           F.min("row").alias("row"), F.min("doc_id").alias("low"),
                                           F.count("*").alias("n_copies")), "texts")
    placed = buckets(texts)
    full = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = placed.join(full, "bucket", "left_semi").join(texts.select("set", "values"), "set")
    stars = staged(members.groupBy("bucket").applyInArrow(_gathered, "a binary, b binary").distinct(), "stars")
    groups = staged(components(stars), "groups")
    verified = staged(_verify(docs, texts, groups), "verified")
    classes = components(verified.where("a <> b").select("a", "b"))
    named = (texts.select("set", "low", "n_copies").join(classes.withColumnRenamed("node", "set"), "set", "left")
             .withColumn("root", F.coalesce("root", "set")))
    class_id = named.groupBy("root").agg(F.min("low").alias("class_id"))
    links = verified.groupBy(F.col("a").alias("set")).agg(F.sum("links").alias("n_links"))
    of_text = named.join(class_id, "root").join(links, "set", "left").select(
        "set", F.col("root").alias("class"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    return rows.select("row", "doc_id", "set").join(of_text, "set").drop("set")


def _verify(docs: DataFrame, texts: DataFrame, groups: DataFrame) -> DataFrame:
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    parts = F.greatest(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = (groups.join(sizes, "root").withColumn("parts", parts).withColumn("own", own)
             .select(F.col("node").alias("set"), "root", "own", F.explode(F.expr("sequence(0, parts - 1)")).alias("with"))
             .select("set", "root", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
                     (F.col("own") > F.col("with")).cast("int").alias("half")))
    wanted = texts.select("set", "row").join(dealt, "set")
    whole = numbered(docs).select("row", "text").join(wanted, "row")
    return whole.groupBy("root", "i", "j").applyInArrow(_verified, "a binary, b binary, links long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links, n_copies; see `join`."""
    return join(docs).drop("row", "class")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with the smallest doc_id of their class, one a class, with all their columns; see `join`.

    A class whose ids are all NULL keeps its first row.
    """
    name = "row"
    while name in map(str.lower, docs.columns):
        name += "_"
    first = join(docs).groupBy("class").agg(
        F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias(name)).select(name)
    return docs.withColumn(name, place(docs)).join(first, name, "left_semi").select(*docs.columns)


def op7_bayesian_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))

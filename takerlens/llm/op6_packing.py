"""Sum-of-squares packing: a document goes where the squared counts of open sequences per residual gap become smallest.

Lengths come from distinct pre-tokens (`blocks`); a document's ids exist only in the task that finishes its block, which
keeps a checksum of each piece. Pieces are dealt at random to buckets of bounded size, packed bucket by bucket, longest
first. What a bucket leaves open is bounded by the capacity, not by the input, and is packed once more with the open
sequences of other buckets.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.blocks import answered, cut, finished, id_type, joined, numbers, ragged
from takerlens.llm.staging import documents, staged
from takerlens.llm.wordpieces import chunked, encoder, pretokens, public_path

CAPACITY = 4096
BUCKET = 40_000
_SLICE = 500_000


def _sequences(ids: pa.Array, texts: list[bytes]) -> tuple[pa.Table, list[str], None]:
    chunks, place, n_chunks = chunked(texts)
    words, pairs = pretokens(chunks)
    both = pairs[place]
    real = both >= 0
    through = np.concatenate([[0], np.cumsum(real.sum(axis=1))])[np.cumsum(n_chunks)]
    return pa.table({"doc_id": ids, **numbers(np.split(both[real], through[:-1]))}), words, None


def _parts(n_words: np.ndarray) -> list[int]:
    """Where to cut a block's documents so that a part has `_SLICE` words or a document."""
    through = np.cumsum(n_words, dtype=np.int64)
    ends, at = [], 0
    while at < len(n_words):
        at = max(at + 1, int(np.searchsorted(through, (through[at - 1] if at else 0) + _SLICE, "right")))
        ends.append(at)
    return ends


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids with `end_id` after them, cut at `capacity`."""

    def cut_up(data: pa.Table, lengths: np.ndarray, flat: np.ndarray) -> pa.Table:
        starts = np.cumsum(lengths) - lengths
        words, n_words = joined(data)
        before = np.concatenate([[0], np.cumsum(n_words, dtype=np.int64)])
        ids_of = np.concatenate([[0], np.cumsum(lengths[words], dtype=np.int64)])
        n_ids = ids_of[before[1:]] - ids_of[before[:-1]] + 1  # with the end
        count = -(-n_ids // capacity)
        doc = np.repeat(np.arange(len(n_ids)), count)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = piece * capacity
        length = np.minimum(n_ids[doc] - start, capacity)
        crc: list[int] = []
        first = 0
        for last in _parts(n_words):
            own = words[before[first]:before[last]]
            ids = np.full(int(n_ids[first:last].sum()), end_id, "<u4")
            ids[np.arange(len(ids) - (last - first)) + np.repeat(np.arange(last - first), n_ids[first:last] - 1)] = ragged(
                flat, starts, lengths, own)
            inside = slice(*np.searchsorted(doc, [first, last]).tolist())
            at = (start + (np.cumsum(n_ids) - n_ids - n_ids[:first].sum())[doc])[inside]
            view = memoryview(ids).cast("B")
            crc += [zlib.crc32(view[4 * lo:4 * (lo + n)]) for lo, n in zip(at.tolist(), length[inside].tolist())]
            first = last
        return pa.table({"doc_id": data.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
                         "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64())})

    rows = answered(cut(docs, _sequences), encoder(path or public_path("word_bpe_49k.json"), count_only=False))
    return finished(rows, cut_up, f"doc_id {id_type(docs)}, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed in the order given.

    With open[g] sequences of fill g, moving one from fill g to g + s changes the sum of squares by
    2 * (open[g + s] - open[g] + 1), filling one up by 1 - 2 * open[g], and opening one by 2 * open[s] + 1.
    """
    counts = np.zeros(capacity + 1, np.int64)
    at: dict[int, list[int]] = defaultdict(list)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i, s in enumerate(lengths.tolist()):
        fill = 0
        if s < capacity:
            change = 2 * (counts[s + 1:] - counts[1:capacity - s + 1] + 1)  # for fills 1 .. capacity - s
            change[-1] = 1 - 2 * counts[capacity - s]
            change[counts[1:capacity - s + 1] == 0] = np.iinfo(np.int64).max
            best = len(change) - 1 - int(change[::-1].argmin())  # of equals the fullest
            if change[best] < 2 * counts[s] + 1:
                fill = best + 1
        if fill:
            sequence[i] = at[fill].pop()
            counts[fill] -= 1
        else:
            sequence[i], used = used, used + 1
        offset[i] = fill
        if fill + s < capacity:
            at[fill + s].append(sequence[i])
            counts[fill + s] += 1
    return sequence, offset


def _packer(capacity: int):
    """Packs a bucket's units (`size` tokens) into sequences: adds `sequence`, `place` and the sequence's `fill`."""

    def pack_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy()
        order = np.lexsort((table.column("unit").to_numpy(), -size))
        sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        sequence[order], offset[order] = sum_of_squares(size[order], capacity)
        fill = np.bincount(sequence, size, minlength=1).astype(np.int64)[sequence]
        return pa.table({"unit": table.column("unit"), "sequence": pa.array((key[0].as_py() << 32) + sequence),
                         "place": pa.array(offset), "fill": pa.array(fill)})

    return pack_bucket, "unit long, sequence long, place long, fill long"


def pack(rows: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """Adds sequence_id and offset to `rows` (length and any columns but `unit`).

    Lengths are from 1 to `capacity`. The sequences that the first round leaves under nine tenths full are packed again
    as units, so that an open remainder exists once for all buckets and not in each. Equal lengths are placed in row
    order. Rows are stored with their number first.
    """
    numbered = staged(rows.withColumn("unit", F.monotonically_increasing_id()), "pieces")
    units = numbered.count()
    narrow = numbered.select("unit", F.col("length").alias("size"))
    first = staged(_round(narrow, max(1, -(-units // bucket)), capacity), "packed")
    loose = (first.where(F.col("fill") < capacity * 9 // 10).groupBy("sequence").agg(F.first("fill").alias("size"))
             .withColumnRenamed("sequence", "unit"))
    again = _round(loose, max(1, -(-units // (bucket * 20))), capacity).select(
        F.col("unit").alias("sequence"), (-1 - F.col("sequence")).alias("joined"), F.col("place").alias("shift"))
    placed = first.join(again, "sequence", "left").select(
        "unit", F.coalesce("joined", "sequence").alias("sequence_id"),
        (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"))
    return numbered.join(placed, "unit").drop("unit")


def _round(units: DataFrame, buckets: int, capacity: int) -> DataFrame:
    pack_bucket, schema = _packer(capacity)
    dealt = units.withColumn("bucket", F.pmod(F.xxhash64("unit"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(pack_bucket, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row of `docs`.

    NULL and empty texts are a piece of the end id alone; repeated rows and NULL ids are packed row by row; an empty
    table gives no rows; other columns are ignored. Only documents over `capacity` are cut.
    """
    return pack(pieces(docs, path, capacity), capacity)


def op6_sum_of_squares_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))

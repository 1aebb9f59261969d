"""Blocks of documents with a vocabulary each.

What depends only on a distinct value (a word's token ids, its count in the corpus) is worked out once per distinct
value, not once per use. Documents are cut into blocks of bounded size as they are scanned. A block yields

* one payload: its documents with values replaced by indices into the block's vocabulary, compressed,
* one row per distinct value.

Distinct values of all blocks meet in one shuffle, where a value has at most one row a block, so no value is hot. The
answers go back to the blocks by number, and each block is finished on its own. Texts are never shuffled.

A block is named by the scan partition and place of its first row, so the documents must come in the same order when a
lost task is run again: from a stored table, not from a shuffle. Where a table is scanned twice, both scans must be split
alike: `steady_splits` sees to it, and a block whose two halves differ is an error, never a loss.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 24 << 20
PAYLOAD = TOTALS = -1
CUT = "block long, idx int, chunk binary, weight long"
_CUT = pa.schema([("block", pa.int64()), ("idx", pa.int32()), ("chunk", pa.binary()), ("weight", pa.int64())])
ANSWERED = "block long, payload binary, idx binary, size binary, flat binary"
_ANSWERED = pa.schema([("block", pa.int64()), *((x, pa.binary()) for x in ("payload", "idx", "size", "flat"))])
_ROWS = 100_000
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library


def released() -> None:
    """Gives back to the system what a block no longer needs: workers stay for the next stage, and would hold it meanwhile."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


class Vocabulary(dict):
    """Numbers each distinct key in order of first use."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n

    def indices(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int32, len(keys))


def steady_splits(spark: SparkSession) -> None:
    """Fix how many tasks a scan aims at, if the session leaves it open.

    Otherwise Spark goes by the cores it has when it plans a scan, so an executor lost or gained between two scans of a
    table would split its files in another way.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def id_type(docs: DataFrame) -> str:
    return docs.select("doc_id").schema[0].dataType.simpleString()


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """`doc_id` and the text in UTF-8; NULL texts become empty. Other columns are not read."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def by_block(docs: DataFrame, each: Callable, schema: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The record batches that `each(number, ids, texts)` yields for every block of documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, number = [], [], 0, 0
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                number = number if ids else row
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= block_bytes:
                    yield from each(number, pa.array(ids, kind), texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from each(number, pa.array(ids, kind), texts)
        ids, texts = [], []
        released()

    steady_splits(docs.sparkSession)
    return id_and_bytes(docs).withColumn("row", F.monotonically_increasing_id()).mapInArrow(rows, schema)


def cut(docs: DataFrame, read: Callable, block_bytes: int = BLOCK_BYTES, payloads: bool = True,
        vocabularies: bool = True) -> DataFrame:
    """Rows of `CUT`: for each block its payload (idx -1) and its vocabulary, or only one of the two.

    `read(ids, texts)` gets a block's ids (Arrow array) and texts (bytes) and returns (payload table, chunks, weights);
    chunks are bytes or text in index order (None where only payloads are asked for and `finish` itself checks them),
    weights a list of numbers or None.
    """

    def block(number: int, ids: pa.Array, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        data, chunks, weights = read(ids, texts)
        if chunks is not None:
            data = data.replace_schema_metadata({"chunks": str(len(chunks))})
        if payloads:
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([PAYLOAD], pa.int32()), pa.array([packed(data)], pa.binary()),
                 pa.nulls(1, pa.int64())], schema=_CUT)
        for lo in range(0, len(chunks) if vocabularies else 0, _ROWS):
            part = chunks[lo:lo + _ROWS]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(part), number)), pa.array(np.arange(lo, lo + len(part), dtype=np.int32)),
                pa.array(part, pa.binary()),
                pa.nulls(len(part), pa.int64()) if weights is None else pa.array(weights[lo:lo + _ROWS], pa.int64())],
                schema=_CUT)

    return by_block(docs, block, CUT, block_bytes)


def answered_apart(docs: DataFrame, read: Callable, answer: Callable, read_chunks: Callable | None = None) -> DataFrame:
    """`answered` for large payloads: they skip the shuffle by chunk, at the price of a second scan.

    `read_chunks` gives the same chunks as `read` with less work; its table is not used.
    """
    return answered(cut(docs, read_chunks or read, payloads=False), answer).unionByName(payloads(docs, read))


def payloads(docs: DataFrame, read: Callable, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The payloads alone, as rows of `ANSWERED`."""
    return cut(docs, read, block_bytes, vocabularies=False).select(
        "block", F.col("chunk").alias("payload"), *(F.lit(None).cast("binary").alias(x) for x in ("idx", "size", "flat")))


def answered(rows: DataFrame, answer: Callable, totals: bool = False) -> DataFrame:
    """Rows of `ANSWERED` for `cut` rows: payloads as they are, and each block's values for its vocabulary.

    With `totals`, rows of block -1 have as size the number of chunks with a weight and the sum of weights of a part.

    `answer(chunks, weights)` gets distinct chunks with their weights summed over all blocks, each chunk once in all, and
    returns a size per chunk and the values (as many as the sizes say, or none where the size is all there is).
    """

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) >= 4 * _ROWS:
                done, left = _whole_runs(pa.Table.from_batches(waiting))
                yield from ask(done)
                waiting = left.to_batches()
                del done, left
        if waiting:
            yield from ask(pa.Table.from_batches(waiting))
        waiting = []
        released()

    def ask(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        idx = table.column("idx").to_numpy()
        for row in np.flatnonzero(idx == PAYLOAD).tolist():
            yield pa.RecordBatch.from_arrays([table.column("block")[row:row + 1].combine_chunks(),
                                              table.column("chunk")[row:row + 1].combine_chunks(),
                                              *[pa.nulls(1, pa.binary())] * 3], schema=_ANSWERED)
        words = table.filter(pa.array(idx != PAYLOAD))
        if not words.num_rows:
            return
        chunks = words.column("chunk")
        new = pc.not_equal(chunks.slice(1), chunks.slice(0, len(chunks) - 1)).to_numpy()
        first = np.concatenate([[0], np.flatnonzero(new) + 1])
        weights = np.add.reduceat(words.column("weight").fill_null(0).to_numpy(), first)
        size, flat = answer(chunks.take(pa.array(first)).to_pylist(), weights)
        if totals:
            summed = np.array([(weights > 0).sum(), weights.sum()], np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([TOTALS]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                              pa.array([summed], pa.binary()), pa.nulls(1, pa.binary())], schema=_ANSWERED)
        of = np.concatenate([[0], np.cumsum(new)])
        yield from _by_block(words.column("block").to_numpy(), words.column("idx").to_numpy(), of, size, flat)

    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(lookup, ANSWERED)


def _whole_runs(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Cut where the last chunk's rows begin: more of them may follow."""
    chunk = table.column("chunk")
    last, n = chunk[-1], table.num_rows
    while n and chunk[n - 1] == last:
        n -= 1
    return table.slice(0, n), table.slice(n)


def _by_block(block: np.ndarray, idx: np.ndarray, of: np.ndarray, size: np.ndarray, flat: np.ndarray | None):
    order = np.lexsort((idx, block))  # steps between indices are small numbers
    bounds = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
    size = np.asarray(size, np.int64)
    starts = np.cumsum(size) - size
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        rows = order[lo:hi]
        values = np.empty(0, np.int32) if flat is None else ragged(flat, starts, size, of[rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[rows[:1]]), pa.nulls(1, pa.binary()),
             *(pa.array([shrunk(x)], pa.binary()) for x in (np.diff(idx[rows], prepend=0), size[of[rows]], values))],
            schema=_ANSWERED)


def shrunk(values: np.ndarray) -> bytes:
    """Integers byte by byte side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def grown(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view("<i8").ravel()


def finished(rows: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """`finish(documents of a block, sizes, flat values)` for each block of `answered` rows, both in index order."""

    def block(table: pa.Table) -> pa.Table:
        done = finish(*opened(table))
        released()
        return done

    return rows.groupBy("block").applyInArrow(block, schema)


def opened(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A block's documents, and the sizes and values of its vocabulary in index order."""
    data, idx, size, flat = None, [], [], []
    for payload, i, s, f in zip(*(table.column(x) for x in ("payload", "idx", "size", "flat"))):
        if payload.is_valid:
            data = unpacked(payload.as_buffer())
        elif i.is_valid:
            idx.append(np.cumsum(grown(i.as_py())))
            size.append(grown(s.as_py()))
            flat.append(grown(f.as_py()).astype(np.int32))
    if data is None or int((data.schema.metadata or {}).get(b"chunks", sum(map(len, idx)))) != sum(map(len, idx)):
        raise ValueError("the documents were split in another way when they were read again")
    if not idx:
        return data, np.empty(0, np.int64), np.empty(0, np.int32)
    size, flat = np.concatenate(size), np.concatenate(flat)
    order = np.argsort(np.concatenate(idx))
    if len(flat):
        flat = ragged(flat, np.cumsum(size) - size, size, order)
    return data, size[order], flat


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> np.ndarray:
    """flat[starts[i]:starts[i] + lengths[i]] for each i of `index`, end to end."""
    each = lengths[index]
    return flat[np.repeat(starts[index] - (np.cumsum(each) - each), each) + np.arange(each.sum())]


def numbers(arrays: list[np.ndarray]) -> dict[str, pa.Array]:
    """Columns for a list of integers per document, a list for each byte: like bytes side by side compress better."""
    flat = np.ascontiguousarray(np.concatenate([*arrays, np.empty(0, np.int32)]).astype("<i4")).view(np.uint8).reshape(-1, 4)
    ends = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return {f"byte{k}": pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(flat[:, k]))) for k in range(4)}


def joined(data: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The lists that `numbers` stored, end to end, and their lengths."""
    columns = [data.column(f"byte{k}").combine_chunks() for k in range(4)]
    return np.stack([c.flatten().to_numpy() for c in columns], axis=1).view("<i4").ravel(), columns[0].value_lengths().to_numpy()


def lists(data: pa.Table) -> Iterator[np.ndarray]:
    """The lists that `numbers` stored."""
    flat, lengths = joined(data)
    for end, n in zip(np.cumsum(lengths).tolist(), lengths.tolist()):
        yield flat[end - n:end]

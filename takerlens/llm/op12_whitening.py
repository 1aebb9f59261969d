"""Whitening of vectors by a polarised covariance.

The covariance of two dimensions follows from three variances: 2 cov(i, j) = var(i + j) - var(i) - var(j). So only squares
are added up: of each dimension and of each sum of two dimensions, over values centred before they are squared. All
of it is integer arithmetic, exact in any order, so a lost task that runs again changes nothing. What reaches the driver
is one number per pair of dimensions, never a vector; there the covariance is assembled for the eigensolver.

Four passes over the table: counts and sums, squares, the covariance of what is whitened, and the rows themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.llm.staging import with_package

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Beyond it 64 * c no longer is a double's exact integer.
LARGEST = 1 << 53
# A component with less than this share of the variance has none but for rounding.
FLAT = 1e-13
_SAFE = 1 << 62


@dataclass(frozen=True)
class Fit:
    """`n` vectors, their sums by dimension, and the unit eigenvectors (columns) of their covariance by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """Sums of what is left when `centre` is taken off: from 0 to n - 1."""
        return [s - self.n * (s // self.n) for s in self.sums]

    @property
    def explained(self) -> np.ndarray:
        total = float(np.trace(self.covariance))
        return np.maximum(self.values, 0) / total if total > 0 else np.zeros(len(self.values))

    def projection(self, components: int) -> np.ndarray:
        """Maps centred vectors to whitened ones; a component without variance maps to 0."""
        flat = self.explained <= FLAT
        scale = np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, self.values)))
        return (self.vectors * scale)[:, :components]


def whole_numbers(column: pa.Array, dimensions: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a usable vector, and floor(64 c) + 1000000 of their entries, row by row.

    Usable: not NULL, not empty, only finite entries; of `dimensions` entries where that is given.
    """
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    entries = flat.to_numpy(zero_copy_only=False)  # NULL entries are NaN here
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    ends = np.cumsum(lengths)
    good = (lengths > 0) & (broken[ends] == broken[ends - lengths])
    if dimensions is not None:
        good &= lengths == dimensions
    kept = np.floor(SCALE * entries[np.repeat(good, lengths)])
    if len(kept) and np.abs(kept).max() >= LARGEST:
        raise OverflowError(f"an entry beyond {LARGEST // SCALE} has no exact whole number")
    return good, kept.astype(np.int64) + SHIFT


def exact_sums(rows: np.ndarray) -> list[int]:
    """Column sums without overflow."""
    if not len(rows):
        return [0] * rows.shape[1]
    if int(np.abs(rows).max()) * len(rows) < _SAFE:
        return rows.sum(0).tolist()
    return rows.astype(object).sum(0).tolist()


def exact_squares(rows: np.ndarray) -> list[int]:
    """Column sums of squares without overflow."""
    most = int(np.abs(rows).max(initial=0))
    step = _SAFE // max(most * most, 1)
    if step < 1:
        return (rows.astype(object) ** 2).sum(0).tolist()
    out = [0] * rows.shape[1]
    for lo in range(0, len(rows), step):
        part = rows[lo:lo + step]
        out = [a + b for a, b in zip(out, np.einsum("ij,ij->j", part, part).tolist())]
    return out


def _scan(rows: DataFrame, vector: str, dimensions: int | None, each: Callable, done: Callable, schema: str) -> DataFrame:
    """`each(state, X)` for the usable vectors X of every batch; `done(state)` yields a task's rows at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {}
        for batch in batches:
            each(state, batch.column(0))
        yield from done(state)

    return rows.select(vector).mapInArrow(task, schema)


def sums(rows: DataFrame, vector: str) -> tuple[int, list[int]]:
    """n and the sums by dimension of the usable vectors; (0, []) if there is none.

    The vectors' dimension is the length that most of them have (of equally frequent ones the larger).
    """

    def each(state: dict, column: pa.Array) -> None:
        good, flat = whole_numbers(column, None)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[good]
        of = np.repeat(lengths, lengths)
        for d in np.unique(lengths).tolist():
            x = flat[of == d].reshape(-1, d)
            n, total = state.get(d, (0, [0] * d))
            state[d] = n + len(x), [a + b for a, b in zip(total, exact_sums(x))]

    def done(state: dict) -> Iterator[pa.RecordBatch]:
        for d, (n, total) in state.items():
            yield _batch(size=np.full(d, d), pos=np.arange(d), n=np.full(d, n), total=_decimals(total))

    parts = _scan(rows, vector, None, each, done, "size int, pos int, n long, total decimal(38,0)").groupBy("size", "pos").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    parts = parts.persist()
    try:
        most = parts.where("pos = 0").orderBy(F.desc("n"), F.desc("size")).first()
        if most is None:
            return 0, []
        found = parts.where(F.col("size") == most["size"]).select("pos", "total").collect()
        return most["n"], [int(r["total"]) for r in sorted(found, key=lambda r: r["pos"])]
    finally:
        parts.unpersist()


def squares(rows: DataFrame, vector: str, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """(i, i): the sum of u_i squared; (i, j) with i < j: of (u_i + u_j) squared, where u is a vector less `centre`."""
    d = len(centre)

    def each(state: dict, column: pa.Array) -> None:
        u = whole_numbers(column, d)[1].reshape(-1, d) - centre
        for i in range(d):
            pair = u[:, i:] + u[:, i:i + 1]
            pair[:, 0] = u[:, i]
            state[i] = [a + b for a, b in zip(state.get(i, [0] * (d - i)), exact_squares(pair))]

    def done(state: dict) -> Iterator[pa.RecordBatch]:
        for i, found in state.items():
            yield _batch(i=np.full(d - i, i), j=np.arange(i, d), q=_decimals(found))

    found = _scan(rows, vector, d, each, done, "i int, j int, q decimal(38,0)").groupBy("i", "j").agg(F.sum("q").alias("q"))
    return {(r["i"], r["j"]): int(r["q"]) for r in found.toLocalIterator()}


def polarised(n: int, rest: list[int], found: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance from variances: exact in n squared times its entries, rounded once."""
    d = len(rest)
    # n * sum(v^2) - sum(v)^2 is n times the sum of squares of v less its mean.
    own = [n * found[i, i] - rest[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n ** 2
        for j in range(i + 1, d):
            both = n * found[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n ** 2)
    return out


def fit(rows: DataFrame, vector: str = "embedding") -> Fit | None:
    """The fit over all usable vectors of `rows`, None without any."""
    n, total = sums(with_rows(rows), vector)
    if not n:
        return None
    start = Fit(n, total, *[np.empty(0)] * 3)
    covariance = polarised(n, start.rest, squares(rows, vector, start.centre))
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1].copy(), vectors[:, ::-1]
    largest = np.abs(vectors).argmax(0)  # either sign is right; this one is the same on each run
    return Fit(n, total, covariance, values, vectors * np.sign(vectors[largest, np.arange(len(values))]))


def _whitened(made: Fit, u: np.ndarray, components: int) -> np.ndarray:
    return (u - np.array([r / made.n for r in made.rest])) @ made.projection(components)


def deviations(made: Fit, u: np.ndarray) -> np.ndarray:
    """The sum over dimensions of (n x - S)^2 for each row of u = x - centre, exact; an error where it leaves 64 bits."""
    rest = np.array(made.rest, np.int64)
    most = int(np.abs(u).max(initial=0)) * made.n + made.n
    if most * most * u.shape[1] < _SAFE:
        y = made.n * u - rest
        return np.einsum("ij,ij->i", y, y)
    y = made.n * u.astype(object) - rest.astype(object)
    found = (y * y).sum(1)
    if len(found) and max(found) >= 1 << 63:
        raise OverflowError("a deviation leaves 64 bits")
    return found.astype(np.int64)


def identity_error(rows: DataFrame, made: Fit, vector: str, components: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, over components with variance."""
    d, live = len(made.sums), np.flatnonzero(made.explained[:components] > FLAT)
    if not len(live):
        return 0.0
    centre, k = made.centre, len(live)

    def each(state: dict, column: pa.Array) -> None:
        z = _whitened(made, whole_numbers(column, d)[1].reshape(-1, d) - centre, components)[:, live]
        state["sum"] = state.get("sum", 0) + z.sum(0)
        state["product"] = state.get("product", 0) + z.T @ z

    def done(state: dict) -> Iterator[pa.RecordBatch]:
        if state:
            both = np.vstack([state["product"], state["sum"]])
            yield _batch(i=np.repeat(np.arange(k + 1), k), j=np.tile(np.arange(k), k + 1), s=both.ravel())

    found = _scan(rows, vector, d, each, done, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    both = np.zeros((k + 1, k))
    for r in found:
        both[r["i"], r["j"]] = r["s"]
    mean = both[k] / made.n
    return float(np.abs(both[:k] / made.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per usable vector and component.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries are dropped, and so are those of another length
    than most. Repeated rows and ids count as often as they come; NULL ids stay; other columns are not read. A component
    without variance (fewer distinct vectors than dimensions) has whitened and explained 0 and takes no part in
    identity_error. A table without usable vectors gives no rows. Entries beyond 2^47 and deviations beyond 64 bits are
    errors.
    """
    kind = rows.select(key).schema[0].dataType.simpleString()
    schema = (f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    made = fit(rows, vector)
    if made is None:
        return rows.sparkSession.createDataFrame([], schema)
    d, centre = len(made.sums), made.centre
    components = min(components, d)
    error = identity_error(rows, made, vector, components)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, x = whole_numbers(batch.column(1), d)
            u = x.reshape(-1, d) - centre
            ids = batch.column(0).filter(pa.array(good))
            deviation, z = deviations(made, u), _whitened(made, u, components)
            of = np.repeat(np.arange(len(u)), components)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(of)), pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(u))),
                 pa.array(np.full(len(of), made.n)), pa.array(deviation[of]), pa.array(z.ravel()),
                 pa.array(np.tile(made.explained[:components], len(u))), pa.array(np.full(len(of), error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(key, vector).mapInArrow(task, schema)


def with_rows(rows: DataFrame) -> DataFrame:
    with_package(rows.sparkSession)
    return rows


def _decimals(values: list[int]) -> pa.Array:
    from decimal import Decimal

    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def _batch(**columns) -> pa.RecordBatch:
    kinds = {"size": pa.int32(), "pos": pa.int32(), "i": pa.int32(), "j": pa.int32()}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds.get(k)) for k, c in columns.items()],
                                      list(columns))


def op12_polarised_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(with_package(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))

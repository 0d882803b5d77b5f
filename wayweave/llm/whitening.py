"""Whitening of embeddings from a tall-and-skinny QR, without forming a covariance matrix.

Vectors become whole numbers on a grid, so their sums are exact. Each partition centres its rows
and keeps the R factor of its QR, batch by batch; R factors are stacked and factored again in a
tree of Spark rounds; the right singular vectors of the last R are the components, and its
singular values scale them. What leaves a task is one R of d x d numbers, whatever its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayweave.plans.workspace import Workspace, small_batches

#: Entries beyond this cannot be kept as exact whole numbers.
REACH = 2.0**44
#: Singular values below this share of the largest are rounding: no component.
NOTHING = 1e-10
PART = "part int, rows long, numbers array<double>"


@dataclass(frozen=True)
class Whitening:
    """Exact count and sums of the fit rows, unit components in rows, their deviations and shares."""

    rows: int
    sums: tuple[int, ...]
    axes: np.ndarray
    deviation: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None


def on_grid(vector: Column, steps: int = 64, shift: int = 1_000_000) -> Column:
    """floor(steps * c) + shift of each entry, as array<long>; null for vectors that cannot be used.

    Null vectors and those with null, NaN or infinite entries, or entries beyond 2**44, are null.
    """
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(REACH), F.lit(False)))
    return F.when(fine, F.transform(vector, lambda c: F.floor(c.cast("double") * steps).cast("long") + shift))


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): rows whose vector can be used, on the grid.

    Vectors of another length than most (ties: the longer) are left out as well, as are empty ones.
    """
    rows = table.select(F.col(id_col).alias("vec_id"), on_grid(F.col(vector_col)).alias("x")).filter("x IS NOT NULL AND size(x) > 0")
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (most.d if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fits(biggest: int, times: int) -> bool:
    return biggest * times < 2**62


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Count of the rows of (vec_id, x), and the sum of each entry of x."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                exact = x if _fits(int(np.abs(x).max()), len(x)) else x.astype(object)
                n, part = n + len(x), exact.sum(axis=0)
                sums = part.astype(object) if sums is None else sums + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([list(map(int, sums))], pa.list_(pa.decimal128(38, 0)))], ["n", "sums"])

    parts = rows.select("x").mapInArrow(partial, "n long, sums array<decimal(38,0)>")
    found = parts.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    return (int(found[0].n), [int(r.s) for r in found]) if found else (0, [])  # one row a dimension


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers where they fit, else Python's."""
    if _fits(int(np.abs(x).max(initial=0)), n) and all(abs(int(s)) < 2**62 for s in sums):
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(np.float64)


def _merged(parts: DataFrame, merge: Callable[[list[tuple[int, np.ndarray]]], tuple[int, np.ndarray]], ws: Workspace, name: str, fan: int) -> tuple[int, np.ndarray] | None:
    """The parts (PART) merged in a tree: ``fan`` neighbours a task, until one is left."""

    def join(table: pa.Table) -> pa.Table:
        pieces = sorted(table.to_pylist(), key=lambda r: r["part"])
        rows, numbers = merge([(r["rows"], np.array(r["numbers"])) for r in pieces])
        return pa.table({"part": pa.array([pieces[0]["part"] // fan], pa.int32()), "rows": [rows], "numbers": pa.array([numbers.ravel().tolist()], pa.list_(pa.float64()))})

    level = 0
    now = ws.save(parts, f"{name}{level}")
    last = now.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while True:
        level += 1
        now = ws.save(now.groupBy(F.floor(F.col("part") / fan).alias("to")).applyInArrow(join, PART), f"{name}{level}")
        ws.drop(f"{name}{level - 1}")
        last //= fan
        if not last:
            (only,) = now.collect()  # one row of d x d numbers
            ws.drop(f"{name}{level}")
            return only.rows, np.array(only.numbers)


def _by_partition(rows: DataFrame, fold: Callable[[Iterator[np.ndarray]], tuple[int, np.ndarray] | None]) -> DataFrame:
    """PART rows: what ``fold`` makes of the matrices of a partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = fold(_matrix(b.column(0)) for b in batches if b.num_rows)
        if found:
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([part, pa.array([found[0]]), pa.array([found[1].ravel().tolist()], pa.list_(pa.float64()))], ["part", "rows", "numbers"])

    return rows.select("x").mapInArrow(work, PART)


def r_factor(rows: DataFrame, n: int, sums: list[int], ws: Workspace, fan: int = 8) -> np.ndarray:
    """R of the QR of all centred rows, by partition and then in a tree."""
    total, d = np.array(sums, object), len(sums)

    def fold(blocks: Iterator[np.ndarray]) -> tuple[int, np.ndarray] | None:
        r, seen = np.zeros((0, d)), 0
        for x in blocks:
            seen += len(x)
            r = np.linalg.qr(np.vstack([r, _centred(x, n, total)]), mode="r")
        return (seen, r) if seen else None

    def merge(parts: list[tuple[int, np.ndarray]]) -> tuple[int, np.ndarray]:
        return sum(k for k, _ in parts), np.linalg.qr(np.vstack([p.reshape(-1, d) for _, p in parts]), mode="r")

    return _merged(_by_partition(rows, fold), merge, ws, "r", fan)[1].reshape(-1, d)


def fit_whitening(rows: DataFrame, components: int = 32) -> Whitening:
    """Fit on all rows of ``usable``; at most ``components`` components of falling deviation.

    A component's sign is that which makes its largest entry, the first of equals, positive.
    Directions without deviation are no components, so equal vectors, or none, give no component.
    """
    n, sums = exact_sums(rows)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    ws = Workspace(rows.sparkSession, "whitening")
    _, s, axes = np.linalg.svd(r_factor(rows, n, sums, ws), full_matrices=False)
    k = min(components, int((s > s.max(initial=0.0) * NOTHING).sum()))
    axes = axes[:k]
    if k:
        axes = axes * np.sign(np.take_along_axis(axes, np.abs(axes).argmax(axis=1)[:, None], axis=1))
    model = Whitening(n, tuple(sums), axes, s[:k] / np.sqrt(n), s[:k] ** 2 / max((s**2).sum(), 1e-300))
    error = float(np.abs(whitened_covariance(rows, model, ws) - np.eye(k)).max()) if k else None
    return Whitening(model.rows, model.sums, model.axes, model.deviation, model.explained, error)


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.rows, np.array(model.sums, object)) @ model.axes.T / model.deviation


def whitened_covariance(rows: DataFrame, model: Whitening, ws: Workspace, fan: int = 8) -> np.ndarray:
    """Covariance (divisor n) of the whitened rows, centred by their own mean.

    A part is its mean and its sum of centred products; parts are merged pair by pair with the
    products of their means' difference.
    """
    k = len(model.axes)

    def join(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
        n, gap = a[0] + b[0], b[1][0] - a[1][0]
        mean = a[1][0] + gap * (b[0] / n)
        return n, np.vstack([mean, a[1][1:] + b[1][1:] + np.outer(gap, gap) * (a[0] * b[0] / n)])

    def of(w: np.ndarray) -> tuple[int, np.ndarray]:
        mean = w.mean(axis=0)
        return len(w), np.vstack([mean, (w - mean).T @ (w - mean)])

    def fold(blocks: Iterator[np.ndarray]) -> tuple[int, np.ndarray] | None:
        now = None
        for x in blocks:
            here = of(_project(x, model))
            now = here if now is None else join(now, here)
        return now

    def merge(parts: list[tuple[int, np.ndarray]]) -> tuple[int, np.ndarray]:
        shaped = [(n, p.reshape(k + 1, k)) for n, p in parts]
        now = shaped[0]
        for other in shaped[1:]:
            now = join(now, other)
        return now

    n, numbers = _merged(_by_partition(rows, fold), merge, ws, "cov", fan)
    return numbers.reshape(k + 1, k)[1:] / n


def apply_whitening(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of rows of ``usable``, whitened being array<double>.

    deviation is the sum of (n * x - S)**2 over the entries, exact; null where it is no long.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    sums = np.array(model.sums, object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            dev = _deviations(x, model.rows, sums)
            big = max(abs(int(dev.max())), abs(int(dev.min())))
            if _fits(big * big, dev.shape[1]):
                square = pa.array((dev.astype(np.int64) ** 2).sum(axis=1))
            else:
                exact = (dev.astype(object) ** 2).sum(axis=1)
                square = pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())
            w = _project(x, model)
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            white = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), square, white], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(work, f"vec_id {kind}, deviation bigint, whitened array<double>")


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Components count from 1. Unusable vectors (see ``usable``) have no rows. Repeated rows and ids
    each count and each give their rows; a null id stays null. A table without usable vectors, or
    with equal ones only, gives no rows. Other columns are ignored. ``identity_error`` is one
    value: the largest absolute entry of the whitened rows' covariance minus the identity.
    """
    small_batches(table.sparkSession)
    rows = usable(table, id_col, vector_col)
    model = fit_whitening(rows, components)
    if not len(model.axes):
        empty = "CAST(NULL AS INT) component, CAST(0 AS BIGINT) n, CAST(0 AS BIGINT) deviation, 0D whitened, 0D explained, 0D identity_error"
        return rows.select("vec_id", *[F.expr(e) for e in empty.split(", ")]).filter("false")
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    told = apply_whitening(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return told.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.rows).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("i")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )

"""Embedding whitening: the leading principal components by block Jacobi-Davidson.

Vectors become integer x-vectors (``floor(scale * c) + shift``), so their sums
are exact, and so is the centred vector ``(n * x - sum) / n`` up to the one
division. The covariance is never formed: a product ``V * B`` with a few
columns B is one pass over the packed, centred vectors, each task summing
``Y' (Y B)`` over its rows.

Jacobi-Davidson: a subspace is grown; its Rayleigh-Ritz pairs approximate the
leading eigenpairs. Pairs whose residual has reached double precision are
locked. For all others the correction equation

    (I - Q Q') (V - theta I) (I - Q Q') t = -r,   Q: locked vectors and all pairs' own

is solved roughly by MINRES, all of them in step, so that one pass over the
data serves a step of every equation. The corrections, made orthogonal, extend
the subspace; it is restarted from its best pairs when it is too wide, and the
work ends when all wanted pairs are locked.

The driver holds matrices of the dimension (d x some hundred), never rows. The
packed vectors are written to the checkpoint folder once, so lost executors
read them again. Sums of tasks are added in two levels in a fixed order, so
reruns agree.

Defined cases: rows whose vector is null, or holds null or non-finite entries,
are dropped, and so are vectors of another length than the most frequent one
(the longer of equally frequent ones) and those with an entry that doesn't fit
an exact double after scaling (2^52). Repeated rows and null ids count as they
come. Components without variance (relative to the largest, 1e-13) can't be
whitened and are left out, so equal vectors, a single vector and an empty table
give no rows. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Steps of MINRES for each correction.
INNER_STEPS = 6
#: Pairs carried beyond the wanted ones, so that the last wanted ones converge.
GUARD = 4
#: Rows packed into one block.
BLOCK_ROWS = 4096
#: Least share of the largest variance that a component can have.
LEAST = 1e-13
#: Subspaces of tasks' sums that are added on the way to the driver.
FAN_IN = 64


@dataclass
class Fit:
    """What the fit yields; all of it is of the dimension's size."""
    n: int
    sums: np.ndarray          # exact sums of the x-vectors (Python ints)
    values: np.ndarray        # falling eigenvalues
    vectors: np.ndarray       # d x components
    trace: float
    passes: int               # products with the covariance that were made


def x_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
              shift: int = SHIFT) -> DataFrame:
    """``(vec_id, x)`` of the rows that can be used; x is an array of longs."""
    v = F.col("v")
    scaled = F.transform(v, lambda c: F.floor(c * scale))
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < float(1 << 52)))
    usable = (rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
              .filter(v.isNotNull() & F.coalesce(fits, F.lit(False)) & (F.size(v) > 0)))
    size = (usable.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.desc("d")).first())
    usable = usable.filter(F.size(v) == (size["d"] if size else 0))
    return usable.select("vec_id", F.transform(scaled, lambda c: c.cast("long") + shift).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The x-vectors of a batch, one in each row."""
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(xs: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                n += len(x)
                low, high = (x & 0xFFFFFF).sum(0), (x >> 24).sum(0)      # neither can overflow
                part = [int(a) + (int(b) << 24) for a, b in zip(low, high)]
                total = part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total)),
                                              pa.array([str(t) for t in total])], ["dim", "n", "s"])

    found = (xs.mapInArrow(run, "dim int, n long, s string").groupBy("dim")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    found = sorted((r["dim"], r["n"], int(r["s"])) for r in found)       # one row for each dimension
    return (found[0][1] if found else 0), [s for _, _, s in found]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: 64-bit integers where all fit, else Python's."""
    most = max([abs(int(x.min())), abs(int(x.max()))]) * n + max(map(abs, sums)) if x.size else 0
    if most < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _packed(xs: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Blocks of centred vectors: ``(y)``, the bytes of a matrix of doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column("x").slice(k, BLOCK_ROWS))
                y = (_deviations(x, n, sums) / n).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array([y.tobytes()], pa.binary())], ["y"])

    return cut(xs.mapInArrow(run, "y binary"))


class Covariance:
    """The covariance of the packed vectors, known by its products only."""

    def __init__(self, packed: DataFrame, n: int, d: int):
        self.packed, self.n, self.d, self.passes = packed, n, d, 0

    def _summed(self, of_block, columns: int, rows: int) -> np.ndarray:
        """The sum over all blocks of ``of_block(y)``, a rows x columns matrix:
        one for each task, then for each group of tasks, then on the driver."""
        d = self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            total, some = np.zeros((rows, columns)), False
            for batch in batches:
                for y in batch.column("y"):
                    total += of_block(np.frombuffer(y.as_buffer(), float).reshape(-1, d))
                    some = True
            if some:
                part = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                                 ["part", "total"])

        def add(group: pa.Table) -> pa.Table:
            group = group.sort_by("part")
            total = sum(np.frombuffer(t.as_buffer(), float) for t in group.column("total"))
            return pa.table({"part": group.column("part")[:1], "total": pa.array([total.tobytes()], pa.binary())})

        parts = self.packed.mapInArrow(run, "part int, total binary")
        grouped = (parts.groupBy(F.pmod(F.col("part"), F.lit(FAN_IN)).alias("g"))
                   .applyInArrow(add, "part int, total binary"))
        self.passes += 1
        found = sorted((r["part"], bytes(r["total"])) for r in grouped.collect())    # at most FAN_IN rows
        return sum((np.frombuffer(t, float).reshape(rows, columns) for _, t in found), np.zeros((rows, columns)))

    def times(self, b: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``b``, in one pass."""
        sent = self.packed.sparkSession.sparkContext.broadcast(b)
        try:
            return self._summed(lambda y: y.T @ (y @ sent.value), b.shape[1], self.d) / self.n
        finally:
            sent.destroy()

    def trace(self) -> float:
        return float(self._summed(lambda y: np.array([[np.square(y).sum()]]), 1, 1)[0, 0]) / self.n

    def of_whitened(self, w: np.ndarray) -> np.ndarray:
        """The covariance of the vectors projected on the columns of ``w``,
        from the projected vectors themselves."""
        sent = self.packed.sparkSession.sparkContext.broadcast(w)
        k = w.shape[1]
        try:
            sums = self._summed(lambda y: np.vstack([(z := y @ sent.value).T @ z, z.sum(0)]), k, k + 1) / self.n
        finally:
            sent.destroy()
        return sums[:k] - np.outer(sums[k], sums[k])


def _orthonormal(b: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Directions of ``b`` outside the space of ``against``, orthonormal; those
    that vanish are left out."""
    b = b / np.maximum(np.linalg.norm(b, axis=0), 1e-300)
    for _ in range(2):
        b = b - against @ (against.T @ b)
    u, s, _ = np.linalg.svd(b, full_matrices=False)
    u = u[:, s > 1e-10]
    for _ in range(2):          # once more, against what rounding left
        u = u - against @ (against.T @ u)
        u, _ = np.linalg.qr(u)
    return u


def _corrections(cov: Covariance, theta: np.ndarray, q: np.ndarray, r: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for the correction equations of all columns, in step: each step
    is one product with the covariance, for all of them. ``q``: the pairs that
    the corrections leave out; with all of them, equal eigenvalues of several
    pairs don't make the equations singular."""
    def project(t: np.ndarray) -> np.ndarray:
        for _ in range(2):
            t = t - q @ (q.T @ t)
        return t

    v = project(-r)
    beta = np.linalg.norm(v, axis=0)
    live = beta > 0
    v = v / np.where(live, beta, 1)
    old, eta, t = np.zeros_like(v), beta.copy(), np.zeros_like(v)
    w, w_old = np.zeros_like(v), np.zeros_like(v)
    c, c_old, s, s_old = (np.ones(len(beta)), np.ones(len(beta)), np.zeros(len(beta)), np.zeros(len(beta)))
    for step in range(steps):
        av = project(cov.times(v) - v * theta)
        alpha = (v * av).sum(0)
        new = av - v * alpha - old * (beta if step else 0)
        new = project(new)
        beta_new = np.linalg.norm(new, axis=0)
        # The new column of the tridiagonal matrix, turned by the last two rotations.
        rho0 = c * alpha - c_old * s * (beta if step else 0)
        rho1 = np.hypot(rho0, beta_new)
        rho2 = s * alpha + c_old * c * (beta if step else 0)
        rho3 = s_old * (beta if step else 0)
        live &= rho1 > 0
        safe = np.where(live, rho1, 1)
        w, w_old = np.where(live, (v - w_old * rho3 - w * rho2) / safe, 0), w
        c_old, s_old, c, s = c, s, np.where(live, rho0 / safe, 1), np.where(live, beta_new / safe, 0)
        t = t + w * np.where(live, c * eta, 0)
        eta = -s * eta
        live &= beta_new > 1e-14 * np.abs(theta)
        old, v, beta = v, np.where(live, new / np.where(beta_new > 0, beta_new, 1), 0), beta_new
        if not live.any():
            break
    return project(t)


def leading_pairs(cov: Covariance, k: int, trace: float, seed: int = 7, inner_steps: int = INNER_STEPS,
                  max_rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their vectors as columns."""
    d = cov.d
    k = min(k, d)
    block = min(d, k + GUARD)
    widest = min(d, 4 * block)
    rng = np.random.default_rng(seed)
    space = np.linalg.qr(rng.standard_normal((d, block)))[0]
    image = cov.times(space)
    for _ in range(max_rounds):
        h = space.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta)[:block]
        theta, s = theta[order], s[:, order]
        u, au = space @ s, image @ s
        r = au - u * theta
        # Double precision: what rounding leaves of a product of this size; the
        # asymmetry of h shows how much that is where many rows are added.
        tolerance = np.sqrt(d) * max(8 * np.finfo(float).eps * max(theta[0], trace / d), 2 * np.abs(h - h.T).max())
        settled = np.linalg.norm(r, axis=0) <= tolerance
        full = space.shape[1] == d     # nothing is left to search
        if settled[:k].all() or full:
            return theta[:k], u[:, :k]
        rest = ~settled                # all others are locked
        t = _corrections(cov, theta[rest], u, r[:, rest], inner_steps)
        if space.shape[1] + rest.sum() > widest and widest < d:
            space, image = u, au       # restart from the best pairs
        more = _orthonormal(t, space)
        if not more.shape[1]:
            return theta[:k], u[:, :k]
        more = more[:, :max(d - space.shape[1], 0)]
        space, image = np.hstack([space, more]), np.hstack([image, cov.times(more)])
    raise RuntimeError(f"not all residuals are below {tolerance:.3g} after {max_rounds} rounds")


def fit(xs: DataFrame, components: int = COMPONENTS, seed: int = 7) -> tuple[Fit, Covariance | None]:
    """The leading components of the x-vectors, and their covariance."""
    n, sums = _sums(xs)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0), None
    cov = Covariance(_packed(xs, n, sums), n, len(sums))
    trace = cov.trace()
    if trace <= 0:
        return Fit(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, cov.passes), cov
    values, vectors = leading_pairs(cov, components, trace, seed)
    kept = values > LEAST * values[0]
    return Fit(n, sums, values[kept], vectors[:, kept], trace, cov.passes), cov


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row for each usable row: ``vec_id``, ``n``, ``deviation`` (decimal),
    ``whitened`` (array of doubles, one for each component), ``explained`` (the
    same array for all rows) and ``identity_error``."""
    xs = cut(x_vectors(rows, vec_id, vector, scale, shift))
    found, cov = fit(xs, components)
    kind = xs.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>"
    if not len(found.values):
        return (xs.filter(F.lit(False)).select(
            "vec_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("decimal(38,0)").alias("deviation"),
            F.lit(None).cast("array<double>").alias("whitened"), F.lit(None).cast("array<double>").alias("explained"),
            F.lit(None).cast("double").alias("identity_error")))
    w = found.vectors / np.sqrt(found.values)
    error = float(np.abs(cov.of_whitened(w) - np.eye(len(found.values))).max())
    sent = xs.sparkSession.sparkContext.broadcast((w, found.n, found.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n, sums = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            dev = _deviations(_matrix(batch.column("x")), n, sums)
            z = (dev / n).astype(float) @ w
            if dev.dtype != object and float(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] < 2.0 ** 62:
                squares = pa.array((dev * dev).sum(1)).cast(pa.decimal128(38, 0))
            else:
                squares = pa.array([_decimal(s) for s in (dev.astype(object) ** 2).sum(1)], pa.decimal128(38, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()),
                                             pa.array(np.ascontiguousarray(z).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.full(len(z), n)), squares, lists],
                                             ["vec_id", "n", "deviation", "whitened"])

    share = F.array(*[F.lit(float(v / found.trace)) for v in found.values])
    return (xs.mapInArrow(run, schema).withColumn("explained", share)
            .withColumn("identity_error", F.lit(error)))


def _decimal(x: int):
    from decimal import Decimal
    return Decimal(x) if abs(x) < 10 ** 38 else None


def digest(whitened: DataFrame) -> DataFrame:
    """One row for each row and component, numbered from 1."""
    at = F.posexplode("whitened").alias("at", "whitened")
    return (whitened.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), at,
                            "explained", "identity_error")
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.get("explained", F.col("at")).alias("explained"), "identity_error"))

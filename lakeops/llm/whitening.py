"""Whitening of embeddings onto the leading eigenvectors of their covariance, found by a block Jacobi-Davidson method.

The covariance matrix is never formed.  All that is known of it are its products with a few vectors, each a Spark job: a task
centres its vectors (from exact integer sums, before anything is multiplied) and adds up z (z . u); tasks' sums are added in
groups before the driver adds the last few.  The driver holds some vectors of the embedding's dimension and nothing that
grows with the rows.

Jacobi-Davidson: the wanted eigenpairs are approximated in a growing subspace (Rayleigh-Ritz).  A pair with residual r
is corrected by t, orthogonal to what is wanted, which solves  (I - QQ') (V - theta I) (I - QQ') t = -r  roughly, by a few
steps of MINRES; the steps of all pairs share their products, so a step is one job.  Corrections extend the subspace.  Pairs
are locked, largest first, when their residuals are at double precision; the subspace is restarted with the
best Ritz vectors when it has grown to its limit.

Rows whose vector is null or has an entry that is null or not finite are dropped; a vector shorter than the longest counts as
filled up with zeros.  Null and repeated ids are rows like others.  Components whose variance is zero to rounding cannot be whitened
and are not returned (so one row, or equal rows, give none); an empty table gives an empty result.  ``deviation`` is null where a
long cannot hold it.  Equal eigenvalues give some orthonormal basis of their space, the same for all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.vectors import blocks, is_finite_vector, matrix
from lakeops.llm.words import releasing

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
GUARDS = 8  # vectors beyond the wanted ones in the first subspace
INNER_STEPS = 5  # of MINRES
MAX_OUTER = 200
SUM_GROUPS = 256  # sums of tasks that reach the driver, at most
SEED = 20240229
LONG = 2.0**63
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# --- distributed sums ----------------------------------------------------------------------------
def _added(all_blocks: DataFrame, n_blocks: int, partial: Callable, dtype: str, size: int) -> np.ndarray:
    """Sum over all blocks of partial(block) -> array of ``size``: by tasks, then by groups of tasks, then here."""

    def of_task(batches):
        total, any_ = np.zeros(size, dtype), False
        for batch in batches:
            for b in batch.to_pylist():
                total, any_ = total + partial(b), True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def of_group(t: pa.Table) -> pa.Table:
        total = np.zeros(size, dtype)
        for s in sorted(x.as_py() for x in t.column("sums")):  # in an order that does not hang on which task came first
            total = total + np.frombuffer(s, dtype)
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    by_task = all_blocks.mapInArrow(releasing(of_task), "sums binary")
    groups = max(1, min(SUM_GROUPS, math.isqrt(n_blocks)))
    got = by_task.groupBy(F.pmod(F.xxhash64("sums"), F.lit(groups)).alias("sum_group")).applyInArrow(releasing(_without_key(of_group)), "sums binary")
    return sum((np.frombuffer(s, dtype) for s in sorted(bytes(r[0]) for r in got.collect())), np.zeros(size, dtype))


def _without_key(of_group):
    return lambda t: of_group(t.select(["sums"]))


class Centred:
    """The centred integer vectors of a table, and the products of their covariance."""

    def __init__(self, all_blocks: DataFrame):
        self.blocks = all_blocks
        n, dim, n_blocks = all_blocks.agg(F.sum("size"), F.max("dim"), F.count(F.lit(1))).first()
        self.n, self.dim, self.n_blocks = n or 0, dim or 0, n_blocks
        self.products = 0
        if not self.n:
            return
        d = self.dim
        self.sums = _added(all_blocks, n_blocks, lambda b: entries(b, d).sum(axis=0), "<i8", d)
        centre = self.centring()
        self.trace = float(_added(all_blocks, n_blocks, lambda b: np.array([np.square(centre(b)).sum()]), "<f8", 1)[0]) / self.n

    def centring(self) -> Callable[[dict], np.ndarray]:
        n, sums, dim = self.n, self.sums, self.dim
        # n x - S is exact, so that a centred entry is rounded once
        return lambda b: (n * entries(b, dim) - sums) / n

    def product(self, u: np.ndarray) -> np.ndarray:
        """V u for the columns of ``u``."""
        self.products += 1
        d, k = u.shape
        centre = self.centring()

        def partial(b: dict) -> np.ndarray:
            z = centre(b)
            return (z.T @ (z @ u)).ravel()

        return _added(self.blocks, self.n_blocks, partial, "<f8", d * k).reshape(d, k) / self.n


def entries(b: dict, dim: int) -> np.ndarray:
    """The integers of a block; an entry beyond its vector counts as that of a zero."""
    x = matrix(b["code"], b["entries"], b["size"], b["dim"], b["dim"]).astype(np.int64)
    return x if b["dim"] == dim else np.pad(x, ((0, 0), (0, dim - b["dim"])), constant_values=SHIFT)


# --- Jacobi-Davidson -----------------------------------------------------------------------------
def orthonormal(new: np.ndarray, base: np.ndarray, least: float = 1e-10) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``base``."""
    norms = np.linalg.norm(new, axis=0)
    new = new[:, norms > 0] / norms[norms > 0]
    for _ in range(2):  # once more, as the first time leaves rounding
        new = new - base @ (base.T @ new)
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > least]
    return new


def minres(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, theta: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """For each column i, some steps of MINRES for P (V - theta_i) P t = rhs_i with P = I - q q'; all columns share a product."""

    def project(x: np.ndarray) -> np.ndarray:
        x = x - q @ (q.T @ x)
        return x - q @ (q.T @ x)

    def safe(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x, 1.0)

    v = project(rhs)
    beta = np.linalg.norm(v, axis=0)
    start, live = beta.copy(), beta > 0
    v = v / safe(beta)
    v_old, t = np.zeros_like(v), np.zeros_like(v)
    d_old, d_older = np.zeros_like(v), np.zeros_like(v)
    k = len(theta)
    c, s, c_old, s_old = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    phi, b = beta.copy(), np.zeros(k)
    for _ in range(steps):
        if not live.any():
            break
        w = project(product(v)) - theta * v
        w = project(w) - b * v_old
        alpha = (v * w).sum(axis=0)
        w = w - alpha * v
        b_new = np.linalg.norm(w, axis=0)
        # the last two rotations on the new column (b, alpha, b_new) of the tridiagonal, then a new one
        eps, delta0 = s_old * b, c_old * b
        delta, gamma0 = c * delta0 + s * alpha, -s * delta0 + c * alpha
        gamma = np.hypot(gamma0, b_new)
        c_old, s_old = c, s
        c, s = np.where(gamma > 0, gamma0 / safe(gamma), 1.0), np.where(gamma > 0, b_new / safe(gamma), 0.0)
        direction = (v - delta * d_old - eps * d_older) / safe(gamma)
        ok = live & (gamma > 0)
        t = t + np.where(ok, c * phi, 0.0) * direction
        phi = -s * phi
        d_older, d_old = d_old, direction
        live = ok & (b_new > 1e-14 * np.maximum(1.0, np.abs(alpha))) & (np.abs(phi) > 1e-3 * start)
        v_old, v = v, w / safe(b_new)
        b = b_new
    return project(t)


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, *, guards: int = GUARDS, inner: int = INNER_STEPS,
               max_outer: int = MAX_OUTER, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns, residual norms) of the ``wanted`` largest eigenpairs of a symmetric product."""
    wanted = min(wanted, dim)
    if not wanted:
        return np.zeros(0), np.zeros((dim, 0)), np.zeros(0)
    first = min(dim, wanted + guards)
    limit = min(dim, 4 * wanted + guards)
    basis = orthonormal(np.random.default_rng(seed).standard_normal((dim, first)), np.zeros((dim, 0)))
    image = product(basis)
    best, stuck = np.inf, 0
    for _ in range(max_outer):
        h = basis.T @ image
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = basis @ turn, image @ turn
        theta, u = values[:wanted], ritz[:, :wanted]
        residual = ritz_image[:, :wanted] - u * theta
        norms = np.linalg.norm(residual, axis=0)
        # rounding of a product: some units in the last place of the largest eigenvalue
        done = norms <= 16 * np.finfo(float).eps * math.sqrt(dim) * max(abs(values[0]), np.finfo(float).tiny)
        locked = int(np.argmin(done)) if not done.all() else wanted  # largest first
        if locked == wanted:
            break
        worst = norms[locked:].max()
        best, stuck = min(best, worst), 0 if worst < 0.5 * best else stuck + 1
        if basis.shape[1] == dim and stuck >= 2 or stuck >= 20:
            break  # at the rounding of the products themselves; the caller sees the residuals
        todo = np.flatnonzero(~done)
        if basis.shape[1] < dim:
            t = minres(product, u, theta[todo], -residual[:, todo], inner)
        else:
            t = residual[:, todo]
        if basis.shape[1] + len(todo) > limit and basis.shape[1] < dim:
            keep = min(basis.shape[1], wanted + guards)  # restart with the best Ritz vectors
            basis, image = ritz[:, :keep], ritz_image[:, :keep]
        new = orthonormal(t, basis)
        if basis.shape[1] + new.shape[1] > dim or not new.shape[1]:
            # nothing is left to add: the space is whole, or what is missing is below rounding.  Clean the basis and its image.
            basis = np.linalg.qr(ritz)[0]
            image = product(basis)
            continue
        basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)
    u = np.linalg.qr(u)[0]  # unit length to the last place
    return theta, u * np.sign((u * ritz[:, :wanted]).sum(axis=0)), norms


# --- the operator --------------------------------------------------------------------------------
def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries count as floor(64 c) + 1,000,000.  ``deviation`` is the sum of (n x - S)**2 over the dimensions; ``whitened`` has unit
    variance in each component; ``identity_error`` is the largest entry of its covariance minus the identity.  Other columns are not read.
    """
    part = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                       F.lit(None).cast("long").alias("label"), F.lit(False).alias("mark"))
    part = part.filter(is_finite_vector(F.col("vector")))
    data = Centred(blocks(part, lambda x: np.floor(SCALE * x) + SHIFT, "whitening-blocks"))
    if not data.n or not data.dim:
        return rows.sparkSession.createDataFrame([], OUT)
    values, vectors, residuals = eigenpairs(data.product, data.dim, components)
    if len(values) and residuals.max() > 1e-10 * values[0]:
        raise RuntimeError(f"the eigenpairs did not settle: residual {residuals.max():.3g} of {values[0]:.6g}")
    kept = int(np.count_nonzero(values > 16 * data.dim * np.finfo(float).eps * max(values[0], 0))) if len(values) else 0
    values, project = values[:kept], vectors[:, :kept] / np.sqrt(values[:kept])
    n, dim, sums, centre = data.n, data.dim, data.sums, data.centring()
    if not kept:
        return rows.sparkSession.createDataFrame([], OUT)

    def moments(b: dict) -> np.ndarray:
        w = centre(b) @ project
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = _added(data.blocks, data.n_blocks, moments, "<f8", kept + kept * kept) / n
    cov = got[kept:].reshape(kept, kept) - np.outer(got[:kept], got[:kept])
    error = float(np.abs(cov - np.eye(kept)).max())
    explained = values / data.trace

    def of_rows(batches):
        for batch in batches:
            for b in batch.to_pylist():
                whole = n * entries(b, dim) - sums
                about = np.square(whole.astype(np.float64)).sum(axis=1)
                deviation = pa.array(np.repeat(np.square(whole).sum(axis=1), kept), pa.int64(), mask=np.repeat(about * (1 + 1e-9) >= LONG, kept))
                m = b["size"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["ids"], pa.int64()).take(pa.array(np.repeat(np.arange(m), kept))), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * kept, n)), deviation, pa.array(((whole / n) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * kept, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return data.blocks.mapInArrow(releasing(of_rows), OUT)

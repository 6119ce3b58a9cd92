r"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers x (see ``quantised``), so that sums over all rows are exact. With
A the rows of x less their mean, A v = alpha u + ..., A'u = beta v' + ... builds orthonormal
v_1, v_2, ... (one entry a dimension) and u_1, u_2, ... (one entry a row) with A V = U B, B upper
bidiagonal. The singular value decomposition of the small B gives A's right singular vectors,
which are the components, and their deviations.

* Distributed products. Rows are packed into blocks of some hundred kilobytes, written once.
  A step is one pass over the blocks: each computes u = A q and its share of A'u and u'u, and the
  shares (a vector a block) are summed by Spark. Only vectors of one entry a dimension
  reach the driver.
* u is never stored: u_k = A p_k for a vector p_k of one entry a dimension, kept by the recurrence.
* Full reorthogonalisation, of v against all earlier v (twice), and of u against all earlier u:
  u_j'(A q) = (A'u_j)'q, and A'u_j is known from step j.
* Breakdown. When alpha or beta vanishes, the space found so far is invariant; the next v is a
  fresh vector orthogonal to all earlier ones, so repeated eigenvalues are found as well.
* End. There are as many steps as dimensions at most; fewer if the wanted components have
  converged to double precision, by the last row of the decomposition of B.

Defined cases: a row whose vector is null, empty or holds a null or non-finite entry, or one of
2^40 or more, is left out, and so is one whose length is not the most frequent length (of equally
frequent ones, the greatest). Components of no variance (constant or dependent dimensions, a
single row) are left out, so a row has as many components as have variance, at most the number
asked for. Null and repeated ids are kept as rows of their own. ``deviation`` is null if it is
beyond a long. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import prepare
from .bounded import saved
from .registry import register, table

COMPONENTS = 8
BLOCK_BYTES = 1 << 19
LARGEST = float(1 << 40)
ROUNDING = np.finfo(float).eps


# ------------------------------------------------------------------ rows and blocks

def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and x (array of long): floor(1024 * entry) + 100000 of every usable vector."""
    c = F.transform("embedding", lambda e: e.cast("double"))
    usable = (F.size("embedding") > 0) & F.forall(c, lambda e: F.coalesce(F.abs(e) < LARGEST, F.lit(False)))  # NaN is not less
    return vectors.select("vec_id", "embedding").where(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.transform(c, lambda e: F.floor(e * 1024) + 100000).alias("x"))


def dimension(rows: DataFrame) -> int:
    """The most frequent length, the greatest of equally frequent ones; 0 without rows."""
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return 0 if first is None else first["d"]


def blocks(rows: DataFrame, dim: int) -> DataFrame:
    """Rows of ``dim`` entries as blocks: ids, n, x (the rows one after the other, 8 bytes an entry). Written once."""
    most = max(1, BLOCK_BYTES // (8 * dim))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    arrow_id = rows.select("vec_id").limit(0).toArrow().schema.field("vec_id").type
    schema = pa.schema([("ids", pa.list_(arrow_id)), ("n", pa.int64()), ("x", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, most):
                part = b.slice(at, most)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("vec_id")),
                    pa.array([n], pa.int64()), pa.array([x.tobytes()], pa.binary())], schema=schema)

    packed = rows.where(F.size("x") == dim).mapInArrow(pack, f"ids array<{id_type}>, n bigint, x binary")
    return saved(packed, "whitening-blocks")


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b, i, np.frombuffer(b.column("x")[i].as_py(), np.int64).reshape(-1, dim)


# ------------------------------------------------------------------ sums over all rows

@dataclass(frozen=True)
class Centre:
    """n rows with the sums S of each dimension; x - S / n is x - whole - part / n without a large rounding."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n for s in self.sums], np.float64) / self.n
        return (x - whole).astype(np.float64) - part


def centre_of(packed: DataFrame, dim: int) -> Centre:
    """The exact sums. A block adds its entries as 64-bit numbers (2^51 at most, some thousand rows)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, x in _matrices(batches, dim):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(dim, dtype=np.int32)), pa.array(x.sum(axis=0)),
                pa.array(np.full(dim, len(x), np.int64))], names=["at", "s", "n"])

    sums = packed.select("x").mapInArrow(add, "at int, s bigint, n bigint").groupBy("at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()  # a row a dimension
    by_place = {r["at"]: int(r["s"]) for r in sums}
    return Centre(sums[0]["n"], [by_place[i] for i in range(dim)])


def _added(packed: DataFrame, dim: int, share, size: int) -> np.ndarray:
    """The sum over all blocks of ``share(rows)`` (``size`` doubles). A task adds its blocks, Spark the tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for _, _, x in _matrices(batches, dim):
            total += share(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "s"])

    rows = packed.select("x").mapInArrow(add, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["at"]] = r["s"]
    return out


# ------------------------------------------------------------------ bidiagonalisation

@dataclass(frozen=True)
class Components:
    vectors: np.ndarray  # one a row, of unit length
    eigenvalues: np.ndarray  # of the covariance, falling


def _off(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``vector`` made orthogonal to ``basis`` (orthonormal), twice."""
    if basis:
        b = np.array(basis)
        for _ in range(2):
            vector = vector - b.T @ (b @ vector)
    return vector


def bidiagonalise(product, dim: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors as rows, singular values) of A, falling; the ``wanted`` first are converged.

    ``product(q)`` gives (A'A q, |A q|^2), in one pass over the rows.
    """
    random = np.random.default_rng(seed)
    fresh = lambda: random.standard_normal(dim)
    vs, ps, ws, alphas, betas = [], [], [], [], []  # v_k; u_k = A p_k; A'u_k; B's diagonal and upper diagonal
    v = fresh()
    v /= np.linalg.norm(v)
    beta = 0.0
    scale = 0.0
    while True:
        vs.append(v)
        q = v - beta * ps[-1] if beta else v.copy()
        for _ in range(2):  # off all earlier u: u_j'(A q) = w_j'q
            for p, w in zip(ps, ws):
                q = q - (w @ q) * p
        w, square = product(q)
        alpha = float(np.sqrt(max(square, 0.0)))
        scale = max(scale, alpha, beta)
        if alpha > 100 * ROUNDING * scale * np.sqrt(dim):
            p, w = q / alpha, w / alpha
        else:
            alpha, p, w = 0.0, np.zeros(dim), np.zeros(dim)
        alphas.append(alpha)
        ps.append(p)
        ws.append(w)
        k = len(vs)
        rest = _off(w, vs)
        beta = float(np.linalg.norm(rest))
        done = k == dim
        if not done:
            b = np.diag(alphas) + np.diag(betas, 1) if betas else np.diag(alphas)
            left, s, right = np.linalg.svd(b)
            if beta <= 100 * ROUNDING * scale * np.sqrt(dim):
                beta = 0.0  # invariant: go on with a vector that is orthogonal to all of it
                rest = _off(fresh(), vs)
            elif k > wanted:
                # A'u - sigma v of a singular pair of B is beta times the last entry of its left vector
                done = bool(np.all(beta * np.abs(left[-1, :wanted]) <= ROUNDING * s[0])) and _alone(product, right, s, vs, wanted, fresh)
        if done:
            b = np.diag(alphas) + np.diag(betas, 1) if betas else np.diag(alphas)
            _, s, right = np.linalg.svd(b)
            return right @ np.array(vs), s
        betas.append(beta)
        v = rest / np.linalg.norm(rest)


def _alone(product, right: np.ndarray, s: np.ndarray, vs: list[np.ndarray], wanted: int, fresh, steps: int = 3) -> bool:
    """No direction outside the found space grows beyond the wanted values (a copy of an eigenvalue would)."""
    x = _off(fresh(), vs)
    for _ in range(steps):
        x = x / np.linalg.norm(x)
        y, square = product(x)
        if np.sqrt(square) >= s[wanted - 1]:
            return False
        x = _off(y, vs)
        if np.linalg.norm(x) == 0:
            return True
    return True


def components(packed: DataFrame, dim: int, centre: Centre, wanted: int = COMPONENTS) -> Components:
    wanted = min(wanted, dim)

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        def share(x: np.ndarray) -> np.ndarray:
            a = centre.centred(x)
            u = a @ q
            return np.append(u @ a, u @ u)

        out = _added(packed, dim, share, dim + 1)
        return out[:dim], float(out[dim])

    vectors, s = bidiagonalise(product, dim, wanted)
    vectors, s = vectors[:wanted], s[:wanted]
    keep = s > 1000 * ROUNDING * max(float(s[0]), 1.0) * dim if len(s) else np.zeros(0, bool)
    vectors, s = vectors[keep], s[keep]
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]) if len(vectors) else np.ones(0)
    return Components(vectors * sign[:, None], s * s / centre.n)


# ------------------------------------------------------------------ whitening

def _deviations(x: np.ndarray, centre: Centre) -> list[int | None]:
    """Per row the exact sum of (n x - S)^2."""
    whole = np.array([s // centre.n for s in centre.sums], np.int64)
    rest = np.array([s % centre.n for s in centre.sums], np.int64)
    d = x - whole
    if x.shape[1] * ((float(np.abs(d).max(initial=0)) + 1) * centre.n) ** 2 < 2.0**62:
        return (d * centre.n - rest).__pow__(2).sum(axis=1).tolist()
    exact = ((d.astype(object) * centre.n - rest.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = quantised(vectors)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = saved(rows, "whitening-rows")
    dim = dimension(rows)
    if dim == 0:
        return spark.createDataFrame([], schema)
    packed = blocks(rows, dim)
    centre = centre_of(packed, dim)
    found = components(packed, dim, centre, wanted)
    k = len(found.vectors)
    if k == 0:
        return spark.createDataFrame([], schema)
    project = (found.vectors / np.sqrt(found.eigenvalues)[:, None]).T

    def moments(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ project
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    added = _added(packed, dim, moments, k + k * k) / centre.n
    covariance = added[k:].reshape(k, k) - np.outer(added[:k], added[:k])
    error = float(np.abs(covariance - np.eye(k)).max())
    trace = float(_added(packed, dim, lambda x: np.array([(centre.centred(x) ** 2).sum()]), 1)[0]) / centre.n
    explained = found.eigenvalues / trace

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, x in _matrices(batches, dim):
            ids = b.column("ids").slice(i, 1).flatten()
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), centre.n, np.int64)), pa.array(_deviations(x, centre), pa.int64()).take(pa.array(each)),
                pa.array((centre.centred(x) @ project).ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return packed.mapInArrow(out, schema)


@register("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))

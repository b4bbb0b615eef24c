"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers x = floor(scale * c) + shift. With n rows and per-dimension sums
S, the centred row is (n x - S) / n, whose numerator is exact. The leading eigenvectors
of the covariance V = X'X / n (X centred) come from products V Q alone: one pass over
the rows forms X'(X Q) of its blocks, a d x block matrix a task, and Spark sums them.

1. Rows are packed into blocks and stored once; two passes give n, S and the block's
   first product. Lanczos steps with one vector bound the lowest eigenvalue.
2. A Chebyshev polynomial of V, small between that bound and the block's least Ritz
   value, is applied to the block by its three-term recurrence, one pass a degree. The
   degree is as high as the spread of the wanted values lets rounding errors be.
3. The block is orthogonalised (QR) and rotated to Ritz vectors (Rayleigh-Ritz); leading
   vectors whose residual is at rounding level are locked and filtered no more.
4. It ends when every wanted component is certified: |V q - e q| <= ``tolerance`` times
   the largest eigenvalue. A block that does not get there grows; at the full dimension
   Rayleigh-Ritz is exact, so it ends.

The driver holds matrices of d x block doubles, whatever the rows: their number only
grows the count of passes' tasks. Passes read the stored blocks, so lost executors cost
their own tasks.

Defined cases: rows are dropped whose vector is null, empty, has a null, NaN or infinite
entry or one beyond +-``LARGEST`` after scaling, or has another width than most vectors
(of equally frequent widths the larger counts). Null ids and repeated rows stay, each
with rows of its own. Components with an eigenvalue under ``RANK`` of the largest have no
whitened value and are left out; so one row, or equal rows, give none, and an empty table
gives an empty result. Equal eigenvalues: any basis. A deviation that does not fit a long
is null. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import staged

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**40
GUARD = 16                    # columns of the block beyond the wanted ones
DEGREE = 10
SPREAD = 1e10                 # by which a filter may part the wanted values
PROBE = 8                     # Lanczos steps for the lower end
TOLERANCE = 1e-13
PATIENCE = 10                 # rounds before the block grows
RANK = 1e-10
BLOCK_BYTES = 4_000_000

Product = Callable[[np.ndarray], np.ndarray]


def _clean(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    v = F.col("vector")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * F.lit(float(scale)) >= LARGEST))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .filter(v.isNotNull() & (F.size(v) > 0) & ~odd))


def width(clean: DataFrame) -> int:
    """The most frequent width; 0 without rows."""
    most = (clean.groupBy(F.size("vector").alias("w")).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), F.desc("w")).first())
    return most.w if most else 0


def packed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, int]:
    """(ids, x) blocks of the remaining rows, stored; x: their integers, row by row. And
    the width."""
    clean = _clean(vectors, id_col, vector_col, scale)
    d = width(clean)
    step = max(1, BLOCK_BYTES // (8 * max(1, d)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            x = np.floor(scale * values).astype("<i8") + shift
            for lo in range(0, len(x), step):
                ids = b.column("vec_id").slice(lo, step)
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    "x": pa.array([x[lo:lo + step].tobytes()], pa.binary())})

    blocks = clean.filter(F.size("vector") == d).mapInArrow(run, "ids array<long>, x binary")
    return staged(blocks, "whitening_blocks", "zstd"), d


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        for ids, x in zip(b.column("ids"), b.column("x")):
            yield ids.values, np.frombuffer(x.as_py(), "<i8").reshape(-1, d)


@dataclass(frozen=True)
class Centre:
    """Row count and exact sums of every dimension."""
    n: int
    sums: tuple[int, ...]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: 64-bit integers where they hold it, else Python's."""
        whole = [s // self.n for s in self.sums]
        rest = [s - self.n * w for s, w in zip(self.sums, whole)]
        off = x - np.array(whole, np.int64)
        if self.n * (int(np.abs(off).max(initial=0)) + 1) < 2**62:
            return off * self.n - np.array(rest, np.int64)
        return off.astype(object) * self.n - np.array(rest, object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squared numerators, exactly; None beyond a long."""
        y = self.numerators(x)
        most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
        if y.dtype == object or x.shape[1] * most * most >= 2**63:
            totals = (y.astype(object)**2).sum(axis=1)
            return [int(t) if t < 2**63 else None for t in totals]
        return np.einsum("ij,ij->i", y, y).tolist()

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n


def centre(blocks: DataFrame, d: int) -> Centre:
    """Collects a row for each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _matrices(batches, d):
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([*range(d), -1], pa.int32()),
                "total": pa.array([*x.sum(axis=0).tolist(), len(x)], pa.int64())})

    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = {r.dim: int(r.total) for r in blocks.mapInArrow(run, "dim int, total long")
             .groupBy("dim").agg(total).collect()}
    return Centre(found.get(-1, 0), tuple(found.get(k, 0) for k in range(d)))


def summed(blocks: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray],
           shape: tuple[int, int]) -> np.ndarray:
    """The sum over all blocks of a matrix computed from each: one row of it a key, summed
    in each task first. Collects the matrix."""
    names = [f"c{j}" for j in range(shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for _, x in _matrices(batches, d):
            total += of(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(shape[0]), pa.int32()), *map(pa.array, np.ascontiguousarray(total.T))],
            ["i", *names])

    rows = (blocks.mapInArrow(run, ", ".join(["i int", *(f"{c} double" for c in names)]))
            .groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect())
    out = np.zeros(shape)
    for r in rows:
        out[r[0]] = r[1:]
    return out


def covariance_product(blocks: DataFrame, d: int, middle: Centre) -> Product:
    """Q -> V Q by one pass over the blocks."""
    def product(q: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            rows = middle.rows(x)
            return rows.T @ (rows @ q)
        return summed(blocks, d, of, q.shape) / middle.n
    return product


def lower_end(product: Product, d: int, draw: np.random.Generator, steps: int = PROBE) -> float:
    """A bound below the spectrum: the least Ritz value of a few Lanczos steps less their
    residual; 0 at least, as V has no negative eigenvalue."""
    q = draw.standard_normal((d, 1))
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, d)):
        w = product(basis[-1])
        alpha.append((basis[-1].T @ w).item())
        for _ in range(2):
            w = w - sum(v * (v.T @ w) for v in basis)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * abs(alpha[0]):
            break
        basis.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - beta[-1])


def degree(low: float, high: float, first: float, last: float) -> int:
    """The highest degree up to DEGREE at which the filter grows ``first`` at most SPREAD
    times as much as ``last``; 1 at least."""
    middle, half = (low + high) / 2, (high - low) / 2
    rate = [math.acosh(max(1.0, (v - middle) / half)) for v in (first, last)]
    most = math.log(SPREAD) / max(rate[0] - rate[1], 1e-9)
    return int(min(DEGREE, max(1, most)))


def filtered(product: Product, x: np.ndarray, vx: np.ndarray, locked: np.ndarray, low: float,
             high: float, first: float, times: int) -> np.ndarray:
    """The Chebyshev polynomial of degree ``times`` on [low, high], scaled to 1 at ``first``,
    of V times ``x``; vx: V x. ``locked`` vectors are kept out."""
    middle, half = (low + high) / 2, (high - low) / 2
    outside = lambda y: y - locked @ (locked.T @ y)
    ratio = start = half / (first - middle)
    before, now = x, outside((vx - middle * x) * (start / half))
    for _ in range(times - 1):
        after = 1 / (2 / start - ratio)
        before, now = now, outside((product(now) - middle * now) * (2 * after / half)
                                   - before * (ratio * after))
        ratio = after
    return now


@dataclass(frozen=True)
class Spectrum:
    values: np.ndarray       # falling
    vectors: np.ndarray      # d x components
    residuals: np.ndarray    # |V q - e q| of each
    passes: int


def leading(product: Product, d: int, components: int = COMPONENTS, guard: int = GUARD,
            tolerance: float = TOLERANCE, seed: int = 13) -> Spectrum:
    """Leading eigenpairs of the matrix that ``product`` applies."""
    draw, passes = np.random.default_rng(seed), 0

    def counted(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(q)

    k = min(components, d)
    size = min(d, k + guard)
    q = np.linalg.qr(draw.standard_normal((d, size)))[0]
    vq, low, rounds, best = counted(q), None, 0, np.inf
    while True:
        inner = q.T @ vq
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residual = np.linalg.norm(vq - q * values, axis=0)
        limit = tolerance * max(values[0], 0)
        open_ = np.flatnonzero(residual[:k] > limit)
        if not len(open_) or size == d:
            return Spectrum(values[:k], q[:, :k], residual[:k], passes)
        if low is None:
            low = lower_end(counted, d, draw)
        elif residual[open_].max() > best:
            low = 0.0           # no gain: the bound may have been too high
        best, rounds = residual[open_].max(), rounds + 1
        done = int(open_[0])
        if rounds % PATIENCE == 0:
            more = draw.standard_normal((d, min(d - size, max(1, size // 2))))
            more = np.linalg.qr(np.concatenate((q, more), axis=1))[0][:, size:]
            q, vq = np.concatenate((q, more), axis=1), np.concatenate((vq, counted(more)), axis=1)
            size = q.shape[1]
            continue
        locked = q[:, :done]
        high = max(values[-1], 1e-6 * values[0])
        if low >= high:
            low = 0.0
        # the first open value bounds what grows; at least a little above the interval
        first = max(values[done], high * 1.000001)
        times = degree(low, high, first, max(values[k - 1], high))
        active = filtered(counted, q[:, done:], vq[:, done:], locked, low, high, first, times)
        for _ in range(2):
            active = active - locked @ (locked.T @ active)
            active = np.linalg.qr(active)[0]
        q = np.concatenate((locked, active), axis=1)
        vq = np.concatenate((vq[:, :done], counted(active)), axis=1)


@dataclass(frozen=True)
class Whitening:
    middle: Centre
    spectrum: Spectrum
    trace: float

    @property
    def transform(self) -> np.ndarray:
        """d x components: a centred row times it is whitened."""
        return self.spectrum.vectors / np.sqrt(self.spectrum.values)

    @property
    def explained(self) -> np.ndarray:
        return self.spectrum.values / self.trace


def fit(blocks: DataFrame, d: int, components: int = COMPONENTS, **how) -> Whitening | None:
    """None where there is nothing to whiten: no rows or no variance."""
    middle = centre(blocks, d) if d else Centre(0, ())
    if not middle.n:
        return None
    square = lambda x: np.sum(middle.rows(x)**2).reshape(1, 1)
    trace = summed(blocks, d, square, (1, 1)).item() / middle.n
    if trace <= 0:
        return None
    found = leading(covariance_product(blocks, d, middle), d, components, **how)
    stay = found.values > RANK * found.values[0]
    return Whitening(middle, Spectrum(found.values[stay], found.vectors[:, stay],
                                      found.residuals[stay], found.passes), trace)


def identity_error(blocks: DataFrame, d: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    turn = model.transform
    k = turn.shape[1]

    def of(x: np.ndarray) -> np.ndarray:
        z = model.middle.rows(x) @ turn
        return np.concatenate((z.T @ z, z.sum(axis=0, keepdims=True)))

    moments = summed(blocks, d, of, (k + 1, k)) / model.middle.n
    return float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())


ROWS = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT,
           **how) -> DataFrame:
    """A row for each remaining row and component: vec_id, component (from 1), n, deviation
    (sum of (n x - S)^2 over the dimensions), whitened, explained (share of the trace) and
    identity_error."""
    blocks, d = packed(vectors, id_col, vector_col, scale, shift)
    model = fit(blocks, d, components, **how)
    if model is None:
        return vectors.sparkSession.createDataFrame([], ROWS)
    error, turn, explained = identity_error(blocks, d, model), model.transform, model.explained
    k, middle = turn.shape[1], model.middle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, d):
            n = len(x)
            row = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(row),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                "n": pa.array(np.full(n * k, middle.n)),
                "deviation": pa.array(middle.deviations(x), pa.int64()).take(row),
                "whitened": pa.array((middle.rows(x) @ turn).ravel()),
                "explained": pa.array(np.tile(explained, n)),
                "identity_error": pa.array(np.full(n * k, error))})

    return blocks.mapInArrow(run, ROWS)

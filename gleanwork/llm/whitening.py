"""Embedding whitening by contour integration (FEAST).

The covariance of all vectors is summed where they are read; only sums by dimension and one matrix
of dimensions squared reach the driver. Its largest eigenvalues are cut into intervals with gaps
around them, and every interval is a task of its own: a quadrature along a circle around the
interval, of solves with the covariance shifted by complex numbers, projects a random block onto
the eigenvectors inside; Rayleigh-Ritz extracts them; the projection is repeated until residuals
are at rounding level. Inertia counts (signs along the tridiagonal form) say how many eigenvalues
an interval holds, so that a missed one is noticed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.session import materialize

# Entries become whole numbers: floor(SCALE * c) + SHIFT, held within +-2^40 (a float entry of a billion).
SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 40
COMPONENTS = 8
# The matrix and its copies in tasks take 8 bytes times the square of this.
MAX_DIMENSION = 4_096
# Quadrature nodes on the half circle, and eigenvalues of an interval unless they lie closer together.
NODES = 12
INTERVAL_SIZE = 4
# Rounds until residuals must be at rounding level.
ROUNDS = 40
# Eigenvalues below this share of the trace are rounding: their directions hold no variance.
NO_VARIANCE = 1e-12
# Eigenvalues closer than this share of the largest are not told apart when intervals are cut.
RESOLUTION = 1e-6


@dataclass
class Whitening:
    """What rows need: the mean (whole part and remainder), components as columns, their eigenvalues, the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        return centre(self.sums, self.n)


def centre(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers near it and what remains, so that x less the first is exact."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])


# ------------------------------------------------------------------ eigenvalues


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections."""
    a = np.array(matrix, float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        v = x / np.linalg.norm(x)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the shifted tridiagonal form."""
    diagonal, off = form
    tiny = np.finfo(float).tiny
    above, pivot = 0, 1.0
    for k, value in enumerate(diagonal):
        pivot = value - shift - (off[k - 1] * off[k - 1] / pivot if k else 0.0)
        if pivot == 0:
            pivot = -tiny
        above += int(pivot > 0)
    return above


def located(form: tuple[np.ndarray, np.ndarray], k: int, low: float, high: float) -> float:
    """The k-th largest eigenvalue (from 1) to the resolution, by halving."""
    width = RESOLUTION * max(abs(low), abs(high)) / 4
    while high - low > width:
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(form, middle) >= k else (low, middle)
    return (low + high) / 2


def intervals(form: tuple[np.ndarray, np.ndarray], components: int, top: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) that hold the largest ``components`` eigenvalues, cut inside wide gaps.

    Eigenvalues within the resolution of each other stay together, so the last interval may hold more.
    """
    floor, ceiling = -top * 1e-3, top * (1 + 1e-3)
    # One more than needed shows the gap below the last.
    size = len(form[0])
    places = [located(form, k, floor, ceiling) for k in range(1, min(components + 1, size) + 1)]
    while len(places) < size and places[-2:-1] and places[-2] - places[-1] <= RESOLUTION * top and len(places) > components:
        places.append(located(form, len(places) + 1, floor, ceiling))
    ends = places + ([floor - top] if len(places) == size else [])
    gaps = [a - b for a, b in zip(ends, ends[1:], strict=False)]
    cuts, start = [], 0
    while start < min(components, len(places)):
        # The widest gap among those that leave a fitting number of eigenvalues.
        options = [k for k in range(start, min(start + INTERVAL_SIZE, len(gaps))) if gaps[k] > RESOLUTION * top]
        if not options:
            options = [k for k in range(start, len(gaps)) if gaps[k] > RESOLUTION * top][:1] or [len(gaps) - 1]
        needed = [k for k in options if k >= components - 1]
        cut = needed[0] if needed else max(options, key=lambda k: gaps[k])
        cuts.append(cut)
        start = cut + 1
    found, high = [], ceiling
    for cut in cuts:
        low = max(ends[cut] - gaps[cut] / 2, floor)
        found.append((float(low), float(high), count_above(form, low) - count_above(form, high)))
        high = low
    return [x for x in found if x[2]]


def project(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block's share in the eigenvectors with eigenvalues in (low, high): a Gauss-Legendre sum of shifted solves."""
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    unit = np.eye(len(matrix))
    for x, weight in zip(*np.polynomial.legendre.leggauss(NODES), strict=True):
        direction = np.exp(1j * np.pi / 2 * (1 - x))
        solved = np.linalg.solve((middle + radius * direction) * unit - matrix, block.astype(complex))
        out += weight / 2 * (radius * direction * solved).real
    return out


def ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and vectors of the matrix within the span of the block."""
    basis = np.linalg.qr(block)[0]
    small = basis.T @ matrix @ basis
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], basis @ vectors[:, ::-1]


def solve_interval(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high); raises when fewer or more are found at the end."""
    d = len(matrix)
    block = np.random.default_rng(7).standard_normal((d, min(d, count + max(4, count))))
    scale = np.abs(matrix).sum(axis=0).max()
    best = np.inf
    for _ in range(ROUNDS):
        values, vectors = ritz(matrix, project(matrix, low, high, block))
        inside = (values > low) & (values < high)
        kept, own = vectors[:, inside], values[inside]
        if inside.sum() == count:
            worst = np.linalg.norm(matrix @ kept - kept * own, axis=0).max() / scale
            # Residuals fall by a large factor each round until rounding stops them.
            if worst < 1e-15 * d or (worst < 1e-13 * d and worst > best / 2):
                return own, kept
            best = worst
        block = vectors
    raise ArithmeticError(f"found {int(inside.sum())} of {count} eigenvalues between {low} and {high}, residual {best}")


def _solved(matrix):
    """Task: eigenpairs of each given interval; the matrix comes as a broadcast."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                values, vectors = solve_interval(matrix.value, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"])

    return solve


def largest_components(spark: SparkSession, covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the largest ``components`` with any variance."""
    trace = float(np.trace(covariance))
    if not len(covariance) or trace <= 0:
        return np.empty(0), np.empty((len(covariance), 0))
    # Shares of the trace: the same tolerances fit any unit.
    matrix = covariance / trace
    form = tridiagonal(matrix)
    wanted = min(components, count_above(form, NO_VARIANCE))
    parts = intervals(form, wanted, float(min(1.0, np.abs(matrix).sum(axis=0).max())))
    sent = spark.sparkContext.broadcast(matrix)
    tasks = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts))
    found = tasks.mapInArrow(_solved(sent), "value double, vector array<double>").collect()
    sent.destroy()
    if len(found) != sum(count for *_, count in parts):
        raise ArithmeticError("an interval's eigenvalues are missing")
    # Once more over all intervals, so that vectors of neighbouring ones are orthogonal too.
    values, vectors = ritz(matrix, np.array([r["vector"] for r in found]).T)
    return values[:wanted] * trace, vectors[:, :wanted]


# ------------------------------------------------------------------ sums over all vectors


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors * SCALE), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _matrix(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable vectors, those as whole numbers)."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dimension), False)
    places = pc.indices_nonzero(fits).to_numpy()
    values = column.filter(fits).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dimension)
    finite = np.isfinite(values).all(axis=1)
    return places[finite], whole_numbers(values[finite])


def _sums(dimension: int):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, object)
        for batch in batches:
            _, x = _matrix(batch.column("vector"), dimension)
            n += len(x)
            total += x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict({"n": [n], "sums": [[str(t) for t in total]]})

    return summed


def _products(whole: np.ndarray, rest: np.ndarray):
    """Task: rows of the sum of outer products of centred vectors."""
    d = len(whole)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            _, x = _matrix(batch.column("vector"), d)
            y = (x - whole) - rest
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return summed


def _added(group: pa.Table) -> pa.Table:
    rows = np.array(group.column("row").to_pylist())
    return pa.table({"i": group.column("i").slice(0, 1), "row": pa.array([rows.sum(axis=0)], pa.list_(pa.float64()))})


def _read(rows: DataFrame, vector: str, keep: list[Column]) -> DataFrame:
    return rows.select(*keep, F.col(vector).cast("array<double>").alias("vector"))


def dimension_of(vectors: DataFrame) -> int:
    """The number of entries that most usable vectors have; ties go to the larger one. 0 without any."""
    usable = vectors.where(F.forall("vector", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))) & (F.size("vector") > 0))
    lengths = usable.groupBy(F.size("vector").alias("size")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def fit(rows: DataFrame, vector: str = "vector", components: int = COMPONENTS) -> Whitening | None:
    """Mean, covariance and components of all usable vectors; None without any."""
    vectors = _read(rows, vector, [])
    d = dimension_of(vectors)
    if not d:
        return None
    if d > MAX_DIMENSION:
        raise ValueError(f"vectors of {d} entries; at most {MAX_DIMENSION}")
    parts = vectors.mapInArrow(_sums(d), "n long, sums array<string>")
    by_place = parts.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i")
    totals = by_place.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    n, sums = totals[0]["n"], [int(r["s"]) for r in sorted(totals, key=lambda r: r["i"])]
    products = vectors.mapInArrow(_products(*centre(sums, n)), "i int, row array<double>")
    added = products.groupBy("i").applyInArrow(_added, "i int, row array<double>").collect()
    covariance = np.array([r["row"] for r in sorted(added, key=lambda r: r["i"])]) / n
    covariance = (covariance + covariance.T) / 2
    values, units = largest_components(rows.sparkSession, covariance, components)
    return Whitening(n, sums, units, values, float(np.trace(covariance)))


def _deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum of (n x - S)^2 by row, exact; null where it is beyond 64 bits."""
    if not len(x):
        return []
    largest = n * int(np.abs(x).max()) + max(map(abs, sums))
    if largest * largest * len(sums) < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _whitened(model: Whitening, name: str):
    whole, rest = model.centre
    units, roots = model.components, np.sqrt(model.eigenvalues)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = _matrix(batch.column("vector"), len(whole))
            out = ((x - whole) - rest) @ units / roots
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(name).take(pa.array(places)),
                    pa.array(_deviations(x, model.sums, model.n), pa.int64()),
                    pa.array(list(out), pa.list_(pa.float64())),
                ],
                names=[name, "deviation", "whitened"],
            )

    return whiten


def whiten(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """``vec_id, deviation, whitened`` (one entry by component) of every usable vector."""
    kept = _read(rows, vector, [F.col(vec_id)])
    kind = kept.schema[vec_id].dataType.simpleString()
    return kept.mapInArrow(_whitened(model, vec_id), f"`{vec_id}` {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest entry of the whitened rows' covariance less the identity, from the rows as returned."""
    at = [F.get("whitened", F.lit(k)) for k in range(components)]
    means = whitened.agg(*(F.avg(c) for c in at)).first()
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    products = whitened.agg(*(F.avg((at[i] - means[i]) * (at[j] - means[j])) for i, j in pairs)).first()
    return max((abs(v - (i == j)) for v, (i, j) in zip(products, pairs, strict=True)), default=0.0)


def whitened_components(rows: DataFrame, vec_id: str = "vec_id", vector: str = "vector", components: int = COMPONENTS) -> DataFrame:
    """One row by usable vector and component, numbered from 1 by falling eigenvalue.

    Returns ``vec_id, component, n, deviation, whitened, explained, identity_error``. A vector is
    usable when it and its entries aren't null, all entries are finite, and it has as many as most
    vectors (ties: the larger number). All others are left out, and count in nothing. Repeated rows
    count and return as often as they occur. Components without variance aren't returned, so fewer
    than ``components`` where the vectors span fewer directions, and no rows at all where they are
    equal, where there is one or none. A deviation beyond 64 bits is null.
    """
    spark = rows.sparkSession
    model = fit(rows, vector, components)
    kind = rows.schema[vec_id].dataType.simpleString()
    columns = f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], columns)
    done = materialize(whiten(rows, model, vec_id, vector))
    error = identity_error(done, len(model.eigenvalues))
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues))
    each = done.select(F.col(vec_id), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col(vec_id),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )

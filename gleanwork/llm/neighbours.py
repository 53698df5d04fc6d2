"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector with ``functions`` random projections, each cut into cells of ``width``
(in lengths of a query vector).
A query visits its own bucket and ``probes`` perturbed ones: cells are stepped to the side the
query is nearest to, in the order in which such steps are expected to succeed. Rows that lie in a
visited bucket of any table are candidates and are ranked by their exact distance.

Every row is hashed where it is read and never shuffled: queries come in blocks of bounded size
that all tasks know, and a task returns only its nearest rows for each query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.llm.tokens import mix, slices
from gleanwork.session import materialize

TABLES, FUNCTIONS, WIDTH, PROBES = 12, 8, 2.0, 64
# Bytes of query vectors that every task holds at a time.
BLOCK_BYTES = 1_000_000
ROWS = 2_048


def perturbations(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of ranks of boundary distances, best expected score first; the first set is empty.

    Rank j of 2 * functions stands for the j-th nearest cell boundary of a query; expected squared
    distances of uniform positions give the order without looking at a query.
    """
    m = functions
    expected = [
        j * (j + 1) / (4 * (m + 1) * (m + 2))
        if j <= m
        else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        for j in range(1, 2 * m + 1)
    ]
    found: list[tuple[int, ...]] = [()]
    heap = [(expected[0], (0,))]
    while heap and len(found) < probes:
        _, chosen = heapq.heappop(heap)
        # The two boundaries of one function can't be crossed at once.
        if len({min(j, 2 * m - 1 - j) for j in chosen}) == len(chosen):
            found.append(chosen)
        if (following := chosen[-1] + 1) < 2 * m:
            for longer in (chosen[:-1] + (following,), chosen + (following,)):
                heapq.heappush(heap, (sum(expected[j] for j in longer), longer))
    return found


class Tables:
    """Hash functions for vectors of one length, the same in every task."""

    def __init__(self, queries: np.ndarray, tables: int, functions: int, width: float, seed: int = 11) -> None:
        size = queries.shape[1]
        random = np.random.default_rng([seed, size])
        # Cells are as wide as the queries are long: root mean square times ``width``.
        largest = np.abs(queries).max()
        length = largest * float(np.sqrt(((queries / largest) ** 2).sum(1).mean()))
        self.tables, self.functions, self.width = tables, functions, width * length if np.isfinite(length) else width * largest
        self.lines = random.standard_normal((size, tables * functions))
        self.offset = random.uniform(0, 1, tables * functions) * self.width

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Positions in units of cells, by row, table and function."""
        # Far vectors only lose hash precision; their distances are computed from the vectors themselves.
        with np.errstate(over="ignore", invalid="ignore"):
            at = np.nan_to_num((vectors @ self.lines + self.offset) / self.width)
        return np.clip(at, -1e15, 1e15).reshape(len(vectors), self.tables, self.functions)

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One 64-bit key per bucket of the last axis."""
        out = np.full(cells.shape[:-1], self.functions, np.uint64)
        for k in range(self.functions):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + cells[..., k].astype(np.int64).view(np.uint64))
        return out

    def probe_keys(self, queries: np.ndarray, order: list[tuple[int, ...]]) -> np.ndarray:
        """Keys of the visited buckets: query, table, probe."""
        at = self.cells(queries)
        floor = np.floor(at)
        part = at - floor
        # Distances to the boundary below (index f) and above (index f + functions), nearest first.
        nearest = np.argsort(np.concatenate([part, 1 - part], -1), -1)
        out = np.empty((len(queries), self.tables, len(order)), np.uint64)
        q, t = np.ogrid[: len(queries), : self.tables]
        for k, chosen in enumerate(order):
            moved = floor.copy()
            for j in chosen:
                side = nearest[:, :, j]
                moved[q, t, side % self.functions] += np.where(side < self.functions, -1, 1)
            out[:, :, k] = self.keys(moved)
        return out


def usable(vector) -> np.ndarray | None:
    """The vector in double precision, or None if it is null, empty, zero or holds null or non-finite numbers."""
    if not vector or any(x is None for x in vector):
        return None
    out = np.asarray(vector, np.float64)
    return out if np.isfinite(out).all() and out.any() else None


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors of a list column; whole batches of one length are checked at once."""
    if column.null_count == 0 and column.flatten().null_count == 0:
        sizes = np.diff(column.offsets.to_numpy())
        if len(sizes) and sizes[0] and (sizes == sizes[0]).all():
            table = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)
            good = np.isfinite(table).all(1) & table.any(1)
            return [row if ok else None for row, ok in zip(table, good)]
    return [usable(v) for v in column.to_pylist()]


class _Nearest:
    """The best rows per query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.distance = np.full((queries, k), np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def offer(self, query: int, distance: np.ndarray, ids: np.ndarray) -> None:
        d, i = np.concatenate([self.distance[query], distance]), np.concatenate([self.id[query], ids])
        # One row per id: the nearest of repeated rows.
        first = np.lexsort((d, i))
        first = first[np.r_[True, i[first][1:] != i[first][:-1]]] if len(i) else first
        d, i = d[first], i[first]
        best = np.lexsort((i, d))[: self.k]
        self.distance[query, : len(best)], self.id[query, : len(best)] = d[best], i[best]
        self.distance[query, len(best) :], self.id[query, len(best) :] = np.inf, np.iinfo(np.int64).max


def _search(block: list, k: int, settings: tuple | None):
    """One task: its rows against a block of (id, vector) queries; ``settings`` None compares all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, tuple] = {}
        for size in {len(v) for _, v in block.value}:
            own = [(i, v) for i, v in block.value if len(v) == size]
            ids, vectors = np.array([i for i, _ in own], np.int64), np.array([v for _, v in own])
            probes = None
            if settings:
                hashes = Tables(vectors, *settings[:3])
                keys = hashes.probe_keys(vectors, perturbations(settings[1], settings[3]))
                probes = hashes, []
                for t in range(hashes.tables):
                    flat = keys[:, t].ravel()
                    order = np.argsort(flat, kind="stable")
                    probes[1].append((flat[order], order // keys.shape[2]))
            by_size[size] = ids, vectors, probes, _Nearest(len(ids), k)
        for batch in slices(batches, ROWS):
            everything = list(zip(batch.column("vec_id").to_pylist(), _vectors(batch.column("vector"))))
            for size, (ids, vectors, probes, nearest) in by_size.items():
                rows = [(i, v) for i, v in everything if v is not None and i is not None and len(v) == size]
                if rows:
                    _compare(np.array([i for i, _ in rows], np.int64), np.array([v for _, v in rows]), ids, vectors, probes, nearest)
        for ids, _, _, nearest in by_size.values():
            at = np.isfinite(nearest.distance)
            yield pa.record_batch(
                {
                    "query_id": pa.array(np.repeat(ids, at.sum(1)), pa.int64()),
                    "vec_id": pa.array(nearest.id[at], pa.int64()),
                    "score": pa.array(nearest.distance[at], pa.float64()),
                }
            )

    return run


def _compare(row_ids, rows, ids, vectors, probes, nearest: _Nearest) -> None:
    if probes is None:
        candidate = np.ones((len(ids), len(row_ids)), bool)
    else:
        hashes, lookup = probes
        candidate = np.zeros((len(ids), len(row_ids)), bool)
        keys = hashes.keys(np.floor(hashes.cells(rows)))
        for t, (sorted_keys, query) in enumerate(lookup):
            low, high = np.searchsorted(sorted_keys, keys[:, t]), np.searchsorted(sorted_keys, keys[:, t], "right")
            for r in np.flatnonzero(high > low):
                candidate[query[low[r] : high[r]], r] = True
    candidate &= ids[:, None] != row_ids[None, :]
    with np.errstate(over="ignore", invalid="ignore"):
        for q in range(len(ids)):
            near = np.flatnonzero(candidate[q])
            if not len(near):
                continue
            distance = np.sqrt(((rows[near] - vectors[q]) ** 2).sum(1))
            good = distance <= nearest.distance[q, -1]
            if good.any():
                nearest.offer(q, distance[good], row_ids[near[good]])


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    width: float = WIDTH,
    probes: int = PROBES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of ``vectors`` (vec_id, vector) found nearest to each query.

    ``queries`` has the same columns; a row with the query's id is never its own neighbour. Score
    is the Euclidean distance in double precision, ties go to the smaller id. A query whose buckets
    hold fewer than ``k`` rows is compared with all rows instead.

    Defined results: rows with a null id and vectors that are null, empty, zero or hold null or
    non-finite numbers take no part; vectors of different lengths are never compared; of repeated
    query ids one (the smallest vector) asks; repeated rows count once, at their nearest; squared
    distances beyond double precision are not found; empty tables give no rows.
    """
    asked = materialize(
        queries.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
        .where("vec_id is not null")
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )
    source = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "vector")
    settings = (tables, functions, width, probes)
    found = _in_blocks(source, asked, k, settings, block_bytes)
    short = asked.join(found.groupBy(F.col("query_id").alias("vec_id")).count().where(F.col("count") >= k), "vec_id", "left_anti")
    short = materialize(short)
    if not short.isEmpty():
        full = _in_blocks(source, short, k, None, block_bytes)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(full)
    return found.select("query_id", "rank", "vec_id", "score")


def _in_blocks(source: DataFrame, asked: DataFrame, k: int, settings: tuple | None, block_bytes: int) -> DataFrame:
    """The ranked rows of all queries, stored block by block: the driver holds one block at a time."""
    size = asked.agg(F.sum(F.size("vector"))).first()[0] or 0
    count = max(1, -(-8 * size // block_bytes))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(count))
    out = None
    for n in range(count):
        ranked = _ranked(source, asked.where(block == n), k, settings)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _ranked(source: DataFrame, asked: DataFrame, k: int, settings: tuple | None) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    rows = [(r["vec_id"], usable(r["vector"])) for r in asked.collect()]
    shared = asked.sparkSession.sparkContext.broadcast([(i, v) for i, v in rows if v is not None])
    part = source.mapInArrow(_search(shared, k, settings), "query_id bigint, vec_id bigint, score double")
    # A row may be offered by several tasks if its id is repeated.
    once = part.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    stored = materialize(once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    shared.destroy()
    return stored

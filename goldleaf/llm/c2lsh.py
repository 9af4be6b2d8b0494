"""Approximate nearest neighbours by collision-counting hashing with query-centred windows.

Vectors are dealt into blocks of a bounded number of components. A block's index is one sorted array per
random projection. A query widens a window around its own projection in every array, round by round
(virtual rehashing: a wider window stands for a coarser hash, nothing is hashed again); vectors that entered
the windows of at least ``THRESHOLD`` of the arrays are verified by their distance. Windows stop widening
once they reach ``REACH`` times the distance of the k-th nearest known: a vector at that distance keeps a
projection within ``REACH`` times it of the query's in 77 of 100 arrays, nearer ones in more. A query that has
no k neighbours yet widens on, at last over everything, so it finds k whenever there are as many candidates.

A table is searched in two passes. In the first each query visits one block, which gives a distance that its
k-th nearest cannot exceed; in the second it visits all others, and there widens its windows no further than
that distance asks for. In both a block and its queries make one partition, sorted so that the rows come
first: the index is built once, the queries stream past it in Arrow batches, and only what can still be among
a query's nearest leaves the task. Memory is bounded by a block, its index and one batch, however many
queries there are. Every row is indexed; there is no cap on the vectors verified.

Distances are Euclidean, in double precision, on the original vectors.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
with a null id; vectors are compared with those of their own dimension; rows that repeat an id are
candidates one by one, and one query (its smallest vector), for which no row of that id is a candidate; ties
go to the smaller id; fewer candidates than asked for give fewer rows; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.common import importable_on_workers, written

NEIGHBOURS, QUERY_EVERY = 10, 100
PROJECTIONS, THRESHOLD = 32, 20  # collisions needed of 32
REACH = 1.2  # final window half-width, in distances of the k-th nearest known
ROUNDS = (0.5, 0.7, 1.0)  # window widths of a search, in final ones
MORE_ROUNDS = (1.5, 2.2, float("inf"))  # of a search without a bound that found too few
BLOCK_VALUES = 1 << 20  # components in a block: 16,384 vectors of 64, 8 MB
SAMPLE_ROWS = 256  # of a block, whose distances give a search without a bound its first one
QUERY_ROWS = 256  # whose windows are found at once
SEED = 23


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class WindowIndex:
    """Sorted projections of the rows of ``x``."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.directions = np.random.default_rng(SEED).normal(size=(x.shape[1], PROJECTIONS))
        values = x @ self.directions
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        self.sample = np.arange(0, len(ids), max(1, len(ids) // SAMPLE_ROWS))

    def _first_bounds(self, queries: np.ndarray, own_ids: np.ndarray, k: int) -> np.ndarray:
        """A distance within which each query has ``k`` rows, by a sample of the block; infinite if it has fewer."""
        x = self.x[self.sample]
        if len(x) < k:
            return np.full(len(queries), np.inf)
        squares = (queries ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1) - 2 * queries @ x.T
        # the difference of nearly equal squares is known to some 1e-14 of them
        slack = 1e-12 * ((queries ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1))
        d = np.sqrt(np.maximum(squares, 0) + slack)
        d[(self.ids[self.sample] == own_ids[:, None]) | ~np.isfinite(d)] = np.inf
        return np.partition(d, k - 1, axis=1)[:, k - 1]

    def _windows(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of all queries' windows, one row per query; an unknown or infinite width holds everything."""
        low, high = np.empty(at.shape, np.int64), np.empty(at.shape, np.int64)
        for j, s in enumerate(self.sorted):
            low[:, j] = np.searchsorted(s, at[:, j] - half)
            high[:, j] = np.searchsorted(s, at[:, j] + half, side="right")
        everything = ~np.isfinite(half) | ~np.isfinite(at).all(axis=1)
        low[everything], high[everything] = 0, len(self.ids)
        return low, high

    def _rounds(self, rounds: list, at: np.ndarray, half: np.ndarray, i: int) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """The windows of query ``i``, round by round; the last holds everything."""
        yield from ((f, low[i], high[i]) for f, low, high in rounds)
        for f in MORE_ROUNDS:
            low, high = self._windows(at[i:i + 1], np.maximum(half[i:i + 1], 1e-300) * f)
            yield f, low[0], high[0]

    def nearest(self, queries: np.ndarray, own_ids: np.ndarray, bounds: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the distances and ids of the ``k`` nearest found that lie within its bound."""
        at = queries @ self.directions
        known = np.minimum(bounds, self._first_bounds(queries, own_ids, k))
        # projections of equal vectors may differ in their last digits
        slack = 1e-9 * (np.abs(at).max(axis=1) + known)
        half = REACH * known + slack
        rounds = [(f, *self._windows(at, f * half)) for f in ROUNDS]
        out = []
        for i, query in enumerate(queries):
            collisions = np.zeros(len(self.ids), np.int64)
            unseen = self.ids != own_ids[i]
            distances, rows = np.empty(0), np.empty(0, np.int64)
            kth, low, high = known[i], None, None
            unbounded = np.isinf(bounds[i])
            for f, a, b in self._rounds(rounds, at, half, i):
                if low is None:
                    entered = [o[s:e] for o, s, e in zip(self.order, a, b)]
                else:
                    entered = [o[s:e] for o, s, e in zip(self.order, a, low)] + [o[s:e] for o, s, e in zip(self.order, high, b)]
                low, high = a, b
                collisions += np.bincount(np.concatenate(entered), minlength=len(self.ids))
                fresh = np.flatnonzero((collisions >= THRESHOLD) & unseen)
                if len(fresh):
                    unseen[fresh] = False
                    away = self.x[fresh]
                    away -= query
                    distances = np.concatenate([distances, np.sqrt(np.einsum("ij,ij->i", away, away))])
                    rows = np.concatenate([rows, fresh])
                    if len(rows) >= k:
                        kth = min(kth, np.partition(distances, k - 1)[k - 1])
                if f * half[i] >= REACH * kth + slack[i] and (len(rows) >= k or not unbounded):
                    break
            if len(rows) > k:  # all ties of the k-th found compete by id
                near = np.flatnonzero(distances <= np.partition(distances, k - 1)[k - 1])
                distances, rows = distances[near], rows[near]
            found = self.ids[rows]
            best = np.lexsort((found, distances))[:k]
            best = best[distances[best] <= bounds[i]]
            out.append((distances[best], found[best]))
        return out


_FOUND = "query_id bigint, vec_id bigint, score double"
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _numbers(column: pa.Array, start: int, stop: int) -> np.ndarray:
    return column.slice(start, stop - start).to_numpy(zero_copy_only=False)


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One partition: for each (block, dim) its rows (not asked), then its queries (asked)."""
    key, parts, index = None, [], None
    for batch in batches:
        marks = np.stack([_numbers(batch.column(c), 0, batch.num_rows).astype(np.int64) for c in ("block", "dim", "asked")])
        starts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for start, stop in zip(starts, starts[1:]):
            if start == stop:
                continue
            block, dim, asked = marks[:, start]
            if key != (block, dim):
                key, parts, index = (block, dim), [], None
            ids = _numbers(batch.column("vec_id"), start, stop)
            x = batch.column("embedding").slice(start, stop - start).flatten().to_numpy(zero_copy_only=False)
            x = x.astype(np.float64).reshape(-1, dim)
            if not asked:
                parts.append((ids, x))
                continue
            if index is None:
                if not parts:  # no row of this dimension in the block
                    continue
                index = WindowIndex(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                parts = [(index.ids, index.x)]
            bounds = _numbers(batch.column("bound"), start, stop)
            for s in range(0, len(ids), QUERY_ROWS):
                own = ids[s:s + QUERY_ROWS]
                found = index.nearest(x[s:s + QUERY_ROWS], own, bounds[s:s + QUERY_ROWS], k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own, [len(d) for d, _ in found]).astype(np.int64)),
                    pa.array(np.concatenate([i for _, i in found]).astype(np.int64)),
                    pa.array(np.concatenate([d for d, _ in found]))], schema=_FOUND_ARROW)


def _visit(rows: DataFrame, asked: DataFrame, blocks: int, k: int) -> DataFrame:
    """What the queries find in the blocks they are sent to; a block is one partition."""
    both = rows.select("block", "dim", F.lit(0).alias("asked"), "vec_id", "embedding", F.lit(float("inf")).alias("bound")
                       ).unionByName(asked.select("block", "dim", F.lit(1).alias("asked"), "vec_id", "embedding", "bound"))
    return both.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions(
        "block", "dim", "asked", "vec_id").mapInArrow(lambda batches: _search(batches, k), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every query.

    Both frames have ``vec_id`` (integer) and ``embedding`` (array of float or double).
    """
    importable_on_workers(vectors.sparkSession)

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(
            F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    dim = F.size("embedding").alias("dim")
    stored = written(clean(vectors).select("*", dim, F.monotonically_increasing_id().alias("_n")), "op3-rows")
    values = stored.agg(F.sum(F.col("dim").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-values // BLOCK_VALUES))
    # rows by number, not by id: repeated ids do not gather in a block
    rows = stored.withColumn("block", F.pmod(F.xxhash64("_n"), F.lit(blocks)))
    asked = written(clean(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select(
        "*", dim, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("home")), "op3-queries")
    first = _visit(rows, asked.withColumn("block", F.col("home")).withColumn("bound", F.lit(float("inf"))), blocks, k)
    if blocks == 1:
        return _ranked(first, k)
    first = written(first, "op3-first")
    bound = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("bound"))
    others = asked.join(bound, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf")))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).where("block <> home")
    return _ranked(first.unionByName(_visit(rows, others, blocks, k)), k)


def neighbours_of_table(vectors: DataFrame, every: int = QUERY_EVERY, k: int = NEIGHBOURS) -> DataFrame:
    """Rows whose id is divisible by ``every`` against all rows."""
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % every == 0), k)

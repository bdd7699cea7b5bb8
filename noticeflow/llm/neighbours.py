"""Nearest neighbours by inner product: cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) turns a unit vector, and the signed axis closest to it is its
hash. ``functions`` such hashes make a cell; each of TABLES tables hashes
with rotations of its own. Every vector lies in one cell of each table; a query
looks into the ``probes`` cells of each table that its own rotated
coordinates rank first, and all vectors found there are compared exactly.

- *Recall is measured, then set.* ``probes`` is not a guess: SAMPLE queries
  are answered by brute force over all rows, and ``probes`` is the least
  number that finds TARGET of those neighbours. So it follows the data: few
  cells where neighbours are close, many where there is no structure. If no
  number will do, a function less makes the cells wider.
- *Inner product.* Where lengths differ, each vector gets one more coordinate
  that fills it up to the greatest length (queries: 0); then the angle orders
  as the inner product does.
- *A floor for each query.* POOL rows are compared with every query first.
  Their best k are candidates, and no later candidate below their k-th is
  sent on. It also makes sure that a query gets k answers.
- *Work.* Vectors and queries meet by (cell, block of vectors, block of
  queries): a cell with a third of all rows is dealt out in blocks by its
  counted size, and a task holds BLOCK vectors and QUERY_BLOCK queries at
  most. It returns a query's k best of the block. The number of functions
  grows with the table, so that usual cells stay below BLOCK.

Scores add the products of the original components in order, in doubles.

Defined cases: vectors that are null, all zero (or empty) or hold null, NaN
or infinite components, and rows without vec_id, take no part; shorter
vectors count as filled up with zeros; rows that share a vec_id are one item
with the least of their vectors; equal scores go by vec_id; with k or fewer
candidates all are returned; an empty table gives an empty result; only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import finite_vectors, join_small, materialise, ready

TABLES = 2
#: Queries with brute-force answers, and the share of those that probing must find.
SAMPLE, TARGET = 64, 0.96
#: Rows compared with every query (fewer for very wide vectors).
POOL, POOL_BYTES = 2048, 1 << 23
#: Rows of a usual cell at most, and of a task.
BLOCK, QUERY_BLOCK = 4096, 1024
#: Probes that are tried for a cell of several functions.
MOST_PROBES = 1 << 15
_PAIRS = 1 << 22


# --------------------------------------------------------------- the hashes


def hadamard(a: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long)."""
    n, h = a.shape[1], 1
    while h < n:
        a = a.reshape(len(a), n // (2 * h), 2, h)
        a = np.stack([a[:, :, 0] + a[:, :, 1], a[:, :, 0] - a[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return a / np.sqrt(n)


class CrossPolytope:
    """``tables`` tables of cells made of ``functions`` signed axes each."""

    def __init__(self, width: int, functions: int, tables: int = TABLES, seed: int = 13):
        self.size = 1 << max(width - 1, 1).bit_length()
        self.axes = 2 * self.size
        self.functions, self.tables = functions, tables
        self.cells = self.axes**functions
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, functions, 3, self.size))

    def _signed(self, x: np.ndarray, table: int, function: int) -> np.ndarray:
        """(n, axes): the coordinate of each row along every signed axis."""
        y = np.zeros((len(x), self.size))
        y[:, : x.shape[1]] = x
        for signs in self.signs[table, function]:
            y = hadamard(y * signs)
        return np.concatenate([y, -y], axis=1)

    def cell(self, x: np.ndarray, table: int) -> np.ndarray:
        """Each row's cell: its closest signed axis by every function."""
        out = np.zeros(len(x), np.int64)
        for f in range(self.functions):
            out = out * self.axes + self._signed(x, table, f).argmax(axis=1)
        return out + table * self.cells

    def probes(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """(n, count) cells of each row, the likeliest first: by the squared
        steps from each function's best axis, summed."""
        n = len(x)
        cost, cells = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for f in range(self.functions):
            y = self._signed(x, table, f)
            step = (y.max(axis=1, keepdims=True) - y) ** 2
            near = _least(step, min(count, self.axes))
            cost = (cost[:, :, None] + np.take_along_axis(step, near, 1)[:, None, :]).reshape(n, -1)
            cells = (cells[:, :, None] * self.axes + near[:, None, :]).reshape(n, -1)
            first = _least(cost, min(count, cost.shape[1]))
            cost, cells = np.take_along_axis(cost, first, 1), np.take_along_axis(cells, first, 1)
        return cells + table * self.cells


def _least(a: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` least values of each row, ascending."""
    return np.argsort(a, axis=1, kind="stable")[:, :count]


# ------------------------------------------------------------ exact scoring


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row; terms are added in order, so a pair's score
    never depends on what it is computed with."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * v[:, j]
    return out


def best(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, v: np.ndarray, v_ids: np.ndarray, k: int):
    """(query places, vector places, scores) of each query's k best vectors
    that reach its floor, by score and vec_id; never a query's own vec_id."""
    found = [], [], []
    if not len(v):
        return np.zeros((2, 0), np.int64)[0], np.zeros((2, 0), np.int64)[0], np.zeros(0)
    by_id = np.argsort(v_ids, kind="stable")
    own = np.searchsorted(v_ids[by_id], q_ids)
    own = np.where(own < len(v_ids), by_id[np.minimum(own, len(v_ids) - 1)], 0)
    length = np.sqrt((v * v).sum(axis=1).max())
    step = max(1, _PAIRS // len(v))
    for a in range(0, len(q), step):
        part = q[a : a + step]
        rough = part @ v.T
        rows = np.flatnonzero(v_ids[own[a : a + step]] == q_ids[a : a + step])
        rough[rows, own[a : a + step][rows]] = -np.inf
        least = floor[a : a + step]
        if len(v) > k:
            least = np.maximum(least, np.partition(rough, len(v) - k, axis=1)[:, len(v) - k])
        # What the matrix product may differ by from the sum in order.
        slack = 4e-16 * q.shape[1] * np.sqrt((part * part).sum(axis=1)) * length
        r, c = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
        score = np.concatenate([np.zeros(0)] + [
            products(part[r[i : i + 65536]], v[c[i : i + 65536]]) for i in range(0, len(r), 65536)
        ])
        order = np.lexsort((v_ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = (place < k) & (score >= floor[a : a + step][r])
        for out, x in zip(found, (r[keep] + a, c[keep], score[keep])):
            out.append(x)
    return tuple(np.concatenate(x) for x in found)


# ------------------------------------------------------------------ columns


def matrix(column, width: int) -> np.ndarray:
    """(rows, width) doubles of a list column; short lists end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _ids(column) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


#: Answers to one query, best first; ``minus`` is the score negated, so that
#: the order of the structs is that of the answers.
FOUND = "found array<struct<minus: double, vec_id: bigint>>"


def packed(n: int, r: np.ndarray, vec_ids: np.ndarray, score: np.ndarray) -> pa.Array:
    """The answers of n queries (r ascending) as a column of lists."""
    ends = np.searchsorted(r, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(ends), pa.StructArray.from_arrays([pa.array(-score), pa.array(vec_ids)], ["minus", "vec_id"])
    )


class Index:
    """Vectors, their measure, the fitted tables and the steps of a search."""

    def __init__(self, vectors: DataFrame, every: int = 20, k: int = 20, functions: int | None = None):
        self.spark, self.k, self.every = vectors.sparkSession, k, every
        ready(self.spark)
        x = F.col("embedding")
        kept = vectors.select(F.col("vec_id").cast("long"), x).filter(
            F.col("vec_id").isNotNull() & finite_vectors(vectors) & ((F.array_max(x) != 0) | (F.array_min(x) != 0))
        )
        # One row per vec_id; vectors are shuffled for that only if some id repeats.
        if not kept.groupBy("vec_id").count().filter("count > 1").isEmpty():
            kept = materialise(kept.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
        self.vectors = kept
        self.kind = kept.schema["embedding"].dataType.simpleString()
        row = self._measured().agg(F.sum("n"), F.max("width"), F.max("longest"), F.min("shortest")).first()
        self.rows, self.width, self.longest = row[0] or 0, row[1] or 1, row[2] or 1.0
        #: Lengths differ: vectors get the coordinate that fills them up.
        self.filled = self.rows > 0 and (row[2] - row[3]) > 1e-6 * row[2]
        self.pool_ids, self.pool = self._pool()
        self.hashes = self._hashes(functions or self.functions_for(self.rows))
        self.probes = 0

    def _measured(self) -> DataFrame:
        """Each task's number of vectors, widest, longest and shortest one."""

        def work(batches):
            n, width, longest, shortest = 0, 0, 0.0, float("inf")
            for batch in batches:
                if not batch.num_rows:
                    continue
                column = batch.column("embedding")
                wide = int(column.value_lengths().to_numpy(zero_copy_only=False).max())
                v = matrix(column, wide)
                size = np.abs(v).max(axis=1)
                length = size * np.sqrt(((v / size[:, None]) ** 2).sum(axis=1))
                n, width = n + len(v), max(width, wide)
                longest, shortest = max(longest, float(length.max())), min(shortest, float(length.min()))
            if n:
                yield pa.record_batch([pa.array([x]) for x in (n, width, longest, shortest)], ["n", "width", "longest", "shortest"])

        return self.vectors.select("embedding").mapInArrow(work, "n long, width long, longest double, shortest double")

    def functions_for(self, rows: int) -> int:
        """The fewest functions that keep usual cells below BLOCK rows."""
        axes, n = CrossPolytope(self.width + self.filled, 1, 1).axes, 1
        while rows > BLOCK * axes**n:
            n += 1
        return n

    def _hashes(self, functions: int) -> CrossPolytope:
        return CrossPolytope(self.width + self.filled, functions)

    def unit(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Rows as the points that are hashed."""
        size = np.abs(v).max(axis=1, keepdims=True, initial=1e-300)
        v = v / size
        length = np.sqrt((v * v).sum(axis=1, keepdims=True))
        if query or not self.filled:
            return np.concatenate([v / length, np.zeros((len(v), int(self.filled)))], axis=1)
        share = length * (size / self.longest)
        return np.concatenate([v / length * share, np.sqrt(np.maximum(1 - share**2, 0))], axis=1)

    def _queries(self) -> DataFrame:
        return self.vectors.filter(F.col("vec_id") % self.every == 0)

    def _first(self, rows: DataFrame, n: int):
        """(ids, matrix) of a bounded, hashed sample."""
        got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect()
        v = np.zeros((len(got), self.width))
        for i, r in enumerate(got):
            v[i, : len(r["embedding"])] = r["embedding"]
        return np.array([r["vec_id"] for r in got], np.int64), v

    def _pool(self):
        return self._first(self.vectors, max(self.k + 1, min(POOL, POOL_BYTES // (8 * self.width))))

    def fit(self) -> None:
        """Set ``probes`` from brute-force answers to sampled queries."""
        q_ids, q = self._first(self._queries(), SAMPLE)
        if not len(q):
            return
        near = self._brute(q_ids, q)
        while True:
            place = self._places(q, near)
            at = int(np.ceil(TARGET * len(place))) - 1
            need = np.sort(place)[at] + 1 if len(place) else 1
            if need <= MOST_PROBES or self.hashes.functions == 1:
                break
            self.hashes = self._hashes(self.hashes.functions - 1)
        self.probes = int(min(need, self.hashes.cells))

    def _brute(self, q_ids: np.ndarray, q: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(place of the query, vector) of the k best of all rows."""
        k, width = self.k, self.width

        def work(batches):
            held = None
            for batch in batches:
                v_ids, v = _ids(batch.column("vec_id")), matrix(batch.column("embedding"), width)
                r, c, score = best(q, q_ids, np.full(len(q), -np.inf), v, v_ids, k)
                new = r, v_ids[c], score, v[c]
                held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
                order = np.lexsort((held[1], -held[2], held[0]))
                r = held[0][order]
                order = order[np.arange(len(r)) - np.searchsorted(r, r) < k]
                held = tuple(x[order] for x in held)
            if held is not None and len(held[0]):
                yield pa.record_batch({
                    "query": pa.array(held[0].astype(np.int32)), "vec_id": pa.array(held[1]), "score": pa.array(held[2]),
                    "vector": pa.array(list(held[3]), pa.list_(pa.float64())),
                })

        schema = "query int, vec_id long, score double, vector array<double>"
        rows = self.vectors.mapInArrow(work, schema).withColumn("_salt", F.spark_partition_id() % 256)
        order = [F.desc("score"), F.asc("vec_id")]
        for keys in (["query", "_salt"], ["query"]):  # in two steps: a query's rows grow with the tasks
            rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= k)
        return [(r["query"], np.array(r["vector"])) for r in rows.select("query", "vector").collect()]

    def _places(self, q: np.ndarray, near) -> np.ndarray:
        """The place of each neighbour's cell in its query's order of cells,
        the least of all tables."""
        h, rows = self.hashes, np.array([i for i, _ in near], np.int64)
        if not len(rows):
            return rows
        points = self.unit(np.array([v for _, v in near]), False)
        out = np.full(len(rows), h.cells)
        asked = self.unit(q, True)
        for t in range(h.tables):
            cell = h.cell(points, t)
            order = h.probes(asked, t, min(MOST_PROBES, h.cells))
            for i in range(len(q)):
                mine = np.flatnonzero(rows == i)
                hit, at = np.nonzero(cell[mine][:, None] == order[i][None, :])
                out[mine[hit]] = np.minimum(out[mine[hit]], at)
        return out

    # ------------------------------------------------------------ search

    def _asked(self) -> DataFrame:
        """Queries with their floor and their best of the pool, written."""
        pool_ids, pool, k, width = self.pool_ids, self.pool, self.k, self.width

        def work(batches):
            for batch in batches:
                q_ids, q = _ids(batch.column("vec_id")), matrix(batch.column("embedding"), width)
                r, c, score = best(q, q_ids, np.full(len(q), -np.inf), pool, pool_ids, k)
                last = np.searchsorted(r, np.arange(len(q)), side="right") - 1
                full = np.bincount(r, minlength=len(q)) == k
                floor = np.full(len(q), -np.inf)
                floor[full] = score[last[full]]
                yield pa.record_batch({
                    "query_id": batch.column("vec_id"), "embedding": batch.column("embedding"), "floor": pa.array(floor),
                    "found": packed(len(q), r, pool_ids[c], score),
                })

        schema = f"query_id long, embedding {self.kind}, floor double, {FOUND}"
        return materialise(self._queries().mapInArrow(work, schema), "asked")

    def _counted(self, asked: DataFrame) -> DataFrame:
        """(cell, blocks, query_blocks) of the cells that need several."""
        per_task = "cell long, n long, asked long"

        def add(batches, cells_of, query):
            seen = {}
            for batch in batches:
                found, n = np.unique(cells_of(matrix(batch.column("embedding"), width)), return_counts=True)
                for c, x in zip(found.tolist(), n.tolist()):
                    seen[c] = seen.get(c, 0) + x
            n = np.array(list(seen.values()), np.int64)
            none = np.zeros(len(n), np.int64)
            yield pa.record_batch({
                "cell": pa.array(np.array(list(seen), np.int64)), "n": pa.array(none if query else n), "asked": pa.array(n if query else none),
            })

        width, cell_rows, probe_rows = self.width, self._cell_rows(), self._probe_rows()
        stored = self.vectors.select("embedding").mapInArrow(lambda b: add(b, cell_rows, False), per_task)
        probed = asked.select("embedding").mapInArrow(lambda b: add(b, probe_rows, True), per_task)
        sums = stored.unionAll(probed).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("asked").alias("asked"))
        blocks = sums.select(
            "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("asked") / QUERY_BLOCK).cast("int").alias("query_blocks"),
        )
        return materialise(blocks.filter("(blocks > 1 or query_blocks > 1) and blocks > 0 and query_blocks > 0"), "cells")

    def _cell_rows(self):
        hashes, unit = self.hashes, _Unit(self)
        return lambda v: np.stack([hashes.cell(unit(v, False), t) for t in range(hashes.tables)], axis=1)

    def _probe_rows(self):
        hashes, unit, n = self.hashes, _Unit(self), self.probes
        return lambda v: np.concatenate([hashes.probes(unit(v, True), t, n) for t in range(hashes.tables)], axis=1)

    def search(self) -> DataFrame:
        """(query_id, rank, vec_id, score)."""
        asked = self._asked()
        found = asked.select("query_id", "found")
        if self.probes and self.rows > len(self.pool_ids):
            found = found.unionAll(self._met(asked))
        # A vector is found once in each table and in the pool, at most.
        most = self.k * (self.hashes.tables + 1)
        merged = found.groupBy("query_id").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("x"))
        best_k = F.slice(F.array_distinct(F.slice("x", 1, most)), 1, self.k)
        return merged.select("query_id", F.posexplode(best_k).alias("place", "x")).select(
            "query_id", (F.col("place") + 1).alias("rank"), "x.vec_id", (-F.col("x.minus")).alias("score")
        )

    def _met(self, asked: DataFrame) -> DataFrame:
        """Vectors and queries brought together by cell."""
        k, width, cell_rows, probe_rows = self.k, self.width, self._cell_rows(), self._probe_rows()

        def store(batches):
            for batch in batches:
                cells = cell_rows(matrix(batch.column("embedding"), width))
                for t in range(cells.shape[1]):
                    yield pa.record_batch({
                        "cell": pa.array(cells[:, t]), "vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"),
                    })

        def probe(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    part = batch.slice(a, 256)
                    cells = probe_rows(matrix(part.column("embedding"), width))
                    again = pa.array(np.repeat(np.arange(len(cells)), cells.shape[1]))
                    yield pa.record_batch({
                        "cell": pa.array(cells.reshape(-1)),
                        **{c: part.column(c).take(again) for c in ("query_id", "floor", "embedding")},
                    })

        stored = self.vectors.mapInArrow(store, f"cell long, vec_id long, embedding {self.kind}")
        probed = asked.select("query_id", "floor", "embedding").mapInArrow(
            probe, f"cell long, query_id long, floor double, embedding {self.kind}"
        )
        large = self._counted(asked)
        keys = ["cell", "block", "query_block"]

        def dealt(rows, own, by, other, each):
            """Rows in a block of their own, once for every block they meet."""
            joined = join_small(rows, large, "cell", spread=by)
            return joined.withColumn(own, F.pmod(F.xxhash64(by), F.coalesce(f"{own}s", F.lit(1))).cast("int")).withColumn(
                other, F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}s", F.lit(1)) - 1))
            ).select(*keys, *each)

        left = dealt(stored, "block", "vec_id", "query_block", ["vec_id", "embedding"])
        right = dealt(probed, "query_block", "query_id", "block", ["query_id", "floor", "embedding"])

        def meet(v: pa.Table, q: pa.Table) -> pa.Table:
            if not v.num_rows or not q.num_rows:
                return pa.table({"query_id": pa.array([], pa.int64()), "found": packed(0, *np.zeros((2, 0), np.int64), np.zeros(0))})
            v_ids, q_ids = _ids(v.column("vec_id")), _ids(q.column("query_id"))
            r, c, score = best(matrix(q.column("embedding"), width), q_ids, _ids(q.column("floor")),
                               matrix(v.column("embedding"), width), v_ids, k)
            some, r = np.unique(r, return_inverse=True)  # queries that found something
            return pa.table({"query_id": pa.array(q_ids[some]), "found": packed(len(some), r, v_ids[c], score)})

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, f"query_id long, {FOUND}")


class _Unit:
    """``Index.unit`` for tasks: the numbers without the tables."""

    def __init__(self, index: Index):
        self.filled, self.longest = index.filled, index.longest

    def __call__(self, v: np.ndarray, query: bool) -> np.ndarray:
        return Index.unit(self, v, query)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, functions: int | None = None) -> DataFrame:
    """The ``k`` nearest rows, by inner product, of each row whose vec_id is
    divisible by ``every``: (query_id, rank, vec_id, score)."""
    index = Index(vectors, every, k, functions)
    index.fit()
    return index.search()


def brute_force(vectors: list[tuple[int, list[float]]], every: int = 20, k: int = 20):
    """{query_id: [(vec_id, score)]} by comparing everything, for tests."""
    ids = np.array([i for i, _ in vectors], np.int64)
    v = np.zeros((len(vectors), max((len(x) for _, x in vectors), default=1)))
    for i, (_, x) in enumerate(vectors):
        v[i, : len(x)] = x
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        others = np.flatnonzero(ids != ids[i])
        score = products(np.broadcast_to(v[i], (len(others), v.shape[1])), v[others])
        order = np.lexsort((ids[others], -score))[:k]
        out[int(ids[i])] = [(int(ids[others][j]), float(score[j])) for j in order]
    return out

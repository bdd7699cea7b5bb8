"""Product codes of vectors: exact integer k-means with adaptive bounds.

Vectors become whole numbers, are cut into parts, and each part position
learns a codebook by Lloyd rounds. Rounds after the first hardly look at
distances (Drake and Hamerly's adaptive bounds): each part keeps its entry
with an upper bound, the ``b`` next closest entries with ordered lower
bounds, and one outer bound for all other entries. When entries move, bounds
move by at most as much; a part whose upper bound stays below all lower ones
keeps its entry unseen. Otherwise the distance to its entry is taken anew, and if that
does not decide, just the leading entries whose bounds do not exceed it are
compared by exact integer distances, or all of them if the outer bound
fails too. Bounds are rounded outwards and compared strictly, so codes,
ties to the lower index included, are those of the plain computation.
``b`` shrinks to what the round before needed.

The state of a round (numbers, entries, bounds) is a written table, read by
the next round and then deleted: a lost executor repeats one round's task.
Vectors are never shuffled; a round adds up PARTS x ENTRIES sums per task.

Defined cases: vectors that are null or hold null, NaN or infinite
components are dropped; vectors shorter than the longest, and a length that
is no multiple of PARTS, are filled up with zeros; whole numbers are kept
within a range in which squared distances fit 64 bits (for vectors of 64
components: components up to 32,768); fewer kept vectors than ENTRIES give
so many entries; repeated and null vec_ids are rows like others (in the
codebooks' start nulls come last, equal ids by their vectors); an empty
table gives an empty result; only ``vec_id``, ``embedding`` and ``label``
are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import remove_path
from .common import finite_vectors, join_small, new_scratch, ready

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Next closest entries with a bound of their own: at the start, and least.
START_B, LEAST_B = ENTRIES // 4, ENTRIES // 8
#: Share of the undecided parts that the next b must cover.
COVERED = 0.95
_UP, _DOWN = 1 + 1e-15, 1 - 1e-15


def limit_for(width: int) -> int:
    """Largest whole number of a component: the squared distance of two
    vectors of ``width`` such components stays below 2**63."""
    return 1 << min(30, (60 - max(width - 1, 0).bit_length()) // 2)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, candidates) of parts (n, m) from entries
    (candidates, m), the same for all, or (n, candidates, m)."""
    diff = x[:, None, :] - entries
    return np.einsum("ncm,ncm->nc", diff, diff)


class Bounds:
    """One part position of a run of vectors: ``near`` (n, 1 + b) entries,
    the own one first; ``lower`` (n, b), ``outer`` (n), ``upper`` (n); ``need`` (n)
    is how many entries the last round had to compare beyond the own one
    (0: none, b + 1: all)."""

    def __init__(self, near, lower, outer, upper, need=None):
        self.near, self.lower, self.outer, self.upper = near, lower, outer, upper
        self.need = np.zeros(len(near), np.uint8) if need is None else need

    @classmethod
    def fresh(cls, x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """From all distances."""
        k = len(entries)
        d = distances(x, entries)
        order = np.argsort(d, axis=1, kind="stable")  # stable: ties to the lower index
        far = np.sqrt(np.take_along_axis(d, order, 1))
        b = min(b, k - 1)
        outer = far[:, b + 1] * _DOWN if b + 1 < k else np.full(len(x), np.inf)
        return cls(order[:, : b + 1].astype(np.int8), far[:, 1 : b + 1] * _DOWN, outer, far[:, 0] * _UP,
                   np.full(len(x), k, np.uint8))

    def narrowed(self, b: int) -> Bounds:
        """With ``b`` entries at most: the bounds of the others join the outer one."""
        if b >= self.lower.shape[1]:
            return self
        outer = np.minimum(self.outer, self.lower[:, b:].min(axis=1))
        return Bounds(self.near[:, : b + 1], self.lower[:, :b], outer, self.upper, self.need)

    def advance(self, x: np.ndarray, entries: np.ndarray, moves: np.ndarray) -> Bounds:
        """The state after entries moved by ``moves`` (rounded up) to ``entries``."""
        near, b = self.near.copy(), self.lower.shape[1]
        upper = np.nextafter(self.upper + moves[near[:, 0]], np.inf)
        lower = np.nextafter(self.lower - moves[near[:, 1:]], -np.inf)
        outer = np.nextafter(self.outer - moves.max(initial=0.0), -np.inf)
        # least[:, j]: no entry from place j + 1 on is closer.
        least = np.minimum.accumulate(np.column_stack([lower, outer])[:, ::-1], axis=1)[:, ::-1]
        need = np.zeros(len(x), np.uint8)
        open_ = np.flatnonzero(upper >= least[:, 0])
        own = x[open_] - entries[near[open_, 0]]
        upper[open_] = np.sqrt(np.einsum("nm,nm->n", own, own)) * _UP
        need[open_] = (least[open_] <= upper[open_, None]).sum(axis=1)
        for n in range(1, b + 1):
            rows = np.flatnonzero(need == n)
            if not len(rows):
                continue
            cand = near[rows, : n + 1]
            d = distances(x[rows], entries[cand])
            order = np.lexsort((cand, d), axis=1)
            near[rows, : n + 1] = np.take_along_axis(cand, order, 1)
            far = np.sqrt(np.take_along_axis(d, order, 1))
            upper[rows], lower[rows, :n] = far[:, 0] * _UP, far[:, 1:] * _DOWN
        rows = np.flatnonzero(need == b + 1)
        if len(rows):
            anew = Bounds.fresh(x[rows], entries, b)
            near[rows], lower[rows], outer[rows], upper[rows] = anew.near, anew.lower, anew.outer, anew.upper
        return Bounds(near, lower, outer, upper, need)


# ------------------------------------------------------------- table layout

STATE = ("vec array<int>, near array<tinyint>, lower array<float>, outer array<float>, upper array<float>, "
         "need array<tinyint>")


def _flat(column, dtype) -> np.ndarray:
    """(rows, width) of a list column whose lists have one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = len(values), int(np.prod(values.shape[1:]))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), kind))


def whole_numbers(column, width: int) -> np.ndarray:
    """(rows, width) whole numbers of a column of finite vectors."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    limit = limit_for(width)
    flat = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE), -limit, limit)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat.astype(np.int64)
    return out


def _outward32(values: np.ndarray, towards: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(values.astype(np.float32), np.float32(towards))


def _state_batch(batch: pa.RecordBatch, x: np.ndarray, parts: list[Bounds]) -> pa.RecordBatch:
    stack = lambda name: np.stack([getattr(p, name) for p in parts], axis=1)
    return pa.record_batch({
        "vec_id": batch.column("vec_id"), "label": batch.column("label"), "vec": _lists(x.astype(np.int32), pa.int32()),
        "near": _lists(stack("near"), pa.int8()), "lower": _lists(_outward32(stack("lower"), -np.inf), pa.float32()),
        "outer": _lists(_outward32(stack("outer"), -np.inf), pa.float32()),
        "upper": _lists(_outward32(stack("upper"), np.inf), pa.float32()), "need": _lists(stack("need").astype(np.int8), pa.int8()),
    })


def _parts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, list[Bounds]]:
    n = batch.num_rows
    x = _flat(batch.column("vec"), np.int64)
    near = _flat(batch.column("near"), np.int8).reshape(n, PARTS, -1)
    lower, outer, upper = (_flat(batch.column(c), np.float64).reshape(n, PARTS, -1) for c in ("lower", "outer", "upper"))
    return x, [Bounds(near[:, p], lower[:, p], outer[:, p, 0], upper[:, p, 0]) for p in range(PARTS)]


def _cut(x: np.ndarray, p: int) -> np.ndarray:
    size = x.shape[1] // PARTS
    return x[:, p * size : (p + 1) * size]


def _moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.sqrt(((new - old) ** 2).sum(axis=2)) * _UP


def codebook_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


class Codes:
    """Codebooks and the written state of the rounds so far."""

    def __init__(self, vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS):
        self.spark = vectors.sparkSession
        ready(self.spark)
        self.kept = vectors.select("vec_id", "label", "embedding").filter(finite_vectors(vectors))
        longest = self.kept.agg(F.max(F.size("embedding"))).first()[0]
        self.width = max(-(-(longest or 0) // PARTS), 1) * PARTS
        first = self.kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding").limit(entries).collect()
        start = whole_numbers(pa.array([list(r[0]) for r in first], pa.list_(pa.float64())), self.width)
        #: (PARTS, entries, size)
        self.codebooks = np.stack([_cut(start, p) for p in range(PARTS)])
        self.id_types = ", ".join(f"{c} {self.kept.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
        self.path, self.b, self.needs = None, START_B, []
        self.moves = None
        if not len(start):
            return
        for _ in range(rounds):
            self._assign()
            before = self.codebooks
            self.codebooks = self._updated()
            self.moves = _moves(before, self.codebooks)
            if not self.moves.any():  # all further rounds would repeat this one
                break

    def _write(self, rows: DataFrame) -> None:
        path, old = new_scratch(self.spark, "vector-codes"), self.path
        rows.write.parquet(path)
        self.path = path
        if old:
            remove_path(self.spark, old)

    def _state(self) -> DataFrame:
        return self.spark.read.schema(f"{self.id_types}, {STATE}").parquet(self.path)

    def _assign(self) -> None:
        """The next round's state: parts get their closest entries."""
        codebooks, moves, width, b = self.codebooks, self.moves, self.width, self.b

        def start(batches):
            for batch in batches:
                x = whole_numbers(batch.column("embedding"), width)
                yield _state_batch(batch, x, [Bounds.fresh(_cut(x, p), codebooks[p], b) for p in range(PARTS)])

        def step(batches):
            for batch in batches:
                x, parts = _parts_of(batch)
                yield _state_batch(batch, x, [
                    part.narrowed(b).advance(_cut(x, p), codebooks[p], moves[p]) for p, part in enumerate(parts)
                ])

        source, work = (self.kept, start) if self.path is None else (self._state(), step)
        self._write(source.mapInArrow(work, f"{self.id_types}, {STATE}"))

    def _updated(self) -> np.ndarray:
        """The entries' new places from the sums of their parts; sets ``b``."""
        entries, size = self.codebooks.shape[1:]
        cells = PARTS * entries

        def add(batches):
            total, needs = np.zeros((cells, size + 1), np.int64), np.zeros(entries + 1, np.int64)
            for batch in batches:
                x, near = _flat(batch.column("vec"), np.int64), _flat(batch.column("near"), np.int64)
                if not len(x):
                    continue
                own = near.reshape(len(x), PARTS, -1)[:, :, 0]
                needs += np.bincount(_flat(batch.column("need"), np.int64).reshape(-1), minlength=entries + 1)
                for p in range(PARTS):
                    cell, part = p * entries + own[:, p], _cut(x, p)
                    total[:, size] += np.bincount(cell, minlength=cells)
                    for j in range(size):  # sums of whole numbers below 2**53: exact in doubles
                        total[:, j] += np.bincount(cell, part[:, j], minlength=cells).astype(np.int64)
            cell, at = np.nonzero(total)
            held = np.flatnonzero(needs)
            yield pa.record_batch({
                "cell": pa.array(np.append(cell, np.full(len(held), -1)).astype(np.int32)),
                "at": pa.array(np.append(at, held).astype(np.int32)), "n": pa.array(np.append(total[cell, at], needs[held])),
            })

        sums = self._state().select("vec", "near", "need").mapInArrow(add, "cell int, at int, n long")
        total, needs = np.zeros((cells, size + 1), np.int64), np.zeros(entries + 1, np.int64)
        for r in sums.groupBy("cell", "at").agg(F.sum("n").alias("n")).collect():  # bounded by the codebooks' size
            if r["cell"] < 0:
                needs[r["at"]] = r["n"]
            else:
                total[r["cell"], r["at"]] = r["n"]
        self._adapt(needs)
        count = total[:, size :]
        moved = np.where(count > 0, total[:, :size] // np.maximum(count, 1), self.codebooks.reshape(cells, size))
        return moved.reshape(PARTS, entries, size)

    def _adapt(self, needs: np.ndarray) -> None:
        """b shrinks to the places that nearly all undecided parts needed;
        those that needed every entry say nothing about b."""
        self.needs.append(needs)
        some = needs[1 : self.b + 1]
        if self.moves is not None and some.sum():
            self.b = max(min(self.b, int(np.searchsorted(np.cumsum(some), COVERED * some.sum())) + 1), min(LEAST_B, self.b))

    def result(self) -> DataFrame:
        """(vec_id, label, code, error) by the final codebooks, written."""
        schema = f"{self.id_types}, code string, error long"
        if self.path is None:
            return self.spark.createDataFrame([], schema)
        codebooks, moves = self.codebooks, self.moves

        def last(batches):
            for batch in batches:
                x, parts = _parts_of(batch)
                own = np.zeros((len(x), PARTS), np.uint8)
                error = np.zeros(len(x), np.int64)
                for p, part in enumerate(parts):
                    cut = _cut(x, p)
                    own[:, p] = part.advance(cut, codebooks[p], moves[p]).near[:, 0]
                    diff = cut - codebooks[p][own[:, p]]
                    error += (diff * diff).sum(axis=1)
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                    "code": pa.array([row.tobytes().hex() for row in own], pa.string()), "error": pa.array(error),
                })

        self._write(self._state().mapInArrow(last, schema))
        return self.spark.read.schema(schema).parquet(self.path)


def vector_codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row."""
    codes = Codes(vectors, entries, rounds)
    rows = codes.result()
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_small(rows, by_label, "label", spread="vec_id").select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(codes.codebooks)).alias("codebooks_sha256")
    )

"""MinHash near-duplicate detection by min-max hashing.

Every hash function gives two signature values, the smallest and the
largest hash over a document's shingles; both are unbiased match tests for
the Jaccard similarity, so half the hash evaluations fill the signature.

1. One pass over the texts makes a narrow table: shingle count, a 128-bit
   fingerprint of the shingle set, band keys. Documents with equal sets
   become one representative (smallest ``doc_id``).
2. Representatives that share a band key form candidate groups: links to
   the band's smallest member, then connected components. A true link is
   missed only if no band agrees: (1 - s^rows)^bands, 7e-11 at s = 0.85
   with the defaults.
3. Within a candidate group, links are confirmed on the full sets. A large
   group is dealt out as pairs of blocks over many tasks; a task multiplies
   two incidence matrices and returns only a spanning forest of the links it
   finds, so its output is linear however many copies there are.
4. Connected components of these links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnp as T
from .common import materialise, ready, release
from .components import connected_components

SEED = 7
#: Bounds of one block of a candidate group.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 400_000
_LOCAL = np.uint64(0xD6E8FEB86659FD93)


def _shingle_sets(column: pa.Array, size: int):
    """(hashes, first): the sorted distinct shingle hashes of each text, one
    after the other; texts with fewer words than ``size`` have their whole
    word sequence as one shingle, texts without words none."""
    data, offsets = T.text_buffer(column)
    starts, ends, first = T.word_spans(data, offsets)
    words = T.word_hashes(data, starts, ends, fold_case=True)
    wide = T.window_hashes(words, size)
    out, bounds = [], [0]
    for i in range(len(column)):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            out.append(np.unique(wide[a : b - size + 1]))
        elif b > a:
            out.append(T.window_hashes(words[a:b], int(b - a)) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
        bounds.append(bounds[-1] + len(out[-1]))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(bounds, np.int64)


def _signatures(size: int, rows: int, bands: int):
    n_hashes = -(-rows * bands // 2)
    rng = np.random.default_rng(SEED)
    shifts = rng.integers(0, 2**63, n_hashes, dtype=np.uint64)
    factors = rng.integers(0, 2**63, n_hashes, dtype=np.uint64) | np.uint64(1)
    weights = rng.integers(0, 2**63, rows, dtype=np.uint64) | np.uint64(1)
    salts = rng.integers(0, 2**63, bands, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            for part in T.pieces(batch, "text"):
                hashes, bounds = _shingle_sets(part.column("text"), size)
                counts = np.diff(bounds)
                full = np.flatnonzero(counts)
                low, high = np.zeros((2, part.num_rows), np.uint64)
                keys = np.zeros((part.num_rows, bands), np.uint64)
                if len(full):
                    at = bounds[full]
                    low[full] = np.add.reduceat(T.mix(hashes), at)
                    high[full] = np.add.reduceat(T.mix(hashes ^ _LOCAL), at)
                    values = np.empty((len(full), 2 * n_hashes), np.uint64)
                    for k in range(n_hashes):
                        v = (hashes ^ shifts[k]) * factors[k]
                        values[:, 2 * k] = np.minimum.reduceat(v, at)
                        values[:, 2 * k + 1] = np.maximum.reduceat(v, at)
                    for j in range(bands):
                        keys[full, j] = T.mix(T.mix(values[:, j * rows : (j + 1) * rows]) @ weights + salts[j])
                flat = pa.array(keys.reshape(-1).view(np.int64))
                offsets = pa.array(np.where(counts > 0, 1, 0).cumsum() * bands, pa.int32())
                offsets = pa.concat_arrays([pa.array([0], pa.int32()), offsets])
                flat = flat if len(full) == part.num_rows else pa.array(keys[full].reshape(-1).view(np.int64))
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array(counts.astype(np.int64)),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    names=["doc_id", "n_shingles", "fp_low", "fp_high", "bands"],
                )

    return run


_SIGNATURE = "doc_id long, n_shingles long, fp_low long, fp_high long, bands array<long>"


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, from incidence
    matrices over the elements that both sides hold, some columns at a time."""
    out = np.zeros((len(left), len(right)), np.int64)
    lv, rv = np.concatenate(left), np.concatenate(right)
    lr = np.repeat(np.arange(len(left)), [len(x) for x in left])
    rr = np.repeat(np.arange(len(right)), [len(x) for x in right])
    shared = np.intersect1d(lv, rv)
    if not len(shared):
        return out

    def places(values, rows):
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        hit = shared[at] == values
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], rows[hit][order]

    (lc, lr), (rc, rr) = places(lv, lr), places(rv, rr)
    step = max(256, 2_000_000 // (len(left) + len(right)))
    for a in range(0, len(shared), step):
        i, j = np.searchsorted(lc, [a, a + step]), np.searchsorted(rc, [a, a + step])
        x = np.zeros((len(left), step), np.float32)
        y = np.zeros((len(right), step), np.float32)
        x[lr[i[0] : i[1]], lc[i[0] : i[1]] - a] = 1
        y[rr[j[0] : j[1]], rc[j[0] : j[1]] - a] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _confirm(rows: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Spanning links among the documents of one block pair. rows: (side,
    doc_id, shingle set); side 2 stands for a block paired with itself."""
    if len(rows) < 2:
        return []
    left = [r for r in rows if r[0] != 1]
    right = [r for r in rows if r[0] != 0]
    if not left or not right:
        return []
    inter = _intersections([r[2] for r in left], [r[2] for r in right])
    nl = np.array([len(r[2]) for r in left])
    nr = np.array([len(r[2]) for r in right])
    linked = 100 * inter >= percent * (nl[:, None] + nr[None, :] - inter)
    linked &= inter > 0
    forest, out = _Forest(), []
    for i, j in zip(*np.nonzero(linked)):
        a, b = left[i][1], right[j][1]
        if a != b and forest.join(a, b):
            out.append((min(a, b), max(a, b)))
    return out


def _links(size: int, percent: int):
    def run(batches):
        key, rows, done = None, [], []
        for batch in batches:
            for part in T.pieces(batch, "text"):
                hashes, bounds = _shingle_sets(part.column("text"), size)
                ids = part.column("doc_id").to_pylist()
                keys = list(zip(*(part.column(c).to_pylist() for c in ("group", "left", "right"))))
                sides = part.column("side").to_pylist()
                for i, k in enumerate(keys):
                    if k != key:
                        done += _confirm(rows, percent)
                        key, rows = k, []
                    rows.append((sides[i], ids[i], hashes[bounds[i] : bounds[i + 1]].copy()))
            if len(done) > 10_000:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*done)], names=["a", "b"])
                done = []
        done += _confirm(rows, percent)
        if done:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*done)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = 5, bands: int = 48) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles,
    component_id, kept.

    Documents are linked when ``100 * |A n B| >= percent * |A u B|`` over
    their sets of ``shingle``-word shingles (A-Z lower-cased). A null or
    wordless text has the empty set and is linked with nothing. Rows that
    share a doc_id are one node of the link graph. A row without doc_id is
    linked with nothing: its component_id is null, kept is true. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ready(spark)
    slim = docs.select("doc_id", "text")
    sig = materialise(slim.mapInArrow(_signatures(shingle, rows, bands), _SIGNATURE), "signatures")
    known = sig.filter("doc_id is not null and n_shingles > 0")
    sets = known.groupBy("fp_low", "fp_high", "n_shingles").agg(F.min("doc_id").alias("rep"))
    node = materialise(
        known.select("doc_id", "fp_low", "fp_high", "n_shingles").join(sets, ["fp_low", "fp_high", "n_shingles"])
        .select("doc_id", "rep", "n_shingles").distinct(),
        "nodes",
    )
    reps = node.filter("doc_id = rep").select("doc_id")
    banded = known.join(reps, "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("band"))
    band = banded.groupBy("band").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")
    ).filter("low < high")
    band = materialise(band, "band_keys")
    pairs = band.filter("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    large = band.filter("n > 2").select("band", F.col("low").alias("a"))
    stars = banded.join(large, "band").select("a", F.col("doc_id").alias("b"))
    group = connected_components(pairs.union(stars).distinct())
    release(spark)

    # Blocks: as many as a group's documents and shingles call for.
    member = group.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "group")
    member = member.join(node.filter("doc_id = rep").select("doc_id", "n_shingles"), "doc_id")
    blocks = member.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count("*") / F.lit(BLOCK_DOCS)), F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES))
        ).cast("int").alias("n_blocks")
    ).filter("n_blocks > 1")
    member = member.select("doc_id", "group").join(blocks, "group", "left")
    n_blocks = F.coalesce("n_blocks", F.lit(1))
    member = member.withColumn("block", F.pmod(F.xxhash64("doc_id"), n_blocks).cast("int"))
    member = materialise(member.select("doc_id", "group", n_blocks.alias("n_blocks"), "block"), "members")
    placed = slim.join(member, "doc_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    placed = placed.select(
        "doc_id", "text", "group",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    placed = placed.repartition("group", "left", "right").sortWithinPartitions("group", "left", "right")
    links = placed.mapInArrow(_links(shingle, percent), "a long, b long")
    component = connected_components(links)
    release(spark)

    rep_of = materialise(node.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last")), "reps")
    twice = rep_of.filter("rep < last").select(F.col("rep").alias("a"), F.col("last").alias("b"))
    if twice.limit(1).count():  # a doc_id with several texts joins their classes
        also = component.select(F.col("component").alias("a"), F.col("node").alias("b"))
        component = connected_components(twice.union(also))
    final = rep_of.join(component, rep_of["rep"] == component["node"], "left").select(
        F.col("doc_id").alias("_id"), F.coalesce("component", "rep").alias("component_id")
    )
    base = sig.select("doc_id", "n_shingles")
    out = base.join(final, base["doc_id"] == final["_id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one document of each group (the smallest doc_id); rows
    without doc_id stay, repeated rows of one doc_id and text become one.
    Different texts under one doc_id are documents of their own: all but one
    of them count as documents with large ids (62-bit hashes)."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("text"))
    named = rows.filter("id is not null").withColumn("mark", F.xxhash64("text"))
    several = named.groupBy("id").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).filter("low < high")
    several = materialise(several.select(F.col("id").alias("several_id"), "low"), "several_texts")
    key = F.col("id")
    if several.limit(1).count():
        named = named.join(several, named["id"] == several["several_id"], "left")
        own = F.xxhash64("id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        key = F.when(F.col("mark") != F.col("low"), own).otherwise(key)
    keyed = named.select("row", "text", key.alias("key"))
    kept = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"), **params).filter("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    named = keyed.join(kept, keyed["key"] == kept["kept_id"], "left_semi").dropDuplicates(["key"])
    return named.select("row.*").unionByName(docs.filter("doc_id is null"))

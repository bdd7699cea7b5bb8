"""Substring de-duplication by level-wise doubling of word windows.

A window of ``length`` words that occurs twice has two halves that occur
twice, so only windows built on repeated halves are looked at again.

* Level 1 (half length): each full-length window names one of its half
  windows, the one with the smallest hash, so about every sixth half window
  is named. One aggregate finds, for each named hash, in how many documents
  it occurs.
* Level 2 (full length): only windows whose named half is repeated are
  hashed and aggregated to the first document that holds them.

There are these two levels and no more: repeats are decided by full windows,
and longer ones are runs of them. Both levels send back to a document
what *it alone* (level 1) or *it first* (level 2) holds, and the document
subtracts that from what it computes itself. So both levels are aggregates
over (hash -> smallest doc_id) with map-side combine: a passage in a third
of all documents is no hot key, and no list of occurrences is ever built.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import textnp as T
from .common import materialise, ready, release


def _parts(batch: pa.RecordBatch, window: int):
    """Per run of rows: (rows, bytes, word starts, ends, first, half hashes,
    window starts, the window's text index, the named half of each window)."""
    half = window // 2
    for rows in T.pieces(batch, "text"):
        data, offsets = T.text_buffer(rows.column("text"))
        starts, ends, first = T.word_spans(data, offsets)
        words = T.word_hashes(data, starts, ends)
        halves = T.window_hashes(words, half)
        text, at = T.windows_inside(first, window)
        named = at
        if len(at):
            span = window - half + 1
            # Smallest of the window's half hashes, leftmost at ties.
            best = np.arange(len(halves) - span + 1)
            low = halves[: len(best)].copy()
            for k in range(1, span):
                other = halves[k : k + len(best)]
                less = other < low
                best[less] = np.flatnonzero(less) + k
                low[less] = other[less]
            named = best[at]
        yield rows, data, starts, ends, first, words, halves, at, text, named


def _levels(words: np.ndarray, halves: np.ndarray, window: int) -> np.ndarray:
    """Full-window hashes from the half-window hashes by one doubling."""
    half = window // 2
    m = len(words) - window + 1
    full = T.joined(halves[:m], halves[half : half + m])
    if window % 2:
        full = T.joined(full, words[window - 1 : window - 1 + m])
    return full


def _check(words: np.ndarray, window: int) -> np.ndarray:
    """A second, independent hash of each window (32 bits)."""
    return (T.window_hashes(T.mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5)), window) >> np.uint64(33)).astype(np.int32)


def _named(window: int):
    """(h, doc_id) of the half windows each document names, once each."""

    def run(batches):
        for batch in batches:
            for rows, _, _, _, _, _, halves, at, text, named in _parts(batch, window):
                if not len(at):
                    continue
                fresh = np.ones(len(named), bool)
                fresh[1:] = (named[1:] != named[:-1]) | (text[1:] != text[:-1])
                hashes, text = halves[named[fresh]], text[fresh]
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                keep = np.ones(len(hashes), bool)
                keep[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                ids = rows.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.record_batch(
                    [pa.array(hashes[keep].view(np.int64)), pa.array(ids[text[keep]].astype(np.int64))],
                    names=["h", "doc_id"],
                )

    return run


def _carried(rows: pa.RecordBatch) -> tuple[list, list]:
    """The carried column, if there is one, and its name."""
    at = rows.schema.get_field_index("carry")
    return ([rows.column(at)], ["carry"]) if at >= 0 else ([], [])


def _candidates(window: int, keep_text: bool):
    """Documents with the starts of candidate windows; a document without
    any is finished here: its digest is set and, unless ``keep_text``, its
    text is dropped."""

    def run(batches):
        for batch in batches:
            for rows, data, starts, ends, first, words, halves, at, text, named in _parts(batch, window):
                n = rows.num_rows
                lonely = rows.column("singles")
                copy = rows.column("is_copy").to_pylist()
                texts = rows.column("text").to_pylist()
                split = np.searchsorted(text, np.arange(n + 1))
                out_text, out_at, digest, gone = [], [], [], []
                for i in range(n):
                    a, b = split[i], split[i + 1]
                    where = np.zeros(0, np.int64)
                    if b > a and not copy[i]:
                        single = lonely[i].values
                        single = np.zeros(0, np.uint64) if single is None else single.to_numpy().view(np.uint64)
                        # A half window that this document alone names, and
                        # names in one place only, is not repeated.
                        places, use = np.unique(named[a:b], return_inverse=True)
                        hashes, inverse, times = np.unique(halves[places], return_inverse=True, return_counts=True)
                        alone = (np.isin(hashes, single) & (times == 1))[inverse]
                        where = at[a:b][~alone[use]] - first[i]
                    if len(where):
                        out_text.append(texts[i])
                        out_at.append(where.astype(np.int32).tobytes())
                        digest.append(None)
                        gone.append(0)
                        continue
                    covered = b > a and copy[i]
                    raw = b"" if covered else _joined((texts[i] or "").encode())
                    out_at.append(None)
                    digest.append(hashlib.sha256(raw).hexdigest())
                    gone.append(int(first[i + 1] - first[i]) if covered else 0)
                    out_text.append(("" if covered else texts[i]) if keep_text else None)
                carry, name = _carried(rows)
                yield pa.record_batch(
                    [
                        rows.column("doc_id"),
                        pa.array(out_text, pa.string()),
                        pa.array(out_at, pa.binary()),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(gone, pa.int64()),
                        pa.array(digest, pa.string()),
                        *carry,
                    ],
                    names=["doc_id", "text", "at", "n_words", "n_removed", "kept_sha256", *name],
                )

    return run


_WHITE_TABLE = bytes(0x20 if c in (0x20, *range(0x09, 0x0E)) else c for c in range(256))


def _joined(raw: bytes) -> bytes:
    """All words of a text joined by one space."""
    return b" ".join(filter(None, raw.translate(_WHITE_TABLE).split(b" ")))


_CANDIDATES = "doc_id long, text string, at binary, n_words long, n_removed long, kept_sha256 string"


def _full_hashes(rows: pa.RecordBatch, window: int):
    """Per row of a candidate table: (row, its bytes, word starts, ends,
    candidate starts, their hashes, their check hashes)."""
    data, offsets = T.text_buffer(rows.column("text"))
    starts, ends, first = T.word_spans(data, offsets)
    words = T.word_hashes(data, starts, ends)
    halves = T.window_hashes(words, window // 2)
    full = _levels(words, halves, window)
    check = _check(words, window)
    at = rows.column("at").to_pylist()
    for i in range(rows.num_rows):
        a, b = first[i], first[i + 1]
        where = np.frombuffer(at[i], np.int32).astype(np.int64)
        low = offsets[i]
        own = data[low : offsets[i + 1]]
        yield i, own, starts[a:b] - low, ends[a:b] - low, where, full[a + where], check[a + where]


def _whole(window: int):
    """(h, g, doc_id) of the candidate windows, once per document."""

    def run(batches):
        for batch in batches:
            for rows in T.pieces(batch, "text"):
                ids = rows.column("doc_id").to_pylist()
                hs, gs, owner = [], [], []
                for i, _, _, _, _, full, check in _full_hashes(rows, window):
                    order = np.lexsort((check, full))
                    full, check = full[order], check[order]
                    keep = np.ones(len(full), bool)
                    keep[1:] = (full[1:] != full[:-1]) | (check[1:] != check[:-1])
                    hs.append(full[keep]), gs.append(check[keep])
                    owner.append(np.full(int(keep.sum()), ids[i], np.int64))
                if hs:
                    yield pa.record_batch(
                        [
                            pa.array(np.concatenate(hs).view(np.int64)),
                            pa.array(np.concatenate(gs)),
                            pa.array(np.concatenate(owner)),
                        ],
                        names=["h", "g", "doc_id"],
                    )

    return run


def _remove(window: int, keep_text: bool):
    """Drop every word covered by a window that starts earlier elsewhere."""

    def run(batches):
        for batch in batches:
            for rows in T.pieces(batch, "text"):
                ids = rows.column("doc_id")
                own = rows.column("firsts")
                out_text, digest, gone = [], [], []
                for i, data, starts, ends, where, full, check in _full_hashes(rows, window):
                    mine = own[i].values
                    mine = np.zeros(0, np.uint64) if mine is None else mine.to_numpy().view(np.uint64)
                    earlier = ~np.isin(full, mine)
                    seen = np.ones(len(full), bool)
                    order = np.lexsort((where, check, full))
                    f, c = full[order], check[order]
                    seen[order[0]] = False
                    seen[order[1:]] = (f[1:] == f[:-1]) & (c[1:] == c[:-1])
                    hit = where[earlier | seen]
                    cover = np.zeros(len(starts) + 1, np.int64)
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + window, -1)
                    drop = np.cumsum(cover[:-1]) > 0
                    gone.append(int(drop.sum()))
                    buffer = memoryview(data)
                    kept = [bytes(buffer[a:b]) for a, b in zip(starts[~drop].tolist(), ends[~drop].tolist())]
                    digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                    out_text.append(_cut(data, starts, drop) if keep_text else None)
                carry, name = _carried(rows)
                yield pa.record_batch(
                    [
                        ids,
                        pa.array(out_text, pa.string()),
                        rows.column("n_words"),
                        pa.array(gone, pa.int64()),
                        pa.array(digest, pa.string()),
                        *carry,
                    ],
                    names=["doc_id", "text", "n_words", "n_removed", "kept_sha256", *name],
                )

    return run


def _cut(data: np.ndarray, starts: np.ndarray, drop: np.ndarray) -> str:
    """The text without its dropped words; each goes with the white space
    that follows it."""
    raw = data.tobytes()
    edges = np.append(starts, len(raw))
    if not drop.any():
        return raw.decode()
    change = np.flatnonzero(np.diff(np.concatenate(([False], drop, [False])).astype(np.int8)))
    keep, at = [], 0
    for a, b in change.reshape(-1, 2):
        keep.append(raw[at : edges[a]])
        at = int(edges[b])
    keep.append(raw[at:])
    return b"".join(keep).decode()


_REMOVED = "doc_id long, text string, n_words long, n_removed long, kept_sha256 string"


def _schema(ddl: str, carry: StructType | None) -> StructType:
    base = StructType.fromDDL(ddl)
    return base.add("carry", carry) if carry is not None else base


def _repeats(slim: DataFrame, window: int, carry: StructType | None) -> DataFrame:
    """The work behind both forms; with ``carry``, that column and whole
    texts pass through."""
    if window < 2:
        raise ValueError("window needs two words or more")
    spark = slim.sparkSession
    ready(spark)
    keep_text = carry is not None
    keyed = slim.filter("doc_id is not null")

    # Whole copies first: a document that is nowhere the smallest doc_id of a
    # text is covered by others, so its windows need not be looked at.
    originals = materialise(
        keyed.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")).agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id").distinct().withColumn("is_first", F.lit(True)),
        "originals",
    )
    alone = (
        keyed.select("doc_id", "text").mapInArrow(_named(window), "h long, doc_id long").groupBy("h")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1").select("doc_id", "h")
    )
    alone = materialise(alone, "level1")
    release(spark)
    none = F.array().cast("array<long>")
    singles = alone.groupBy("doc_id").agg(F.collect_list("h").alias("singles"))
    # Rows without doc_id stand alone: every half window of theirs would be
    # unknown, so they are taken through as they are.
    extra = ["carry"] if keep_text else []
    known = keyed.join(singles, "doc_id", "left").join(originals, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("singles", none).alias("singles"), F.col("is_first").isNull().alias("is_copy"), *extra
    )
    staged = known.mapInArrow(_candidates(window, keep_text), _schema(_CANDIDATES, carry))
    staged = materialise(staged, "candidates")
    release(spark)

    open_docs = staged.filter("at is not null")
    firsts = (
        open_docs.select("doc_id", "text", "at").mapInArrow(_whole(window), "h long, g int, doc_id long")
        .groupBy("h", "g").agg(F.min("doc_id").alias("doc_id"))
        .groupBy("doc_id").agg(F.collect_list("h").alias("firsts"))
    )
    judged = open_docs.join(firsts, "doc_id", "left").select(
        "doc_id", "text", "at", "n_words", F.coalesce("firsts", none).alias("firsts"), *extra
    )
    removed = judged.mapInArrow(_remove(window, keep_text), _schema(_REMOVED, carry))
    finished = staged.filter("at is null").drop("at")
    stray = slim.filter("doc_id is null").mapInArrow(_plain, _schema(_REMOVED, carry))
    return finished.unionByName(removed).unionByName(stray)


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_removed,
    kept_sha256 (of the kept words joined by one space).

    A word goes if it lies in a window of ``window`` words whose word
    sequence also starts in a smaller doc_id, or earlier in the same text.
    Windows are judged on the input. A null text has no words. Rows that
    share a doc_id are judged alike against other documents and each by
    itself. A row without doc_id is returned whole and removes nothing from
    others. Extra columns are ignored; an empty table gives an empty result.
    """
    return _repeats(docs.select("doc_id", "text"), window, None).drop("text")


def cut_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """``docs`` with the repeated words cut from text (each with the white
    space after it); all columns and rows stay, whatever their names."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    slim = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("carry"))
    out = _repeats(slim, window, slim.schema["carry"].dataType)
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"carry.`{c}`") for c in docs.columns])


def _plain(batches):
    for batch in batches:
        joined = [_joined((t or "").encode()) for t in batch.column("text").to_pylist()]
        carry, name = _carried(batch)
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("text"),
                pa.array([len(j.split(b" ")) if j else 0 for j in joined], pa.int64()),
                pa.array([0] * len(joined), pa.int64()),
                pa.array([hashlib.sha256(j).hexdigest() for j in joined], pa.string()),
                *carry,
            ],
            names=["doc_id", "text", "n_words", "n_removed", "kept_sha256", *name],
        )

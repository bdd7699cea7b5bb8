"""Importance resampling towards a target distribution.

Documents and target texts are described by hashed word n-grams (1 to 3
words). A bucket's gain is the log ratio of its smoothed share in the target
and in the corpus; a document's weight is the sum of the gains of its
features, and Gumbel noise from its doc_id turns the highest weights into a
draw without replacement.

Features are found batch by batch: a run of texts is joined with a sentinel
byte that no word holds, one regex pass finds all words, ``searchsorted`` on
the texts' offsets names each word's document and masks n-grams that would
cross a border, and ``bincount`` adds up. A bucket is the CRC-32 of the
n-gram's bytes; as CRC-32 is linear, the n-gram's value is put together from
its words' values by table lookups, with no string built.

Counts of the corpus (10,000 numbers) are gathered in one pass, documents
are scored in a second; texts never move. Drawn documents get their ranks
from a range-partitioned sort of (score, doc_id) rows.

Defined cases: a null or empty text has no features, weight 0 and is not
drawn; rows of one doc_id share their noise and are ranked one by one; a null
doc_id takes the noise of an empty id and comes last among equal scores; only
``doc_id`` and ``text`` are read, so other columns never clash; an empty table
gives an empty result, and without target texts all gains follow the formula.
A long text is read in stretches of ``STRETCH`` bytes, cut between words.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textnp as T
from .common import materialise, partitions_for, ready

#: Words of lower-cased texts: digits, letters a-z and all beyond ASCII. In
#: UTF-8 every byte of a character beyond ASCII is one of the class as well.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SENTINEL = b"\x00"
BUCKETS = 10_000
ORDERS = 3
#: Bytes of one regex pass: longer texts are cut between words.
STRETCH = 1 << 22
_NOT_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_IN_WORD = np.array([WORD.match(bytes([c])) is not None for c in range(256)])
_SPACE = zlib.crc32(b" ")
_TABLES: dict[int, tuple[np.ndarray, int]] = {}


def _shift_table(length: int) -> tuple[np.ndarray, int]:
    """((4, 256) tables, space): the linear map that takes the CRC of a text
    to its part in the CRC of that text followed by a space and ``length``
    bytes, and the CRC of the space seen through those bytes."""
    known = _TABLES.get(length)
    if known is None:
        table = np.zeros((4, 256), np.uint32)
        zeros = bytes(length + 1)
        rest = zlib.crc32(zeros)
        for i in range(32):
            byte = np.arange(256) >> (i % 8) & 1 == 1
            table[i // 8, byte] ^= np.uint32(zlib.crc32(zeros, 1 << i) ^ rest)
        zeros = zeros[1:]
        known = table, zlib.crc32(zeros, _SPACE) ^ zlib.crc32(zeros)
        if length <= 64:
            _TABLES[length] = known
    return known


def ngram_crcs(crc: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """CRC-32 of all runs of 1, 2, .. ORDERS consecutive words joined by one
    space, from each word's CRC and length; entry i of order n is the run
    that starts at word i."""
    if not len(crc):
        return [crc] * ORDERS
    found, which = np.unique(length, return_inverse=True)
    tables, space = zip(*(_shift_table(int(n)) for n in found))
    t = np.stack(tables)
    spaced = np.array(space, np.uint32)[which] ^ crc  # a space, then the word
    out = [crc]
    for n in range(1, ORDERS):
        c, w = out[-1][: max(len(crc) - n, 0)], which[n:]
        out.append(
            t[w, 0, c & 255] ^ t[w, 1, c >> 8 & 255] ^ t[w, 2, c >> 16 & 255] ^ t[w, 3, c >> 24] ^ spaced[n:]
        )
    return out


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc, length, text index) of all words of a run of lower-cased texts,
    from one regex pass over their concatenation."""
    stream = SENTINEL.join(texts)
    found = WORD.findall(stream)
    inside = _IN_WORD[np.frombuffer(stream, np.uint8)]
    inside[1:] &= ~inside[:-1]  # the first byte of each word, as the pattern takes whole runs
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(SENTINEL)
    return (
        np.fromiter(map(zlib.crc32, found), np.uint32, len(found)),
        np.fromiter(map(len, found), np.int64, len(found)),
        np.searchsorted(np.cumsum(sizes), np.flatnonzero(inside), side="right"),
    )


def _stretches(text: bytes):
    """A long text in pieces that end between words."""
    a = 0
    while len(text) - a > STRETCH:
        gap = _NOT_WORD.search(text, a + STRETCH)
        if not gap:
            break
        yield text[a : gap.end()]
        a = gap.end()
    yield text[a:]


def features(texts: list[bytes]):
    """(bucket, text index) arrays of all features and the text index of
    each word, in runs of bounded size."""
    if len(texts) == 1 and len(texts[0]) > STRETCH:
        held = np.zeros(0, np.uint32), np.zeros(0, np.int64)  # last words of the piece before
        for piece in _stretches(texts[0]):
            crc, length, text = words_of([piece])
            k = len(held[0])
            crc, length = np.concatenate([held[0], crc]), np.concatenate([held[1], length])
            # Runs that end among the held words are counted already.
            runs = [x[max(k - n, 0) :] for n, x in enumerate(ngram_crcs(crc, length))]
            bucket = np.concatenate(runs) % BUCKETS
            yield bucket, np.zeros(len(bucket), np.int64), text
            held = crc[-ORDERS + 1 :], length[-ORDERS + 1 :]
        return
    crc, length, text = words_of(texts)
    buckets, owners = [], []
    for n, run in enumerate(ngram_crcs(crc, length)):
        last = text[n:]
        owner = text[: len(last)]
        inside = owner == last
        buckets.append(run[inside] % BUCKETS)
        owners.append(owner[inside])
    yield np.concatenate(buckets), np.concatenate(owners), text


def _runs(batch: pa.RecordBatch):
    """(rows, their lower-cased texts as bytes) with bounded text."""
    at = batch.schema.get_field_index("text")
    for rows in T.pieces(batch, "text"):
        column = rows.column(at).cast(pa.large_binary())
        yield rows, [(t or b"").lower() for t in column.to_pylist()]


def feature_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts in each bucket: a bincount per task, added up."""
    ready(texts.sparkSession)

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, run in _runs(batch):
                for bucket, _, _ in features(run):
                    total += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(held.astype(np.int32)), "n": pa.array(total[held])})

    parts = texts.select("text").mapInArrow(count, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket."""
    all_s, all_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log(((t + 1.0) * all_s) / ((s + 1.0) * all_t)))
         for s, t in zip(corpus.tolist(), target.tolist())], np.int64
    )


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    ready(docs.sparkSession)

    def score(batches):
        for batch in batches:
            for rows, run in _runs(batch):
                n_words, n_features, weight = np.zeros((3, len(run)), np.int64)
                for bucket, owner, text in features(run):
                    n_words += np.bincount(text, minlength=len(run))
                    n_features += np.bincount(owner, minlength=len(run))
                    # Sums of whole numbers below 2**53: exact in doubles.
                    weight += np.bincount(owner, gain[bucket], minlength=len(run)).astype(np.int64)
                yield pa.record_batch({
                    "doc_id": rows.column(rows.schema.get_field_index("doc_id")),
                    "n_words": pa.array(n_words), "n_features": pa.array(n_features), "weight": pa.array(weight),
                })

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    return docs.select("doc_id", "text").mapInArrow(score, schema)


def gumbel(doc_id: str, seed: int = 42) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256('seed:doc_id')."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def add_rank(scored: DataFrame, drawn: int, rows: int, rows_each: int = 500_000) -> DataFrame:
    """``scored`` (a written table) with ``rank`` among its eligible rows by
    score, null beyond the first ``drawn``. Rows are dealt out by ranges of
    (score, doc_id, row), numbered within each range, and raised by the sizes of the
    ranges before: no task holds more than a range."""
    spark = scored.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    eligible = scored.filter("_eligible")
    n = partitions_for(spark, rows, rows_each)
    dealt = materialise(eligible.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    before, offsets = 0, []
    for part, size in sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        offsets.append((part, before))
        before += size
    starts = spark.createDataFrame(offsets, "_at int, _before long")  # one row per range
    within = dealt.join(F.broadcast(starts), F.col("_part") == F.col("_at"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    ranked = within.withColumn("rank", F.when(place <= drawn, place).cast("long")).drop("_part", "_at", "_before")
    return ranked.unionByName(scored.filter("not _eligible").withColumn("rank", F.lit(None).cast("long")))


def importance_sample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """Every row's (doc_id, n_features, weight, score, rank): the draw takes
    floor(percent/100) of the documents with at least ``min_words`` words,
    highest score first; ``rank`` is null for the others."""
    gain = gains(feature_counts(docs), feature_counts(target))
    scored = weigh(docs, gain).select(
        "doc_id", "n_features", "weight", (F.col("weight") + gumbel("doc_id", seed)).alias("score"),
        (F.col("n_words") >= min_words).alias("_eligible"), F.monotonically_increasing_id().alias("_row"),
    )
    scored = materialise(scored, "importance")
    rows = scored.filter("_eligible").count()
    return add_rank(scored, percent * rows // 100, rows).select("doc_id", "n_features", "weight", "score", "rank")

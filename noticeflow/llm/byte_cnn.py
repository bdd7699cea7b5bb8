"""Quality classifier: a convolutional network over raw bytes, in numpy.

A document's UTF-8 bytes are embedded and seen in overlapping chunks that
together cover all of it. In each chunk, learned filters (8 bytes wide,
every 4 bytes) are max-pooled; a document's pooled chunks are combined by
their mean and their maximum into one logistic probability. Only bytes go
in: no label, language, source or id.

The network is trained on a bounded, hashed sample of labelled documents: in
the order of a hash, up to ``SAMPLE_ROWS`` per class and as many as have
``SAMPLE_BYTES`` bytes together (a document that does not fit in is passed
over). Every byte of a sampled document is learned from, and scoring reads every
byte of every document, a long one in stretches of ``STRETCH`` chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnp as T
from .common import ready

#: Training sample of whole documents: number and bytes, per class.
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 12 << 20
#: Chunks that are pooled at a time.
STRETCH = 512

STEP = 4  # bytes per block; a filter spans two blocks
CHUNK = 128  # blocks per chunk
OVERLAP = 8  # blocks shared by neighbouring chunks
EMBED, FILTERS = 8, 32
PAD = 256  # index of the padding byte; its embedding is zero


class ByteCnn:
    """Parameters and forward pass; ``train`` fits them."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        self.p = {
            "embed": normal(257, EMBED) * 0.5,
            "near": normal(STEP * EMBED, FILTERS) / np.sqrt(2 * STEP * EMBED, dtype=np.float32),
            "far": normal(STEP * EMBED, FILTERS) / np.sqrt(2 * STEP * EMBED, dtype=np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": normal(2 * FILTERS) * 0.05,
            "shift": np.zeros(1, np.float32),
        }
        self.p["embed"][PAD] = 0
        self.mean = np.zeros(2 * FILTERS, np.float32)
        self.scale = np.ones(2 * FILTERS, np.float32)

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, 2 * FILTERS): mean and maximum of the max-pooled chunks
        of every document in the buffer."""
        n = len(offsets) - 1
        lengths = np.diff(offsets)
        used = -(-lengths // STEP)
        # Each document has a whole number of blocks and one block of padding.
        size = np.maximum(used, 1) + 1
        first = np.concatenate(([0], np.cumsum(size)))
        padded = np.full(int(first[-1]) * STEP, PAD, np.int16)
        inside = np.arange(offsets[-1]) + np.repeat(first[:-1] * STEP - offsets[:-1], lengths)
        padded[inside] = data
        p = self.p
        blocks = p["embed"][padded].reshape(-1, STEP * EMBED)
        acts = blocks @ p["near"]
        acts[:-1] += (blocks @ p["far"])[1:]
        acts = np.maximum(acts + p["bias"], 0, out=acts)
        # Chunks of each document: CHUNK blocks, every CHUNK - OVERLAP blocks.
        hop = CHUNK - OVERLAP
        body = size - 1
        n_chunks = 1 + np.maximum(0, -(-(body - CHUNK) // hop))
        doc = np.repeat(np.arange(n), n_chunks)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
        begin = first[doc] + k * hop
        end = np.minimum(begin + CHUNK, first[doc] + body[doc])
        pairs = np.stack([begin, end], 1).reshape(-1)
        best = np.maximum.reduceat(acts, pairs, axis=0)[::2]
        at = np.concatenate(([0], np.cumsum(n_chunks)))[:-1]
        return np.concatenate(
            [np.add.reduceat(best, at, axis=0) / n_chunks[:, None], np.maximum.reduceat(best, at, axis=0)], axis=1
        ).astype(np.float32)

    def pooled_long(self, data: np.ndarray) -> np.ndarray:
        """``pooled`` of one long document, chunk by chunk: each stretch of
        chunks is a document of its own up to the block after its last chunk."""
        hop = CHUNK - OVERLAP
        n_blocks = -(-len(data) // STEP)
        n_chunks = 1 + max(0, -(-(n_blocks - CHUNK) // hop))
        total, top, p = np.zeros(FILTERS), np.zeros(FILTERS, np.float32), self.p
        for k in range(0, n_chunks, STRETCH):
            m = min(STRETCH, n_chunks - k)
            part = data[k * hop * STEP : ((k + m - 1) * hop + CHUNK + 1) * STEP]
            body = min((m - 1) * hop + CHUNK, n_blocks - k * hop)
            padded = np.full((body + 1) * STEP, PAD, np.int16)
            padded[: len(part)] = part
            blocks = p["embed"][padded].reshape(-1, STEP * EMBED)
            acts = np.maximum(blocks[:-1] @ p["near"] + blocks[1:] @ p["far"] + p["bias"], 0)
            best = np.stack([acts[b : b + CHUNK].max(axis=0) for b in range(0, m * hop, hop)])
            total += best.sum(axis=0)
            top = np.maximum(top, best.max(axis=0))
        return np.concatenate([total / n_chunks, top]).astype(np.float32)[None]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        if len(offsets) == 2 and len(data) > STRETCH * CHUNK * STEP:
            features = self.pooled_long(data)
        else:
            features = self.pooled(data, offsets)
        z = ((features - self.mean) / self.scale) @ self.p["out"] + self.p["shift"]
        return 1 / (1 + np.exp(-z.astype(np.float64)))

    def train(self, texts: list[list[bytes]], labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 4e-3,
              seed: int = 5) -> None:
        """Adam on the logistic loss. texts: the sampled chunks of each document."""
        rng = np.random.default_rng(seed)
        width = CHUNK * STEP + STEP
        flat = np.full((sum(map(len, texts)), width), PAD, np.int16)
        for row, chunk in enumerate(c for t in texts for c in t):
            flat[row, : len(chunk)] = np.frombuffer(chunk, np.uint8)
        counts = np.array([len(t) for t in texts])
        first = np.concatenate(([0], np.cumsum(counts)))
        p = self.p
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        t = 0
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                docs = order[a : a + batch]
                rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
                owner = np.repeat(np.arange(len(docs)), counts[docs])
                grads = self._gradients(flat[rows], owner, counts[docs], labels[docs])
                t += 1
                step = rate * (0.5 * (1 + np.cos(np.pi * t * batch / (epochs * len(order) + batch))))
                for key, g in grads.items():
                    m, v = state[key]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p[key] -= (step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
                p["embed"][PAD] = 0

    def _gradients(self, chunks: np.ndarray, owner: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict:
        p = self.p
        c = len(chunks)
        blocks = p["embed"][chunks].reshape(c, CHUNK + 1, STEP * EMBED)
        acts = blocks[:, :-1] @ p["near"] + blocks[:, 1:] @ p["far"] + p["bias"]
        # Blocks of padding alone are no part of the text (one stays for empty texts).
        used = np.maximum(1, -(-(chunks != PAD).sum(1) // STEP))
        acts[np.arange(CHUNK)[None, :] >= used[:, None]] = -1
        best_at = acts.argmax(1)
        best = np.maximum(np.take_along_axis(acts, best_at[:, None, :], 1)[:, 0], 0)
        at = np.concatenate(([0], np.cumsum(counts)))[:-1]
        mean = np.add.reduceat(best, at, axis=0) / counts[:, None]
        top = np.maximum.reduceat(best, at, axis=0)
        features = np.concatenate([mean, top], 1)
        z = features @ p["out"] + p["shift"]
        error = ((1 / (1 + np.exp(-z)) - labels) / len(labels)).astype(np.float32)
        grads = {"out": features.T @ error + 1e-4 * p["out"], "shift": error.sum(keepdims=True)}
        d = error[:, None] * p["out"]
        dbest = (d[:, :FILTERS] / counts[:, None])[owner]
        is_top = best == top[owner]
        dbest = (dbest + d[:, FILTERS:][owner] * is_top) * (best > 0)
        rows = np.arange(c)[:, None]
        near, far = blocks[rows, best_at], blocks[rows, best_at + 1]  # (chunks, filters, block)
        grads["near"] = np.einsum("cfe,cf->ef", near, dbest)
        grads["far"] = np.einsum("cfe,cf->ef", far, dbest)
        grads["bias"] = dbest.sum(0)
        embed = np.zeros_like(p["embed"])
        view = chunks.reshape(c, CHUNK + 1, STEP)
        for side, weights in ((0, p["near"]), (1, p["far"])):
            seen = view[rows, best_at + side].reshape(-1)  # byte by byte
            flow = (dbest[:, :, None] * weights.T[None]).reshape(-1, EMBED)
            for e in range(EMBED):
                embed[:, e] += np.bincount(seen, flow[:, e], 257).astype(np.float32)
        grads["embed"] = embed
        return grads


def chunks_of(raw: bytes) -> list[bytes]:
    """The chunks of a text, as scoring cuts them."""
    hop, size = (CHUNK - OVERLAP) * STEP, CHUNK * STEP + STEP
    n = 1 + max(0, -(-(len(raw) - CHUNK * STEP) // hop))
    return [raw[k * hop : k * hop + size] for k in range(n)]


def held_out_by_crc(buckets: int, remainder: int):
    """True where crc32 of doc_id as text leaves ``remainder``; a row without
    doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets == remainder, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, buckets: int = 3, remainder: int = 1,
                sample_rows: int = SAMPLE_ROWS) -> ByteCnn:
    """Train on at most ``sample_rows`` documents per class among the labelled
    rows that are not held out. Of several labels of a document the lowest
    counts. Without both classes the network is left at even odds."""
    spark = docs.sparkSession
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    ).filter(~held_out_by_crc(buckets, remainder))
    sizes = {bool(r["good"]): r["n"] for r in known.groupBy((F.col("quality") == 1).alias("good")).agg(
        F.count("*").alias("n")).collect()}
    model = ByteCnn()
    if len(sizes) < 2:
        model.p["out"][:] = 0
        return model
    hashed = F.xxhash64("doc_id", F.lit(17))
    picked = None
    for good in (True, False):
        part = known.filter((F.col("quality") == 1) == F.lit(good)).orderBy(hashed, "doc_id").limit(sample_rows)
        picked = part if picked is None else picked.union(part)
    picked = picked.select(F.col("doc_id").alias("_picked"), "quality", hashed.alias("_order"))  # 2 * sample_rows rows at most
    named = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_picked"))
    # Lengths first: of the rows of a doc_id the shortest text, then the least.
    size = F.octet_length(F.coalesce("text", F.lit("")))
    sizes_of = named.groupBy("doc_id").agg(F.min(size).alias("size"), F.min("quality").alias("quality"), F.min("_order").alias("order"))
    left, fits = {True: SAMPLE_BYTES, False: SAMPLE_BYTES}, []
    for r in sorted(sizes_of.collect(), key=lambda r: (r["order"], r["doc_id"])):
        if r["size"] <= left[r["quality"] == 1]:
            left[r["quality"] == 1] -= r["size"]
            fits.append((r["doc_id"], r["size"]))
    fitting = F.broadcast(spark.createDataFrame(fits, "_fits long, _size long"))
    whole = named.join(fitting, (F.col("doc_id") == F.col("_fits")) & (size == F.col("_size")))
    rows = whole.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    if len({r["quality"] == 1 for r in rows}) < 2:
        model.p["out"][:] = 0
        return model
    y = np.array([r["quality"] == 1 for r in rows], np.float32)
    model.train([chunks_of((r["text"] or "").encode()) for r in rows], y)
    # The sample is balanced; the corpus is as the labels say.
    share = y.mean()
    model.p["shift"] += np.float32(np.log(sizes[True] / sizes[False]) - np.log(share / (1 - share)))
    return model


def _score(model: ByteCnn):
    def run(batches):
        for batch in batches:
            for rows in T.pieces(batch, "text", 1 << 20):
                data, offsets = T.text_buffer(rows.column("text"))
                yield pa.record_batch(
                    [rows.column("doc_id"), pa.array(model.scores(data, offsets))], names=["doc_id", "score"]
                )

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, buckets: int = 3, remainder: int = 1) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, score,
    predicted.

    Labels are learned only from documents that are not held out (crc32 of
    doc_id as text, modulo ``buckets``, equals ``remainder``). A null text is
    empty; an empty text has the score of padding. Extra columns are ignored.
    """
    ready(docs.sparkSession)
    model = fit_quality(docs, labels, buckets, remainder)
    scored = docs.select("doc_id", "text").mapInArrow(_score(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out_by_crc(buckets, remainder).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

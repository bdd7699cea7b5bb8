"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character 1- to 3-grams of the lower-cased
text (hashed to ``BUCKETS``), at unit length. Document frequencies cover all
documents that may be learned from. The classifier is trained by
follow-the-regularised-leader with L1 and L2 penalties on a bounded, hashed
sample (``SAMPLE_ROWS`` documents per language), and a temperature fitted on
a part of the sample that was left out makes its probabilities honest.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textnp as T
from .byte_cnn import held_out_by_crc
from .common import join_small, ready

BITS = 14
BUCKETS = 1 << BITS
ORDERS = 3
#: Training sample: documents per language.
SAMPLE_ROWS = 800
SALTS = 64
UNKNOWN = "und"
_LIKE_LETTERS = re.compile(r"[^\W\d_]").finditer
_K = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_SHIFT, _DOWN = np.uint32(15), np.uint32(32 - BITS)


def has_letter(text: str) -> bool:
    """True if a character is a letter (the pattern also finds signs such as
    a superscript two)."""
    return any(m[0].isalpha() for m in _LIKE_LETTERS(text))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, times) of a text's n-grams, buckets ascending. Long texts
    are counted piece by piece."""
    total = np.zeros(BUCKETS, np.int64)
    lowered = text.lower()
    size = 1 << 20
    for a in range(0, max(len(lowered), 1), size):
        codes = np.frombuffer(lowered[max(0, a - ORDERS + 1) : a + size].encode("utf-32-le", "surrogatepass"), np.uint32)
        again = min(a, ORDERS - 1)  # codes of the piece before
        h = np.zeros(len(codes), np.uint32)
        for n in range(min(ORDERS, len(codes))):
            # h[i] covers codes i .. i+n
            h = h[: len(codes) - n] * _K[1] + codes[n:] * _K[0] + np.uint32(n + 1)
            x = h ^ (h >> _SHIFT)
            x = (x * _K[2]) >> _DOWN
            # n-grams that end inside the piece before are counted there.
            total += np.bincount(x[max(0, again - n) :], minlength=BUCKETS)
    where = np.flatnonzero(total)
    return where, total[where]


def weights(times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(times) * idf
    norm = np.sqrt((v * v).sum())
    return v / norm if norm else v


class Ftrl:
    """FTRL-proximal for softmax regression with elastic-net penalties."""

    def __init__(self, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((2, classes, BUCKETS + 1))  # the last column is the intercept

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(
            np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        )

    def learn(self, where: np.ndarray, value: np.ndarray, label: int) -> None:
        where, value = np.append(where, BUCKETS), np.append(value, 1.0)
        z, n = self.z[:, where], self.n[:, where]
        w = self._weights(z, n)
        p = softmax(w @ value)
        p[label] -= 1
        g = p[:, None] * value
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[:, where] = z + g - sigma * w
        self.n[:, where] = n + g * g

    def matrix(self) -> np.ndarray:
        return self._weights(self.z, self.n)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


class LanguageModel:
    def __init__(self, languages: list[str], matrix: np.ndarray, idf: np.ndarray, temperature: float):
        self.languages, self.matrix, self.idf, self.temperature = languages, matrix, idf, temperature

    def logits(self, where: np.ndarray, times: np.ndarray) -> np.ndarray:
        return self.matrix[:, where] @ weights(times, self.idf[where]) + self.matrix[:, BUCKETS]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*counts(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(sample: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3, seed: int = 9) -> LanguageModel:
    """sample: (language, buckets, times). Every fifth document is left out
    of the training and sets the temperature."""
    languages = sorted({s[0] for s in sample})
    label = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    aside, learned = order[::5] if len(sample) >= 50 else order[:0], order if len(sample) < 50 else np.delete(order, np.s_[::5])
    ftrl = Ftrl(len(languages))
    for _ in range(epochs):
        for i in rng.permutation(learned):
            name, where, times = sample[i]
            ftrl.learn(where, weights(times, idf[where]), label[name])
    model = LanguageModel(languages, ftrl.matrix(), idf, 1.0)
    if len(aside):
        logits = np.array([model.logits(*sample[i][1:]) for i in aside])
        truth = np.array([label[sample[i][0]] for i in aside])

        def loss(temperature: float) -> float:
            x = logits / temperature
            x = x - x.max(1, keepdims=True)
            return float((np.log(np.exp(x).sum(1)) - x[np.arange(len(x)), truth]).mean())

        # Golden-section search on the logarithm: the loss is unimodal in it.
        low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
        for _ in range(40):
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
        model.temperature = float(np.exp((low + high) / 2))
    return model


def _frequencies(batches):
    """One row per bucket and task: in how many of its documents it occurs;
    bucket -1 counts the documents."""
    found, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found[counts(text or "")[0]] += 1
            n += 1
    where = np.flatnonzero(found)
    yield pa.record_batch(
        [pa.array(np.append(where, -1).astype(np.int32)), pa.array(np.append(found[where], n))], names=["bucket", "df"]
    )


def _features(batches):
    for batch in batches:
        rows = [counts(t or "") for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array([w.astype(np.int32) for w, _ in rows], pa.list_(pa.int32())),
                pa.array([t for _, t in rows], pa.list_(pa.int64())),
            ],
            names=["doc_id", "lang", "buckets", "times"],
        )


def fit_languages(docs: DataFrame, buckets: int = 4, remainder: int = 2, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Train on documents with a language and a letter that are not held out."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")
        & ~held_out_by_crc(buckets, remainder)
    )
    df = known.select("text").mapInArrow(_frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df"))
    table = {r["bucket"]: r["df"] for r in df.collect()}  # BUCKETS + 1 rows at most
    n = table.pop(-1, 0)
    frequency = np.zeros(BUCKETS)
    frequency[list(table.keys())] = list(table.values())
    idf = np.log((1 + n) / (1 + frequency)) + 1
    # The sample: the first rows of each language by a hash of doc_id. Ranked
    # within parts of a language first, so that a language that holds most
    # rows is no hot key: its last task sees SALTS * sample_rows rows at most.
    hashed = F.xxhash64("doc_id", F.lit(23))
    picked = known.select("doc_id", "lang", hashed.alias("h"))
    for key in (["lang", F.pmod(F.col("h"), F.lit(SALTS))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*key).orderBy("h", "doc_id"))
        picked = picked.withColumn("k", rank).filter(F.col("k") <= sample_rows).drop("k")
    picked = picked.select(F.col("doc_id").alias("_picked")).distinct()
    chosen = join_small(known.withColumn("_key", F.col("doc_id")), picked.withColumnRenamed("_picked", "_key"), "_key", "inner")
    rows = chosen.select("doc_id", "lang", "text").mapInArrow(
        _features, "doc_id long, lang string, buckets array<int>, times array<long>"
    ).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], len(r["buckets"])))
    sample = [(r["lang"], np.array(r["buckets"], np.int64), np.array(r["times"], np.int64)) for r in rows]
    return fit(sample, idf) if sample else LanguageModel([], np.zeros((0, BUCKETS + 1)), idf, 1.0)


def _predict(model: LanguageModel):
    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def predict_languages(docs: DataFrame, buckets: int = 4, remainder: int = 2) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: doc_id, held_out,
    lang_pred, score.

    ``lang`` is read from documents that are not held out and only to learn;
    a prediction sees the text alone. A text that is null or has no letter is
    ``und`` with score 0, as is every text if nothing can be learned. Rows
    without doc_id are predicted but not learned from. Extra columns are
    ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    model = fit_languages(docs, buckets, remainder)
    # The matrix has a fixed size per language; one copy per worker.
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        yield from _predict(shared.value)(batches)

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out_by_crc(buckets, remainder).alias("held_out"), "lang_pred", "score")

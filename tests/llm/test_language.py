import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeflow.llm import language_id as L


def brute_counts(text):
    c = collections.Counter()
    t = text.lower()
    for n in range(1, L.ORDERS + 1):
        for i in range(len(t) - n + 1):
            h = 0
            for k in range(n):
                h = (h * 0x85EBCA77 + ord(t[i + k]) * 0x9E3779B1 + k + 1) & 0xFFFFFFFF
            x = h ^ (h >> 15)
            c[((x * 0xC2B2AE3D) & 0xFFFFFFFF) >> (32 - L.BITS)] += 1
    return dict(c)


@pytest.mark.parametrize("text", ["", "a", "ab", "Hello Wörld", "日本😀x"])
def test_counts(text):
    where, times = L.counts(text)
    assert dict(zip(where.tolist(), times.tolist())) == brute_counts(text)


def test_long_texts_are_counted_whole():
    text = "abc é" * 300_000  # more than one piece
    where, times = L.counts(text)
    assert int(times.sum()) == 3 * len(text) - 3
    assert dict(zip(*L.counts(text[:20]))) == brute_counts(text[:20])


def test_penalties_make_the_matrix_sparse():
    rng = np.random.default_rng(1)
    model, dense = L.Ftrl(2, l1=0.5), L.Ftrl(2, l1=0.0, l2=0.0)
    for _ in range(200):
        label = int(rng.integers(2))
        where = np.sort(np.append(rng.choice(np.arange(10, 500), 20, replace=False), label))
        for m in (model, dense):
            m.learn(where, np.full(21, 21**-0.5), label)
    assert (model.matrix() != 0).mean() < (dense.matrix() != 0).mean() / 2
    w = model.matrix()
    assert w[0, 0] > w[1, 0] and w[1, 1] > w[0, 1]


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = L.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    right = (out.lang_pred == out.lang).to_numpy()
    assert right.mean() > 0.99
    assert abs(out.score.mean() - right.mean()) < 0.02


def test_lang_of_held_out_rows_is_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.predict_languages(docs).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in L.predict_languages(turned).collect()}
    flags = docs.select("doc_id", held.alias("h"))
    got = L.predict_languages(docs).join(flags, "doc_id")
    assert got.filter("h <> held_out").count() == 0 and 20 < got.filter("held_out").count() < 90


def test_edges(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(40)] + [(100 + i, "der hund und die katze " * 3, "de") for i in range(40)]
    rows += [(500, None, "en"), (501, "", None), (502, "123 !? ²", "en"), (None, "the dog", "en"), (503, "und die katze", None),
             (503, "und die katze", None), (504, "the dog " * 300_000, None), (505, "日", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    got = L.predict_languages(docs).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r.lang_pred for r in got}
    assert (of[500], of[501], of[502], of[503], of[504], of[None]) == ("und", "und", "und", "de", "en", "en")
    assert of[505] in ("en", "de") and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in L.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert L.predict_languages(docs.limit(0)).collect() == []

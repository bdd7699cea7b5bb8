import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeflow.llm import byte_cnn as B
from noticeflow.llm import textnp as T


def scores(model, texts):
    return model.scores(*T.text_buffer(pa.array(texts, pa.string())))


def test_a_score_depends_on_its_own_text_alone():
    model = B.ByteCnn()
    texts = ["", None, "short", "x" * 511, "y " * 2000, "é" * 700, "short"]
    together = scores(model, texts)
    assert together == pytest.approx([scores(model, [t])[0] for t in texts], abs=1e-6)
    assert together[0] == together[1] and together[2] == pytest.approx(together[6], abs=1e-6)


def test_chunks_cover_the_whole_text():
    """A change at any place of a long text reaches its features."""
    model = B.ByteCnn()
    base = "a" * 5000
    plain = model.pooled(*T.text_buffer(pa.array([base])))
    for at in (0, 3, 511, 512, 2500, 4990, 4999):
        changed = base[:at] + "#" + base[at + 1 :]
        assert not np.array_equal(plain, model.pooled(*T.text_buffer(pa.array([changed])))), at


def test_training_sees_what_scoring_sees():
    """The pooled features of the training pass equal those of scoring."""
    model = B.ByteCnn()
    for text in ("", "abc", "z" * 480, "q" * 517, "some words here " * 300):
        chunks = B.chunks_of(text.encode())
        width = B.CHUNK * B.STEP + B.STEP
        flat = np.full((len(chunks), width), B.PAD, np.int16)
        for i, c in enumerate(chunks):
            flat[i, : len(c)] = np.frombuffer(c, np.uint8)
        seen = {}
        model.p["out"] = np.ones_like(model.p["out"])
        grads = model._gradients(flat, np.zeros(len(chunks), int), np.array([len(chunks)]), np.zeros(1, np.float32))
        # With label 0, the gradient of ``out`` is p * features.
        z = model.pooled(*T.text_buffer(pa.array([text])))[0]
        p = 1 / (1 + np.exp(-(z.sum() + model.p["shift"][0])))
        assert grads["out"] - 1e-4 == pytest.approx(p * z, rel=1e-3, abs=1e-4), (text[:5], seen)


@pytest.mark.parametrize("size", [1, 4, 511, 512, 513, 517, 5000, 40_003])
def test_a_plain_forward_pass_over_a_whole_text(monkeypatch, size):
    """Block by block and chunk by chunk in Python; long texts in stretches."""
    model, rng = B.ByteCnn(), np.random.default_rng(size)
    raw = bytes(rng.integers(32, 127, size).astype(np.uint8))
    n = -(-size // B.STEP)
    padded = list(raw) + [B.PAD] * ((n + 1) * B.STEP - size)
    block = [model.p["embed"][padded[i * B.STEP : (i + 1) * B.STEP]].reshape(-1) for i in range(n + 1)]
    act = [np.maximum(block[i] @ model.p["near"] + block[i + 1] @ model.p["far"] + model.p["bias"], 0) for i in range(n)]
    best, a = [], 0
    while True:
        best.append(np.max(act[a : a + B.CHUNK], axis=0))
        if a + B.CHUNK >= n:
            break
        a += B.CHUNK - B.OVERLAP
    want = np.concatenate([np.mean(best, axis=0), np.max(best, axis=0)])
    data, offsets = T.text_buffer(pa.array([raw.decode()]))
    assert model.pooled(data, offsets)[0] == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(B, "STRETCH", 3)
    assert model.pooled_long(data)[0] == pytest.approx(want, abs=1e-5)


def test_a_long_text_takes_little_memory():
    import tracemalloc

    data, offsets = T.text_buffer(pa.array(["some words " * 2_000_000]))
    model = B.ByteCnn()
    tracemalloc.start()
    model.scores(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # 22 MB of text


def test_the_sample_is_bounded_by_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(B, "SAMPLE_BYTES", 1000)
    seen = []
    monkeypatch.setattr(B.ByteCnn, "train", lambda self, texts, y: seen.extend(texts))
    rows = [(i, ("good " if i % 2 else "bad ") * (10_000 if i == 4 else 40)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    B.fit_quality(docs, labels)
    whole = {tuple(B.chunks_of(t.encode())) for _, t in rows}
    assert 8 <= len(seen) <= 12 and all(tuple(t) in whole for t in seen)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = B.ByteCnn()
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    model.p["out"] = rng.standard_normal(2 * B.FILTERS) * 0.3
    width = B.CHUNK * B.STEP + B.STEP
    chunks = rng.integers(97, 123, (3, width)).astype(np.int16)
    owner, counts, y = np.array([0, 0, 1]), np.array([2, 1]), np.array([1.0, 0.0])

    def loss():
        total = 0.0
        for d, rows in enumerate(([0, 1], [2])):
            blocks = model.p["embed"][chunks[rows]].reshape(len(rows), B.CHUNK + 1, -1)
            acts = blocks[:, :-1] @ model.p["near"] + blocks[:, 1:] @ model.p["far"] + model.p["bias"]
            best = np.maximum(acts.max(1), 0)
            z = np.concatenate([best.mean(0), best.max(0)]) @ model.p["out"] + model.p["shift"][0]
            total += np.log1p(np.exp(-z if y[d] else z)) / 2
        return total

    grads = model._gradients(chunks, owner, counts, y)
    for key, at in (("near", (3, 5)), ("far", (10, 2)), ("bias", (4,)), ("embed", (100, 3)), ("shift", (0,))):
        keep = model.p[key][at]
        model.p[key][at] = keep + 1e-5
        up = loss()
        model.p[key][at] = keep - 1e-5
        down = loss()
        model.p[key][at] = keep
        assert grads[key][at] == pytest.approx((up - down) / 2e-5, rel=2e-3, abs=1e-6), key


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = B.quality_scores(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").filter("held_out").toPandas()
    good = (out.quality == 1).to_numpy()
    rank = out.score.rank().to_numpy()
    auc = (rank[good].mean() - (good.sum() + 1) / 2) / (~good).sum()
    assert auc > 0.98
    assert (out.predicted[good] == 1).mean() > 0.97
    assert (out.predicted[~good] == 0).mean() > 0.7


def test_edges(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "text"), (3, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("quality", F.lit(1))
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, none.limit(0), spark.createDataFrame([(2, 1, 0), (3, 0, 0)], none.schema)):
        got = B.quality_scores(docs, labels).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        by = {(r.doc_id): r.score for r in got}
        assert by[1] == by[2]
    assert B.quality_scores(docs.limit(0), none).collect() == []


def test_held_out_rows_are_not_learned_from(spark):
    """Turning the labels of held-out rows changes nothing."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(B.held_out_by_crc(3, 1), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    a = {r.doc_id: r.score for r in B.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in B.quality_scores(docs, turned).collect()}
    assert a == b

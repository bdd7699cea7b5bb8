import collections
import hashlib
import math
import re
import zlib

import pytest

from noticeflow.llm import importance as I

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5):
    """{doc_id: (n_features, weight, score, rank)} for distinct doc_ids."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    found = {d: features(t) for d, t in docs}
    s = collections.Counter(bucket(f) for _, fs in found.values() for f in fs)
    t = collections.Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10000)}
    out = {}
    for d, (n, fs) in found.items():
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(f)] for f in fs)
        out[d] = [len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    eligible = sorted((d for d in found if found[d][0] >= 20), key=lambda d: (-out[d][2], d is None, d or 0))
    for i, d in enumerate(eligible[: percent * len(eligible) // 100]):
        out[d][3] = i + 1
    return out


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        assert [r.n_features, r.weight, r.score, r["rank"]] == want[r.doc_id], r


def test_registered_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    target = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert sum(x[3] is not None for x in want.values()) == 9
    check(I.importance_sample(docs, target).collect(), want)


def frame(spark, rows):
    return spark.createDataFrame([(t, d, 1, "x", 2) for d, t in rows], "text string, doc_id long, rank long, score string, _row int")


def test_edges(spark):
    same = "one two three " * 10
    rows = [(1, None), (2, ""), (3, "A"), (4, "été Ünï 12-a"), (5, same), (6, same), (7, "あ" * 30), (None, same),
            (8, "x " * 19), (9, "x " * 20), (10, " \x00 ")]
    got = I.importance_sample(frame(spark, rows), frame(spark, [(1, "one two"), (2, None)]), percent=100).collect()
    check(got, brute(rows, ["one two", None], percent=100))
    drawn = [r.doc_id for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    assert sorted(drawn, key=str) == sorted([5, 6, 9, None], key=str)
    assert I.importance_sample(frame(spark, []), frame(spark, [])).collect() == []


def test_ranks_of_repeated_rows(spark):
    """Rows of one doc_id and one text tie: each gets a rank of its own."""
    rows = [(7, "a b c " * 10)] * 50 + [(i, f"w{i} " * 25) for i in range(100, 150)]
    got = I.importance_sample(frame(spark, rows).repartition(5), frame(spark, [(1, "a b")]), percent=80).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 81))
    placed = sorted((-r.score, r.doc_id, r["rank"] or 81) for r in got)
    assert [x[2] for x in placed][:80] == list(range(1, 81))


@pytest.mark.parametrize("stretch", [7, 64, 1 << 22])
def test_long_texts_in_stretches(monkeypatch, stretch):
    monkeypatch.setattr(I, "STRETCH", stretch)
    text = " ".join(f"w{i % 13}é" + "long" * (i % 7) for i in range(500)) + "z" * 200
    got, n_words = collections.Counter(), 0
    for bucket, owner, words in I.features([text.encode()]):
        assert not owner.any()
        got.update(bucket.tolist())
        n_words += len(words)
    n, fs = features(text)
    assert n_words == n and got == collections.Counter(zlib.crc32(f.encode()) % 10000 for f in fs)


def test_texts_of_a_run_do_not_touch():
    texts = ["a b", "", "c", "d e f g", " h "]
    owners = collections.Counter()
    for _, owner, _ in I.features([t.encode() for t in texts]):
        owners.update(owner.tolist())
    assert [owners[i] for i in range(5)] == [len(features(t)[1]) for t in texts]

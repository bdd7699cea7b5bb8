import random

import pytest

from noticeflow.llm import substring_dedup as S

from ..conftest import SF_SMALL
from . import brute


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, n_words string, carry long")


def passages(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 90))] for _ in range(6)]
    rows = []
    for d in rng.sample(range(1000), 40):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(shared)[rng.randint(0, 3) :] if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(1, 60))
        rows.append((d, rng.choice(["", "  ", "\n"]) + rng.choice([" ", "  ", "\t\n"]).join(w)))
    return rows + [(2000 + i, t) for i, (_, t) in enumerate(rows[:5])]


@pytest.mark.parametrize("window", [20, 7])
def test_same_as_brute_force(spark, window):
    rows = passages()
    got = {r.doc_id: r for r in S.remove_repeats(frame(spark, rows), window).collect()}
    texts = dict(rows)
    cut = {r.doc_id: r.text for r in S.cut_repeats(frame(spark, rows), window).collect()}
    removed = 0
    for d, w, drop in brute.repeats(rows, window):
        kept = " ".join(x for x, gone in zip(w, drop) if not gone)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), sum(drop), brute.sha(kept)), d
        assert " ".join(brute.words(cut[d])) == kept
        if not any(drop):
            assert cut[d] == texts[d]
        removed += sum(drop)
    assert removed > 100


def test_registered_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in S.remove_repeats(docs).collect()}
    for d, w, drop in brute.repeats(rows, 20):
        kept = " ".join(x for x, gone in zip(w, drop) if not gone)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), sum(drop), brute.sha(kept))


def test_edges(spark):
    block = " ".join(f"k{i}" for i in range(20))
    long = " ".join(f"v{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, block), (3, block), (None, block), (4, "x " + block + " y"), (5, long), (6, long), (None, None)]
    got = S.remove_repeats(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    count = {(r.doc_id, r.n_words, r.n_removed) for r in got}
    # Rows of one doc_id do not remove each other; a row without doc_id takes no part.
    assert count == {(1, 0, 0), (2, 0, 0), (3, 20, 0), (None, 20, 0), (4, 22, 20), (5, 40_000, 0), (6, 40_000, 40_000), (None, 0, 0)}
    cut = S.cut_repeats(frame(spark, rows))
    assert cut.columns == ["doc_id", "text", "n_words", "carry"]
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert {(1, None), (2, ""), (4, "x y"), (6, ""), (None, None), (None, block)} <= texts
    assert S.remove_repeats(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        S.remove_repeats(frame(spark, []), 1)


def test_repeats_inside_one_text(spark):
    block = " ".join(f"k{i}" for i in range(20))
    (r,) = S.remove_repeats(frame(spark, [(1, f"{block} mid {block}")])).collect()
    assert (r.n_words, r.n_removed) == (41, 20)
    same = " ".join(["a"] * 50)  # every window but the first starts earlier as well
    (r,) = S.remove_repeats(frame(spark, [(1, same)])).collect()
    assert (r.n_words, r.n_removed, r.kept_sha256) == (50, 49, brute.sha("a"))

import random

import pytest

from noticeflow.llm import minmax_dedup as M

from ..conftest import SF_SMALL
from . import brute

SCHEMA = "doc_id long, text string, kept string, n_shingles string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)


def run(spark, rows, **params):
    return M.near_duplicates(frame(spark, rows), **params).collect()


def near_copies(seed=1):
    """Chains of edits, so that groups hold pairs on both sides of the limit."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(8):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 12)):
            copy = list(text)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy).title() if rng.random() < 0.3 else " ".join(copy))
            if rng.random() < 0.5:
                text = copy
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_same_components_as_brute_force(spark, size, percent):
    rows = near_copies()
    want = brute.components(rows, size, percent)
    got = run(spark, rows, shingle=size, percent=percent)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(brute.shingles(t, size)) for d, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert 1 < sum(r.kept for r in got) < len(rows)


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 4)
    rows = near_copies(2)
    got = run(spark, rows, shingle=3, percent=85)
    assert {r.doc_id: r.component_id for r in got} == brute.components(rows, 3, 85)


def test_registered_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = M.near_duplicates(docs, shingle=3, percent=85, rows=5, bands=40).collect()
    assert {r.doc_id: r.component_id for r in got} == brute.components(rows, 3, 85)


def test_edges(spark):
    long = " ".join(f"v{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "two one"), (7, long), (8, long + " z"),
        (9, "a b c d"), (9, "a b c d"), (10, "é à ü"), (11, "É à ü"), (None, "a b c d"), (None, None),
    ]
    got = run(spark, rows, shingle=3, percent=85)
    assert len(got) == len(rows)
    of = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert of == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11}
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert (sizes[1], sizes[2], sizes[3], sizes[4], sizes[9]) == (0, 0, 0, 1, 2)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert run(spark, []) == []


def test_one_doc_id_with_two_texts_joins_their_groups(spark):
    a, b = "q w e r t y u i o p", "a s d f g h j k l m"
    got = run(spark, [(5, a), (5, b), (2, b), (7, a)], shingle=3, percent=85)
    assert {r.doc_id: r.component_id for r in got} == {5: 2, 2: 2, 7: 2}


def test_drop_keeps_columns_and_one_of_each_group(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z"), (3, "x y z"), (None, "a b c d e f")]
    kept = M.drop_near_duplicates(frame(spark, rows), shingle=5, percent=80)
    assert kept.columns == ["doc_id", "text", "kept", "n_shingles"]
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3]


def test_both_ends_of_a_hash_estimate_the_similarity():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    words = [f"t{i}" for i in range(600)]
    a, b = words[:400], words[100:500]  # one-word shingles: similarity 0.6
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [" ".join(a), " ".join(rng.permutation(b))]})
    (out,) = M._signatures(1, 1, 400)([batch])
    x, y = (np.array(v) for v in out.column("bands").to_pylist())
    assert abs((x == y).mean() - 0.6) < 0.1
    assert abs((x == y)[::2].mean() - 0.6) < 0.12 and abs((x == y)[1::2].mean() - 0.6) < 0.12


def test_drop_judges_different_texts_of_one_doc_id_each_by_itself(spark):
    a, b, c = "a b c d e f g", "q w e r t y u", "z x c v b n m"
    rows = [(1, a), (1, b), (1, b), (2, b), (3, c), (3, c), (4, a), (5, None), (5, "o p"), (None, a)]
    kept = M.drop_near_duplicates(frame(spark, rows), shingle=5, percent=80).collect()
    assert sorted(r.text or "" for r in kept if r.doc_id is not None) == ["", a, "o p", b, c]
    assert [r.text for r in kept if r.doc_id is None] == [a]


def test_columns_of_any_name_come_back_as_they_were(spark):
    names = ["_key", "_low", "_high", "row", "id", "key", "mark", "low", "several_id", "kept_id", "kept"]
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, text), (3, "other words"), (3, "other words of one id"), (None, text)]
    docs = spark.createDataFrame([(d, t, *[f"{n}{d}" for n in names]) for d, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = M.drop_near_duplicates(docs, shingle=5, percent=80).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 3, 3]
    assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)

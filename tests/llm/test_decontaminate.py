import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeflow.llm import decontaminate as D

from . import brute


def test_lcs_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(50):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 90))]
        b = [rng.randint(0, 6) for _ in range(rng.randint(0, 90))]
        assert D.lcs_length(D._masks(a), len(a), b) == brute.lcs(a, b)


def test_sketched_singular_vectors():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((400, 6)) @ rng.standard_normal((6, D.COLUMNS // 64)) * 3
    a += 0.01 * rng.standard_normal(a.shape)
    g = rng.standard_normal((a.shape[1], 16))
    v, s = D.singular_vectors(a.T @ (a @ g), g, 6)
    _, want, vt = np.linalg.svd(a, full_matrices=False)
    assert s == pytest.approx(want[:6], rel=1e-3)
    assert np.linalg.norm(vt[:6] @ v) == pytest.approx(np.sqrt(6), rel=1e-3)  # the same subspace


def test_a_task_s_share_is_the_matrix_product():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 65536, n).astype(np.uint16) for n in (0, 1, 24, 25, 400)]
    texts.append(np.repeat(rng.integers(0, 65536, 5).astype(np.uint16), 60))  # frequent columns
    batch = pa.RecordBatch.from_pydict({"terms": pa.array([t.tobytes() for t in texts], pa.binary())})
    idf = rng.random(D.COLUMNS).astype(np.float32) + 0.1
    (out,) = D._sketch(idf)([batch])
    z = np.concatenate([np.frombuffer(x, np.float32) for x in out.column("data").to_pylist()]).reshape(D.COLUMNS, -1)
    rows = []
    for t in texts:
        for a in range(0, len(t), D.PASSAGE):
            columns = t[a : a + D.PASSAGE] >> (16 - D.TERM_BITS)
            row = np.zeros(D.COLUMNS)
            np.add.at(row, columns, idf[columns])
            rows.append(row / np.sqrt((idf[columns] ** 2).sum()))
    a = np.array(rows)
    assert z == pytest.approx(a.T @ (a @ D._gaussian()), rel=1e-3, abs=1e-3)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("ka", "to", "mi", "ré", "lu", "ge", "no", "sa") for b in ("ri", "da", "pe", "ko", "vu", "be", "x", "th")]
    say = lambda n: [rng.choice(vocabulary) + rng.choice(["", "", "s", "n"]) for _ in range(n)]
    items = [(i, say(rng.randint(14, 60))) for i in range(30)] + [(90, say(7)), (91, []), (92, say(40))]
    rows, truth, changed = [], set(), set()
    for d in range(300):
        w = say(rng.randint(0, 300))
        if d % 5 == 0:
            i, item = rng.choice(items[:30])
            item = list(item)
            kind = d % 4
            if kind == 1:  # one word in eight replaced
                for k in range(3, len(item) - 6, 8):
                    item[k] = say(1)[0]
                changed.add((d, i))
            at = rng.randint(0, len(w))
            passage = [x.upper() for x in item] if kind == 2 else item
            w = w[:at] + passage + w[at:]
            truth.add((d, i))
        if d == 7:
            w = w[:3] + items[30][1] + w[3:]
            truth.add((7, 90))
        rows.append((d, rng.choice([" ", ", ", ".\n"]).join(w)))
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, lcs string")
    bench = spark.createDataFrame([(i, " ".join(w), 0) for i, w in items], "item_id long, text string, doc_id long")
    return docs, bench, truth, changed


def test_planted_items_are_found_and_nothing_else(planted):
    docs, bench, truth, changed = planted
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    # Every copy, upper-cased ones included; nearly every paraphrase.
    assert truth - changed <= got <= truth and len(truth & changed - got) <= 0.2 * len(changed)
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(300)) - {d for d, _ in got}


def test_blocks_of_items_change_nothing(planted, monkeypatch):
    docs, bench, truth, changed = planted
    whole = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()} == whole


def test_registered_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: " " + " ".join(brute.terms(r.text)) + " " for r in bench.collect()}
    want = set()
    for r in docs.collect():
        text = " " + " ".join(brute.terms(r.text)) + " "
        want |= {(r.doc_id, i) for i, x in items.items() if x in text}
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert len(want) > 10 and got == want


def test_edges(spark):
    item = " ".join(f"item{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "x " * 60_000 + item), (5, item[:60]), (6, "!!! ...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, item)], "item_id long, text string")
    got = D.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, i) for d in (3, None, 4) for i in (1, None)}
    # The row without doc_id that holds the item goes, another one stays.
    more = docs.union(spark.createDataFrame([(None, "plain words", "clash")], docs.schema))
    kept = D.drop_contaminated(more, bench).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, 1, 2, 5, 6] and [r.text for r in kept if r.doc_id is None] == ["plain words"]
    assert D.contaminated(docs.limit(0), bench).collect() == [] == D.contaminated(docs, bench.limit(0)).collect()
    assert D.contaminated(docs.filter("doc_id < 3"), bench).collect() == []


@pytest.mark.parametrize("share", [1 / 8, 1 / 4, 1 / 3, 0.45])
def test_every_paraphrase_that_the_rule_accepts_is_found(spark, share):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rng = random.Random(int(100 * share))
    filler = [w for r in docs.limit(200).collect() for w in brute.terms(r.text or "")]
    rows, accepted = [], set()
    for r in bench.collect():
        item = brute.terms(r.text)
        if len(item) < D.SHORT_PASSAGE:
            continue
        for _ in range(8):
            copy = list(item)
            for k in rng.sample(range(len(item) - D.ANSWER), min(round(share * len(item)), len(item) - D.ANSWER)):
                copy[k] = rng.choice(filler)
            at, n = rng.randrange(len(filler) - 300), rng.randint(0, 200)
            d = 1_000_000 + len(rows)
            rows.append((d, " ".join(filler[at : at + n] + copy + filler[at + n : at + n + 90])))
            if brute.lcs(item, copy) >= 0.5 * len(item):
                accepted.add((d, r.item_id))
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs.union(planted), bench).collect()}
    assert len(accepted) >= 200 and not accepted - got


def test_rare_terms_lose_no_stretch_that_holds_enough(monkeypatch):
    rng = random.Random(3)
    items = [rng.choices(range(0, 65536, 331), k=rng.randint(12, 70)) for _ in range(9)]
    rate = np.random.default_rng(1).random(D.COLUMNS) / 4
    rare = D.RareTerms(items, list(range(9)), rate, 0.5)
    texts, planted = [], []
    for t in range(120):
        i = rng.randrange(9)
        n = len(items[i])
        kept = sorted(rng.sample(range(n), -(-n // 2)))
        stretch = [rng.randrange(65536) for _ in range(D.span(n))]
        for k, place in zip(kept, sorted(rng.sample(range(len(stretch)), len(kept)))):
            stretch[place] = items[i][k]
        at = rng.randint(0, 200)
        texts.append([rng.randrange(65536) for _ in range(at)] + stretch + [1] * rng.randint(0, 50))
        planted.append((t, at, i))
    texts += [[], [5]]
    hashes, first = np.array(sum(texts, []), np.uint16), np.concatenate(([0], np.cumsum([len(x) for x in texts])))
    for cells in (D.CELLS, 50):  # in one table and in many
        monkeypatch.setattr(D, "CELLS", cells)
        assert {(t, at // D.UNIT * D.UNIT, i) for t, at, i in planted} <= set(rare.candidates(hashes, first))


def test_short_items_are_judged_on_their_words(spark):
    # Words with the same 16-bit hash as the item's: a hit by collision only.
    pool = np.array([f"w{i}" for i in range(400_000)])
    hashes = D.terms(pa.array([" ".join(pool)]))[0]
    twin = lambda k: str(pool[np.flatnonzero(hashes == hashes[k])[1]])
    one, two = str(pool[0]), [str(x) for x in pool[1:3]]
    assert twin(0) != one
    eight = "quiet rivers carry seven golden boats past midnight".split()
    gone, added = eight[:2] + ["other"] + eight[3:], eight[:4] + ["very"] + eight[4:]
    rows = [
        (1, f"a {twin(0)} b"), (2, f"a {one} b"), (3, f"a {twin(1)} {twin(2)} b"), (4, f"a {' '.join(two)} b"), (5, " x ".join(two)),
        (6, "so " * 30 + " ".join(eight)), (7, "so " * 15 + " ".join(gone) + " end"), (8, " ".join(added).upper()),
        (9, " ".join(reversed(eight))), (10, " so so ".join(eight)), (11, " ".join(eight[:5])), (12, None), (None, " ".join(gone)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, one), (2, " ".join(two)), (3, " ".join(eight))], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.lcs) for r in D.contaminated(docs, bench).collect()}
    assert got == {(2, 1, 1), (4, 2, 2), (6, 3, 8), (7, 3, 7), (8, 3, 8), (None, 3, 7)}

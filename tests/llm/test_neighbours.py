import numpy as np
import pytest

from noticeflow.llm import neighbours as N

from ..conftest import SF_SMALL


def frame(spark, rows):
    return spark.createDataFrame([(r, e, "x", 0.5) for r, e in rows], "vec_id long, embedding array<double>, rank string, score double")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def check(got, want):
    """The same queries, exact scores in order, and the share of neighbours found."""
    assert got.keys() == want.keys()
    hit = total = 0
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, len(want[q]) + 1))
        order = [(-s, v) for _, v, s in rows]
        assert order == sorted(order) and q not in [v for _, v, _ in rows]
        hit += len({v for _, v, _ in rows} & {v for v, _ in want[q]})
        total += len(want[q])
    return hit / max(total, 1)


def plain(rows, every=20, k=20):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    least = {}
    for i, v in usable:
        least[i] = min(least.get(i, v), v)
    return N.brute_force(list(least.items()), every, k)


def test_registered_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    got, want = found(N.nearest(df)), plain(rows)
    assert check(got, want) == 1.0  # the pool covers so few rows
    assert all([(v, s) for _, v, s in got[q]] == want[q] for q in got)


@pytest.mark.parametrize("kind", ["spread", "clusters", "lengths"])
def test_recall_beyond_the_pool(spark, monkeypatch, kind):
    """Through the cells, and not the pool: whole rows, recall as fitted."""
    monkeypatch.setattr(N, "POOL", 64)
    rng = np.random.default_rng(8)
    v = rng.standard_normal((6000, 24))
    if kind == "clusters":
        v = v[rng.integers(0, 60, 6000)] + 0.3 * v
    if kind == "lengths":
        v *= rng.lognormal(0, 0.4, (6000, 1))
    else:
        v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    index = N.Index(frame(spark, rows))
    index.fit()
    assert index.filled == (kind == "lengths") and 0 < index.probes <= index.hashes.cells
    if kind == "clusters":
        assert index.probes < index.hashes.cells / 4  # probing follows the data
    assert check(found(index.search()), plain(rows)) >= 0.9


def test_two_functions_and_hot_cells(spark, monkeypatch):
    """A third of the rows in one cell, dealt out in blocks of both sides."""
    monkeypatch.setattr(N, "POOL", 64)
    monkeypatch.setattr(N, "BLOCK", 100)
    monkeypatch.setattr(N, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(9)
    v = rng.standard_normal((3000, 8))
    v[::3] = v[0] + 1e-3 * rng.standard_normal((1000, 8))
    v[3:300:3] = v[3]  # equal vectors: vec_id decides
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    index = N.Index(frame(spark, rows))
    assert index.hashes.functions == 2
    index.fit()
    got, want = found(index.search()), plain(rows)
    assert check(got, want) >= 0.9
    same = [q for q in got if q % 3 == 0 and 3 <= q < 300]
    assert same and all([x[1] for x in got[q]] == [x[0] for x in want[q]] for q in same)


def test_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (20, [0.5, 0.5, 1.0]),
            (21, [2.0]), (21, [1.0, 5.0]), (40, [-1.0, 0.0]), (40, [-1.0, 0.0]), (None, [1.0, 1.0]), (60, [float("inf")])]
    got, want = found(N.nearest(frame(spark, rows))), plain(rows)
    assert {q: [(v, s) for _, v, s in x] for q, x in got.items()} == want
    assert set(got) == {0, 20, 40} and [v for _, v, _ in got[0]] == [21, 20, 40]
    assert N.nearest(frame(spark, [])).collect() == []
    assert N.nearest(frame(spark, [(20, [1.0])])).collect() == []
    assert N.nearest(frame(spark, [(1, [1.0]), (2, [1.0])])).collect() == []


def test_hadamard_is_a_rotation():
    a = np.random.default_rng(1).standard_normal((5, 16))
    b = N.hadamard(a)
    assert np.allclose(a @ a.T, b @ b.T) and np.allclose(N.hadamard(b), a)


def test_probes_order_all_cells():
    h = N.CrossPolytope(6, 2, tables=1)
    x = np.random.default_rng(2).standard_normal((4, 6))
    cells = h.probes(x, 0, h.cells)
    assert (np.sort(cells, axis=1) == np.arange(h.cells)).all()
    assert (cells[:, 0] == h.cell(x, 0)).all()  # its own cell comes first
    first = h.probes(x, 0, 10)
    assert (first == cells[:, :10]).all()


def test_scores_do_not_depend_on_blocks():
    rng = np.random.default_rng(4)
    q, v = rng.standard_normal((7, 33)), rng.standard_normal((50, 33))
    v[10:40] = v[10]
    ids = rng.permutation(50)
    none = np.full(7, -np.inf)
    r, c, s = N.best(q, np.arange(7) + 1000, none, v, ids, 12)
    for i in range(7):
        alone = N.best(q[i : i + 1], np.array([1000 + i]), none[:1], v, ids, 12)
        assert (alone[1] == c[r == i]).all() and (alone[2] == s[r == i]).all()

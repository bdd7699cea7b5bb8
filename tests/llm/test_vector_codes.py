import hashlib
import math

import numpy as np
import pytest

from noticeflow.llm import vector_codes as V

from ..conftest import SF_SMALL


def brute(rows, entries=16, rounds=6):
    """([(vec_id, code, error, label_error)], digest) with Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in kept), default=1) // 8)) * 8
    size = width // 8
    ints = [[math.floor(4096 * float(x)) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    cut = [[v[p * size : (p + 1) * size] for p in range(8)] for v in ints]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            own = [nearest(v[p], books[p])[1] for v in cut]
            for e in range(len(books[p])):
                mine = [v[p] for v, o in zip(cut, own) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [[nearest(v[p], books[p]) for p in range(8)] for v in cut]
    errors, by_label = [sum(d for d, _ in f) for f in final], {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = [(r[0], "".join(f"{e:02x}" for _, e in f), err, by_label[r[2]]) for r, f, err in zip(kept, final, errors)]
    return out, digest


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error long")


def key(r):
    return str(r)


def check(spark, rows, **kind):
    want, digest = brute(rows, **kind)
    got = V.vector_codes(frame(spark, rows), **kind).collect()
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=key) == sorted(want, key=key)
    assert all(r.codebooks_sha256 == digest for r in got)


def test_registered_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(spark, rows)


def test_clusters_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-3, 4, (12, 16)) / 8.0
    rows = [(i, (centres[i % 12] + rng.integers(-1, 2, 16) / 4096.0).tolist(), i % 3) for i in range(600)]
    rows += [(1000 + i, centres[0].tolist(), None) for i in range(300)]  # a third are copies
    check(spark, rows)
    check(spark, rows, entries=5, rounds=9)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [0.1, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 2), (5, [0.25, -0.3, 1.0], None),
            (5, [0.25, -0.3, 1.0], None), (None, [1.0] * 9, 2), (6, [], 2), (7, [-1e-9] * 10, 3), (8, [7.5] * 10, 3)]
    check(spark, rows)
    assert V.vector_codes(frame(spark, [])).collect() == []
    assert V.vector_codes(frame(spark, rows[:4])).collect() == []
    huge = V.vector_codes(frame(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1)])).collect()
    assert sorted(r.code for r in huge) == ["00" * 8, "01" * 8] and all(r.error == 0 for r in huge)


@pytest.mark.parametrize("b", [1, 2, 4, 7])
def test_bounds_hold_while_entries_move(b):
    """After every move the own entry is the nearest by integers, every bound
    holds, and most parts are decided unseen once entries hardly move."""
    rng = np.random.default_rng(b)
    x = rng.integers(-900, 900, (2000, 8))
    entries = x[:16].copy()
    state, unseen = V.Bounds.fresh(x, entries, b), []
    for step in (400, 90, 20, 4, 1, 0):
        new = entries + rng.integers(-step, step + 1, entries.shape)
        state = state.advance(x, new, np.sqrt(((new - entries) ** 2).sum(axis=1)) * V._UP)
        entries = new
        d = V.distances(x, entries)
        assert (state.near[:, 0] == d.argmin(axis=1)).all()  # argmin: the lower index of ties
        far = np.sqrt(d)
        rows = np.arange(len(x))
        assert (far[rows, state.near[:, 0]] <= state.upper).all()
        others = np.ones(d.shape, bool)
        others[rows, state.near[:, 0]] = False
        for j in range(state.lower.shape[1]):
            assert (state.lower[:, j] <= far[rows, state.near[:, j + 1]]).all()
            others[rows, state.near[:, j + 1]] = False
        assert (state.outer <= np.where(others, far, np.inf).min(axis=1)).all()
        unseen.append((state.need == 0).mean())
    assert unseen[-1] > 0.9


def test_later_rounds_compare_few(spark):
    """The point of the bounds: the last round compares all entries for few parts only."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 16))
    rows = [(i, (centres[i % 16] + rng.normal(size=16) * 0.05).tolist(), 0) for i in range(2000)]
    codes = V.Codes(frame(spark, rows))
    assert len(codes.needs) >= 3
    assert codes.needs[0][16] == 2000 * 8  # the first round sees all
    assert codes.needs[-1][0] > 0.8 * 2000 * 8
    assert codes.b <= V.START_B

import random

import numpy as np
import pyarrow as pa
import pytest

from noticeflow.llm import viterbi as V
from noticeflow.llm.vocab import file_bytes

from . import brute

ODD = [
    "", " ", "  ", "a", " a ", "Hello  world\n\tnew\r\nline", "naïve café ÜBER", "日本語テキスト", "😀👩‍👩‍👧 ▁ ▁▁x", "\x00\x01￾",
    "x" * 300, "▁" * 5 + " y", "0x0A<0x0A><s></s><unk>", "word" * 200 + " " * 40 + "end", "ẞßſ  　  z",
]


@pytest.fixture(scope="module")
def model():
    return V.PieceModel(file_bytes(V.MODEL))


def score(model, text, ids):
    """Sum of scores; a character in byte pieces counts as one unknown."""
    best, k = 0.0, 0
    while k < len(ids):
        i = int(ids[k])
        if i in model.byte_ids.values():
            first = model.decoded[i][0]
            k += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            best += model.unknown
        else:
            best += model.nodes[model.pieces[i]][0]
            k += 1
    return best


def test_best_segmentation_and_round_trip(model):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abcdefghilnorstu éàß日本.,-\n") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    for text in texts:
        ids = model.encode(text)
        assert model.decode(ids) == text
        if text and V.SPACE not in text:
            whole = (" " + text).replace(" ", V.SPACE)
            best, _ = brute.viterbi(whole, model.nodes, model.longest, model.unknown)
            assert score(model, whole, ids) == best[-1], text


def test_commits_while_streaming(model, monkeypatch):
    """The window is cut long before the text ends, with the same result."""
    text = V.SPACE + "internationalisation" * 60
    kept = []
    path = V.PieceModel._path
    monkeypatch.setattr(V.PieceModel, "_path", lambda self, t, base, end, back: kept.append((base, end)) or path(self, t, base, end, back))
    ids = model.segment(text)
    best, back = brute.viterbi(text, model.nodes, model.longest, model.unknown)
    want, at = [], len(text)
    while at:
        begin, piece = back[at]
        want.append(piece)
        at = begin
    assert ids == want[::-1]
    assert len(kept) > 10 and max(end for _, end in kept) <= 8 * model.longest


def test_stretches_change_nothing(model, monkeypatch):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("abe .,\n-é日▁(1") for _ in range(rng.randint(0, 200))) for _ in range(80)] + [None]
    for limit in (2_000_000, 7):
        monkeypatch.setattr(model.cache, "limit", limit)
        for a in range(0, len(texts), 30):
            part = texts[a : a + 30]
            ids, bounds = model.encode_column(pa.array(part, pa.string()))
            got = [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:])]
            assert got == [model.encode(t or "") for t in part]


def test_table(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x", 1), (0, None, 2), (5, "twice", 3), (5, "twice", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    out = V.encode_pieces(docs)
    got = out.collect()
    assert len(got) == len(rows) and all(r.exact and r.n_tokens == len(r.ids) for r in got)
    back = V.decode_pieces(out).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((d or -1 if d is not None else -1, t or "") for d, t, _ in rows)
    assert V.encode_pieces(docs.limit(0)).collect() == []


def test_every_byte_decodes(model):
    ids = np.array([model.byte_ids[b] for b in "é\n".encode()])
    assert model.decode(ids) == "é\n"

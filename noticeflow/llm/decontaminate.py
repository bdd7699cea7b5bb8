"""Benchmark decontamination by latent semantic retrieval.

1. Every text becomes a row of 16-bit term hashes (letters and digits,
   lower-cased), written once.
2. Passages are stretches of ``PASSAGE`` terms; their document frequencies
   give IDF weights (an aggregate over all passages).
3. Distributed randomised SVD of the TF-IDF passage matrix A: each task adds
   up its share of Z = A'(A G) for a fixed Gaussian G; the sum of the shares,
   a matrix of fixed size, gives the leading right singular vectors and
   singular values (Nystroem form: one pass).
4. Passages (overlapping, every ``STRIDE`` terms) and the windows of the
   benchmark items are mapped to latent vectors; pairs with a cosine of at
   least ``cosine`` are candidates.
5. A paraphrase may lie below that cosine, so stretches of text that hold
   enough of an item's rare terms are candidates as well. An item that may
   miss ``size - need`` of its terms holds at least ``need - (size - n)`` of
   any n of them, so this bound loses nothing that step 6 accepts.
6. A candidate is confirmed on the words: the longest common subsequence of
   the whole item with the text around the passage, and whether the item's
   answer (its last words) is there. A paraphrase that keeps the answer needs
   a shorter subsequence.

Items of fewer than ``SHORT_PASSAGE`` terms are too short for latent vectors.
They are searched in the texts themselves, by rare terms and then on 64-bit
hashes: from ``LCS_LEAST`` terms on by their longest common subsequence with
hardly longer stretches, below that word for word.

The benchmark is a stated query set, taken in blocks of ``BLOCK_ITEMS``
items; each block is searched against all passages where they lie, so there
is no join and no shuffle of texts.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp as T
from .common import materialise, ready, release

TERM_BITS = 14  # columns of the passage matrix
COLUMNS = 1 << TERM_BITS
RANK, EXTRA = 56, 8
PASSAGE, STRIDE = 24, 8
#: Items with fewer terms than PASSAGE are searched with passages of this length.
SHORT_PASSAGE, SHORT_STRIDE = 12, 4
BLOCK_ITEMS = 2000
ANSWER = 5
#: Rare terms are placed in units of this length; CELLS terms of text at a time.
UNIT, CELLS = 16, 1 << 17
#: Items with fewer terms must occur word for word.
LCS_LEAST = 6
_ROWS = 128  # rows of Z per exchanged block


def whole_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the 64-bit term hashes of all texts, end to end."""
    data, offsets = T.text_buffer(pc.utf8_lower(column))
    starts, ends, first = T.word_spans(data, offsets, T.NOT_TERM)
    return T.word_hashes(data, starts, ends, between=T.NOT_TERM), first


def _cut(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.uint16)


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the 16-bit term hashes of all texts, end to end."""
    hashes, first = whole_terms(column)
    return _cut(hashes), first


def _tokenise(batches):
    for batch in batches:
        for rows in T.pieces(batch, "text"):
            hashes, first = terms(rows.column("text"))
            raw = hashes.tobytes()
            packed = [raw[2 * a : 2 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.record_batch([rows.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "terms"])


def _term_rows(batch: pa.RecordBatch, terms: int = 16_000):
    """Runs of rows as (row range, hashes, first), about ``terms`` terms each:
    what is computed for them stays in the processor's cache."""
    packed = batch.column("terms").to_pylist()
    for a, b in T.slices(np.array([len(p) for p in packed]), 2 * terms):
        hashes = np.frombuffer(b"".join(packed[a:b]), np.uint16)
        yield a, b, hashes, np.concatenate(([0], np.cumsum([len(p) // 2 for p in packed[a:b]])))


def _passages(first: np.ndarray) -> np.ndarray:
    """Starts of the passages, end to end within each text."""
    n = -(-np.diff(first) // PASSAGE)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first[:-1], n) + k * PASSAGE


def _frequencies(batches):
    found, n = np.zeros(COLUMNS, np.int64), 0
    for batch in batches:
        for _, _, hashes, first in _term_rows(batch):
            starts = _passages(first)
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(hashes))))
            cells = np.unique((passage << TERM_BITS) | (hashes >> (16 - TERM_BITS)))
            found += np.bincount(cells & (COLUMNS - 1), minlength=COLUMNS)
            n += len(starts)
    where = np.flatnonzero(found)
    yield pa.record_batch(
        [pa.array(np.append(where, -1).astype(np.int32)), pa.array(np.append(found[where], n))], names=["term", "df"]
    )


def _gaussian() -> np.ndarray:
    return np.random.default_rng(13).standard_normal((COLUMNS, RANK + EXTRA)).astype(np.float32)


def _padded(hashes: np.ndarray, first: np.ndarray, unit: int, least: int = 0):
    """(columns, starts): the terms' columns with every text filled up to a
    multiple of ``unit`` and at least ``least`` by the empty column COLUMNS."""
    lengths = np.diff(first)
    size = np.maximum(-(-lengths // unit) * unit, least)
    starts = np.concatenate(([0], np.cumsum(size)))
    out = np.full(int(starts[-1]), COLUMNS, np.int32)
    out[np.arange(len(hashes)) + np.repeat(starts[:-1] - first[:-1], lengths)] = hashes >> (16 - TERM_BITS)
    return out, starts


def _block_sums(rows: np.ndarray, columns: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each ``size`` columns."""
    out = np.take(rows, columns[::size], axis=0, mode="clip")  # places are in range; "clip" saves a copy
    more = np.empty_like(out)
    for k in range(1, size):
        out += np.take(rows, columns[k::size], axis=0, out=more, mode="clip")
    return out


def _scatter(share: np.ndarray, columns: np.ndarray, passage: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """share[column] += weight[column] * y[passage] for every term."""
    order = np.argsort(columns.astype(np.uint16), kind="stable")  # 16 bits: a radix sort
    columns, passage = columns[order], passage[order]
    begin = np.flatnonzero(np.append(True, columns[1:] != columns[:-1]))
    times = np.diff(np.append(begin, len(columns)))
    # Frequent columns by a product with their counts per passage ...
    often = times > 8
    if often.any():
        inside = np.repeat(often, times)
        which = np.repeat(np.cumsum(often) - 1, times)[inside]
        n = int(often.sum())
        cells = np.bincount(which * len(y) + passage[inside], minlength=n * len(y)).reshape(n, len(y))
        at = columns[begin[often]]
        share[at] += weight[at][:, None] * (cells.astype(np.float32) @ y)
    # ... the others one occurrence after the other (no column twice at once).
    for k in range(8):
        use = begin[~often & (times > k)] + k
        if not len(use):
            break
        at = columns[use]
        share[at] += weight[at][:, None] * np.take(y, passage[use], axis=0, mode="clip")


def _sketch(idf: np.ndarray):
    """Each task's share of Z, in blocks of rows."""

    def run(batches):
        empty = np.zeros((1, RANK + EXTRA), np.float32)
        weighted = np.concatenate([_gaussian() * idf[:, None], empty])
        weight = np.append(idf, np.float32(0))
        square = (weight * weight)[:, None]
        share = np.zeros((COLUMNS, RANK + EXTRA), np.float32)
        for batch in batches:
            for _, _, hashes, first in _term_rows(batch):
                if not len(hashes):
                    continue
                columns, _ = _padded(hashes, first, PASSAGE)
                y = _block_sums(weighted, columns, PASSAGE)
                y /= _block_sums(square, columns, PASSAGE)
                passage = np.repeat(np.arange(len(y)), PASSAGE)
                real = columns < COLUMNS
                _scatter(share, columns[real], passage[real], y, weight)
        blocks = share.reshape(-1, _ROWS * (RANK + EXTRA))
        yield pa.record_batch(
            [pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([b.tobytes() for b in blocks], pa.binary())],
            names=["block", "data"],
        )

    return run


def _add_up(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
            part = np.frombuffer(data, np.float32)
            total[block] = total[block] + part if block in total else part.astype(np.float64)
    if total:
        yield pa.record_batch(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            names=["block", "data"],
        )


def singular_vectors(z: np.ndarray, g: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors and singular values of A from
    Z = A'A G (the Nystroem approximation of A'A with a stabilising shift)."""
    z, g = z.astype(np.float64), g.astype(np.float64)
    shift = np.sqrt(len(z)) * np.finfo(np.float32).eps * np.linalg.norm(z, 2)
    z = z + shift * g
    c = g.T @ z
    c = (c + c.T) / 2
    value, vector = np.linalg.eigh(c)
    keep = value > value.max() * 1e-9
    root = z @ (vector[:, keep] / np.sqrt(value[keep]))
    u, s, _ = np.linalg.svd(root, full_matrices=False)
    s = np.sqrt(np.maximum(s * s - shift, 0))
    use = (s > s.max() * 1e-4) & (np.arange(len(s)) < rank)
    return u[:, use], s[use]


def latent_terms(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """(latent, rate): the latent vector of every term column (and of the empty
    one; a passage's vector is the sum of its terms' vectors), and the share of
    passages that hold the column. None for a corpus without terms."""
    df = tokens.select("terms").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    table = {r["term"]: r["df"] for r in df.collect()}  # COLUMNS + 1 rows at most
    n = table.pop(-1, 0)
    if not table:
        return None
    frequency = np.zeros(COLUMNS)
    frequency[list(table.keys())] = list(table.values())
    idf = (np.log((1 + n) / (1 + frequency)) + 0.1).astype(np.float32)
    shares = tokens.select("terms").mapInArrow(_sketch(idf), "block int, data binary")
    rows = shares.repartition("block").mapInArrow(_add_up, "block int, data binary").collect()  # COLUMNS x (RANK + EXTRA)
    z = np.zeros((COLUMNS // _ROWS, _ROWS * (RANK + EXTRA)))
    for r in rows:
        z[r["block"]] = np.frombuffer(r["data"], np.float64)
    vectors, values = singular_vectors(z.reshape(COLUMNS, RANK + EXTRA), _gaussian())
    latent = (idf[:, None] * vectors / values).astype(np.float32)
    latent = np.concatenate([latent, np.zeros((1, latent.shape[1]), np.float32)])  # and the empty column
    return latent, (1 + frequency) / (1 + n)


def lcs_length(masks: dict[int, int], size: int, other: list[int]) -> int:
    """Length of the longest common subsequence of a sequence, given as
    position masks per element, and another (bit-parallel)."""
    full = (1 << size) - 1
    v = full
    for t in other:
        m = masks.get(t)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def _masks(sequence: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(sequence):
        out[t] = out.get(t, 0) | 1 << i
    return out


def span(size: int) -> int:
    """Terms of text that an item of ``size`` terms may be spread over."""
    return size + size // 4 + STRIDE


def short_span(size: int) -> int:
    """The same for items of fewer than SHORT_PASSAGE terms."""
    return size + size // 4 if size >= LCS_LEAST else size


class RareTerms:
    """For every item the terms to count and how many of them a stretch of
    ``reach(size)`` terms must hold to reach ``paraphrase`` of the item."""

    def __init__(self, words: list[list[int]], use: list[int], rate: np.ndarray, paraphrase: float, reach=span):
        use = sorted(use, key=lambda i: len(words[i]))
        self.items = np.array(use, np.int64)
        self.units = np.array([-(-(reach(len(words[i])) + UNIT - 1) // UNIT) for i in use], np.int64)
        self.least = np.ones(len(use), np.int64)
        pairs = []
        for k, i in enumerate(use):
            size = len(words[i])
            need = next(n for n in range(size + 1) if n >= paraphrase * size)
            if not need:  # everything is a paraphrase
                self.least[k] = 0
                continue
            order = sorted(words[i], key=lambda t: (rate[t >> (16 - TERM_BITS)], t))
            best, expected, seen = None, 0.0, set()
            for n, t in enumerate(order, 1):
                if t not in seen:
                    seen.add(t)
                    # Twice the mean: terms come in clusters.
                    expected += 2 * float(rate[t >> (16 - TERM_BITS)]) * self.units[k] * UNIT / PASSAGE
                least = need - (size - n)
                if least < 1:
                    continue
                # Chernoff's exponent for ``least`` of a Poisson count.
                odds = expected - least + least * np.log(least / expected) if least > expected else 0.0
                if best is None or odds > best[0]:
                    best = (odds, least, n)
            self.least[k] = best[1]
            pairs += [(t, k) for t in set(order[: best[2]])]
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.of_term = pairs[:, 1]
        self.begin = np.searchsorted(pairs[:, 0], np.arange((1 << 16) + 1))
        self.times = np.diff(self.begin)

    def candidates(self, hashes: np.ndarray, first: np.ndarray):
        """(text, term place in it, item) of the stretches with enough terms;
        the item lies in the ``UNIT + reach(size)`` terms from the place.

        Only hits are looked at: each is a number (item, unit of text), and
        once these are sorted, the ``least`` hits of an item that lie within
        its units of each other are neighbours in that order."""
        if not len(self.items) or not len(hashes):
            return
        lengths = np.diff(first)
        n_units = -(-lengths // UNIT)
        widest = int(self.units.max())
        # A gap before each text, so that no stretch spans two.
        base = widest + np.concatenate(([0], np.cumsum(n_units + widest)))
        total = int(base[-1])
        hit = np.flatnonzero(self.times[hashes])
        text = np.searchsorted(first, hit, side="right") - 1
        unit_of = base[text] + (hit - first[text]) // UNIT
        step = max(CELLS // UNIT, widest)
        for a in range(0, total, step):
            x, y = np.searchsorted(unit_of, (a, a + step + widest))
            times = self.times[hashes[hit[x:y]]]
            within = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            item = self.of_term[np.repeat(self.begin[hashes[hit[x:y]]], times) + within]
            keys = np.sort(item * total + np.repeat(unit_of[x:y], times))
            item = keys // total
            last = np.arange(len(keys)) + self.least[item] - 1
            some = np.flatnonzero((last < len(keys)) & (self.least[item] > 0))
            some = some[keys[last[some]] - keys[some] < self.units[item[some]]]
            # Every start of a stretch that holds these hits, once.
            low = keys[last[some]] - self.units[item[some]] + 1
            counts = keys[some] - low + 1
            starts = np.unique(np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum())))
            k, u = np.divmod(starts, total)
            mine = (a <= u) & (u < a + step)
            k, u = k[mine], u[mine]
            # A start in the gap stands for the beginning of the text after it.
            of = np.searchsorted(base, u + widest, side="right") - 1
            place = np.maximum(u - base[of], 0) * UNIT
            yield from zip(of.tolist(), place.tolist(), self.items[k].tolist())
        for k in np.flatnonzero(self.least == 0).tolist():  # items of which nothing is asked
            for t, n in enumerate(n_units.tolist()):
                yield from ((t, UNIT * u, int(self.items[k])) for u in range(n))


class Query:
    """A block of benchmark items, ready to be searched."""

    def __init__(self, items: list[tuple[int, str]], latent: np.ndarray, rate: np.ndarray, paraphrase: float):
        hashes, first = terms(pa.array([t or "" for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.words = [hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        self.masks = [_masks(w) for w in self.words]
        self.answers = [_masks(w[-ANSWER:]) for w in self.words]
        self.groups = []
        for length, stride, use in (
            (PASSAGE, STRIDE, [i for i, w in enumerate(self.words) if len(w) >= PASSAGE]),
            (SHORT_PASSAGE, SHORT_STRIDE, [i for i, w in enumerate(self.words) if SHORT_PASSAGE <= len(w) < PASSAGE]),
        ):
            windows = [(i, o) for i in use for o in sorted({*range(0, len(self.words[i]) - length, length),
                                                            len(self.words[i]) - length})]
            if windows:
                words = np.array([self.words[i][o : o + length] for i, o in windows], np.uint16)
                vectors = latent[words >> (16 - TERM_BITS)].sum(1)
                self.groups.append((length, stride, windows, words, unit(vectors).T.copy()))
        searched = [i for i, w in enumerate(self.words) if len(w) >= SHORT_PASSAGE]
        self.rare = RareTerms(self.words, searched, rate, paraphrase)


class ShortQuery:
    """The items of a block with fewer terms than any passage."""

    def __init__(self, items: list[tuple[int, str]], rate: np.ndarray, share: float):
        hashes, first = whole_terms(pa.array([t or "" for _, t in items], pa.string()))
        use = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHORT_PASSAGE)).tolist()
        self.ids = [items[i][0] for i in use]
        self.words = [hashes[first[i] : first[i + 1]].tolist() for i in use]
        self.masks = [_masks(w) for w in self.words]
        self.answers = [_masks(w[-ANSWER:]) for w in self.words]
        self.least = [share * len(w) if len(w) >= LCS_LEAST else len(w) for w in self.words]
        cut = [_cut(hashes[first[i] : first[i + 1]]).tolist() for i in use]
        tiny = [i for i, w in enumerate(cut) if len(w) < LCS_LEAST]
        others = [i for i, w in enumerate(cut) if len(w) >= LCS_LEAST]
        self.rare = [RareTerms(cut, tiny, rate, 1.0, short_span), RareTerms(cut, others, rate, share, short_span)]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _near(hashes: np.ndarray, starts: np.ndarray, sums: np.ndarray, first: np.ndarray, group, cosine: float):
    """(text, term place in it, item, offset) of the candidates in a run of
    texts; sums: latent sums of each SHORT_STRIDE terms of the padded texts."""
    length, stride, windows, words, vectors = group
    per, hop = length // SHORT_STRIDE, stride // SHORT_STRIDE
    n_blocks = np.diff(starts) // SHORT_STRIDE
    n = (n_blocks - per) // hop + 1
    text = np.repeat(np.arange(len(n)), n)
    k = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * hop
    # Every ``hop`` blocks from the run's start on (texts start there too), then
    # those that lie in one text.
    hops = sums if hop == 1 else sum(sums[i::hop] for i in range(hop))
    passages = hops[: len(hops) - per // hop + 1].copy()
    for step in range(1, per // hop):
        passages += hops[step : step + len(passages)]
    passages = passages[(starts[text] // SHORT_STRIDE + k) // hop]
    least = cosine * np.sqrt(np.einsum("nd,nd->n", passages, passages))
    at = k * SHORT_STRIDE
    padded = np.concatenate([hashes, np.zeros(length, np.uint16)])
    place = np.minimum(first[text] + at, len(hashes))
    for a in range(0, len(passages), 2048):
        near = passages[a : a + 2048] @ vectors
        bound = least[a : a + 2048]
        rows = np.flatnonzero((near.max(1) >= bound) & (bound > 0))
        p, q = np.nonzero(near[rows] >= bound[rows, None])
        p = rows[p] + a
        # Shared words first: half of the window's words must be there.
        for b in range(0, len(p), 2000):
            seen = padded[place[p[b : b + 2000]] + np.arange(length)[:, None]]
            want = np.ascontiguousarray(words[q[b : b + 2000]].T)
            there = want == seen[0]
            for row in seen[1:]:
                there |= want == row
            for j in np.flatnonzero(2 * there.sum(0) >= length) + b:
                item, offset = windows[q[j]]
                yield int(text[p[j]]), int(at[p[j]]), item, offset


def _runs(candidates):
    """(text, item, places) of candidates of one item whose places follow each other."""
    held, places = None, []
    for text, at, item in candidates:
        if (text, item) != held or at != places[-1] + UNIT:
            if places:
                yield *held, places
            held, places = (text, item), []
        places.append(at)
    if places:
        yield *held, places


def search(hashes: np.ndarray, first: np.ndarray, latent: np.ndarray, query: Query, cosine: float, share: float,
           paraphrase: float) -> dict[tuple[int, int], tuple[int, bool, int]]:
    """(text, item index) -> (lcs, answer found, place) of the items found in
    a run of texts, the best place of each."""
    best: dict[tuple[int, int], tuple[int, bool, int]] = {}
    lists: dict[int, list[int]] = {}
    tried = set()

    def confirm(text: int, item: int, begin: int, end: int):
        size = len(query.words[item])
        if text not in lists:
            lists[text] = hashes[first[text] : first[text + 1]].tolist()
        around = lists[text][begin:end]
        common = lcs_length(query.masks[item], size, around)
        if common < paraphrase * size:
            return
        answer = lcs_length(query.answers[item], min(ANSWER, size), around) >= min(ANSWER, size) - 1
        if common >= share * size or answer:
            best[text, item] = max(best.get((text, item), (0, False, 0)), (common, answer, begin))

    columns, starts = _padded(hashes, first, STRIDE, PASSAGE)
    sums = _block_sums(latent, columns, SHORT_STRIDE)
    for text, at, item, offset in itertools.chain.from_iterable(
        _near(hashes, starts, sums, first, g, cosine) for g in query.groups
    ):
        size = len(query.words[item])
        if best.get((text, item), (0,))[0] == size:
            continue
        slack = size // 4 + STRIDE
        begin = max(0, at - offset - slack)
        if (text, item, begin // STRIDE) in tried:
            continue
        tried.add((text, item, begin // STRIDE))
        confirm(text, item, begin, max(0, at - offset) + size + slack)
    for text, item, places in _runs(query.rare.candidates(hashes, first)):
        size, masks = len(query.words[item]), query.masks[item]
        if text not in lists:
            lists[text] = hashes[first[text] : first[text + 1]].tolist()
        words, reach = lists[text], UNIT + span(size)
        # Different terms first: a subsequence cannot have more than these and
        # the item's repeats; of all places that follow each other, then of each.
        least = paraphrase * size - size + len(masks)
        if len(masks.keys() & words[places[0] : places[-1] + reach]) < least:
            continue
        for at in places:
            if best.get((text, item), (0,))[0] < size and len(masks.keys() & words[at : at + reach]) >= least:
                confirm(text, item, at, at + reach)
    return best


def search_short(hashes: np.ndarray, first: np.ndarray, query: ShortQuery) -> dict[tuple[int, int], tuple[int, bool, int]]:
    """The same for short items in a run of texts given by their 64-bit hashes."""
    best: dict[tuple[int, int], tuple[int, bool, int]] = {}
    cut = _cut(hashes)
    for text, at, item in itertools.chain.from_iterable(r.candidates(cut, first) for r in query.rare):
        size, masks = len(query.words[item]), query.masks[item]
        if best.get((text, item), (0,))[0] == size:
            continue
        reach, least = short_span(size), min(ANSWER, size)
        around = hashes[first[text] + at : min(first[text] + at + UNIT + reach, first[text + 1])].tolist()
        for k, t in enumerate(around[:UNIT]):
            if t not in masks:
                continue
            stretch = around[k : k + reach]
            common = lcs_length(masks, size, stretch)
            if common >= query.least[item]:
                answer = lcs_length(query.answers[item], least, stretch) >= max(least - 1, 1)
                best[text, item] = max(best.get((text, item), (0, False, 0)), (common, answer, at + k))
    return best


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
    return pa.record_batch(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["doc_id", "item_id", "item_terms", "lcs", "answer_found", "place"],
    )


def _find_short(shared):
    def run(batches):
        query = shared.value
        for batch in batches:
            for part in T.pieces(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                rows = [
                    (ids[text], query.ids[item], len(query.words[item]), *hit)
                    for (text, item), hit in search_short(*whole_terms(part.column("text")), query).items()
                ]
                if rows:
                    yield _found(rows)

    return run


def _find(shared, cosine: float, share: float, paraphrase: float):
    def run(batches):
        latent, query = shared.value
        for batch in batches:
            rows, ids = [], batch.column("doc_id").to_pylist()
            for a, _, hashes, first in _term_rows(batch, 50_000):
                found = search(hashes, first, latent, query, cosine, share, paraphrase)
                for (text, item), (common, answer, place) in found.items():
                    rows.append((ids[a + text], query.ids[item], len(query.words[item]), common, answer, place))
            if rows:
                yield _found(rows)

    return run


_FOUND = "doc_id long, item_id long, item_terms long, lcs long, answer_found boolean, place long"


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.65, share: float = 0.75,
                 paraphrase: float = 0.5) -> DataFrame:
    """(doc_id, item_id, item_terms, lcs, answer_found, place) of the items
    found in whole texts of ``docs(doc_id, text)``, one row per document row
    and item.

    An item of ``benchmark(item_id, text)`` counts as found when its longest
    common subsequence with the text around a candidate passage holds
    ``share`` of its terms, or ``paraphrase`` of them and the answer. Every
    stretch of ``span`` terms that satisfies this is found. Items of
    fewer than SHORT_PASSAGE terms need ``share`` of their terms in order
    within ``short_span`` terms, those of fewer than LCS_LEAST must occur word
    for word; items without terms are never found. Null and empty texts hold nothing. Rows that share
    a doc_id are searched each by itself; rows without doc_id report null.
    Extra columns are ignored; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    ready(spark)
    tokens = materialise(docs.select("doc_id", "text").mapInArrow(_tokenise, "doc_id long, terms binary"), "terms")
    model = latent_terms(tokens)
    release(spark)
    out = spark.createDataFrame([], _FOUND)
    if model is None:
        return out
    latent, rate = model
    found = None
    items = ((r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").toLocalIterator())
    while block := list(itertools.islice(items, BLOCK_ITEMS)):
        shared = spark.sparkContext.broadcast((latent, Query(block, latent, rate, paraphrase)))  # bounded by BLOCK_ITEMS
        part = tokens.mapInArrow(_find(shared, cosine, share, paraphrase), _FOUND)
        found = part if found is None else found.union(part)
        short = ShortQuery(block, rate, share)
        if short.ids:
            texts = docs.select("doc_id", "text")
            found = found.union(texts.mapInArrow(_find_short(spark.sparkContext.broadcast(short)), _FOUND))
    return out if found is None else found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without the documents that hold an item; of rows that share a
    doc_id all go. Rows without doc_id are named by a hash of their text."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"), F.coalesce(
        F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    ).alias("key"))
    bad = contaminated(rows.select(F.col("key").alias("doc_id"), "text"), benchmark, **params)
    # A narrow table of its own, so that the plan knows its size.
    bad = materialise(bad.select(F.col("doc_id").alias("bad_key")).distinct(), "contaminated")
    return rows.join(bad, rows["key"] == bad["bad_key"], "left_anti").select("row.*")

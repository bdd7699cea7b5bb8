"""Vectorised word hashing over whole Arrow batches (numpy, inside tasks).

Words are runs of ``[^\\x20\\x09-\\x0D]`` bytes. All of these bytes are
ASCII, so splitting the UTF-8 bytes equals splitting the decoded text.
Nothing here loops over words in Python: a batch of texts is one byte
buffer, and every step is one numpy pass over it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S29 = np.uint64(33), np.uint64(29)


def _byte_values(fold_case: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
    if fold_case:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


_VALUES, _FOLDED = _byte_values(False), _byte_values(True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads every input bit."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S29)
    x = x * _M2
    return x ^ (x >> _S33)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two adjacent windows from the hashes of both."""
    return mix(a * _MULTIPLIER + (b ^ (b >> _S29)) + _M1)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes between terms: all of ASCII but letters and digits.
NOT_TERM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _WHITE):
    """(starts, ends, first): byte spans of all words (runs of bytes that are
    not ``between``); ``first[i]`` is the index of text i's first word,
    ``first[-1]`` the number of words."""
    n = len(data)
    solid = np.zeros(n + 2, dtype=bool)
    np.logical_not(between[data], out=solid[1 : n + 1])
    begins = solid[1 : n + 1] & ~solid[:n]
    finishes = solid[1 : n + 1] & ~solid[2:]
    # A text border ends a word and begins another.
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] = solid[inner + 1]
    finishes[inner - 1] = solid[inner]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False,
                between: np.ndarray = _WHITE) -> np.ndarray:
    """A 64-bit hash of each word; ``fold_case`` takes A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = (ends - starts).astype(np.int32)
    powers = np.cumprod(np.full(int(lengths.max()), _MULTIPLIER, np.uint64))
    before = np.cumsum(lengths, dtype=np.int64) - lengths
    kind = np.int32 if len(data) < 2**31 else np.int64
    letters = data[~between[data]]  # the words' bytes, end to end
    within = np.arange(len(letters), dtype=kind)
    within -= np.repeat(before.astype(kind), lengths)
    values = (_FOLDED if fold_case else _VALUES)[letters]
    values *= powers[within]
    return mix(np.add.reduceat(values, before) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` words, built by doubling: a
    window of 2L is joined from two of L. Windows that cross a text border
    are included; the caller drops them."""
    out, have = None, 0
    part, size = words, 1
    # Binary decomposition: at most 2 log2(length) vector passes.
    while True:
        if length & size:
            if out is None:
                out, have = part, size
            else:
                m = len(words) - have - size + 1
                if m <= 0:
                    return np.zeros(0, np.uint64)
                out, have = joined(out[:m], part[have : have + m]), have + size
        size *= 2
        if size > length:
            break
        m = len(words) - size + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        part = joined(part[:m], part[size // 2 : size // 2 + m])
    return out


def windows_inside(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, start) of every window of ``length`` words that lies in
    one text; starts count from the batch's first word."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    return text, start


def slices(n_bytes: np.ndarray, limit: int):
    """Runs [a, b) of rows whose texts hold about ``limit`` bytes at most
    (one longer text stands alone), so memory is bounded by the largest text."""
    a, size = 0, 0
    for i, b in enumerate(n_bytes):
        if i > a and size + b > limit:
            yield a, i
            a, size = i, 0
        size += int(b)
    if len(n_bytes) > a:
        yield a, len(n_bytes)


def pieces(batch: pa.RecordBatch, text: str, limit: int = 1 << 20):
    """The batch in runs of rows with bounded text (see ``slices``)."""
    n = batch.num_rows
    if not n:
        return
    column = batch.column(batch.schema.get_field_index(text))
    _, offsets = text_buffer(column)
    for a, b in slices(np.diff(offsets), limit):
        yield batch.slice(a, b - a)

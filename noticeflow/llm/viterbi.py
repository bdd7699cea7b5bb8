"""SentencePiece encoding and decoding by streaming Viterbi.

The best segmentation maximises the sum of piece scores. Characters are
read one by one; only boundaries at most one longest piece behind the front
can still be extended, so these are the surviving paths. Whenever their back
pointers meet in one boundary, the ids before it are final: they are
committed and the window forgets them. Memory is bounded by the piece
length and the distance to the last meeting point, not by the text.

Between two bytes that stand side by side in no piece (into a space, say)
all paths meet whatever comes; stretches between such places are encoded by
themselves and remembered (see ``stretches``), which makes ordinary text fast.

A character without a piece of its own becomes its UTF-8 byte pieces. A
literal U+2581 in a text, which the model uses for spaces, is written as
byte pieces too, so that decoding gives back every text exactly.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import stretches as S
from . import textnp as T
from .common import ready
from .vocab import file_bytes

MODEL = "piece_bpe_32k.model"
SPACE = "\u2581"
#: An unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0


class PieceModel:
    """Pieces and scores of a SentencePiece model file."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids: dict[int, int] = {}
        self.nodes: dict[str, tuple[float, int] | None] = {}
        plain = []
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain.append((piece, sp.get_score(i), i))
        for piece, _, _ in plain:
            for k in range(1, len(piece)):
                self.nodes.setdefault(piece[:k], None)
        for piece, score, i in plain:
            self.nodes[piece] = (score, i)
        self.longest = max(len(p) for p, _, _ in plain)
        self.unknown = min(s for _, s, _ in plain) - UNKNOWN_PENALTY
        self.unknown_id = sp.unk_id()
        self.dtype = np.dtype("<u2") if n <= 65536 else np.dtype("<u4")
        if len(self.byte_ids) < 256:
            raise ValueError("the model needs byte pieces")
        self.decoded = [self._bytes(i) for i in range(n)]
        self._sizes = np.array([len(b) for b in self.decoded], np.int64)
        self._flat = np.frombuffer(b"".join(self.decoded), np.uint8)
        # Paths meet between bytes that no piece holds side by side (not
        # inside a character, whose later bytes are 0x80 to 0xBF).
        self.borders = np.ones((256, 256), bool)
        for piece, _, _ in plain:
            raw = piece.replace(SPACE, " ").encode()
            self.borders[list(raw[:-1]), list(raw[1:])] = False
        self.borders[:, 0x80:0xC0] = False
        self.cache = S.StretchCache(lambda texts: [self.segment(t.replace(" ", SPACE)) for t in texts], self.dtype)

    def _bytes(self, i: int) -> bytes:
        for value, j in self.byte_ids.items():
            if i == j:
                return bytes([value])
        return self.pieces[i].replace(SPACE, " ").encode()

    def segment(self, text: str) -> list[int]:
        """Ids of a stretch in which spaces are written U+2581."""
        nodes, longest, unknown = self.nodes, self.longest, self.unknown
        out: list[int] = []
        # Boundary base + k has best[k], and back[k] = (previous k, id).
        base, best, back = 0, [0.0], [None]
        n, low = len(text), float("-inf")
        i = 0
        while base + i < n:
            at = base + i
            reach = min(longest, n - at)
            while len(best) <= i + reach:
                best.append(low)
                back.append(None)
            score = best[i]
            single = False
            for k in range(1, reach + 1):
                node = nodes.get(text[at : at + k], 0)
                if node == 0:
                    break
                if node is not None:
                    single = single or k == 1
                    value = score + node[0]
                    if value > best[i + k]:
                        best[i + k], back[i + k] = value, (i, node[1])
            if not single and score + unknown > best[i + 1]:
                best[i + 1], back[i + 1] = score + unknown, (i, -1)
            i += 1
            if i >= 4 * longest:
                meet = self._meeting(i, back)
                if meet:
                    out += self._path(text, base, meet, back)
                    base, best = base + meet, best[meet:]
                    back = [None if p is None or p[0] < meet else (p[0] - meet, p[1]) for p in back[meet:]]
                    i -= meet
        return out + self._path(text, base, i, back)

    def _meeting(self, i: int, back: list) -> int:
        """The boundary in which all surviving back pointers meet (0: none new)."""
        live = {k for k in range(i, len(back)) if k == i or back[k] is not None}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(back[last][0])
        return live.pop()

    def _path(self, text: str, base: int, end: int, back: list) -> list[int]:
        out: list[int] = []
        while end:
            begin, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.byte_ids[b] for b in reversed(text[base + begin : base + end].encode())]
            end = begin
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of one text, without the memory of stretches."""
        if not text:
            return []
        out: list[int] = []
        for k, part in enumerate((" " + text).split(SPACE)):
            if k:  # a literal U+2581
                out += [self.byte_ids[b] for b in SPACE.encode()]
            out += self.segment(part.replace(" ", SPACE))
        return out

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a column of texts (null: empty)."""
        column = column.fill_null("").cast(pa.large_string())
        # The model's leading space; a literal U+2581 goes the plain way.
        literal = np.array(pc.match_substring(column, SPACE))
        skip = pa.array(literal | (np.array(pc.binary_length(column)) == 0))
        empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        spaced = pc.if_else(skip, empty, pc.binary_join_element_wise(empty, column, space))
        data, offsets = T.text_buffer(spaced)
        starts, first = S.cut(data, offsets, self.borders)
        ids, counts = self.cache.ids(data, starts)
        bounds = S.sums(counts, first)
        if not literal.any():
            return ids, bounds
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i in np.flatnonzero(literal).tolist():
            parts[i] = np.array(self.encode(column[i].as_py()), self.dtype)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The UTF-8 texts of several id sequences, end to end in ``ids``."""
        sizes = self._sizes[ids]
        at = np.cumsum(self._sizes) - self._sizes
        raw = self._flat[S.ragged(at[ids], sizes)].tobytes()
        edges = np.concatenate(([0], np.cumsum(sizes)))[bounds].tolist()
        return [raw[a:b].removeprefix(b" ") for a, b in zip(edges[:-1], edges[1:])]

    def decode(self, ids) -> str:
        """The text of ids."""
        ids = np.asarray(ids, np.int64)
        return self.decode_many(ids, np.array([0, len(ids)]))[0].decode("utf-8", "replace")


_MODELS: dict[int, PieceModel] = {}


def _model(raw: bytes) -> PieceModel:
    """One model, with its memory, per Python worker and model file."""
    key = zlib.crc32(raw)
    if key not in _MODELS:
        _MODELS[key] = PieceModel(raw)
    return _MODELS[key]


def _encode(shared):
    def run(batches):
        model = _model(shared.value)
        for batch in batches:
            for rows in T.pieces(batch, "text"):
                ids, bounds = model.encode_column(rows.column("text"))
                back = model.decode_many(ids, bounds)
                data, offsets = T.text_buffer(rows.column("text"))
                raw = data.tobytes()
                exact = [raw[a:b] == t for a, b, t in zip(offsets[:-1].tolist(), offsets[1:].tolist(), back)]
                wide = ids.astype("<u4")
                packed = wide.tobytes()
                edges = (4 * bounds).tolist()
                crc = [zlib.crc32(packed[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                yield pa.record_batch(
                    [
                        rows.column("doc_id"),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(crc, pa.int64()),
                        pa.array(exact, pa.bool_()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(wide.view(np.int32))),
                    ],
                    names=["doc_id", "n_tokens", "ids_crc32", "exact", "ids"],
                )

    return run


_ENCODED = "doc_id long, n_tokens long, ids_crc32 long, exact boolean, ids array<int>"


def encode_pieces(docs: DataFrame, model: str = MODEL, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), exact (decoding
    gives the text back), ids.

    The whole text is encoded, after the model's leading space. A null or
    empty text has no ids. Repeated rows and rows without doc_id are encoded
    like any other; extra columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(file_bytes(model, folder))  # one model file
    return docs.select("doc_id", "text").mapInArrow(_encode(shared), _ENCODED)


def decode_pieces(encoded: DataFrame, model: str = MODEL, folder: str | None = None) -> DataFrame:
    """(doc_id, text) of ``encoded(doc_id, ids)``; null ids give an empty text."""
    spark = encoded.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(file_bytes(model, folder))

    def run(batches):
        decoder = _model(shared.value)
        for batch in batches:
            texts = [decoder.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")

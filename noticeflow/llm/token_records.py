"""Token ids as length-delimited binary records with an offset index.

A record file holds, per document, in ascending order:

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the length's 8 bytes
    payload        doc_id i64, has_id u8, width u8 (2 or 4), ids
    check    u32   masked CRC-32 of the payload

all little-endian. Masking rotates a checksum and adds a constant, so that a
checksum stored inside checked data stays meaningful. Beside each record file
lies an index of (offset u64, n_ids u64) per record, so that readers can take
records in any order. A file is written under a name of its own by each task
attempt and counts only if the manifest names it: a lost or repeated task
leaves nothing that a reader would see.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.bronze import arrow_file_system as _file_system
from . import textnp as T
from .common import materialise, new_scratch, ready
from .stretches import StretchCache, cut, sums
from .vocab import file_bytes

VOCABULARY = "byte_bpe_50k.json"
MASK_DELTA = 0xA282EAD8
END_ID = 0
_LENGTH, _CHECK, _HEAD, _INDEX = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB"), struct.Struct("<QQ")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = _LENGTH.pack(len(payload))
    return b"".join((size, _CHECK.pack(masked_crc(size)), payload, _CHECK.pack(masked_crc(payload))))


def payload_of(doc_id: int | None, width: int, ids: bytes) -> bytes:
    return _HEAD.pack(doc_id or 0, doc_id is not None, width) + ids


def index_entry(offset: int, n_ids: int) -> bytes:
    return _INDEX.pack(offset, n_ids)


def read_frame(stream) -> bytes | None:
    """The next payload of a stream, None at its end; ValueError if damaged."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or _CHECK.unpack_from(head, 8)[0] != masked_crc(head[:8]):
        raise ValueError("damaged record length")
    (size,) = _LENGTH.unpack_from(head)
    body = stream.read(size + 4)
    if len(body) < size + 4 or _CHECK.unpack_from(body, size)[0] != masked_crc(body[:size]):
        raise ValueError("damaged record")
    return bytes(body[:size])


def qualified(spark, path: str) -> str:
    """The path with the scheme that Spark would use for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()


def _borders() -> np.ndarray:
    """Byte pairs that the byte-level pattern never keeps in one pre-token:
    a visible character before ASCII white space, and an ASCII letter or
    digit beside other ASCII signs but the apostrophe (of 's, 'll ...)."""
    white = np.zeros(256, bool)
    white[[0x20, *range(0x09, 0x0E)]] = True
    alnum = np.array([c < 128 and chr(c).isalnum() for c in range(256)])
    sign = ~white & ~alnum & (np.arange(256) < 128)
    sign[ord("'")] = False
    return (~white[:, None] & white) | (alnum[:, None] & sign) | (sign[:, None] & alnum)


class _Encoder:
    """The tokenizers library behind a memory of stretches.

    Pre-tokens of the byte-level pattern never cross the borders above, so
    equal stretches between them have equal ids. That holds for ASCII white
    space; a text with any other goes to the library whole, as does a text
    that holds a token added to the vocabulary (the library looks for those
    before anything else), and every text if the vocabulary has another pattern.
    """

    _odd = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 65536 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        spec = json.loads(raw)
        added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        self.odd = "|".join([self._odd, *("\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E" for t in added)])
        kind = spec.get("pre_tokenizer") or {}
        self.local = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space", True)
            and spec.get("normalizer") is None and not spec["model"].get("dropout")
        )
        self.borders = _borders()
        self.model = self.tokenizer.model
        self.signs = _byte_signs()
        self.cache = StretchCache(self._stretches, self.dtype)

    def _stretches(self, texts: list[str]) -> list[list[int]]:
        """A stretch that is one pre-token (a word, with a space or not) goes
        to the library's model as it is, others through its whole pipeline."""
        out: list = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if t.removeprefix(" ").isalpha():
                signs = t.encode().decode("latin-1").translate(self.signs)
                out[i] = [token.id for token in self.model.tokenize(signs)]
            else:
                rest.append(i)
        for i, ids in zip(rest, self._whole([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a column of texts (null: empty)."""
        column = column.fill_null("").cast(pa.large_string())
        odd = np.array(pc.match_substring_regex(column, self.odd)) if self.local else np.ones(len(column), bool)
        data, offsets = T.text_buffer(pc.if_else(pa.array(odd), "", column) if odd.any() else column)
        starts, first = cut(data, offsets, self.borders)
        ids, counts = self.cache.ids(data, starts)
        bounds = sums(counts, first)
        if not odd.any():
            return ids, bounds
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        where = np.flatnonzero(odd).tolist()
        for i, found in zip(where, self._whole([column[i].as_py() for i in where])):
            parts[i] = np.array(found, self.dtype)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))


def _byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: itself
    where it is printable, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


_ENCODERS: dict[int, _Encoder] = {}


def _encoder(raw: bytes) -> _Encoder:
    key = zlib.crc32(raw)
    if key not in _ENCODERS:
        _ENCODERS[key] = _Encoder(raw)
    return _ENCODERS[key]


def _write(shared, folder: str):
    def run(batches):
        from pyspark import TaskContext

        encoder, files, part = _encoder(shared.value), None, TaskContext.get().partitionId()
        end = np.array([END_ID], encoder.dtype).tobytes()
        offset = docs = ids_total = 0
        for batch in batches:
            for rows in T.pieces(batch, "text"):
                if files is None:
                    system, base = _file_system(folder)
                    name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
                    system.create_dir(base, recursive=True)
                    files = [system.open_output_stream(f"{base}/{name}.{kind}") for kind in ("records", "index")]
                flat, bounds = encoder.encode(rows.column("text"))
                packed, edges = flat.tobytes(), (bounds * encoder.width).tolist()
                for k, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    record = frame(payload_of(doc_id, encoder.width, packed[edges[k] : edges[k + 1]] + end))
                    n_ids = int(bounds[k + 1] - bounds[k]) + 1
                    files[0].write(record)
                    files[1].write(index_entry(offset, n_ids))
                    offset, docs, ids_total = offset + len(record), docs + 1, ids_total + n_ids
        if files is not None:
            for f in files:
                f.close()
            row = {"part": [part], "name": [name], "n_docs": [docs], "n_ids": [ids_total]}
            yield pa.RecordBatch.from_pydict(row, pa.schema(
                [("part", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return run


def write_records(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """Encode and write ``docs(doc_id, text)`` under ``path`` in ascending
    doc_id order (null first; rows of one doc_id by text); returns the
    manifest: part, name, n_docs, n_ids, first_id (ids in earlier files).

    The whole text is encoded (null: empty) and END_ID appended. Extra
    columns are ignored; an empty table writes no file.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(file_bytes(vocabulary, folder))  # one vocabulary file
    target = qualified(spark, path)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    # Ranges of (doc_id, text hash): a doc_id with very many rows is split too.
    ranged = keyed.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text")
    written = ranged.select("doc_id", "text").mapInArrow(
        _write(shared, target), "part long, name string, n_docs long, n_ids long"
    )
    manifest = materialise(written, "manifest")
    # One row per file: a running sum over the list of files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, known, width = _HEAD.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)


def read_at(system, path: str, offset: int) -> tuple[int | None, np.ndarray]:
    """The record at one offset of a record file: (doc_id, ids)."""
    with system.open_input_file(path) as f:
        f.seek(offset)
        return _unpack(read_frame(f))


def _read(folder: str, shuffle_seed: int | None, with_ids: bool):
    def run(batches):
        system, base = _file_system(folder)
        for batch in batches:
            for name, first in zip(batch.column("name").to_pylist(), batch.column("first_id").to_pylist()):
                with system.open_input_file(f"{base}/{name}.index") as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2)
                starts = first + np.concatenate(([0], np.cumsum(index[:, 1].astype(np.int64))))
                order = np.arange(len(index))
                if shuffle_seed is None:
                    stream = system.open_input_stream(f"{base}/{name}.records", buffer_size=1 << 20)
                else:
                    order = np.random.default_rng([shuffle_seed, zlib.crc32(name.encode())]).permutation(order)
                    stream = system.open_input_file(f"{base}/{name}.records")
                rows, size = [], 0
                with stream:
                    for i in order.tolist():
                        if shuffle_seed is not None:
                            stream.seek(int(index[i, 0]))
                        doc_id, ids = _unpack(read_frame(stream))
                        if len(ids) != index[i, 1]:
                            raise ValueError(f"index and records of {name} differ")
                        wide = ids.astype("<u4")
                        crc = zlib.crc32(wide.tobytes())
                        rows.append((doc_id, int(starts[i]), len(ids), crc, wide.astype(np.int32) if with_ids else None))
                        size += len(ids)
                        if size > 1_000_000 or len(rows) >= 10_000:
                            yield _batch(rows, with_ids)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, with_ids)

    return run


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if with_ids:
        arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
        names.append("ids")
    return pa.record_batch(arrays, names=names)


def read_records(manifest: DataFrame, path: str, shuffle_seed: int | None = None, with_ids: bool = False) -> DataFrame:
    """Read the manifest's files and check every record: doc_id, start (ids
    of all documents before it), n_tokens, ids_crc32 and, with ``with_ids``,
    ids. With a seed, each file's records come in a shuffled order by way of
    the offset index."""
    spark = manifest.sparkSession
    ready(spark)
    n = max(1, manifest.count())
    spread = manifest.select("part", "name", "first_id").repartitionByRange(n, "part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return spread.mapInArrow(_read(qualified(spark, path), shuffle_seed, with_ids), schema)


def token_records(docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY,
                  folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token records (in the shared scratch folder unless a
    path is given) and return what reading them back gives per document."""
    path = path or new_scratch(docs.sparkSession, "token-records")
    return read_records(write_records(docs, path, vocabulary, folder), path)

import io
import os
import zlib

import numpy as np
import pytest

from noticeflow.llm import token_records as R
from noticeflow.llm.vocab import file_bytes

from ..conftest import SF_SMALL

ODD = [
    "", " ", "plain words", "  two  spaces \n\n line\r\n", "it's I'll\tx", "naïve  x   y z", "a\x1c b\x85c", "<|endoftext|> x", "a<|endoftext|>b <|endoftext|", "words before<|endoftext|>\n",
    "日本語 テキスト", "x" * 5000, "3.14 1,000 ½ ²", "﻿bom", "!!!  ???", "tab\t\tend \t", "\n \n", "é ​ z",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(file_bytes(R.VOCABULARY).decode())


def check(rows, got, library):
    """rows in file order."""
    start = 0
    assert len(got) == len(rows)
    for (doc_id, text), r in zip(rows, got):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, R.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), crc), text
        start += len(ids)


def test_ids_are_the_library_s(spark, library):
    rows = list(enumerate(ODD))
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, start string").repartition(3)
    check(rows, sorted(R.token_records(docs).collect(), key=lambda r: r.start), library)


def test_an_added_token_in_a_text_is_that_token(library):
    assert 50256 in library.encode("a<|endoftext|>b", add_special_tokens=False).ids


def test_registered_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    check(rows, sorted(R.token_records(docs).collect(), key=lambda r: r.start), library)


def test_order_nulls_and_repeated_rows(spark, library):
    rows = [(None, "n"), (1, None), (1, None), (2, "b"), (2, "b"), (9, "z")]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    check(rows, sorted(R.token_records(docs).collect(), key=lambda r: r.start), library)
    assert R.token_records(docs.limit(0)).collect() == []


def test_shuffled_reads_by_the_index(spark, tmp_uri):
    docs = spark.createDataFrame([(i, f"text {i} " * i) for i in range(50)], "doc_id long, text string")
    manifest = R.write_records(docs, f"{tmp_uri}/rec").cache()
    plain = R.read_records(manifest, f"{tmp_uri}/rec", with_ids=True).collect()
    mixed = R.read_records(manifest, f"{tmp_uri}/rec", shuffle_seed=3, with_ids=True).collect()
    assert [r.doc_id for r in plain] != [r.doc_id for r in mixed]
    assert sorted(plain) == sorted(mixed)
    first = manifest.orderBy("part").first()
    system, base = R._file_system(R.qualified(spark, f"{tmp_uri}/rec"))
    with open(f"{tmp_uri}/rec/{first['name']}.index", "rb") as f:
        offset, n = R._INDEX.unpack(f.read(16))
    doc_id, ids = R.read_at(system, f"{base}/{first['name']}.records", offset)
    assert (doc_id, len(ids)) == (0, n)


def test_damage_is_found(spark, tmp_uri):
    docs = spark.createDataFrame([(1, "some text to damage")], "doc_id long, text string")
    manifest = R.write_records(docs, f"{tmp_uri}/rec")
    (name,) = [x for x in os.listdir(f"{tmp_uri}/rec") if x.endswith(".records")]
    raw = bytearray(open(f"{tmp_uri}/rec/{name}", "rb").read())
    for at in (0, 9, 14, len(raw) - 1):
        bad = bytes(raw[:at]) + bytes([raw[at] ^ 1]) + bytes(raw[at + 1 :])
        with pytest.raises(ValueError):
            R.read_frame(io.BytesIO(bad))
    for cut in (3, 20, len(raw) - 2):
        with pytest.raises(ValueError):
            R.read_frame(io.BytesIO(bytes(raw[:cut])))
    raw[20] ^= 1
    open(f"{tmp_uri}/rec/{name}", "wb").write(raw)
    with pytest.raises(Exception, match="damaged"):
        R.read_records(manifest, f"{tmp_uri}/rec").collect()


def test_a_repeated_task_leaves_nothing_a_reader_sees(spark, tmp_uri):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(20)], "doc_id long, text string")
    R.write_records(docs, f"{tmp_uri}/rec").count()
    manifest = R.write_records(docs, f"{tmp_uri}/rec")  # as if every task had run twice
    assert len(R.read_records(manifest, f"{tmp_uri}/rec").collect()) == 20


def test_masked_crc_differs_from_the_crc_of_framed_data():
    data = b"abc"
    assert R.masked_crc(data) != zlib.crc32(data)
    assert R.masked_crc(data) == (((zlib.crc32(data) >> 15) | (zlib.crc32(data) << 17)) + 0xA282EAD8) % 2**32

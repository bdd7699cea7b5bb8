"""The pipeline against the plain Python versions of its stages."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from noticeflow.llm import viterbi as V
from noticeflow.llm.queries import ORACLE
from noticeflow.llm.vocab import file_bytes

from ..oracle_harness import duck
from . import brute


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_as_brute_force(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    con = duck(sf_dir)
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    kept = con.execute(f"SELECT doc_id FROM ({ORACLE['op1_quality_rules']}) WHERE kept").fetchall()
    rows = [(d, texts[d]) for (d,) in kept]
    group = brute.components(rows, 5, 80)
    rows = [(d, t) for d, t in rows if group[d] == d]
    rows = [(d, brute.cut(texts[d], drop)) for d, _, drop in brute.repeats(rows, 20)]
    items = [" " + " ".join(brute.terms(t)) + " " for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    rows = [(d, t) for d, t in rows if not any(x in " " + " ".join(brute.terms(t)) + " " for x in items)]
    model = V.PieceModel(file_bytes(V.MODEL))
    want = {}
    for d, t in rows:
        ids = model.encode(t)
        want[d] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in P.run(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert got == want


def test_stages_return_the_columns_of_documents_and_take_odd_rows(spark):
    sf_dir = "/root/testdata/sf0.001"
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [
        (1, None, None, None, None, "a"), (2, "", "en", "s", 0, "a"), (None, long, None, None, 5, "b"), (3, long, "en", "s", 5, "b"),
        (3, long, "en", "s", 5, "b"), (4, " ".join(f"v{i % 90}" for i in range(95)), "fr", None, 5, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes, name
        assert out.count() <= 6
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
    assert P.STAGES[-1][1](spark, docs, sf_dir).filter("exact").count() == 6
    assert [n for n, _ in P.STAGES] == [
        "quality_rules", "minmax_near_dedup", "substring_dedup", "latent_decontamination", "streaming_viterbi"]


def test_stages_free_their_own_scratch_only(spark):
    """Lazy results of other operators outlive two runs of the pipeline; of a
    run's tables only its last stage's input is left."""
    import os

    from noticeflow.llm import queries as Q
    from noticeflow.session import ensure_checkpoint_dir

    sf_dir = "/root/testdata/sf0.001"
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/').removeprefix('file:')}/noticeflow-scratch"
    held = {n: Q.QUERIES[n](spark, sf_dir) for n in (
        "op1_quality_rules", "op3_minmax_near_dedup", "op5_latent_decontamination", "op8_substring_dedup")}
    before = set(os.listdir(folder))
    first, second = P.run(spark, sf_dir), P.run(spark, sf_dir)
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before}
    assert left <= {"stage-latent_decontamination", "sources"} and len(set(os.listdir(folder)) - before) <= 3
    n_docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, df in held.items():
        n = df.count()
        assert n == n_docs or name == "op5_latent_decontamination" and n > 0, name
    assert sorted(first.select("doc_id", "ids_crc32").collect()) == sorted(second.select("doc_id", "ids_crc32").collect())


def test_a_stage_frees_what_the_stage_before_has_written(spark):
    import os

    from noticeflow.llm.common import Scratch, materialise

    with Scratch(spark) as outer:
        kept = materialise(spark.range(3), "outer")
        with Scratch(spark) as inner:
            gone = materialise(spark.range(4), "inner")
        also = materialise(spark.range(5), "outer")
    free = materialise(spark.range(6), "free")
    (path,) = inner.paths
    inner.free()
    assert not os.path.exists(path.removeprefix("file:")) and len(outer.paths) == 2 and gone is not None
    assert (kept.count(), also.count(), free.count()) == (3, 5, 6)
    outer.free()
    assert free.count() == 6

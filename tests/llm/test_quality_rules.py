import math

import pytest
from pyspark.sql import functions as F

from noticeflow.llm import quality_rules as Q
from noticeflow.llm.queries import ORACLE, QUERIES

from ..conftest import SF_SMALL
from ..oracle_harness import compare, duck
from . import brute


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_matches_sql(spark, sf_dir):
    key = "op1_quality_rules"
    r = compare(spark, duck(sf_dir), sf_dir, key, QUERIES[key], ORACLE[key])
    assert r["match"], r


def counts(text):
    w = brute.words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    marked = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(marked)
    )


def test_counts_of_odd_texts(spark):
    texts = [
        None, "", " \n\t ", "one", "a b c d e f g h", "a " * 40, "x y z " * 9 + "end", "l1 a\nl1 a\n\n \nl1 a ", "Ünï cödé 😀 #*|<>",
        " ".join(f"w{i}" for i in range(5000)) + " " + " ".join(f"w{i}" for i in range(100, 140)), "a\x0bb\x0cc\rd\x85e f",
    ]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: tuple(r[c] for c in Q.COUNTS) for r in Q.text_signals(docs).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_binomial_p_value_is_exact(spark):
    cases = [(n, k) for n in (1, 5, 20, 21, 200, 3000) for k in {0, 1, 3, n // 200, n // 100} if k <= n]
    rate = 0.0125
    df = spark.createDataFrame(cases, "n long, k long").withColumn("p", Q.binomial_p_value("n", "k", rate))
    for r in df.collect():
        want = sum(math.comb(r.n, i) * rate**i * (1 - rate) ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(want if r.k < rate * r.n else 1.0, rel=1e-9)
    # Far beyond what the sum of factorials could hold.
    big = spark.createDataFrame([(10_000_000, 120_000)], "n long, k long").select(Q.binomial_p_value("n", "k", rate).alias("p"))
    assert 0 < big.first().p < 1e-40


def labelled(spark, n=4000):
    """Good texts with few capitals, bad ones with many; one stratum has few labels."""
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    bad = F.col("doc_id") % 5 == 0
    word = F.concat(F.lit("w"), F.lit("abc"))
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.when(bad, "WORD").otherwise("word"), i)))
    docs = df.select("doc_id", text.alias("text"), F.when(F.col("doc_id") < n - 40, "en").otherwise(F.lit(None)).alias("lang"))
    return docs, df.select("doc_id", F.when(bad, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic")), word


def test_cutoffs_are_certified_and_useful(spark):
    docs, labels, _ = labelled(spark)
    tests = Q.certified_cutoffs(Q.text_signals(docs, ("doc_id", "lang")), labels).collect()
    chosen = [(r.stratum, r.rule) for r in tests if r.chosen]
    assert chosen == [("en", "capitals")]  # the small stratum certifies nothing, other rules catch nothing
    assert all(r.p_value <= 0.1 / (2 * len(Q.RULES)) for r in tests if r.certified)
    kept = Q.quality_rules(docs, labels).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    assert {(r.quality, r.kept): r["count"] for r in kept} == {(1, True): 3200, (0, False): 792, (0, True): 8}


def test_false_rejections_stop_a_cutoff(spark):
    docs, labels, _ = labelled(spark)
    wrong = labels.withColumn("quality", F.when(F.col("doc_id") % 50 == 0, 1).otherwise(F.col("quality")))
    tests = Q.certified_cutoffs(Q.text_signals(docs, ("doc_id", "lang")), wrong).collect()
    assert not any(r.certified for r in tests if r.rule == "capitals" and r.cutoff <= 500 and r.stratum == "en")


def test_edges(spark):
    rows = [(1, None, "en"), (1, "", None), (None, " ".join(f"w{i}" for i in range(30)), "xx"), (2, "short text", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    got = Q.quality_rules(docs, labels).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.base_failed, r.kept) for r in got) == [
        (-1, 30, False, True), (1, 0, True, False), (1, 0, True, False), (2, 2, True, False)]
    kept = Q.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.kept) for r in kept.collect()] == [(None, "clash")]
    assert Q.quality_rules(docs.limit(0), labels.limit(0)).collect() == []
    assert len(Q.quality_rules(docs, labels.limit(0)).collect()) == 4


def test_no_python_on_the_main_path(spark):
    docs, labels, _ = labelled(spark, 200)
    plan = Q.quality_rules(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

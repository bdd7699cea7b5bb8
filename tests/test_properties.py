"""Properties over the derived recall records (sf0.001)."""

from pyspark.sql import functions as F

from noticeflow.operators import gold
from noticeflow.operators.scoring import score_recalls
from noticeflow.operators.silver import region_join, silver_projection
from noticeflow.operators.skew import attach_group_count
from noticeflow.sources.fixture import recall_records

from .conftest import SF_SMALL


def _scored(spark):
    return score_recalls(silver_projection(recall_records(spark, SF_SMALL)))


def test_expected_fixture_measures(spark):
    sc = _scored(spark)
    tiers = {r["risk_tier"]: r["count"] for r in sc.groupBy("risk_tier").count().collect()}
    assert tiers == {"Critical": 274, "High": 387, "Medium": 628, "Low": 211}
    agg = sc.agg(F.min("risk_score"), F.max("risk_score"), F.sum("risk_score")).first()
    assert tuple(agg) == (9, 135, 96363)
    assert sc.filter("risk_score > 100").count() == 78


def test_every_row_has_one_category_and_bounded_score(spark):
    sc = _scored(spark)
    bad = sc.filter(
        F.col("recall_reason_category").isNull() | F.col("product_category").isNull()
        | F.col("distribution_scope").isNull() | F.col("region").isNull() | F.col("risk_tier").isNull()
        | ~F.col("risk_score").between(5, 135)
    )
    assert bad.count() == 0


def test_group_counts_sum_to_rows(spark):
    sc = _scored(spark)
    n = sc.count()
    for table, col in [(gold.recall_overview(sc), "count"), (gold.recall_reason_summary(sc), "count"),
                       (gold.company_risk(sc), "total_recalls"), (gold.monthly_recall_trends(sc), "count"),
                       (gold.geographic_recall_summary(sc), "total_recalls"), (gold.risk_tier_summary(sc), "count"),
                       (gold.product_category_summary(sc), "count")]:
        assert table.agg(F.sum(col)).first()[0] == n


def test_region_equals_region_join(spark):
    s = silver_projection(recall_records(spark, SF_SMALL))
    diff = region_join(s, out="region2").filter(~F.col("region").eqNullSafe(F.col("region2")))
    assert diff.count() == 0


def test_company_risk_equals_joined_form(spark):
    sc = _scored(spark)
    a, b = gold.company_risk(sc), gold.company_risk_joined(sc)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salted_group_count_equals_window_with_hot_keys(spark):
    # A skewed input: one key (and the NULL key) hold most rows; force the
    # hot-key path with a tiny top-k so both salted and cold paths run.
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        F.col("id"),
    )
    salted = attach_group_count(df, ["k"], out="n", hot_keys=2, salt_buckets=16, method="salted")
    window = attach_group_count(df, ["k"], out="n", method="window")
    assert salted.exceptAll(window).count() == 0 and window.exceptAll(salted).count() == 0
    counts = {r["k"]: r["n"] for r in salted.select("k", "n").distinct().collect()}
    assert counts[None] == 1667 and counts["hot"] == 1667


def test_hot_key_rows_spread_over_partitions(spark):
    df = spark.range(0, 20000).select(F.lit("hot").alias("k"), F.col("id"))
    out = attach_group_count(df, ["k"], out="n", salt_buckets=32, method="salted")
    per_part = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_part) < 20000  # not all in one task
    assert out.filter(F.col("n") != 20000).count() == 0


def test_broadcast_and_salted_paths_agree(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise((F.col("id") % 13).cast("string")).alias("k"), "id"
    )
    a = attach_group_count(df, ["k"], out="n")  # size check passes: broadcast
    b = attach_group_count(df, ["k"], out="n", method="salted", hot_keys=3)
    c = attach_group_count(df, ["k"], out="n", broadcast_max_keys=5)  # check fails: salted
    for x, y in [(a, b), (a, c)]:
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_literal_rule_rewrite_equals_regex(spark):
    """The substring form of literal alternations gives the regex answer."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from noticeflow.functions import rules
    from noticeflow.functions.text import first_match_category

    words = [w for _, ws in rules.PRODUCT_RULES + rules.REASON_RULES + rules.DISTRIBUTION_RULES for w in ws.split("|")]
    piece = st.one_of(st.sampled_from(words + ["E. COLI", "Ice Cream", "e.coli", ", "]), st.text(max_size=6))
    texts = st.lists(st.lists(piece, max_size=6).map(" ".join), min_size=50, max_size=50)

    @settings(max_examples=4, deadline=None)
    @given(texts)
    def check(batch):
        df = spark.createDataFrame([(t,) for t in batch] + [(None,)], "t string")
        for table, default in [(rules.PRODUCT_RULES, "Other"), (rules.REASON_RULES, "Other"),
                               (rules.DISTRIBUTION_RULES, "Local/Unknown")]:
            regex = None
            for p, label in table:
                cond = F.lower(F.col("t")).rlike(p)
                regex = F.when(cond, label) if regex is None else regex.when(cond, label)
            got = df.select(first_match_category("t", table, default).alias("a"), regex.otherwise(default).alias("b"))
            assert got.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0

    check()


def test_fixture_measures_at_sf001(spark):
    """All expected values listed for sf0.01 in FIXTURES.md."""
    sc = score_recalls(silver_projection(recall_records(spark, "/root/testdata/sf0.01"))).cache()

    def counts(col):
        return {r[0]: r[1] for r in sc.groupBy(col).count().collect()}

    assert counts("risk_tier") == {"Critical": 2627, "High": 4016, "Medium": 6165, "Low": 2192}
    assert counts("classification") == {"Class I": 2944, "Class II": 5953, "Class III": 2965,
                                        "Not Yet Classified": 2957, None: 181}
    assert counts("status") == {"Ongoing": 4836, "Terminated": 9715, "Pending": 280, None: 169}
    assert counts("recall_reason_category") == {"Bacterial Contamination": 4286, "Allergen Issue": 2143,
                                                "Labeling Issue": 2143, "Foreign Material": 2143, "Other": 4285}
    assert counts("distribution_scope") == {"Nationwide": 5039, "International": 2484, "Multi-State": 2508,
                                            "Local/Unknown": 4969}
    assert counts("region") == {"Midwest": 1964, "Northeast": 1940, "South": 3378, "West": 3386, "Unknown": 4332}
    products = counts("product_category")
    assert products.pop("Dairy") == 2500 and products.pop("Other") == 2500
    assert set(products.values()) == {1250} and len(products) == 8
    agg = sc.agg(F.min("risk_score"), F.max("risk_score"), F.sum("risk_score")).first()
    assert tuple(agg) == (7, 135, 965772)
    assert sc.filter("risk_score > 100").count() == 758
    assert sc.filter(F.col("recalling_firm_clean").isNotNull()).select("recalling_firm_clean").distinct().count() == 1500
    nulls = sc.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in
                     ["recall_number", "recalling_firm", "reason_for_recall", "classification",
                      "recall_initiation_date", "recall_duration_days"]]).first()
    assert tuple(nulls) == (155, 149, 2142, 181, 212, 212)
    raw = recall_records(spark, "/root/testdata/sf0.01")
    term = raw.agg(F.count_if(F.col("termination_date") == "").alias("blank"),
                   F.count_if(F.col("termination_date") == "N/A").alias("na")).first()
    assert (term["blank"], term["na"]) == (10067, 94)
    assert sc.filter(F.col("termination_date").isNotNull()).count() == 4839
    sc.unpersist()

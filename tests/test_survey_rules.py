
from pyspark.sql import functions as F

from noticeflow.functions import (
    clean_firm,
    distribution_scope,
    parse_compact_date,
    product_category,
    standard_classification,
    standard_status,
)
from noticeflow.functions import rules, text
from noticeflow.operators.scoring import score_recalls
from noticeflow.operators.silver import silver_projection


def _one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).first()["y"]


def test_bad_dates_become_null(spark):
    for v in ["", "N/A", "2020-01-01", "20200230", "2020010", None]:
        assert _one(spark, parse_compact_date("x"), v) is None, v
    assert str(_one(spark, parse_compact_date("x"), "20200229")) == "2020-02-29"


def test_null_status_and_firm_stay_null(spark):
    assert _one(spark, standard_status("x"), None) is None
    assert _one(spark, clean_firm("x"), None) is None


def test_firm_cleaning_order_and_space_only_trim(spark):
    assert _one(spark, clean_firm("x"), "  ACME, Inc.  ") == "acme inc"
    assert _one(spark, clean_firm("x"), "\tAcme  Foods ") == "\tacme  foods"  # tabs stay, inner spaces kept


def test_status_and_classification_rules(spark):
    assert _one(spark, standard_status("x"), "Completed") == "Terminated"
    assert _one(spark, standard_status("x"), "Pending review") == "Pending review"
    assert _one(spark, standard_classification("x"), "CLASS  III") == "Class III"
    assert _one(spark, standard_classification("x"), "Not Yet Classified") == "Not Yet Classified"
    assert _one(spark, standard_classification("x"), "class i") == "Class I"


def test_first_match_order(spark):
    assert _one(spark, product_category("x"), "Ice Cream bar") == "Dairy"
    assert _one(spark, distribution_scope("x"), "Sold nationally, incl. Canada") == "Nationwide"
    assert _one(spark, distribution_scope("x"), None) == "Local/Unknown"


def test_repeat_counts_rows_and_null_firm_group(spark):
    rows = [("F-1", "Class I", "Ongoing", "NATIONWIDE", None, "Listeria"),
            ("F-2", "Class I", "Ongoing", "Sold nationally", None, "Listeria"),
            (None, "Class II", "Terminated", "Local", "Acme", "Label"),
            (None, "Class II", "Terminated", "Local", "Acme", "Label")]
    recs = spark.createDataFrame(
        rows, "recall_number string, classification string, status string, distribution_pattern string, "
              "recalling_firm string, reason_for_recall string",
    )
    for c in ["event_id", "product_type", "product_description", "state", "country", "city", "postal_code",
              "product_quantity", "voluntary_mandated", "initial_firm_notification", "recall_initiation_date",
              "report_date", "termination_date"]:
        recs = recs.withColumn(c, F.lit(None).cast("string"))
    out = {(r["recalling_firm_clean"], r["distribution_pattern"]): r for r in score_recalls(silver_projection(recs)).collect()}
    # NULL firms form one group; rows (not recall numbers) are counted
    assert out[(None, "NATIONWIDE")]["repeated_company_count"] == 1
    assert out[("acme", "Local")]["repeated_company_count"] == 1
    # the raw text decides distribution points: 'nationally' is Nationwide scope but scores 0
    assert out[(None, "NATIONWIDE")]["distribution_score"] == 20
    assert out[(None, "Sold nationally")]["distribution_score"] == 0
    assert out[(None, "Sold nationally")]["distribution_scope"] == "Nationwide"
    assert out[(None, "NATIONWIDE")]["risk_score"] == 50 + 20 + 20 + 25 + 2


def test_firm_names_keep_the_same_characters_as_the_fixed_pattern(spark):
    chars = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000] + ["😀", "Ａ", "１"]
    df = spark.createDataFrame([(f"x{c}y",) for c in chars], "s string")
    kept = F.trim(F.lower(F.regexp_replace("s", rules.FIRM_DROP_PATTERN, "")))
    assert df.filter(~text.clean_firm("s").eqNullSafe(kept)).count() == 0


def test_silver_rules_are_no_part_of_one_long_generated_method(spark):
    df = spark.createDataFrame([("Sold NATIONWIDE",), (None,)], "s string")
    out = df.select(text.distribution_scope("s").alias("x"))
    assert "transform(" in spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert [r.x for r in out.collect()] == ["Nationwide", rules.DISTRIBUTION_DEFAULT]

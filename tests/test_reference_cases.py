"""Four rules that must give the same results as the source system, on
records of our own.

Fixed values: the points 50/30/10 of the classes and 20 (status), 20
(nationwide), the reason points, 2 per repeat up to 20, and the tier bounds.
"""

import json

import pytest
from pyspark.sql import functions as F

from noticeflow.functions import compute_risk_score
from noticeflow.operators.scoring import score_recalls
from noticeflow.operators.silver import silver_projection
from noticeflow.sources.bronze import read_bronze

NOTICE = {
    "recall_number": "K-77", "event_id": "9", "status": "Ongoing", "classification": "Class III", "product_type": "Food",
    "recalling_firm": "Hill Creamery, LLC.", "product_description": "Yogurt drink with cocoa",
    "reason_for_recall": "Wrong label on carton", "distribution_pattern": "Shipped nationwide", "state": "OR",
    "country": "United States", "product_quantity": "3 pallets", "recall_initiation_date": "20240305",
    "report_date": "20240320", "termination_date": "",
}


@pytest.fixture(scope="module")
def notice(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landed") / "notice.json"
    path.write_text(json.dumps({"results": [NOTICE]}, indent=1), encoding="utf-8")
    return silver_projection(read_bronze(spark, str(path), multiline=True)).first()


def test_a_lower_class_is_not_read_as_a_higher_one(spark, notice):
    assert notice.classification == "Class III"
    one = spark.createDataFrame(
        [(notice.classification, notice.status, notice.distribution_pattern, notice.recall_reason_category, notice.recalling_firm_clean)],
        "classification string, status string, distribution_pattern string, recall_reason_category string, recalling_firm_clean string",
    )
    assert score_recalls(one).first().classification_score == 10


def test_the_first_matching_category_wins(notice):
    # Both a dairy and a sweets word occur; dairy is asked first.
    assert notice.product_category == "Dairy"
    assert (notice.distribution_scope, notice.region, notice.recall_reason_category) == ("Nationwide", "West", "Labeling Issue")
    assert notice.is_open is True and notice.termination_date is None and notice.recall_duration_days == 15
    assert notice.city is None and notice.postal_code is None


@pytest.mark.parametrize("inputs,points", [
    (("Class I", "Ongoing", "all stores nationwide", "Bacterial Contamination", 2), 119),
    (("Class III", "Terminated", "two counties", "Labeling Issue", 0), 20),
    ((" Class II ", "\tongoing\n", " NATIONWIDE ", "Allergen Issue ", 20), 110),
    ((None, "Ongoing soon", None, None, 0), 5),
])
def test_the_formula(spark, inputs, points):
    df = spark.createDataFrame([inputs], "c string, s string, d string, r string, n long")
    assert df.select(compute_risk_score(*map(F.col, "csdrn")).alias("x")).first().x == points


def test_forty_points_are_medium(spark):
    schema = (
        "recall_number string, classification string, status string, distribution_pattern string, "
        "recall_reason_category string, recalling_firm_clean string"
    )
    row = score_recalls(spark.createDataFrame([("K-1", "Class II", "Completed", "one shop", "Labeling Issue", "mill")], schema)).first()
    assert (row.classification_score, row.risk_score, row.risk_tier) == (30, 40, "Medium")
    assert row.risk_explanation == "Classification +30; Status +0; Distribution +0; Reason +10; Repeat company +0"

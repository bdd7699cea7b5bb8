"""The rule tables by their effects, written out here: a wrong constant in
``rules`` (which the oracle SQL shares) fails on one of these lines."""

import pytest
from pyspark.sql import functions as F

from noticeflow.operators.scoring import score_recalls
from noticeflow.operators.silver import silver_projection
from noticeflow.schemas import RECORD_FIELDS, SERVING_TABLES

# Fixed values of the source system: words and the category they select.
PRODUCTS = {
    "Dairy": "cheese milk cream yogurt butter dairy", "Meat & Poultry": "beef chicken pork turkey meat sausage",
    "Seafood": "fish shrimp crab salmon tuna seafood", "Produce": "lettuce spinach salad sprout fruit vegetable produce",
    "Infant & Baby Food": "infant baby formula", "Supplements": "supplement vitamin capsule tablet",
    "Bakery": "cookie cake bread bakery pastry", "Beverages": "juice drink beverage water", "Frozen Foods": "frozen", "Other": "rice",
}
REASONS = {
    "Bacterial Contamination": ["Listeria", "Salmonella", "E. coli", "contamination"],
    "Allergen Issue": ["undeclared allergen", "milk", "soy", "peanut", "wheat", "tree nut"],
    "Labeling Issue": ["label", "mislabeled"], "Foreign Material": ["foreign", "plastic", "metal", "glass"], "Other": ["odour", "e coli"],
}
SCOPES = {
    "Nationwide": ["nationwide", "Nationally", "all states"], "International": ["international", "Canada", "Mexico", "export"],
    "Multi-State": ["OH, PA"], "Local/Unknown": ["OH", ""],
}
REGIONS = {
    "Northeast": "CT ME MA NH RI VT NJ NY PA", "Midwest": "IL IN MI OH WI IA KS MN MO NE ND SD",
    "South": "DE FL GA MD NC SC VA DC WV AL KY MS TN AR LA OK TX", "West": "AZ CO ID MT NV NM UT WY AK CA HI OR WA", "Unknown": "PR GU XX",
}


def silver(spark, column, values):
    rows = [tuple(v if f == column else None for f in RECORD_FIELDS) for v in values]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in RECORD_FIELDS))
    return silver_projection(df)


@pytest.mark.parametrize("column,out,table", [
    ("product_description", "product_category", {k: v.split() for k, v in PRODUCTS.items()}),
    ("reason_for_recall", "recall_reason_category", REASONS),
    ("distribution_pattern", "distribution_scope", SCOPES),
    ("state", "region", {k: v.split() for k, v in REGIONS.items()}),
])
def test_every_word_selects_its_category(spark, column, out, table):
    want = {w: k for k, words in table.items() for w in words}
    got = {r[column]: r[out] for r in silver(spark, column, list(want)).select(column, out).collect()}
    assert got == want


def test_first_rules_come_first(spark):
    got = silver(spark, "product_description", ["ice cream", "fish cake", "beef salad", "baby vitamin", "frozen juice"])
    assert [r.product_category for r in got.collect()] == ["Dairy", "Seafood", "Meat & Poultry", "Infant & Baby Food", "Beverages"]
    classes = silver(spark, "classification", ["CLASS I", "class  ii", "Class III", "classiii", "IV"]).collect()
    assert [r.classification for r in classes][:3] == ["Class I", "Class II", "Class III"]


# class, status, distribution, reason -> points of the single record of a firm
POINTS = [
    ("Class I", "Ongoing", "Nationwide", "Bacterial Contamination", (50, 20, 20, 25, 115, "Critical")),
    ("Class II", "ongoing", "nationwide, all", "Allergen Issue", (30, 20, 20, 20, 90, "Critical")),
    ("Class II", "Ongoing", "Nationwide", "Foreign Material", (30, 20, 20, 5, 75, "High")),
    ("Class I", "Terminated", "Nationwide", "Other", (50, 0, 20, 5, 75, "High")),
    ("Class I", "Ongoing", "OH", "Labeling Issue", (50, 20, 0, 10, 80, "High")),
    ("Class III", "Ongoing", "OH", "Labeling Issue", (10, 20, 0, 10, 40, "Medium")),
    ("Class III", "Terminated", "OH", "Allergen Issue", (10, 0, 0, 20, 30, "Low")),
    ("Class IV", "Terminated", "OH", "Other", (0, 0, 0, 5, 5, "Low")),
]
COLUMNS = ["classification_score", "status_score", "distribution_score", "reason_score", "risk_score", "risk_tier"]


def test_points_and_tiers(spark):
    rows = [(*p[:4], f"firm {i}", f"N{i}") for i, p in enumerate(POINTS)]
    df = spark.createDataFrame(rows, "classification string, status string, distribution_pattern string, "
                                     "recall_reason_category string, recalling_firm_clean string, recall_number string")
    got = {r.recall_number: tuple(r[c] for c in COLUMNS) for r in score_recalls(df).collect()}
    assert got == {f"N{i}": p[4] for i, p in enumerate(POINTS)}


def test_repeats_count_two_points_up_to_twenty(spark):
    for n, points in ((1, 0), (2, 2), (10, 18), (11, 20), (30, 20)):
        df = spark.range(n).select(
            F.lit("Class IV").alias("classification"), F.lit("x").alias("status"), F.lit("x").alias("distribution_pattern"),
            F.lit("Other").alias("recall_reason_category"), F.lit("mill").alias("recalling_firm_clean"),
        )
        assert {r.repeated_company_score for r in score_recalls(df).collect()} == {points}


def test_keys_of_the_serving_tables():
    assert {n: t["keys"] for n, t in SERVING_TABLES.items()} == {
        "recalls": ["recall_number"], "company_risk": ["recalling_firm_clean"], "recall_reason_summary": ["recall_reason_category"],
        "monthly_recall_trends": ["recall_month"], "geographic_recall_summary": ["state", "country"],
        "product_category_summary": ["product_category"], "risk_tier_summary": ["risk_tier"], "open_recall_aging": ["recall_number"],
    }

"""Explicit schemas: bronze documents are never inferred.

Reading with a declared schema means a field missing from every record
becomes NULL (no FIELD_NOT_FOUND) and an empty ``results`` array reads as
zero rows instead of an ``array<string>`` that breaks field access.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES - the column names, orders, types and keys below must equal the
# source system's for results and served tables to match.
# ---------------------------------------------------------------------------

RECORD_FIELDS = [
    "recall_number", "event_id", "status", "classification", "product_type", "recalling_firm",
    "product_description", "reason_for_recall", "distribution_pattern", "state", "country", "city",
    "postal_code", "product_quantity", "voluntary_mandated", "initial_firm_notification",
    "recall_initiation_date", "report_date", "termination_date",
]

RECORD = StructType([StructField(f, StringType(), True) for f in RECORD_FIELDS])

META = StructType([
    StructField("source", StringType(), True),
    StructField("fetched_at", StringType(), True),
    StructField("requested_limit", LongType(), True),
    StructField("records_fetched", LongType(), True),
    StructField("search", StringType(), True),
    StructField("warning", StringType(), True),
    StructField("downloaded_files", ArrayType(StringType()), True),
    StructField("manifest_total_records", LongType(), True),
    StructField("export_date", StringType(), True),
])

BRONZE_DOCUMENT = StructType([
    StructField("meta", META, True),
    StructField("results", ArrayType(RECORD), True),
])

SILVER_COLUMNS = [
    "recall_number", "event_id", "status", "classification", "product_type", "recalling_firm",
    "recalling_firm_clean", "product_description", "reason_for_recall", "recall_reason_category",
    "product_category", "distribution_pattern", "distribution_scope", "state", "region", "country",
    "city", "postal_code", "product_quantity", "voluntary_mandated", "initial_firm_notification",
    "recall_initiation_date", "report_date", "termination_date", "is_open", "recall_duration_days",
]

SCORE_COLUMNS = [
    "repeated_company_count", "classification_score", "status_score", "distribution_score",
    "reason_score", "repeated_company_score", "risk_score", "risk_tier", "risk_explanation",
]

SCORED_COLUMNS = SILVER_COLUMNS + SCORE_COLUMNS

_T = StringType()
_D = DateType()
_I = IntegerType()
_F = DoubleType()

# Serving tables: declared column types and primary keys. Text columns
# not listed explicitly are strings.
SERVING_TABLES: dict[str, dict] = {
    "recalls": {
        "keys": ["recall_number"],
        "columns": {
            **{c: _T for c in SILVER_COLUMNS},
            "recall_initiation_date": _D, "report_date": _D, "termination_date": _D,
            "is_open": BooleanType(), "recall_duration_days": _I,
            "repeated_company_count": _I, "classification_score": _I, "status_score": _I,
            "distribution_score": _I, "reason_score": _I, "repeated_company_score": _I,
            "risk_score": _I, "risk_tier": _T, "risk_explanation": _T,
        },
        "gold": "scored",
        # served partitioned by report month, so an upsert rewrites only
        # the months it touches
        "partition": "report_month",
    },
    "company_risk": {
        "keys": ["recalling_firm_clean"],
        "columns": {
            "recalling_firm_clean": _T, "total_recalls": _I, "avg_risk_score": _F,
            "latest_recall_date": _D, "class_i_recalls": _I, "high_risk_recalls": _I,
            "ongoing_recalls": _I,
        },
        "gold": "company_risk",
    },
    "recall_reason_summary": {
        "keys": ["recall_reason_category"],
        "columns": {"recall_reason_category": _T, "count": _I},
        "gold": "recall_reason_summary",
    },
    "monthly_recall_trends": {
        "keys": ["recall_month"],
        "columns": {"recall_month": _T, "count": _I},
        "gold": "monthly_recall_trends",
    },
    "geographic_recall_summary": {
        "keys": ["state", "country"],
        "columns": {"state": _T, "country": _T, "total_recalls": _I, "avg_risk_score": _F},
        "gold": "geographic_recall_summary",
    },
    "product_category_summary": {
        "keys": ["product_category"],
        "columns": {"product_category": _T, "count": _I, "avg_risk_score": _F},
        "gold": "product_category_summary",
    },
    "risk_tier_summary": {
        "keys": ["risk_tier"],
        "columns": {"risk_tier": _T, "count": _I, "avg_risk_score": _F},
        "gold": "risk_tier_summary",
    },
    "open_recall_aging": {
        "keys": ["recall_number"],
        "columns": {
            "recall_number": _T, "recalling_firm_clean": _T, "classification": _T,
            "recall_reason_category": _T, "recall_initiation_date": _D, "recall_duration_days": _I,
            "risk_score": _I, "risk_tier": _T,
        },
        "gold": "open_recall_aging",
    },
}

RUN_LOG = StructType([
    StructField("run_id", StringType(), False),
    StructField("started_at", TimestampType(), True),
    StructField("finished_at", TimestampType(), True),
    StructField("source", StringType(), True),
    StructField("bronze_path", StringType(), True),
    StructField("records_fetched", LongType(), True),
    StructField("records_loaded", LongType(), True),
    StructField("status", StringType(), False),
    StructField("warning", StringType(), True),
    StructField("error", StringType(), True),
])

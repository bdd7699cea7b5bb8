"""Risk scoring of silver rows: one group count plus one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from .skew import attach_group_count

FIRM_KEY = "recalling_firm_clean"


def repeated_company_count(
    df: DataFrame,
    history: DataFrame | None = None,
    key: str = FIRM_KEY,
    method: str = "auto",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Rows sharing the clean firm name, minus the row itself.

    With ``history`` the count is taken over that table (e.g. everything
    served so far, including this batch) instead of only ``df``, so an
    incremental batch scores like a full rebuild. ``counts`` is a maintained
    table (key, n) of such counts.
    """
    counted = attach_group_count(df, [key], out="_firm_rows", counts_from=history, method=method, counts=counts)
    n = F.col("_firm_rows") - F.lit(1)
    if history is not None or counts is not None:
        # A batch row whose firm is not in history counts itself only.
        n = F.coalesce(n, F.lit(0).cast("bigint"))
    return counted.withColumn("repeated_company_count", n).drop("_firm_rows")


def add_scores(df: DataFrame) -> DataFrame:
    """The five component scores, total, tier and explanation (narrow)."""
    c = F.col
    with_parts = df.select(
        *[c(x) for x in df.columns],
        scores.classification_score("classification").alias("classification_score"),
        scores.status_score("status").alias("status_score"),
        scores.distribution_score("distribution_pattern").alias("distribution_score"),
        scores.reason_score("recall_reason_category").alias("reason_score"),
        scores.repeated_company_score("repeated_company_count").alias("repeated_company_score"),
    )
    total = (
        c("classification_score") + c("status_score") + c("distribution_score")
        + c("reason_score") + c("repeated_company_score")
    )
    with_total = with_parts.withColumn("risk_score", total)
    return with_total.select(
        *[c(x) for x in with_total.columns],
        scores.risk_tier("risk_score").alias("risk_tier"),
        scores.risk_explanation().alias("risk_explanation"),
    )


def score_recalls(
    silver: DataFrame, history: DataFrame | None = None, method: str = "auto", counts: DataFrame | None = None
) -> DataFrame:
    """Silver + 9 score columns (35 columns)."""
    return add_scores(repeated_company_count(silver, history=history, method=method, counts=counts))

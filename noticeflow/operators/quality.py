"""Data-quality reports: single global aggregates (partial per task, one
tiny final merge), never a collect of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def dq_report(df: DataFrame) -> DataFrame:
    """One row: records and NULL counts of four fields (blank strings are not NULL)."""
    c = F.col
    return df.agg(
        F.count(F.lit(1)).alias("records_checked"),
        F.count_if(c("recall_number").isNull()).alias("missing_recall_number"),
        F.count_if(c("classification").isNull()).alias("missing_classification"),
        F.count_if(c("reason_for_recall").isNull()).alias("missing_reason"),
        F.count_if(c("recalling_firm").isNull()).alias("missing_recalling_firm"),
    )


def missing_value_report(df: DataFrame, checks: dict[str, str], total: str = "records_checked") -> DataFrame:
    """One row: row count plus a NULL count per ``{output: column}`` check."""
    return df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(F.col(col).isNull()).alias(out) for out, col in checks.items()],
    )


def duplicate_count(df: DataFrame, columns: list[str] | str = "recall_number", out: str = "duplicate_recall_numbers") -> DataFrame:
    """Rows beyond the first per non-NULL value (tuple) of ``columns``.

    count(non-NULL) - count(DISTINCT): Spark de-duplicates map-side before
    the shuffle, so a value repeated a billion times costs one row per task.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    nonnull = None
    for x in cols:
        cond = F.col(x).isNotNull()
        nonnull = cond if nonnull is None else nonnull & cond
    return df.agg(
        (F.count_if(nonnull) - F.count_distinct(*[F.col(x) for x in cols])).alias(out)
    )


def duplicate_recall_numbers(df: DataFrame) -> DataFrame:
    return duplicate_count(df, "recall_number", "duplicate_recall_numbers")


def invalid_score_count(score: str = "risk_score", upper: int = 100, strict_reference: bool = False):
    """Aggregate Column: scores NULL or outside [0, upper].

    ``strict_reference=True`` reproduces the dashboard's arithmetic, which
    counts a NULL twice (once as missing, once as out of range).
    """
    s = F.col(score)
    bad = s.isNull() | ~s.between(0, upper)
    n = F.count_if(bad)
    if strict_reference:
        n = n + F.count_if(s.isNull())
    return n


def invalid_scores(df: DataFrame, upper: int = 100, strict_reference: bool = False) -> DataFrame:
    return df.agg(invalid_score_count("risk_score", upper, strict_reference).alias("invalid_scores"))


def dq_report_long(df: DataFrame, upper: int = 100, strict_reference: bool = False) -> DataFrame:
    """(metric, value, status) rows, built from one wide aggregate.

    Missing-value checks appear only for columns present in ``df``; the
    report-date range only when some report date is set; an empty input
    gives no rows. status = 'Review' when a check counts something.
    """
    present = set(df.columns)
    c = F.col
    aggs = [F.count(F.lit(1)).alias("n")]
    missing = [(label, col) for label, col in rules.DQ_MISSING_CHECKS if col in present]
    for i, (_, col) in enumerate(missing):
        aggs.append(F.count_if(c(col).isNull()).alias(f"m{i}"))
    if "recall_number" in present:
        aggs.append((F.count(c("recall_number")) - F.count_distinct(c("recall_number"))).alias("dup"))
    if "report_date" in present:
        aggs.append(F.min("report_date").alias("dmin"))
        aggs.append(F.max("report_date").alias("dmax"))
    if "risk_score" in present:
        aggs.append(invalid_score_count("risk_score", upper, strict_reference).alias("bad"))
    wide = df.agg(*aggs)

    def entry(order, metric, value, status, keep=None):
        return F.struct(
            F.lit(order).alias("check_order"),
            F.lit(metric).alias("metric"),
            value.cast("string").alias("value"),
            status.alias("status"),
            (keep if keep is not None else F.lit(True)).alias("keep"),
        )

    def review(v):
        return F.when(v != 0, F.lit("Review")).otherwise(F.lit("OK"))

    ok = F.lit("OK")
    entries = [entry(0, "Records checked", c("n"), ok)]
    for i, (label, _) in enumerate(missing):
        entries.append(entry(1 + i, label, c(f"m{i}"), review(c(f"m{i}"))))
    if "recall_number" in present:
        entries.append(entry(10, "Duplicate recall numbers", c("dup"), review(c("dup"))))
    if "report_date" in present:
        has_dates = c("dmin").isNotNull()
        entries.append(entry(11, "Earliest report date", F.date_format("dmin", "yyyy-MM-dd"), ok, has_dates))
        entries.append(entry(12, "Latest report date", F.date_format("dmax", "yyyy-MM-dd"), ok, has_dates))
    if "risk_score" in present:
        entries.append(entry(13, "Missing or invalid risk scores", c("bad"), review(c("bad"))))
    return (
        wide.filter(c("n") > 0)
        .select(F.inline(F.array(*entries)))
        .filter(c("keep"))
        .select("check_order", "metric", "value", "status")
    )

"""Gold summaries of the scored table.

Every summary is one ``groupBy().agg`` (hash aggregate with a map-side
partial step, so a hot group costs one row per task in the shuffle).
NULL groups are kept and rows are counted with ``count(*)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import rules

HIGH_TIERS = ["Critical", "High"]


def recall_overview(scored: DataFrame) -> DataFrame:
    return scored.groupBy("classification").agg(F.count(F.lit(1)).alias("count"))


def recall_reason_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("recall_reason_category").agg(F.count(F.lit(1)).alias("count"))


def _company_measures():
    c = F.col
    return [
        F.count(F.lit(1)).alias("total_recalls"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.max("recall_initiation_date").alias("latest_recall_date"),
        F.count_if(c("classification") == "Class I").alias("class_i_recalls"),
        F.count_if(c("risk_tier").isin(HIGH_TIERS)).alias("high_risk_recalls"),
        F.count_if(c("status").rlike("(?i)ongoing")).alias("ongoing_recalls"),
    ]


def company_risk(scored: DataFrame) -> DataFrame:
    """firm -> total, mean score, latest initiation, Class I / high-risk / ongoing counts."""
    return scored.groupBy("recalling_firm_clean").agg(*_company_measures())


def company_risk_joined(scored: DataFrame) -> DataFrame:
    """Same table assembled as (count, mean) LEFT JOIN latest date LEFT JOIN
    flag counts, all keyed by firm. Kept as a cross-check of
    :func:`company_risk`; NULL firms drop out of equality joins, so they
    are matched null-safely here. Three aggregates over three scans: use
    :func:`company_risk`, which is one, for anything but the cross-check."""
    c = F.col
    k = "recalling_firm_clean"
    base = scored.groupBy(k).agg(F.count(F.lit(1)).alias("total_recalls"), F.avg("risk_score").alias("avg_risk_score"))
    latest = scored.groupBy(k).agg(F.max("recall_initiation_date").alias("latest_recall_date"))
    flags = scored.groupBy(k).agg(
        F.count_if(c("classification") == "Class I").alias("class_i_recalls"),
        F.count_if(c("risk_tier").isin(HIGH_TIERS)).alias("high_risk_recalls"),
        F.count_if(c("status").rlike("(?i)ongoing")).alias("ongoing_recalls"),
    )
    j = base.join(latest, base[k].eqNullSafe(latest[k]), "left").select(base["*"], latest["latest_recall_date"])
    j2 = j.join(flags, j[k].eqNullSafe(flags[k]), "left")
    return j2.select(
        j[k], "total_recalls", "avg_risk_score", "latest_recall_date",
        "class_i_recalls", "high_risk_recalls", "ongoing_recalls",
    )


def company_watchlist(company: DataFrame) -> DataFrame:
    """Companies by high-risk count, then mean score (descending); firm
    name breaks ties so the order is total and the range partitioning of
    the sort is balanced."""
    c = F.col
    return company.orderBy(
        c("high_risk_recalls").desc(), c("avg_risk_score").desc(), c("recalling_firm_clean").asc_nulls_last()
    )


def monthly_recall_trends(scored: DataFrame) -> DataFrame:
    return (
        scored.select(dates.recall_month("recall_initiation_date").alias("recall_month"))
        .groupBy("recall_month")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def geographic_recall_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("state", "country").agg(
        F.count(F.lit(1)).alias("total_recalls"), F.avg("risk_score").alias("avg_risk_score")
    )


def risk_tier_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("count"), F.avg("risk_score").alias("avg_risk_score"))


def product_category_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("count"), F.avg("risk_score").alias("avg_risk_score")
    )


def open_recalls(scored: DataFrame) -> DataFrame:
    """Rows whose status mentions 'ongoing' (any case). Silver holds that as
    ``is_open``: a comparison that reaches the Parquet scan, which a pattern
    does not."""
    if "is_open" in scored.columns:
        return scored.filter(F.col("is_open") == F.lit(True))
    return scored.filter(F.col("status").rlike("(?i)ongoing"))


def open_recall_aging(scored: DataFrame, ordered: bool = False) -> DataFrame:
    out = open_recalls(scored).select(*rules.OPEN_AGING_COLUMNS)
    if ordered:
        out = out.orderBy(F.col("recall_duration_days").desc_nulls_last(), F.col("recall_number").asc_nulls_last())
    return out


GOLD_TABLES = {
    "recall_overview": recall_overview,
    "recall_reason_summary": recall_reason_summary,
    "company_risk": company_risk,
    "monthly_recall_trends": monthly_recall_trends,
    "geographic_recall_summary": geographic_recall_summary,
    "risk_tier_summary": risk_tier_summary,
    "product_category_summary": product_category_summary,
    "open_recall_aging": open_recall_aging,
}


def gold_tables(scored: DataFrame) -> dict[str, DataFrame]:
    """The nine gold DataFrames; the watchlist is derived from company_risk."""
    out = {name: fn(scored) for name, fn in GOLD_TABLES.items()}
    out["company_watchlist"] = company_watchlist(out["company_risk"])
    return out


# ------------------------------------------------ single-pass summaries
# group keys of the seven group-by summaries, and the measures each keeps
SUMMARY_SETS: dict[str, list[str]] = {
    "recall_overview": ["classification"],
    "recall_reason_summary": ["recall_reason_category"],
    "company_risk": ["recalling_firm_clean"],
    "monthly_recall_trends": ["recall_month"],
    "geographic_recall_summary": ["state", "country"],
    "risk_tier_summary": ["risk_tier"],
    "product_category_summary": ["product_category"],
}
SUMMARY_MEASURES: dict[str, list[tuple[str, str]]] = {
    "recall_overview": [("n", "count")],
    "recall_reason_summary": [("n", "count")],
    "company_risk": [
        ("n", "total_recalls"), ("avg_risk_score", "avg_risk_score"), ("latest_recall_date", "latest_recall_date"),
        ("class_i_recalls", "class_i_recalls"), ("high_risk_recalls", "high_risk_recalls"),
        ("ongoing_recalls", "ongoing_recalls"),
    ],
    "monthly_recall_trends": [("n", "count")],
    "geographic_recall_summary": [("n", "total_recalls"), ("avg_risk_score", "avg_risk_score")],
    "risk_tier_summary": [("n", "count"), ("avg_risk_score", "avg_risk_score")],
    "product_category_summary": [("n", "count"), ("avg_risk_score", "avg_risk_score")],
}
_SET_KEYS = list(dict.fromkeys(k for ks in SUMMARY_SETS.values() for k in ks))


def _set_id(keys: list[str]) -> int:
    """grouping_id() of a set: bit set for every key *not* grouped."""
    n = len(_SET_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(_SET_KEYS) if k not in keys)


def _set_rows(scored: DataFrame, *more: str) -> DataFrame:
    """The columns that the summaries read."""
    c = F.col
    return scored.select(
        *[c(k) for k in _SET_KEYS if k != "recall_month"],
        dates.recall_month("recall_initiation_date").alias("recall_month"),
        "risk_score", "recall_initiation_date", "status", *more,
    )


def _flags():
    """The counted conditions of a company's summary."""
    c = F.col
    return {
        "class_i_recalls": c("classification") == "Class I",
        "high_risk_recalls": c("risk_tier").isin(HIGH_TIERS),
        "ongoing_recalls": c("status").rlike("(?i)ongoing"),
    }


def summary_sets(scored: DataFrame) -> DataFrame:
    """All seven summaries in one pass: GROUPING SETS over a single scan,
    partially aggregated map-side, one shuffle of (groups x tasks) rows.
    ``_set`` tells the sets apart (a NULL key stays a real NULL group)."""
    c = F.col
    return _set_rows(scored).groupingSets([[c(k) for k in ks] for ks in SUMMARY_SETS.values()], *[c(k) for k in _SET_KEYS]).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.max("recall_initiation_date").alias("latest_recall_date"),
        *[F.count_if(flag).alias(name) for name, flag in _flags().items()],
    )


def summary_from_sets(sets: DataFrame, name: str) -> DataFrame:
    """One gold summary cut from the :func:`summary_sets` table."""
    keys = SUMMARY_SETS[name]
    return sets.filter(F.col("_set") == F.lit(_set_id(keys))).select(
        *keys, *[F.col(src).alias(dst) for src, dst in SUMMARY_MEASURES[name]]
    )


# ------------------------------------------------- maintained summaries
#: Keys of a table of sums: the set and its group (NULL where not grouped).
SUM_KEYS = ["_set", *_SET_KEYS]
DATE_KEYS = ["recalling_firm_clean", "recall_initiation_date"]


def summary_sums(signed: DataFrame) -> DataFrame:
    """What scored rows add to (``sign`` 1) or take from (-1) the seven
    summaries: only sums, so that contributions of any batches add up."""
    c = F.col
    sign = c("sign").cast("long")
    return _set_rows(signed, "sign").groupingSets(
        [[c(k) for k in ks] for ks in SUMMARY_SETS.values()], *[c(k) for k in _SET_KEYS]
    ).agg(
        F.grouping_id().alias("_set"),
        F.sum(sign).alias("n"),
        F.sum(sign * c("risk_score")).alias("risk_sum"),
        *[F.sum(F.when(flag, sign).otherwise(F.lit(0))).alias(name) for name, flag in _flags().items()],
    ).select(*SUM_KEYS, "n", "risk_sum", *_flags())


def date_sums(signed: DataFrame) -> DataFrame:
    """Rows of each firm and initiation date: the greatest date that is left
    is a firm's latest one, also after rows went."""
    return signed.groupBy(*DATE_KEYS).agg(F.sum(F.col("sign").cast("long")).alias("n"))


def summary_from_sums(sums: DataFrame, by_date: DataFrame, name: str) -> DataFrame:
    """One gold summary from the maintained sums (and, for companies, dates)."""
    keys, measures = SUMMARY_SETS[name], SUMMARY_MEASURES[name]
    rows = sums.filter(F.col("_set") == F.lit(_set_id(keys))).withColumn("avg_risk_score", F.col("risk_sum") / F.col("n"))
    if ("latest_recall_date", "latest_recall_date") in measures:
        latest = by_date.groupBy(F.col(keys[0]).alias("_firm")).agg(F.max("recall_initiation_date").alias("latest_recall_date"))
        rows = rows.join(latest, rows[keys[0]].eqNullSafe(latest["_firm"]), "left")
    return rows.select(*keys, *[F.col(src).alias(dst) for src, dst in measures])

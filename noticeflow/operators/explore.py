"""Exploration operators: filters become Column predicates, pages become
aggregates / top-k over the filtered frame - one Catalyst plan each."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, rules

# ----------------------------------------------------------------- filters


def filter_report_date(df: DataFrame, start=None, end=None, column: str = "report_date") -> DataFrame:
    """Inclusive report-date window; NULL dates drop; neither bound = no-op.
    Plain comparisons against date literals, so Parquet pushes them down."""
    out = df
    if start:
        out = out.filter(F.col(column) >= dates.to_date_literal(start))
    if end:
        out = out.filter(F.col(column) <= dates.to_date_literal(end))
    return out


def _search_columns(df: DataFrame, columns=None) -> list[str]:
    wanted = columns or rules.SEARCH_COLUMNS
    return [c for c in wanted if c in df.columns]


def like_pattern(query: str) -> str:
    """'%query%' lower-cased; '%' and '_' stay wildcards, while a backslash
    is doubled so it matches itself (Spark LIKE escapes with '\\')."""
    return "%" + query.lower().replace("\\", "\\\\") + "%"


def text_search(df: DataFrame, query: str | None, columns=None) -> DataFrame:
    """Case-insensitive LIKE '%query%' OR-ed over the present search columns."""
    cols = _search_columns(df, columns)
    if not query or not cols:
        return df
    pat = like_pattern(query)
    cond = None
    for c in cols:
        term = F.lower(F.col(c).cast("string")).like(pat)
        cond = term if cond is None else cond | term
    return df.filter(cond)


def text_search_literal(df: DataFrame, query: str | None, columns=None) -> DataFrame:
    """Literal, case-insensitive substring search; NULL reads as ''."""
    cols = _search_columns(df, columns)
    if not query or not cols:
        return df
    q = F.lit(query.lower())
    cond = None
    for c in cols:
        term = F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), q)
        cond = term if cond is None else cond | term
    return df.filter(cond)


def preset_open_class_i(df: DataFrame) -> DataFrame:
    return df.filter((F.col("status") == "Ongoing") & (F.col("classification") == "Class I"))


def preset_high_risk(df: DataFrame) -> DataFrame:
    return df.filter(F.col("risk_tier").isin("Critical", "High"))


def preset_nationwide_allergen(df: DataFrame) -> DataFrame:
    return df.filter((F.col("distribution_scope") == "Nationwide") & (F.col("recall_reason_category") == "Allergen Issue"))


def preset_recent_bacterial(df: DataFrame, as_of=None, days: int = 365) -> DataFrame:
    """Bacterial recalls initiated within ``days`` of ``as_of`` (default today)."""
    as_of = as_of or _dt.date.today().isoformat()
    out = df.filter(F.col("recall_reason_category") == "Bacterial Contamination")
    if "recall_initiation_date" in df.columns:
        out = out.filter(F.col("recall_initiation_date") >= F.date_sub(dates.to_date_literal(as_of), days))
    return out


PRESET_FILTERS = {
    "All Recalls": lambda df, as_of=None: df,
    "Open Class I Recalls": lambda df, as_of=None: preset_open_class_i(df),
    "High-Risk Companies": lambda df, as_of=None: preset_high_risk(df),
    "Nationwide Allergen Recalls": lambda df, as_of=None: preset_nationwide_allergen(df),
    "Recent Bacterial Contamination": lambda df, as_of=None: preset_recent_bacterial(df, as_of),
}


def filter_recall_date(df: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive initiation-date range, applied only when both ends are given."""
    if "recall_initiation_date" not in df.columns or not start or not end:
        return df
    return df.filter(F.col("recall_initiation_date").between(dates.to_date_literal(start), dates.to_date_literal(end)))


def facet_filter(df: DataFrame, facets: dict) -> DataFrame:
    """Equality per facet; 'All', None or an absent column skips it."""
    out = df
    for key, column in rules.FACET_COLUMNS:
        value = facets.get(key, "All")
        if value is None or value == "All" or column not in df.columns:
            continue
        out = out.filter(F.col(column) == F.lit(value))
    return out


def filter_risk_range(df: DataFrame, low=None, high=None) -> DataFrame:
    if "risk_score" not in df.columns or low is None or high is None:
        return df
    return df.filter(F.col("risk_score").between(low, high))


def apply_filters(df: DataFrame, filters: dict, as_of=None) -> DataFrame:
    """search -> preset -> initiation dates -> facets -> risk range (AND)."""
    out = text_search(df, filters.get("query"))
    out = PRESET_FILTERS[filters.get("preset") or "All Recalls"](out, as_of)
    date_range = filters.get("date_range") or ()
    if len(date_range) == 2:
        out = filter_recall_date(out, date_range[0], date_range[1])
    out = facet_filter(out, filters)
    risk_range = filters.get("risk_range")
    if risk_range:
        out = filter_risk_range(out, risk_range[0], risk_range[1])
    return out


def company_recalls(df: DataFrame, firm: str) -> DataFrame:
    """One firm's recalls, newest first."""
    return df.filter(F.col("recalling_firm_clean") == F.lit(firm)).orderBy(
        F.col("recall_initiation_date").desc_nulls_last(), F.col("recall_number").asc_nulls_last()
    )


# -------------------------------------------------------------- aggregates


def kpis(df: DataFrame) -> DataFrame:
    """One row: recalls, Critical, Ongoing, mean score (1 dp, half-even; 0
    when empty) and latest report date ('N/A' when none). A column the frame
    lacks counts as empty."""

    def column(name: str, kind: str):
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    return df.agg(
        F.count(F.lit(1)).alias("recalls"),
        F.count_if(column("risk_tier", "string") == "Critical").alias("critical"),
        F.count_if(column("status", "string") == "Ongoing").alias("ongoing"),
        F.coalesce(F.bround(F.avg(column("risk_score", "long")), 1), F.lit(0.0)).alias("avg_risk"),
        F.coalesce(F.date_format(F.max(column("report_date", "date")), "yyyy-MM-dd"), F.lit("N/A")).alias("latest_report"),
    )


def prepare_explore_input(df: DataFrame) -> DataFrame:
    """Repair a served frame for exploration in one step: dates as DATE
    (bad values NULL), ``risk_tier`` from the score bins where the column is
    absent, missing category columns filled with the constant."""
    from ..functions.scores import risk_tier_bins
    from ..sources.serving import backfill_columns, normalize_dates

    out = normalize_dates(df)
    if "risk_tier" not in out.columns and "risk_score" in out.columns:
        out = out.withColumn("risk_tier", risk_tier_bins("risk_score"))
    return backfill_columns(out)


def most_frequent(df: DataFrame, column: str, out: str) -> DataFrame:
    """Most frequent non-NULL value (ties: smallest label); no row when empty."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(column).asc())
        .limit(1)
        .select(F.col(column).alias(out), F.col("n").alias("occurrences"))
    )


def top_reason(df: DataFrame) -> DataFrame:
    return most_frequent(df, "recall_reason_category", "top_reason")


def top_product(df: DataFrame) -> DataFrame:
    return most_frequent(df, "product_category", "top_product")


def top_risk_company(df: DataFrame) -> DataFrame:
    """Firm with the highest mean score (NULL firms dropped; ties by name)."""
    return (
        df.filter(F.col("recalling_firm_clean").isNotNull())
        .groupBy("recalling_firm_clean")
        .agg(F.avg("risk_score").alias("avg_risk_score"))
        .orderBy(F.col("avg_risk_score").desc(), F.col("recalling_firm_clean").asc())
        .limit(1)
    )


def company_reason_counts(df: DataFrame, firm: str) -> DataFrame:
    return (
        df.filter(F.col("recalling_firm_clean") == F.lit(firm))
        .groupBy(F.col("recall_reason_category").alias("reason"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("reason").asc_nulls_last())
    )


def company_summary(df: DataFrame) -> DataFrame:
    """firm -> non-NULL recall numbers, mean score, Critical count (NULL firms dropped)."""
    return (
        df.filter(F.col("recalling_firm_clean").isNotNull())
        .groupBy("recalling_firm_clean")
        .agg(
            F.count("recall_number").alias("total_recalls"),
            F.avg("risk_score").alias("avg_risk_score"),
            F.count_if(F.col("risk_tier") == "Critical").alias("critical_recalls"),
        )
    )


def company_top20(df: DataFrame, k: int = 20) -> DataFrame:
    """Top-k firms by mean score (a top-k report: TakeOrderedAndProject)."""
    return company_summary(df).orderBy(F.col("avg_risk_score").desc(), F.col("recalling_firm_clean").asc()).limit(k)


def severity_by_product(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("product_category").isNotNull() & F.col("risk_tier").isNotNull())
        .groupBy("product_category", "risk_tier")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def state_summary(df: DataFrame, ordered: bool = True) -> DataFrame:
    """state -> non-NULL recall numbers and mean score, by count descending."""
    out = (
        df.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(F.count("recall_number").alias("total_recalls"), F.avg("risk_score").alias("avg_risk_score"))
    )
    if ordered:
        out = out.orderBy(F.col("total_recalls").desc(), F.col("state").asc())
    return out


def top_states_by_count(df: DataFrame, k: int = 20) -> DataFrame:
    return state_summary(df, ordered=False).orderBy(F.col("total_recalls").desc(), F.col("state").asc()).limit(k)


def top_states_by_risk(df: DataFrame, k: int = 20) -> DataFrame:
    return state_summary(df, ordered=False).orderBy(F.col("avg_risk_score").desc(), F.col("state").asc()).limit(k)


def risk_histogram(df: DataFrame, bins: int = 25, floor_max: int = 100) -> DataFrame:
    """Score histogram by tier: ``bins`` equal bins over [0, max(100, max
    score)], the top edge in the last bin. The upper edge is a scalar
    subquery (computed once, then a literal) - no join, no single-task window."""
    upper = df.select(F.greatest(F.lit(floor_max), F.max("risk_score")).cast("double")).scalar()
    s = F.col("risk_score").cast("double")
    b = F.least(F.width_bucket(s, F.lit(0.0), upper, F.lit(bins)), F.lit(bins))
    width = upper / F.lit(bins)
    return (
        df.filter(F.col("risk_score").isNotNull())
        .select(b.alias("bin"), F.col("risk_tier"), width.alias("_w"))
        .groupBy("bin", "risk_tier", "_w")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("bin"),
            ((F.col("bin") - 1) * F.col("_w")).alias("bin_start"),
            (F.col("bin") * F.col("_w")).alias("bin_end"),
            F.col("risk_tier"),
            F.col("count"),
        )
    )


def filter_bounds(df: DataFrame, as_of=None) -> DataFrame:
    """Initiation-date bounds (defaults when there is none) and the risk-slider maximum."""
    as_of = as_of or _dt.date.today().isoformat()
    return df.agg(
        F.coalesce(F.min("recall_initiation_date"), dates.to_date_literal(rules.DEFAULT_MIN_RECALL_DATE)).alias("min_date"),
        F.coalesce(F.max("recall_initiation_date"), dates.to_date_literal(as_of)).alias("max_date"),
        F.coalesce(F.greatest(F.lit(100), F.max("risk_score")), F.lit(100)).cast("bigint").alias("risk_max"),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows): one count aggregate per table, unioned."""
    out = None
    for name, t in tables.items():
        row = t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ orders


def recall_explorer(df: DataFrame) -> DataFrame:
    cols = [c for c in rules.EXPLORER_COLUMNS if c in df.columns]
    return df.select(*cols).orderBy(F.col("risk_score").desc_nulls_last(), F.col("recall_number").asc_nulls_last())


def company_risk_timeline(df: DataFrame, firm: str) -> DataFrame:
    return (
        df.filter(F.col("recalling_firm_clean") == F.lit(firm))
        .select("recall_number", "recall_initiation_date", "risk_score", "risk_tier")
        .orderBy(F.col("recall_initiation_date").asc_nulls_last(), F.col("recall_number").asc_nulls_last())
    )


def sorted_month_trend(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy(F.col("recall_month").asc_nulls_last())


def reasons_by_count(reason_summary: DataFrame) -> DataFrame:
    return reason_summary.orderBy(F.col("count").asc(), F.col("recall_reason_category").asc_nulls_last())


def products_by_count(product_summary: DataFrame) -> DataFrame:
    return product_summary.orderBy(F.col("count").asc(), F.col("product_category").asc_nulls_last())


def option_list(df: DataFrame, column: str) -> DataFrame:
    """'All' first, then the sorted distinct non-NULL, non-blank values.
    ``distinct`` de-duplicates map-side, so the shuffle carries one row per
    value per task."""
    spark = df.sparkSession
    all_row = spark.range(1).select(F.lit("All").alias("option"), F.lit(0).alias("_rank"))
    if column not in df.columns:
        return all_row.select("option")
    vals = (
        df.select(F.col(column).cast("string").alias("option"))
        .filter(F.col("option").isNotNull() & (F.col("option") != ""))
        .distinct()
        .withColumn("_rank", F.lit(1))
    )
    return all_row.unionByName(vals).orderBy("_rank", "option").select("option")


def company_list(df: DataFrame) -> DataFrame:
    return (
        df.select("recalling_firm_clean")
        .filter(F.col("recalling_firm_clean").isNotNull())
        .distinct()
        .orderBy("recalling_firm_clean")
    )

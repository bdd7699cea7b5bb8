"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame`` plus the
DuckDB oracle SQL for each key.

Every query reads the driver's tables (or data Spark derives and writes
from them) in full; there are no id subsets, modulo filters or row caps.
A ``limit`` appears only where it is the feature (top-k reports, the
source row limit).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, rules, scores, text
from ..operators import explore, gold, quality
from ..operators.scoring import score_recalls
from ..operators.silver import region_join, silver_projection
from ..operators.skew import attach_group_count
from ..sources.fixture import read_driver_table, recall_records
from . import oracle as O
from .oracle import q, with_base

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries (the oracle uses the same).
AS_OF = "2001-06-30"
REPORT_START, REPORT_END = "1996-01-01", "1997-12-31"
RECALL_START, RECALL_END = "1997-03-01", "1999-10-31"
FIRM = "customer000000001  co"
SEARCH_TEXT = "co"
SEARCH_WILDCARD = "f-00_0%1"
LITERAL_TEXT = "ream"
RISK_LOW, RISK_HIGH = 40, 95
FACETS = {"classification": "Class II", "status": "Terminated", "state": "TX"}
FILTERS = {
    "query": "inc",
    "preset": "High-Risk Companies",
    "date_range": ("1996-06-01", "2000-12-31"),
    "risk_range": (60, 130),
    "classification": "Class I",
    "status": "All",
    "reason": "All",
    "product_category": "All",
    "distribution_scope": "All",
    "state": "All",
    "risk_tier": "All",
}
DOC_SEARCH = "tion"


def _bigint_count_if(sql: str) -> str:
    """DuckDB's count_if is HUGEINT; Spark's is BIGINT. Cast each call."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = _bigint_count_if(sql)
        return fn

    return deco


def records(spark, sf):
    return recall_records(spark, sf)


def silver(spark, sf):
    return silver_projection(records(spark, sf))


def scored(spark, sf):
    return score_recalls(silver(spark, sf))


# ===================================================== §2.B scalar functions
register("silver_projection", with_base("SELECT * FROM silver"))(lambda s, d: silver(s, d))

register(
    "clean_firm",
    with_base(f"SELECT recalling_firm, {O.clean_firm_sql('recalling_firm')} AS recalling_firm_clean FROM fx"),
)(lambda s, d: records(s, d).select("recalling_firm", text.clean_firm("recalling_firm").alias("recalling_firm_clean")))

register(
    "standard_classification",
    with_base(
        "SELECT classification AS raw_classification, "
        f"{O.first_match_sql('classification', rules.CLASSIFICATION_RULES, 'classification')} AS classification FROM fx"
    ),
)(lambda s, d: records(s, d).select(
    F.col("classification").alias("raw_classification"),
    text.standard_classification("classification").alias("classification"),
))

register(
    "standard_status",
    with_base(f"SELECT status AS raw_status, {O.first_match_sql('status', rules.STATUS_RULES, 'status')} AS status FROM fx"),
)(lambda s, d: records(s, d).select(F.col("status").alias("raw_status"), text.standard_status("status").alias("status")))

register(
    "reason_category",
    with_base(
        "SELECT reason_for_recall, "
        f"{O.first_match_sql('reason_for_recall', rules.REASON_RULES, q(rules.REASON_DEFAULT))} AS recall_reason_category FROM fx"
    ),
)(lambda s, d: records(s, d).select("reason_for_recall", text.reason_category("reason_for_recall").alias("recall_reason_category")))

register(
    "product_category",
    with_base(
        "SELECT product_description, "
        f"{O.first_match_sql('product_description', rules.PRODUCT_RULES, q(rules.PRODUCT_DEFAULT))} AS product_category FROM fx"
    ),
)(lambda s, d: records(s, d).select("product_description", text.product_category("product_description").alias("product_category")))

register(
    "distribution_scope",
    with_base(
        "SELECT distribution_pattern, "
        f"{O.first_match_sql('distribution_pattern', rules.DISTRIBUTION_RULES, q(rules.DISTRIBUTION_DEFAULT))} AS distribution_scope FROM fx"
    ),
)(lambda s, d: records(s, d).select("distribution_pattern", text.distribution_scope("distribution_pattern").alias("distribution_scope")))

# The shared ordered-rule builder, applied to whole document texts.
register(
    "first_match_category",
    "SELECT doc_id, "
    f"{O.first_match_sql('text', rules.REASON_RULES, q(rules.REASON_DEFAULT))} AS reason_category, "
    f"{O.first_match_sql('text', rules.PRODUCT_RULES, q(rules.PRODUCT_DEFAULT))} AS product_category, "
    f"{O.first_match_sql('text', rules.DISTRIBUTION_RULES, q(rules.DISTRIBUTION_DEFAULT))} AS distribution_scope "
    "FROM documents",
)(lambda s, d: read_driver_table(s, d, "documents", spread=True).select(
    "doc_id",
    text.first_match_category("text", rules.REASON_RULES, rules.REASON_DEFAULT).alias("reason_category"),
    text.first_match_category("text", rules.PRODUCT_RULES, rules.PRODUCT_DEFAULT).alias("product_category"),
    text.first_match_category("text", rules.DISTRIBUTION_RULES, rules.DISTRIBUTION_DEFAULT).alias("distribution_scope"),
))

register("region", with_base(f"SELECT state, {O.region_sql('state')} AS region FROM fx"))(
    lambda s, d: records(s, d).select("state", text.region("state").alias("region"))
)

register(
    "parse_compact_date",
    with_base(
        "SELECT termination_date AS raw_termination_date, recall_initiation_date AS raw_initiation_date, "
        f"{O.compact_date_sql('termination_date')} AS termination_date, "
        f"{O.compact_date_sql('recall_initiation_date')} AS recall_initiation_date FROM fx"
    ),
)(lambda s, d: records(s, d).select(
    F.col("termination_date").alias("raw_termination_date"),
    F.col("recall_initiation_date").alias("raw_initiation_date"),
    dates.parse_compact_date("termination_date").alias("termination_date"),
    dates.parse_compact_date("recall_initiation_date").alias("recall_initiation_date"),
))

register("is_open", with_base("SELECT status, regexp_matches(lower(status), 'ongoing') AS is_open FROM silver"))(
    lambda s, d: silver(s, d).select("status", text.is_open("status").alias("is_open"))
)

register(
    "recall_duration_days",
    with_base(
        "SELECT recall_number, recall_initiation_date, termination_date, report_date, recall_duration_days FROM silver"
    ),
)(lambda s, d: silver(s, d).select(
    "recall_number", "recall_initiation_date", "termination_date", "report_date",
    dates.recall_duration_days("recall_initiation_date", "termination_date", "report_date").alias("recall_duration_days"),
))

register(
    "recall_month",
    with_base("SELECT recall_initiation_date, strftime(recall_initiation_date, '%Y-%m') AS recall_month FROM silver"),
)(lambda s, d: silver(s, d).select("recall_initiation_date", dates.recall_month("recall_initiation_date").alias("recall_month")))

register(
    "fill_conflict_keys",
    with_base(
        "SELECT recall_number AS raw_recall_number, state AS raw_state, "
        "CASE WHEN recall_number IS NULL OR recall_number = '' THEN 'Unknown' ELSE recall_number END AS recall_number, "
        "CASE WHEN state IS NULL OR state = '' THEN 'Unknown' ELSE state END AS state FROM fx"
    ),
)(lambda s, d: records(s, d).select(
    F.col("recall_number").alias("raw_recall_number"),
    F.col("state").alias("raw_state"),
    text.fill_conflict_keys("recall_number").alias("recall_number"),
    text.fill_conflict_keys("state").alias("state"),
))

register("risk_explanation", with_base("SELECT recall_number, risk_explanation FROM scored"))(
    lambda s, d: scored(s, d).select("recall_number", scores.risk_explanation().alias("risk_explanation"))
)

register(
    "iso_date_text",
    with_base(
        "SELECT strftime(report_date, '%Y-%m-%d') AS report_date_text, "
        "strftime(recall_initiation_date, '%Y-%m-%d') AS initiation_date_text FROM silver"
    ),
)(lambda s, d: silver(s, d).select(
    dates.iso_date_text("report_date").alias("report_date_text"),
    dates.iso_date_text("recall_initiation_date").alias("initiation_date_text"),
))

# ============================================================ §2.C scoring
_SCORE_KEY = "recall_number, recalling_firm_clean"

register("classification_score", with_base(f"SELECT {_SCORE_KEY}, classification, classification_score FROM scored"))(
    lambda s, d: silver(s, d).select(
        "recall_number", "recalling_firm_clean", "classification",
        scores.classification_score("classification").alias("classification_score"),
    )
)
register("status_score", with_base(f"SELECT {_SCORE_KEY}, status, status_score FROM scored"))(
    lambda s, d: silver(s, d).select(
        "recall_number", "recalling_firm_clean", "status", scores.status_score("status").alias("status_score")
    )
)
register(
    "distribution_score",
    with_base(f"SELECT {_SCORE_KEY}, distribution_pattern, distribution_scope, distribution_score FROM scored"),
)(lambda s, d: silver(s, d).select(
    "recall_number", "recalling_firm_clean", "distribution_pattern", "distribution_scope",
    scores.distribution_score("distribution_pattern").alias("distribution_score"),
))
register("reason_score", with_base(f"SELECT {_SCORE_KEY}, recall_reason_category, reason_score FROM scored"))(
    lambda s, d: silver(s, d).select(
        "recall_number", "recalling_firm_clean", "recall_reason_category",
        scores.reason_score("recall_reason_category").alias("reason_score"),
    )
)
register("repeated_company_count", with_base(f"SELECT {_SCORE_KEY}, repeated_company_count FROM scored"))(
    lambda s, d: scored(s, d).select("recall_number", "recalling_firm_clean", "repeated_company_count")
)
register(
    "repeated_company_score",
    with_base(f"SELECT {_SCORE_KEY}, repeated_company_count, repeated_company_score FROM scored"),
)(lambda s, d: scored(s, d).select(
    "recall_number", "recalling_firm_clean", "repeated_company_count",
    scores.repeated_company_score("repeated_company_count").alias("repeated_company_score"),
))
register("risk_score", with_base(f"SELECT {_SCORE_KEY}, risk_score FROM scored"))(
    lambda s, d: scored(s, d).select("recall_number", "recalling_firm_clean", "risk_score")
)
register("risk_tier", with_base(f"SELECT {_SCORE_KEY}, risk_score, risk_tier FROM scored"))(
    lambda s, d: scored(s, d).select(
        "recall_number", "recalling_firm_clean", "risk_score", scores.risk_tier("risk_score").alias("risk_tier")
    )
)
register("score_recalls", with_base("SELECT * FROM scored"))(lambda s, d: scored(s, d))

register(
    "compute_risk_score",
    with_base(f"""SELECT {_SCORE_KEY},
  {O.points_sql("regexp_replace(coalesce(classification, ''), '^\\s+|\\s+$', '', 'g')", rules.CLASSIFICATION_POINTS, 0)}
  + CASE WHEN lower(regexp_replace(coalesce(status, ''), '^\\s+|\\s+$', '', 'g')) = 'ongoing' THEN {rules.STATUS_POINTS} ELSE 0 END
  + CASE WHEN contains(lower(regexp_replace(coalesce(distribution_pattern, ''), '^\\s+|\\s+$', '', 'g')), 'nationwide') THEN {rules.DISTRIBUTION_POINTS} ELSE 0 END
  + {O.points_sql("regexp_replace(coalesce(recall_reason_category, ''), '^\\s+|\\s+$', '', 'g')", rules.REASON_POINTS, rules.REASON_POINTS_DEFAULT)}
  + least(coalesce(repeated_company_count, 0) * {rules.REPEAT_POINTS_PER_RECALL}, {rules.REPEAT_POINTS_CAP}) AS formula_score
FROM scored"""),
)(lambda s, d: scored(s, d).select(
    "recall_number", "recalling_firm_clean",
    scores.compute_risk_score(
        "classification", "status", "distribution_pattern", "recall_reason_category", "repeated_company_count"
    ).alias("formula_score"),
))

register(
    "risk_tier_bins",
    with_base("""SELECT recall_number, risk_score,
  CASE WHEN risk_score IS NULL OR risk_score <= -1 THEN NULL WHEN risk_score <= 39 THEN 'Low'
       WHEN risk_score <= 69 THEN 'Medium' WHEN risk_score <= 89 THEN 'High' ELSE 'Critical' END AS risk_tier_binned
FROM scored"""),
)(lambda s, d: scored(s, d).select(
    "recall_number", "risk_score", scores.risk_tier_bins("risk_score").alias("risk_tier_binned")
))

# Repeat count at scale on a driver table with a real hot-key spread.
register(
    "repeated_supplier_count",
    "SELECT l_orderkey, l_linenumber, l_suppkey, "
    "CAST(count(*) OVER (PARTITION BY l_suppkey) - 1 AS BIGINT) AS repeated_count FROM lineitem",
)(lambda s, d: attach_group_count(
    read_driver_table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), ["l_suppkey"], out="_n"
).select("l_orderkey", "l_linenumber", "l_suppkey", (F.col("_n") - 1).alias("repeated_count")))

# ============================================================ §2.D filters
register(
    "filter_report_date",
    with_base(f"SELECT * FROM silver WHERE report_date >= DATE '{REPORT_START}' AND report_date <= DATE '{REPORT_END}'"),
)(lambda s, d: explore.filter_report_date(silver(s, d), REPORT_START, REPORT_END))


def _like_sql(query: str, cols) -> str:
    pat = "%" + query.lower() + "%"
    return " OR ".join(f"lower(CAST({c} AS VARCHAR)) LIKE {q(pat)}" for c in cols)


register("text_search", with_base(f"SELECT * FROM scored WHERE {_like_sql(SEARCH_TEXT, rules.SEARCH_COLUMNS)}"))(
    lambda s, d: explore.text_search(scored(s, d), SEARCH_TEXT)
)
register(
    "text_search_wildcards",
    with_base(f"SELECT * FROM scored WHERE {_like_sql(SEARCH_WILDCARD, rules.SEARCH_COLUMNS)}"),
)(lambda s, d: explore.text_search(scored(s, d), SEARCH_WILDCARD))

register(
    "text_search_documents",
    f"SELECT doc_id, lang, source FROM documents WHERE lower(CAST(text AS VARCHAR)) LIKE {q('%' + DOC_SEARCH + '%')}",
)(lambda s, d: explore.text_search(read_driver_table(s, d, "documents", spread=True), DOC_SEARCH, columns=["text"]).select(
    "doc_id", "lang", "source"
))


def _literal_sql(query: str, cols) -> str:
    return " OR ".join(f"contains(lower(coalesce(CAST({c} AS VARCHAR), '')), {q(query.lower())})" for c in cols)


register(
    "text_search_literal",
    with_base(f"SELECT * FROM scored WHERE {_literal_sql(LITERAL_TEXT, rules.SEARCH_COLUMNS)}"),
)(lambda s, d: explore.text_search_literal(scored(s, d), LITERAL_TEXT))

register(
    "preset_open_class_i",
    with_base("SELECT * FROM scored WHERE status = 'Ongoing' AND classification = 'Class I'"),
)(lambda s, d: explore.preset_open_class_i(scored(s, d)))
register("preset_high_risk", with_base("SELECT * FROM scored WHERE risk_tier IN ('Critical', 'High')"))(
    lambda s, d: explore.preset_high_risk(scored(s, d))
)
register(
    "preset_nationwide_allergen",
    with_base("SELECT * FROM scored WHERE distribution_scope = 'Nationwide' AND recall_reason_category = 'Allergen Issue'"),
)(lambda s, d: explore.preset_nationwide_allergen(scored(s, d)))
register(
    "preset_recent_bacterial",
    with_base(
        "SELECT * FROM scored WHERE recall_reason_category = 'Bacterial Contamination' "
        f"AND recall_initiation_date >= DATE '{AS_OF}' - INTERVAL 365 DAY"
    ),
)(lambda s, d: explore.preset_recent_bacterial(scored(s, d), AS_OF))
register(
    "filter_recall_date",
    with_base(f"SELECT * FROM scored WHERE recall_initiation_date BETWEEN DATE '{RECALL_START}' AND DATE '{RECALL_END}'"),
)(lambda s, d: explore.filter_recall_date(scored(s, d), RECALL_START, RECALL_END))
register(
    "facet_filter",
    with_base("SELECT * FROM scored WHERE classification = 'Class II' AND status = 'Terminated' AND state = 'TX'"),
)(lambda s, d: explore.facet_filter(scored(s, d), FACETS))
register("filter_risk_range", with_base(f"SELECT * FROM scored WHERE risk_score BETWEEN {RISK_LOW} AND {RISK_HIGH}"))(
    lambda s, d: explore.filter_risk_range(scored(s, d), RISK_LOW, RISK_HIGH)
)
register(
    "apply_filters",
    with_base(f"""SELECT * FROM scored WHERE ({_like_sql(FILTERS['query'], rules.SEARCH_COLUMNS)})
  AND risk_tier IN ('Critical', 'High')
  AND recall_initiation_date BETWEEN DATE '{FILTERS['date_range'][0]}' AND DATE '{FILTERS['date_range'][1]}'
  AND classification = 'Class I'
  AND risk_score BETWEEN {FILTERS['risk_range'][0]} AND {FILTERS['risk_range'][1]}"""),
)(lambda s, d: explore.apply_filters(scored(s, d), FILTERS, as_of=AS_OF))
register("open_recalls", with_base("SELECT * FROM scored WHERE regexp_matches(status, '(?i)ongoing')"))(
    lambda s, d: gold.open_recalls(scored(s, d))
)
register("company_recalls", with_base(f"SELECT * FROM scored WHERE recalling_firm_clean = {q(FIRM)}"))(
    lambda s, d: explore.company_recalls(scored(s, d), FIRM)
)

# ======================================================= §2.E aggregations
register("recall_overview", with_base("SELECT classification, count(*) AS count FROM scored GROUP BY classification"))(
    lambda s, d: gold.recall_overview(scored(s, d))
)
register(
    "recall_reason_summary",
    with_base("SELECT recall_reason_category, count(*) AS count FROM scored GROUP BY recall_reason_category"),
)(lambda s, d: gold.recall_reason_summary(scored(s, d)))

COMPANY_RISK_SQL = """SELECT recalling_firm_clean, count(*) AS total_recalls, avg(risk_score) AS avg_risk_score,
  max(recall_initiation_date) AS latest_recall_date,
  count_if(classification = 'Class I') AS class_i_recalls,
  count_if(risk_tier IN ('Critical', 'High')) AS high_risk_recalls,
  count_if(regexp_matches(status, '(?i)ongoing')) AS ongoing_recalls
FROM scored GROUP BY recalling_firm_clean"""
register("company_risk", with_base(COMPANY_RISK_SQL))(lambda s, d: gold.company_risk(scored(s, d)))
register(
    "monthly_recall_trends",
    with_base("SELECT strftime(recall_initiation_date, '%Y-%m') AS recall_month, count(*) AS count FROM scored GROUP BY 1"),
)(lambda s, d: gold.monthly_recall_trends(scored(s, d)))
register(
    "monthly_order_trends",
    "SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS count FROM orders GROUP BY 1",
)(lambda s, d: read_driver_table(s, d, "orders")
  .groupBy(dates.recall_month("o_orderdate").alias("order_month")).agg(F.count(F.lit(1)).alias("count")))
register(
    "geographic_recall_summary",
    with_base(
        "SELECT state, country, count(*) AS total_recalls, avg(risk_score) AS avg_risk_score FROM scored GROUP BY state, country"
    ),
)(lambda s, d: gold.geographic_recall_summary(scored(s, d)))
register(
    "risk_tier_summary",
    with_base("SELECT risk_tier, count(*) AS count, avg(risk_score) AS avg_risk_score FROM scored GROUP BY risk_tier"),
)(lambda s, d: gold.risk_tier_summary(scored(s, d)))
register(
    "product_category_summary",
    with_base(
        "SELECT product_category, count(*) AS count, avg(risk_score) AS avg_risk_score FROM scored GROUP BY product_category"
    ),
)(lambda s, d: gold.product_category_summary(scored(s, d)))

DQ_SQL = """SELECT count(*) AS records_checked, count_if(recall_number IS NULL) AS missing_recall_number,
  count_if(classification IS NULL) AS missing_classification, count_if(reason_for_recall IS NULL) AS missing_reason,
  count_if(recalling_firm IS NULL) AS missing_recalling_firm FROM silver"""
register("dq_report", with_base(DQ_SQL))(lambda s, d: quality.dq_report(silver(s, d)))

register(
    "dq_report_documents",
    """SELECT count(*) AS records_checked, count_if(d.text IS NULL) AS missing_text,
  count_if(l.quality IS NULL) AS missing_quality, count_if(l.toxic IS NULL) AS missing_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)(lambda s, d: quality.missing_value_report(
    read_driver_table(s, d, "documents").select("doc_id", "text").join(
        read_driver_table(s, d, "labels"), "doc_id", "left"
    ),
    {"missing_text": "text", "missing_quality": "quality", "missing_toxic": "toxic"},
))

DQ_LONG_SQL = """SELECT * FROM (
  SELECT 0 AS check_order, 'Records checked' AS metric, CAST(count(*) AS VARCHAR) AS value, 'OK' AS status FROM scored
  UNION ALL SELECT 1, 'Missing recall number', CAST(count_if(recall_number IS NULL) AS VARCHAR),
    CASE WHEN count_if(recall_number IS NULL) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
  UNION ALL SELECT 2, 'Missing classification', CAST(count_if(classification IS NULL) AS VARCHAR),
    CASE WHEN count_if(classification IS NULL) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
  UNION ALL SELECT 3, 'Missing reason', CAST(count_if(reason_for_recall IS NULL) AS VARCHAR),
    CASE WHEN count_if(reason_for_recall IS NULL) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
  UNION ALL SELECT 4, 'Missing recalling firm', CAST(count_if(recalling_firm IS NULL) AS VARCHAR),
    CASE WHEN count_if(recalling_firm IS NULL) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
  UNION ALL SELECT 5, 'Missing report date', CAST(count_if(report_date IS NULL) AS VARCHAR),
    CASE WHEN count_if(report_date IS NULL) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
  UNION ALL SELECT 10, 'Duplicate recall numbers', CAST(count(recall_number) - count(DISTINCT recall_number) AS VARCHAR),
    CASE WHEN count(recall_number) - count(DISTINCT recall_number) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
  UNION ALL SELECT 11, 'Earliest report date', strftime(min(report_date), '%Y-%m-%d'), 'OK' FROM scored HAVING min(report_date) IS NOT NULL
  UNION ALL SELECT 12, 'Latest report date', strftime(max(report_date), '%Y-%m-%d'), 'OK' FROM scored HAVING max(report_date) IS NOT NULL
  UNION ALL SELECT 13, 'Missing or invalid risk scores',
    CAST(count_if(risk_score IS NULL OR NOT (risk_score BETWEEN 0 AND 100)) AS VARCHAR),
    CASE WHEN count_if(risk_score IS NULL OR NOT (risk_score BETWEEN 0 AND 100)) <> 0 THEN 'Review' ELSE 'OK' END FROM scored
) t WHERE (SELECT count(*) FROM scored) > 0"""
register("dq_report_long", with_base(DQ_LONG_SQL))(lambda s, d: quality.dq_report_long(scored(s, d)))

register(
    "duplicate_recall_numbers",
    with_base("SELECT count(recall_number) - count(DISTINCT recall_number) AS duplicate_recall_numbers FROM silver"),
)(lambda s, d: quality.duplicate_recall_numbers(silver(s, d)))
register(
    "duplicate_order_lines",
    """SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
  - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
       WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) t) AS duplicate_order_lines""",
)(lambda s, d: quality.duplicate_count(
    read_driver_table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], "duplicate_order_lines"
))
register(
    "invalid_scores",
    with_base("SELECT count_if(risk_score IS NULL OR NOT (risk_score BETWEEN 0 AND 100)) AS invalid_scores FROM scored"),
)(lambda s, d: quality.invalid_scores(scored(s, d)))

register(
    "kpis",
    with_base("""SELECT count(*) AS recalls, count_if(risk_tier = 'Critical') AS critical,
  count_if(status = 'Ongoing') AS ongoing, coalesce(CAST(round_even(avg(risk_score), 1) AS DOUBLE), 0.0) AS avg_risk,
  coalesce(strftime(max(report_date), '%Y-%m-%d'), 'N/A') AS latest_report FROM scored"""),
)(lambda s, d: explore.kpis(scored(s, d)))


def _top_sql(col: str, out: str) -> str:
    return (
        f"SELECT {col} AS {out}, count(*) AS occurrences FROM scored WHERE {col} IS NOT NULL "
        f"GROUP BY {col} ORDER BY occurrences DESC, {col} ASC LIMIT 1"
    )


register("top_reason", with_base(_top_sql("recall_reason_category", "top_reason")))(
    lambda s, d: explore.top_reason(scored(s, d))
)
register("top_product", with_base(_top_sql("product_category", "top_product")))(
    lambda s, d: explore.top_product(scored(s, d))
)
register(
    "top_risk_company",
    with_base(
        "SELECT recalling_firm_clean, avg(risk_score) AS avg_risk_score FROM scored WHERE recalling_firm_clean IS NOT NULL "
        "GROUP BY 1 ORDER BY avg_risk_score DESC, recalling_firm_clean ASC LIMIT 1"
    ),
)(lambda s, d: explore.top_risk_company(scored(s, d)))
register(
    "company_reason_counts",
    with_base(
        f"SELECT recall_reason_category AS reason, count(*) AS count FROM scored WHERE recalling_firm_clean = {q(FIRM)} GROUP BY 1"
    ),
)(lambda s, d: explore.company_reason_counts(scored(s, d), FIRM))

COMPANY_SUMMARY_SQL = """SELECT recalling_firm_clean, count(recall_number) AS total_recalls, avg(risk_score) AS avg_risk_score,
  count_if(risk_tier = 'Critical') AS critical_recalls FROM scored WHERE recalling_firm_clean IS NOT NULL GROUP BY 1"""
register(
    "company_top20",
    with_base(f"SELECT * FROM ({COMPANY_SUMMARY_SQL}) t ORDER BY avg_risk_score DESC, recalling_firm_clean ASC LIMIT 20"),
)(lambda s, d: explore.company_top20(scored(s, d)))
register(
    "severity_by_product",
    with_base("SELECT product_category, risk_tier, count(*) AS count FROM scored GROUP BY 1, 2"),
)(lambda s, d: explore.severity_by_product(scored(s, d)))

STATE_SUMMARY_SQL = """SELECT state, count(recall_number) AS total_recalls, avg(risk_score) AS avg_risk_score
FROM scored WHERE state IS NOT NULL GROUP BY state"""
register("state_summary", with_base(STATE_SUMMARY_SQL))(lambda s, d: explore.state_summary(scored(s, d)))
register(
    "risk_histogram",
    with_base("""SELECT bin, (bin - 1) * w AS bin_start, bin * w AS bin_end, risk_tier, count(*) AS count FROM (
  SELECT least(CAST(floor(25 * CAST(risk_score AS DOUBLE) / u) AS BIGINT) + 1, 25) AS bin, u / 25 AS w, risk_tier
  FROM scored, (SELECT CAST(greatest(100, max(risk_score)) AS DOUBLE) AS u FROM scored) m
  WHERE risk_score IS NOT NULL) t GROUP BY bin, w, risk_tier"""),
)(lambda s, d: explore.risk_histogram(scored(s, d)))
register(
    "filter_bounds",
    with_base(f"""SELECT coalesce(min(recall_initiation_date), DATE '{rules.DEFAULT_MIN_RECALL_DATE}') AS min_date,
  coalesce(max(recall_initiation_date), DATE '{AS_OF}') AS max_date,
  CAST(coalesce(greatest(100, max(risk_score)), 100) AS BIGINT) AS risk_max FROM scored"""),
)(lambda s, d: explore.filter_bounds(scored(s, d), as_of=AS_OF))


def _table_row_counts(s, d):
    sc = scored(s, d)
    company = gold.company_risk(sc)
    return explore.table_row_counts({
        "risk_scores": sc,
        "company_risk": company,
        "company_watchlist": gold.company_watchlist(company),
        "monthly_recall_trends": gold.monthly_recall_trends(sc),
        "product_category_summary": gold.product_category_summary(sc),
        "risk_tier_summary": gold.risk_tier_summary(sc),
    })


register(
    "table_row_counts",
    with_base("""SELECT 'risk_scores' AS "table", count(*) AS rows FROM scored
UNION ALL SELECT 'company_risk', count(DISTINCT coalesce(recalling_firm_clean, chr(0))) FROM scored
UNION ALL SELECT 'company_watchlist', count(DISTINCT coalesce(recalling_firm_clean, chr(0))) FROM scored
UNION ALL SELECT 'monthly_recall_trends', count(DISTINCT coalesce(strftime(recall_initiation_date, '%Y-%m'), chr(0))) FROM scored
UNION ALL SELECT 'product_category_summary', count(DISTINCT product_category) FROM scored
UNION ALL SELECT 'risk_tier_summary', count(DISTINCT risk_tier) FROM scored"""),
)(_table_row_counts)

# ============================================================== §2.F joins
register("company_risk_joined", with_base(COMPANY_RISK_SQL))(lambda s, d: gold.company_risk_joined(scored(s, d)))
register("region_join", with_base(f"SELECT *, {O.region_sql('state')} AS region_lookup FROM silver"))(
    lambda s, d: region_join(silver(s, d), out="region_lookup")
)

# ========================================= §2.G sorts, top-k, distinct lists
register("company_watchlist", with_base(COMPANY_RISK_SQL))(
    lambda s, d: gold.company_watchlist(gold.company_risk(scored(s, d)))
)
register(
    "open_recall_aging",
    with_base(f"SELECT {', '.join(rules.OPEN_AGING_COLUMNS)} FROM scored WHERE regexp_matches(status, '(?i)ongoing')"),
)(lambda s, d: gold.open_recall_aging(scored(s, d), ordered=True))
register("recall_explorer", with_base(f"SELECT {', '.join(rules.EXPLORER_COLUMNS)} FROM scored"))(
    lambda s, d: explore.recall_explorer(scored(s, d))
)
register(
    "company_risk_timeline",
    with_base(
        "SELECT recall_number, recall_initiation_date, risk_score, risk_tier FROM scored "
        f"WHERE recalling_firm_clean = {q(FIRM)}"
    ),
)(lambda s, d: explore.company_risk_timeline(scored(s, d), FIRM))
register(
    "top_states_by_count",
    with_base(f"SELECT * FROM ({STATE_SUMMARY_SQL}) t ORDER BY total_recalls DESC, state ASC LIMIT 20"),
)(lambda s, d: explore.top_states_by_count(scored(s, d)))
register(
    "top_states_by_risk",
    with_base(f"SELECT * FROM ({STATE_SUMMARY_SQL}) t ORDER BY avg_risk_score DESC, state ASC LIMIT 20"),
)(lambda s, d: explore.top_states_by_risk(scored(s, d)))
register(
    "sorted_month_trend",
    with_base("SELECT strftime(recall_initiation_date, '%Y-%m') AS recall_month, count(*) AS count FROM scored GROUP BY 1"),
)(lambda s, d: explore.sorted_month_trend(gold.monthly_recall_trends(scored(s, d))))
register(
    "reasons_by_count",
    with_base("SELECT recall_reason_category, count(*) AS count FROM scored GROUP BY recall_reason_category"),
)(lambda s, d: explore.reasons_by_count(gold.recall_reason_summary(scored(s, d))))
register(
    "products_by_count",
    with_base(
        "SELECT product_category, count(*) AS count, avg(risk_score) AS avg_risk_score FROM scored GROUP BY product_category"
    ),
)(lambda s, d: explore.products_by_count(gold.product_category_summary(scored(s, d))))
register(
    "option_list",
    with_base(
        "SELECT 'All' AS option UNION ALL SELECT DISTINCT CAST(state AS VARCHAR) FROM scored WHERE state IS NOT NULL AND state <> ''"
    ),
)(lambda s, d: explore.option_list(scored(s, d), "state"))
register(
    "company_list",
    with_base("SELECT DISTINCT recalling_firm_clean FROM scored WHERE recalling_firm_clean IS NOT NULL"),
)(lambda s, d: explore.company_list(scored(s, d)))


# ================================================ §2.A sources and sinks
# These write with Spark (under the shared checkpoint folder) and read back
# what was written; the oracle is SQL over the same derived records.
from ..schemas import SCORED_COLUMNS, SERVING_TABLES, SILVER_COLUMNS  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import bronze as B  # noqa: E402
from ..sources import serving as S  # noqa: E402
from ..sources import tables as T  # noqa: E402

SOURCE = "derived:orders+customer"
BRONZE_META = {"source": SOURCE, "fetched_at": "2001-07-01T00:00:00", "requested_limit": None, "warning": None}
FIXED_NOW = "2001-07-01 08:30:00"
WINDOW_A = ("1992-01-01", "1997-12-31")
WINDOW_B = ("1997-07-01", "2002-12-31")
SOURCE_LIMIT = 1000


def _bronze(s, d, records_df=None):
    path = scratch_path(s, "bronze")
    B.write_bronze(records(s, d) if records_df is None else records_df, path, BRONZE_META)
    return path


register("read_bronze", with_base("SELECT * FROM fx"))(lambda s, d: B.read_bronze(s, _bronze(s, d)))


def _archives(s, d):
    path = scratch_path(s, "archives")
    B.write_bronze_archives(records(s, d), path, BRONZE_META).count()
    return B.read_bronze_archives(s, path)


register("read_bronze_archives", with_base("SELECT * FROM fx"))(_archives)

register(
    "bronze_meta",
    with_base(f"SELECT {q(SOURCE)} AS source, count(*) AS records_fetched FROM fx"),
)(lambda s, d: B.bronze_meta(s, _bronze(s, d)).groupBy("source").agg(F.sum("records_fetched").alias("records_fetched")))


# Documents of three kinds in one landing: JSON Lines, one document over many
# lines per file, and documents that were cut off on the way.
_KIND = "CAST(event_id AS INTEGER) % 10"


def _mixed_landing(s, d) -> list[str]:
    base = scratch_path(s, "mixed")
    r = records(s, d).withColumn("_kind", F.expr(_KIND))
    B.write_bronze(r.filter("_kind < 8").drop("_kind"), f"{base}/lines", BRONZE_META)
    record = F.struct(*O.RECORD_FIELDS)
    pretty = r.filter("_kind = 8").groupBy("event_id").agg(F.collect_list(record).alias("results")).withColumn(
        "meta", F.struct(F.lit(SOURCE).alias("source"), F.size("results").alias("records_fetched"))
    )
    pretty.select("event_id", F.to_json(F.struct("meta", "results"), {"pretty": "true"}).alias("value")).write.partitionBy(
        "event_id"
    ).text(f"{base}/pretty")
    whole = F.to_json(F.struct(F.array(record).alias("results")))
    r.filter("_kind = 9").select(F.substring(whole, F.lit(1), F.length(whole) - 3).alias("value")).write.text(f"{base}/cut")
    return [f"{base}/lines", f"{base}/pretty/*", f"{base}/cut"]


register("read_bronze_quarantine", with_base(f"SELECT * FROM fx WHERE {_KIND} < 9"))(
    lambda s, d: B.land_bronze(s, _mixed_landing(s, d), on_loss="warn").records
)


def _bronze_rejects(s, d):
    found = B.land_bronze(s, _mixed_landing(s, d), on_loss="warn")
    return found.rejects.groupBy("reason").agg(F.count("*").alias("rejects"), F.count_distinct("file").cast("boolean").alias("named")).select(
        "reason", "rejects", "named", F.lit(found.held).cast("long").alias("held"), F.lit(found.announced).cast("long").alias("announced")
    )


register(
    "bronze_rejects",
    with_base(f"""SELECT 'no whole JSON document' AS reason, count(*) FILTER ({_KIND} = 9) AS rejects, true AS named,
  count(*) FILTER ({_KIND} < 9) AS held, count(*) FILTER ({_KIND} < 9) AS announced FROM fx"""),
)(_bronze_rejects)


def _union_batches(s, d):
    r = records(s, d)
    first = r.filter(F.col("report_date") < "19980101")
    second = r.filter(F.col("report_date") >= "19980101").drop("city")
    return B.union_batches(first, second)


register(
    "union_batches",
    with_base(
        "SELECT * FROM fx WHERE report_date < '19980101' "
        "UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS city) FROM fx WHERE report_date >= '19980101'"
    ),
)(_union_batches)

_WIN_DATE = O.compact_date_sql("report_date")
register(
    "source_window",
    with_base(
        f"SELECT * FROM fx WHERE {_WIN_DATE} BETWEEN DATE '{REPORT_START}' AND DATE '{REPORT_END}' "
        f"ORDER BY {_WIN_DATE} ASC NULLS LAST, "
        + ", ".join(f"{c} ASC NULLS LAST" for c in O.RECORD_FIELDS)
        + f" LIMIT {SOURCE_LIMIT}"
    ),
)(lambda s, d: B.source_window(records(s, d), "report_date", REPORT_START, REPORT_END.replace("-", ""), SOURCE_LIMIT))

register("read_table", "SELECT * FROM customer")(lambda s, d: T.read_table(s, f"{d.rstrip('/')}/customer.parquet"))


def _write_table(s, d):
    path = scratch_path(s, "silver")
    T.write_table(silver(s, d), path)
    return T.read_table(s, path)


register("write_table", with_base("SELECT * FROM silver"))(_write_table)


def _first_non_empty(s, d):
    missing = scratch_path(s, "missing")
    return T.first_non_empty(lambda: T.read_table(s, missing), lambda: scored(s, d))


register("first_non_empty", with_base("SELECT * FROM scored"))(_first_non_empty)


def _staged_overwrite(s, d):
    path = scratch_path(s, "silver")
    T.write_table(silver(s, d), path)
    T.staged_overwrite(s, path, lambda df: explore.filter_report_date(df, REPORT_START, REPORT_END))
    return T.read_table(s, path)


register(
    "staged_overwrite",
    with_base(f"SELECT * FROM silver WHERE report_date >= DATE '{REPORT_START}' AND report_date <= DATE '{REPORT_END}'"),
)(_staged_overwrite)


def _read_version(s, d):
    """The version that a rewrite has replaced, read after it."""
    path = scratch_path(s, "silver")
    T.committed_write(silver(s, d), path)
    T.staged_overwrite(s, path, lambda df: explore.filter_report_date(df, REPORT_START, REPORT_END))
    return T.read_table(s, path, version=T.table_versions(s, path)[0]["number"])


register("read_table_version", with_base("SELECT * FROM silver"))(_read_version)


def _window_scored(s, d, window):
    return score_recalls(explore.filter_report_date(silver(s, d), *window))


_WINDOW_CTES = (
    f"silver_a AS (SELECT * FROM silver WHERE report_date BETWEEN DATE '{WINDOW_A[0]}' AND DATE '{WINDOW_A[1]}'),\n"
    f"silver_b AS (SELECT * FROM silver WHERE report_date BETWEEN DATE '{WINDOW_B[0]}' AND DATE '{WINDOW_B[1]}'),\n"
    f"scored_a AS ({O.scored_select_sql('silver_a')}),\n"
    f"scored_b AS ({O.scored_select_sql('silver_b')}),\n"
    f"load_a AS ({O.dedupe_sql('(' + O.fill_keys_sql('scored_a', ['recall_number']) + ') fa', ['recall_number'], SCORED_COLUMNS)}),\n"
    f"load_b AS ({O.dedupe_sql('(' + O.fill_keys_sql('scored_b', ['recall_number']) + ') fb', ['recall_number'], SCORED_COLUMNS)})"
)


def _keyed_upsert(s, d):
    path = scratch_path(s, "recalls")
    S.upsert_table(s, path, _window_scored(s, d, WINDOW_A), ["recall_number"], FIXED_NOW)
    S.upsert_table(s, path, _window_scored(s, d, WINDOW_B), ["recall_number"], FIXED_NOW)
    return T.read_table(s, path).drop("updated_at")


def _keyed_upsert_partitioned(s, d):
    path = scratch_path(s, "recalls")
    part = S.partition_value("recalls")
    S.upsert_partitioned(s, path, _window_scored(s, d, WINDOW_A), ["recall_number"], "report_month", part, FIXED_NOW)
    S.upsert_partitioned(s, path, _window_scored(s, d, WINDOW_B), ["recall_number"], "report_month", part, FIXED_NOW)
    return T.read_table(s, path).drop("updated_at", "report_month")


register(
    "keyed_upsert_partitioned",
    with_base(
        "SELECT * FROM load_a WHERE recall_number NOT IN (SELECT recall_number FROM load_b) UNION ALL SELECT * FROM load_b",
        _WINDOW_CTES,
    ),
)(_keyed_upsert_partitioned)

register(
    "keyed_upsert",
    with_base(
        "SELECT * FROM load_a WHERE recall_number NOT IN (SELECT recall_number FROM load_b) UNION ALL SELECT * FROM load_b",
        _WINDOW_CTES,
    ),
)(_keyed_upsert)


def _keyed_upsert_bucketed(s, d):
    """Tables kept in hash buckets: only the second load's buckets are rewritten."""
    path = scratch_path(s, "recalls")
    S.upsert_table(s, path, _window_scored(s, d, WINDOW_A), ["recall_number"], FIXED_NOW, buckets=32)
    S.upsert_table(s, path, _window_scored(s, d, WINDOW_B), ["recall_number"], FIXED_NOW)
    return T.read_table(s, path).drop("updated_at")


register("keyed_upsert_bucketed", ORACLE["keyed_upsert"])(_keyed_upsert_bucketed)


def _replace_load(s, d):
    path = scratch_path(s, "recalls")
    S.replace_load(s, path, _window_scored(s, d, WINDOW_A), ["recall_number"], FIXED_NOW)
    S.replace_load(s, path, _window_scored(s, d, WINDOW_B), ["recall_number"], FIXED_NOW)
    return T.read_table(s, path).drop("updated_at")


register("replace_load", with_base("SELECT * FROM load_b", _WINDOW_CTES))(_replace_load)


def _serving_sources(s, d):
    # Written once, as in a batch run: the loads read the table, instead of each
    # deriving, joining and scoring the records again at the same time.
    path = scratch_path(s, "scored")
    T.write_table(scored(s, d), path)
    sc = T.read_table(s, path)
    g = gold.gold_tables(sc)
    return {name: (sc if spec["gold"] == "scored" else g[spec["gold"]]) for name, spec in SERVING_TABLES.items()}


register(
    "load_tables",
    with_base("""SELECT 'recalls' AS "table", count(*) AS loaded FROM scored
UNION ALL SELECT 'company_risk', count(DISTINCT coalesce(recalling_firm_clean, chr(0))) FROM scored
UNION ALL SELECT 'recall_reason_summary', count(DISTINCT recall_reason_category) FROM scored
UNION ALL SELECT 'monthly_recall_trends', count(DISTINCT coalesce(strftime(recall_initiation_date, '%Y-%m'), chr(0))) FROM scored
UNION ALL SELECT 'geographic_recall_summary', count(*) FROM (SELECT DISTINCT state, country FROM scored) g
UNION ALL SELECT 'product_category_summary', count(DISTINCT product_category) FROM scored
UNION ALL SELECT 'risk_tier_summary', count(DISTINCT risk_tier) FROM scored
UNION ALL SELECT 'open_recall_aging', count_if(regexp_matches(status, '(?i)ongoing')) FROM scored"""),
)(lambda s, d: S.load_tables(s, _serving_sources(s, d), scratch_path(s, "serving"), now=FIXED_NOW))

register(
    "to_serving_rows",
    with_base(f"""SELECT recalling_firm_clean, total_recalls, avg_risk_score,
  strftime(latest_recall_date, '%Y-%m-%d') AS latest_recall_date, class_i_recalls, high_risk_recalls, ongoing_recalls
FROM ({COMPANY_RISK_SQL}) c"""),
)(lambda s, d: S.to_serving_rows(gold.company_risk(scored(s, d)), FIXED_NOW).drop("updated_at"))

_SERVING_CASTS = ", ".join(
    f"CAST({c} AS {'INTEGER' if t.simpleString() == 'int' else t.simpleString().upper().replace('STRING', 'VARCHAR')}) AS {c}"
    for c, t in SERVING_TABLES["recalls"]["columns"].items()
)
register("enforce_serving_schema", with_base(f"SELECT {_SERVING_CASTS} FROM scored"))(
    lambda s, d: S.enforce_serving_schema(scored(s, d), "recalls")
)
register(
    "serving_key_report",
    with_base("""SELECT 'recalls' AS "table", count(*) AS rows, count_if(recall_number IS NULL) AS null_keys,
  count_if(recall_number IS NOT NULL) - count(DISTINCT recall_number) AS duplicate_keys FROM scored"""),
)(lambda s, d: S.key_report(scored(s, d), "recalls"))
register(
    "normalize_dates",
    with_base(f"SELECT {', '.join(rules.OPEN_AGING_COLUMNS)} FROM scored WHERE regexp_matches(status, '(?i)ongoing')"),
)(lambda s, d: S.normalize_dates(
    S.to_serving_rows(gold.open_recall_aging(scored(s, d)), FIXED_NOW).drop("updated_at")
))
register(
    "backfill_columns",
    with_base("SELECT * REPLACE ('Unknown' AS product_category, 'Unknown' AS distribution_scope) FROM scored"),
)(lambda s, d: S.backfill_columns(scored(s, d).drop("product_category", "distribution_scope")))


def _run_log(s, d):
    from .stages import run_stages

    out = scratch_path(s, "run")
    landed = scratch_path(s, "bronze")
    B.write_bronze(records(s, d), landed, BRONZE_META | {"warning": "partial export"})
    run_stages(s, landed, out, load=True, now=FIXED_NOW, tables=["recalls"])
    empty = scratch_path(s, "bronze-empty")
    B.write_bronze(records(s, d).filter(F.lit(False)), empty, BRONZE_META)
    run_stages(s, empty, out, load=True, now=FIXED_NOW)
    return T.read_table(s, f"{out}/pipeline_runs").select(
        "source", "records_fetched", "records_loaded", "status", "warning", "error"
    )


register(
    "append_run_log",
    with_base(f"""SELECT {q(SOURCE)} AS source, count(*) AS records_fetched, count(*) AS records_loaded, 'success' AS status,
  'partial export' AS warning, CAST(NULL AS VARCHAR) AS error FROM fx
UNION ALL SELECT {q(SOURCE)}, 0, 0, 'success', 'No records found for requested date window.', CAST(NULL AS VARCHAR)"""),
)(_run_log)


# The contents of each serving table after a load: declared types, filled
# keys, one row per key.
_SERVED_SOURCE = {
    "recalls": "SELECT * FROM scored",
    "company_risk": COMPANY_RISK_SQL,
    "recall_reason_summary": "SELECT recall_reason_category, count(*) AS count FROM scored GROUP BY 1",
    "monthly_recall_trends":
        "SELECT strftime(recall_initiation_date, '%Y-%m') AS recall_month, count(*) AS count FROM scored GROUP BY 1",
    "geographic_recall_summary":
        "SELECT state, country, count(*) AS total_recalls, avg(risk_score) AS avg_risk_score FROM scored GROUP BY 1, 2",
    "product_category_summary":
        "SELECT product_category, count(*) AS count, avg(risk_score) AS avg_risk_score FROM scored GROUP BY 1",
    "risk_tier_summary": "SELECT risk_tier, count(*) AS count, avg(risk_score) AS avg_risk_score FROM scored GROUP BY 1",
    "open_recall_aging": "SELECT * FROM scored WHERE regexp_matches(status, '(?i)ongoing')",
}


def _served_sql(name: str) -> str:
    spec = SERVING_TABLES[name]
    kinds = {"int": "INTEGER", "string": "VARCHAR"}
    casts = ", ".join(
        f"CAST({c} AS {kinds.get(t.simpleString(), t.simpleString().upper())}) AS {c}" for c, t in spec["columns"].items()
    )
    typed = f"(SELECT {casts} FROM ({_SERVED_SOURCE[name]}) src) typed"
    return with_base(O.dedupe_sql(f"({O.fill_keys_sql(typed, spec['keys'])}) filled", spec["keys"], list(spec["columns"])))


def _load_one(name: str):
    def run(s, d):
        out = scratch_path(s, "serving")
        S.load_tables(s, _serving_sources(s, d), out, tables=[name], now=FIXED_NOW)
        return T.read_table(s, f"{out}/{name}").drop("updated_at", "report_month")

    return run


for _name in SERVING_TABLES:
    register(f"load_table_{_name}", _served_sql(_name))(_load_one(_name))

# ===================================================== §2.H composite runs


def _bronze_to_silver(s, d):
    from .stages import bronze_to_silver

    return bronze_to_silver(s, _bronze(s, d), scratch_path(s, "silver"))


register("bronze_to_silver", with_base("SELECT * FROM silver"))(_bronze_to_silver)


def _build_gold(s, d):
    from .stages import build_gold

    path = scratch_path(s, "scored")
    T.write_table(scored(s, d), path)
    paths = build_gold(s, path, scratch_path(s, "gold"))
    return explore.table_row_counts({name: T.read_table(s, p) for name, p in paths.items()})


register(
    "build_gold",
    with_base("""SELECT 'recall_overview' AS "table", count(DISTINCT coalesce(classification, chr(0))) AS rows FROM scored
UNION ALL SELECT 'recall_reason_summary', count(DISTINCT recall_reason_category) FROM scored
UNION ALL SELECT 'company_risk', count(DISTINCT coalesce(recalling_firm_clean, chr(0))) FROM scored
UNION ALL SELECT 'company_watchlist', count(DISTINCT coalesce(recalling_firm_clean, chr(0))) FROM scored
UNION ALL SELECT 'monthly_recall_trends', count(DISTINCT coalesce(strftime(recall_initiation_date, '%Y-%m'), chr(0))) FROM scored
UNION ALL SELECT 'geographic_recall_summary', count(*) FROM (SELECT DISTINCT state, country FROM scored) g
UNION ALL SELECT 'risk_tier_summary', count(DISTINCT risk_tier) FROM scored
UNION ALL SELECT 'product_category_summary', count(DISTINCT product_category) FROM scored
UNION ALL SELECT 'open_recall_aging', count_if(regexp_matches(status, '(?i)ongoing')) FROM scored"""),
)(_build_gold)


def _run_all(s, d):
    from .stages import run_stages

    out = scratch_path(s, "run")
    run_stages(s, _bronze(s, d), out, report_start=WINDOW_A[0], report_end=WINDOW_A[1], load=True, now=FIXED_NOW)
    return T.read_table(s, f"{out}/serving/recalls").drop("updated_at", "report_month")


# The served table has the declared column types.
_LOAD_A_TYPED = with_base(f"SELECT {_SERVING_CASTS} FROM load_a", _WINDOW_CTES)
register("run_all_stages", _LOAD_A_TYPED)(_run_all)
register("run_pipeline", _LOAD_A_TYPED)(_run_all)


def _run_commit(s, d):
    """A second load that dies before its run is committed changes nothing."""
    out = scratch_path(s, "store")
    load = lambda window, run=None: S.load_tables(
        s, {"recalls": _window_scored(s, d, window)}, out, ["recalls"], now=FIXED_NOW, run=run
    )
    load(WINDOW_A)
    load(WINDOW_B, T.Run(s, out))  # never committed
    return S.read_store(s, out)["recalls"].drop("updated_at", "report_month")


register("run_commit", _LOAD_A_TYPED)(_run_commit)

EMPTY_WINDOW = "2030-01-01"


def _run_empty_window(s, d):
    """A run whose report window holds no record: its row in the log, and
    how many rows its nine summaries and eight served tables hold."""
    from .stages import run_stages

    out = scratch_path(s, "run")
    res = run_stages(s, _bronze(s, d), out, report_start=EMPTY_WINDOW, load=True, now=FIXED_NOW)
    again = run_stages(s, _bronze(s, d), scratch_path(s, "run"), report_start=EMPTY_WINDOW)
    tables = [T.read_table(s, p) for r in (res, again) for p in r["gold"].values()]
    held = [df.select(F.lit(1)) for df in [*tables, *S.read_store(s, f"{out}/serving").values()]]
    rows = held[0]
    for df in held[1:]:
        rows = rows.unionAll(df)
    log = T.read_table(s, f"{out}/pipeline_runs").select("source", "records_fetched", "records_loaded", "status", "warning", "error")
    return log.crossJoin(rows.agg(F.count("*").alias("rows"))).withColumn("tables", F.lit(len(held)))  # one row each


register(
    "run_pipeline_empty_window",
    with_base(f"""SELECT {q(SOURCE)} AS source, count(*) AS records_fetched, CAST(0 AS BIGINT) AS records_loaded,
  'success' AS status, 'No records found for requested date window.' AS warning, CAST(NULL AS VARCHAR) AS error,
  CAST(0 AS BIGINT) AS rows, 26 AS "tables" FROM fx"""),
)(_run_empty_window)


def _run_without_meta(s, d):
    """Documents without metadata announce nothing and are read in full."""
    from .stages import run_stages

    landed, out = scratch_path(s, "bronze"), scratch_path(s, "run")
    document = F.struct(F.array(F.struct(*O.RECORD_FIELDS)).alias("results"))
    records(s, d).select(F.to_json(document).alias("value")).write.text(landed)
    run_stages(
        s, landed, out, report_start=WINDOW_A[0], report_end=WINDOW_A[1], load=True, now=FIXED_NOW, tables=["recalls"]
    )
    return T.read_table(s, f"{out}/serving/recalls").drop("updated_at", "report_month")


register("run_pipeline_without_meta", _LOAD_A_TYPED)(_run_without_meta)


def _run_archives(s, d):
    """The batch run over a folder of ZIP exports."""
    from .stages import run_stages

    landed, out = scratch_path(s, "archives"), scratch_path(s, "run")
    B.write_bronze_archives(records(s, d), landed, BRONZE_META).count()
    run_stages(
        s, landed, out, report_start=WINDOW_A[0], report_end=WINDOW_A[1], load=True, now=FIXED_NOW, tables=["recalls"],
        archives=True,
    )
    return T.read_table(s, f"{out}/serving/recalls").drop("updated_at", "report_month")


register("run_pipeline_archives", _LOAD_A_TYPED)(_run_archives)


def _refresh_all(s, d):
    from .stages import refresh_stages

    res = refresh_stages(s, _bronze(s, d), scratch_path(s, "run"))
    return T.read_table(s, res["scored_path"])


register("refresh_all_stages", with_base("SELECT * FROM scored"))(_refresh_all)
register("refresh_pipeline", with_base("SELECT * FROM scored"))(_refresh_all)

# ======================================================= §2.I streaming
CORRECTION_DAYS = 30


def _corrections(r):
    """Second drop: every still-open record is re-reported later, closed."""
    later = F.date_format(F.date_add(F.try_to_date("report_date", "yyyyMMdd"), CORRECTION_DAYS), "yyyyMMdd")
    return r.filter(F.col("status") == "ONGOING").select(
        *[
            later.alias(c) if c in ("report_date", "termination_date")
            else F.lit("Terminated").alias(c) if c == "status"
            else F.col(c)
            for c in O.RECORD_FIELDS
        ]
    )


def _incremental(s, d):
    from ..streaming.incremental import incremental_refresh, served_table

    r = records(s, d)
    land = scratch_path(s, "landing")
    B.write_bronze(r, f"{land}/drop-1", BRONZE_META)
    B.write_bronze(_corrections(r), f"{land}/drop-2", BRONZE_META)
    served = scratch_path(s, "served")
    incremental_refresh(s, f"{land}/*", served, scratch_path(s, "stream-ckpt"), history=True)  # exact counts
    return served_table(s, served)


_LATER = f"strftime(CAST(try_strptime(report_date, '%Y%m%d') AS DATE) + INTERVAL {CORRECTION_DAYS} DAY, '%Y%m%d')"
_INCR_CTES = (
    "fx2 AS (SELECT * FROM fx UNION ALL SELECT * REPLACE ('Terminated' AS status, "
    f"{_LATER} AS report_date, {_LATER} AS termination_date) FROM fx WHERE status = 'ONGOING'),\n"
    f"silver2 AS ({O.silver_select_sql('fx2')}),\n"
    f"silver2d AS ({O.dedupe_sql('(' + O.fill_keys_sql('silver2', ['recall_number']) + ') f2', ['recall_number'], SILVER_COLUMNS)}),\n"
    f"scored2 AS ({O.scored_select_sql('silver2d')})"
)
register("incremental_refresh", with_base("SELECT * FROM scored2", _INCR_CTES))(_incremental)


def _firm_counts(s, d):
    """The records per firm that two drops leave, maintained by deltas."""
    from ..streaming.incremental import counts_path, incremental_refresh

    land, served, ckpt = scratch_path(s, "landing"), scratch_path(s, "served"), scratch_path(s, "stream-ckpt")
    r = records(s, d)
    for k, drop in enumerate((r, _corrections(r))):
        B.write_bronze(drop, f"{land}/drop-{k}", BRONZE_META)
        incremental_refresh(s, f"{land}/*", served, ckpt, history=True)
    return T.read_table(s, counts_path(served))


def _maintained(name: str):
    def run(s, d):
        """A gold table kept up to date over two drops, never rebuilt."""
        from ..streaming.incremental import incremental_refresh, maintained_gold

        land, served, ckpt = scratch_path(s, "landing"), scratch_path(s, "served"), scratch_path(s, "stream-ckpt")
        r = records(s, d)
        for k, drop in enumerate((r, _corrections(r))):
            B.write_bronze(drop, f"{land}/drop-{k}", BRONZE_META)
            incremental_refresh(s, f"{land}/*", served, ckpt, history=True, gold=True)
        return maintained_gold(s, served)[name]

    return run


# ============================================ single-pass gold summaries
register("summary_sets_company_risk", with_base(COMPANY_RISK_SQL))(
    lambda s, d: gold.summary_from_sets(gold.summary_sets(scored(s, d)), "company_risk")
)
register(
    "summary_sets_geographic",
    with_base(
        "SELECT state, country, count(*) AS total_recalls, avg(risk_score) AS avg_risk_score FROM scored GROUP BY state, country"
    ),
)(lambda s, d: gold.summary_from_sets(gold.summary_sets(scored(s, d)), "geographic_recall_summary"))
register(
    "summary_sets_monthly",
    with_base("SELECT strftime(recall_initiation_date, '%Y-%m') AS recall_month, count(*) AS count FROM scored GROUP BY 1"),
)(lambda s, d: gold.summary_from_sets(gold.summary_sets(scored(s, d)), "monthly_recall_trends"))


def _incremental_batch_relative(s, d):
    """Two drops processed as two runs (two micro-batches), batch-relative
    scores: rows of the first drop that the second does not replace keep
    the scores computed within the first drop."""
    from ..streaming.incremental import incremental_refresh, served_table

    r = records(s, d)
    land, served, ckpt = scratch_path(s, "landing"), scratch_path(s, "served"), scratch_path(s, "stream-ckpt")
    B.write_bronze(r, f"{land}/drop-1", BRONZE_META)
    incremental_refresh(s, f"{land}/*", served, ckpt, history=False)
    B.write_bronze(_corrections(r), f"{land}/drop-2", BRONZE_META)
    incremental_refresh(s, f"{land}/*", served, ckpt, history=False)
    return served_table(s, served)


_CORRECTIONS_CTE = (
    "fxc AS (SELECT * REPLACE ('Terminated' AS status, "
    f"{_LATER} AS report_date, {_LATER} AS termination_date) FROM fx WHERE status = 'ONGOING')"
)


def _drop_ctes(n: int, source: str, window: tuple[str, str] | None = None) -> str:
    """Every row of the drop's window is scored, then reduced to one per key."""
    silver_sql = O.silver_select_sql(source)
    if window:
        silver_sql = f"SELECT * FROM ({silver_sql}) w WHERE report_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}'"
    filled = O.fill_keys_sql("(" + O.scored_select_sql(f"silver_d{n}") + f") s{n}", ["recall_number"])
    return (
        f"silver_d{n} AS ({silver_sql}),\n"
        f"scored_d{n} AS ({O.dedupe_sql('(' + filled + f') f{n}', ['recall_number'], SCORED_COLUMNS)})"
    )


_BATCH_RELATIVE_CTES = ",\n".join([_CORRECTIONS_CTE, _drop_ctes(1, "fx"), _drop_ctes(2, "fxc")])
register(
    "incremental_refresh_batch_relative",
    with_base(
        "SELECT * FROM scored_d1 WHERE recall_number NOT IN (SELECT recall_number FROM scored_d2) "
        "UNION ALL SELECT * FROM scored_d2",
        _BATCH_RELATIVE_CTES,
    ),
)(_incremental_batch_relative)


# A daily run keeps a rolling window of report dates: records outside it stay
# out, late and corrected ones inside replace what an earlier run served.
LOOKBACK = 700
LOOKBACK_DAYS_AS_OF = ("1997-12-31", "1998-06-30")


def _incremental_lookback(s, d):
    from ..streaming.incremental import incremental_refresh, served_table

    r = records(s, d)
    land, served, ckpt = scratch_path(s, "landing"), scratch_path(s, "served"), scratch_path(s, "stream-ckpt")
    for k, (drop, as_of) in enumerate(zip((r, _corrections(r)), LOOKBACK_DAYS_AS_OF)):
        B.write_bronze(drop, f"{land}/drop-{k}", BRONZE_META)
        incremental_refresh(s, f"{land}/*", served, ckpt, lookback_days=LOOKBACK, as_of=as_of)
    return served_table(s, served)


def _lookback_window(as_of: str) -> tuple[str, str]:
    import datetime as dt

    return (dt.date.fromisoformat(as_of) - dt.timedelta(days=LOOKBACK)).isoformat(), as_of


register(
    "incremental_refresh_lookback",
    with_base(
        "SELECT * FROM scored_d1 WHERE recall_number NOT IN (SELECT recall_number FROM scored_d2) "
        "UNION ALL SELECT * FROM scored_d2",
        ",\n".join([
            _CORRECTIONS_CTE,
            _drop_ctes(1, "fx", _lookback_window(LOOKBACK_DAYS_AS_OF[0])),
            _drop_ctes(2, "fxc", _lookback_window(LOOKBACK_DAYS_AS_OF[1])),
        ]),
    ),
)(_incremental_lookback)


# The same drops, but as two runs: what the second holds replaces what the
# first left, whatever its report date.
def _kept_of(n: int, source: str) -> str:
    filled = O.fill_keys_sql(f"({O.silver_select_sql(source)}) s{n}", ["recall_number"])
    return f"kept_{n} AS ({O.dedupe_sql(f'({filled}) f{n}', ['recall_number'], SILVER_COLUMNS)})"


_SEQUENCE_CTES = ",\n".join([
    _CORRECTIONS_CTE, _kept_of(1, "fx"), _kept_of(2, "fxc"),
    "silver2d AS (SELECT * FROM kept_1 WHERE recall_number NOT IN (SELECT recall_number FROM kept_2) "
    "UNION ALL SELECT * FROM kept_2)",
    f"scored2 AS ({O.scored_select_sql('silver2d')})",
])
register(
    "incremental_firm_counts",
    with_base("SELECT recalling_firm_clean, count(*) AS n FROM silver2d GROUP BY 1", _SEQUENCE_CTES),
)(_firm_counts)
register(
    "build_gold_incremental_company_risk",
    with_base(COMPANY_RISK_SQL.replace("scored", "scored2"), _SEQUENCE_CTES),
)(_maintained("company_risk"))
register(
    "build_gold_incremental_geographic",
    with_base(
        "SELECT state, country, count(*) AS total_recalls, avg(risk_score) AS avg_risk_score FROM scored2 GROUP BY state, country",
        _SEQUENCE_CTES,
    ),
)(_maintained("geographic_recall_summary"))

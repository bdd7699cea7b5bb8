"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The views ``orders``/``customer``/... are registered by the checker. Every
oracle query starts from the same CTE chain: the derived recall records
(``fx``), the silver projection (``silver``) and the scored table
(``scored``). Rule CASE expressions are generated from the fixed rule
tables in :mod:`noticeflow.functions.rules`.
"""

from __future__ import annotations

from ..functions import rules
from ..schemas import RECORD_FIELDS, SILVER_COLUMNS

FIXTURE_SQL = """
SELECT
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'F-' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') END AS recall_number,
  CAST(o_orderkey % 500 AS VARCHAR) AS event_id,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN 'Pending'
       WHEN o_orderstatus = 'F' THEN 'Terminated' WHEN o_orderstatus = 'O' THEN 'ONGOING' ELSE 'Completed' END AS status,
  CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Class I'
       WHEN o_orderpriority = '2-HIGH' THEN 'class ii' WHEN o_orderpriority = '3-MEDIUM' THEN 'CLASS  III'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Class II' ELSE 'Not Yet Classified' END AS classification,
  'Food' AS product_type,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE c_name || CASE WHEN c_custkey % 2 = 0 THEN ', Inc.' ELSE ' & Co' END END AS recalling_firm,
  CASE o_orderkey % 12 WHEN 0 THEN 'Cheddar Cheese block' WHEN 1 THEN 'Ground BEEF patties' WHEN 2 THEN 'Smoked salmon'
       WHEN 3 THEN 'Spinach salad' WHEN 4 THEN 'Infant cereal' WHEN 5 THEN 'Vitamin C 500' WHEN 6 THEN 'Oat cookie pack'
       WHEN 7 THEN 'Sparkling water' WHEN 8 THEN 'Frozen pizza' WHEN 9 THEN 'Ice Cream bar' WHEN 10 THEN 'Rice crackers' END AS product_description,
  CASE o_orderkey % 7 WHEN 0 THEN 'Potential Listeria monocytogenes' WHEN 1 THEN 'Undeclared allergen: milk' WHEN 2 THEN 'Mislabeled package'
       WHEN 3 THEN 'Foreign material: metal fragments' WHEN 4 THEN 'E. coli O157:H7' WHEN 5 THEN 'Quality complaint' END AS reason_for_recall,
  CASE (o_orderkey + c_custkey) % 6 WHEN 0 THEN 'NATIONWIDE' WHEN 1 THEN 'Sold nationally, incl. Canada' WHEN 2 THEN 'AZ, CA, NV'
       WHEN 3 THEN 'Exported to Mexico' WHEN 4 THEN 'Local stores' END AS distribution_pattern,
  CASE c_nationkey % 9 WHEN 0 THEN 'AZ' WHEN 1 THEN ' ny ' WHEN 2 THEN 'TX' WHEN 3 THEN 'oh' WHEN 4 THEN 'PR' WHEN 5 THEN '' WHEN 6 THEN 'CA' WHEN 7 THEN 'DC' END AS state,
  CASE WHEN c_nationkey = 24 THEN 'Canada' ELSE 'United States' END AS country,
  c_mktsegment AS city, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS postal_code,
  CAST(o_orderkey % 400 AS VARCHAR) || ' cases' AS product_quantity,
  'Voluntary: Firm initiated' AS voluntary_mandated, 'Letter' AS initial_firm_notification,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') END AS recall_initiation_date,
  replace(CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT) AS VARCHAR), '-', '') AS report_date,
  CASE WHEN o_orderstatus <> 'F' THEN '' WHEN o_orderkey % 61 = 0 THEN 'N/A'
       ELSE replace(CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 365 AS INT) AS VARCHAR), '-', '') END AS termination_date
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def first_match_sql(expr: str, ordered_rules, default_sql: str) -> str:
    parts = [f"WHEN regexp_matches(lower({expr}), {q(p)}) THEN {q(label)}" for p, label in ordered_rules]
    return "CASE " + " ".join(parts) + f" ELSE {default_sql} END"


def region_sql(expr: str) -> str:
    state = f"lower(trim({expr}))"
    parts = []
    for name, states in rules.REGION_STATES.items():
        parts.append(f"WHEN {state} IN ({', '.join(q(s) for s in states)}) THEN {q(name)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(rules.REGION_DEFAULT)} END"


def compact_date_sql(expr: str) -> str:
    return f"CAST(try_strptime({expr}, '%Y%m%d') AS DATE)"


def clean_firm_sql(expr: str) -> str:
    return f"trim(lower(regexp_replace({expr}, {q(rules.FIRM_DROP_PATTERN)}, '', 'g')))"


def silver_select_sql(src: str = "fx") -> str:
    s0 = f"""
SELECT recall_number, event_id,
  {first_match_sql('status', rules.STATUS_RULES, 'status')} AS status,
  {first_match_sql('classification', rules.CLASSIFICATION_RULES, 'classification')} AS classification,
  product_type, recalling_firm,
  {clean_firm_sql('recalling_firm')} AS recalling_firm_clean,
  product_description, reason_for_recall,
  {first_match_sql('reason_for_recall', rules.REASON_RULES, q(rules.REASON_DEFAULT))} AS recall_reason_category,
  {first_match_sql('product_description', rules.PRODUCT_RULES, q(rules.PRODUCT_DEFAULT))} AS product_category,
  distribution_pattern,
  {first_match_sql('distribution_pattern', rules.DISTRIBUTION_RULES, q(rules.DISTRIBUTION_DEFAULT))} AS distribution_scope,
  state, {region_sql('state')} AS region, country, city, postal_code, product_quantity,
  voluntary_mandated, initial_firm_notification,
  {compact_date_sql('recall_initiation_date')} AS recall_initiation_date,
  {compact_date_sql('report_date')} AS report_date,
  {compact_date_sql('termination_date')} AS termination_date
FROM {src}"""
    cols = ", ".join(SILVER_COLUMNS[:-2])
    return f"""
SELECT {cols},
  regexp_matches(lower(status), 'ongoing') AS is_open,
  CAST(date_diff('day', recall_initiation_date, coalesce(termination_date, report_date)) AS INTEGER) AS recall_duration_days
FROM ({s0}) s0"""


def points_sql(expr: str, table, default: int) -> str:
    parts = [f"WHEN {expr} = {q(label)} THEN {pts}" for label, pts in table]
    return "CASE " + " ".join(parts) + f" ELSE {default} END"


def tier_sql(expr: str) -> str:
    parts = [f"WHEN {expr} >= {b} THEN {q(label)}" for b, label in rules.TIER_BOUNDS]
    return "CASE " + " ".join(parts) + f" ELSE {q(rules.TIER_DEFAULT)} END"


def scored_select_sql(src: str = "silver", count_src: str | None = None) -> str:
    if count_src is None:
        rc = "CAST(count(*) OVER (PARTITION BY recalling_firm_clean) - 1 AS BIGINT)"
        base = f"SELECT *, {rc} AS repeated_company_count FROM {src}"
    else:
        base = (
            f"SELECT b.*, CAST(coalesce(h.n - 1, 0) AS BIGINT) AS repeated_company_count FROM {src} b "
            f"LEFT JOIN (SELECT recalling_firm_clean AS k, count(*) AS n FROM {count_src} GROUP BY 1) h "
            f"ON b.recalling_firm_clean IS NOT DISTINCT FROM h.k"
        )
    parts = f"""
SELECT *,
  {points_sql('classification', rules.CLASSIFICATION_POINTS, 0)} AS classification_score,
  CASE WHEN regexp_matches(status, '(?i)ongoing') THEN {rules.STATUS_POINTS} ELSE 0 END AS status_score,
  CASE WHEN regexp_matches(distribution_pattern, '(?i)nationwide') THEN {rules.DISTRIBUTION_POINTS} ELSE 0 END AS distribution_score,
  {points_sql('recall_reason_category', rules.REASON_POINTS, rules.REASON_POINTS_DEFAULT)} AS reason_score,
  CASE WHEN repeated_company_count * {rules.REPEAT_POINTS_PER_RECALL} > {rules.REPEAT_POINTS_CAP} THEN {rules.REPEAT_POINTS_CAP}
       ELSE repeated_company_count * {rules.REPEAT_POINTS_PER_RECALL} END AS repeated_company_score
FROM ({base}) b0"""
    total = "classification_score + status_score + distribution_score + reason_score + repeated_company_score"
    expl = " || '; ' || ".join(f"{q(label)} || CAST({name} AS VARCHAR)" for label, name in rules.EXPLANATION_PARTS)
    return f"""
SELECT *, {tier_sql('risk_score')} AS risk_tier, {expl} AS risk_explanation
FROM (SELECT *, CAST({total} AS BIGINT) AS risk_score FROM ({parts}) b1) b2"""


BASE_CTES = f"fx AS ({FIXTURE_SQL}),\nsilver AS ({silver_select_sql('fx')}),\nscored AS ({scored_select_sql('silver')})"


def with_base(final_sql: str, extra_ctes: str = "") -> str:
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {BASE_CTES}{extra}\n{final_sql}"


RECORD_COLS = ", ".join(RECORD_FIELDS)


def fill_keys_sql(src: str, keys) -> str:
    repl = ", ".join(f"CASE WHEN {k} IS NULL OR {k} = '' THEN 'Unknown' ELSE {k} END AS {k}" for k in keys)
    return f"SELECT * REPLACE ({repl}) FROM {src}"


def dedupe_sql(src: str, keys, columns, order_first: str = "report_date") -> str:
    """One row per key: latest ``order_first``, then greatest remaining
    columns with NULL lowest - the same total order as max(struct)."""
    rest = [c for c in columns if c not in keys]
    if order_first in rest:
        rest = [order_first] + [c for c in rest if c != order_first]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {order}) AS _rn FROM {src}) d WHERE _rn = 1"
    )

"""Risk-score building blocks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _points(c: Column, table: list[tuple[str, int]], default: int) -> Column:
    expr = None
    for label, pts in table:
        cond = c == F.lit(label)
        expr = F.when(cond, F.lit(pts)) if expr is None else expr.when(cond, F.lit(pts))
    return expr.otherwise(F.lit(default))


def classification_score(c: Column | str) -> Column:
    """Exact Class I 50, Class II 30, Class III 10, else 0."""
    return _points(_col(c), rules.CLASSIFICATION_POINTS, 0)


def status_score(c: Column | str) -> Column:
    return F.when(_col(c).rlike("(?i)ongoing"), F.lit(rules.STATUS_POINTS)).otherwise(F.lit(0))


def distribution_score(raw_pattern: Column | str) -> Column:
    """Scored on the raw distribution text: only 'nationwide' earns points."""
    return F.when(_col(raw_pattern).rlike("(?i)nationwide"), F.lit(rules.DISTRIBUTION_POINTS)).otherwise(F.lit(0))


def reason_score(c: Column | str) -> Column:
    return _points(_col(c), rules.REASON_POINTS, rules.REASON_POINTS_DEFAULT)


def repeated_company_score(n: Column | str) -> Column:
    """min(2n, 20)."""
    doubled = _col(n) * F.lit(rules.REPEAT_POINTS_PER_RECALL)
    return F.when(doubled > F.lit(rules.REPEAT_POINTS_CAP), F.lit(rules.REPEAT_POINTS_CAP)).otherwise(doubled)


def risk_tier(score: Column | str) -> Column:
    s = _col(score)
    expr = None
    for bound, label in rules.TIER_BOUNDS:
        cond = s >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rules.TIER_DEFAULT))


def risk_tier_bins(score: Column | str, strict_reference: bool = False) -> Column:
    """Tier from right-closed bins (-1,39], (39,69], (69,89], (89,inf).

    A score at or below -1 falls outside every bin: NULL by default, or
    the text 'nan' with ``strict_reference=True`` (what a categorical
    cast to text produces). NULL scores stay NULL / 'nan' likewise.
    """
    s = _col(score)
    outside = F.lit("nan") if strict_reference else F.lit(None).cast("string")
    expr = F.when(s.isNull() | (s <= F.lit(rules.TIER_BIN_LOWEST)), outside)
    for upper, label in rules.TIER_BIN_EDGES:
        expr = expr.when(s <= F.lit(upper), F.lit(label))
    return expr.otherwise(F.lit(rules.TIER_BIN_TOP))


def risk_explanation() -> Column:
    """'Classification +a; Status +b; Distribution +c; Reason +d; Repeat company +e'."""
    parts = [F.concat(F.lit(label), F.col(name).cast("string")) for label, name in rules.EXPLANATION_PARTS]
    return F.concat_ws("; ", *parts)


def _strip(c: Column | str) -> Column:
    """NULL -> '', then remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"^\s+|\s+$", "")


def compute_risk_score(
    classification: Column | str,
    status: Column | str,
    distribution_pattern: Column | str,
    reason_category: Column | str,
    repeated_company_count: Column | str | int = 0,
) -> Column:
    """Stand-alone score formula (stricter than the table scorer).

    Inputs are trimmed (NULL counts as ''); the status must *equal*
    'ongoing' ignoring case, the distribution text must contain
    'nationwide'; the caller supplies the repeat count.
    """
    cls = _strip(classification)
    st = F.lower(_strip(status))
    dist = F.lower(_strip(distribution_pattern))
    reason = _strip(reason_category)
    n = F.lit(repeated_company_count) if isinstance(repeated_company_count, int) else _col(repeated_company_count)
    st_pts = F.when(st == F.lit("ongoing"), F.lit(rules.STATUS_POINTS)).otherwise(F.lit(0))
    dist_pts = F.when(dist.contains("nationwide"), F.lit(rules.DISTRIBUTION_POINTS)).otherwise(F.lit(0))
    # An unknown repeat count is no repeat (least() would skip a NULL).
    repeat_pts = F.least(F.coalesce(n, F.lit(0)) * F.lit(rules.REPEAT_POINTS_PER_RECALL), F.lit(rules.REPEAT_POINTS_CAP))
    return (
        _points(cls, rules.CLASSIFICATION_POINTS, 0)
        + st_pts
        + dist_pts
        + _points(reason, rules.REASON_POINTS, rules.REASON_POINTS_DEFAULT)
        + repeat_pts
    )

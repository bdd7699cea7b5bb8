"""Row order of every ordered query, and that no plan gathers rows into one
task to number them."""

import pytest

from noticeflow.plans.catalog import QUERIES

from .conftest import SF_SMALL


def low(x):
    """Ascending, missing values last."""
    return (x is None, x if x is not None else 0)


def high(x):
    """Descending, missing values last."""
    return (x is None, -x if x is not None else 0)


ORDER = {
    "company_watchlist": lambda r: (-r.high_risk_recalls, -r.avg_risk_score, low(r.recalling_firm_clean)),
    "open_recall_aging": lambda r: (high(r.recall_duration_days), low(r.recall_number)),
    "company_reason_counts": lambda r: (-r["count"],),
    "state_summary": lambda r: (-r.total_recalls, low(r.state)),
    "recall_explorer": lambda r: (high(r.risk_score), low(r.recall_number)),
    "company_risk_timeline": lambda r: low(r.recall_initiation_date),
    "top_states_by_count": lambda r: (-r.total_recalls, low(r.state)),
    "top_states_by_risk": lambda r: (-r.avg_risk_score, low(r.state)),
    "sorted_month_trend": lambda r: low(r.recall_month),
    "reasons_by_count": lambda r: (r["count"], low(r.recall_reason_category)),
    "products_by_count": lambda r: (r["count"], low(r.product_category)),
    "company_list": lambda r: low(r.recalling_firm_clean),
}


@pytest.mark.parametrize("key", sorted(ORDER))
def test_rows_come_in_order(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = df.collect()
    keys = [ORDER[key](r) for r in rows]
    assert len(rows) > 1 and keys == sorted(keys)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and ("SinglePartition" not in plan or "TakeOrdered" in plan)

"""Column -> Column functions (text rules, dates, scores)."""

from .dates import coerce_date, iso_date_text, parse_compact_date, recall_duration_days, recall_month, to_date_literal
from .scores import (
    classification_score,
    compute_risk_score,
    distribution_score,
    reason_score,
    repeated_company_score,
    risk_explanation,
    risk_tier,
    risk_tier_bins,
    status_score,
)
from .text import (
    clean_firm,
    distribution_scope,
    fill_conflict_keys,
    first_match_category,
    is_open,
    product_category,
    reason_category,
    region,
    region_map_rows,
    standard_classification,
    standard_status,
)

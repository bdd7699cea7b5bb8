"""Ordered text rules and lookup tables, kept as data.

Every rule list is ordered: the first pattern that matches wins, so the
order below is part of the semantics (e.g. "ice cream" lands in Dairy
because the Dairy rule comes before Frozen Foods).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES - these must equal the source system's rules for results to
# match. Patterns are Java / RE2 compatible and are applied to lower-cased
# text with "find anywhere" semantics.
# ---------------------------------------------------------------------------

CLASSIFICATION_RULES: list[tuple[str, str]] = [
    (r"\bclass\s*iii\b", "Class III"),
    (r"\bclass\s*ii\b", "Class II"),
    (r"\bclass\s*i\b", "Class I"),
]

STATUS_RULES: list[tuple[str, str]] = [
    ("ongoing", "Ongoing"),
    ("terminated|completed", "Terminated"),
]

REASON_RULES: list[tuple[str, str]] = [
    (r"listeria|salmonella|e\. coli|contamination", "Bacterial Contamination"),
    ("undeclared allergen|milk|soy|peanut|wheat|tree nut", "Allergen Issue"),
    ("label|mislabel", "Labeling Issue"),
    ("foreign|plastic|metal|glass", "Foreign Material"),
]
REASON_DEFAULT = "Other"

PRODUCT_RULES: list[tuple[str, str]] = [
    ("cheese|milk|cream|yogurt|butter|dairy", "Dairy"),
    ("beef|chicken|pork|turkey|meat|sausage", "Meat & Poultry"),
    ("fish|shrimp|crab|salmon|tuna|seafood", "Seafood"),
    ("lettuce|spinach|salad|sprout|fruit|vegetable|produce", "Produce"),
    ("infant|baby|formula", "Infant & Baby Food"),
    ("supplement|vitamin|capsule|tablet", "Supplements"),
    ("cookie|cake|bread|bakery|pastry", "Bakery"),
    ("juice|drink|beverage|water", "Beverages"),
    ("frozen|ice cream", "Frozen Foods"),
]
PRODUCT_DEFAULT = "Other"

DISTRIBUTION_RULES: list[tuple[str, str]] = [
    ("nationwide|nationally|all states", "Nationwide"),
    ("international|canada|mexico|export", "International"),
    (",", "Multi-State"),
]
DISTRIBUTION_DEFAULT = "Local/Unknown"

# US census regions by lower-case state code; anything else is "Unknown".
REGION_STATES: dict[str, list[str]] = {
    "Northeast": ["ct", "me", "ma", "nh", "ri", "vt", "nj", "ny", "pa"],
    "Midwest": ["il", "in", "mi", "oh", "wi", "ia", "ks", "mn", "mo", "ne", "nd", "sd"],
    "South": ["de", "fl", "ga", "md", "nc", "sc", "va", "dc", "wv", "al", "ky", "ms", "tn", "ar", "la", "ok", "tx"],
    "West": ["az", "co", "id", "mt", "nv", "nm", "ut", "wy", "ak", "ca", "hi", "or", "wa"],
}
REGION_DEFAULT = "Unknown"

# Characters kept by the firm-name cleaner (everything else is removed).
FIRM_DROP_PATTERN = r"[^a-zA-Z0-9\s]"

# Risk points.
CLASSIFICATION_POINTS: list[tuple[str, int]] = [("Class I", 50), ("Class II", 30), ("Class III", 10)]
STATUS_POINTS = 20          # status matches "ongoing" (case-insensitive)
DISTRIBUTION_POINTS = 20    # raw distribution text matches "nationwide"
REASON_POINTS: list[tuple[str, int]] = [
    ("Bacterial Contamination", 25),
    ("Allergen Issue", 20),
    ("Labeling Issue", 10),
]
REASON_POINTS_DEFAULT = 5
REPEAT_POINTS_PER_RECALL = 2
REPEAT_POINTS_CAP = 20

# Tier thresholds (score >= bound), highest first.
TIER_BOUNDS: list[tuple[int, str]] = [(90, "Critical"), (70, "High"), (40, "Medium")]
TIER_DEFAULT = "Low"
# Fallback tiering on right-closed bins (-1, 39], (39, 69], (69, 89], (89, inf).
TIER_BIN_EDGES: list[tuple[float, str]] = [(39, "Low"), (69, "Medium"), (89, "High")]
TIER_BIN_LOWEST = -1
TIER_BIN_TOP = "Critical"

# Explanation labels, in output order.
EXPLANATION_PARTS: list[tuple[str, str]] = [
    ("Classification +", "classification_score"),
    ("Status +", "status_score"),
    ("Distribution +", "distribution_score"),
    ("Reason +", "reason_score"),
    ("Repeat company +", "repeated_company_score"),
]

# Free-text search columns, facet columns and explorer projections.
SEARCH_COLUMNS = [
    "recall_number", "recalling_firm", "recalling_firm_clean", "product_description",
    "reason_for_recall", "state", "country", "classification", "recall_reason_category",
    "product_category", "risk_tier",
]
FACET_COLUMNS: list[tuple[str, str]] = [
    ("classification", "classification"),
    ("status", "status"),
    ("reason", "recall_reason_category"),
    ("product_category", "product_category"),
    ("distribution_scope", "distribution_scope"),
    ("state", "state"),
    ("risk_tier", "risk_tier"),
]
PRESETS = [
    "All Recalls",
    "Open Class I Recalls",
    "High-Risk Companies",
    "Nationwide Allergen Recalls",
    "Recent Bacterial Contamination",
]
EXPLORER_COLUMNS = [
    "recall_number", "recalling_firm_clean", "product_category", "classification", "status",
    "risk_tier", "risk_score", "recall_reason_category", "distribution_scope", "state",
    "recall_initiation_date", "risk_explanation",
]
OPEN_AGING_COLUMNS = [
    "recall_number", "recalling_firm_clean", "classification", "recall_reason_category",
    "recall_initiation_date", "recall_duration_days", "risk_score", "risk_tier",
]
DATE_COLUMNS = ["recall_initiation_date", "report_date", "termination_date", "latest_recall_date"]
BACKFILL_COLUMNS = ["product_category", "distribution_scope"]
BACKFILL_VALUE = "Unknown"
CONFLICT_FILL = "Unknown"

# Long data-quality report labels: (label, column).
DQ_MISSING_CHECKS: list[tuple[str, str]] = [
    ("Missing recall number", "recall_number"),
    ("Missing classification", "classification"),
    ("Missing reason", "reason_for_recall"),
    ("Missing recalling firm", "recalling_firm"),
    ("Missing report date", "report_date"),
]

# Default date-window start when only an end is given.
WINDOW_EARLIEST = "19000101"
# Default recall-date bounds when a table has no initiation dates.
DEFAULT_MIN_RECALL_DATE = "2023-01-01"

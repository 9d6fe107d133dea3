"""Business constants and scope thresholds."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Labels, rules and patterns that must equal the reference's
# outputs exactly.  Kept together, in natural order, as plain text.
# ---------------------------------------------------------------------------
BUDGET_TIER_LABELS = {
    1: "Low (Bottom Quartile)",
    2: "Lower-Mid (Second Quartile)",
    3: "Upper-Mid (Third Quartile)",
    4: "High (Top Quartile)",
}
BUDGET_TIER_DEFINITIONS = {
    1: "Bottom quarter of reported budgets in the analysis dataset",
    2: "Second quarter of reported budgets in the analysis dataset",
    3: "Third quarter of reported budgets in the analysis dataset",
    4: "Top quarter of reported budgets in the analysis dataset",
}
BUDGET_TIER_UNCLASSIFIED = "Budget tier not classified"
BUDGET_TIER_UNKNOWN = "Unknown"

# profitability tier on roi_pct: (lower bound inclusive, label), checked in order
PROFITABILITY_TIERS = [
    (300, "Massive Hit (300%+)"),
    (100, "Strong Hit (100-300%)"),
    (0, "Profitable (0-100%)"),
]
PROFITABILITY_LOSS = "Loss (<0%)"

# volatility bands on the (unrounded) ROI standard deviation
RISK_INSUFFICIENT = "Insufficient History"
RISK_LOW = "Low Volatility"
RISK_MODERATE = "Moderate Volatility"
RISK_HIGH = "High Volatility"
RISK_LOW_MAX = 50
RISK_MODERATE_MAX = 125

PREDICTABILITY_LOW_CONFIDENCE = "Low Confidence"
PREDICTABILITY_HIGH = "Highly Predictable"
PREDICTABILITY_MODERATE = "Moderately Predictable"
PREDICTABILITY_VOLATILE = "Volatile"
PREDICTABILITY_HIGH_MIN_SUCCESS = 70
PREDICTABILITY_MODERATE_MIN_SUCCESS = 55

MOMENTUM_INSUFFICIENT = "Insufficient History"
MOMENTUM_UP = "Trending Up"
MOMENTUM_DOWN = "Trending Down"
MOMENTUM_STABLE = "Stable"

COVERAGE_INSUFFICIENT = "Insufficient History"
COVERAGE_EXPANDING = "Expanding"
COVERAGE_CONTRACTING = "Contracting"
COVERAGE_MIXED = "Mixed"

IMPUTE_RATIO_LABEL = "median_budget_revenue_ratio_from_reported_financials"
IMPUTE_MEDIAN_LABEL = "median_budget_from_reported_financials"

EXCLUDED_GENRES = ("TV Movie", "Foreign")
MIN_SEGMENT_SAMPLE = 5

SCOPE_LABEL_VERIFIED = "Verified Financials"
SCOPE_LABEL_COVERAGE = "Market Coverage (10K budget / positive revenue)"

# release-date shape census (EDA)
DATE_SHAPE_PATTERNS = {
    "YYYY-MM-DD": r"^\d{4}-\d{2}-\d{2}$",
    "MM/DD/YYYY": r"^\d{2}/\d{2}/\d{4}$",
    "DD-MM-YYYY": r"^\d{2}-\d{2}-\d{4}$",
}
COMMA_SPACING_PATTERN = r",\s|\s,"

# EDA constants
TOP_TOKENS = 15
TOP_EXAMPLES = 5
TOP_RATED = 20
ROI_HIST_BINS = 50
ROI_CLIP = (-1.0, 20.0)
RATING_HIST_BINS = 30
RATING_VALID_RANGE = (0.0, 10.0)
TERTILE_CUTS = (0.33, 0.66)
TERTILE_LABELS = ("Low", "Mid", "High")
LOW_BUDGET_OUTLIER = 10_000
TOP_N_RANKING = 10

# default thresholds of the two analytical scopes
MIN_BUDGET = 10_000
MIN_REVENUE = 1_000_000
# the generated test tables top out near 724k revenue per order, so the
# recommendation threshold is lowered for them (documented in FIXTURES.md)
GENERATED_MIN_REVENUE = 100_000
# percentile accuracy of the approximate median mode
APPROX_ACCURACY = 1000


@dataclass(frozen=True)
class Scope:
    """Thresholds of the recommendation and market-coverage scopes."""

    min_budget: float = MIN_BUDGET
    min_revenue: float = MIN_REVENUE

    @classmethod
    def generated(cls) -> "Scope":
        return cls(MIN_BUDGET, GENERATED_MIN_REVENUE)

"""Business rule chains as built-in CASE expressions (no Python UDFs).

Fixed values: the labels, tier names and edges below must equal the reference
pipeline's outputs; they are listed together, in the reference's order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
SEGMENTS = [
    "Champions", "Loyal Customers", "New Customers", "Potential Loyalists",
    "At Risk", "Cannot Lose Them", "Lost", "Others",
]
PRIORITIES = {
    "P1 - Critical Retention": ["Champions", "Cannot Lose Them"],
    "P2 - Grow & Nurture": ["Loyal Customers", "Potential Loyalists"],
    "P3 - Activate & Re-engage": ["At Risk", "New Customers"],
    "P4 - Win-back Campaign": ["Lost"],
}
DEFAULT_PRIORITY = "P5 - Monitor"
CLV_TIERS = [(2000, "VIP (High CLV)"), (1000, "High Value"), (500, "Medium Value"),
             (200, "Low Value")]
CLV_TIER_FLOOR = "Minimal Value"
RISK_TIERS = [(0.8, "Critical Risk (80%+)"), (0.6, "High Risk (60-80%)"),
              (0.4, "Medium Risk (40-60%)"), (0.2, "Low Risk (20-40%)")]
RISK_TIER_FLOOR = "Safe (<20%)"
SUBSCRIPTION_TIERS = ["Basic", "Standard", "Premium", "Enterprise"]
# -----------------------------------------------------------------------------


def segment(r: Column, f: Column, m: Column) -> Column:
    """RFM segment, first matching rule wins."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r >= 3) & (f >= 3) & (m <= 2), "Potential Loyalists")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2) & (m >= 3), "Cannot Lose Them")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
        .otherwise("Others")
    )


def priority(seg: Column) -> Column:
    out = None
    for label, members in PRIORITIES.items():
        cond = seg.isin(*members)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(DEFAULT_PRIORITY)


def frequency_tier(freq: Column) -> Column:
    return (
        F.when(freq == 0, "One-time Buyer")
        .when(freq.between(1, 4), "Occasional")
        .when(freq.between(5, 10), "Regular")
        .when(freq > 10, "Frequent")
    )


def value_tier(mv: Column) -> Column:
    return (
        F.when(mv.isNull(), "No Repeat Purchases")
        .when(mv < 10, "Low Value")
        .when(mv < 50, "Medium Value")
        .when(mv < 200, "High Value")
        .otherwise("Premium Value")
    )


def _descending_tiers(x: Column, edges, floor_label: str) -> Column:
    out = None
    for edge, label in edges:
        cond = x >= F.lit(edge)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(floor_label)


def clv_tier(clv: Column) -> Column:
    return _descending_tiers(clv, CLV_TIERS, CLV_TIER_FLOOR)


def risk_tier(score: Column) -> Column:
    return _descending_tiers(score, RISK_TIERS, RISK_TIER_FLOOR)


def tier_code(tier: Column) -> Column:
    """Ordinal code 1..4 of the subscription tier, NULL otherwise."""
    out = None
    for i, name in enumerate(SUBSCRIPTION_TIERS, start=1):
        out = F.when(tier == name, F.lit(i)) if out is None else out.when(tier == name, F.lit(i))
    return out


def cluster_name(r: Column, f: Column, m: Column) -> Column:
    """Name a cluster from its mean recency, frequency and monetary value."""
    return (
        F.when((r < 30) & (f > 10) & (m > 2000), "Champions")
        .when((r < 60) & (f > 5) & (m > 1000), "Loyal Customers")
        .when((r > 90) & (f > 5) & (m > 1000), "At Risk")
        .when((r > 120) & (f <= 3), "Lost / Dormant")
        .otherwise("Average")
    )

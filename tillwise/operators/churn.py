"""Gold mart: churn features (profile LEFT JOIN per-customer behaviour)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import cents, days_between, flag, half_up_div
from ..params import ChurnParams
from .activity import customer_activity, last_clean
from .silver import observation_end_value

CHURN_COLUMNS = [
    "CustomerID", "first_purchase_date", "last_purchase_date", "tenure_days",
    "subscription_tier", "monthly_fee", "churn_label", "country", "is_uk_customer",
    "total_transactions", "total_spend", "total_items", "unique_products",
    "avg_line_value", "avg_order_value", "recency_days", "customer_lifespan_days",
    "active_months", "avg_items_per_order", "has_high_value_order", "has_bulk_purchase",
    "spend_per_transaction", "items_per_transaction", "spend_per_product",
    "purchase_regularity", "tier_encoded", "is_whale", "is_inactive_90d",
    "is_inactive_60d", "engagement_score",
]


def transaction_features(silver: DataFrame | None, p: ChurnParams = ChurnParams(), activity: DataFrame | None = None) -> DataFrame:
    """Behaviour per customer with clean lines: of the lines ``silver``, or of
    ``activity``, what ``customer_activity`` made of them (written)."""
    if activity is None:
        end = observation_end_value(silver)
        activity = customer_activity(silver, p=p)
    else:
        end = last_clean(activity).scalar()
    agg = activity.where(F.col("clean_lines") > 0).select(
        "CustomerID", F.col("clean_invoices").alias("total_transactions"), F.col("clean_spend").alias("_spend"),
        F.col("clean_items").alias("_items"), F.col("clean_lines").alias("_lines"), F.col("clean_last").alias("_last"),
        F.col("clean_first").alias("_first"), F.col("clean_months").alias("active_months"),
        "has_high_value_order", "has_bulk_purchase", F.col("clean_products").alias("unique_products"))
    return agg.select(
        "CustomerID",
        F.col("total_transactions").cast("long").alias("total_transactions"),
        "_spend",
        F.col("_items").cast("long").alias("total_items"),
        F.col("unique_products").cast("long").alias("unique_products"),
        half_up_div(cents("_spend"), "_lines").alias("avg_line_value"),
        half_up_div(cents("_spend"), "total_transactions").alias("avg_order_value"),
        days_between(F.col("_last"), end).cast("long").alias("recency_days"),
        days_between("_first", "_last").cast("long").alias("customer_lifespan_days"),
        F.col("active_months").cast("long").alias("active_months"),
        half_up_div(F.col("_lines") * 100, "total_transactions").alias("avg_items_per_order"),
        F.col("has_high_value_order").cast("long").alias("has_high_value_order"),
        F.col("has_bulk_purchase").cast("long").alias("has_bulk_purchase"),
    )


def churn_features(silver: DataFrame | None, customers: DataFrame,
                   p: ChurnParams = ChurnParams(), activity: DataFrame | None = None) -> DataFrame:
    """Profiles LEFT JOIN behaviour on CustomerID plus ratios, flags, tier code
    and the engagement score. Profiles without clean lines keep NULL
    behaviour and FALSE flags (reported by the data tests). ``activity`` takes
    the place of the lines (see ``transaction_features``).

    Both sides arrive hash-partitioned (the behaviour side by its own
    aggregate), so the join adds at most the profile-side shuffle; AQE turns
    it into a broadcast when a side is measured small, and splits skewed keys.
    """
    t = transaction_features(silver, p, activity)
    c = customers.select(
        "CustomerID", "first_purchase_date", "last_purchase_date", "tenure_days",
        "subscription_tier", "monthly_fee", "churn_label", "country", "is_uk_customer")
    j = c.join(t, "CustomerID", "left")
    tx, spend = F.col("total_transactions"), F.col("_spend")
    products, months = F.col("unique_products"), F.col("active_months")
    w = lambda s: F.lit(Decimal(s))  # noqa: E731 - exact decimal weights
    engagement = F.round(
        tx.cast("decimal(20,0)") * w(p.w_tx)
        + spend / F.lit(100) * w(p.w_spend)
        + products.cast("decimal(20,0)") * w(p.w_products)
        + months.cast("decimal(20,0)") * w(p.w_months), 2)
    return j.select(
        "CustomerID", "first_purchase_date", "last_purchase_date", "tenure_days",
        "subscription_tier", "monthly_fee", "churn_label", "country", "is_uk_customer",
        "total_transactions",
        spend.cast("double").alias("total_spend"),
        "total_items", "unique_products", "avg_line_value", "avg_order_value",
        "recency_days", "customer_lifespan_days", "active_months", "avg_items_per_order",
        "has_high_value_order", "has_bulk_purchase",
        half_up_div(cents(spend), tx).alias("spend_per_transaction"),
        half_up_div(F.col("total_items") * 100, tx).alias("items_per_transaction"),
        half_up_div(cents(spend), products).alias("spend_per_product"),
        half_up_div(months * 3000, "customer_lifespan_days").alias("purchase_regularity"),
        rules.tier_code(F.col("subscription_tier")).cast("long").alias("tier_encoded"),
        flag(spend >= p.whale_spend).alias("is_whale"),
        flag(F.col("recency_days") > p.inactive_long).alias("is_inactive_90d"),
        flag(F.col("recency_days") > p.inactive_short).alias("is_inactive_60d"),
        engagement.cast("double").alias("engagement_score"),
    )

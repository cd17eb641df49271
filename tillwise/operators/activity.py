"""What the customer profiles and the gold marts need of the lines, per customer.

One pass per grouping serves both: a profile counts every dated line, the
marts only the clean ones among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import int_flag
from ..params import ChurnParams
from ..session import cut_lineage


def customer_activity(lines: DataFrame, clean: Column | None = None, p: ChurnParams = ChurnParams(),
                      profile: bool = True, behaviour: bool = True, written: bool = False) -> DataFrame:
    """One row per customer with a dated line. ``lines`` are distinct; with
    ``clean`` (never NULL) they are ``silver.counted_lines`` and the columns of
    ``profile`` count all their copies; without it they are the clean lines,
    and only the columns of ``behaviour`` (``clean_*``) are given, NULL or 0 for
    customers without a clean line.

    Lines become one row per (customer, invoice), (customer, product),
    (customer, month) and (customer, country), each combined map-side and
    shuffled on the pair, so a customer with a third of all lines is spread over
    many tasks, and no row is expanded for a distinct count. Pass it on written
    where it is read more than once. ``written``: what each grouping gives per
    customer is written before the next one begins, so that their shuffles need
    not be on disk at the same time.
    """
    cut = cut_lineage if written else (lambda df: df)
    profile = profile and clean is not None
    kept = F.lit(True) if clean is None else clean
    of_clean = (lambda c: c) if clean is None else (lambda c: F.when(clean, c))
    ts, quantity = F.col("invoice_timestamp"), F.col("Quantity")
    lines = lines.where(ts.isNotNull())

    per_invoice, per_customer, products = [], [], []
    if profile:
        positive, copies = quantity > 0, F.col("copies")
        amount = F.col("line_total").cast("decimal(38,2)")
        per_invoice += [
            F.min(ts).alias("_first"), F.max(ts).alias("_last"),
            F.sum(F.when(positive, F.when(copies == 1, amount).otherwise((amount * copies).cast("decimal(38,2)")))).alias("_spend"),
            F.sum(F.when(positive, quantity * copies)).alias("_items")]
        per_customer += [
            F.min("_first").alias("first_date"), F.max("_last").alias("last_date"), F.count("InvoiceNo").alias("invoices"),
            F.sum("_spend").alias("spend"), F.sum("_items").alias("items")]
        products += [F.count("StockCode").alias("products")]
    if behaviour:
        per_invoice += [
            F.count_if(kept).alias("_c_lines"), F.sum(of_clean(F.col("line_total"))).alias("_c_spend"),
            F.sum(of_clean(quantity)).alias("_c_items"),
            F.min(of_clean(ts)).alias("_c_first"), F.max(of_clean(ts)).alias("_c_last"),
            F.max(of_clean(int_flag(F.col("line_total") > p.high_value_line))).alias("_high"),
            F.max(of_clean(int_flag(quantity > p.bulk_quantity))).alias("_bulk")]
        per_customer += [
            F.sum("_c_lines").alias("clean_lines"), F.count(F.when(F.col("_c_lines") > 0, F.col("InvoiceNo"))).alias("clean_invoices"),
            F.sum("_c_spend").alias("clean_spend"), F.sum("_c_items").alias("clean_items"),
            F.min("_c_first").alias("clean_first"), F.max("_c_last").alias("clean_last"),
            F.max("_high").alias("has_high_value_order"), F.max("_bulk").alias("has_bulk_purchase")]
        products += [F.count(F.when(F.col("_clean"), F.col("StockCode"))).alias("clean_products")]

    out = cut(lines.groupBy("CustomerID", "InvoiceNo").agg(*per_invoice).groupBy("CustomerID").agg(*per_customer))
    out = out.join(cut(lines.groupBy("CustomerID", "StockCode").agg(F.max(kept).alias("_clean"))
                       .groupBy("CustomerID").agg(*products)), "CustomerID")
    if profile:
        # A string MIN buffer would force sort-based aggregation of every line;
        # the country comes from the (few) customer/country pairs instead. Their
        # line counts are used, else the optimizer takes the pairs for redundant.
        out = out.join(cut(lines.groupBy("CustomerID", "Country").agg(F.sum("copies").alias("_n"))
                           .groupBy("CustomerID").agg(F.min("Country").alias("country"), F.sum("_n").alias("_n"))
                           .where(F.col("_n") > 0).drop("_n")), "CustomerID")
    if behaviour:
        out = out.join(cut(lines.where(kept).groupBy("CustomerID", F.date_trunc("month", ts).alias("_month")).agg(F.count(F.lit(1)).alias("_n"))
                           .groupBy("CustomerID").agg(F.count_if(F.col("_n") > 0).alias("clean_months"))), "CustomerID", "left")
    return out


def last_clean(activity: DataFrame) -> DataFrame:
    """``silver.observation_end`` of the lines behind ``activity``."""
    return activity.agg(F.max("clean_last").alias("end_date"))

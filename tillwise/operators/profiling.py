"""Table profiling as DataFrames (the statistics behind the exploration charts).

Statistics of one table share one aggregate pass where the reference ran a
separate action per number; medians and quartiles are exact and distributed
(range sort), not collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import days_between, exact_amount, half_up_div
from ..params import CleaningParams
from ..session import cut_lineage
from .ranking import exact_quantiles

INVOICE_KEYS = ["InvoiceNo", "StockCode", "CustomerID"]


def _pct(n, total):
    """Share in percent, 2 decimals, exact half-up."""
    return half_up_div(F.col(n) * 10000 if isinstance(n, str) else n * 10000, total)


def _long(df: DataFrame, columns: Sequence[str], name: str = "column_name",
          value: str = "value") -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), name, value)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column, all columns in one aggregate."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_total"], cols, "column_name", "null_count")
    return long.select("column_name", F.col("null_count").cast("long").alias("null_count"),
                       _pct("null_count", F.col("_total")).alias("null_pct"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Exact duplicate rows = rows - distinct rows (one grouped pass)."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    agg = groups.agg(F.sum("_c").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows"))
    return agg.select(
        F.col("total_rows").cast("long").alias("total_rows"),
        F.col("distinct_rows").cast("long").alias("distinct_rows"),
        (F.col("total_rows") - F.col("distinct_rows")).cast("long").alias("duplicate_rows"),
        half_up_div((F.col("total_rows") - F.col("distinct_rows")) * 10000, F.col("total_rows"))
        .alias("duplicate_pct"))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = INVOICE_KEYS) -> DataFrame:
    """Key groups (InvoiceNo, StockCode, CustomerID) occurring more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("count"))
              .where(F.col("count") > 1))


def worst_duplicate_lines(df: DataFrame, keys: Sequence[str] = INVOICE_KEYS) -> DataFrame:
    """All lines of the largest duplicate key group (NULL-safe key match).

    The top group is one row (top-1 of an aggregate), so the join broadcasts
    a single key."""
    top = (duplicate_keys(df, keys)
           .orderBy(F.col("count").desc(), *[F.col(k).asc_nulls_first() for k in keys]).limit(1))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(top[k])
        cond = c if cond is None else cond & c
    return df.join(F.broadcast(top.select(*keys)), cond, "left_semi")


def numeric_summary(df: DataFrame, columns: Sequence[str] = ("Quantity", "UnitPrice"),
                    approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """min, max, mean and sample std (2 dp) and exact median (6 dp: an
    interpolated median of cents can end in a half cent) per column."""
    basic = [F.min("value").alias("min"), F.max("value").alias("max"),
             F.avg("value").alias("avg"), F.stddev_samp("value").alias("std")]
    if approx:  # one-pass mergeable sketch (a data value, rank error <= n / accuracy)
        out = _long(df, columns).groupBy("column_name").agg(
            *basic, F.percentile_approx("value", 0.5, accuracy).alias("median"))
    else:  # the columns are written once: moments and quantiles read them separately
        long = _long(cut_lineage(df.select(*columns)), columns)
        med = exact_quantiles(long, "value", {"median": 0.5}, ["column_name"])
        out = long.groupBy("column_name").agg(*basic).join(med, "column_name", "left")
    return out.select("column_name", *[F.round(c, 2).alias(c) for c in ["min", "max", "avg"]],
                      F.round("median", 6).alias("median"), F.round("std", 2).alias("std"))


def rule_violations(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """Counts of rows breaking each cleaning rule, one pass."""
    q, price = F.col("Quantity"), F.col("UnitPrice")
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("total_rows"),
        F.count_if(q <= 0).cast("long").alias("quantity_not_positive"),
        F.count_if(price <= 0).cast("long").alias("price_not_positive"),
        F.count_if(q > p.extreme_quantity).cast("long").alias("extreme_quantity"),
        F.count_if(price > p.extreme_price).cast("long").alias("extreme_price"),
        F.count_if(F.col("InvoiceNo").startswith(p.cancel_prefix)).cast("long").alias("cancelled"),
        F.count_if(F.col("CustomerID").isNull()).cast("long").alias("null_customer"),
        F.count_if(F.col("Description").isNull()).cast("long").alias("null_description"),
    )


def cancellations(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    return (df.where(F.col("InvoiceNo").startswith(p.cancel_prefix))
              .select("InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "CustomerID"))


def top_quantity_lines(df: DataFrame, n: int = 5) -> DataFrame:
    """Largest quantities (per-partition top-n, one small merge)."""
    order = [F.col("Quantity").desc()] + [F.col(c).asc_nulls_first() for c in
                                          ["InvoiceNo", "StockCode", "Description", "UnitPrice", "CustomerID"]]
    return (df.orderBy(*order).limit(n)
              .select("InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "CustomerID"))


def with_parsed_date(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    return df.withColumn("InvoiceDateParsed", F.try_to_timestamp(F.col("InvoiceDate"), F.lit(p.timestamp_format)))


def date_span(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    d = with_parsed_date(df, p)
    agg = d.agg(F.min("InvoiceDateParsed").alias("min_date"), F.max("InvoiceDateParsed").alias("max_date"))
    return agg.select("min_date", "max_date", days_between("min_date", "max_date").cast("long").alias("span_days"))


def monthly_volume(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    d = with_parsed_date(df, p)
    return (d.groupBy(F.date_format("InvoiceDateParsed", "yyyy-MM").alias("YearMonth"))
              .agg(F.count(F.lit(1)).cast("long").alias("count")))


def country_volume(df: DataFrame) -> DataFrame:
    """Rows per country and their share of all rows (one row per country, so
    the total window runs on a small frame)."""
    from pyspark.sql import Window

    g = df.groupBy("Country").agg(F.count(F.lit(1)).alias("count"))
    return g.select("Country", F.col("count").cast("long").alias("count"),
                    half_up_div(F.col("count") * 10000, F.sum("count").over(Window.partitionBy()))
                    .alias("share_pct"))


def top_countries(df: DataFrame, n: int = 10) -> DataFrame:
    return country_volume(df).orderBy(F.col("count").desc(), F.col("Country").asc_nulls_first()).limit(n)


def customer_metrics(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """Profiling view of customers: raw lines with a customer, positive
    quantity and price (no dedup); first/last on the parsed date (a text
    min/max would compare day-first strings)."""
    clean = with_parsed_date(df, p).where(
        F.col("CustomerID").isNotNull() & (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))
    return clean.groupBy("CustomerID").agg(
        F.count_distinct("InvoiceNo").cast("long").alias("transaction_count"),
        F.sum(exact_amount("Quantity", "UnitPrice")).cast("double").alias("total_spend"),
        F.sum("Quantity").cast("long").alias("total_items"),
        F.min("InvoiceDateParsed").alias("first_purchase"),
        F.max("InvoiceDateParsed").alias("last_purchase"),
    )


def top_customers(metrics: DataFrame, n: int = 10) -> DataFrame:
    return (metrics.orderBy(F.col("total_spend").desc(), F.col("CustomerID").asc()).limit(n)
                   .select("CustomerID", "total_spend", "transaction_count"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``describe()``: count, mean, std (n-1), min, exact 25/50/75 %, max per
    column, long format, 6 decimals. The columns are written once: moments and
    quantiles read them separately."""
    long = _long(cut_lineage(df.select(*columns)), columns, "metric", "value")
    basic = long.groupBy("metric").agg(
        F.count("value").cast("long").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["metric"])
    out = basic.join(qs, "metric", "left")
    return out.select("metric", "count", *[F.round(c, 6).alias(c) for c in
                                          ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation matrix in long form (metric_a, metric_b, corr)."""
    cols = list(columns)
    exprs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
             for a in cols for b in cols]
    wide = df.agg(*exprs)
    long = wide.unpivot([], list(wide.columns), "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("metric_a"), F.split("pair", r"\|")[1].alias("metric_b"),
                       F.round("corr", 6).alias("corr"))


def histogram(df: DataFrame, value: str, bins: int = 50, metric: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed (numpy style).
    ``min``/``max`` come from one aggregate (a scalar subquery); binning is a
    narrow expression followed by a partial-aggregated count."""
    return histograms(df, [(metric or value, F.col(value), F.lit(True))], bins)


def histograms(df: DataFrame, metrics: Sequence[tuple], bins: int = 50) -> DataFrame:
    """Several histograms of one table from two passes: one aggregate for all
    ranges, one unpivoted binning pass. ``metrics``: (name, value, condition)."""
    names = [m[0] for m in metrics]
    wide = df.select(*[F.when(keep, v.cast("double")).alias(n) for n, v, keep in metrics])
    ranges = wide.agg(F.struct(*[F.struct(F.min(n).alias("mn"), F.max(n).alias("mx")).alias(n) for n in names])).scalar()
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("_x"), ranges[n]["mn"].alias("_mn"), ranges[n]["mx"].alias("_mx"))
        for n in names]))).where(F.col("_x").isNotNull())
    width = F.col("_mx") - F.col("_mn")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_mn")) / width * F.lit(float(bins))), F.lit(bins - 1)))
    counted = (long.groupBy("metric", b.cast("int").alias("bin"), "_mn", "_mx")
                   .agg(F.count(F.lit(1)).cast("long").alias("count")))
    w = width / F.lit(float(bins))
    return counted.select(
        "metric", "bin",
        F.round(F.col("_mn") + F.col("bin") * w, 6).alias("lower"),
        F.round(F.col("_mn") + (F.col("bin") + 1) * w, 6).alias("upper"),
        "count")


def distribution_histograms(bronze: DataFrame, customers: DataFrame, bins: int = 50) -> DataFrame:
    """Data behind the distribution charts, on all rows: quantity and unit
    price in the plotted range (0 < Quantity < 1000, 0 < UnitPrice < 100),
    log10 customer spend (spend > 0) and transactions per customer."""
    quantity, price, spend = F.col("Quantity"), F.col("UnitPrice"), F.col("total_spend")
    plotted = (quantity > 0) & (quantity < 1000) & (price > 0) & (price < 100)
    lines = histograms(bronze, [("Quantity", quantity, plotted), ("UnitPrice", price, plotted)], bins)
    return lines.unionByName(histograms(customers, [
        ("log10_spend", F.log10(F.when(spend > 0, spend)), F.lit(True)),
        ("transaction_count", F.col("transaction_count"), F.lit(True))], bins))


def scorecard(bronze: DataFrame, p: CleaningParams = CleaningParams(),
              high_null_share: float = 0.2) -> DataFrame:
    """Eight data quality metrics with value, share and severity, from two
    passes over the table: one aggregate (counts, date span, customers with
    a valid line) and the duplicate grouping."""
    q, price = F.col("Quantity"), F.col("UnitPrice")
    ts = F.try_to_timestamp(F.col("InvoiceDate"), F.lit(p.timestamp_format))
    valid = F.col("CustomerID").isNotNull() & (q > 0) & (price > 0)
    stats = bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("CustomerID").isNull()).alias("null_customer"),
        F.count_if(F.col("Description").isNull()).alias("null_description"),
        F.count_if(F.col("InvoiceNo").startswith(p.cancel_prefix)).alias("cancelled"),
        F.count_if(price <= 0).alias("price_not_positive"),
        F.count_distinct(F.when(valid, F.col("CustomerID"))).alias("valid_customers"),
        days_between(F.min(ts), F.max(ts)).alias("span_days"),
    )
    one = stats.withColumn("duplicate_rows", duplicate_profile(bronze).select("duplicate_rows").scalar())
    t = F.col("total_rows")

    def row(metric, value, pct, severity):
        return F.struct(F.lit(metric).alias("metric"), value.cast("long").alias("value"),
                        pct.alias("pct"), severity.alias("severity"))

    none = F.lit(None).cast("double")
    null_cust_sev = F.when(F.col("null_customer") / t > high_null_share, "HIGH").otherwise("MEDIUM")
    rows = F.array(
        row("Total Rows", t, none, F.lit("INFO")),
        row("Rows with Null CustomerID", F.col("null_customer"), _pct("null_customer", t), null_cust_sev),
        row("Rows with Null Description", F.col("null_description"), _pct("null_description", t), F.lit("LOW")),
        row("Cancelled Orders (Qty < 0 or Invoice 'C')", F.col("cancelled"), _pct("cancelled", t), F.lit("INFO")),
        row("Rows with UnitPrice <= 0", F.col("price_not_positive"), _pct("price_not_positive", t), F.lit("MEDIUM")),
        row("Exact Duplicate Rows", F.col("duplicate_rows"), _pct("duplicate_rows", t), F.lit("LOW")),
        row("Valid Customer Records (post-cleaning)", F.col("valid_customers"), none, F.lit("INFO")),
        row("Date Range Span (days)", F.col("span_days"), none, F.lit("INFO")),
    )
    return one.select(F.inline(rows))


def row_hash(keys: Sequence[str]) -> Column:
    """The first 32 bits of the md5 of the named columns, as a number."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def sample_rows(df: DataFrame, keys: Sequence[str], fraction: float = 0.1) -> DataFrame:
    """Rows whose hashed key is in the lowest ``fraction``: a narrow filter that
    takes the same rows on every run, partitioning and engine, and whose
    samples of two tables are the sample of their union."""
    return df.where(row_hash(keys) < F.lit(int(fraction * (1 << 32))))


def sample_rows_k(df: DataFrame, keys: Sequence[str], k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows of the smallest hashed key (bottom-k): exactly ``k`` rows
    if there are so many. Each task keeps its ``k`` smallest, which are merged;
    samples of two tables merge the same way."""
    return df.withColumn("_h", row_hash(keys)).orderBy("_h", *keys, *ties).limit(k).drop("_h")

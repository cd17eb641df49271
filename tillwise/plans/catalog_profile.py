"""Query catalogue: profiling of the raw invoice lines."""

from __future__ import annotations

from ..operators import profiling as P
from ..sources.bronze import INVOICE_COLUMNS
from . import oracle as O
from .registry import Inputs, register

B = O.with_ctes(O.BRONZE)
PARSED = O.with_ctes(O.BRONZE, """
parsed AS (SELECT *, try_strptime(InvoiceDate, '%d-%m-%Y %H:%M') AS InvoiceDateParsed FROM bronze)""")
PROFILE_CUSTOMERS = """
pcm AS (
  SELECT CustomerID, CAST(COUNT(DISTINCT InvoiceNo) AS BIGINT) AS transaction_count,
    CAST(SUM(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice AS DECIMAL(24,10))) AS DOUBLE) AS total_spend,
    CAST(SUM(Quantity) AS BIGINT) AS total_items,
    MIN(InvoiceDateParsed) AS first_purchase, MAX(InvoiceDateParsed) AS last_purchase
  FROM parsed WHERE CustomerID IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
  GROUP BY CustomerID
)"""
PCM = PARSED + "," + PROFILE_CUSTOMERS
METRICS = ["transaction_count", "total_spend", "total_items"]


def _pct_sql(n: str, total: str) -> str:
    return O.half_up(f"({n}) * 10000", total)


_null_union = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
    f"COUNT(*) AS total FROM bronze" for c in INVOICE_COLUMNS)


@register("null_profile", B + f""", nc AS ({_null_union})
  SELECT column_name, null_count, {_pct_sql('null_count', 'total')} AS null_pct FROM nc""")
def q_null_profile(spark, sf_dir):
    return P.null_profile(Inputs(spark, sf_dir).bronze)


@register("duplicate_profile", B + f""",
  g AS (SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, COUNT(*) AS c
        FROM bronze GROUP BY ALL)
  SELECT CAST(SUM(c) AS BIGINT) AS total_rows, CAST(COUNT(*) AS BIGINT) AS distinct_rows,
    CAST(SUM(c) - COUNT(*) AS BIGINT) AS duplicate_rows,
    {_pct_sql('SUM(c) - COUNT(*)', 'SUM(c)')} AS duplicate_pct
  FROM g""")
def q_duplicate_profile(spark, sf_dir):
    return P.duplicate_profile(Inputs(spark, sf_dir).bronze)


@register("duplicate_keys", B + """
  SELECT InvoiceNo, StockCode, CustomerID, CAST(COUNT(*) AS BIGINT) AS count
  FROM bronze GROUP BY InvoiceNo, StockCode, CustomerID HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    return P.duplicate_keys(Inputs(spark, sf_dir).bronze)


@register("duplicate_example", B + """,
  top AS (SELECT InvoiceNo, StockCode, CustomerID FROM bronze GROUP BY InvoiceNo, StockCode, CustomerID
          HAVING COUNT(*) > 1
          ORDER BY COUNT(*) DESC, InvoiceNo NULLS FIRST, StockCode NULLS FIRST, CustomerID NULLS FIRST LIMIT 1)
  SELECT b.* FROM bronze b SEMI JOIN top t
    ON b.InvoiceNo IS NOT DISTINCT FROM t.InvoiceNo AND b.StockCode IS NOT DISTINCT FROM t.StockCode
   AND b.CustomerID IS NOT DISTINCT FROM t.CustomerID""")
def q_duplicate_example(spark, sf_dir):
    return P.worst_duplicate_lines(Inputs(spark, sf_dir).shared_bronze)


@register("numeric_summary", B + """,
  lv AS (SELECT 'Quantity' AS column_name, CAST(Quantity AS DOUBLE) AS value FROM bronze
         UNION ALL SELECT 'UnitPrice', CAST(UnitPrice AS DOUBLE) FROM bronze)
  SELECT column_name, ROUND(MIN(value), 2) AS "min", ROUND(MAX(value), 2) AS "max", ROUND(AVG(value), 2) AS "avg",
    ROUND(quantile_cont(value, 0.5), 6) AS median, ROUND(stddev_samp(value), 2) AS std
  FROM lv GROUP BY column_name""")
def q_numeric_summary(spark, sf_dir):
    return P.numeric_summary(Inputs(spark, sf_dir).bronze)


@register("rule_violations", B + """
  SELECT CAST(COUNT(*) AS BIGINT) AS total_rows,
    CAST(COUNT(*) FILTER (WHERE Quantity <= 0) AS BIGINT) AS quantity_not_positive,
    CAST(COUNT(*) FILTER (WHERE UnitPrice <= 0) AS BIGINT) AS price_not_positive,
    CAST(COUNT(*) FILTER (WHERE Quantity > 10000) AS BIGINT) AS extreme_quantity,
    CAST(COUNT(*) FILTER (WHERE UnitPrice > 5000) AS BIGINT) AS extreme_price,
    CAST(COUNT(*) FILTER (WHERE starts_with(InvoiceNo, 'C')) AS BIGINT) AS cancelled,
    CAST(COUNT(*) FILTER (WHERE CustomerID IS NULL) AS BIGINT) AS null_customer,
    CAST(COUNT(*) FILTER (WHERE Description IS NULL) AS BIGINT) AS null_description
  FROM bronze""")
def q_rule_violations(spark, sf_dir):
    return P.rule_violations(Inputs(spark, sf_dir).bronze)


@register("cancellations", B + """
  SELECT InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID FROM bronze
  WHERE starts_with(InvoiceNo, 'C')""")
def q_cancellations(spark, sf_dir):
    return P.cancellations(Inputs(spark, sf_dir).bronze)


@register("top_quantity_lines", B + """
  SELECT InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID FROM bronze
  ORDER BY Quantity DESC, InvoiceNo NULLS FIRST, StockCode NULLS FIRST, Description NULLS FIRST,
           UnitPrice NULLS FIRST, CustomerID NULLS FIRST LIMIT 5""")
def q_top_quantity_lines(spark, sf_dir):
    return P.top_quantity_lines(Inputs(spark, sf_dir).bronze)


@register("date_span", PARSED + """
  SELECT MIN(InvoiceDateParsed) AS min_date, MAX(InvoiceDateParsed) AS max_date,
    CAST(date_sub('day', MIN(InvoiceDateParsed), MAX(InvoiceDateParsed)) AS BIGINT) AS span_days
  FROM parsed""")
def q_date_span(spark, sf_dir):
    return P.date_span(Inputs(spark, sf_dir).bronze)


@register("monthly_volume", PARSED + """
  SELECT strftime(InvoiceDateParsed, '%Y-%m') AS YearMonth, CAST(COUNT(*) AS BIGINT) AS count
  FROM parsed GROUP BY 1""")
def q_monthly_volume(spark, sf_dir):
    return P.monthly_volume(Inputs(spark, sf_dir).bronze)


_COUNTRY = B + f""",
  cv AS (SELECT Country, CAST(COUNT(*) AS BIGINT) AS count,
           {_pct_sql('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct
         FROM bronze GROUP BY Country)"""


@register("country_volume", _COUNTRY + " SELECT * FROM cv")
def q_country_volume(spark, sf_dir):
    return P.country_volume(Inputs(spark, sf_dir).bronze)


@register("top_countries", _COUNTRY + " SELECT * FROM cv ORDER BY count DESC, Country NULLS FIRST LIMIT 10")
def q_top_countries(spark, sf_dir):
    return P.top_countries(Inputs(spark, sf_dir).bronze)


@register("customer_spend_profile", PCM + " SELECT * FROM pcm")
def q_customer_spend_profile(spark, sf_dir):
    return P.customer_metrics(Inputs(spark, sf_dir).bronze)


@register("top_customers", PCM + """
  SELECT CustomerID, total_spend, transaction_count FROM pcm ORDER BY total_spend DESC, CustomerID LIMIT 10""")
def q_top_customers(spark, sf_dir):
    return P.top_customers(P.customer_metrics(Inputs(spark, sf_dir).bronze))


_desc_union = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM pcm" for m in METRICS)


@register("describe_metrics", PCM + f""", dl AS ({_desc_union})
  SELECT metric, CAST(COUNT(value) AS BIGINT) AS count, ROUND(AVG(value), 6) AS mean, ROUND(stddev_samp(value), 6) AS std,
    ROUND(MIN(value), 6) AS "min", ROUND(quantile_cont(value, 0.25), 6) AS p25, ROUND(quantile_cont(value, 0.5), 6) AS p50,
    ROUND(quantile_cont(value, 0.75), 6) AS p75, ROUND(MAX(value), 6) AS "max"
  FROM dl GROUP BY metric""")
def q_describe_metrics(spark, sf_dir):
    return P.describe(P.customer_metrics(Inputs(spark, sf_dir).bronze), METRICS)


_corr_union = " UNION ALL ".join(
    f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM pcm"
    for a in METRICS for b in METRICS)


@register("correlations", PCM + f" {_corr_union}")
def q_correlations(spark, sf_dir):
    return P.correlations(P.customer_metrics(Inputs(spark, sf_dir).bronze), METRICS)


def _hist_sql(metric: str, source: str, expr: str, where: str = "TRUE", bins: int = 50) -> str:
    return f"""
  SELECT '{metric}' AS metric, CAST(bin AS INTEGER) AS bin,
    ROUND(mn + bin * ((mx - mn) / {float(bins)}), 6) AS lower, ROUND(mn + (bin + 1) * ((mx - mn) / {float(bins)}), 6) AS upper,
    CAST(COUNT(*) AS BIGINT) AS count
  FROM (
    SELECT CASE WHEN mx - mn = 0 THEN 0 ELSE least(floor((x - mn) / (mx - mn) * {float(bins)}), {bins - 1}) END AS bin, mn, mx
    FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {source} WHERE {where}) v
    CROSS JOIN (SELECT MIN(CAST({expr} AS DOUBLE)) AS mn, MAX(CAST({expr} AS DOUBLE)) AS mx FROM {source} WHERE {where}) r
    WHERE x IS NOT NULL
  ) GROUP BY bin, mn, mx"""


_RANGE = "Quantity > 0 AND Quantity < 1000 AND UnitPrice > 0 AND UnitPrice < 100"


@register("histograms", PCM + " UNION ALL ".join([
    _hist_sql("Quantity", "parsed", "Quantity", _RANGE),
    _hist_sql("UnitPrice", "parsed", "UnitPrice", _RANGE),
    _hist_sql("log10_spend", "pcm", "log10(total_spend)", "total_spend > 0"),
    _hist_sql("transaction_count", "pcm", "transaction_count"),
]))
def q_histograms(spark, sf_dir):
    bronze = Inputs(spark, sf_dir).shared_bronze
    return P.distribution_histograms(bronze, P.customer_metrics(bronze))


@register("scorecard", PCM + f""",
  v AS (SELECT COUNT(*) AS t,
          COUNT(*) FILTER (WHERE CustomerID IS NULL) AS nc, COUNT(*) FILTER (WHERE Description IS NULL) AS nd,
          COUNT(*) FILTER (WHERE starts_with(InvoiceNo, 'C')) AS cx, COUNT(*) FILTER (WHERE UnitPrice <= 0) AS np,
          COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM bronze)) AS dup,
          (SELECT COUNT(*) FROM pcm) AS vc,
          date_sub('day', MIN(InvoiceDateParsed), MAX(InvoiceDateParsed)) AS span
        FROM parsed)
  SELECT 'Total Rows' AS metric, CAST(t AS BIGINT) AS value, CAST(NULL AS DOUBLE) AS pct, 'INFO' AS severity FROM v
  UNION ALL SELECT 'Rows with Null CustomerID', nc, {_pct_sql('nc', 't')},
    CASE WHEN nc / t > 0.2 THEN 'HIGH' ELSE 'MEDIUM' END FROM v
  UNION ALL SELECT 'Rows with Null Description', nd, {_pct_sql('nd', 't')}, 'LOW' FROM v
  UNION ALL SELECT 'Cancelled Orders (Qty < 0 or Invoice ''C'')', cx, {_pct_sql('cx', 't')}, 'INFO' FROM v
  UNION ALL SELECT 'Rows with UnitPrice <= 0', np, {_pct_sql('np', 't')}, 'MEDIUM' FROM v
  UNION ALL SELECT 'Exact Duplicate Rows', dup, {_pct_sql('dup', 't')}, 'LOW' FROM v
  UNION ALL SELECT 'Valid Customer Records (post-cleaning)', vc, NULL, 'INFO' FROM v
  UNION ALL SELECT 'Date Range Span (days)', span, NULL, 'INFO' FROM v""")
def q_scorecard(spark, sf_dir):
    return P.scorecard(Inputs(spark, sf_dir).bronze)


SAMPLE_KEYS = ("InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "CustomerID")
_SAMPLE_HASH = ("CAST('0x' || substr(md5(" + " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in SAMPLE_KEYS)
                + "), 1, 8) AS BIGINT)")


@register("sample_rows", O.with_ctes(O.BRONZE) + f" SELECT * FROM bronze WHERE {_SAMPLE_HASH} < {int(0.1 * (1 << 32))}")
def q_sample_rows(spark, sf_dir):
    """A tenth of the raw lines, by the hash of their key."""
    return P.sample_rows(Inputs(spark, sf_dir).bronze, SAMPLE_KEYS)


@register("sample_rows_k", O.with_ctes(O.BRONZE) + f" SELECT * FROM bronze ORDER BY {_SAMPLE_HASH}, {', '.join(SAMPLE_KEYS)}, UnitPrice LIMIT 500")
def q_sample_rows_k(spark, sf_dir):
    """The 500 raw lines of the smallest hash."""
    return P.sample_rows_k(Inputs(spark, sf_dir).bronze, SAMPLE_KEYS, 500, ["UnitPrice"])

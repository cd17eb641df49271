"""Silver layer: cleaned invoice lines and customer profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag, line_total, of_share
from ..params import CleaningParams
from ..sources.bronze import INVOICE_COLUMNS

STG_TRANSACTION_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "invoice_timestamp",
    "UnitPrice", "CustomerID", "Country", "line_total",
    "is_extreme_quantity", "is_extreme_price", "is_uk_customer",
]


def parse_invoice_ts(c: str = "InvoiceDate", fmt: str = CleaningParams.timestamp_format):
    """Safe parse of the ``dd-MM-yyyy HH:mm`` text date; NULL when it fails."""
    return F.try_to_timestamp(F.col(c), F.lit(fmt))


def stg_transactions(bronze: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """Deduplicate, parse, filter and enrich raw invoice lines.

    Written in the reference's order (DISTINCT, parse, filter); Catalyst moves
    the row filters below the distinct aggregate, so only surviving lines are
    shuffled for deduplication. ``line_total`` is DECIMAL(.,2).
    """
    dedup = bronze.select(*INVOICE_COLUMNS).distinct()
    parsed = dedup.withColumn("invoice_timestamp", parse_invoice_ts("InvoiceDate", p.timestamp_format))
    return clean_lines(parsed.withColumn("line_total", line_total("Quantity", "UnitPrice")), p)


def busy_customers(bronze: DataFrame, share: float = 0.005) -> list[str]:
    """Customers with at least ``share`` of the lines of known customers, at
    most ``1 / share``. Three narrow passes over ``bronze``, so pass it written:
    candidates, among them every such customer, then their counts."""
    known = bronze.where(F.col("CustomerID").isNotNull()).select("CustomerID")
    candidates = known.freqItems(["CustomerID"], share).first()[0] or []
    least = share * known.count()
    counts = known.where(F.col("CustomerID").isin(candidates)).groupBy("CustomerID").count().collect()   # a row per candidate
    return sorted(r["CustomerID"] for r in counts if r["count"] >= least)


def counted_lines(bronze: DataFrame, p: CleaningParams = CleaningParams(), busy: Sequence[str] | None = None,
                  share: tuple[int, int] | None = None) -> DataFrame:
    """The raw lines of known customers, equal ones as one row with their
    number (``copies``), the parsed date and the line's amount: what silver and
    the customer profiles both read. Pass it on written: the date is then
    parsed once per line, where a filter on it would be moved below the
    grouping and parse it a second time. Lines whose date can't be parsed stay,
    with NULL.

    ``busy`` (see ``busy_customers``): the lines of all other customers are
    dealt by customer for their grouping. Each of those stands in one file then,
    so what is later grouped by customer and something else is combined before
    its shuffle. Lines of busy customers are spread as without it. ``share``
    (i, n): part i of n of the lines, equal ones in the same part, whole
    customers unless they are busy."""
    known = bronze.where(F.col("CustomerID").isNotNull()).select(*INVOICE_COLUMNS)
    spread = of_share(share, "InvoiceNo", "StockCode")
    if busy is None:
        parts = [known.where(spread)]
    else:
        of_busy = F.col("CustomerID").isin(list(busy))
        parts = [known.where(~of_busy & of_share(share, "CustomerID")).repartition("CustomerID"),
                 *([known.where(of_busy & spread)] if busy else [])]
    counted = [part.groupBy(*INVOICE_COLUMNS).agg(F.count(F.lit(1)).alias("copies")) for part in parts]
    same = counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1])
    return same.select(
        *[c for c in INVOICE_COLUMNS if c != "InvoiceDate"],
        parse_invoice_ts("InvoiceDate", p.timestamp_format).alias("invoice_timestamp"),
        line_total("Quantity", "UnitPrice").alias("line_total"), "copies")


def is_clean(p: CleaningParams = CleaningParams()):
    """Whether a parsed line is kept (NULL: no)."""
    return (F.col("CustomerID").isNotNull()
            & ~F.col("InvoiceNo").startswith(p.cancel_prefix)
            & (F.col("Quantity") > p.min_quantity_exclusive)
            & (F.col("UnitPrice") >= p.min_unit_price)
            & F.col("invoice_timestamp").isNotNull())


def clean_lines(parsed: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """Filter and enrich lines that are distinct and parsed, ``counted_lines``
    among them."""
    return parsed.where(is_clean(p)).select(
        "InvoiceNo", "StockCode", "Description", "Quantity", "invoice_timestamp",
        "UnitPrice", "CustomerID", "Country", "line_total",
        flag(F.col("Quantity") > p.extreme_quantity).alias("is_extreme_quantity"),
        flag(F.col("UnitPrice") > p.extreme_price).alias("is_extreme_price"),
        flag(F.col("Country") == p.home_country).alias("is_uk_customer"),
    )


def stg_customers(profiles: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """Profiles passed through plus the home-country flag."""
    return profiles.withColumn("is_uk_customer", flag(F.col("country") == p.home_country))


def observation_end(silver: DataFrame) -> DataFrame:
    """One-row frame ``end_date`` = latest clean invoice timestamp."""
    return silver.agg(F.max("invoice_timestamp").alias("end_date"))


def observation_end_value(silver: DataFrame):
    """Latest clean invoice timestamp as a scalar subquery column (computed
    once per query, attached to every row without a join)."""
    return silver.agg(F.max("invoice_timestamp")).scalar()


def output(silver: DataFrame) -> DataFrame:
    """Silver lines with money as DOUBLE (the published column types)."""
    return silver.withColumn("line_total", F.col("line_total").cast("double"))

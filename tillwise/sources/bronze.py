"""Bronze inputs.

``invoice_lines`` derives the raw retail invoice-line table (8 string/number
columns, dirt included) from the star-schema tables the tests provide; the
customer ``profiles`` table stands in for the simulated subscription table.
Both are lazy DataFrames: Catalyst prunes the columns a query does not use and
pushes its filters to the parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import days_between, flag, of_share
from ..params import CleaningParams

# Raw schema of the invoice-line table (all nullable, InvoiceDate is text).
INVOICE_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity",
                   "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
INVOICE_DDL = ("InvoiceNo STRING, StockCode STRING, Description STRING, Quantity INT, "
               "InvoiceDate STRING, UnitPrice DOUBLE, CustomerID STRING, Country STRING")


@dataclass(frozen=True)
class DirtSpec:
    """Deterministic dirt injected by key arithmetic (fixed values of the test
    fixture, shared with the SQL oracle)."""
    cancel_mod: int = 53            # l_orderkey % 53 = 0 -> cancelled, negative qty
    null_description_mod: int = 370  # l_partkey % 370 = 0 -> NULL Description
    bulk_mod: int = 1999            # l_orderkey % 1999 = 2 -> quantity x 400
    bulk_rem: int = 2
    bulk_factor: int = 400
    bad_date_mod: int = 997         # l_orderkey % 997 = 0 -> unparseable date
    free_item_mod: int = 211        # l_partkey % 211 = 0 -> price 0
    coarse_price_mod: int = 499     # l_partkey % 499 = 7 -> price / 10 instead of divisor
    coarse_price_rem: int = 7
    anonymous_mod: int = 4          # l_orderkey % 4 = 1 -> NULL CustomerID
    anonymous_rem: int = 1
    guest_mod: int = 1000           # l_orderkey % 1000 = 3 -> one-off guest id
    guest_rem: int = 3
    home_nations: int = 20          # n_nationkey < 20 -> home country
    duplicate_mod: int = 101        # (l_orderkey + l_linenumber) % 101 = 0 -> row twice


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _price_divisor(custkey: Column) -> Column:
    m = custkey % 4
    return (F.when(m == 0, F.lit(1)).when(m == 1, F.lit(5))
            .when(m == 2, F.lit(25)).otherwise(F.lit(100)))


def invoice_lines(spark: SparkSession, sf_dir: str, dirt: DirtSpec = DirtSpec(),
                  home_country: str = "United Kingdom", share: tuple[int, int] | None = None) -> DataFrame:
    """Raw invoice lines (bronze) built from lineitem, orders, part, customer, nation.

    Join order keeps the widest input (lineitem) to two shuffles: orders is
    first enriched with the customer's nation (orders-sized join), then joined
    to lineitem on the order key, then to part on the part key. AQE decides
    from runtime sizes which sides are broadcast. ``share`` (i, n): part i of
    n of the orders, so that a writer can take them one after the other.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if share is not None:
        li, orders = li.where(of_share(share, "l_orderkey")), orders.where(of_share(share, "o_orderkey"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    cust_nation = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    # Keys and numbers go through the shuffles; texts (number, date, customer,
    # country) are made of them behind the last join. What an order settles is
    # made of its own columns alone, so filters on it reach the scan of orders.
    home = flag(F.col("n_nationkey") < dirt.home_nations)
    orders_c = orders.join(cust_nation, orders.o_custkey == cust_nation.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", home.alias("_home"), F.when(~home, F.col("n_name")).alias("_abroad"))
    base = (li.join(orders_c, li.l_orderkey == orders_c.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey))

    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    qty_int = F.col("l_quantity").cast("int")
    key = F.col("o_orderkey")
    shifted = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), F.lit(0), (key % 1440).cast("int"), F.lit(0))

    out = base.select(
        F.when(key % dirt.cancel_mod == 0, F.concat(F.lit("C"), key.cast("string")))
         .otherwise(key.cast("string")).alias("InvoiceNo"),
        pk.cast("string").alias("StockCode"),
        F.when(pk % dirt.null_description_mod == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_name")).alias("Description"),
        F.when(ok % dirt.cancel_mod == 0, -qty_int)
         .when(ok % dirt.bulk_mod == dirt.bulk_rem, qty_int * dirt.bulk_factor)
         .otherwise(qty_int).alias("Quantity"),
        F.when(key % dirt.bad_date_mod == 0, F.date_format(F.col("o_orderdate"), "yyyy/MM/dd"))
         .otherwise(F.date_format(shifted, "dd-MM-yyyy HH:mm")).alias("InvoiceDate"),
        F.when(pk % dirt.free_item_mod == 0, F.lit(0.0))
         .when(pk % dirt.coarse_price_mod == dirt.coarse_price_rem,
               F.floor(F.col("l_extendedprice") / F.col("l_quantity")) / 10)
         .otherwise(F.floor(F.col("l_extendedprice") / F.col("l_quantity") / _price_divisor(F.col("o_custkey"))) / 100)
         .cast("double").alias("UnitPrice"),
        F.when(key % dirt.anonymous_mod == dirt.anonymous_rem, F.lit(None).cast("string"))
         .when(key % dirt.guest_mod == dirt.guest_rem, F.concat(F.lit("G"), ok.cast("string"), F.lit("-"), ln.cast("string")))
         .otherwise(F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.when(F.col("_home"), F.lit(home_country)).otherwise(F.col("_abroad")).alias("Country"),
        ((ok + ln) % dirt.duplicate_mod == 0).alias("_dup"),
    )
    # Exact duplicates without re-running the joins: a narrow generator emits
    # flagged rows twice.
    copies = F.when(F.col("_dup"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (out.withColumn("_copy", F.explode(copies))
               .select(*INVOICE_COLUMNS))


def read_invoice_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
                     mode: str = "PERMISSIVE", corrupt_column: str | None = None,
                     multi_line: bool = False) -> DataFrame:
    """CSV ingest of the raw invoice file with an explicit schema (no inference).

    Quotes inside quoted fields are doubled. ``multi_line`` lets quoted fields
    span lines, at the price that a file can't be split among tasks. With
    ``corrupt_column`` (PERMISSIVE mode) a row whose fields don't fit the
    schema keeps its text there instead of losing it silently."""
    reader = (spark.read.option("header", True).option("encoding", encoding).option("mode", mode)
              .option("multiLine", multi_line).option("escape", '"'))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(INVOICE_DDL + (f", {corrupt_column} STRING" if corrupt_column else "")).csv(path)


def rejected_rows(lines: DataFrame, corrupt_column: str) -> DataFrame:
    """Row counts of an ingest with a corrupt-record column."""
    return lines.agg(F.count(F.lit(1)).alias("rows"), F.count(corrupt_column).alias("rejected"))


# Fixed values of the subscription stand-in (our constants; the reference
# publishes none): market segment -> tier, tier -> monthly fee.
SEGMENT_TIER = {"BUILDING": "Standard", "AUTOMOBILE": "Premium", "FURNITURE": "Enterprise"}
DEFAULT_TIER = "Basic"
TIER_FEE = {"Basic": "9.99", "Standard": "19.99", "Premium": "29.99", "Enterprise": "49.99"}


def profiles(spark: SparkSession, sf_dir: str, bronze: DataFrame | None = None,
             observation_end: DataFrame | None = None,
             cleaning: CleaningParams = CleaningParams(),
             churn_after_days: int = 90, counted: DataFrame | None = None,
             activity: DataFrame | None = None) -> DataFrame:
    """Customer profile table (stand-in for the simulated subscription table).

    One row per CustomerID seen on a bronze line with a parseable date
    (cancellations kept): activity dates and counts, spend and items over
    positive quantities, recency and tenure against the silver observation
    end, a subscription tier from the customer dimension, its monthly fee and
    the churn label ``recency_days > 90``. ``counted``: the raw lines in the
    form of ``silver.counted_lines``, written; else it is made of ``bronze``.
    ``activity`` (with ``observation_end``): what ``customer_activity`` made of them.
    """
    from ..operators.activity import customer_activity
    from ..operators.silver import clean_lines, counted_lines, is_clean, observation_end as obs_end_of

    if activity is None:
        if counted is None:
            counted = counted_lines(bronze if bronze is not None else invoice_lines(spark, sf_dir), cleaning)
        if observation_end is None:
            observation_end = obs_end_of(clean_lines(counted, cleaning))
        activity = customer_activity(counted, flag(is_clean(cleaning)), behaviour=False)
    agg = activity.select(
        "CustomerID", F.col("first_date").alias("first_purchase_date"), F.col("last_date").alias("last_purchase_date"),
        F.col("invoices").alias("transaction_count"), F.col("spend").alias("_spend"), F.col("items").alias("total_items"),
        F.col("products").alias("unique_products"), "country")
    tier_map = F.create_map(*[F.lit(x) for kv in SEGMENT_TIER.items() for x in kv])
    fee_map = F.create_map(*[F.lit(x) for kv in TIER_FEE.items() for x in kv])
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_ck"), "c_mktsegment")
    end = observation_end.select("end_date").scalar()
    recency = days_between(F.col("last_purchase_date"), end)
    tier = F.coalesce(tier_map[F.col("c_mktsegment")], F.lit(DEFAULT_TIER))
    return (agg.join(cust, agg.CustomerID == cust._ck, "left")
            .select(
                "CustomerID", "first_purchase_date", "last_purchase_date",
                F.col("transaction_count").cast("long").alias("transaction_count"),
                F.coalesce(F.col("_spend"), F.lit(0).cast("decimal(22,2)")).cast("double").alias("total_spend"),
                F.coalesce(F.col("total_items"), F.lit(0)).cast("long").alias("total_items"),
                F.col("unique_products").cast("long").alias("unique_products"),
                "country",
                recency.cast("long").alias("recency_days"),
                days_between(F.col("first_purchase_date"), end).cast("long").alias("tenure_days"),
                tier.alias("subscription_tier"),
                fee_map[tier].cast("decimal(6,2)").cast("double").alias("monthly_fee"),
                F.when(recency > churn_after_days, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("churn_label"),
            ))


__all__ = ["invoice_lines", "profiles", "read_invoice_csv", "read_table", "DirtSpec",
           "INVOICE_COLUMNS", "INVOICE_DDL"]

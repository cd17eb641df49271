"""Values beyond the fixture's range, intermediate folders, ingest rejects."""

import os
from decimal import ROUND_HALF_UP, Decimal
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions.exprs import half_up_div, line_total
from tillwise.operators import clv, profiling, ranking

SMALL = "/root/testdata/sf0.001"


def test_line_total_keeps_every_decimal(spark):
    cases = [(10000, 0.12345, "1234.50"), (1, 150000000.0, "150000000.00"), (3, 0.335, "1.01"), (7, 12.34, "86.38"), (2, 1e14, None)]
    rows = spark.createDataFrame([(i, q, p) for i, (q, p, _) in enumerate(cases)], "i int, Quantity int, UnitPrice double")
    got = {r.i: r.v for r in rows.select("i", line_total("Quantity", "UnitPrice").alias("v")).collect()}
    assert got == {i: None if w is None else Decimal(w) for i, (_, _, w) in enumerate(cases)}


def test_ratios_stay_exact_beyond_a_million(spark):
    cases = [(1104759 * 10000, 6005757), (5000000, 10000001), (4999999, 10000001), (1, 3 * 10 ** 12), (0, 6005757), (10 ** 15 + 7, 999999937)]
    rows = spark.createDataFrame(cases, "n long, d long")
    for r in rows.select("n", "d", half_up_div("n", "d").alias("v")).collect():
        want = (Decimal(r.n) / Decimal(r.d) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.v == float(want), r


@pytest.mark.parametrize("many", [False, True])
def test_grouped_quantiles_without_a_shuffle_on_the_group(spark, monkeypatch, many):
    if many:
        monkeypatch.setattr(ranking, "MAX_GROUPS", 0)
    rng = np.random.default_rng(0)
    rows = [(f"m{i % 3}", float(v)) for i, v in enumerate(rng.integers(0, 40, 900))]
    df = spark.createDataFrame(rows, "metric string, value double")
    out = ranking.exact_quantiles(df, "value", {"q1": 0.25, "q2": 0.5}, ["metric"])
    for r in out.collect():
        x = [v for m, v in rows if m == r.metric]
        assert (r.q1, r.q2) == pytest.approx(tuple(np.quantile(x, [0.25, 0.5])))


def test_scratch_removes_what_it_wrote(spark):
    from tillwise.session import cut_lineage, ensure_checkpoint_dir, scratch
    root = urlparse(ensure_checkpoint_dir(spark)).path
    count = lambda: len([f for f in os.listdir(root) if f.startswith("tillwise-")]) if os.path.isdir(root) else 0
    before = count()
    with scratch(spark):
        df = cut_lineage(cut_lineage(spark.range(5)))
        assert df.count() == 5 and count() == before + 2
    assert count() == before


def test_scratch_leaves_other_threads_tables(spark):
    from concurrent.futures import ThreadPoolExecutor
    from tillwise.session import cut_lineage, scratch
    with ThreadPoolExecutor(1) as pool:
        with scratch(spark):
            other = pool.submit(lambda: cut_lineage(spark.range(5))).result()
        assert other.count() == 5


def test_a_refresh_leaves_only_its_tables(spark, tmp_path):
    from tillwise.plans.medallion import run
    from tillwise.session import ensure_checkpoint_dir
    from tillwise.sources import bronze
    root = urlparse(ensure_checkpoint_dir(spark)).path
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    lines = bronze.invoice_lines(spark, SMALL)
    profiles = bronze.profiles(spark, SMALL, lines)
    paths = run(spark, None, str(tmp_path / "lake"), models=False, lines=lines, profiles=profiles)
    assert set(os.listdir(root)) == before
    assert spark.read.parquet(paths["mart_churn_risk"]).count() == spark.read.parquet(paths["customers_simulated"]).count()


def test_non_finite_values_become_the_median(spark):
    rows = [(1, 1.0), (2, float("nan")), (3, float("inf")), (4, None), (5, 3.0), (6, float("-inf")), (7, 5.0)]
    got = {r.i: r.v for r in clv.repair_with_median(spark.createDataFrame(rows, "i int, v double"), "v").collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 3.0, 4: 3.0, 5: 3.0, 6: 3.0, 7: 5.0}


def test_csv_rejects_are_kept_and_counted(spark, tmp_path):
    from tillwise.sources.bronze import INVOICE_COLUMNS, read_invoice_csv, rejected_rows
    path = tmp_path / "x.csv"
    path.write_text(",".join(INVOICE_COLUMNS) + '\n1,A,"say ""hi""",2,01-12-2010 08:26,2.5,17850,UK\n2,B,b,two,01-12-2010 08:26,2.5,1,UK\n'
                    "3,C,c,3,01-12-2010 08:26,2.5,1,UK,extra\n", encoding="latin-1")
    lines = read_invoice_csv(spark, str(path), corrupt_column="_bad").cache()
    assert tuple(rejected_rows(lines, "_bad").first()) == (3, 2)
    assert lines.filter("InvoiceNo = '1'").first().Description == 'say "hi"'


def test_histograms_share_their_passes(spark):
    rows = [(float(i % 50), float(i % 7)) for i in range(400)] + [(None, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = profiling.histograms(df, [("a", F.col("a"), F.lit(True)), ("b", F.col("b"), F.col("b") > 0)], 10).collect()
    for name, values in (("a", [a for a, _ in rows if a is not None]), ("b", [b for _, b in rows if b > 0])):
        want, _ = np.histogram(values, 10)
        assert {r.bin: r["count"] for r in got if r.metric == name} == {i: n for i, n in enumerate(want) if n}


def test_lines_are_parsed_once_for_silver_and_profiles(spark):
    from tillwise.operators import silver
    from tillwise.plans.registry import Inputs
    from tillwise.sources import bronze

    i = Inputs(spark, SMALL, share_bronze=True)
    for df in (i.silver, i.profiles):
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "gettimestamp" not in plan and "to_timestamp" not in plan
    lines = bronze.invoice_lines(spark, SMALL)
    assert sorted(map(str, i.silver.collect())) == sorted(map(str, silver.stg_transactions(lines).collect()))
    same = silver.counted_lines(lines)
    assert same.agg({"copies": "sum"}).first()[0] == lines.where("CustomerID IS NOT NULL").count()
    assert same.where("copies > 1").count() > 0                      # copies count in the spend of a profile
    spend = lines.where("CustomerID IS NOT NULL AND Quantity > 0 AND InvoiceDate LIKE '__-__-____ __:__'").selectExpr(
        "sum(round(cast(Quantity AS decimal(10,0)) * cast(UnitPrice AS decimal(12,4)), 2))").first()[0]
    assert float(spend) == pytest.approx(i.profiles.agg({"total_spend": "sum"}).first()[0], abs=0.01)


def test_marts_share_one_activity(spark):
    """Profiles, churn mart and RFM base from the activity that they share, on
    lines that the fixture lacks: invoices across months, with cancellations or
    without a number, products without a code, customers without a clean line."""
    from tillwise.functions.exprs import flag
    from tillwise.operators import churn, rfm, silver
    from tillwise.operators.activity import customer_activity, last_clean
    from tillwise.plans.registry import Inputs
    from tillwise.sources import bronze

    odd = [("1", "A", None, 2, "31-01-2011 23:59", 600.0, "x", "France"), ("1", "A", None, 2, "31-01-2011 23:59", 600.0, "x", "France"),
           ("1", "B", None, 200, "01-02-2011 00:01", 0.5, "x", "Belgium"), ("1", "B", None, 1, "01-04-2011 00:01", 0.0, "x", "France"),
           ("C2", "D", None, -3, "02-03-2011 10:00", 5.0, "x", "France"), (None, "E", "e", 1, "02-05-2011 10:00", 5.0, "x", "France"),
           ("3", None, "f", 1, "02-01-2011 10:00", 5.0, "x", "France"), ("C4", "A", "a", -1, "02-01-2011 10:00", 5.0, "y", "Spain"),
           ("5", "A", "a", 1, "2011/01/02", 5.0, "z", "Spain"), ("6", "A", "a", 4, "03-06-2011 10:00", 2.5, "w", "Spain")]
    lines = spark.createDataFrame(odd, bronze.INVOICE_DDL).unionByName(bronze.invoice_lines(spark, SMALL))
    counted, clean = silver.counted_lines(lines), silver.stg_transactions(lines)
    shared = customer_activity(counted, flag(silver.is_clean()))
    got = {r.CustomerID: r for r in shared.where("CustomerID IN ('w', 'x', 'y', 'z')").collect()}
    assert set(got) == {"w", "x", "y"}                               # z has no dated line
    x, y = got["x"], got["y"]
    assert (x.invoices, x["items"], x.products, x.country, float(x.spend)) == (3, 207, 4, "Belgium", 2510.0)
    assert (x.clean_lines, x.clean_invoices, x.clean_products, x.clean_months, x.clean_items, float(x.clean_spend)) == (3, 2, 2, 2, 203, 1305.0)
    assert (x.has_high_value_order, x.has_bulk_purchase, str(x.clean_last)) == (1, 1, "2011-02-01 00:01:00")
    assert (y.invoices, y.spend, y.clean_lines, y.clean_months) == (1, None, 0, None)

    def same(a, b):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))

    end = silver.observation_end(clean)
    assert last_clean(shared).first() == end.first()
    profiles = bronze.profiles(spark, SMALL, lines)
    same(bronze.profiles(spark, SMALL, None, end, activity=shared), profiles)
    customers = silver.stg_customers(profiles)
    same(churn.churn_features(None, customers, activity=shared), churn.churn_features(clean, customers))
    same(rfm.customer_metrics(None, activity=shared), rfm.customer_metrics(clean))

    i = Inputs(spark, SMALL, share_bronze=True)
    mart = churn.churn_features(None, i.customers, activity=i.activity)
    for df in (mart, i.customers):                                   # no line is read again
        assert "InvoiceNo" not in df._jdf.queryExecution().optimizedPlan().toString()

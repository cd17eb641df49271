"""Data tests that ride on writes, and refreshes that readers never see half done."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tillwise.operators import quality, silver
from tillwise.operators.quality import av, nn, rng, uq
from tillwise.plans import medallion
from tillwise.session import cut_lineage
from tillwise.sources import bronze as B

CHECKS = [nn("k"), uq("k"), nn("v"), rng("v", 0, 5), rng("v", 1), av("t", ["a", "b"])]


@pytest.mark.parametrize("rows", [
    [],
    [(1, 2.0, "a"), (2, 3.0, "b")],
    [(1, None, "x"), (1, -1.0, "x"), (None, 6.0, "y"), (2, float("nan"), None), (1, -1.0, "x")]])
@pytest.mark.parametrize("parts", [1, 7])
def test_watched_checks_equal_a_pass_over_the_table(spark, rows, parts):
    df = spark.createDataFrame(rows, "k long, v double, t string").repartition(parts)
    watched, seen = quality.watch(df, CHECKS)
    table = cut_lineage(watched)
    got = quality.run_checks(table, "t", CHECKS, seen)
    want = quality.run_checks(table, "t", CHECKS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.columns == want.columns
    if rows:
        assert seen.get["rows"] == len(rows)


def test_row_checks_cost_no_scan(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, -3.0, "b")], "k long, v double, t string")
    watched, seen = quality.watch(df, CHECKS)
    table = cut_lineage(watched)
    row_checks = [c for c in CHECKS if c.kind != "unique"]
    plan = quality.run_checks(table, "t", row_checks, seen)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert "FileScan" in quality.run_checks(table, "t", row_checks)._jdf.queryExecution().executedPlan().toString()


def _state(spark, names):
    return {n: sorted(map(str, spark.table(q).collect())) for n, q in names.items()}


def test_readers_never_see_a_failed_or_rejected_refresh(spark, tmp_path):
    root = str(tmp_path)
    lines = cut_lineage(B.invoice_lines(spark, SMALL))
    clean = silver.stg_transactions(lines)
    profiles = cut_lineage(B.profiles(spark, SMALL, lines, silver.observation_end(clean)))
    refresh = lambda lines, profiles, **kw: medallion.refresh(
        spark, None, root, models=False, lines=lines, profiles=profiles, **kw)

    names = refresh(lines, profiles)
    assert len(names) == 8 and len(os.listdir(root)) == 1
    before = _state(spark, names)
    assert len(before["dq_report"]) == sum(map(len, quality.SPECS.values()))

    # the write of the lines ends in the middle: some tasks have written, one fails
    broken = lines.withColumn("StockCode", F.when(F.col("InvoiceNo") == lines.agg(F.max("InvoiceNo")).first()[0],
                                                  F.raise_error(F.lit("lost the source"))).otherwise(F.col("StockCode")))
    with pytest.raises(Exception, match="lost the source"):
        refresh(broken, profiles)
    assert _state(spark, names) == before and len(os.listdir(root)) == 1

    # everything is written, but a data test fails
    wrong = profiles.withColumn("churn_label", F.lit(3).cast(profiles.schema["churn_label"].dataType))
    with pytest.raises(medallion.RefreshRejected, match="accepted_values"):
        refresh(lines, wrong)
    assert _state(spark, names) == before and len(os.listdir(root)) == 1

    # fewer lines and one more column: contents and schema follow, the previous version stays
    less = lines.where(F.crc32("InvoiceNo") % 5 > 0)
    first = os.listdir(root)[0]
    names = refresh(less.withColumn("Loaded", F.lit("today")), profiles)
    assert "Loaded" in spark.table(names["online_retail"]).columns
    assert spark.table(names["online_retail"]).count() == less.count() < len(before["online_retail"])
    assert first in os.listdir(root) and len(os.listdir(root)) == 2
    refresh(lines, profiles)
    assert first not in os.listdir(root) and len(os.listdir(root)) == 2
    assert _state(spark, names)["mart_churn_risk"] == before["mart_churn_risk"]
    for q in names.values():
        spark.sql(f"DROP VIEW {q}")

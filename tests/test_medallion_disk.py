"""What a full refresh keeps on disk while it runs."""

import os
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tillwise.operators import silver
from tillwise.plans import medallion
from tillwise.session import cut_lineage, small_disk
from tillwise.sources import bronze as B

CLEANUP, CODEC = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def _cut_tables(spark):
    """Columns of the intermediate tables that are on disk."""
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f: spark.read.parquet(os.path.join(top, f)).columns for f in os.listdir(top)
            if f.startswith("tillwise-cut-") and os.path.exists(os.path.join(top, f, "_SUCCESS"))}


def test_refresh_frees_shuffles_and_counted_lines_as_it_goes(spark, tmp_path, monkeypatch):
    settings = {k: spark.conf.get(k, None) for k in (CLEANUP, CODEC)}
    before, cuts, held, save = _shuffle_files(spark), set(_cut_tables(spark)), {}, medallion.save_table

    def seen(df, name, **kw):
        tables = _cut_tables(spark)
        held[name] = [columns for f, columns in tables.items() if f not in cuts]
        return save(df, name, **kw)

    monkeypatch.setattr(medallion, "save_table", seen)
    paths = medallion.run(spark, SMALL, str(tmp_path), models=False)
    assert any("copies" in columns for columns in held["stg_transactions"])
    for mart in ("mart_customer_segments", "mart_clv_projections", "mart_churn_risk", "dq_report"):
        assert not any("copies" in columns for columns in held[mart])
        assert any("clean_lines" in columns for columns in held[mart])    # the activity stays till the end
    assert set(_cut_tables(spark)) <= cuts

    end = time.time() + 20                        # executors delete them a little later
    while (left := _shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert {k: spark.conf.get(k, None) for k in settings} == settings

    raw = spark.read.parquet(paths["online_retail"])
    want = B.invoice_lines(spark, SMALL)
    assert raw.count() == want.count() and raw.exceptAll(want).isEmpty()
    lines = silver.stg_transactions(want)
    assert spark.read.parquet(paths["stg_transactions"]).exceptAll(lines).isEmpty()
    assert spark.read.parquet(paths["stg_transactions"]).count() == lines.count()


def test_settings_come_back_and_a_chosen_codec_stays(spark):
    try:
        spark.conf.set(CODEC, "gzip")
        spark.conf.set(CLEANUP, "false")
        with pytest.raises(ZeroDivisionError), small_disk(spark):
            assert (spark.conf.get(CODEC), spark.conf.get(CLEANUP)) == ("gzip", "true")
            raise ZeroDivisionError
        assert (spark.conf.get(CODEC), spark.conf.get(CLEANUP)) == ("gzip", "false")
    finally:
        spark.conf.unset(CODEC)
        spark.conf.unset(CLEANUP)


def test_frames_run_twice_when_their_shuffles_are_gone(spark):
    with small_disk(spark):
        grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(grouped.collect()) == sorted(grouped.collect())


@pytest.mark.parametrize("n", [1, 2, 3])
def test_shares_of_the_orders_make_the_raw_lines(spark, n):
    whole = cut_lineage(B.invoice_lines(spark, SMALL))
    parts = [cut_lineage(B.invoice_lines(spark, SMALL, share=(i, n))) for i in range(n)]
    assert sum(p.count() for p in parts) == whole.count()
    joined = parts[0]
    for p in parts[1:]:
        assert p.count() > 0
        joined = joined.unionByName(p)
    assert joined.exceptAll(whole).isEmpty() and whole.exceptAll(joined).isEmpty()


def _dirty(spark, hot):
    rows = spark.range(2000).select(
        F.concat(F.when(F.col("id") % 9 == 0, F.lit("C")).otherwise(F.lit("")), (F.col("id") % 300).cast("string")).alias("InvoiceNo"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 40).cast("string")).alias("StockCode"),
        F.when(F.col("id") % 13 > 0, F.lit("thing")).alias("Description"), (F.col("id") % 5).cast("int").alias("Quantity"),
        F.when(F.col("id") % 17 > 0, F.lit("02-01-2011 10:30")).otherwise(F.lit("?")).alias("InvoiceDate"),
        F.when(F.col("id") % 19 == 0, F.lit(-0.0)).when(F.col("id") % 19 == 1, F.lit(float("nan"))).otherwise(F.lit(1.5)).alias("UnitPrice"),
        F.when(F.col("id") % 23 > 0, F.concat(F.lit("c"), (F.col("id") % 300 % 250).cast("string"))).alias("CustomerID"), F.lit("France").alias("Country"))
    rows = rows.unionByName(rows.where(F.col("Quantity") > 2).withColumn("UnitPrice", F.when(F.col("UnitPrice") == 0, F.lit(0.0)).otherwise(F.col("UnitPrice"))))
    return rows.unionByName(rows.withColumn("CustomerID", F.lit("hot"))) if hot else rows


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("n", [1, 3])
def test_lines_dealt_by_customer_are_the_counted_lines(spark, hot, n):
    raw = cut_lineage(_dirty(spark, hot).repartition(5))
    busy = silver.busy_customers(raw, 0.1)
    assert busy == (["hot"] if hot else [])
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        parts = [cut_lineage(silver.counted_lines(raw, busy=busy, share=(i, n))) for i in range(n)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    key = lambda r: tuple(map(str, r))
    want = sorted(map(key, silver.counted_lines(raw).collect()))
    assert sorted(key(r) for p in parts for r in p.collect()) == want
    files = defaultdict(set)
    for p in parts:
        for r in p.select("CustomerID", F.input_file_name().alias("f")).distinct().collect():
            files[r.CustomerID].add(r.f)
    assert all(len(f) == 1 for c, f in files.items() if c != "hot")
    assert not hot or len(files["hot"]) > 1


def test_busy_customers_of_odd_tables(spark):
    lines = lambda ids: spark.createDataFrame([(i,) for i in ids], "CustomerID string")
    assert silver.busy_customers(lines([])) == []
    assert silver.busy_customers(lines([None, None])) == []
    assert silver.busy_customers(lines([None] * 9 + ["a"]), 0.5) == ["a"]
    many = [f"c{i}" for i in range(5000)] + ["x"] * 900 + ["y"] * 400
    assert silver.busy_customers(lines(many).repartition(7), 0.1) == ["x"]

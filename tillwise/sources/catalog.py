"""Sinks: materialise a model as a full-refresh table in its layer schema.

A table is written either into the session catalog (``saveAsTable``, schema =
layer) or, when ``root`` is given, as files under ``root/<schema>/<name>``.
Per-customer tables can be bucketed on the key so later joins on it read
co-located buckets without a shuffle.

``mode("overwrite")`` deletes a table before it writes the new one. Readers who
must never see that use ``publish``: every refresh writes files of its own, and
the catalog name, a view, is pointed at them when they are complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Default layer of each model (routing of custom schema vs target schema).
LAYERS = {
    "online_retail": "bronze", "customers_simulated": "bronze",
    "stg_transactions": "silver", "stg_customers": "silver",
    "mart_customer_segments": "gold", "mart_clv_projections": "gold", "mart_churn_risk": "gold",
    "mart_customer_segments_enriched": "gold", "cluster_mapping": "gold",
    "mart_clv_projections_enriched": "gold", "mart_churn_risk_scored": "gold",
}


def schema_for(custom_schema: str | None, target_schema: str) -> str:
    """The model's own schema when it names one, else the target schema."""
    return target_schema if custom_schema is None else custom_schema


def table_path(root: str, name: str, target_schema: str = "default") -> str:
    return f"{root.rstrip('/')}/{schema_for(LAYERS.get(name), target_schema)}/{name}"


def save_table(df: DataFrame, name: str, root: str | None = None, target_schema: str = "default",
               fmt: str = "parquet", mode: str = "overwrite", overwrite_schema: bool = True,
               partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None) -> str:
    """Full refresh of one table; returns its name or path. The write is the
    only action: the model's whole plan runs once, distributed."""
    schema = schema_for(LAYERS.get(name), target_schema)
    w = df.write.mode(mode).format(fmt)
    if overwrite_schema:
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if root is not None and bucket_by is None:
        path = table_path(root, name, target_schema)
        w.save(path)
        return path
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    if bucket_by is not None:
        n, key = bucket_by
        w = w.bucketBy(n, key).sortBy(key)
    if root is not None:
        w = w.option("path", table_path(root, name, target_schema))
    qualified = f"{schema}.{name}"
    w.saveAsTable(qualified)
    return qualified


def read_table(spark: SparkSession, name: str, root: str | None = None, target_schema: str = "default",
               fmt: str = "parquet") -> DataFrame:
    """Scan an upstream model (files under ``root`` or the catalog table)."""
    if root is not None:
        return spark.read.format(fmt).load(table_path(root, name, target_schema))
    return spark.table(f"{schema_for(LAYERS.get(name), target_schema)}.{name}")


def publish(spark: SparkSession, name: str, path: str, target_schema: str = "default", fmt: str = "parquet") -> str:
    """Point the catalog name of a model at the files under ``path``: one
    catalog operation that also replaces the schema. Queries that started before
    go on reading the files they were planned on."""
    schema = schema_for(LAYERS.get(name), target_schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    qualified = f"`{schema}`.`{name}`"
    place = path.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS SELECT * FROM {fmt}.`{place}`")
    return qualified

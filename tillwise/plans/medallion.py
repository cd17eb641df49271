"""Full refresh of every layer: bronze -> silver -> gold -> scored tables.

Each model reads its upstream model back from storage, so the silver lines
(read by three marts) are computed once, and every layer is a restart point
if executors or the driver are lost. ``run`` writes into a folder; ``refresh``
does so in a folder of its own, checks the tables and only then lets readers
see them.
"""

from __future__ import annotations

import time
import uuid
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import flag
from ..operators import churn, clustering as C, clv, modeling as M, quality, rfm, silver
from ..operators.activity import customer_activity, last_clean
from ..params import Params
from ..session import cut_lineage, delete_folder, folders_in, new_folder, prefer_hash_joins, prepare, scratch, small_disk
from ..sources import bronze as B
from ..sources.catalog import publish, read_table, save_table

# The widest shuffles (of the raw lines for their joins, of the known lines for
# their grouping) are made in so many parts, one after the other.
SHARES = 2


def run(spark: SparkSession, sf_dir: str | None, root: str, params: Params = Params(),
        models: bool = True, lines: DataFrame | None = None, profiles: DataFrame | None = None) -> dict[str, str]:
    """Write all tables under ``root``; returns table -> path.

    ``lines`` (raw invoice lines) and ``profiles`` (customer profiles) are the
    two source tables; where they are not given they are derived from the
    star-schema tables in ``sf_dir``. Intermediate tables are deleted at the
    end."""
    prefer_hash_joins(prepare(spark))
    with scratch(spark), small_disk(spark):
        return _run(spark, sf_dir, root, params, models, lines, profiles)[0]


class RefreshRejected(Exception):
    """A refresh whose tables failed their checks; nothing was published."""


def refresh(spark: SparkSession, sf_dir: str | None, root: str, params: Params = Params(), models: bool = True,
            lines: DataFrame | None = None, profiles: DataFrame | None = None, keep: int = 2) -> dict[str, str]:
    """A full refresh that readers never see half done; returns table -> catalog
    name.

    All tables are written into a new folder under ``root``. Where every data
    test passes and every table reads back with as many rows as were written,
    the catalog names are pointed at them, one after the other; else
    ``RefreshRejected`` is raised. A refresh that fails or is rejected leaves
    the names on the tables they had and deletes its folder. The newest ``keep``
    published folders stay (at least 2, so that running readers finish). One
    refresh of a ``root`` at a time."""
    prefer_hash_joins(prepare(spark))
    version = f"{root.rstrip('/')}/v{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    try:
        with scratch(spark), small_disk(spark):
            paths, seen = _run(spark, sf_dir, version, params, models, lines, profiles)
        failed = spark.read.parquet(paths["dq_report"]).where("NOT passed").collect()   # a row per data test at most
        if failed:
            raise RefreshRejected("; ".join(f"{r.table_name}.{r.column_name} {r.test_name}: {r.failures}" for r in failed))
        for name, path in paths.items():
            rows, wrote = spark.read.parquet(path).count(), seen[name].get.get("rows")
            if wrote not in (None, rows):
                raise RefreshRejected(f"{name}: {wrote} rows written, {rows} read back")
    except BaseException:
        delete_folder(spark, version)
        raise
    names = {name: publish(spark, name, path) for name, path in paths.items()}
    older = sorted(f for f in folders_in(spark, root) if f.rsplit("/", 1)[-1].startswith("v") and not version.endswith(f.rsplit("/", 1)[-1]))
    for folder in older[:max(0, len(older) - max(keep, 2) + 1)]:
        delete_folder(spark, folder)
    return names


def _run(spark, sf_dir, root, params, models, lines, profiles):
    out: dict[str, str] = {}
    seen = {}

    def save(df, name, **kw):
        watched, seen[name] = quality.watch(df, quality.SPECS.get(name, ()))
        out[name] = save_table(watched, name, root=root, **kw)
        return read_table(spark, name, root=root)

    if lines is None:
        rows = []
        for i in range(SHARES):
            raw = save(B.invoice_lines(spark, sf_dir, share=(i, SHARES)), "online_retail", mode="append" if i else "overwrite")
            rows.append(seen["online_retail"].get.get("rows"))
        seen["online_retail"] = SimpleNamespace(get={} if None in rows else {"rows": sum(rows)})
    else:
        raw = save(lines, "online_retail")
    if profiles is None:      # silver and the profiles share the deduplicated, parsed lines
        kept, busy = new_folder(spark, "cut"), silver.busy_customers(raw)
        with scratch(spark):  # the counted lines go as soon as silver and the activity are made
            path = new_folder(spark, "cut")
            for i in range(SHARES):
                counted = cut_lineage(silver.counted_lines(raw, params.cleaning, busy, (i, SHARES)), path, "append")
            activity = cut_lineage(customer_activity(counted, flag(silver.is_clean(params.cleaning)), params.churn, written=True), kept)
            lines = save(silver.clean_lines(counted, params.cleaning), "stg_transactions")
        profiles = B.profiles(spark, sf_dir, None, last_clean(activity), params.cleaning, activity=activity)
    else:
        lines, activity = save(silver.stg_transactions(raw, params.cleaning), "stg_transactions"), None
    profiles = save(profiles, "customers_simulated")
    customers = save(silver.stg_customers(profiles, params.cleaning), "stg_customers")
    segments = save(rfm.rfm_segments(lines, params.segments, activity=activity), "mart_customer_segments")
    clv_in = save(clv.clv_inputs(lines, params.clv), "mart_clv_projections")
    churn_mart = save(churn.churn_features(lines, customers, params.churn, activity), "mart_churn_risk")
    report = quality.dq_report({
        "stg_transactions": lines, "stg_customers": customers, "mart_customer_segments": segments,
        "mart_clv_projections": clv_in, "mart_churn_risk": churn_mart}, seen=seen)
    save(report, "dq_report")
    if not models:
        return out, seen
    save(clv.enriched(clv.clv_heuristic(clv_in, params.clv), params.clv), "mart_clv_projections_enriched")
    features = C.rfm_scaled(segments)
    clustered = cut_lineage(C.lloyd_assign(features, params.cluster).select("CustomerID", "cluster"))
    clustered = segments.join(clustered, "CustomerID")
    mapping = save(C.cluster_mapping(clustered), "cluster_mapping")
    save(C.enrich_segments(segments, clustered, mapping), "mart_customer_segments_enriched")
    prep = M.prepared(churn_mart, params.model)
    save(M.risk_scored(churn_mart, prep, params.model), "mart_churn_risk_scored")
    return out, seen

"""Query catalogue: data tests over the silver and gold tables."""

from __future__ import annotations


from ..operators import churn, clv, quality
from ..session import cut_lineage
from . import oracle as O
from .registry import Inputs, register

ALL_MODELS = O.with_ctes(O.BRONZE, O.SILVER, O.PROFILES, O.CUSTOMER_METRICS, O.segments_cte(True),
                         O.CLV_INPUTS, O.CHURN)


def model_tables(i: Inputs) -> tuple[dict, dict]:
    """The five tested models and what the row checks observed while four of
    them were written; the unique check reads stored rows. The clean lines are
    a filter over the written lines and checked by a pass of their own."""
    seen = {}

    def write(name, df):
        watched, seen[name] = quality.watch(df, quality.SPECS[name])
        return cut_lineage(watched)

    lines = i.silver
    customers = write("stg_customers", i.customers)
    return {
        "stg_transactions": lines,
        "stg_customers": customers,
        "mart_customer_segments": write("mart_customer_segments", i.segments),
        "mart_clv_projections": write("mart_clv_projections", clv.clv_inputs(lines)),
        "mart_churn_risk": write("mart_churn_risk", churn.churn_features(None, customers, activity=i.activity)),
    }, seen


@register("dq_report", ALL_MODELS + " " + O.dq_sql())
def q_dq_report(spark, sf_dir):
    tables, seen = model_tables(Inputs(spark, sf_dir, share_bronze=True))
    return quality.dq_report(tables, seen=seen)


@register("referential_integrity", ALL_MODELS + """
  SELECT 'mart_customer_segments' AS table_name, 'CustomerID' AS column_name, 'relationships' AS test_name,
         'stg_transactions.CustomerID' AS test_args,
         CAST(COUNT(*) AS BIGINT) AS failures, COUNT(*) = 0 AS passed
  FROM segments s WHERE s.CustomerID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM silver t WHERE t.CustomerID = s.CustomerID)
  UNION ALL
  SELECT 'mart_churn_risk', 'CustomerID', 'relationships', 'stg_customers.CustomerID',
         CAST(COUNT(*) AS BIGINT), COUNT(*) = 0
  FROM churn c WHERE c.CustomerID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_customers s WHERE s.CustomerID = c.CustomerID)
  UNION ALL
  SELECT 'stg_customers', 'CustomerID', 'relationships', 'stg_transactions.CustomerID',
         CAST(COUNT(*) AS BIGINT), COUNT(*) = 0
  FROM stg_customers c WHERE c.CustomerID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM silver t WHERE t.CustomerID = c.CustomerID)""")
def q_referential_integrity(spark, sf_dir):
    i = Inputs(spark, sf_dir, share_bronze=True)
    t, _ = model_tables(i)
    return (quality.relationships(t["mart_customer_segments"], i.silver, "CustomerID",
                                  child_name="mart_customer_segments", parent_name="stg_transactions")
            .unionByName(quality.relationships(t["mart_churn_risk"], t["stg_customers"], "CustomerID",
                                               child_name="mart_churn_risk", parent_name="stg_customers"))
            .unionByName(quality.relationships(t["stg_customers"], i.silver, "CustomerID",
                                               child_name="stg_customers", parent_name="stg_transactions")))

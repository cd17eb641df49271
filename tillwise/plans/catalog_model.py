"""Query catalogue: clustering and churn models.

Deterministic steps (feature scaling, assignment to given centroids, cluster
profiling on that assignment, imputation, split, weights, metrics of a fixed
scorer) have SQL twins, and so have K-Means (seeded by hashes, see ``lloyd``)
and logistic regression (Newton's method, see ``newton``), whose twins run the
same iterations as recursive SQL. The random forest and Spark ML's solvers get
the rows-only check.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import functions as F

from ..operators import churn, clustering as C, evaluation as E, forest as FO, modeling as M
from ..params import ModelParams
from ..session import cut_lineage, forget_at_exit, new_folder
from ..sources.catalog import read_table, save_table
from . import oracle as O
from .catalog import NULLABLE_BEHAVIOUR, as_double, sql_as_double
from .registry import REGISTRY, Inputs, register

P = ModelParams()

# ---------------------------------------------------------------- clustering

SEG_CHAIN = (O.BRONZE, O.SILVER, O.CUSTOMER_METRICS, O.segments_cte(True))
FEAT = """
feat_base AS (
  SELECT CustomerID, recency_days, frequency, monetary, business_priority, customer_segment, rfm_score,
    ln(1 + CAST(recency_days AS DOUBLE)) AS recency_log, ln(1 + CAST(frequency AS DOUBLE)) AS frequency_log,
    ln(1 + CAST(monetary AS DOUBLE)) AS monetary_log
  FROM segments WHERE recency_days IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL
),
feat_stats AS (
  SELECT avg(recency_log) AS mr, stddev_pop(recency_log) AS sr, avg(frequency_log) AS mf,
    stddev_pop(frequency_log) AS sf, avg(monetary_log) AS mm, stddev_pop(monetary_log) AS sm FROM feat_base
),
feat AS (
  SELECT b.*,
    CASE WHEN sr = 0 THEN 0.0 ELSE (recency_log - mr) / sr END AS recency_log_z,
    CASE WHEN sf = 0 THEN 0.0 ELSE (frequency_log - mf) / sf END AS frequency_log_z,
    CASE WHEN sm = 0 THEN 0.0 ELSE (monetary_log - mm) / sm END AS monetary_log_z
  FROM feat_base b CROSS JOIN feat_stats
),
cents AS (
  SELECT business_priority, avg(recency_log_z) AS c0, avg(frequency_log_z) AS c1, avg(monetary_log_z) AS c2,
    CAST(ROW_NUMBER() OVER (ORDER BY business_priority) - 1 AS INTEGER) AS cluster
  FROM feat GROUP BY business_priority
),
assigned AS (
  SELECT CustomerID, cluster FROM (
    SELECT f.CustomerID, c.cluster,
      ROW_NUMBER() OVER (PARTITION BY f.CustomerID ORDER BY
        (f.recency_log_z - c.c0) * (f.recency_log_z - c.c0) + (f.frequency_log_z - c.c1) * (f.frequency_log_z - c.c1)
        + (f.monetary_log_z - c.c2) * (f.monetary_log_z - c.c2), c.cluster) AS rn
    FROM feat f CROSS JOIN cents c) WHERE rn = 1
),
clustered AS (SELECT s.*, a.cluster FROM segments s JOIN assigned a USING (CustomerID))"""
FEAT_SQL = O.with_ctes(*SEG_CHAIN, FEAT)


def _segments(i: Inputs):
    return i.segments


def _features(i: Inputs, segments=None):
    return C.rfm_scaled(segments if segments is not None else _segments(i))


def _fixed_clusters(i: Inputs):
    seg = _segments(i)
    feats = _features(i, seg).join(seg.select("CustomerID", "business_priority"), "CustomerID")
    assigned = C.assign_to_centroids(feats, C.centroids_by_group(feats, "business_priority"))
    return seg, seg.join(assigned.select("CustomerID", "cluster"), "CustomerID")


def _kmeans_clusters(i: Inputs):
    seg = _segments(i)
    assigned = cut_lineage(C.lloyd_assign(_features(i, seg)))
    return seg, seg.join(assigned.select("CustomerID", "cluster"), "CustomerID")


@register("rfm_scaled", FEAT_SQL + """
  SELECT CustomerID, recency_days, frequency, monetary,
    ROUND(recency_log, 6) AS recency_log, ROUND(frequency_log, 6) AS frequency_log, ROUND(monetary_log, 6) AS monetary_log,
    ROUND(recency_log_z, 6) AS recency_log_z, ROUND(frequency_log_z, 6) AS frequency_log_z,
    ROUND(monetary_log_z, 6) AS monetary_log_z
  FROM feat""")
def q_rfm_scaled(spark, sf_dir):
    return C.rounded_features(_features(Inputs(spark, sf_dir)))


@register("kmeans_assign_fixed", FEAT_SQL + " SELECT CustomerID, cluster FROM assigned")
def q_kmeans_assign_fixed(spark, sf_dir):
    return _fixed_clusters(Inputs(spark, sf_dir))[1].select("CustomerID", "cluster")


_PROFILE_SQL = """
  , base AS (SELECT cluster, CAST(COUNT(*) AS BIGINT) AS customers,
      ROUND(AVG(recency_days), 6) AS recency_days_mean, ROUND(AVG(frequency), 6) AS frequency_mean,
      ROUND(AVG(monetary), 6) AS monetary_mean, ROUND(AVG(rfm_score), 6) AS rfm_score_mean,
      ROUND(quantile_cont(recency_days, 0.5), 6) AS recency_days_median,
      ROUND(quantile_cont(frequency, 0.5), 6) AS frequency_median,
      ROUND(quantile_cont(monetary, 0.5), 6) AS monetary_median,
      ROUND(quantile_cont(rfm_score, 0.5), 6) AS rfm_score_median
    FROM clustered GROUP BY cluster),
  modes AS (SELECT cluster, customer_segment AS segment_mode FROM (
      SELECT cluster, customer_segment, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, customer_segment) AS rn
      FROM clustered GROUP BY cluster, customer_segment) WHERE rn = 1)
  SELECT * FROM base JOIN modes USING (cluster)"""


@register("cluster_profile_fixed", FEAT_SQL + _PROFILE_SQL)
def q_cluster_profile_fixed(spark, sf_dir):
    return C.cluster_profile(_fixed_clusters(Inputs(spark, sf_dir))[1])


_MAPPING_SQL = """
  , means AS (SELECT cluster, AVG(recency_days) AS r, AVG(frequency) AS f, AVG(monetary) AS m FROM clustered GROUP BY cluster),
  mapping AS (SELECT CAST(cluster AS BIGINT) AS cluster_id,
      CASE WHEN r < 30 AND f > 10 AND m > 2000 THEN 'Champions'
           WHEN r < 60 AND f > 5 AND m > 1000 THEN 'Loyal Customers'
           WHEN r > 90 AND f > 5 AND m > 1000 THEN 'At Risk'
           WHEN r > 120 AND f <= 3 THEN 'Lost / Dormant'
           ELSE 'Average' END AS cluster_name FROM means)"""


@register("cluster_mapping_fixed", FEAT_SQL + _MAPPING_SQL + " SELECT * FROM mapping")
def q_cluster_mapping_fixed(spark, sf_dir):
    return C.cluster_mapping(_fixed_clusters(Inputs(spark, sf_dir))[1])


@register("mapping_schema_replaced", REGISTRY["cluster_mapping_fixed"].sql)
def q_mapping_schema_replaced(spark, sf_dir):
    """The cluster mapping saved twice: a first version with fewer columns is
    replaced, schema included, by the full one, which is read back."""
    root = new_folder(spark, "mapping")
    mapping = cut_lineage(C.cluster_mapping(_fixed_clusters(Inputs(spark, sf_dir))[1]))
    save_table(mapping.select(mapping.columns[0]), "cluster_mapping", root=root)
    save_table(mapping, "cluster_mapping", root=root)
    forget_at_exit(spark, root)
    return read_table(spark, "cluster_mapping", root=root)


@register("cluster_shares_fixed", FEAT_SQL + _MAPPING_SQL + f""",
  enriched AS (SELECT c.*, m.cluster_name AS cluster_business_name FROM clustered c
               LEFT JOIN mapping m ON CAST(c.cluster AS BIGINT) = m.cluster_id)
  SELECT cluster, cluster_business_name, CAST(COUNT(*) AS BIGINT) AS customers,
    {O.half_up('COUNT(*) * 10000', 'SUM(COUNT(*)) OVER ()')} AS customer_pct,
    CAST(SUM(CAST(monetary AS DECIMAL(22,2))) AS DOUBLE) AS revenue,
    {O.half_up(O.cents('SUM(CAST(monetary AS DECIMAL(22,2)))') + ' * 10000',
               O.cents('SUM(SUM(CAST(monetary AS DECIMAL(22,2)))) OVER ()'))} AS revenue_pct,
    ROUND(AVG(monetary), 2) AS avg_monetary, ROUND(AVG(recency_days), 2) AS avg_recency,
    ROUND(AVG(frequency), 2) AS avg_frequency
  FROM enriched GROUP BY cluster, cluster_business_name""")
def q_cluster_shares_fixed(spark, sf_dir):
    seg, clustered = _fixed_clusters(Inputs(spark, sf_dir))
    enriched = C.enrich_segments(seg, clustered, C.cluster_mapping(clustered))
    return C.cluster_shares(enriched)


@register("enriched_segments_fixed", FEAT_SQL + _MAPPING_SQL + """
  SELECT c.*, concat('Cluster ', CAST(c.cluster AS VARCHAR)) AS cluster_label, m.cluster_name AS cluster_business_name
  FROM clustered c LEFT JOIN mapping m ON CAST(c.cluster AS BIGINT) = m.cluster_id""")
def q_enriched_segments_fixed(spark, sf_dir):
    """The enriched segments table, on the assignment to fixed centroids."""
    seg, clustered = _fixed_clusters(Inputs(spark, sf_dir))
    return C.enrich_segments(seg, clustered, C.cluster_mapping(clustered))


@register("kmeans_step_fixed", FEAT_SQL + """
  SELECT a.cluster, CAST(COUNT(*) AS BIGINT) AS customers,
    ROUND(SUM((f.recency_log_z - c.c0) ** 2 + (f.frequency_log_z - c.c1) ** 2 + (f.monetary_log_z - c.c2) ** 2), 6) AS cost,
    ROUND(AVG(f.recency_log_z), 6) AS recency_log_z_new, ROUND(AVG(f.frequency_log_z), 6) AS frequency_log_z_new,
    ROUND(AVG(f.monetary_log_z), 6) AS monetary_log_z_new
  FROM assigned a JOIN feat f USING (CustomerID) JOIN cents c ON c.cluster = a.cluster GROUP BY a.cluster""")
def q_kmeans_step_fixed(spark, sf_dir):
    """One K-Means update and its cost from fixed centroids."""
    i = Inputs(spark, sf_dir)
    seg = _segments(i)
    feats = _features(i, seg).join(seg.select("CustomerID", "business_priority"), "CustomerID")
    cents = cut_lineage(C.centroids_by_group(feats, "business_priority"))
    return C.lloyd_step(C.assign_to_centroids(feats, cents), cents)


KP = C.ClusterParams()


def _distance(p: str, c: str) -> str:
    return " + ".join(f"({p}.x{j} - {c}.x{j}) * ({p}.x{j} - {c}.x{j})" for j in range(3))


def kmeans_sql(ks: str) -> str:
    """All restarts of K-Means for the K in ``ks``: k-means++ by a race of
    hashed numbers, Lloyd's steps as a recursion, the best run per K with its
    clusters numbered by centroid."""
    return FEAT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
  , pts AS (SELECT CustomerID AS key, recency_log_z AS x0, frequency_log_z AS x1, monetary_log_z AS x2 FROM feat),
  restarts AS (SELECT CAST(r AS INTEGER) AS r FROM range({KP.restarts}) t(r)),
  firsts AS (SELECT r, [arg_min({{'x0': x0, 'x1': x1, 'x2': x2}}, {{'h': h, 'key': key}})] AS cs FROM (
      SELECT r, p.*, CAST('0x' || substr(md5(key || '|' || ({KP.seed} + r) || '|0'), 1, 8) AS BIGINT) AS h FROM pts p CROSS JOIN restarts) GROUP BY r),
  sequence AS (
    SELECT r, 1 AS t, cs FROM firsts
    UNION ALL
    SELECT r, t + 1, list_append(cs, arg_min({{'x0': x0, 'x1': x1, 'x2': x2}}, {{'race': -ln((h + 0.5) / 4294967296.0) / d, 'key': key}})) FROM (
      SELECT s.r, s.t, s.cs, p.*, CAST('0x' || substr(md5(key || '|' || ({KP.seed} + s.r) || '|' || s.t), 1, 8) AS BIGINT) AS h,
        list_min(list_transform(s.cs, lambda c: {_distance('p', 'c')})) AS d
      FROM sequence s CROSS JOIN pts p WHERE s.t < {KP.k_max})
    WHERE d > 0 GROUP BY r, t, cs),
  starts AS (SELECT CAST(k AS INTEGER) AS k, r, cs[:k] AS cs FROM (SELECT unnest({ks}) AS k) CROSS JOIN sequence WHERE t = {KP.k_max}),
  steps AS (
    SELECT k, r, 0 AS it, TRUE AS live, cs FROM starts
    UNION ALL
    SELECT k, r, it + 1, moved > 1e-9 AND it < {KP.max_iter}, CASE WHEN moved > 1e-9 THEN fresh ELSE cs END FROM (
      SELECT *, list_max(list_transform(list_zip(cs, fresh), lambda z: greatest(abs(z[1].x0 - z[2].x0), abs(z[1].x1 - z[2].x1), abs(z[1].x2 - z[2].x2)))) AS moved
      FROM (SELECT k, r, it, cs, list_transform(range(1, k + 1), lambda i: coalesce(list_filter(found, lambda f: f.c = i)[1].x, cs[i])) AS fresh
        FROM (SELECT k, r, it, cs, list({{'c': c, 'x': {{'x0': m0, 'x1': m1, 'x2': m2}}}}) AS found
          FROM (SELECT k, r, it, cs, c, avg(x0) AS m0, avg(x1) AS m1, avg(x2) AS m2
            FROM (SELECT k, r, it, cs, x0, x1, x2, list_position(ds, list_min(ds)) AS c
              FROM (SELECT s.k, s.r, s.it, s.cs, p.x0, p.x1, p.x2, list_transform(s.cs, lambda c: {_distance('p', 'c')}) AS ds
                    FROM steps s CROSS JOIN pts p WHERE s.live))
            GROUP BY k, r, it, cs, c)
          GROUP BY k, r, it, cs)))),
  ended AS (SELECT k, r, list_sort(cs) AS cs FROM steps WHERE NOT live),
  members AS (SELECT k, r, key, x0, x1, x2, list_position(ds, list_min(ds)) - 1 AS cluster, list_min(ds) AS d2, ds
    FROM (SELECT e.k, e.r, p.*, list_transform(e.cs, lambda c: {_distance('p', 'c')}) AS ds FROM ended e CROSS JOIN pts p)),
  best AS (SELECT k, r, inertia FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY ROUND(inertia, 9), r) AS rn
      FROM (SELECT k, r, SUM(d2) AS inertia FROM members GROUP BY k, r)) WHERE rn = 1),
  won AS (SELECT m.* FROM members m JOIN best USING (k, r))"""


@register("kmeans_sweep", kmeans_sql(f"range({KP.k_min}, {KP.k_max + 1})") + """,
  size AS (SELECT k, list({'n': n, 'v': v} ORDER BY cluster) AS st FROM (
      SELECT k, cluster, COUNT(*) AS n, AVG(d2) AS v FROM won GROUP BY k, cluster) GROUP BY k),
  sil AS (SELECT k, AVG(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
      SELECT w.k, st[cluster + 1].n AS n, (d2 + st[cluster + 1].v) * st[cluster + 1].n / (st[cluster + 1].n - 1.0) AS a,
        list_min(list_transform(list_filter(range(1, w.k + 1), lambda i: i <> cluster + 1), lambda i: ds[i] + st[i].v)) AS b
      FROM won w JOIN size USING (k)) GROUP BY k)
  SELECT k, ROUND(inertia, 6) AS inertia, ROUND(silhouette, 6) AS silhouette,
    ROW_NUMBER() OVER (ORDER BY ROUND(silhouette, 6) DESC, k) = 1 AS is_best
  FROM best JOIN sil USING (k)""")
def q_kmeans_sweep(spark, sf_dir):
    """Inertia and silhouette for every K, ten restarts each, one job a step."""
    return C.lloyd_sweep(_features(Inputs(spark, sf_dir)), KP)


KMEANS_SQL = (kmeans_sql(f"[{KP.k}]")
              + ", kmeans_clusters AS (SELECT s.*, CAST(w.cluster AS INTEGER) AS cluster FROM segments s JOIN won w ON w.key = s.CustomerID)")


def _on_kmeans(sql: str) -> str:
    """The statement of a query on fixed centroids, on the K-Means clusters."""
    return KMEANS_SQL + sql.replace("FROM clustered", "FROM kmeans_clusters")


@register("kmeans_segments", _on_kmeans(_MAPPING_SQL + """
  SELECT c.*, concat('Cluster ', CAST(c.cluster AS VARCHAR)) AS cluster_label, m.cluster_name AS cluster_business_name
  FROM clustered c LEFT JOIN mapping m ON CAST(c.cluster AS BIGINT) = m.cluster_id"""))
def q_kmeans_segments(spark, sf_dir):
    seg, clustered = _kmeans_clusters(Inputs(spark, sf_dir))
    return C.enrich_segments(seg, clustered, C.cluster_mapping(clustered))


@register("cluster_profile", _on_kmeans(_PROFILE_SQL))
def q_cluster_profile(spark, sf_dir):
    return C.cluster_profile(_kmeans_clusters(Inputs(spark, sf_dir))[1])


@register("cluster_mapping", _on_kmeans(_MAPPING_SQL + " SELECT * FROM mapping"))
def q_cluster_mapping(spark, sf_dir):
    return C.cluster_mapping(_kmeans_clusters(Inputs(spark, sf_dir))[1])


@register("cluster_shares", _on_kmeans(REGISTRY["cluster_shares_fixed"].sql.removeprefix(FEAT_SQL)))
def q_cluster_shares(spark, sf_dir):
    seg, clustered = _kmeans_clusters(Inputs(spark, sf_dir))
    return C.cluster_shares(C.enrich_segments(seg, clustered, C.cluster_mapping(clustered)))


SILHOUETTE_SAMPLE = 4000


@register("silhouette_exact", FEAT_SQL + f"""
  , drawn AS (SELECT a.cluster, f.recency_log_z AS x0, f.frequency_log_z AS x1, f.monetary_log_z AS x2, f.CustomerID AS key
      FROM feat f JOIN assigned a USING (CustomerID) ORDER BY md5(f.CustomerID || '|42'), f.CustomerID LIMIT {SILHOUETTE_SAMPLE}),
  size AS (SELECT cluster, COUNT(*) AS n FROM drawn GROUP BY cluster),
  per AS (SELECT a.key, a.cluster AS own, b.cluster, SUM(sqrt((a.x0 - b.x0) ** 2 + (a.x1 - b.x1) ** 2 + (a.x2 - b.x2) ** 2)) AS d
      FROM drawn a CROSS JOIN drawn b GROUP BY a.key, a.cluster, b.cluster),
  ab AS (SELECT key, any_value(o.n) AS n, SUM(d) FILTER (p.cluster = own) / greatest(any_value(o.n) - 1, 1) AS a, MIN(d / s.n) FILTER (p.cluster <> own) AS b
      FROM per p JOIN size s ON s.cluster = p.cluster JOIN size o ON o.cluster = p.own GROUP BY key)
  SELECT (SELECT COUNT(*) FROM feat) AS customers, COUNT(*) AS sampled,
    ROUND(AVG(CASE WHEN n = 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab""")
def q_silhouette_exact(spark, sf_dir):
    """Euclidean silhouette of the assignment to fixed centroids, from all
    pairs of at most 4,000 hashed customers."""
    i = Inputs(spark, sf_dir)
    feats = _features(i).join(_segments(i).select("CustomerID", "business_priority"), "CustomerID")
    return C.silhouette_exact(C.assign_to_centroids(feats, C.centroids_by_group(feats, "business_priority")), SILHOUETTE_SAMPLE)


# ---------------------------------------------------------------- churn models

FEATS = M.FEATURES
_TEST = Fraction(1) - Fraction(str(P.train_fraction))
CHURN_CHAIN = (O.BRONZE, O.SILVER, O.PROFILES, O.CHURN)
MODEL_INPUT = f"""
ts_base AS (SELECT CustomerID, CAST(churn_label AS INTEGER) AS churn_label,
    {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS)} FROM churn),
ts_med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in FEATS)} FROM ts_base),
training_set AS (SELECT CustomerID, churn_label, {", ".join(f"COALESCE({c}, med_{c}) AS {c}" for c in FEATS)}
    FROM ts_base CROSS JOIN ts_med),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY churn_label ORDER BY md5(CustomerID || '|{P.seed}'), CustomerID) - 1 AS pos,
    COUNT(*) OVER (PARTITION BY churn_label) AS nc FROM training_set),
split AS (SELECT * EXCLUDE (pos, nc), pos < nc - (nc * {_TEST.numerator} + {_TEST.denominator - 1}) // {_TEST.denominator} AS is_train,
    CASE WHEN pos < nc - (nc * {_TEST.numerator} + {_TEST.denominator - 1}) // {_TEST.denominator}
         THEN CAST(pos % {P.folds} AS INTEGER) END AS fold FROM ranked),
weights AS (SELECT churn_label, CAST(COUNT(*) AS BIGINT) AS class_count,
    CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (2 * CAST(COUNT(*) AS DOUBLE)) AS weight
    FROM split WHERE is_train GROUP BY churn_label),
zstats AS (SELECT {", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in FEATS)} FROM split WHERE is_train),
prepared AS (SELECT s.*, w.weight,
    {", ".join(f"CASE WHEN std_{c} = 0 THEN 0.0 ELSE ({c} - mean_{c}) / std_{c} END AS {c}_z" for c in FEATS)}
    FROM split s JOIN weights w USING (churn_label) CROSS JOIN zstats),
baseline AS (SELECT CustomerID, churn_label AS label, is_train,
    ROUND(1.0 / (1.0 + exp(engagement_score_z)), 9) AS score FROM prepared),
test_scores AS (SELECT label, score FROM baseline WHERE NOT is_train)"""
MODEL_SQL = O.with_ctes(*CHURN_CHAIN, MODEL_INPUT)


def _mart(i: Inputs):
    return cut_lineage(churn.churn_features(None, i.customers, activity=i.activity))  # read more than once by the models


def _prepared(i: Inputs):
    return M.prepared(_mart(i), P)


def _baseline_test(i: Inputs):
    return M.baseline_scores(M.standardised(_mart(i), P)).where(~F.col("is_train")).select("label", "score")


@register("churn_training_set", MODEL_SQL + " SELECT * FROM training_set")
def q_churn_training_set(spark, sf_dir):
    return M.training_set(_mart(Inputs(spark, sf_dir, share_bronze=True)))


# ``fold`` is NULL for test rows: reported as DOUBLE on both engines (see
# catalog.NULLABLE_BEHAVIOUR for why).
@register("stratified_split", MODEL_SQL + " SELECT CustomerID, churn_label, is_train, CAST(fold AS DOUBLE) AS fold FROM split")
def q_stratified_split(spark, sf_dir):
    ts = M.training_set(_mart(Inputs(spark, sf_dir, share_bronze=True)))
    return E.stratified_split(ts, M.LABEL, M.KEY, P.seed, P.train_fraction, P.folds).select(
        "CustomerID", "churn_label", "is_train", F.col("fold").cast("double").alias("fold"))


@register("class_weights", MODEL_SQL + " SELECT * FROM weights")
def q_class_weights(spark, sf_dir):
    ts = M.training_set(_mart(Inputs(spark, sf_dir, share_bronze=True)))
    split = E.stratified_split(ts, M.LABEL, M.KEY, P.seed, P.train_fraction, P.folds)
    return E.class_weight_table(split.where("is_train"), M.LABEL)


@register("churn_model_input", MODEL_SQL + f"""
  SELECT CustomerID, churn_label, is_train, CAST(fold AS DOUBLE) AS fold, weight,
    {", ".join(f"ROUND({c}_z, 6) AS {c}_z" for c in FEATS)}
  FROM prepared""")
def q_churn_model_input(spark, sf_dir):
    prep = _prepared(Inputs(spark, sf_dir, share_bronze=True))
    return prep.select("CustomerID", "churn_label", "is_train", F.col("fold").cast("double").alias("fold"), "weight",
                       *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in FEATS])


@register("baseline_scores", MODEL_SQL + " SELECT * FROM baseline")
def q_baseline_scores(spark, sf_dir):
    return M.baseline_scores(M.standardised(_mart(Inputs(spark, sf_dir, share_bronze=True)), P))


@register("confusion_metrics", MODEL_SQL + """
  , c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp, COUNT(*) FILTER (WHERE label <> 1 AND score > 0.5) AS fp,
                 COUNT(*) FILTER (WHERE label <> 1 AND NOT score > 0.5) AS tn, COUNT(*) FILTER (WHERE label = 1 AND NOT score > 0.5) AS fn
          FROM test_scores)
  SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
    ROUND(CAST(tp + tn AS DOUBLE) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS accuracy,
    ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END, 6) AS precision,
    ROUND(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END, 6) AS recall,
    ROUND(CASE WHEN tp = 0 THEN 0.0 ELSE 2 * CAST(tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1
  FROM c""")
def q_confusion_metrics(spark, sf_dir):
    return E.confusion_metrics(_baseline_test(Inputs(spark, sf_dir, share_bronze=True)), "label", "score", P.threshold)


@register("classification_report", MODEL_SQL + """
  , c AS (SELECT CAST(COUNT(*) FILTER (WHERE label = 1 AND score > 0.5) AS DOUBLE) AS tp,
                 CAST(COUNT(*) FILTER (WHERE label <> 1 AND score > 0.5) AS DOUBLE) AS fp,
                 CAST(COUNT(*) FILTER (WHERE label <> 1 AND NOT score > 0.5) AS DOUBLE) AS tn,
                 CAST(COUNT(*) FILTER (WHERE label = 1 AND NOT score > 0.5) AS DOUBLE) AS fn FROM test_scores),
  b AS (SELECT 0 AS cls, 'Active' AS class_name, tn AS t, fn AS f_p, fp AS f_n FROM c
        UNION ALL SELECT 1, 'Churned', tp, fp, fn FROM c)
  SELECT CAST(cls AS INTEGER) AS class, class_name,
    ROUND(CASE WHEN t + f_p = 0 THEN 0.0 ELSE t / (t + f_p) END, 6) AS precision,
    ROUND(CASE WHEN t + f_n = 0 THEN 0.0 ELSE t / (t + f_n) END, 6) AS recall,
    ROUND(CASE WHEN t = 0 THEN 0.0 ELSE 2 * t / (2 * t + f_p + f_n) END, 6) AS f1,
    CAST(t + f_n AS BIGINT) AS support
  FROM b""")
def q_classification_report(spark, sf_dir):
    return E.classification_report(_baseline_test(Inputs(spark, sf_dir, share_bronze=True)), "label", "score", P.threshold)


@register("auc_rank", MODEL_SQL + """
  , g AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg, COUNT(*) AS c FROM test_scores GROUP BY score),
  r AS (SELECT *, SUM(c) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum FROM g)
  SELECT ROUND((SUM(pos * (cum - CAST(c - 1 AS DOUBLE) / 2)) - CAST(SUM(pos) AS DOUBLE) * (CAST(SUM(pos) AS DOUBLE) + 1) / 2)
               / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 9) AS auc,
    CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
  FROM r""")
def q_auc_rank(spark, sf_dir):
    return E.auc_rank(_baseline_test(Inputs(spark, sf_dir, share_bronze=True)))


@register("roc_pr_points", MODEL_SQL + """
  , g AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM test_scores GROUP BY score),
  r AS (SELECT score, SUM(pos) OVER w AS tps, SUM(neg) OVER w AS fps, SUM(pos) OVER () AS P, SUM(neg) OVER () AS N
        FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
  SELECT score AS threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps,
    ROUND(CASE WHEN N = 0 THEN 0.0 ELSE CAST(fps AS DOUBLE) / CAST(N AS DOUBLE) END, 9) AS fpr,
    ROUND(CASE WHEN P = 0 THEN 0.0 ELSE CAST(tps AS DOUBLE) / CAST(P AS DOUBLE) END, 9) AS tpr,
    ROUND(CAST(tps AS DOUBLE) / CAST(tps + fps AS DOUBLE), 9) AS precision,
    ROUND(CASE WHEN P = 0 THEN 0.0 ELSE CAST(tps AS DOUBLE) / CAST(P AS DOUBLE) END, 9) AS recall
  FROM r
  UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, 0.0, 0.0, 1.0, 0.0""")
def q_roc_pr_points(spark, sf_dir):
    return E.curve_points(_baseline_test(Inputs(spark, sf_dir, share_bronze=True)))


_BASE_RISK = """
  , scored AS (SELECT c.*, b.score AS churn_risk_score,
      CASE WHEN b.score >= 0.8 THEN 'Critical Risk (80%+)' WHEN b.score >= 0.6 THEN 'High Risk (60-80%)'
           WHEN b.score >= 0.4 THEN 'Medium Risk (40-60%)' WHEN b.score >= 0.2 THEN 'Low Risk (20-40%)'
           ELSE 'Safe (<20%)' END AS risk_tier
    FROM churn c LEFT JOIN baseline b USING (CustomerID))"""


def _baseline_scored(i: Inputs):
    mart = _mart(i)
    s = M.baseline_scores(M.standardised(mart, P)).select("CustomerID", F.col("score").alias("churn_risk_score"))
    from ..functions import rules
    return mart.join(s, "CustomerID", "left").withColumn("risk_tier", rules.risk_tier(F.col("churn_risk_score")))


@register("risk_summary_baseline", MODEL_SQL + _BASE_RISK + """
  SELECT risk_tier, CAST(COUNT(*) AS BIGINT) AS customers,
    CAST(SUM(CAST(total_spend AS DECIMAL(22,2))) AS DOUBLE) AS total_spend,
    ROUND(AVG(churn_risk_score), 6) AS churn_risk_score_mean,
    CAST(SUM(CAST(monthly_fee AS DECIMAL(22,2))) AS DOUBLE) AS monthly_fee
  FROM scored GROUP BY risk_tier""")
def q_risk_summary_baseline(spark, sf_dir):
    return M.risk_summary(_baseline_scored(Inputs(spark, sf_dir, share_bronze=True)))


@register("at_risk_exposure_baseline", MODEL_SQL + _BASE_RISK + """
  , per AS (SELECT risk_tier, COUNT(*) AS customers, SUM(CAST(total_spend AS DECIMAL(22,2))) AS spend,
              SUM(CAST(monthly_fee AS DECIMAL(22,2))) AS fee
            FROM scored WHERE risk_tier IN ('Critical Risk (80%+)', 'High Risk (60-80%)') GROUP BY risk_tier),
  allr AS (SELECT * FROM per UNION ALL SELECT 'Critical + High', SUM(customers), SUM(spend), SUM(fee) FROM per)
  SELECT risk_tier, CAST(COALESCE(customers, 0) AS BIGINT) AS customers,
    ROUND(CAST(customers AS DOUBLE) / CAST((SELECT COUNT(*) FROM scored) AS DOUBLE) * 100, 1) AS customer_pct,
    CAST(COALESCE(spend, 0) AS DOUBLE) AS total_spend, CAST(COALESCE(fee, 0) AS DOUBLE) AS monthly_fee,
    CAST(COALESCE(fee, 0) * 12 AS DOUBLE) AS annual_fee_at_risk
  FROM allr""")
def q_at_risk_exposure_baseline(spark, sf_dir):
    return M.at_risk_exposure(_baseline_scored(Inputs(spark, sf_dir, share_bronze=True)))


# A fixed logistic model (our constants): the scoring path without a solver.
FIXED_COEFFICIENTS = (-0.9, -0.2, 0.15, 0.1, -1.1, 0.05, -0.1, 0.2, 0.3, -0.25, 0.12, -0.4, 0.08, -0.35)
FIXED_INTERCEPT = 0.25
_FIXED_RISK = """
  , fixed AS (SELECT CustomerID, ROUND(1.0 / (1.0 + exp(-(""" + f"CAST({FIXED_INTERCEPT} AS DOUBLE)" + "".join(
    f" + CAST({w} AS DOUBLE) * {c}_z" for c, w in zip(FEATS, FIXED_COEFFICIENTS)) + """))), 9) AS churn_risk_score FROM prepared),
  fixed_scored AS (SELECT c.CustomerID, c.total_spend, c.monthly_fee, f.churn_risk_score,
      (['Safe (<20%)', 'Low Risk (20-40%)', 'Medium Risk (40-60%)', 'High Risk (60-80%)', 'Critical Risk (80%+)'])[
        1 + len(list_filter([0.2, 0.4, 0.6, 0.8], lambda e: f.churn_risk_score >= e))] AS risk_tier
    FROM churn c JOIN fixed f USING (CustomerID))"""


@register("risk_scored_fixed", MODEL_SQL + _FIXED_RISK + " SELECT * FROM fixed_scored")
def q_risk_scored_fixed(spark, sf_dir):
    """Scored customers and risk tiers under the fixed logistic model."""
    from ..functions import rules
    mart = _mart(Inputs(spark, sf_dir, share_bronze=True))
    s = M.linear_scores(M.prepared(mart, P), FIXED_COEFFICIENTS, FIXED_INTERCEPT)
    return (mart.select("CustomerID", "total_spend", "monthly_fee")
                .join(s.select("CustomerID", F.col("score").alias("churn_risk_score")), "CustomerID")
                .withColumn("risk_tier", rules.risk_tier(F.col("churn_risk_score"))))


@register("driver_ranking_fixed", MODEL_SQL + ", gaps AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG({c}_z) FILTER (churn_label = 1) - AVG({c}_z) FILTER (churn_label = 0), 6) AS value "
    "FROM prepared WHERE is_train" for c in FEATS) + """)
  SELECT 'gap' AS model, feature, value, abs(value) AS abs_value, CASE WHEN value > 0 THEN 'risk' ELSE 'retention' END AS direction,
    CAST(ROW_NUMBER() OVER (ORDER BY abs(value) DESC, feature) AS INTEGER) AS rank FROM gaps""")
def q_driver_ranking_fixed(spark, sf_dir):
    """All features ranked as drivers, by the gap between class means."""
    return M.rank_drivers(M.class_gaps(_prepared(Inputs(spark, sf_dir, share_bronze=True))))


_SIZE = len(FEATS) + 1
NEWTON_SQL = MODEL_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
  , lr_rows AS (SELECT CAST(churn_label AS DOUBLE) AS y, weight AS w, fold, [CAST(1.0 AS DOUBLE), {", ".join(f"{c}_z" for c in FEATS)}] AS x
      FROM prepared WHERE is_train),
  models AS (SELECT CAST(m AS INTEGER) AS m FROM range(-1, {P.folds}) t(m)),
  newton AS (
    SELECT m, 0 AS it, list_transform(range({_SIZE}), lambda i: CAST(0 AS DOUBLE)) AS beta FROM models
    UNION ALL
    SELECT m, it + 1, list_transform(beta, lambda b, i: b - list_reduce(
        list_prepend({{'p': CAST(0 AS BIGINT), 'm': a}}, list_transform(range(1, {_SIZE + 1}), lambda p: {{'p': p, 'm': CAST([] AS DOUBLE[][])}})),
        lambda s, n: {{'p': n.p, 'm': list_transform(s.m, lambda v, k: CASE WHEN k = n.p THEN list_transform(v, lambda e: e / s.m[n.p][n.p])
          ELSE list_transform(v, lambda e, j: e - v[n.p] * s.m[n.p][j] / s.m[n.p][n.p]) END)}}).m[i][{_SIZE + 1}])
    FROM (SELECT m, it, beta, list(v ORDER BY i) AS a
      FROM (SELECT m, it, beta, i, list(v ORDER BY j) AS v
        FROM (SELECT m, it, beta, i, j, {P.lr_c} * SUM(CASE WHEN j <= {_SIZE} THEN w * p * (1 - p) * x[i] * x[j] ELSE w * (p - y) * x[i] END)
                + CASE WHEN i = 1 THEN 0 WHEN j = i THEN 1 WHEN j > {_SIZE} THEN beta[i] ELSE 0 END AS v
          FROM (SELECT n.m, n.it, n.beta, r.x, r.w, r.y, 1 / (1 + exp(-list_dot_product(n.beta, r.x))) AS p
                FROM newton n JOIN lr_rows r ON n.m = -1 OR r.fold <> n.m WHERE n.it < 14)
          CROSS JOIN range(1, {_SIZE + 1}) ti(i) CROSS JOIN range(1, {_SIZE + 2}) tj(j) GROUP BY m, it, beta, i, j)
        GROUP BY m, it, beta, i)
      GROUP BY m, it, beta)),
  betas AS (SELECT m, beta FROM newton WHERE it = 14),
  lr_scored AS (SELECT p.CustomerID, p.churn_label AS label, p.is_train,
      ROUND(1 / (1 + exp(-list_dot_product(b.beta, [CAST(1.0 AS DOUBLE), {", ".join(f"p.{c}_z" for c in FEATS)}]))), 6) AS score
    FROM prepared p CROSS JOIN betas b WHERE b.m = -1)"""
_AUC = """SUM(pos * (cum - CAST(c - 1 AS DOUBLE) / 2)) - CAST(SUM(pos) AS DOUBLE) * (CAST(SUM(pos) AS DOUBLE) + 1) / 2)
      / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(c) - SUM(pos) AS DOUBLE)"""


@register("lr_scores", NEWTON_SQL + " SELECT CustomerID, label, score FROM lr_scored WHERE NOT is_train")
def q_lr_scores(spark, sf_dir):
    """Test rows scored by the logistic model (Newton's method)."""
    scored = M.newton_scores(_prepared(Inputs(spark, sf_dir, share_bronze=True)), P)
    return scored.where(~F.col("is_train")).select("CustomerID", F.col("churn_label").alias("label"), "score")


@register("cv_auc_lr", NEWTON_SQL + f"""
  , held AS (SELECT p.fold, p.churn_label AS label,
      ROUND(1 / (1 + exp(-list_dot_product(b.beta, [CAST(1.0 AS DOUBLE), {", ".join(f"p.{c}_z" for c in FEATS)}]))), 6) AS score
    FROM prepared p JOIN betas b ON b.m = p.fold WHERE p.is_train),
  g AS (SELECT fold, score, SUM(label) AS pos, COUNT(*) AS c FROM held GROUP BY fold, score),
  r AS (SELECT *, SUM(c) OVER (PARTITION BY fold ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum FROM g),
  per AS (SELECT fold, ({_AUC}) AS auc FROM r GROUP BY fold)
  SELECT 'lr' AS model, CAST(fold AS VARCHAR) AS fold, ROUND(auc, 9) AS auc FROM per
  UNION ALL SELECT 'lr', 'mean', ROUND(AVG(auc), 9) FROM per UNION ALL SELECT 'lr', 'plus_minus', ROUND(2 * stddev_pop(auc), 9) FROM per""")
def q_cv_auc_lr(spark, sf_dir):
    """Cross-validated AUC of the logistic model, all folds fitted together."""
    return M.cv_auc_newton(_prepared(Inputs(spark, sf_dir, share_bronze=True)), P)


@register("feature_drivers_lr", NEWTON_SQL + f""", co AS (
    SELECT unnest({FEATS!r}) AS feature, unnest(list_transform(beta[2:], lambda b: ROUND(b, 6))) AS value FROM betas WHERE m = -1)
  SELECT 'lr' AS model, feature, value, abs(value) AS abs_value, CASE WHEN value > 0 THEN 'risk' ELSE 'retention' END AS direction,
    CAST(ROW_NUMBER() OVER (ORDER BY abs(value) DESC, feature) AS INTEGER) AS rank FROM co""")
def q_feature_drivers_lr(spark, sf_dir):
    return M.newton_drivers(_prepared(Inputs(spark, sf_dir, share_bronze=True)), P)


@register("model_metrics_lr", NEWTON_SQL + f"""
  , c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp, COUNT(*) FILTER (WHERE label <> 1 AND score > 0.5) AS fp,
        COUNT(*) FILTER (WHERE label <> 1 AND NOT score > 0.5) AS tn, COUNT(*) FILTER (WHERE label = 1 AND NOT score > 0.5) AS fn
      FROM lr_scored WHERE NOT is_train),
  g AS (SELECT score, SUM(label) AS pos, COUNT(*) AS c FROM lr_scored WHERE NOT is_train GROUP BY score),
  r AS (SELECT *, SUM(c) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum FROM g)
  SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
    ROUND(CAST(tp + tn AS DOUBLE) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS accuracy,
    ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END, 6) AS precision,
    ROUND(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END, 6) AS recall,
    ROUND(CASE WHEN tp = 0 THEN 0.0 ELSE 2 * CAST(tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1,
    (SELECT ROUND(({_AUC}), 9) FROM r) AS auc
  FROM c""")
def q_model_metrics_lr(spark, sf_dir):
    """Test metrics of the logistic model."""
    return M.newton_metrics(_prepared(Inputs(spark, sf_dir, share_bronze=True)), P)


@register("rf_scores")
def q_rf_scores(spark, sf_dir):
    return M.test_scores(_prepared(Inputs(spark, sf_dir, share_bronze=True)), "rf", P)


# A small forest, stored: tree, node, feature, threshold, left, right, leaf
FIXED_FOREST = [
    (0, 0, 13, 40.5, 1, 4, None), (0, 1, 4, 2.5, 2, 3, None), (0, 2, None, None, None, None, 0.8125),
    (0, 3, None, None, None, None, 0.625), (0, 4, 1, 25000.0, 5, 6, None), (0, 5, None, None, None, None, 0.375),
    (0, 6, None, None, None, None, 0.125),
    (1, 0, 0, 8.5, 1, 2, None), (1, 1, None, None, None, None, 0.75), (1, 2, 12, 2.5, 3, 6, None),
    (1, 3, 3, 9000.0, 4, 5, None), (1, 4, None, None, None, None, 0.5625), (1, 5, None, None, None, None, 0.4375),
    (1, 6, None, None, None, None, 0.25),
    (2, 0, 11, 0.5, 1, 2, None), (2, 1, None, None, None, None, 0.3125), (2, 2, None, None, None, None, 0.6875),
]
_NODES = ", ".join("(" + ", ".join("NULL" if v is None else str(v) for v in n) + ")" for n in FIXED_FOREST)
_STEP = "list_extract([" + ", ".join(f"p.{c}" for c in FEATS) + "], n.feature + 1) <= n.threshold"


@register("rf_scores_fixed", MODEL_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
  nodes(tree, node, feature, threshold, lft, rgt, leaf) AS (VALUES {_NODES}),
  walk AS (
    SELECT CustomerID, tree, 0 AS node FROM prepared CROSS JOIN (SELECT DISTINCT tree FROM nodes)
    UNION ALL
    SELECT w.CustomerID, w.tree, CASE WHEN {_STEP} THEN n.lft ELSE n.rgt END
    FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN prepared p ON p.CustomerID = w.CustomerID
    WHERE n.leaf IS NULL)
  SELECT w.CustomerID, any_value(p.churn_label) AS label, ROUND(SUM(CAST(n.leaf AS DOUBLE)) / COUNT(*), 9) AS score
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.leaf IS NOT NULL
    JOIN prepared p ON p.CustomerID = w.CustomerID
  GROUP BY w.CustomerID""")
def q_rf_scores_fixed(spark, sf_dir):
    """Every customer's score under a stored forest, walked node by node."""
    prep = _prepared(Inputs(spark, sf_dir, share_bronze=True))
    scored = FO.score(prep, spark.createDataFrame(FIXED_FOREST, FO.SCHEMA), FEATS, depth=3)
    return scored.select("CustomerID", F.col(M.LABEL).alias("label"), "score")


@register("cv_auc")
def q_cv_auc(spark, sf_dir):
    prep = _prepared(Inputs(spark, sf_dir, share_bronze=True))
    return M.cv_auc(prep, "lr", P).unionByName(M.cv_auc(prep, "rf", P))


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    return M.model_comparison(_prepared(Inputs(spark, sf_dir, share_bronze=True)), P)


@register("feature_drivers")
def q_feature_drivers(spark, sf_dir):
    return M.feature_drivers(_prepared(Inputs(spark, sf_dir, share_bronze=True)), P)


def _lr_scored(i: Inputs):
    mart = _mart(i)
    return M.risk_scored(mart, M.prepared(mart, P), P)


LR_RISK = NEWTON_SQL + _BASE_RISK.replace("JOIN baseline b", "JOIN lr_scored b")


@register("risk_tiers", LR_RISK + f" SELECT {sql_as_double(NULLABLE_BEHAVIOUR)} FROM scored")
def q_risk_tiers(spark, sf_dir):
    return as_double(_lr_scored(Inputs(spark, sf_dir, share_bronze=True)), NULLABLE_BEHAVIOUR)


@register("risk_summary", LR_RISK + REGISTRY["risk_summary_baseline"].sql.removeprefix(MODEL_SQL + _BASE_RISK))
def q_risk_summary(spark, sf_dir):
    return M.risk_summary(_lr_scored(Inputs(spark, sf_dir, share_bronze=True)))


@register("at_risk_exposure", LR_RISK + REGISTRY["at_risk_exposure_baseline"].sql.removeprefix(MODEL_SQL + _BASE_RISK))
def q_at_risk_exposure(spark, sf_dir):
    return M.at_risk_exposure(_lr_scored(Inputs(spark, sf_dir, share_bronze=True)))


@register("churn_label_rate", MODEL_SQL + """
  , g AS (SELECT CAST(churn_label AS BIGINT) AS churn_label, COUNT(*) AS customers FROM churn GROUP BY 1)
  SELECT churn_label, CAST(customers AS BIGINT) AS customers,
    ROUND(CAST(SUM(churn_label * customers) OVER () AS DOUBLE) / CAST(SUM(customers) OVER () AS DOUBLE), 6) AS churn_rate
  FROM g""")
def q_churn_label_rate(spark, sf_dir):
    return M.label_distribution(_mart(Inputs(spark, sf_dir, share_bronze=True)))


@register("cluster_silhouette")
def q_cluster_silhouette(spark, sf_dir):
    """Squared-Euclidean silhouette (closed form per point and cluster, no
    pairs) of the K-Means assignment and of the fixed-centroid assignment."""
    i = Inputs(spark, sf_dir)
    seg = _segments(i)
    feats = _features(i, seg)
    vectors = C.prepare_vectors(feats)
    km = C.fit_kmeans(vectors, C.ClusterParams().k)
    kmeans_sil = C.silhouette(km.transform(vectors))
    fixed = _fixed_clusters(i)[1].select("CustomerID", "cluster")
    fixed_sil = C.silhouette(vectors.join(fixed, "CustomerID"))
    return spark.createDataFrame([("kmeans", float(kmeans_sil)), ("fixed_centroids", float(fixed_sil))],
                                 "assignment string, silhouette double")


_RFM_DESC = ["recency_days", "frequency", "monetary", "recency_log", "frequency_log", "monetary_log"]
_rfm_union = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM feat" for m in _RFM_DESC)
_DESC_COLS = """metric, CAST(COUNT(value) AS BIGINT) AS count, ROUND(AVG(value), 6) AS mean,
    ROUND(stddev_samp(value), 6) AS std, ROUND(MIN(value), 6) AS "min", ROUND(quantile_cont(value, 0.25), 6) AS p25,
    ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.75), 6) AS p75, ROUND(MAX(value), 6) AS "max"
"""


@register("describe_rfm", FEAT_SQL + f", dl AS ({_rfm_union}) SELECT {_DESC_COLS} FROM dl GROUP BY metric")
def q_describe_rfm(spark, sf_dir):
    from ..operators import profiling
    return profiling.describe(_features(Inputs(spark, sf_dir)), _RFM_DESC)


_CLV_DESC = ["frequency", "recency", "T", "monetary_value", "clv_12m", "predicted_purchases_6m", "probability_alive"]
_clv_union = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM clv_tiered" for m in _CLV_DESC)


@register("describe_clv", O.with_ctes(O.BRONZE, O.SILVER, O.CLV_INPUTS, O.CLV_SCORED)
          + f", dl AS ({_clv_union}) SELECT {_DESC_COLS} FROM dl GROUP BY metric")
def q_describe_clv(spark, sf_dir):
    from ..operators import clv as clv_ops
    from ..operators import profiling
    scored = clv_ops.clv_heuristic(clv_ops.clv_inputs(Inputs(spark, sf_dir).silver))
    return profiling.describe(scored, _CLV_DESC)


_CURVE_SQL = """
  , g AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM test_scores GROUP BY score),
  r AS (SELECT score, SUM(pos) OVER w AS tps, SUM(neg) OVER w AS fps, SUM(pos) OVER () AS P, SUM(neg) OVER () AS N
        FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
  pts AS (
    SELECT score AS threshold,
      ROUND(CASE WHEN N = 0 THEN 0.0 ELSE CAST(fps AS DOUBLE) / CAST(N AS DOUBLE) END, 9) AS fpr,
      ROUND(CASE WHEN P = 0 THEN 0.0 ELSE CAST(tps AS DOUBLE) / CAST(P AS DOUBLE) END, 9) AS tpr,
      ROUND(CAST(tps AS DOUBLE) / CAST(tps + fps AS DOUBLE), 9) AS precision
    FROM r
    UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0, 1.0)"""


@register("roc_points", MODEL_SQL + _CURVE_SQL + " SELECT threshold, fpr, tpr FROM pts")
def q_roc_points(spark, sf_dir):
    return E.curve_points(_baseline_test(Inputs(spark, sf_dir, share_bronze=True))).select("threshold", "fpr", "tpr")


@register("roc_points_reduced", MODEL_SQL + """
  , g AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM test_scores GROUP BY score),
  r AS (SELECT score, SUM(pos) OVER w AS tps, SUM(neg) OVER w AS fps, SUM(pos) OVER () AS P, SUM(neg) OVER () AS N,
          ROW_NUMBER() OVER w AS rn, COUNT(*) OVER () AS points FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
  bent AS (SELECT *, rn = 1 OR rn = points OR lead(tps) OVER o - 2 * tps + lag(tps) OVER o <> 0 OR lead(fps) OVER o - 2 * fps + lag(fps) OVER o <> 0 AS kept
        FROM r WINDOW o AS (ORDER BY score DESC))
  SELECT score AS threshold, ROUND(CASE WHEN N = 0 THEN 0.0 ELSE CAST(fps AS DOUBLE) / CAST(N AS DOUBLE) END, 9) AS fpr,
    ROUND(CASE WHEN P = 0 THEN 0.0 ELSE CAST(tps AS DOUBLE) / CAST(P AS DOUBLE) END, 9) AS tpr FROM bent WHERE kept
  UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_points_reduced(spark, sf_dir):
    """The ROC curve without collinear points."""
    return E.reduced_roc(_baseline_test(Inputs(spark, sf_dir, share_bronze=True)))


@register("pr_points", MODEL_SQL + _CURVE_SQL + " SELECT threshold, precision, tpr AS recall FROM pts")
def q_pr_points(spark, sf_dir):
    return E.curve_points(_baseline_test(Inputs(spark, sf_dir, share_bronze=True))).select("threshold", "precision", "recall")


@register("split_summary", MODEL_SQL + """
  SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS part, CAST(COUNT(*) AS BIGINT) AS customers,
    ROUND(AVG(CAST(churn_label AS DOUBLE)), 6) AS churn_rate
  FROM split GROUP BY 1""")
def q_split_summary(spark, sf_dir):
    ts = M.training_set(_mart(Inputs(spark, sf_dir, share_bronze=True)))
    return E.split_summary(E.stratified_split(ts, M.LABEL, M.KEY, P.seed, P.train_fraction, P.folds), M.LABEL)

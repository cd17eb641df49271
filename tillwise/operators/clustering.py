"""RFM clustering on Spark ML K-Means, cluster profiling and naming.

Features: log1p of recency, frequency and monetary value, standardised with
the population standard deviation. Fits read a checkpointed, cached feature
frame; restarts keep the lowest within-cluster cost. Assignment to given
centroids is a narrow expression (centroids are K rows, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import cents, half_up_div
from ..params import ClusterParams  # noqa: F401 (re-exported)
from ..session import cut_lineage
from . import evaluation as E
from . import lloyd
from .ranking import exact_quantiles

RAW = ["recency_days", "frequency", "monetary"]
LOGS = ["recency_log", "frequency_log", "monetary_log"]
Z = [f"{c}_z" for c in LOGS]


def rfm_scaled(segments: DataFrame) -> DataFrame:
    """Key, raw RFM, log1p features and their z-scores (rows with a NULL
    feature dropped, the key kept)."""
    base = segments.dropna(subset=RAW).select(
        "CustomerID", *RAW,
        F.log1p(F.col("recency_days").cast("double")).alias("recency_log"),
        F.log1p(F.col("frequency").cast("double")).alias("frequency_log"),
        F.log1p(F.col("monetary").cast("double")).alias("monetary_log"))
    return E.standardize(base, LOGS)


def _vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=Z, outputCol="features").transform(features)


def prepare_vectors(features: DataFrame) -> DataFrame:
    """Assembled vectors, materialised once (fits and transforms re-read the
    stored rows; they are cached only while fits iterate over them)."""
    return cut_lineage(_vectors(features).select("CustomerID", "features"))


def _fit_one(vectors: DataFrame, k: int, seed: int, p: ClusterParams):
    return KMeans(k=k, seed=seed, maxIter=p.max_iter, featuresCol="features",
                  predictionCol="cluster").fit(vectors)


def _fit_many(vectors: DataFrame, jobs: list[tuple[int, int]], p: ClusterParams) -> dict:
    """Fit (k, seed) pairs as concurrent Spark jobs (like CrossValidator's
    ``parallelism``); returns the lowest-cost model per k."""
    from concurrent.futures import ThreadPoolExecutor

    vectors.persist()
    try:
        with ThreadPoolExecutor(max_workers=max(1, p.parallelism)) as pool:
            models = list(pool.map(lambda js: (js[0], _fit_one(vectors, js[0], js[1], p)), jobs))
    finally:
        vectors.unpersist()
    best: dict = {}
    for k, m in models:  # jobs are in seed order: ties keep the first seed
        if k not in best or m.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = m
    return best


def fit_kmeans(vectors: DataFrame, k: int, p: ClusterParams = ClusterParams()):
    """Best of ``p.restarts`` K-Means runs (seeds seed, seed+1, ...) by cost."""
    jobs = [(k, p.seed + r) for r in range(max(1, p.restarts))]
    return _fit_many(vectors, jobs, p)[k]


def kmeans_sweep(vectors: DataFrame, p: ClusterParams = ClusterParams()) -> DataFrame:
    """Inertia and silhouette (squared Euclidean) for K = k_min..k_max, with
    the best K (highest silhouette) flagged. One small row per K."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                             distanceMeasure="squaredEuclidean")
    ks = list(range(p.k_min, p.k_max + 1))
    jobs = [(k, p.seed + r) for k in ks for r in range(max(1, p.restarts))]
    best = _fit_many(vectors, jobs, p)
    rows = []
    for k in ks:
        model = best[k]
        sil = ev.evaluate(model.transform(vectors))
        rows.append((k, float(model.summary.trainingCost), float(sil)))
    spark = vectors.sparkSession
    df = spark.createDataFrame(rows, "k int, inertia double, silhouette double")
    top = F.max("silhouette").over(Window.partitionBy())  # one row per K
    return df.withColumn("is_best", F.col("silhouette") == top)


def kmeans_assign(features: DataFrame, p: ClusterParams = ClusterParams()) -> DataFrame:
    """Fit K-Means with ``p.k`` clusters and assign every customer."""
    vectors = prepare_vectors(features)
    model = fit_kmeans(vectors, p.k, p)
    assigned = model.transform(vectors).select("CustomerID", F.col("cluster").cast("int").alias("cluster"))
    return features.join(assigned, "CustomerID")


def lloyd_sweep(features: DataFrame, p: ClusterParams = ClusterParams()) -> DataFrame:
    """Inertia and silhouette (squared Euclidean) of the best run for each K
    from k_min to k_max, all runs advanced together (see ``lloyd``); the K of
    the highest silhouette is flagged, the smaller one of equals."""
    points = lloyd.uniforms(features, "CustomerID", Z)
    best = lloyd.fit(points, Z, list(range(p.k_min, p.k_max + 1)), p)
    sil = {k: round(v, 6) for k, v in lloyd.silhouettes(points, Z, best).items()}
    top = min((-v, k) for k, v in sil.items())[1] if sil else None
    rows = [(k, round(run.cost, 6), sil[k], k == top) for k, run in sorted(best.items())]
    return features.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, is_best boolean")  # a row per K


def lloyd_assign(features: DataFrame, p: ClusterParams = ClusterParams()) -> DataFrame:
    """``features`` with the cluster of the best of ``p.restarts`` runs; the
    numbers follow the centroids' coordinates."""
    points = lloyd.uniforms(features, "CustomerID", Z)
    best = lloyd.fit(points, Z, [p.k], p)
    cluster = lloyd.nearest(Z, best[p.k]) if p.k in best else F.lit(None)
    return features.withColumn("cluster", cluster.cast("int"))


def silhouette_exact(clustered: DataFrame, sample: int = 4000, seed: int = 42, block: int = 512) -> DataFrame:
    """Euclidean silhouette from all pairs of a sample: the ``sample`` rows of
    the smallest md5 of the key (all rows, if there are fewer). One row:
    rows, sampled rows, mean silhouette. ``sample`` x 4 numbers travel with
    the tasks; a task takes its rows in blocks against the sample."""
    order = F.md5(F.concat(F.col("CustomerID").cast("string"), F.lit(f"|{seed}")))
    rows = cut_lineage(clustered.select("CustomerID", "cluster", *Z))
    drawn = rows.withColumn("_h", order).orderBy("_h", "CustomerID").limit(sample)
    table = drawn.select("cluster", *Z).toArrow()                  # at most ``sample`` rows
    cols = {c: table.column(c).to_numpy() for c in ("cluster", *Z)}
    own, points = cols["cluster"], np.stack([cols[z] for z in Z], axis=1)
    kinds, number = np.unique(own, return_inverse=True)
    size = np.bincount(number, minlength=len(kinds)).astype(np.float64)

    def values(batches):
        for b in batches:
            at = b.column("id").to_numpy()
            for i in range(0, len(at), block):
                mine = at[i:i + block]
                d = np.sqrt(lloyd.squares(points[mine], points))
                per = np.stack([d[:, number == c].sum(axis=1) for c in range(len(kinds))], axis=1)
                n, rows_ = size[number[mine]], np.arange(len(mine))
                a = per[rows_, number[mine]] / np.maximum(n - 1, 1)
                mean = per / size
                mean[rows_, number[mine]] = np.inf
                c = mean.min(axis=1)
                top = np.maximum(a, c)
                good = (n > 1) & np.isfinite(c) & (top > 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.where(good, (c - a) / np.where(good, top, 1), 0.0))], names=["s"])

    spark = clustered.sparkSession
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-len(own) // block)))
    s = spark.range(0, len(own), numPartitions=tasks).mapInArrow(values, "s double")
    return s.agg(F.count(F.lit(1)).alias("sampled"), F.round(F.avg("s"), 6).alias("silhouette")).select(
        rows.agg(F.count(F.lit(1))).scalar().alias("customers"), "sampled", "silhouette")


def centroids_by_group(features: DataFrame, group: str) -> DataFrame:
    """Centroids = mean z-scores per group value; ids 0.. in group order."""
    g = features.groupBy(group).agg(*[F.avg(c).alias(c) for c in Z])
    return g.withColumn("cluster", (F.row_number().over(Window.orderBy(group)) - 1).cast("int"))  # K rows


def assign_to_centroids(features: DataFrame, centroids: DataFrame) -> DataFrame:
    """Nearest centroid (squared Euclidean, ties to the lower id): the K
    centroids arrive as one array (a scalar subquery); the distance scan is a
    narrow expression, no shuffle."""
    cents = centroids.agg(F.collect_list(F.struct("cluster", *Z))).scalar()  # K rows -> one array

    def dist(c):
        terms = [(F.col(z) - c[z]) * (F.col(z) - c[z]) for z in Z]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return F.struct(out.alias("d"), c["cluster"].alias("k"))

    best = F.array_min(F.transform("_cents", dist))  # a subquery may not sit inside a lambda
    return features.withColumn("_cents", cents).withColumn("cluster", best["k"].cast("int")).drop("_cents")


def lloyd_step(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """One K-Means update from a given assignment: per cluster the customers,
    their cost (squared distance to the given centroid) and the new centroid."""
    old = centroids.select("cluster", *[F.col(z).alias(f"_old_{z}") for z in Z])
    j = assigned.join(old, "cluster")
    cost = sum((F.col(z) - F.col(f"_old_{z}")) * (F.col(z) - F.col(f"_old_{z}")) for z in Z)
    return j.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("long").alias("customers"), F.round(F.sum(cost), 6).alias("cost"),
        *[F.round(F.avg(z), 6).alias(f"{z}_new") for z in Z])


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Per cluster: customers, mean and exact median of recency, frequency,
    monetary and RFM score (6 decimals: an interpolated median of cents can
    end in a half cent), and the most common segment (smallest on ties)."""
    metrics = ["recency_days", "frequency", "monetary", "rfm_score"]
    base = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        *[F.round(F.avg(c), 6).alias(f"{c}_mean") for c in metrics])
    long = clustered.select("cluster", *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot(
        ["cluster"], metrics, "_metric", "_value")
    med = exact_quantiles(long, "_value", {"_median": 0.5}, ["cluster", "_metric"])
    med_wide = med.groupBy("cluster").pivot("_metric", metrics).agg(F.first("_median"))
    med_wide = med_wide.select("cluster", *[F.round(F.col(c), 6).alias(f"{c}_median") for c in metrics])
    seg_counts = clustered.groupBy("cluster", "customer_segment").agg(F.count(F.lit(1)).alias("_n"))
    mode = seg_counts.groupBy("cluster").agg(
        F.min_by("customer_segment", F.struct((-F.col("_n")).alias("n"), F.col("customer_segment"))).alias(
            "segment_mode"))
    return base.join(med_wide, "cluster").join(mode, "cluster")


def cluster_mapping(clustered: DataFrame) -> DataFrame:
    """(cluster_id, cluster_name) from the clusters' mean recency, frequency
    and monetary value."""
    means = clustered.groupBy("cluster").agg(
        F.avg("recency_days").alias("_r"), F.avg("frequency").alias("_f"), F.avg("monetary").alias("_m"))
    return means.select(F.col("cluster").cast("long").alias("cluster_id"),
                        rules.cluster_name(F.col("_r"), F.col("_f"), F.col("_m")).alias("cluster_name"))


def enrich_segments(segments: DataFrame, clustered: DataFrame, mapping: DataFrame) -> DataFrame:
    """Segments mart + cluster, label and business name (mapping = K rows)."""
    c = clustered.select("CustomerID", "cluster")
    m = mapping.select(F.col("cluster_id").cast("int").alias("cluster"), "cluster_name")
    return (segments.join(c, "CustomerID")
            .join(F.broadcast(m), "cluster", "left")
            .withColumn("cluster_label", F.concat(F.lit("Cluster "), F.col("cluster").cast("string")))
            .withColumnRenamed("cluster_name", "cluster_business_name"))


def cluster_shares(enriched: DataFrame) -> DataFrame:
    """Per cluster: customers and revenue with shares of the total, average
    value, recency and frequency."""
    g = enriched.groupBy("cluster", "cluster_business_name").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("monetary").cast("decimal(22,2)")).alias("_rev"),
        F.avg("monetary").alias("_avg_m"), F.avg("recency_days").alias("_avg_r"),
        F.avg("frequency").alias("_avg_f"))
    everyone = Window.partitionBy()  # one row per cluster
    return g.select(
        "cluster", "cluster_business_name", F.col("customers").cast("long").alias("customers"),
        half_up_div(F.col("customers") * 10000, F.sum("customers").over(everyone)).alias("customer_pct"),
        F.col("_rev").cast("double").alias("revenue"),
        half_up_div(cents("_rev") * 10000, cents(F.sum("_rev").over(everyone))).alias("revenue_pct"),
        F.round("_avg_m", 2).alias("avg_monetary"), F.round("_avg_r", 2).alias("avg_recency"),
        F.round("_avg_f", 2).alias("avg_frequency"))


def silhouette(clustered_vectors: DataFrame) -> float:
    """Squared-Euclidean silhouette of an assignment (Spark's closed form)."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                             distanceMeasure="squaredEuclidean")
    return ev.evaluate(clustered_vectors)


def rounded_features(features: DataFrame, digits: int = 6, columns: Sequence[str] = (*LOGS, *Z)) -> DataFrame:
    out = features
    for c in columns:
        out = out.withColumn(c, F.round(c, digits))
    return out

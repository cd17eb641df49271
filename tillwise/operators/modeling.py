"""Churn models on Spark ML: feature set, split, logistic regression, random
forest, cross-validated AUC, risk scoring.

Training data never leaves the cluster: features are assembled as vectors
next to their CustomerID, fitted models are applied with ``transform``. Only
coefficients, importances and metric rows (a few dozen values) reach the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..params import ModelParams
from ..session import cut_lineage
from . import evaluation as E
from . import newton

# The model features (leakage columns recency_days and
# customer_lifespan_days are left out).
FEATURES = [
    "total_transactions", "total_spend", "unique_products", "avg_order_value",
    "active_months", "avg_items_per_order", "has_high_value_order", "has_bulk_purchase",
    "spend_per_transaction", "items_per_transaction", "spend_per_product",
    "purchase_regularity", "tier_encoded", "engagement_score",
]
LABEL = "churn_label"
KEY = "CustomerID"
SCALED = [f"{c}_z" for c in FEATURES]


def training_set(churn_mart: DataFrame) -> DataFrame:
    """Key, label, the 14 features as DOUBLE with NULLs replaced by the exact
    median of the whole table."""
    base = churn_mart.select(KEY, F.col(LABEL).cast("int").alias(LABEL),
                             *[F.col(c).cast("double").alias(c) for c in FEATURES])
    return E.impute_median(base, FEATURES)


def prepared(churn_mart: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Training set with split, folds, balanced weights (from training rows)
    and features standardised with training-set mean / population std."""
    split = E.stratified_split(training_set(churn_mart), LABEL, KEY, p.seed, p.train_fraction, p.folds)
    train = split.where("is_train")
    weights = E.class_weight_table(train, LABEL).drop("class_count")
    stats = E.fit_standardizer(train, FEATURES)
    out = E.apply_standardizer(split.join(F.broadcast(weights), LABEL), stats, FEATURES)
    return cut_lineage(out)


def standardised(churn_mart: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """``prepared`` without folds and weights, for scorers that need neither:
    nothing is sorted or written. Pass a written mart."""
    split = E.train_test_cut(training_set(churn_mart), LABEL, KEY, p.seed, p.train_fraction)
    return E.apply_standardizer(split, E.fit_standardizer(split.where("is_train"), FEATURES), FEATURES)


def _assembled(df: DataFrame, scaled: bool) -> DataFrame:
    cols = SCALED if scaled else FEATURES
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


@dataclass
class Fitted:
    kind: str
    model: object
    scaled: bool


def forest_estimator(p: ModelParams = ModelParams()) -> RandomForestClassifier:
    """The churn forest. Every row keeps the node it has reached in each tree
    (four bytes a tree), instead of walking from the roots at every level."""
    return RandomForestClassifier(featuresCol="features", labelCol=LABEL, weightCol="weight",
                                  numTrees=p.rf_trees, maxDepth=p.rf_depth,
                                  minInstancesPerNode=p.rf_min_leaf, featureSubsetStrategy="sqrt",
                                  maxBins=64, seed=p.seed, cacheNodeIds=True)


def fit(train: DataFrame, kind: str, p: ModelParams = ModelParams()) -> Fitted:
    """Logistic regression (L2, C as in scikit-learn: regParam = 1 / (C * sum
    of weights), on standardised features) or random forest (raw features,
    balanced weights)."""
    data = _assembled(train, scaled=(kind == "lr"))
    if kind == "lr":
        total_w = train.agg(F.sum("weight")).collect()[0][0]
        est = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="weight",
                                 maxIter=p.lr_max_iter, regParam=1.0 / (p.lr_c * total_w),
                                 elasticNetParam=0.0, standardization=False, tol=1e-8)
        return Fitted(kind, est.fit(data), True)
    if kind == "rf":
        return Fitted(kind, forest_estimator(p).fit(data), False)
    raise ValueError(kind)


def score(fitted: Fitted, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of churn for every row (key and label kept)."""
    pred = fitted.model.transform(_assembled(df, fitted.scaled))
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def test_scores(prep: DataFrame, kind: str, p: ModelParams = ModelParams()) -> DataFrame:
    """Test rows with their probability of churn. The logistic model, whose
    optimum is unique, comes from Newton's method: some ten jobs."""
    if kind == "lr":
        beta = newton_fit(prep, p)[newton.FULL]
        return prep.where(~F.col("is_train")).select(
            KEY, F.col(LABEL).alias("label"), newton.probability(SCALED, beta).alias("score"))
    fitted = fit(prep.where("is_train"), kind, p)
    return score(fitted, prep.where(~F.col("is_train"))).select(KEY, F.col(LABEL).alias("label"), "score")


def cv_auc(prep: DataFrame, kind: str, p: ModelParams = ModelParams()) -> DataFrame:
    """Stratified k-fold ROC AUC on the training rows (exact AUC per fold),
    plus a summary row: mean and 2 x population std. The logistic models of all
    folds are fitted in the same jobs (Newton's method); forests are fitted as
    concurrent Spark jobs (like ``CrossValidator(parallelism=...)``)."""
    from concurrent.futures import ThreadPoolExecutor

    train = prep.where("is_train")
    betas = newton_fit(prep, p, folds=True) if kind == "lr" else {}

    def one_fold(f: int) -> float:
        held = train.where(F.col("fold") == f)
        if kind == "lr":
            s = held.withColumn("score", newton.probability(SCALED, betas[f]))
        else:
            s = score(fit(train.where(F.col("fold") != f), kind, p), held)
        s = s.select(F.col(LABEL).alias("label"), "score")
        return float(E.auc_rank(s).collect()[0]["auc"])

    with ThreadPoolExecutor(max_workers=max(1, p.parallelism)) as pool:
        rows = list(pool.map(one_fold, range(p.folds)))
    mean = sum(rows) / len(rows)
    std = (sum((x - mean) ** 2 for x in rows) / len(rows)) ** 0.5
    spark = prep.sparkSession
    data = [(kind, str(i), a) for i, a in enumerate(rows)]
    data += [(kind, "mean", float(mean)), (kind, "plus_minus", float(2 * std))]
    return spark.createDataFrame(data, "model string, fold string, auc double")


DIGITS = 6    # decimals of the scores of the Newton models


def newton_fit(prep: DataFrame, p: ModelParams = ModelParams(), folds: bool = False) -> dict:
    """The logistic model of the training rows and, on request, one model per
    fold that leaves it out, all in the same jobs."""
    return newton.fit(prep.where("is_train"), SCALED, LABEL, "weight", p.lr_c, "fold", range(p.folds) if folds else ())


def newton_scores(prep: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Every row of ``prep`` with its probability of churn (6 decimals) under
    the logistic model of the training rows."""
    beta = newton_fit(prep, p)[newton.FULL]
    return prep.withColumn("score", F.round(newton.probability(SCALED, beta), DIGITS))


def cv_auc_newton(prep: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Cross-validated AUC of the logistic model: per fold the exact AUC of the
    rows left out, the mean, and twice the population deviation."""
    betas = newton_fit(prep, p, folds=True)
    score = F.lit(None).cast("double")
    for f in range(p.folds):
        score = F.when(F.col("fold") == f, F.round(newton.probability(SCALED, betas[f]), DIGITS)).otherwise(score)
    per = E.auc_by_group(prep.where("is_train").select("fold", F.col(LABEL).alias("label"), score.alias("score")), "fold")
    both = per.agg(F.avg("auc").alias("mean"), (2 * F.stddev_pop("auc")).alias("plus_minus"))
    return per.select(F.lit("lr").alias("model"), F.col("fold").cast("string").alias("fold"), F.round("auc", 9).alias("auc")).unionByName(
        both.select(F.lit("lr").alias("model"), F.expr("stack(2, 'mean', mean, 'plus_minus', plus_minus) AS (fold, auc)")).withColumn("auc", F.round("auc", 9)))


def newton_drivers(prep: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """The logistic model's coefficients, ranked by size."""
    beta = newton_fit(prep, p)[newton.FULL]
    rows = [("lr", f, round(float(c), 6)) for f, c in zip(FEATURES, beta[1:])]
    df = prep.sparkSession.createDataFrame(rows, "model string, feature string, value double")   # a row per feature
    return rank_drivers(df.select("model", "feature", "value", F.abs("value").alias("abs_value"),
                                  F.when(F.col("value") > 0, "risk").otherwise("retention").alias("direction")))


def newton_metrics(prep: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Test-set accuracy, precision, recall, F1 and AUC of the logistic model."""
    s = cut_lineage(newton_scores(prep, p).where(~F.col("is_train")).select(F.col(LABEL).alias("label"), "score"))
    auc = E.auc_by_group(s.withColumn("all", F.lit(0)), "all").select(F.round("auc", 9).alias("auc")).scalar()
    return E.confusion_metrics(s, "label", "score", p.threshold).withColumn("auc", auc)


def model_comparison(prep: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Test-set accuracy, precision, recall, F1 and AUC of both models; the
    best model by AUC is flagged."""
    out = None
    for kind, name in (("lr", "Logistic Regression"), ("rf", "Random Forest")):
        s = test_scores(prep, kind, p)
        auc = E.auc_rank(s).select("auc").scalar()
        m = E.confusion_metrics(s, "label", "score", p.threshold).select(
            F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1", auc.alias("auc"))
        out = m if out is None else out.unionByName(m)
    from pyspark.sql import Window
    first = F.row_number().over(Window.orderBy(F.col("auc").desc(), "model"))  # two rows; logistic regression wins a tie
    return out.withColumn("is_best", first == 1)


def feature_drivers(prep: DataFrame, p: ModelParams = ModelParams(), top: int | None = None) -> DataFrame:
    """LR coefficients (sign -> direction) and RF importances of all features,
    ranked by absolute value; ``top`` keeps the strongest of each model."""
    spark = prep.sparkSession
    train = prep.where("is_train")
    beta = newton_fit(prep, p)[newton.FULL]
    rf = fit(train, "rf", p).model
    rows = [("lr", f, float(c), abs(float(c)), "risk" if c > 0 else "retention")
            for f, c in zip(FEATURES, beta[1:])]
    rows += [("rf", f, float(v), abs(float(v)), None) for f, v in zip(FEATURES, rf.featureImportances.toArray())]
    df = spark.createDataFrame(rows, "model string, feature string, value double, abs_value double, direction string")
    return rank_drivers(df, top)


def rank_drivers(values: DataFrame, top: int | None = None) -> DataFrame:
    """Features of each model by falling ``abs_value`` (ties by name)."""
    from pyspark.sql import Window
    w = Window.partitionBy("model").orderBy(F.col("abs_value").desc(), F.col("feature"))  # 14 rows per model
    ranked = values.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= top) if top else ranked


def class_gaps(prep: DataFrame) -> DataFrame:
    """Per feature the gap between the classes' training means (standardised),
    in the form that ``rank_drivers`` takes."""
    long = prep.where("is_train").select(LABEL, *[F.col(f"{c}_z").alias(c) for c in FEATURES]).unpivot(
        [LABEL], FEATURES, "feature", "_z")
    gap = F.round(F.avg(F.when(F.col(LABEL) == 1, F.col("_z"))) - F.avg(F.when(F.col(LABEL) == 0, F.col("_z"))), 6)
    g = long.groupBy("feature").agg(gap.alias("value"))
    return g.select(F.lit("gap").alias("model"), "feature", "value", F.abs("value").alias("abs_value"),
                    F.when(F.col("value") > 0, "risk").otherwise("retention").alias("direction"))


def linear_scores(prep: DataFrame, coefficients, intercept: float) -> DataFrame:
    """Scores of a logistic model with given coefficients on the standardised
    features, rounded to 9 decimals."""
    z = F.lit(float(intercept))
    for c, w in zip(SCALED, coefficients):
        z = z + F.lit(float(w)) * F.col(c)
    return prep.select(KEY, F.col(LABEL).alias("label"), "is_train",
                       F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 9).alias("score"))


def risk_scored(churn_mart: DataFrame, prep: DataFrame, p: ModelParams = ModelParams(),
                kind: str | None = None) -> DataFrame:
    """Score every customer of the mart and attach the risk tier."""
    kind = kind or p.score_model
    if kind == "lr":
        scores = newton_scores(prep, p)
    else:
        scores = score(fit(prep.where("is_train"), kind, p), prep)
    scores = scores.select(KEY, F.col("score").alias("churn_risk_score"))
    return (churn_mart.join(scores, KEY, "left")
            .withColumn("risk_tier", rules.risk_tier(F.col("churn_risk_score"))))


def risk_summary(scored: DataFrame) -> DataFrame:
    """Customers, spend, mean score and monthly fees per risk tier."""
    return scored.groupBy("risk_tier").agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        F.sum(F.col("total_spend").cast("decimal(22,2)")).cast("double").alias("total_spend"),
        F.round(F.avg("churn_risk_score"), 6).alias("churn_risk_score_mean"),
        F.sum(F.col("monthly_fee").cast("decimal(22,2)")).cast("double").alias("monthly_fee"))


def at_risk_exposure(scored: DataFrame, tiers=("Critical Risk (80%+)", "High Risk (60-80%)")) -> DataFrame:
    """Customers, spend and fees of the top risk tiers (per tier and combined)."""
    total = scored.agg(F.count(F.lit(1))).scalar()
    at = scored.where(F.col("risk_tier").isin(*tiers))
    per = at.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("total_spend").cast("decimal(22,2)")).alias("_spend"),
        F.sum(F.col("monthly_fee").cast("decimal(22,2)")).alias("_fee"))
    both = per.agg(F.lit("Critical + High").alias("risk_tier"), F.sum("customers").alias("customers"),
                   F.sum("_spend").alias("_spend"), F.sum("_fee").alias("_fee"))
    out = per.unionByName(both).withColumn("_all", total)
    return out.select(
        "risk_tier", F.coalesce(F.col("customers"), F.lit(0)).cast("long").alias("customers"),
        F.round(F.col("customers") / F.col("_all") * 100, 1).alias("customer_pct"),
        F.coalesce(F.col("_spend"), F.lit(0)).cast("double").alias("total_spend"),
        F.coalesce(F.col("_fee"), F.lit(0)).cast("double").alias("monthly_fee"),
        (F.coalesce(F.col("_fee"), F.lit(0)) * 12).cast("double").alias("annual_fee_at_risk"))


def baseline_scores(prep: DataFrame) -> DataFrame:
    """Deterministic reference scorer for the evaluation operators: churn
    risk falls with standardised engagement, ``1 / (1 + exp(z))``, rounded
    to 9 decimals so score ties are exact."""
    z = F.col("engagement_score_z")
    return prep.select(KEY, F.col(LABEL).alias("label"), "is_train",
                       F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(z)), 9).alias("score"))


def label_distribution(churn_mart: DataFrame) -> DataFrame:
    """Customers per churn label and the overall churn rate (one row per
    label; the total comes from a window over those two rows)."""
    from pyspark.sql import Window

    g = churn_mart.groupBy(F.col(LABEL).cast("long").alias(LABEL)).agg(F.count(F.lit(1)).alias("customers"))
    everyone = Window.partitionBy()
    rate = F.sum(F.col(LABEL) * F.col("customers")).over(everyone) / F.sum("customers").over(everyone)
    return g.select(LABEL, F.col("customers").cast("long").alias("customers"),
                    F.round(rate.cast("double"), 6).alias("churn_rate"))

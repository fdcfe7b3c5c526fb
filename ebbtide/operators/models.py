"""Fitted tiers: preprocessing, logistic regression and isotonic calibration on MLlib, boosted trees, importance."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FAMILY, FEATURES, LABEL, NUMERIC
from ebbtide.functions.ordered import ranked
from ebbtide.operators import boosting
from ebbtide.operators.ranking import rank_metrics
from ebbtide.operators.scoring import prior_score, recency_score

POOLED = "__infrequent__"
MIN_LEVEL_ROWS = 20


def frequent_levels(rows: DataFrame, column: str, min_rows: int = MIN_LEVEL_ROWS) -> DataFrame:
    """Levels with enough rows to keep their own column; a missing value is the level Unknown."""
    level = F.coalesce(column, F.lit("Unknown")).alias("level")
    return rows.groupBy(level).agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)


def pool_rare(rows: DataFrame, column: str, kept: DataFrame) -> DataFrame:
    """Replace levels outside ``kept`` by one shared level."""
    levels = kept.select(F.col("level").alias("_level"))
    known = F.coalesce(rows[column], F.lit("Unknown")) == levels["_level"]
    return rows.join(levels, known, "left").withColumn(column, F.coalesce("_level", F.lit(POOLED))).drop("_level")


def preprocessing(train: DataFrame, scale: bool) -> list:
    """Stages fitted with the model: median imputation, optional scaling, bounded one-hot countries.

    The pooled country level is part of the pipeline, so a level never seen in training scores like a
    rare one. ``country_grp`` has at most the whitelist plus one level, so its list may be a literal.
    """
    kept = sorted(r.level for r in frequent_levels(train, "country_grp").collect())
    names = ", ".join("'" + k.replace("'", "\\'") + "'" for k in kept) or "''"
    filled = [f"{f}_filled" for f in NUMERIC]
    stages = [
        Imputer(strategy="median", inputCols=NUMERIC, outputCols=filled),
        SQLTransformer(statement=f"SELECT *, CASE WHEN coalesce(country_grp, 'Unknown') IN ({names}) THEN coalesce(country_grp, 'Unknown') ELSE '{POOLED}' END AS country_pooled FROM __THIS__"),
        StringIndexer(inputCol="country_pooled", outputCol="country_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="country_index", outputCol="country_hot", dropLast=False),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=["scaled" if scale else "numbers", "country_hot"], outputCol="features"))
    return stages


def balanced(train: DataFrame) -> DataFrame:
    """Add the weight n / (2 * rows of the class), which sums to n."""
    sizes = train.agg(F.count("*").alias("n"), F.sum(LABEL).alias("pos")).select(F.struct("n", "pos").alias("s"))
    weighted = train.withColumn("_s", sizes.scalar())
    of_class = F.when(F.col(LABEL) == 1, F.col("_s.pos")).otherwise(F.col("_s.n") - F.col("_s.pos"))
    return weighted.withColumn("weight", F.col("_s.n") / (2.0 * of_class)).drop("_s")


def fit_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 2000, tol: float = 1e-4) -> PipelineModel:
    """L2 logistic regression on scaled features with balanced classes.

    Spark averages the losses, so the penalty 1/C of the summed loss becomes 1/(C * n).
    """
    n = train.count()
    model = LogisticRegression(
        featuresCol="features", labelCol=LABEL, weightCol="weight", regParam=1.0 / (c * n), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=tol)
    return Pipeline(stages=[*preprocessing(train, scale=True), model]).fit(balanced(train))


def boosting_edges(train: DataFrame) -> DataFrame:
    """Bins of the boosted tier, learned on the rows that fit it; rare countries have no column of their own."""
    return boosting.bin_edges(train, sorted(r.level for r in frequent_levels(train, "country_grp").collect()))


def predict_boosted(model: tuple[DataFrame, DataFrame], rows: DataFrame) -> DataFrame:
    return boosting.predict(model, rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the probability ``p`` of the positive class."""
    return model.transform(rows).withColumn("p", vector_to_array("probability")[1]).select(*rows.columns, "p")


def fit_isotonic(valid_scores: DataFrame) -> IsotonicRegressionModel:
    """Monotone map from scores to observed rates on the validation fold; the base model stays as it is.

    Rows with equal scores are one weighted point; MLlib pools violators inside partitions before it brings
    the remaining blocks together.
    """
    cells = valid_scores.groupBy("p").agg(F.avg(LABEL).alias("rate"), F.count("*").cast("double").alias("rows"))
    return IsotonicRegression(featuresCol="p", labelCol="rate", weightCol="rows", predictionCol="calibrated").fit(cells)


def calibrate(model: IsotonicRegressionModel, scores: DataFrame) -> DataFrame:
    return model.transform(scores).withColumn("p", F.col("calibrated")).drop("calibrated")


def score_tiers(table: DataFrame, logistic: PipelineModel, boosted: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Scored rows of the four tiers: base rate, recency rule, logistic regression, calibrated boosted trees.

    Everything is learned on the train fold, calibration on the validation fold.
    """
    train, valid = table.where("fold = 'train'"), table.where("fold = 'valid'")
    isotonic = fit_isotonic(predict_boosted(boosted, valid))
    tiers = {
        "trivial_prior": table.withColumn("p", prior_score(train)),
        "heuristic_recency": table.withColumn("p", recency_score(train)),
        "baseline_logistic": predict(logistic, table),
        "candidate_boosted": calibrate(isotonic, predict_boosted(boosted, table)),
    }
    parts = [rows.select(F.lit(name).alias("model"), "fold", ASOF, CUSTOMER, F.col(LABEL).alias("y"), "p") for name, rows in tiers.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_tiers(table: DataFrame, settings: boosting.BoostingSettings = boosting.BoostingSettings(), seed: int = 42) -> DataFrame:
    """``score_tiers`` with models fitted on the spot."""
    train = table.where("fold = 'train'")
    edges = boosting_edges(train)
    trees = boosting.fit(train, edges, lambda: boosting.tune_rounds(train, edges, settings, seed)["rounds"], settings, seed)
    return score_tiers(table, fit_logistic(train), (edges, trees))


def permutation_importance(model: PipelineModel, rows: DataFrame, repeats: int = 5, seed: int = 42) -> DataFrame:
    """(feature, auc_drop_mean, auc_drop_std): loss of AUC when one column is shuffled.

    Each repeat puts the rows in a seeded hash order; a row takes the shuffled value from the next one,
    which is a random cyclic permutation found by an equi-join on ranks.
    """
    base = rows.select(CUSTOMER, ASOF, LABEL, *FEATURES)
    copies = base.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    hashed = copies.withColumn("_h", F.xxhash64(CUSTOMER, ASOF, "repeat", F.lit(seed)))
    order = ranked(hashed, ["_h", CUSTOMER, ASOF], ["repeat"]).drop("_h")
    size = base.agg(F.count("*")).scalar()
    donors = order.select("repeat", (F.col("rank") % size + 1).alias("rank"), F.struct(*FEATURES).alias("donor"))
    both = order.join(donors, ["repeat", "rank"])
    shuffled = both.withColumn("shuffled", F.explode(F.array(*[F.lit(f) for f in FEATURES])))
    swapped = shuffled.select("repeat", "shuffled", CUSTOMER, ASOF, LABEL, *[
        F.when(F.col("shuffled") == f, F.col(f"donor.{f}")).otherwise(F.col(f)).alias(f) for f in FEATURES])
    scored = predict(model, swapped).select("repeat", "shuffled", F.col(LABEL).alias("y"), "p")
    whole = rank_metrics(predict(model, base).select(F.lit("all").alias("rows"), F.col(LABEL).alias("y"), "p"), ["rows"])
    drops = rank_metrics(scored, ["repeat", "shuffled"]).withColumn("drop", whole.select("roc_auc").scalar() - F.col("roc_auc"))
    return drops.groupBy(F.col("shuffled").alias("feature")).agg(F.avg("drop").alias("auc_drop_mean"), F.stddev_pop("drop").alias("auc_drop_std"))


def importance_by_family(importance: DataFrame) -> DataFrame:
    """Summed importance and number of features at or below zero per family."""
    family = F.create_map(*[F.lit(x) for pair in FAMILY.items() for x in pair])[F.col("feature")]
    return importance.groupBy(family.alias("family")).agg(
        F.sum("auc_drop_mean").alias("auc_drop"), F.count_if(F.col("auc_drop_mean") <= 0).alias("n_not_useful"))

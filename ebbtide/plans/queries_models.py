"""Queries that fit models, and queries over realised outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, LABEL
from ebbtide.operators import aging, boosting, campaign, features, models, outcomes, ranking, scoring
from ebbtide.plans.queries_features import shown
from ebbtide.plans.registry import query
from ebbtide.settings import STAR
from ebbtide.sources.stages import Stages

def _folds(spark: SparkSession, folder: str) -> DataFrame:
    return Stages(spark, folder).training()


def _as_scored(rows: DataFrame, model: str) -> DataFrame:
    return rows.select(F.lit(model).alias("model"), "fold", ASOF, CUSTOMER, F.col(LABEL).alias("y"), "p")


@query
def rare_level_pooling(spark: SparkSession, folder: str) -> DataFrame:
    """Countries of customers; those with fewer than 60 customers share one level."""
    places = Stages(spark, folder).events().select(CUSTOMER, F.col("country").alias("level_of")).distinct()
    pooled = models.pool_rare(places, "level_of", models.frequent_levels(places, "level_of", 60))
    return pooled.groupBy(F.col("level_of").alias("level")).agg(F.count("*").alias("n"))


def _checked(scored: DataFrame) -> DataFrame:
    """Rows and base rate per fold, and whether every score is a probability."""
    valid = F.coalesce((F.col("p") >= 0) & (F.col("p") <= 1), F.lit(False))
    return scored.groupBy("model", "fold").agg(F.count("*").alias("n"), F.round(F.avg("y"), 6).alias("base_rate"), F.bool_and(valid).alias("p_valid"))


@query
def train_logreg(spark: SparkSession, folder: str) -> DataFrame:
    """The logistic tier per fold, and its first-order condition: in training, weighted residuals add up to nothing."""
    stages = Stages(spark, folder)
    scored = _as_scored(models.predict(stages.logistic(), stages.training()), "baseline_logistic")
    class_gap = F.abs(F.avg(F.when(F.col("y") == 1, 1 - F.col("p"))) - F.avg(F.when(F.col("y") == 0, F.col("p"))))
    settled = scored.where("fold = 'train'").agg((class_gap < 1e-3).alias("settled")).scalar()
    return _checked(scored).withColumn("settled", settled)


@query
def train_gbt(spark: SparkSession, folder: str) -> DataFrame:
    """The boosted tier per fold, and whether the searched rounds keep their bounds: the cap, or the patience after the best."""
    stages = Stages(spark, folder)
    scored = _as_scored(models.predict_boosted(stages.boosted(), stages.training()), "candidate_boosted")
    found, bounds = stages.rounds().first(), boosting.BoostingSettings()
    kept = found["rounds"] >= bounds.least_rounds and found["best_inner"] <= found["cap"] == bounds.max_rounds
    kept = kept and (found["searched"] == found["cap"] or found["searched"] - found["best_inner"] >= bounds.patience)
    return _checked(scored).withColumn("rounds_in_bounds", F.lit(kept))


@query
def calibrate_isotonic(spark: SparkSession, folder: str) -> DataFrame:
    """Brier score and log loss of the linear scores on the validation fold, before and after their isotonic fit."""
    rows = Stages(spark, folder).scored().where("model = 'linear_fixed' AND fold = 'valid'").withColumnRenamed("y", LABEL)
    before, after = _as_scored(rows, "raw"), _as_scored(models.calibrate(models.fit_isotonic(rows), rows), "calibrated")
    return shown(ranking.threshold_metrics(before.unionByName(after)).select("model", "fold", "n", "brier", "log_loss"))


@query
def scored_long(spark: SparkSession, folder: str) -> DataFrame:
    """All four tiers scored: rows, base rate and validity per model and fold."""
    return _checked(Stages(spark, folder).fitted())


@query
def fitted_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Statistical metrics of the four tiers, fitted ones included."""
    return shown(ranking.metric_panel(Stages(spark, folder).fitted()))


@query
def fitted_campaign(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign value of the four tiers."""
    return shown(campaign.campaign_value(Stages(spark, folder).fitted(), STAR.economics))


@query
def fitted_gates(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a tier may be promoted over the logistic model, which is the live one."""
    panel = ranking.metric_panel(Stages(spark, folder).fitted())
    live = F.max(F.when(F.col("model") == "baseline_logistic", F.col("roc_auc"))).over(W.partitionBy("fold"))
    return campaign.promotion_decision(campaign.gate_checks(panel.withColumn("incumbent_auc", live), STAR.gates))


@query
def fitted_stability(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the four tiers per as-of day."""
    return shown(ranking.snapshot_stability(Stages(spark, folder).fitted()))


@query
def perm_importance(spark: SparkSession, folder: str) -> DataFrame:
    return Stages(spark, folder).importance()


@query
def importance_by_family(spark: SparkSession, folder: str) -> DataFrame:
    return models.importance_by_family(Stages(spark, folder).importance())


@query
def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The whole feature store re-aged to a week after it was built, scored by the stored logistic model, with decisions."""
    stages = Stages(spark, folder)
    moment = F.date_add(F.lit(STAR.system_asof).cast("date"), 7)
    store = aging.reage(stages.feature_store(), moment, ranges=STAR.ranges)
    rows = features.align_features(store, keep=[CUSTOMER])
    return scoring.decide(models.predict(stages.logistic(), rows).select(CUSTOMER, "p"), STAR.serving, STAR.economics)


@query
def delayed_label_auc(spark: SparkSession, folder: str) -> DataFrame:
    """AUC of what was scored at each as-of day, from the purchases of the following 90 days."""
    stages = Stages(spark, folder)
    log = stages.scored().select("model", CUSTOMER, F.col(ASOF).alias("scored_on"), "p")
    return shown(ranking.rank_metrics(outcomes.realised_outcomes(log, stages.events(), STAR.system_asof), ["model", "scored_on"]))


@query
def early_engagement(spark: SparkSession, folder: str) -> DataFrame:
    """Scored customers by model, fold and risk band, and whether they bought within two weeks."""
    stages = Stages(spark, folder)
    scored = stages.scored().select("model", "fold", CUSTOMER, F.col(ASOF).alias("contacted_on"), "p")
    return outcomes.early_engagement(scoring.decide(scored), stages.events(), by=["model", "fold"])


@query
def latest_snapshot_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Promotion gates on the latest labelled as-of day only."""
    scored = Stages(spark, folder).scored()
    latest = scored.where(F.col(ASOF) == scored.agg(F.max(ASOF)).scalar())
    panel = ranking.metric_panel(latest).withColumn("incumbent_auc", F.lit(None).cast("double"))
    return campaign.promotion_decision(campaign.gate_checks(panel, STAR.gates))

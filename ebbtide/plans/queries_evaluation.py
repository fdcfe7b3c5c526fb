"""Queries over scored rows: metrics, curves, campaign money and promotion gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ebbtide.contracts import ASOF, CUSTOMER
from ebbtide.operators import campaign, ranking
from ebbtide.plans.queries_features import shown
from ebbtide.plans.registry import query
from ebbtide.settings import STAR
from ebbtide.sources.stages import Stages


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return Stages(spark, folder).scored()


def _of_model(spark: SparkSession, folder: str, model: str) -> DataFrame:
    return _scored(spark, folder).where(F.col("model") == model)


@query
def score_prior(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_of_model(spark, folder, "prior").select(CUSTOMER, ASOF, "p"))


@query
def score_recency(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_of_model(spark, folder, "recency_rule").select(CUSTOMER, ASOF, "p"))


@query
def score_linear(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_of_model(spark, folder, "linear_fixed").select(CUSTOMER, ASOF, "p"))


@query
def metric_auc(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.rank_metrics(_scored(spark, folder)).select("model", "fold", "roc_auc"))


@query
def metric_ap(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.rank_metrics(_scored(spark, folder)).select("model", "fold", "pr_auc"))


@query
def metric_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.threshold_metrics(_scored(spark, folder)).drop("brier", "log_loss", "base_rate", "threshold"))


@query
def metric_proba(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.threshold_metrics(_scored(spark, folder)).select("model", "fold", "base_rate", "brier", "log_loss"))


@query
def topk_mask(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.topk_mask(_scored(spark, folder), 0.20).select("model", "fold", ASOF, CUSTOMER, "rank", "selected")


@query
def metric_topk(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.slice_metrics(_scored(spark, folder)))


@query
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.roc_curve(_scored(spark, folder)))


@query
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.pr_curve(_scored(spark, folder)))


@query
def calibration_curve(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.calibration_curve(_scored(spark, folder))


@query
def gains_curve(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.gains_curve(_scored(spark, folder)))


@query
def campaign_value(spark: SparkSession, folder: str) -> DataFrame:
    return campaign.campaign_value(_scored(spark, folder), STAR.economics)


@query
def campaign_best_model(spark: SparkSession, folder: str) -> DataFrame:
    return campaign.best_model(campaign_value(spark, folder))


@query
def depth_sweep(spark: SparkSession, folder: str) -> DataFrame:
    swept = campaign.campaign_value(_scored(spark, folder), STAR.economics, campaign.depth_grid())
    return shown(swept.select("model", "fold", "capacity", "n_contacted", "true_positives", "net_value"))


@query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.metric_panel(_scored(spark, folder)))


def _with_incumbent(panel: DataFrame) -> DataFrame:
    """The linear scorer plays the live model, the recency rule has none to compare with."""
    live = F.max(F.when(F.col("model") == "linear_fixed", F.col("roc_auc"))).over(W.partitionBy("fold"))
    return panel.withColumn("incumbent_auc", F.when(F.col("model") != "recency_rule", live))


@query
def promotion_gates(spark: SparkSession, folder: str) -> DataFrame:
    return campaign.gate_checks(_with_incumbent(ranking.metric_panel(_scored(spark, folder))), STAR.gates)


@query
def promotion_decision(spark: SparkSession, folder: str) -> DataFrame:
    return campaign.promotion_decision(promotion_gates(spark, folder))


@query
def gate_negative_control(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged versions of every model's scores against the model itself."""
    scored = _scored(spark, folder)
    live = ranking.rank_metrics(scored).select(F.col("model").alias("whole"), F.col("fold").alias("of_fold"), F.col("roc_auc").alias("incumbent_auc"))
    panel = ranking.metric_panel(campaign.damaged_scores(scored))
    same = (F.regexp_replace("model", "^(scrambled|overconfident)_", "") == F.col("whole")) & (F.col("fold") == F.col("of_fold"))
    return campaign.gate_checks(panel.join(F.broadcast(live), same).drop("whole", "of_fold"), STAR.gates)


@query
def snapshot_stability(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.snapshot_stability(_scored(spark, folder)))


@query
def generalisation_gap(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ranking.generalisation_gap(ranking.snapshot_stability(_scored(spark, folder))))

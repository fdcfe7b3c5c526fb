"""Queries over the feature store: lookups, re-ageing, scores and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FEATURES, REAGED
from ebbtide.operators import aging, features, outcomes, ranking, scoring, served
from ebbtide.operators.moments import moment_features
from ebbtide.plans.queries_features import shown
from ebbtide.plans.registry import query
from ebbtide.settings import STAR
from ebbtide.sources import star
from ebbtide.sources.stages import Stages

STORED, LATER = "2001-05-01", "2001-05-08"


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per row of the events table; the user asks for the customer of the same number."""
    return star.table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"), (F.col("user_id") * 11).cast("string").alias(CUSTOMER), F.col("ts").alias("served_at"),
        F.col("value").alias("latency_ms"), F.col("event_type").alias("model_id"))


def _store_scores(spark: SparkSession, folder: str) -> DataFrame:
    return Stages(spark, folder).feature_store().select(CUSTOMER, scoring.linear_score().alias("p"))


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Requests answered with the stored score; requests of unknown customers are misses."""
    scores = _store_scores(spark, folder)
    late = F.greatest(F.datediff("served_at", F.lit("2024-01-15").cast("date")), F.lit(0))
    return _requests(spark, folder).join(scores, CUSTOMER, "left").select(
        "request_id", CUSTOMER, "served_at", "latency_ms", "model_id", F.col("p").alias("probability"),
        (F.col("p") >= 0.5).cast("int").alias("prediction"), F.col("p").isNull().alias("lookup_miss"),
        late.alias("feature_staleness_days"))


@query
def feature_store(spark: SparkSession, folder: str) -> DataFrame:
    """Built from the events, not read back from the written table."""
    return shown(Stages(spark, folder).build_feature_store())


@query
def feature_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = scoring.feature_lookup(_requests(spark, folder), Stages(spark, folder).feature_store())
    return shown(found.select("request_id", CUSTOMER, "recency_days", "orders_90d", "revenue_180d", "country_grp", "lookup_miss"))


@query
def cold_start_ids(spark: SparkSession, folder: str) -> DataFrame:
    misses = scoring.cold_start(_requests(spark, folder), Stages(spark, folder).feature_store())
    return misses.groupBy(CUSTOMER).agg(F.count("*").alias("n_requests"))


@query
def reage_features(spark: SparkSession, folder: str) -> DataFrame:
    """Store rows scored up to two weeks later, the delay depending on the customer."""
    store = Stages(spark, folder).feature_store()
    day = F.date_add("feature_timestamp", (F.col(CUSTOMER).cast("int") % 15))
    aged = aging.reage(store, day, ranges=STAR.ranges)
    return shown(aged.select(CUSTOMER, *REAGED, "feature_staleness_days", "feature_source"))


def _both_days(spark: SparkSession, folder: str) -> DataFrame:
    stages = Stages(spark, folder)
    return features.asof_features(stages.events(), [STORED, LATER], stages.levels(), STAR.ranges, wanted=["avg_interpurchase_gap_days", *REAGED])


@query
def skew_audit(spark: SparkSession, folder: str) -> DataFrame:
    return shown(aging.skew_audit(_both_days(spark, folder), Stages(spark, folder).events(), STORED, LATER, STAR.ranges))


@query
def skew_summary(spark: SparkSession, folder: str) -> DataFrame:
    return shown(aging.skew_summary(aging.skew_audit(_both_days(spark, folder), Stages(spark, folder).events(), STORED, LATER, STAR.ranges)))


@query
def dormant_customers(spark: SparkSession, folder: str) -> DataFrame:
    return aging.dormant_customers(Stages(spark, folder).events(), STORED, LATER)


@query
def decide_contacts(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.decide(_store_scores(spark, folder))


@query
def risk_band_counts(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.band_counts(scoring.decide(_store_scores(spark, folder)))


@query
def campaign_list(spark: SparkSession, folder: str) -> DataFrame:
    chosen = scoring.campaign_list(scoring.decide(_store_scores(spark, folder)), STAR.economics.capacity)
    return chosen.select("rank", CUSTOMER, "p", "risk_band", "expected_value")


@query
def campaign_summary(spark: SparkSession, folder: str) -> DataFrame:
    return campaign_list(spark, folder).agg(
        F.count("*").alias("n_contacted"), F.min("p").alias("min_p"), F.max("p").alias("max_p"),
        F.round(F.sum(F.col("expected_value").cast("decimal(18,3)")).cast("double"), 3).alias("total_expected_value"))


@query
def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    return shown(scoring.score_summary(_store_scores(spark, folder)))


@query
def predlog_by_model(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.log_by_model(prediction_log(spark, folder))


@query
def ops_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.operational_metrics(prediction_log(spark, folder), STAR.serving)


@query
def scoring_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The request stream run twice: what its log holds per model."""
    stages = Stages(spark, folder)
    stages.served_log()
    return shown(served.log_summary(stages.served_log()))


@query
def served_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the prediction log, with one of the features served."""
    return shown(Stages(spark, folder).served_log().select(
        "request_id", CUSTOMER, "served_at", "model_id", "lookup_miss", "feature_staleness_days", F.col("features")["recency_days"].alias("recency_days"),
        "probability", "prediction", "risk_band", "expected_value"))


@query
def moment_features_served(spark: SparkSession, folder: str) -> DataFrame:
    """Features of every customer and day in the log, each as of its own day."""
    stages = Stages(spark, folder)
    asked = stages.requests().select(CUSTOMER, F.to_date("served_at").alias(ASOF))
    return shown(moment_features(stages.events(), asked, stages.levels(), STAR.ranges).drop("has_history"))


@query
def production_skew_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Features as logged against features recomputed at the moment of each request."""
    stages = Stages(spark, folder)
    return shown(served.skew_of_served(served.recomputed(stages.served_log(), stages.events(), stages.levels(), STAR.ranges)))


@query
def delayed_label_auc_logged(spark: SparkSession, folder: str) -> DataFrame:
    """AUC per model of the logged answers whose 90 days have passed, from the purchases that followed."""
    stages = Stages(spark, folder)
    log = stages.served_log().where(~F.col("lookup_miss")).select(
        F.col("model_id").alias("model"), CUSTOMER, F.to_date("served_at").alias("scored_on"), F.col("probability").alias("p"))
    return shown(ranking.rank_metrics(outcomes.realised_outcomes(log, stages.events(), STAR.system_asof), ["model"]))


@query
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """From raw lines to a contact list: features, in-scope customers, recency score, top fifth at one day."""
    from ebbtide.operators import snapshots

    stages, day = Stages(spark, folder), "2001-01-31"
    rows = snapshots.with_fold(snapshots.snapshot_build(stages.events(), [day], STAR, stages.levels()), STAR.split)
    score = scoring.recency_score(stages.training().where("fold = 'train'"))
    scored = rows.select(CUSTOMER, ASOF, "recency_days", "revenue_180d", "country_grp", "churn_90d", score.alias("p"))
    chosen = scoring.campaign_list(scoring.decide(scored), STAR.economics.capacity)
    return shown(chosen.select("rank", CUSTOMER, "p", "risk_band", "expected_value", "recency_days", "revenue_180d", "country_grp", "churn_90d"))

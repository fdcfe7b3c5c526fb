"""Queries over reference profiles, drift, data quality and the retraining policy."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, NUMERIC, feature_catalogue
from ebbtide.operators import monitoring as M
from ebbtide.operators import features, ranking, retrain, scoring
from ebbtide.plans.queries_features import shown
from ebbtide.plans.registry import query
from ebbtide.settings import STAR
from ebbtide.sources.stages import Stages


def _fold(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    return Stages(spark, folder).training().where(F.col("fold").isin(*names))


def _train(spark: SparkSession, folder: str) -> DataFrame:
    return _fold(spark, folder, "train")


def _batch(spark: SparkSession, folder: str) -> DataFrame:
    return _fold(spark, folder, "test")


def _later(spark: SparkSession, folder: str) -> DataFrame:
    return _fold(spark, folder, "valid", "purged", "test")


def _profile(spark: SparkSession, folder: str) -> M.Profile:
    return Stages(spark, folder).profile()


def _scores(spark: SparkSession, folder: str, fold: str, model: str = "recency_rule") -> DataFrame:
    return Stages(spark, folder).scored().where((F.col("model") == model) & (F.col("fold") == fold))


@query
def ref_profile_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return shown(M.numeric_profile(_train(spark, folder), STAR.monitor).drop("edges"))


@query
def ref_profile_bins(spark: SparkSession, folder: str) -> DataFrame:
    train = _train(spark, folder)
    bins = M.expected_bins(train, M.numeric_profile(train, STAR.monitor))
    open_end = lambda c: F.when(F.abs(c) != F.lit(float("inf")), F.col(c)).alias(c)
    return shown(bins.select("feature", "bin", open_end("lo"), open_end("hi"), "expected_pct"))


@query
def ref_profile_categorical(spark: SparkSession, folder: str) -> DataFrame:
    return shown(M.categorical_profile(_train(spark, folder)))


@query
def ref_profile_target(spark: SparkSession, folder: str) -> DataFrame:
    return shown(M.target_rate(_train(spark, folder)))


@query
def profile_by_family(spark: SparkSession, folder: str) -> DataFrame:
    """The feature catalogue joined to the observed profile: features and mean null rate per family and kind."""
    profile = M.numeric_profile(_train(spark, folder), STAR.monitor)
    joined = profile.join(F.broadcast(feature_catalogue(spark)), "feature")
    return shown(joined.groupBy("family", "window_days", "reaged").agg(F.count("*").alias("n_features"), F.avg("null_rate").alias("mean_null_rate")))


@query
def psi_numeric(spark: SparkSession, folder: str) -> DataFrame:
    psi = M.psi_numeric(_batch(spark, folder), _profile(spark, folder))
    return shown(psi.withColumn("severity", M.severity(F.col("psi"), STAR.monitor)))


@query
def psi_categorical(spark: SparkSession, folder: str) -> DataFrame:
    """The batch carries one level the training rows never had."""
    batch = _batch(spark, folder).withColumn("country_grp", F.when(F.col("country_grp") == "Other", F.lit("Elsewhere")).otherwise(F.col("country_grp")))
    psi = M.psi_categorical(batch, _profile(spark, folder))
    return shown(psi.withColumn("severity", M.severity(F.col("psi"), STAR.monitor)))


@query
def ks_two_sample(spark: SparkSession, folder: str) -> DataFrame:
    return shown(M.ks_two_sample(_train(spark, folder), _batch(spark, folder), STAR.monitor))


@query
def feature_drift(spark: SparkSession, folder: str) -> DataFrame:
    return shown(M.feature_drift(_profile(spark, folder), _train(spark, folder), _batch(spark, folder), STAR.monitor))


@query
def top_drifting(spark: SparkSession, folder: str) -> DataFrame:
    return M.top_drifting(M.feature_drift(_profile(spark, folder), _train(spark, folder), _batch(spark, folder), STAR.monitor)).select("feature", "kind", F.round("psi", 6).alias("psi"), "severity")


@query
def drift_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return M.drift_rollup(M.feature_drift(_profile(spark, folder), _train(spark, folder), _batch(spark, folder), STAR.monitor), STAR.monitor)


@query
def drift_injected(spark: SparkSession, folder: str) -> DataFrame:
    """Per-feature PSI of the real batch next to the same batch with a unit error and late recency."""
    batch = _batch(spark, folder)
    both = batch.withColumn("scenario", F.lit("real")).unionByName(M.shifted_batch(batch, STAR.ranges).withColumn("scenario", F.lit("injected")))
    return shown(M.psi_table(_profile(spark, folder), both, ["scenario"], STAR.monitor))


@query
def drift_contrast(spark: SparkSession, folder: str) -> DataFrame:
    return M.drift_rollup(drift_injected(spark, folder), STAR.monitor, ["scenario"]).drop("n_confirmed")


@query
def drift_by_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    table = M.psi_table(_profile(spark, folder), _later(spark, folder), [ASOF], STAR.monitor)
    return M.drift_rollup(table, STAR.monitor, [ASOF]).drop("n_confirmed")


@query
def prediction_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Drift of the scores of every rule-based model."""
    parts = [
        M.prediction_drift(_scores(spark, folder, "train", m), _scores(spark, folder, "test", m), STAR.monitor).select(F.lit(m).alias("model"), "*")
        for m in scoring.RULE_MODELS]
    return shown(reduce(DataFrame.unionByName, parts))


@query
def dq_findings(spark: SparkSession, folder: str) -> DataFrame:
    """The batch against the narrow one-year bounds, which its long tenures break."""
    return M.quality_findings(_batch(spark, folder), thresholds=STAR.monitor)


@query
def dq_injected(spark: SparkSession, folder: str) -> DataFrame:
    return M.quality_findings(M.faulty_batch(_batch(spark, folder)), STAR.ranges, STAR.monitor)


@query
def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows as one batch: every customer seen at several as-of days is a repeated entity."""
    return M.quality_findings(_train(spark, folder), STAR.ranges, STAR.monitor)


@query
def dq_rollup(spark: SparkSession, folder: str) -> DataFrame:
    scenarios = {"healthy": _batch(spark, folder), "faulty": M.faulty_batch(_batch(spark, folder)), "repeated": _train(spark, folder)}
    rows = [M.quality_rollup(M.quality_findings(b, STAR.ranges, STAR.monitor)).withColumn("scenario", F.lit(n)) for n, b in scenarios.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def row_contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rows outside the one-year bounds, with the offending fields."""
    bad = M.row_violations(_batch(spark, folder)).where("size(violations) > 0")
    return bad.select(CUSTOMER, F.array_join("violations", ",").alias("violations"))


@query
def monitoring_suite(spark: SparkSession, folder: str) -> DataFrame:
    """Check rows for the real batch, the shifted batch, and a batch that lost a column."""
    profile, train, batch = _profile(spark, folder), _train(spark, folder), _batch(spark, folder)
    scores = _scores(spark, folder, "train"), _scores(spark, folder, "test")
    late = M.shifted_batch(batch, STAR.ranges)
    late_scores = late.select(scoring.recency_score(train).alias("p"))
    parts = [
        M.suite(profile, batch, "real", *scores, STAR.ranges, STAR.monitor),
        M.suite(profile, late, "injected", scores[0], late_scores, STAR.ranges, STAR.monitor),
        M.suite(profile, batch.drop("orders_90d"), "lost_column", ranges=STAR.ranges, thresholds=STAR.monitor),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("batch", "check", "severity", "passed", "low_power")


@query
def top_contributions(spark: SparkSession, folder: str) -> DataFrame:
    profile = _profile(spark, folder).numeric.select("feature", "mean", "std")
    rated = scoring.top_contributions(_batch(spark, folder), profile, STAR.serving.top_contributions)
    return rated.select(CUSTOMER, "place", F.abs("z_score").alias("abs_z"))


def _signals(spark: SparkSession, folder: str, damaged: str | None = None) -> DataFrame:
    """Nightly signals; each night's batch is checked as it arrives, the one of ``damaged`` without a column."""
    stages, later = Stages(spark, folder), _later(spark, folder)
    rule = stages.scored().where("model = 'recency_rule'")
    auc = ranking.rank_metrics(rule.where("fold != 'train'"), [ASOF])
    promoted = ranking.rank_metrics(rule.where("fold = 'valid'"), ["model"]).select("roc_auc")
    quality = M.quality_findings(later, STAR.ranges, STAR.monitor, [ASOF])
    nights = [*STAR.split.valid, *STAR.split.purged, *STAR.split.test]
    found = {d: M.schema_findings(later.drop("orders_90d") if d == damaged else later) for d in nights}
    broken = [date.fromisoformat(d) for d, schema in found.items() if schema["missing"] or schema["wrong_type"]]
    return shown(retrain.nightly_signals(later, auc, promoted, drift_by_snapshot(spark, folder), quality, stages.events(), STAR, broken))


@query
def retrain_signals(spark: SparkSession, folder: str) -> DataFrame:
    return _signals(spark, folder)


@query
def retrain_decision(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(retrain_signals(spark, folder))


@query
def retrain_decision_broken_night(spark: SparkSession, folder: str) -> DataFrame:
    """The same nights, one of whose batches arrives without a column: that night is blocked."""
    return _decided(_signals(spark, folder, damaged=STAR.split.purged[0]))


def _decided(signals: DataFrame) -> DataFrame:
    decided = retrain.retrain_decision(signals, STAR.retrain)
    return decided.select("night", "should_retrain", "urgency", F.array_join("fired", ",").alias("fired"), F.array_join("blocked_by", ",").alias("blocked_by"))


@query
def feature_schema_check(spark: SparkSession, folder: str) -> DataFrame:
    """What the schema check says of a batch that lost a column, gained one and has one as text, with the batch's rows."""
    batch = _batch(spark, folder)
    found = M.schema_findings(batch.drop("orders_90d").withColumns({"tenure_days": F.col("tenure_days").cast("string"), "note": F.lit("x")}))
    listed = F.array(*[F.struct(F.lit(k).alias("finding"), F.lit(c).alias("column_name")) for k, cs in found.items() for c in cs])
    return batch.where("fold IS NOT NULL").groupBy().agg(F.count("*").alias("n_rows")).select(F.inline(listed), "n_rows")


@query
def align_features(spark: SparkSession, folder: str) -> DataFrame:
    """Batch rows that arrive in another order and without two columns, put into contract order with defaults."""
    batch = _batch(spark, folder)
    arrived = batch.select(CUSTOMER, *sorted(set(features.FEATURES) - {"recency_days", "country_grp"}, reverse=True))
    return shown(features.align_features(arrived, strict=False, keep=[CUSTOMER]))

"""Whether to retrain: rules over a table of nightly signals."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ebbtide.contracts import ASOF
from ebbtide.settings import RetrainPolicy, Settings

SIGNALS = [
    "model_age_days", "new_labelled_snapshots", "recent_auc", "auc_at_promotion", "drift_share", "drift_status",
    "schema_ok", "data_quality_ok", "rows_since_training",
]


def nightly_signals(batches: DataFrame, auc: DataFrame, promotion_auc: DataFrame, drift: DataFrame, quality: DataFrame, events: DataFrame, settings: Settings, broken: list[date] = []) -> DataFrame:
    """Signals on the night each later snapshot's labels mature.

    ``batches`` has the as-of days to judge, ``auc`` (as-of, roc_auc) of the live model, ``promotion_auc``
    one value, from the fold it was promoted on, ``drift`` the rollup per as-of day, ``quality`` the findings
    per as-of day, ``broken`` the as-of days whose batch does not have the contract's columns.
    """
    horizon, trained = settings.label.horizon_days, max(settings.split.train)
    nights = batches.select(ASOF).distinct().withColumn("night", F.date_add(ASOF, horizon))
    waiting = [date.fromisoformat(d) for d in settings.snapshots if d not in settings.split.train]
    mature = F.size(F.filter(F.array(*[F.lit(d) for d in waiting]), lambda d: F.date_add(d, horizon) <= F.col("night")))
    per_day = events.where(F.col("event_date") > F.lit(trained).cast("date")).groupBy("event_date").agg(F.count("*").alias("n"))
    later = F.filter(F.array(*[F.lit(d + timedelta(days=horizon)) for d in waiting]), lambda night: F.col("event_date") <= night)
    since = per_day.withColumn("night", F.explode(later)).groupBy("night").agg(F.sum("n").alias("rows_since_training"))
    alarms = quality.groupBy(ASOF).agg(F.count_if(F.col("severity") == "alert").alias("n_alarms"))
    return (
        nights.join(auc.select(ASOF, F.col("roc_auc").alias("recent_auc")), ASOF, "left")
        .join(drift.select(ASOF, "drift_share", F.col("severity").alias("drift_status")), ASOF, "left")
        .join(alarms, ASOF, "left").join(since, "night", "left")
        .select(
            "night", F.datediff("night", F.lit(trained).cast("date")).alias("model_age_days"), mature.alias("new_labelled_snapshots"),
            "recent_auc", promotion_auc.scalar().alias("auc_at_promotion"), F.coalesce("drift_share", F.lit(0.0)).alias("drift_share"),
            F.coalesce("drift_status", F.lit("ok")).alias("drift_status"), (~F.col(ASOF).isin(broken) if broken else F.lit(True)).alias("schema_ok"),
            (F.coalesce("n_alarms", F.lit(0)) == 0).alias("data_quality_ok"), F.coalesce("rows_since_training", F.lit(0)).alias("rows_since_training")))


def retrain_decision(signals: DataFrame, policy: RetrainPolicy = RetrainPolicy()) -> DataFrame:
    """Blocks first; measured degradation is enough alone; age and drift also need fresh labels."""
    fresh = F.col("new_labelled_snapshots") >= policy.min_new_labelled_snapshots
    drop = F.col("auc_at_promotion") - F.col("recent_auc")
    degraded = F.coalesce(drop >= policy.auc_drop, F.lit(False))
    stale = F.col("model_age_days") >= policy.max_model_age_days
    drifting = (F.col("drift_status") == "alert") | (F.col("drift_share") >= policy.drift_share)
    listed = lambda *pairs: F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]))
    blocked = listed(("schema_break", ~F.col("schema_ok")), ("data_quality_failure", ~F.col("data_quality_ok")))
    fired = listed(("performance_degradation", degraded), ("model_staleness", stale & fresh), ("feature_drift", drifting & fresh))
    performance = F.when(drop.isNull(), F.lit("performance not measurable yet")).when(degraded, F.lit("AUC dropped")).otherwise(F.lit("performance holding"))
    reasons = F.array_compact(F.array(
        F.when(~F.col("schema_ok"), F.lit("schema break blocks retraining")),
        F.when(~F.col("data_quality_ok"), F.lit("data-quality alert blocks retraining")),
        performance,
        F.when(fresh, F.lit("fresh labels exist")).otherwise(F.lit("no fresh labels")),
        F.when(stale & fresh, F.lit("model is stale: scheduled refresh")).when(stale, F.lit("model is stale, but nothing new to learn from")),
        F.when(drifting & fresh, F.lit("drift with fresh labels: learn the new regime")).when(drifting, F.lit("drift without fresh labels: investigate and wait")),
    ))
    ruled = signals.withColumns({"blocked_by": blocked, "fired": fired, "reasons": reasons})
    ruled = ruled.withColumn("should_retrain", (F.size("blocked_by") == 0) & (F.size("fired") > 0))
    urgency = (
        F.when(F.size("blocked_by") > 0, F.lit("blocked")).when(F.array_contains("fired", "performance_degradation"), F.lit("high"))
        .when(F.col("should_retrain"), F.lit("scheduled")).otherwise(F.lit("none")))
    idle = F.when((F.size("blocked_by") == 0) & (F.size("fired") == 0), F.array(F.lit("no trigger fired"))).otherwise(F.array().cast("array<string>"))
    return ruled.withColumn("urgency", urgency).withColumn("reasons", F.concat("reasons", idle))

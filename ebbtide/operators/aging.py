"""Bring stored feature rows forward to a scoring day, and measure what that leaves wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, GAP_SENTINEL, RANGES, REAGED
from ebbtide.functions.exact import clip_to, per


def reage(stored: DataFrame, scoring_day: Column, stamp: str = "feature_timestamp", ranges: dict = RANGES) -> DataFrame:
    """Age the time-dependent features by the whole days since they were computed.

    Exact for customers without new purchases in between. Rows of the same day pass unchanged. The ratios
    use the clipped day counts. Adds ``feature_staleness_days`` and ``feature_source``.
    """
    age = F.greatest(F.datediff(scoring_day, F.coalesce(F.col(stamp).cast("date"), scoring_day)), F.lit(0))
    aged = stored.withColumn("_age", age)
    later = F.col("_age") > 0
    recency = clip_to(ranges, "recency_days", F.coalesce("recency_days", F.lit(0.0)) + F.col("_age"))
    tenure = clip_to(ranges, "tenure_days", F.coalesce("tenure_days", F.lit(0.0)) + F.col("_age"))
    aged = aged.withColumns({"_recency": recency, "_tenure": tenure})
    ratio = clip_to(ranges, "active_days_ratio", (F.col("_tenure") - F.col("_recency")) / (F.col("_tenure") + 1.0))
    overdue = clip_to(ranges, "recency_over_avg_gap", per(F.col("_recency"), F.coalesce("avg_interpurchase_gap_days", F.lit(GAP_SENTINEL))))
    fresh = {"recency_days": F.col("_recency"), "tenure_days": F.col("_tenure"), "active_days_ratio": ratio, "recency_over_avg_gap": overdue}
    return aged.withColumns({
        **{f: F.when(later, fresh[f]).otherwise(F.col(f)) for f in REAGED},
        "feature_staleness_days": F.col("_age").cast("int"),
        "feature_source": F.lit("feature_store"),
    }).drop("_age", "_recency", "_tenure")


def buyers_between(events: DataFrame, after: str, until: str) -> DataFrame:
    """Customers with a sale in (after, until]."""
    day = F.col("event_date")
    return events.where(~F.col("is_return") & (day > F.lit(after).cast("date")) & (day <= F.lit(until).cast("date"))).select(CUSTOMER).distinct()


def dormant_customers(events: DataFrame, stored_day: str, scoring_day: str) -> DataFrame:
    """Customers with history by the stored day and no purchase until the scoring day."""
    known = events.where(F.col("event_date") <= F.lit(stored_day).cast("date")).select(CUSTOMER).distinct()
    return known.join(buyers_between(events, stored_day, scoring_day), CUSTOMER, "left_anti")


def skew_audit(features_at_both: DataFrame, events: DataFrame, stored_day: str, scoring_day: str, ranges: dict = RANGES) -> DataFrame:
    """Per customer and re-aged feature: stored, re-aged and recomputed values and their differences.

    ``features_at_both`` holds feature rows at the stored and the scoring day, built in one pass.
    """
    at = lambda day: features_at_both.where(F.col(ASOF) == F.lit(day).cast("date"))
    stored = at(stored_day).select(CUSTOMER, "avg_interpurchase_gap_days", *REAGED, F.col(ASOF).alias("feature_timestamp"))
    aged = reage(stored, F.lit(scoring_day).cast("date"), ranges=ranges)
    fresh = at(scoring_day).select(CUSTOMER, *[F.col(f).alias(f"_now_{f}") for f in REAGED])
    raw = stored.select(CUSTOMER, *[F.col(f).alias(f"_old_{f}") for f in REAGED])
    active = buyers_between(events, stored_day, scoring_day).withColumn("active", F.lit(True))
    wide = aged.join(fresh, CUSTOMER).join(raw, CUSTOMER).join(active, CUSTOMER, "left")
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_old_{f}").alias("stored"), F.col(f).alias("reaged"), F.col(f"_now_{f}").alias("recomputed"))
        for f in REAGED
    ])
    return wide.select(CUSTOMER, F.coalesce("active", F.lit(False)).alias("active_in_interval"), F.inline(rows)).withColumns({
        "skew_after_reaging": F.abs(F.col("reaged") - F.col("recomputed")),
        "error_if_stale": F.abs(F.col("stored") - F.col("recomputed")),
    })


def skew_summary(audit: DataFrame) -> DataFrame:
    """Largest differences per feature for quiet and for active customers."""
    return audit.groupBy("feature", "active_in_interval").agg(
        F.count("*").alias("n_customers"),
        F.max("skew_after_reaging").alias("max_skew"), F.max("error_if_stale").alias("max_error_if_stale"))

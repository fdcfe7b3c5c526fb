"""Scores from rules and fixed weights, and the decisions taken on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, LABEL, NUMERIC
from ebbtide.functions.ordered import attach_row, exact_quantiles, ranked
from ebbtide.settings import Economics, ServingRules

RULE_MODELS = ("prior", "recency_rule", "linear_fixed")  # tiers that need no fit

# A transparent scorer for tables without a fitted model: intercept, then (feature, centre, weight).
LINEAR_INTERCEPT = 0.8
LINEAR_WEIGHTS = (
    ("recency_days", 60.0, 0.01),
    ("recency_over_avg_gap", 0.5, 0.1),
    ("orders_30d", 0.0, -0.15),
    ("orders_90d", 1.0, -0.25),
)


def prior_score(train: DataFrame) -> Column:
    """The training base rate, the same for everyone."""
    return train.agg(F.avg(LABEL)).scalar()


def recency_score(train: DataFrame) -> Column:
    """Recency scaled between its 1st and 99th training percentile, kept off 0 and 1."""
    bounds = exact_quantiles(train, "recency_days", [(1, 100), (99, 100)])
    low, high = (bounds.select(F.element_at("quantiles", i)).scalar() for i in (1, 2))
    scaled = (F.coalesce(F.col("recency_days"), low) - low) / F.greatest(high - low, F.lit(1e-9))
    return F.least(F.greatest(scaled, F.lit(0.001)), F.lit(0.999))


def linear_score() -> Column:
    z = F.lit(LINEAR_INTERCEPT)
    for name, centre, weight in LINEAR_WEIGHTS:
        z = z + (F.col(name) - F.lit(centre)) * F.lit(weight)
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 9)


def scored_long(table: DataFrame) -> DataFrame:
    """(model, fold, as-of, customer, y, p) for the rule-based tiers, parameters taken from the train fold."""
    train = table.where("fold = 'train'")
    scores = table.withColumns({"_prior": prior_score(train), "_recency": recency_score(train), "_linear": linear_score()})
    models = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(column).alias("p"))
        for name, column in zip(RULE_MODELS, ("_prior", "_recency", "_linear"), strict=True)
    ])
    return scores.select("fold", ASOF, CUSTOMER, F.col(LABEL).alias("y"), F.inline(models)).select("model", "fold", ASOF, CUSTOMER, "y", "p")


def decide(scores: DataFrame, rules: ServingRules = ServingRules(), economics: Economics = Economics(), requested: str | None = None, registered: Column | None = None) -> DataFrame:
    """Threshold decision, risk band and expected value of contacting, from the probability ``p``.

    The threshold is the requested one if the row has it, else the registered one, else the default.
    """
    options = [F.col(requested)] if requested else []
    threshold = F.coalesce(*options, *([registered] if registered is not None else []), F.lit(rules.default_threshold))
    band = F.when(F.col("p") >= rules.high_risk, F.lit("high")).when(F.col("p") >= rules.medium_risk, F.lit("medium")).otherwise(F.lit("low"))
    value = F.col("p") * F.lit(economics.uplift) * F.lit(economics.margin) - F.lit(economics.offer_cost)
    return scores.withColumns({
        "threshold": threshold, "prediction": (F.col("p") >= threshold).cast("int"),
        "risk_band": band, "expected_value": F.round(value, 3),
    })


def band_counts(decided: DataFrame) -> DataFrame:
    return decided.groupBy("risk_band").agg(F.count("*").alias("n"))


def campaign_list(decided: DataFrame, capacity: float = 0.20) -> DataFrame:
    """The top floor(n * capacity) customers by probability, ties by id, with their rank."""
    rows = decided.withColumn("_minus", -F.col("p"))
    order = ranked(rows, ["_minus", CUSTOMER]).drop("_minus")
    size = decided.agg(F.floor(F.count("*") * F.lit(capacity)).cast("long")).scalar()
    return order.where(F.col("rank") <= size)


def score_summary(scores: DataFrame) -> DataFrame:
    """Count, mean and median of the probabilities."""
    median = exact_quantiles(scores, "p", [(1, 2)]).select(F.element_at("quantiles", 1)).scalar()
    return scores.agg(F.count("*").alias("n"), F.avg("p").alias("mean_p")).withColumn("p50", median)


def feature_lookup(requests: DataFrame, store: DataFrame) -> DataFrame:
    """Each request with stored features of the customer, the latest, or marked as a miss."""
    found = latest_per_customer(store).withColumn("_found", F.lit(True))
    return requests.join(found, CUSTOMER, "left").withColumn("lookup_miss", F.col("_found").isNull()).drop("_found")


def cold_start(requests: DataFrame, store: DataFrame) -> DataFrame:
    """Requested customers that have no stored features."""
    return requests.join(store.select(CUSTOMER).distinct(), CUSTOMER, "left_anti")


def latest_per_customer(store: DataFrame) -> DataFrame:
    """The newest row per customer, reduced before the shuffle, so piled-up versions of one id stay cheap."""
    rest = [c for c in store.columns if c not in (CUSTOMER, "feature_timestamp")]
    newest = store.groupBy(CUSTOMER).agg(F.max(F.struct("feature_timestamp", *rest)).alias("_row"))
    return newest.select(CUSTOMER, "_row.*").select(*store.columns)


def top_contributions(rows: DataFrame, profile: DataFrame, k: int = 5) -> DataFrame:
    """The k features of each row furthest from the training mean, in training standard deviations.

    ``profile`` has one row per numeric feature with ``mean`` and ``std``; it becomes one small map.
    """
    lookup = profile.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std"))))).scalar()
    listed = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in NUMERIC])
    z = lambda e: (e["value"] - F.element_at("_ref", e["feature"])["mean"]) / F.greatest(F.element_at("_ref", e["feature"])["std"], F.lit(1e-9))
    rated = F.transform(listed, lambda e: F.struct(
        (-F.abs(F.round(z(e), 3))).alias("order"), e["feature"].alias("feature"), e["value"].alias("value"),
        F.element_at("_ref", e["feature"])["mean"].alias("training_mean"), F.round(z(e), 3).alias("z_score")))
    best = F.slice(F.array_sort(rated), 1, k)
    return rows.withColumn("_ref", lookup).select(CUSTOMER, F.posexplode(best).alias("position", "e")).select(
        CUSTOMER, (F.col("position") + 1).alias("place"), "e.feature", F.round("e.value", 4).alias("value"),
        F.round("e.training_mean", 4).alias("training_mean"), "e.z_score")


def log_by_model(log: DataFrame) -> DataFrame:
    """Predictions, mean probability and mean latency per model of a prediction log."""
    return log.groupBy("model_id").agg(
        F.count("*").alias("n"), F.round(F.avg("probability"), 4).alias("mean_prob"), F.round(F.avg("latency_ms"), 4).alias("mean_latency_ms"))


def operational_metrics(log: DataFrame, rules: ServingRules = ServingRules()) -> DataFrame:
    """Per day of the log: requests, misses, stale servings, and latency percentiles, breach flag, mean
    probability and positive rate of the predictions that were made."""
    daily = log.withColumn("day", F.to_date("served_at"))
    made = daily.where(~F.col("lookup_miss"))
    whole = daily.groupBy("day").agg(
        F.count("*").alias("requests_total"), F.count_if("lookup_miss").alias("lookup_misses"),
        F.count_if(F.col("feature_staleness_days") > 0).alias("stale_servings"))
    means = made.groupBy(F.col("day").alias("m_day")).agg(
        F.count("*").alias("n_predictions"), F.avg("latency_ms").alias("latency_mean"),
        F.avg("probability").alias("mean_probability"), F.avg(F.col("prediction").cast("double")).alias("positive_rate"))
    quantiles = exact_quantiles(made, "latency_ms", [(1, 2), (19, 20), (99, 100)], ["day"]).select(F.col("day").alias("q_day"), "quantiles")
    quantile = lambda i: F.round(F.get("quantiles", F.lit(i)), 6)
    joined = whole.join(means, F.col("day").eqNullSafe(F.col("m_day")), "left").join(quantiles, F.col("day").eqNullSafe(F.col("q_day")), "left")
    return joined.select(
        "day", "requests_total", "lookup_misses", "stale_servings", F.coalesce("n_predictions", F.lit(0)).alias("n_predictions"), F.round("latency_mean", 6).alias("latency_mean"),
        quantile(0).alias("latency_p50"), quantile(1).alias("latency_p95"), quantile(2).alias("latency_p99"),
        (F.get("quantiles", F.lit(1)) > rules.latency_slo_ms).alias("slo_breached"),
        F.round("mean_probability", 6).alias("mean_probability"), F.round("positive_rate", 6).alias("positive_rate"))

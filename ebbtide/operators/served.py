"""Answers to scoring requests, the log record with the features they were given, and its later audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ebbtide.contracts import ASOF, CATEGORICAL, CUSTOMER, FEATURES, NUMERIC, RANGES
from ebbtide.operators.aging import reage
from ebbtide.operators.moments import moment_features
from ebbtide.operators.scoring import decide, feature_lookup
from ebbtide.settings import Economics, ServingRules

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField(CUSTOMER, T.StringType()),
    T.StructField("served_at", T.TimestampNTZType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("model_id", T.StringType()),
])
LOG_SCHEMA = T.StructType(REQUEST_SCHEMA.fields + [
    T.StructField("lookup_miss", T.BooleanType()),
    T.StructField("feature_timestamp", T.DateType()),
    T.StructField("feature_staleness_days", T.IntegerType()),
    T.StructField("features", T.StructType([T.StructField(f, T.StringType() if f in CATEGORICAL else T.DoubleType()) for f in FEATURES])),
    T.StructField("probability", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("risk_band", T.StringType()),
    T.StructField("expected_value", T.DoubleType()),
])


def answer(requests: DataFrame, store: DataFrame, score: Column, ranges: dict = RANGES,
           rules: ServingRules = ServingRules(), economics: Economics = Economics()) -> DataFrame:
    """One log record per request: stored features brought forward to the request's day, score and decision.

    A customer without stored features is a miss; its record has no features and no answer.
    """
    ids = requests.select(CUSTOMER).distinct()
    known = store.join(ids, CUSTOMER, "left_semi").select(CUSTOMER, "feature_timestamp", *FEATURES)
    found = reage(feature_lookup(requests, known), F.to_date("served_at"), ranges=ranges)
    decided = decide(found.withColumn("p", F.when(~F.col("lookup_miss"), score)), rules, economics)
    made = lambda c: F.when(~F.col("lookup_miss"), c)
    answers = decided.withColumns({
        "probability": F.col("p"), "features": made(F.struct(*FEATURES)), "feature_staleness_days": made(F.col("feature_staleness_days")),
        **{c: made(F.col(c)) for c in ("threshold", "prediction", "risk_band", "expected_value")},
    })
    return answers.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields])


def recomputed(log: DataFrame, events: DataFrame, levels: DataFrame | list[str], ranges: dict = RANGES) -> DataFrame:
    """Per logged answer and numeric feature: the served value and the one recomputed as of the moment of serving.

    ``bought_since`` tells whether the customer had a sale after the features were stored.
    """
    made = log.where(~F.col("lookup_miss")).withColumn(ASOF, F.to_date("served_at"))
    truth = moment_features(events, made, levels, ranges).select(CUSTOMER, ASOF, F.struct(*FEATURES).alias("truth"))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col("features")[f].alias("served"), F.col("truth")[f].alias("recomputed")) for f in NUMERIC])
    bought = F.col("truth")["recency_days"] < F.col("feature_staleness_days")
    return made.join(truth, [CUSTOMER, ASOF]).select("request_id", "model_id", CUSTOMER, "served_at", bought.alias("bought_since"), F.inline(pairs)).withColumn(
        "skew", F.abs(F.col("served") - F.col("recomputed")))


def skew_of_served(rows: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Answers, answers whose served value was off, and the largest and mean difference, per model, feature and activity."""
    return rows.groupBy("model_id", "feature", "bought_since").agg(
        F.count("*").alias("n_answers"), F.count_if(F.col("skew") > tolerance).alias("n_skewed"),
        F.max("skew").alias("max_skew"), F.avg("skew").alias("mean_skew"))


def log_summary(log: DataFrame) -> DataFrame:
    """Per model: requests, misses, answers, positive answers, mean probability and the oldest features used."""
    return log.groupBy("model_id").agg(
        F.count("*").alias("n_requests"), F.countDistinct("request_id").alias("n_request_ids"), F.count_if("lookup_miss").alias("n_misses"),
        F.count("probability").alias("n_answers"), F.count_if(F.col("prediction") == 1).alias("n_positive"),
        F.avg("probability").alias("mean_probability"), F.max("feature_staleness_days").alias("max_staleness_days"))

"""What became of predictions and contacts once later purchases are known."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ebbtide.contracts import CUSTOMER


def next_purchase_within(rows: DataFrame, events: DataFrame, since: str, days: int) -> DataFrame:
    """Add ``bought``: a sale in (since, since + days].

    Moments and sale days of a customer are put in one time line and each moment looks up the next sale,
    so no pairs are formed and a customer is never larger than their calendar.
    """
    moments = rows.select(CUSTOMER, F.col(since).alias("day"), F.lit(1).alias("kind")).distinct()
    sales = events.where("NOT is_return").select(CUSTOMER, F.col("event_date").alias("day"), F.lit(0).alias("kind")).distinct()
    # Read backwards, so that the frame only grows: the latest sale seen is the next one to come.
    ahead = W.partitionBy(CUSTOMER).orderBy(F.desc("day"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)
    following = F.last(F.when(F.col("kind") == 0, F.col("day")), ignorenulls=True).over(ahead)
    line = moments.unionByName(sales).withColumn("_next", following).where("kind = 1")
    joined = rows.join(line.select(CUSTOMER, F.col("day").alias(since), "_next"), [CUSTOMER, since], "left")
    return joined.withColumn("bought", F.coalesce(F.col("_next") <= F.date_add(F.col(since), days), F.lit(False))).drop("_next")


def realised_outcomes(log: DataFrame, events: DataFrame, now: str, horizon_days: int = 90) -> DataFrame:
    """Logged predictions whose horizon has passed, with the realised label ``y``."""
    mature = log.where(F.date_add("scored_on", horizon_days) <= F.lit(now).cast("date"))
    return next_purchase_within(mature, events, "scored_on", horizon_days).withColumn("y", F.when(F.col("bought"), 0).otherwise(1))


def early_engagement(contacts: DataFrame, events: DataFrame, since: str = "contacted_on", days: int = 14, by: list[str] = []) -> DataFrame:
    """Contacted customers, those who bought within the first days, and their share, per risk band (and ``by``)."""
    return next_purchase_within(contacts, events, since, days).groupBy(*by, "risk_band").agg(
        F.count("*").alias("n_contacted"), F.count_if("bought").alias("n_engaged"),
        F.round(F.avg(F.col("bought").cast("int")), 6).alias("engagement_rate"))

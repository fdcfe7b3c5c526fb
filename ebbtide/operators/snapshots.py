"""Populations, forward labels, snapshot tables and the temporal split."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FEATURES, LABEL
from ebbtide.functions.exact import dates
from ebbtide.operators.features import asof_features, top_countries
from ebbtide.settings import Settings, SplitSpec


def _sales_in(events: DataFrame, asofs: list[str], after: int, until: int) -> DataFrame:
    """(as-of, customer) pairs with a sale in (as-of + after, as-of + until] days; one row per pair."""
    day, days = F.col("event_date"), dates(asofs)
    low, high = F.lit(min(asofs)).cast("date"), F.lit(max(asofs)).cast("date")
    sales = events.where(~F.col("is_return") & (day > F.date_add(low, after)) & (day <= F.date_add(high, until)))
    hit = F.filter(days, lambda a: (day > F.date_add(a, after)) & (day <= F.date_add(a, until)))
    return sales.select(CUSTOMER, F.explode(hit).alias(ASOF)).distinct()


def customers_in_scope(events: DataFrame, asofs: list[str], window_days: int = 180) -> DataFrame:
    """Customers with a sale in (as-of - window, as-of]."""
    return _sales_in(events, asofs, -window_days, 0)


def active_after(events: DataFrame, asofs: list[str], horizon_days: int = 90) -> DataFrame:
    """Customers with a sale in (as-of, as-of + horizon]."""
    return _sales_in(events, asofs, 0, horizon_days)


def with_labels(rows: DataFrame, events: DataFrame, asofs: list[str], horizon_days: int = 90) -> DataFrame:
    """Add the label: 1 when the customer has no sale in the horizon after the as-of day."""
    seen = active_after(events, asofs, horizon_days).withColumn("_seen", F.lit(True))
    joined = rows.join(seen, [CUSTOMER, ASOF], "left")
    return joined.withColumn(LABEL, F.when(F.col("_seen"), F.lit(0)).otherwise(F.lit(1))).drop("_seen")


def usable(asofs: tuple[str, ...] | list[str], system_asof: str, horizon_days: int) -> list[str]:
    """The as-of days whose label horizon has been fully observed."""
    last = date.fromisoformat(system_asof) - timedelta(days=horizon_days)
    return [a for a in asofs if date.fromisoformat(a) <= last]


def snapshot_build(events: DataFrame, asofs: list[str], settings: Settings, levels: DataFrame | list[str] | None = None, label: bool = True) -> DataFrame:
    """Features, and labels if wanted, of every in-scope customer at each as-of day."""
    rows = asof_features(
        events, asofs, levels, settings.ranges, active_within=settings.label.activity_window_days, top_n=settings.top_countries,
    ).select(CUSTOMER, ASOF, *FEATURES)
    return with_labels(rows, events, asofs, settings.label.horizon_days) if label else rows


def training_table(events: DataFrame, settings: Settings) -> DataFrame:
    """All usable snapshots in one pass, country levels frozen at the first of them, with the fold."""
    asofs = usable(settings.snapshots, settings.system_asof, settings.label.horizon_days)
    levels = top_countries(events, min(asofs), settings.top_countries)
    return with_fold(snapshot_build(events, asofs, settings, levels), settings.split)


def with_fold(rows: DataFrame, split: SplitSpec) -> DataFrame:
    """Add the fold of the as-of day: train, valid, test or purged; NULL for other days."""
    fold = F.lit(None).cast("string")
    for day, name in split.fold_of().items():
        fold = F.when(F.col(ASOF) == F.lit(day).cast("date"), F.lit(name)).otherwise(fold)
    return rows.withColumn("fold", fold)


def temporal_split(table: DataFrame) -> DataFrame:
    """The rows that belong to a fold used for fitting or scoring; purged days are in none."""
    return table.where(F.col("fold").isin("train", "valid", "test"))


def split_report(table: DataFrame) -> DataFrame:
    """Snapshots, rows, distinct customers and label rate per fold."""
    per_customer = temporal_split(table).groupBy("fold", CUSTOMER).agg(F.count("*").alias("n"), F.sum(LABEL).alias("lost"))
    sizes = per_customer.groupBy("fold").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_customers"),
        F.round(F.sum("lost") / F.sum("n"), 4).alias("churn_rate"))
    days = temporal_split(table).select("fold", ASOF).distinct().groupBy("fold").agg(
        F.array_join(F.sort_array(F.collect_list(F.col(ASOF).cast("string"))), ", ").alias("snapshots"))
    return days.join(sizes, "fold")


def fold_entity_overlap(table: DataFrame) -> DataFrame:
    """One row: customers in both train and test, and the most snapshots any customer appears in."""
    flags = table.groupBy(CUSTOMER).agg(
        F.max(F.when(F.col("fold") == "train", 1).otherwise(0)).alias("in_train"),
        F.max(F.when(F.col("fold") == "test", 1).otherwise(0)).alias("in_test"), F.count("*").alias("n"))
    return flags.agg(
        F.sum(F.col("in_train") * F.col("in_test")).alias("n_in_train_and_test"),
        F.max("n").alias("max_snapshots_per_customer"), F.count("*").alias("n_customers"))


def churn_by_snapshot(table: DataFrame) -> DataFrame:
    return table.groupBy(ASOF).agg(F.count("*").alias("n"), F.round(F.avg(LABEL), 6).alias("churn_rate"))


def snapshot_days(scope: DataFrame, settings: Settings) -> DataFrame:
    """Size of each candidate snapshot's population, observed in the events."""
    return scope.groupBy(ASOF).agg(F.count("*").alias("n_in_scope"))


def censoring_report(scope: DataFrame, settings: Settings) -> DataFrame:
    """Per candidate snapshot: end of its label window, whether it is fully observed, rows at stake."""
    end = F.date_add(ASOF, settings.label.horizon_days)
    return snapshot_days(scope, settings).select(
        ASOF, end.alias("label_window_ends"), (end <= F.lit(settings.system_asof).cast("date")).alias("fully_observed"), "n_in_scope")


def label_maturity(scope: DataFrame, settings: Settings) -> DataFrame:
    """Per candidate snapshot: maturity day, days still to wait, and whether training uses it."""
    mature, now = F.date_add(ASOF, settings.label.horizon_days), F.lit(settings.system_asof).cast("date")
    trained = F.col(ASOF).isin([date.fromisoformat(d) for d in settings.split.train])
    return snapshot_days(scope, settings).select(
        ASOF, mature.alias("labels_mature_on"), (mature <= now).alias("usable_today"),
        F.greatest(F.datediff(mature, now), F.lit(0)).alias("days_until_mature"), trained.alias("in_training_set"), "n_in_scope")


def embargo_report(scope: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of folds whose label window reaches the as-of day of a later fold, with the days of overlap."""
    sized = with_fold(snapshot_days(scope, settings), settings.split).where(F.col("fold").isNotNull())
    end = F.date_add(ASOF, settings.label.horizon_days)
    others = F.array(*[
        F.struct(F.lit(fold).alias("fold"), F.lit(date.fromisoformat(day)).alias("day")) for day, fold in settings.split.fold_of().items()])
    reached = F.filter(others, lambda o: (o["fold"] != F.col("fold")) & (o["day"] > F.col(ASOF)) & (o["day"] <= end))
    return sized.withColumn("o", F.explode(reached)).select(
        "fold", ASOF, F.col("o.fold").alias("later_fold"), F.col("o.day").alias("later_snapshot_date"),
        F.datediff(end, F.col("o.day")).alias("overlap_days"), "n_in_scope")

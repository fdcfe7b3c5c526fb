"""Queries over point-in-time features, snapshots and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FAMILY, FEATURES, LABEL, NUMERIC
from ebbtide.operators import features, snapshots
from ebbtide.plans.registry import QUERIES, query
from ebbtide.settings import STAR
from ebbtide.sources.stages import Stages

DAY = "2001-01-31"


def shown(frame: DataFrame) -> DataFrame:
    """Round the float columns for display and comparison."""
    return frame.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes])


def _at(spark: SparkSession, folder: str, wanted: list[str] = FEATURES) -> DataFrame:
    return features.asof_features(Stages(spark, folder).events(), [DAY], ranges=STAR.ranges, wanted=wanted)


@query
def features_asof(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_at(spark, folder).select(CUSTOMER, ASOF, *FEATURES))


def _family(name: str):
    columns = [f for f in FEATURES if FAMILY[f] == name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return shown(_at(spark, folder, columns).select(CUSTOMER, *columns))

    return run


for _key, _name in {"feat_recency": "recency", "feat_rhythm": "rhythm", "feat_frequency": "frequency", "feat_monetary": "monetary",
                    "feat_basket": "basket", "feat_returns": "returns", "feat_country": "geo"}.items():
    QUERIES[_key] = _family(_name)


@query
def feature_windows_extra(spark: SparkSession, folder: str) -> DataFrame:
    return features.extra_window(Stages(spark, folder).events(), [DAY], 60)


@query
def customers_in_scope(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.customers_in_scope(Stages(spark, folder).events(), list(STAR.snapshots))


@query
def churn_labels(spark: SparkSession, folder: str) -> DataFrame:
    events = Stages(spark, folder).events()
    scope = snapshots.customers_in_scope(events, [DAY])
    return snapshots.with_labels(scope, events, [DAY])


@query
def snapshot_build(spark: SparkSession, folder: str) -> DataFrame:
    return shown(snapshots.snapshot_build(Stages(spark, folder).events(), [DAY], STAR))


@query
def training_table(spark: SparkSession, folder: str) -> DataFrame:
    """Every stage from the events on, not the written table."""
    return shown(snapshots.training_table(Stages(spark, folder).events(), STAR))


@query
def censoring_report(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.censoring_report(customers_in_scope(spark, folder), STAR)


@query
def label_maturity(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.label_maturity(customers_in_scope(spark, folder), STAR)


@query
def embargo_report(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.embargo_report(customers_in_scope(spark, folder), STAR)


@query
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.temporal_split(Stages(spark, folder).training()).select(CUSTOMER, ASOF, LABEL, "fold")


@query
def split_report(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.split_report(Stages(spark, folder).training())


@query
def fold_entity_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.fold_entity_overlap(Stages(spark, folder).training())


@query
def churn_by_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.churn_by_snapshot(Stages(spark, folder).training())

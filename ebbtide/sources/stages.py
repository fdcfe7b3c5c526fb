"""The stage tables of the star-schema data: events, training rows and scores."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FEATURES, SOURCE_TS_PATTERN
from ebbtide.operators import boosting, models, monitoring, scoring, snapshots
from ebbtide.operators.features import asof_features, top_countries
from ebbtide.settings import STAR, Settings
from ebbtide.sources import star
from ebbtide.sources.warehouse import Warehouse, by_day, source_state
from ebbtide.streaming import daily_drops, score_requests


SERVED_STORE_DAY = "2001-03-25"  # the features that requests are answered with
REQUEST_SHIFT_DAYS = 8310  # requests of January 2024 are moved into April 2001, where the orders are


LATE_DROPS = 2001  # the year whose files arrive after the latest promotion


class Stages:
    def __init__(self, spark: SparkSession, folder: str, settings: Settings = STAR):
        self.spark, self.folder, self.settings = spark, folder, settings
        self._tables = Warehouse(spark, f"{folder.rstrip('/')}|{settings!r}|{source_state(spark, folder)}")

    def events(self) -> DataFrame:
        return self._tables.table("events", lambda: by_day(star.canonical_events(self.spark, self.folder)))

    def training(self) -> DataFrame:
        return self._tables.table("training", lambda: snapshots.training_table(self.events(), self.settings))

    def levels(self) -> DataFrame:
        """Country levels frozen at the first usable snapshot, for training and serving alike."""
        first = min(snapshots.usable(self.settings.snapshots, self.settings.system_asof, self.settings.label.horizon_days))
        return top_countries(self.events(), first, self.settings.top_countries)

    def feature_store(self) -> DataFrame:
        return self._tables.table("feature_store", self.build_feature_store)

    def build_feature_store(self) -> DataFrame:
        """Features of every known customer as of today, stamped with the day they were computed."""
        rows = asof_features(self.events(), [self.settings.system_asof], self.levels(), self.settings.ranges)
        return rows.select(CUSTOMER, ASOF, *FEATURES, F.col(ASOF).alias("feature_timestamp"))

    def served_store(self) -> DataFrame:
        """Features of every customer known on the day before the requests begin."""
        def build() -> DataFrame:
            rows = asof_features(self.events(), [SERVED_STORE_DAY], self.levels(), self.settings.ranges)
            return rows.select(CUSTOMER, *FEATURES, F.col(ASOF).alias("feature_timestamp"))

        return self._tables.table("served_store", build)

    def requests(self) -> DataFrame:
        """One request per row of the events table; the user asks for the customer of the same number."""
        return star.table(self.spark, self.folder, "events").select(
            F.col("event_id").alias("request_id"), (F.col("user_id") * 11).cast("string").alias(CUSTOMER),
            (F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(F.lit(REQUEST_SHIFT_DAYS))).alias("served_at"),
            F.col("value").alias("latency_ms"), F.col("event_type").alias("model_id"))

    def served_log(self) -> DataFrame:
        """The prediction log of the request stream, which goes on from its checkpoint and stops when all is answered."""
        root = self._tables.root
        self._tables.table("requests", self.requests)
        score_requests.start(
            self.spark, f"{root}/requests", self.served_store, scoring.linear_score(), f"{root}/served_log", f"{root}/served_checkpoint",
            self.settings.ranges, self.settings.serving).awaitTermination()
        return score_requests.prediction_log(self.spark, f"{root}/served_log")

    def ingested(self) -> tuple[DataFrame, DataFrame]:
        """Run log of the stream over yearly drops, and the promotions recorded meanwhile.

        One model is promoted before the first drop, another then and again before the last year arrives, together
        with a file of another layout.
        """
        def build() -> DataFrame:
            root = f"{self._tables.root}/ingest-{uuid4().hex[:8]}"
            raw = star.raw_extract(self.spark, self.folder)
            raw = raw.withColumn("year", F.year(F.to_timestamp_ntz("InvoiceDate", F.lit(SOURCE_TS_PATTERN))))

            def promote(*names: str) -> None:
                now = datetime.now(timezone.utc)
                self.spark.createDataFrame([(n, now) for n in names], "model string, promoted_at timestamp").write.mode("append").parquet(f"{root}/promotions")

            def deliver(rows: DataFrame, name: str) -> None:
                rows.write.partitionBy("year").option("header", True).csv(f"{root}/incoming/{name}")

            def ingest() -> None:
                daily_drops.start(self.spark, f"{root}/incoming", f"{root}/events", f"{root}/log", f"{root}/checkpoint", files_per_batch=64).awaitTermination()

            promote("linear_fixed", "recency_rule")
            deliver(raw.where(F.col("year") < LATE_DROPS), "early")
            ingest()
            promote("recency_rule")
            deliver(raw.where(F.col("year") >= LATE_DROPS), "late")
            star.table(self.spark, self.folder, "nation").coalesce(1).write.option("header", True).csv(f"{root}/incoming/other")
            ingest()
            return self.spark.createDataFrame([(root,)], "root string")

        root = self._tables.table("ingested", build).first()["root"]
        return daily_drops.run_log(self.spark, f"{root}/log"), self.spark.read.parquet(f"{root}/promotions")

    def scored(self) -> DataFrame:
        return self._tables.table("scored", lambda: scoring.scored_long(self.training()))

    def logistic(self) -> PipelineModel:
        return self._tables.model("logistic", lambda: models.fit_logistic(self.training().where("fold = 'train'")))

    def boosting_edges(self) -> DataFrame:
        return self._tables.table("boosting_edges", lambda: models.boosting_edges(self.training().where("fold = 'train'")))

    def rounds(self) -> DataFrame:
        """One row: what the round search found."""
        def found() -> DataFrame:
            return self.spark.createDataFrame([boosting.tune_rounds(self.training().where("fold = 'train'"), self.boosting_edges(), seed=self.settings.seed)])

        return self._tables.table("rounds_by_auc", found)

    def boosted(self) -> tuple[DataFrame, DataFrame]:
        """Bins and trees of the boosted tier."""
        def fit() -> DataFrame:
            return boosting.fit(self.training().where("fold = 'train'"), self.boosting_edges(), lambda: self.rounds().first()["rounds"], seed=self.settings.seed)

        return self.boosting_edges(), self._tables.table("boosted_trees", fit)

    def fitted(self) -> DataFrame:
        """Scored rows of the four tiers, by the stored models."""
        def build() -> DataFrame:
            training = self.training()  # before both fits, which run beside each other
            with ThreadPoolExecutor(1) as beside:
                logistic, boosted = beside.submit(self.logistic), self.boosted()
                return models.score_tiers(training, logistic.result(), boosted)

        return self._tables.table("fitted_by_auc", build)

    def importance(self) -> DataFrame:
        """Permutation importance of the stored logistic model on the validation fold."""
        def build() -> DataFrame:
            return models.permutation_importance(self.logistic(), self.training().where("fold = 'valid'"), repeats=5, seed=self.settings.seed)

        return self._tables.table("importance", build)

    def profile(self) -> monitoring.Profile:
        """The training profile, frozen when first needed and only read afterwards."""
        train = self.training().where("fold = 'train'")
        numeric = self._tables.table("profile_numeric", lambda: monitoring.numeric_profile(train, self.settings.monitor))
        bins = self._tables.table("profile_bins", lambda: monitoring.expected_bins(train, numeric))
        levels = self._tables.table("profile_levels", lambda: monitoring.categorical_profile(train))
        return monitoring.Profile(numeric, bins, levels)

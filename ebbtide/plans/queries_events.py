"""Queries over events: scans, cleaning, ingestion."""

from __future__ import annotations

from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.contracts import SOURCE_COLUMNS, SOURCE_TS_PATTERN
from ebbtide.functions.exact import money, units
from ebbtide.operators import cleaning, explore, merge
from ebbtide.plans.registry import query
from ebbtide.session import shared_folder
from ebbtide.sources import retail, star
from ebbtide.sources.stages import Stages
from ebbtide.streaming import daily_drops

CUT = "2001-03-31"


@query
def events_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return star.canonical_events(spark, folder)


@query
def events_until(spark: SparkSession, folder: str) -> DataFrame:
    return star.canonical_events(spark, folder).where(F.col("event_date") <= F.lit("2000-08-31").cast("date"))


@query
def daily_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """All events written by day and read back: rows per day."""
    path = _scratch(spark, "by-day")
    retail.write_by_day(Stages(spark, folder).events(), path)
    return spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n_rows"))


@query
def clean_events(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_events(retail.typed(star.raw_extract(spark, folder)))


@query
def cleaning_audit(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaning_audit(retail.typed(star.raw_extract(spark, folder)))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return retail.typed(star.raw_extract(spark, folder))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/ebbtide/{spark.sparkContext.applicationId}/{name}-{uuid4().hex[:8]}"


@query
def merge_new_events(spark: SparkSession, folder: str) -> DataFrame:
    """A later, overlapping delivery merged into the events up to a day: the rows it adds."""
    cleaned = cleaning.clean_events(_lines(spark, folder))
    existing = cleaned.where(F.col("event_date") <= F.lit(CUT).cast("date"))
    first = date.fromisoformat(CUT) - timedelta(days=29)
    incoming = cleaned.where(F.col("event_date") >= F.lit(first))
    return merge.new_events(merge.in_days_of(existing, first, date.max), incoming)


@query
def merge_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Rows added by a delivery, and by the same delivery again."""
    events = Stages(spark, folder).events()
    existing = events.where(F.col("event_date") <= F.lit(CUT).cast("date"))
    incoming = events.where(F.col("event_date") > F.date_sub(F.lit(CUT).cast("date"), 30))
    first = merge.new_events(existing, incoming)
    again = merge.new_events(existing.unionByName(first), incoming)
    counts = first.agg(F.count("*").alias("appended_first")).withColumn("appended_again", again.agg(F.count("*")).scalar())
    return counts


@query
def ingest_run_record(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    record = merge.run_record(lines, cleaning.clean_events(lines))
    rejected = [F.col("rows_rejected_by_rule")[r].alias(r) for r in cleaning.RULES]
    return record.select("*", *rejected).drop("rows_rejected_by_rule")


@query
def ingest_run_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """One run record per year of lines, as if each year had come as one file."""
    lines = _lines(spark, folder).withColumn("year", F.year("event_ts"))
    return merge.run_record(lines, cleaning.clean_events(lines, by=["year"]), ["year"]).drop("rows_rejected_by_rule")


@query
def scan_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The raw extract written as text, read back under the contract and cleaned: rows and revenue per country."""
    path = _scratch(spark, "extract")
    retail.write_extract(star.raw_extract(spark, folder), path)
    cleaned = cleaning.clean_events(retail.typed(retail.scan_files(spark, retail.files_below(spark, path))))
    return cleaned.groupBy("country").agg(F.count("*").alias("n_rows"), F.round(money(F.sum(units(F.col("line_revenue")))), 2).alias("net_revenue"))


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly text drops ingested by the stream, then the stream run again: rows read and stored per year."""
    root = _scratch(spark, "drops")
    raw = star.raw_extract(spark, folder)
    raw.withColumn("year", F.year(F.to_timestamp_ntz("InvoiceDate", F.lit(SOURCE_TS_PATTERN)))).write.partitionBy("year").option("header", True).csv(f"{root}/incoming")
    for _ in range(2):
        daily_drops.start(spark, f"{root}/incoming", f"{root}/events", f"{root}/log", f"{root}/checkpoint", files_per_batch=64).awaitTermination()
    log = daily_drops.run_log(spark, f"{root}/log")
    per_year = log.groupBy(F.regexp_extract("source_file", r"year=(\d+)", 1).cast("int").alias("year")).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_appended").alias("rows_appended"))
    stored = daily_drops.stored_events(spark, f"{root}/events").groupBy(F.year("event_date").alias("year")).agg(F.count("*").alias("rows_stored"))
    return per_year.join(stored, "year")


@query
def ingest_history_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over a log with one run per month of events, where the runs of even months were repeated."""
    events = Stages(spark, folder).events()
    month = F.date_format("event_date", "yyyy-MM")
    runs = events.groupBy(month.alias("source_file")).agg(F.count("*").alias("rows_read")).withColumn(
        "again", F.explode(F.when(F.substring("source_file", -2, 2).cast("int") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    log = runs.selectExpr(
        "source_file", "concat(source_file, '-', again) AS run_id", "'ok' AS status", "rows_read", "CASE WHEN again = 0 THEN rows_read ELSE 0 END AS rows_appended",
        "CASE WHEN again = 0 THEN 0 ELSE rows_read END AS rows_deduplicated", "0.5D AS duration_s", "rows_read AS warehouse_rows")
    return merge.history_summary(log)


@query
def ingest_history(spark: SparkSession, folder: str) -> DataFrame:
    """The log of the stream per year of files and outcome; a refused file has no year."""
    log, _ = Stages(spark, folder).ingested()
    year = F.regexp_extract("source_file", r"year=(\d+)", 1)
    return log.groupBy(F.nullif(year, F.lit("")).cast("int").alias("year"), "status").agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_appended").alias("rows_appended"), F.count("error").alias("n_errors"))


@query
def stream_history_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the stream's own log; how many files a year has is up to the writer and left out."""
    summary = merge.history_summary(Stages(spark, folder).ingested()[0])
    return summary.select("rows_read", "rows_appended", "reruns", "rows_appended_by_reruns", "rejected", "warehouse_rows_max")


@query
def rows_since_promotion(spark: SparkSession, folder: str) -> DataFrame:
    return merge.since_promotion(*Stages(spark, folder).ingested())


@query
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return explore.column_profile(_lines(spark, folder)).drop("dtype")


@query
def defect_counts(spark: SparkSession, folder: str) -> DataFrame:
    return explore.defect_counts(_lines(spark, folder))


@query
def clean_summary(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return explore.clean_summary(lines, cleaning.clean_events(lines))


@query
def weekly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return explore.weekly_revenue(Stages(spark, folder).events())


@query
def monthly_active(spark: SparkSession, folder: str) -> DataFrame:
    return explore.monthly_active(Stages(spark, folder).events())


@query
def invoices_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return explore.invoices_histogram(explore.invoice_counts(Stages(spark, folder).events()))


@query
def invoices_per_customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return explore.invoices_summary(explore.invoice_counts(Stages(spark, folder).events())).select(
        F.round("mean", 6).alias("mean"), "max", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"))


@query
def one_time_buyers(spark: SparkSession, folder: str) -> DataFrame:
    return explore.one_time_buyers(explore.invoice_counts(Stages(spark, folder).events()))


@query
def revenue_concentration(spark: SparkSession, folder: str) -> DataFrame:
    curve = explore.revenue_concentration(Stages(spark, folder).events())
    return curve.select("rank", "customer_id", "revenue", F.round("pct_customers", 6).alias("pct_customers"), F.round("pct_revenue", 6).alias("pct_revenue"))


@query
def revenue_top_share(spark: SparkSession, folder: str) -> DataFrame:
    return explore.top_share(explore.revenue_concentration(Stages(spark, folder).events()))


@query
def ingest_volume_alert(spark: SparkSession, folder: str) -> DataFrame:
    return explore.volume_alerts(star.table(spark, folder, "events"), "ts")


@query
def schema_contract(spark: SparkSession, folder: str) -> DataFrame:
    """The contract's columns in the raw extract: lines, and lines with a value."""
    raw = star.raw_extract(spark, folder)
    retail.check_columns(raw.columns)
    filled = raw.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in SOURCE_COLUMNS])
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in SOURCE_COLUMNS])
    return filled.select(F.inline(listed), F.col("n").alias("n_lines"))

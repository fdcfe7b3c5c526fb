"""Idempotent merge into the event table, and the record of an ingestion run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.contracts import NATURAL_KEY
from ebbtide.functions.exact import money, units
from ebbtide.functions.ordered import attach_row
from ebbtide.operators.cleaning import RULES, keep_one, rule_losses
from ebbtide.settings import CleaningRules


def new_events(existing: DataFrame, incoming: DataFrame, prefer: list[str] = []) -> DataFrame:
    """The incoming events whose natural key the table does not hold yet; existing rows win.

    Keys compare NULL-safe. The incoming side is reduced to one row per key before it is shuffled.
    """
    once = keep_one(incoming, prefer=prefer)
    known = existing.select(*[F.col(k).alias(f"_k_{k}") for k in NATURAL_KEY])
    same = once[NATURAL_KEY[0]].eqNullSafe(known[f"_k_{NATURAL_KEY[0]}"])
    for k in NATURAL_KEY[1:]:
        same = same & once[k].eqNullSafe(known[f"_k_{k}"])
    return once.join(known, same, "left_anti")


def in_days_of(existing: DataFrame, first, last) -> DataFrame:
    """Only events of the days a batch touches can share its keys; the literal bounds prune the scan.

    Events without a day stay in, since the key compares missing times as equal.
    """
    return existing.where(F.col("event_date").between(F.lit(first), F.lit(last)) | F.col("event_date").isNull())


def month_of(day: str) -> Column:
    """Year and month of a day, the unit event tables are laid out by; NULL without a day."""
    return F.date_format(day, "yyyy-MM")


def in_months_of(existing: DataFrame, months: list[str | None]) -> DataFrame:
    """Stored events of the listed months, by the partition column, so other months are not opened.

    Equal keys have equal times, so nothing outside the months of a batch can hold its rows; events without a
    time are in the NULL month.
    """
    named = [m for m in months if m is not None]
    wanted = F.col("month").isin(named)
    return existing.where(wanted | F.col("month").isNull() if None in months else wanted)


def run_record(lines: DataFrame, cleaned: DataFrame, by: list[str] = [], rules: CleaningRules = CleaningRules()) -> DataFrame:
    """What a run read, lost per rule and kept, per ``by``: the content of an ingestion log record.

    ``gross_revenue`` adds sales and returns, so it is net of returns despite its name.
    """
    losses = rule_losses(lines, rules, by)
    used = F.map_from_entries(F.array(*[F.struct(F.lit(r), F.col(r).cast("long")) for r in RULES]))
    facts = cleaned.groupBy(*by).agg(
        F.count("*").alias("rows_after_cleaning"), F.min("event_date").alias("event_date_min"), F.max("event_date").alias("event_date_max"),
        F.round(money(F.sum(units(F.col("line_revenue")))), 2).alias("gross_revenue"))
    distinct = _distinct(cleaned, "customer_id", "n_customers", by), _distinct(cleaned, "invoice_no", "n_invoices", by)
    # One row per file of the run on every side, or one row in all.
    out = losses
    for table in (facts, *distinct):
        out = out.join(F.broadcast(table), by, "left") if by else attach_row(out, table)
    return out.select(
        *by, F.col("rows_read").cast("long").alias("rows_read"), F.coalesce("rows_after_cleaning", F.lit(0)).alias("rows_after_cleaning"),
        used.alias("rows_rejected_by_rule"), "event_date_min", "event_date_max",
        F.coalesce("n_customers", F.lit(0)).alias("n_customers"), F.coalesce("n_invoices", F.lit(0)).alias("n_invoices"),
        F.coalesce("gross_revenue", F.lit(0.0)).alias("gross_revenue"))


def _distinct(rows: DataFrame, column: str, name: str, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, column).agg(F.lit(1).alias("_one")).groupBy(*by).agg(F.count(column).alias(name))


def history_summary(log: DataFrame) -> DataFrame:
    """Totals of an ingestion log: first runs, re-runs and rejections.

    The first run of a file is the one with the smallest run id.
    """
    ok = log.where("status = 'ok'")
    first = ok.groupBy("source_file").agg(
        F.min(F.struct("run_id", "rows_read", "rows_appended")).alias("f"), F.count("*").alias("runs"),
        F.sum("rows_appended").alias("appended"), F.sum("rows_deduplicated").alias("deduplicated"), F.sum("duration_s").alias("seconds"),
        F.min("warehouse_rows").alias("low"), F.max("warehouse_rows").alias("high"))
    files = first.agg(
        F.count("*").alias("files"), F.sum("f.rows_read").alias("rows_read"), F.sum("f.rows_appended").alias("rows_appended"),
        F.sum(F.col("runs") - 1).alias("reruns"), F.sum(F.col("appended") - F.col("f.rows_appended")).alias("rows_appended_by_reruns"),
        (F.sum("seconds") / F.sum("runs")).alias("mean_duration_s"), F.min("low").alias("warehouse_rows_min"), F.max("high").alias("warehouse_rows_max"))
    return files.withColumn("rejected", log.agg(F.count_if(F.col("status") == "rejected_schema")).scalar())


def rows_since(log: DataFrame, moment) -> DataFrame:
    """Rows appended by runs at or after a moment."""
    return log.where(F.col("ingested_at_utc") >= F.lit(moment).cast("timestamp")).agg(F.coalesce(F.sum("rows_appended"), F.lit(0)).alias("rows_since"))


def since_promotion(log: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per model, from the run log and the append-only record of promotions: rows appended and files refused since
    its latest promotion, and rows appended in all. The latest promotions are one row per model."""
    latest = promotions.groupBy("model").agg(F.max("promoted_at").alias("promoted_at"))
    live = latest.agg(F.collect_list(F.struct("model", "promoted_at"))).scalar()
    runs = log.withColumn("_live", live).select("status", "rows_appended", "ingested_at_utc", F.inline("_live"))
    later = F.col("ingested_at_utc") >= F.col("promoted_at")
    return runs.groupBy("model").agg(
        F.coalesce(F.sum(F.when(later, F.col("rows_appended"))), F.lit(0)).alias("rows_since"),
        F.count_if(later & (F.col("status") == "rejected_schema")).alias("refused_since"), F.sum("rows_appended").alias("rows_in_all"))

"""Raw typed lines to canonical events, with a per-rule account of the rows lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.contracts import EVENT_COLUMNS, NATURAL_KEY
from ebbtide.functions.exact import truthy
from ebbtide.settings import CleaningRules

# fixed values: names of the rules in reports
RULES = (
    "drop_missing_customer_id",
    "drop_non_product_stock_codes",
    "drop_non_positive_price_sales",
    "drop_exact_duplicate_lines",
)

def return_flag() -> Column:
    """Cancellation invoices and negative quantities are returns; unknown values are not."""
    return truthy(F.upper("invoice_no").startswith("C")) | truthy(F.col("quantity") < 0)


def first_failed_rule(rules: CleaningRules) -> Column:
    """Name of the first row rule a line breaks, NULL when it passes. Unknown values pass."""
    codes = [c.upper() for c in rules.non_product_codes]
    failed = F.when(F.upper("stock_code").isin(codes), F.lit(RULES[1])).when(
        ~return_flag() & (F.col("unit_price") <= rules.min_unit_price), F.lit(RULES[2]))
    if not rules.drop_missing_customer:
        return failed
    return F.when(F.col("customer_id").isNull(), F.lit(RULES[0])).otherwise(failed)


def keep_one(lines: DataFrame, key: list[str] = NATURAL_KEY, prefer: list[str] = []) -> DataFrame:
    """One row per key, the smallest by ``prefer`` and then by the other columns.

    An aggregate, not a window: copies of one line are reduced before the shuffle, however many there are.
    """
    rest = prefer + [c for c in lines.columns if c not in key and c not in prefer]
    kept = lines.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*key, "_kept.*").select(*lines.columns)


def clean_events(lines: DataFrame, rules: CleaningRules = CleaningRules(), by: list[str] = []) -> DataFrame:
    """Canonical events from typed source lines. ``by`` columns, such as the source file, are cleaned apart and kept."""
    valid = lines.where(first_failed_rule(rules).isNull())
    return keep_one(valid, [*NATURAL_KEY, *by]).select(
        "invoice_no",
        "stock_code",
        F.coalesce("description", F.lit("UNKNOWN")).alias("description"),
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
        "event_ts",
        F.to_date("event_ts").alias("event_date"),
        F.regexp_replace("customer_id", r"\.0$", "").alias("customer_id"),
        F.coalesce("country", F.lit("Unknown")).alias("country"),
        return_flag().alias("is_return"),
        *by,
    ).select(*EVENT_COLUMNS, *by)


def rule_losses(lines: DataFrame, rules: CleaningRules = CleaningRules(), by: list[str] = []) -> DataFrame:
    """One row (per ``by``): rows read, and rows removed by each rule, from a single pass over the lines."""
    tagged = lines.select(first_failed_rule(rules).alias("failed"), *by, *NATURAL_KEY)
    # Rows that fail collapse to one group per rule; rows that pass keep their natural key.
    keys = [F.when(F.col("failed").isNull(), F.col(k)).alias(k) for k in NATURAL_KEY]
    groups = tagged.groupBy(*by, "failed", *keys).agg(F.count("*").alias("n"))
    passed = F.col("failed").isNull()
    losses = [F.coalesce(F.sum(F.when(F.col("failed") == r, F.col("n"))), F.lit(0)).alias(r) for r in RULES[:3]]
    duplicates = F.coalesce(F.sum(F.when(passed, F.col("n") - 1)), F.lit(0)).alias(RULES[3])
    return groups.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"), *losses, duplicates)


def cleaning_audit(lines: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """One row per rule in the order applied: rows before, after, removed, and the share of the raw rows."""
    used = RULES if rules.drop_missing_customer else RULES[1:]
    before, steps = F.col("rows_read"), []
    for number, rule in enumerate(used, start=1):
        after = before - F.col(rule)
        pct = F.when(F.col("rows_read") == 0, F.lit(0.0)).otherwise(
            F.round(F.try_divide(F.lit(100.0) * F.col(rule), F.col("rows_read")), 3))
        steps.append(F.struct(
            F.lit(number).alias("step"), F.lit(rule).alias("rule"), before.alias("rows_before"),
            after.alias("rows_after"), F.col(rule).alias("rows_removed"), pct.alias("pct_of_raw_removed")))
        before = after
    return rule_losses(lines, rules).select(F.inline(F.array(*steps)))

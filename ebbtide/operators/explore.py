"""Descriptive tables over raw lines and clean events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ebbtide.contracts import CUSTOMER
from ebbtide.functions.exact import money, money_sql, units, units_sql
from ebbtide.functions.ordered import attach_row, exact_quantiles, running_totals


def column_profile(lines: DataFrame) -> DataFrame:
    """Type, missing values and distinct values of every column, counted in one grouped pass."""
    kinds = dict(lines.dtypes)
    pairs = ", ".join(f"'{c}', '{kinds[c]}', cast({c} AS string)" for c in lines.columns)
    values = lines.selectExpr(f"stack({len(kinds)}, {pairs}) AS (column, dtype, value)").groupBy("column", "dtype", "value").agg(F.count("*").alias("n"))
    return values.groupBy("column", "dtype").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.round(100.0 * F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)) / F.sum("n"), 2).alias("pct_null"),
        F.count("value").alias("n_unique"))


def defect_counts(lines: DataFrame) -> DataFrame:
    """One row: size, time range, distinct entities, and how often each known defect occurs."""
    facts = lines.selectExpr(
        "count(*) AS n_rows", "min(event_ts) AS first_ts", "max(event_ts) AS last_ts", "datediff(max(event_ts), min(event_ts)) AS n_days",
        "count_if(customer_id IS NULL) AS missing_customer", "count_if(upper(invoice_no) LIKE 'C%') AS cancellations",
        "count_if(quantity <= 0) AS non_positive_quantity", "count_if(unit_price <= 0) AS non_positive_price",
        "count_if(abs(quantity) > 10000) AS extreme_quantity")
    distinct = lines.agg(F.countDistinct("customer_id").alias("n_customers"), F.countDistinct("invoice_no").alias("n_invoices"), F.countDistinct("country").alias("n_countries"))
    return attach_row(facts, distinct)


def clean_summary(lines: DataFrame, events: DataFrame) -> DataFrame:
    """One row: rows before and after cleaning, customers, purchases, returns and sale revenue."""
    raw = lines.agg(F.count("*")).scalar()
    customers = events.groupBy(CUSTOMER).agg(
        F.count("*").alias("n"), F.count_if("is_return").alias("back"),
        F.expr(f"sum(CASE WHEN NOT is_return THEN {units_sql('line_revenue')} END) AS u"))
    return customers.agg(
        F.sum("n").alias("n_clean"), F.count("*").alias("n_customers"), F.sum(F.col("n") - F.col("back")).alias("n_purchases"),
        F.sum("back").alias("n_returns"), F.round(money(F.sum("u")), 2).alias("sale_revenue"),
    ).withColumn("n_raw", raw).withColumn("pct_retained", F.round(100.0 * F.col("n_clean") / F.col("n_raw"), 1))


def _sales(events: DataFrame) -> DataFrame:
    return events.where("NOT is_return")


def weekly_revenue(events: DataFrame) -> DataFrame:
    """Sale revenue per week ending on Sunday; weeks without sales are zero. The calendar has one row per week."""
    weeks = _sales(events).selectExpr("date_add(cast(date_trunc('week', event_date) AS date), 6) AS week_end", f"{units_sql('line_revenue')} AS u")
    found = weeks.groupBy("week_end").agg(F.sum("u").alias("u"))
    ends = found.agg(F.min("week_end").alias("a"), F.max("week_end").alias("b")).selectExpr("explode(sequence(a, b, interval 7 days)) AS week_end")
    return ends.join(found, "week_end", "left").selectExpr("week_end", f"{money_sql('coalesce(u, 0)')} AS revenue")


def monthly_active(events: DataFrame) -> DataFrame:
    """Customers with a sale per calendar month; months without sales are zero."""
    found = _sales(events).selectExpr("last_day(event_date) AS month_end", CUSTOMER).distinct().groupBy("month_end").agg(F.count("*").alias("n"))
    ends = found.agg(F.min("month_end").alias("a"), F.max("month_end").alias("b")).selectExpr(
        "explode(sequence(trunc(a, 'MM'), b, interval 1 month)) AS m").selectExpr("last_day(m) AS month_end")
    return ends.join(found, "month_end", "left").selectExpr("month_end", "coalesce(n, 0L) AS active_customers")


def invoice_counts(events: DataFrame) -> DataFrame:
    """Distinct sale invoices per customer."""
    return _sales(events).select(CUSTOMER, "invoice_no").distinct().groupBy(CUSTOMER).agg(F.count("invoice_no").alias("n_invoices"))


def invoices_histogram(counts: DataFrame, top: int = 40) -> DataFrame:
    """Customers per invoice count, counts above ``top`` put into the last bar."""
    return counts.groupBy(F.least("n_invoices", F.lit(top).cast("long")).alias("n_invoices")).agg(F.count("*").alias("n_customers"))


def invoices_summary(counts: DataFrame) -> DataFrame:
    quantiles = exact_quantiles(counts, "n_invoices", [(1, 2), (95, 100)])
    at = lambda i: quantiles.select(F.element_at("quantiles", i)).scalar()
    return counts.agg(F.avg("n_invoices").alias("mean"), F.max("n_invoices").alias("max")).withColumns({"median": at(1), "p95": at(2)})


def one_time_buyers(counts: DataFrame) -> DataFrame:
    single = F.count_if(F.col("n_invoices") == 1)
    return counts.agg(single.alias("n_single"), F.count("*").alias("n_customers"), F.round(100.0 * single / F.count("*"), 4).alias("pct_single"))


def revenue_concentration(events: DataFrame) -> DataFrame:
    """Customers by falling revenue with the cumulative shares of customers and of revenue."""
    per_customer = _sales(events).groupBy(CUSTOMER).agg(F.sum(units(F.col("line_revenue"))).alias("u"))
    rows = per_customer.withColumns({"_minus": -F.col("u"), "_one": F.lit(1).cast("long")})
    ranked = running_totals(rows, ["_minus", CUSTOMER], {"_one": "rank", "u": "cum"})
    totals = per_customer.agg(F.count("*").alias("n"), F.sum("u").alias("total"))
    return attach_row(ranked, totals).selectExpr(
        "rank", CUSTOMER, f"{money_sql('u')} AS revenue", "100D * rank / n AS pct_customers", "100D * cum / total AS pct_revenue", "n")


def top_share(concentration: DataFrame, part: float = 0.2) -> DataFrame:
    """Revenue share at position int(part * n) counted from zero, i.e. of one customer more than that."""
    return concentration.where(F.col("rank") == F.floor(F.col("n") * part) + 1).select(
        "n", F.col("rank").alias("n_top"), F.round("pct_revenue", 4).alias("pct_revenue"))


def volume_alerts(rows: DataFrame, day: str, share: float = 0.5, days: int = 7) -> DataFrame:
    """Calendar days whose row count is below a share of the median of the previous days.

    Days without rows count zero, so an outage alerts. The window runs over the calendar, one row per day.
    """
    daily = rows.where(F.col(day).isNotNull()).groupBy(F.to_date(day).alias("day")).agg(F.count("*").alias("n_rows"))
    span = daily.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL")
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("day"))
    filled = calendar.join(daily, "day", "left").select("day", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    before = W.orderBy("day").rowsBetween(-days, -1)
    median = F.percentile("n_rows", F.lit(0.5)).over(before)
    return filled.withColumn("median_before", median).withColumn(
        "alert", F.coalesce(F.col("n_rows") < share * F.col("median_before"), F.lit(False)))

"""Features of any (customer, day) pairs, each pair at its own day, from one time line per customer.

A windowed feature changes only on few days: a sale of day d counts from d until d + window, a distinct invoice
or product from d until its window ends or its next sale begins a new one. Each such change is one signed number
on one day, so all windows become running sums over the changes of a customer, however many days are asked for.
Rows do not fan out to the asked days. Changes are added up per customer and day before the window, so a
customer is never larger than four times their calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FEATURES, RANGES
from ebbtide.functions.exact import units_sql
from ebbtide.operators.features import LONG, MEDIUM, SHORT, _as_array, _finish, purchase_gaps, sale_days

_WINDOWS = (SHORT, MEDIUM, LONG)
# What is added up over a window of sales: name, value per line, and the windows it is kept for.
_ADDED = {
    "units": (f"CASE WHEN NOT is_return THEN {units_sql('line_revenue')} END", _WINDOWS),
    "valued": ("CASE WHEN NOT is_return AND line_revenue IS NOT NULL THEN 1L END", _WINDOWS),
    "items": (f"CASE WHEN NOT is_return THEN {units_sql('quantity')} END", (MEDIUM,)),
    "counted": ("CASE WHEN NOT is_return AND quantity IS NOT NULL THEN 1L END", (MEDIUM,)),
    "price_units": (f"CASE WHEN NOT is_return THEN {units_sql('unit_price')} END", (MEDIUM,)),
    "lines": ("CASE WHEN NOT is_return AND unit_price IS NOT NULL THEN 1L END", (MEDIUM,)),
    "return_units": (f"CASE WHEN is_return THEN {units_sql('line_revenue')} END", (LONG,)),
    "return_lines": ("CASE WHEN is_return THEN 1L END", (LONG,)),
}
_SUMS = [
    "n_gaps", "gap_sum", "gap_squares", "lifetime_units", *[f"{name}_{w}" for name, (_, kept) in _ADDED.items() for w in kept],
    *[f"orders_{w}" for w in _WINDOWS], f"returns_{LONG}", f"products_{MEDIUM}",
]


def _calendar(events: DataFrame, levels: Column) -> DataFrame:
    """Purchase days with their gaps, revenue and the rank of the day's last country."""
    cells = purchase_gaps(sale_days(events)).withColumn("_levels", levels)
    return cells.withColumn("rank", F.expr("coalesce(array_position(_levels, country), 0)")).groupBy(CUSTOMER, F.col("event_date").alias("day")).agg(
        F.count("gap").alias("n_gaps"), F.sum("gap").alias("gap_sum"), F.sum(F.col("gap") * F.col("gap")).alias("gap_squares"),
        F.sum("rev_units").alias("lifetime_units"), F.max(F.struct("last_ts", "country", "rank"))["rank"].alias("rank"),
    ).withColumn("sale_day", F.col("day"))


def _added(events: DataFrame) -> DataFrame:
    """Daily totals, which enter their windows on the day and leave them one window later."""
    daily = events.groupBy(CUSTOMER, "event_date").agg(*[F.expr(f"coalesce(sum({value}), 0L) AS {name}") for name, (value, _) in _ADDED.items()])
    moves = daily.withColumn("after", F.explode(F.array(*[F.lit(d) for d in (0, *_WINDOWS)])))
    signed = lambda name, w: f"CASE WHEN after = 0 THEN {name} WHEN after = {w} THEN -{name} ELSE 0L END AS {name}_{w}"
    return moves.selectExpr(CUSTOMER, "date_add(event_date, after) AS day", *[signed(name, w) for name, (_, kept) in _ADDED.items() for w in kept])


def _distinct(events: DataFrame, item: str, name: str, windows: tuple[int, ...]) -> DataFrame:
    """Number of different items in a window: +1 on each day of an item, -1 when its window ends or its next day comes."""
    days = events.where(F.col(item).isNotNull()).select(CUSTOMER, item, "event_date").distinct()
    following = days.selectExpr(CUSTOMER, "event_date", f"lead(event_date) OVER (PARTITION BY {CUSTOMER}, {item} ORDER BY event_date) AS next_day")
    moves = ["struct(event_date AS day, " + ", ".join(f"1L AS {name}_{w}" for w in windows) + ")"]
    for w in windows:
        ends = f"least(date_add(event_date, {w}), next_day)"  # least skips a missing next day
        moves.append(f"struct({ends} AS day, " + ", ".join(f"{'-1L' if v == w else '0L'} AS {name}_{v}" for v in windows) + ")")
    return following.selectExpr(CUSTOMER, f"inline(array({', '.join(moves)}))")


def changes(events: DataFrame, levels: Column) -> DataFrame:
    """All changes of the customers' running sums, one row per customer and day."""
    sales, returns = events.where("NOT is_return"), events.where("is_return")
    parts = [
        _calendar(events, levels), _added(events), _distinct(sales, "invoice_no", "orders", _WINDOWS),
        _distinct(returns, "invoice_no", "returns", (LONG,)), _distinct(sales, "stock_code", "products", (MEDIUM,)),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def moment_features(events: DataFrame, moments: DataFrame, levels: DataFrame | list[str], ranges: dict = RANGES, wanted: list[str] = FEATURES) -> DataFrame:
    """Feature rows of the (customer, as-of day) pairs in ``moments``, equal to those of ``asof_features``.

    Each different pair gives one row, if a sale is visible on its day; events of customers that are not asked
    for, and events without a day, are left out before anything is computed.
    """
    asked = moments.select(CUSTOMER, F.col(ASOF).alias("day")).where(F.col(CUSTOMER).isNotNull() & F.col("day").isNotNull()).distinct()
    visible = events.where(F.col("event_date").isNotNull()).join(asked.select(CUSTOMER).distinct(), CUSTOMER, "left_semi")
    level = _as_array(levels)
    stacked = changes(visible, level).unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    line = stacked.groupBy(CUSTOMER, "day").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.max("rank").alias("rank"), F.max("sale_day").alias("sale_day"), F.max("asked").alias("asked"))
    so_far = f"OVER (PARTITION BY {CUSTOMER} ORDER BY day ROWS UNBOUNDED PRECEDING)"
    seen = line.selectExpr(
        CUSTOMER, f"day AS {ASOF}", "asked", f"min(sale_day) {so_far} AS first_day", f"max(sale_day) {so_far} AS last_day",
        f"last(rank, true) {so_far} AS country_rank", *[f"coalesce(sum({c}) {so_far}, 0L) AS {c}" for c in _SUMS],
    ).where("asked AND last_day IS NOT NULL")
    # A window without lines has no sum, as opposed to a sum of zero.
    nothing = {f"units_{w}": f"valued_{w}" for w in _WINDOWS} | {f"items_{MEDIUM}": f"counted_{MEDIUM}"}
    counts = [f"orders_{w}" for w in _WINDOWS] + [f"returns_{LONG}", f"products_{MEDIUM}"]
    parts = seen.withColumns({
        **{total: F.expr(f"CASE WHEN {lines} > 0 THEN {total} END") for total, lines in nothing.items()},
        **{c: F.expr(f"nullif({c}, 0L)") for c in counts},
        f"has_return_{LONG}": F.expr(f"CASE WHEN return_lines_{LONG} > 0 THEN 1 END"),
    })
    return _finish(parts, level, ranges, list(wanted))

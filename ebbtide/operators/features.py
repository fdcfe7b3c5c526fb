"""Point-in-time customer features for many as-of days in one distributed pass.

Three branches read only the columns and days they need, fan out to the as-of days whose windows they
touch, and reduce before anything meets per customer:

* days:     (customer, day, country) sale cells over all visible history: recency, tenure, gaps, country;
* invoices: (as-of, customer, invoice) cells of the last 180 days: order counts, money, units, returns;
* products: (as-of, customer, product) cells of the last 90 days.

Their partial results share one layout and are added up in a single aggregation by (as-of, customer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.contracts import ASOF, CUSTOMER, EPS, FAMILY, FEATURES, GAP_SENTINEL, NUMERIC, RANGES
from ebbtide.functions.exact import clip_sql, dates, money_sql, scrub_sql, units_sql

# fixed values: the look-back windows of the contract, in days
SHORT, MEDIUM, LONG = 30, 90, 180

_DAY_PARTS = ["first_day", "last_day", "n_gaps", "gap_sum", "gap_squares", "lifetime_units", "country_rank"]
_INVOICE_PARTS = [
    "orders_30", "orders_90", "orders_180", "units_30", "units_90", "units_180",
    "items_90", "price_units_90", "lines_90", "returns_180", "return_units_180", "has_return_180",
]
_PRODUCT_PARTS = ["products_90"]

_DAY_FEATURES = {f for f, family in FAMILY.items() if family in ("recency", "rhythm", "geo")} | {"lifetime_revenue"}
_PRODUCT_FEATURES = {"distinct_products_90d", "product_breadth_ratio"}


def top_countries(events: DataFrame, until: str, n: int = 6) -> DataFrame:
    """The n countries with most sale lines up to a day, ties by name: at most n rows."""
    visible = events.where(f"NOT is_return AND country IS NOT NULL AND event_date <= DATE'{until}'")
    return visible.groupBy("country").count().orderBy(F.desc("count"), "country").limit(n).select("country")


def _as_array(levels: DataFrame | list[str]) -> Column:
    if isinstance(levels, DataFrame):
        return levels.agg(F.sort_array(F.collect_list("country"))).scalar()
    return F.array(*[F.lit(c) for c in levels]) if levels else F.array().cast("array<string>")


def _fan_out(rows: DataFrame, asofs: list[str], look_back: int | None) -> DataFrame:
    """Repeat each row for the as-of days that may see it: on or before the day, within the look-back.

    The look-back window is (as-of - days, as-of]. Its outer bounds are plain filters, so they reach the scan.
    """
    days = ", ".join(f"DATE'{a}'" for a in asofs)
    inside = "event_date <= a" if look_back is None else f"event_date <= a AND event_date > date_sub(a, {look_back})"
    seen = rows.where(f"event_date <= DATE'{max(asofs)}'")
    if look_back is not None:
        seen = seen.where(f"event_date > date_sub(DATE'{min(asofs)}', {look_back})")
    return seen.withColumn(ASOF, F.expr(f"explode(filter(array({days}), a -> {inside}))"))


def sale_days(events: DataFrame) -> DataFrame:
    """(customer, day, country) sale cells with revenue and the latest time, reduced before the shuffle."""
    return events.where("NOT is_return").groupBy(CUSTOMER, "event_date", "country").agg(
        F.expr(f"sum({units_sql('line_revenue')}) AS rev_units"), F.max("event_ts").alias("last_ts"))


def purchase_gaps(cells: DataFrame) -> DataFrame:
    """Days since the previous purchase day, and the next cell's day, per sale cell.

    The window spans one customer's calendar, a few thousand cells at most however many lines they buy.
    """
    calendar = f"OVER (PARTITION BY {CUSTOMER} ORDER BY event_date, last_ts, country)"
    return cells.selectExpr(
        "*", f"datediff(event_date, lag(event_date) {calendar}) AS days_since", f"lead(event_date) {calendar} AS next_day",
    ).withColumn("gap", F.expr("CASE WHEN days_since > 0 THEN cast(days_since AS bigint) END"))


def _sums(table: DataFrame, keys: list[str], expressions: dict[str, str]) -> DataFrame:
    return table.groupBy(*keys).agg(*[F.expr(f"{e} AS {name}") for name, e in expressions.items()])


def _day_parts(events: DataFrame, asofs: list[str], levels: Column) -> DataFrame:
    visible = events.where(f"event_date <= DATE'{max(asofs)}'")
    gaps = purchase_gaps(sale_days(visible)).withColumn("levels", levels)
    # Position in the level list, 0 when pooled: numbers aggregate in the hash map, strings would not.
    gaps = gaps.withColumn("rank", F.expr("coalesce(array_position(levels, country), 0)")).drop("levels")
    return _sums(_fan_out(gaps, asofs, None), [ASOF, CUSTOMER], {
        "first_day": "min(event_date)",
        "last_day": "max(event_date)",
        "n_gaps": "count(gap)",
        "gap_sum": "sum(gap)",
        "gap_squares": "sum(gap * gap)",
        "lifetime_units": "sum(rev_units)",
        "country_rank": f"max(CASE WHEN next_day IS NULL OR next_day > {ASOF} THEN rank END)",
    })


def _invoice_parts(events: DataFrame, asofs: list[str]) -> DataFrame:
    within = lambda day, days: f"{day} > date_sub({ASOF}, {days})"
    revenue = units_sql("line_revenue")
    cells = _sums(_fan_out(events, asofs, LONG), [ASOF, CUSTOMER, "is_return", "invoice_no"], {
        "latest": "max(event_date)",
        "u30": f"sum(CASE WHEN {within('event_date', SHORT)} THEN {revenue} END)",
        "u90": f"sum(CASE WHEN {within('event_date', MEDIUM)} THEN {revenue} END)",
        "u180": f"sum({revenue})",
        "q90": f"sum(CASE WHEN {within('event_date', MEDIUM)} THEN {units_sql('quantity')} END)",
        "p90": f"sum(CASE WHEN {within('event_date', MEDIUM)} THEN {units_sql('unit_price')} END)",
        "n90": f"count(CASE WHEN {within('event_date', MEDIUM)} THEN unit_price END)",
    })
    sale, known = "NOT is_return", "invoice_no IS NOT NULL"
    return _sums(cells, [ASOF, CUSTOMER], {
        "orders_30": f"sum(CASE WHEN {sale} AND {known} AND {within('latest', SHORT)} THEN 1 END)",
        "orders_90": f"sum(CASE WHEN {sale} AND {known} AND {within('latest', MEDIUM)} THEN 1 END)",
        "orders_180": f"sum(CASE WHEN {sale} AND {known} THEN 1 END)",
        "units_30": f"sum(CASE WHEN {sale} THEN u30 END)",
        "units_90": f"sum(CASE WHEN {sale} THEN u90 END)",
        "units_180": f"sum(CASE WHEN {sale} THEN u180 END)",
        "items_90": f"sum(CASE WHEN {sale} THEN q90 END)",
        "price_units_90": f"sum(CASE WHEN {sale} THEN p90 END)",
        "lines_90": f"sum(CASE WHEN {sale} THEN n90 END)",
        "returns_180": f"sum(CASE WHEN is_return AND {known} THEN 1 END)",
        "return_units_180": "sum(CASE WHEN is_return THEN u180 END)",
        "has_return_180": "max(CASE WHEN is_return THEN 1 END)",
    })


def _product_parts(events: DataFrame, asofs: list[str]) -> DataFrame:
    sales = _fan_out(events.where("NOT is_return AND stock_code IS NOT NULL"), asofs, MEDIUM)
    return sales.select(ASOF, CUSTOMER, "stock_code").distinct().groupBy(ASOF, CUSTOMER).agg(F.count("*").alias("products_90"))


def feature_parts(events: DataFrame, asofs: list[str], levels: DataFrame | list[str], wanted: list[str] = FEATURES) -> DataFrame:
    """Exact additive parts per (as-of, customer) with at least one visible sale.

    The day branch always runs, as it defines the population; the others only when a feature needs them.
    """
    stacked, parts = _day_parts(events, asofs, _as_array(levels)), list(_DAY_PARTS)
    if set(wanted) - _DAY_FEATURES - {"distinct_products_90d"}:
        stacked, parts = stacked.unionByName(_invoice_parts(events, asofs), allowMissingColumns=True), parts + _INVOICE_PARTS
    if set(wanted) & _PRODUCT_FEATURES:
        stacked, parts = stacked.unionByName(_product_parts(events, asofs), allowMissingColumns=True), parts + _PRODUCT_PARTS
    extreme = {"first_day": F.min, "last_day": F.max, "country_rank": F.max, "has_return_180": F.max}
    totals = stacked.groupBy(ASOF, CUSTOMER).agg(*[extreme.get(p, F.sum)(p).alias(p) for p in parts])
    absent = [p for p in _INVOICE_PARTS + _PRODUCT_PARTS if p not in parts]
    return totals.where(F.col("last_day").isNotNull()).withColumns({p: F.lit(None).cast("long") for p in absent})


# Exact parts as doubles. Revenue is NULL, not zero, in a window without sales: the return ratio is undefined there.
_TERMS = {
    "recency": f"cast(datediff({ASOF}, last_day) AS double)",
    "tenure": f"cast(datediff({ASOF}, first_day) AS double)",
    "mean_gap": "CASE WHEN n_gaps > 0 THEN cast(gap_sum AS double) / n_gaps END",
    "var_gap": "CASE WHEN n_gaps > 1 THEN greatest((gap_squares - cast(gap_sum AS double) * gap_sum / n_gaps) / (n_gaps - 1), 0D) END",
    **{f"o{w}": f"cast(orders_{w} AS double)" for w in (SHORT, MEDIUM, LONG)},
    **{f"r{w}": f"CASE WHEN coalesce(orders_{w}, units_{w}) IS NOT NULL THEN {money_sql(f'coalesce(units_{w}, 0)')} END" for w in (SHORT, MEDIUM, LONG)},
    "lifetime": money_sql("lifetime_units"),
    "products": "cast(products_90 AS double)",
    "items": money_sql("items_90"),
    "price": f"CASE WHEN lines_90 > 0 THEN {money_sql('price_units_90')} / lines_90 END",
    "n_back": "cast(returns_180 AS double)",
    "back": f"CASE WHEN has_return_180 = 1 THEN abs({money_sql('coalesce(return_units_180, 0)')}) END",
}

_FORMULAS = {
    "recency_days": "recency",
    "tenure_days": "tenure",
    "active_days_ratio": "(tenure - recency) / (tenure + 1D)",
    "avg_interpurchase_gap_days": f"coalesce(mean_gap, {GAP_SENTINEL}D)",
    "interpurchase_gap_cv": f"sqrt(var_gap) / (mean_gap + {EPS}D)",
    "recency_over_avg_gap": f"recency / (coalesce(mean_gap, {GAP_SENTINEL}D) + {EPS}D)",
    "orders_30d": "o30",
    "orders_90d": "o90",
    "orders_180d": "o180",
    "order_freq_trend": f"o30 / (o90 / 3D + {EPS}D)",
    "revenue_30d": "r30",
    "revenue_90d": "r90",
    "revenue_180d": "r180",
    "lifetime_revenue": "lifetime",
    "aov_90d": f"r90 / (o90 + {EPS}D)",
    "revenue_trend": f"r30 / (r90 / 3D + {EPS}D)",
    "distinct_products_90d": "products",
    "avg_items_per_order_90d": f"items / (o90 + {EPS}D)",
    "avg_unit_price_90d": "price",
    "product_breadth_ratio": f"products / (items + {EPS}D)",
    "n_returns_180d": "n_back",
    "return_value_ratio_180d": "back / (r180 + 1D)",
}


def _finish(parts: DataFrame, levels: Column, ranges: dict, wanted: list[str]) -> DataFrame:
    """Feature formulas on the exact parts; NULLs survive until the final scrub and clip."""
    level = "CASE WHEN country_rank > 0 THEN element_at(_levels, cast(country_rank AS int)) END"
    terms = parts.withColumn("_levels", levels).selectExpr(
        CUSTOMER, ASOF, *[f"{e} AS {name}" for name, e in _TERMS.items()],
        f"coalesce({level}, 'Other') AS country_grp", "last_day IS NOT NULL AS has_history")
    values = terms.selectExpr(
        CUSTOMER, ASOF, *[f"{_FORMULAS[f]} AS {f}" for f in wanted if f in _FORMULAS], "country_grp", "has_history")
    return values.selectExpr(
        CUSTOMER, ASOF, *[clip_sql(scrub_sql(f), ranges.get(f)) + f" AS {f}" if f in _FORMULAS else f for f in wanted], "has_history")


def asof_features(
    events: DataFrame,
    asofs: list[str],
    levels: DataFrame | list[str] | None = None,
    ranges: dict = RANGES,
    customers: DataFrame | None = None,
    active_within: int | None = None,
    top_n: int = 6,
    wanted: list[str] = FEATURES,
) -> DataFrame:
    """Feature rows keyed by (customer, as-of day), using only events on or before that day.

    ``levels``: countries kept as their own level; by default the most frequent ones up to the first
    as-of day. ``customers``: an id table; ids without visible sales get default values and
    ``has_history`` false. ``active_within``: keep customers with a sale in (as-of - days, as-of].
    ``wanted``: the features to return; branches that none of them needs are not read.
    """
    asofs = [str(a)[:10] for a in asofs]
    if levels is None:
        levels = top_countries(events, min(asofs), top_n)
    parts = feature_parts(events, asofs, levels, wanted)
    if active_within is not None:
        parts = parts.where(F.col("last_day") > F.date_sub(F.col(ASOF), active_within))
    if customers is not None:
        asked = customers.select(CUSTOMER).distinct().withColumn(ASOF, F.explode(dates(asofs)))
        parts = asked.join(parts, [CUSTOMER, ASOF], "left")
    return _finish(parts, _as_array(levels), ranges, list(wanted))


def extra_window(events: DataFrame, asofs: list[str], days: int) -> DataFrame:
    """Orders and revenue over a window outside the contract, as additive columns keyed like the features."""
    sales = _fan_out(events.where("NOT is_return"), asofs, days)
    invoices = _sums(sales, [ASOF, CUSTOMER, "invoice_no"], {"u": f"sum({units_sql('line_revenue')})"})
    return _sums(invoices, [ASOF, CUSTOMER], {
        f"orders_{days}d": "cast(count(invoice_no) AS double)", f"revenue_{days}d": money_sql("sum(u)")})


def align_features(frame: DataFrame, strict: bool = True, keep: list[str] = []) -> DataFrame:
    """The contract columns in order, after those to keep; a missing one is an error, or a default when not strict."""
    missing = [f for f in FEATURES if f not in frame.columns]
    if missing and strict:
        raise ValueError(f"missing feature columns: {missing}")
    default = {f: F.lit("Unknown") if f not in NUMERIC else F.lit(0.0) for f in missing}
    return frame.select(*keep, *[default[f].alias(f) if f in default else F.col(f) for f in FEATURES])

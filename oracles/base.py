"""Shared common table expressions of the SQL statements."""

from __future__ import annotations

from ebbtide.contracts import NUMERIC, RANGES
from ebbtide.settings import STAR

WIDE = STAR.ranges
EV = """ev AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code, p_name AS description,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS quantity,
         p_retailprice AS unit_price,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END * p_retailprice AS line_revenue,
         o_orderdate AS event_ts, CAST(o_orderdate AS DATE) AS event_date,
         CAST(o_custkey AS VARCHAR) AS customer_id, n_name AS country, l_returnflag = 'R' AS is_return
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

RAW = """raw AS (
  SELECT CASE WHEN l_returnflag <> 'R' THEN '' WHEN l_orderkey % 2 = 0 THEN 'c' ELSE 'C' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CASE WHEN l_partkey % 100 = 0 THEN 'POST' WHEN l_partkey % 50 = 0 THEN 'post' WHEN l_partkey % 53 = 0 THEN NULL
              ELSE CAST(l_partkey AS VARCHAR) END AS stock_code,
         CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE p_name END AS description,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS quantity,
         CASE WHEN l_partkey % 97 = 0 THEN 0.0 WHEN l_partkey % 89 = 0 THEN NULL ELSE p_retailprice END AS unit_price,
         o_orderdate AS event_ts,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) || CASE WHEN l_orderkey % 3 = 0 THEN '.0' ELSE '' END END AS customer_id,
         CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE n_name END AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR l_orderkey % 11 = 0),
tagged AS (
  SELECT *, coalesce(upper(invoice_no) LIKE 'C%', false) OR coalesce(quantity < 0, false) AS is_return,
    CASE WHEN customer_id IS NULL THEN 1
         WHEN upper(stock_code) IN ('POST','D','DOT','M','C2','CRUK','S','B','BANK CHARGES','PADS','AMAZONFEE','GIFT') THEN 2
         WHEN NOT (coalesce(upper(invoice_no) LIKE 'C%', false) OR coalesce(quantity < 0, false)) AND unit_price <= 0 THEN 3
    END AS failed
  FROM raw),
clean AS (
  SELECT invoice_no, stock_code, coalesce(description, 'UNKNOWN') AS description, quantity, unit_price,
         quantity * unit_price AS line_revenue, event_ts, CAST(event_ts AS DATE) AS event_date,
         regexp_replace(customer_id, '\\.0$', '') AS customer_id, coalesce(country, 'Unknown') AS country, is_return
  FROM tagged WHERE failed IS NULL
  QUALIFY row_number() OVER (PARTITION BY invoice_no, stock_code, quantity, unit_price, event_ts
    ORDER BY description NULLS FIRST, customer_id NULLS FIRST, country NULLS FIRST) = 1)"""


def asof_list(days) -> str:
    return "asofs AS (SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in days) + "]) AS snapshot_date)"


def units(column: str) -> str:
    return f"CAST(round({column} * 10000) AS BIGINT)"


def _clip(name: str, ranges: dict) -> str:
    lo, hi = ranges[name]
    return f"least(greatest(coalesce(CAST({name} AS DOUBLE), 0.0), CAST({lo!r} AS DOUBLE)), CAST({hi!r} AS DOUBLE)) AS {name}"


def features(days, out: str = "feats", ranges: dict = WIDE, until: str | None = None, prefix: str = "") -> str:
    """CTEs (asofs .. ``out``) with every customer that has a visible sale; needs ``ev``."""
    p = prefix
    levels_until = until or min(days)
    w = lambda n: f"event_date > snapshot_date - {n}"
    return f"""{p}{asof_list(days)},
{p}hist AS (SELECT a.snapshot_date, e.* FROM ev e JOIN {p}asofs a ON e.event_date <= a.snapshot_date),
{p}base AS (
  SELECT snapshot_date, customer_id, min(event_date) AS fd, max(event_date) AS ld,
    sum({units('line_revenue')}) / 10000.0::DOUBLE AS life,
    nullif(count(DISTINCT invoice_no) FILTER ({w(30)}), 0)::DOUBLE AS o30, nullif(count(DISTINCT invoice_no) FILTER ({w(90)}), 0)::DOUBLE AS o90,
    nullif(count(DISTINCT invoice_no) FILTER ({w(180)}), 0)::DOUBLE AS o180,
    sum({units('line_revenue')}) FILTER ({w(30)})::DOUBLE / 10000.0::DOUBLE AS r30, sum({units('line_revenue')}) FILTER ({w(90)})::DOUBLE / 10000.0::DOUBLE AS r90,
    sum({units('line_revenue')}) FILTER ({w(180)})::DOUBLE / 10000.0::DOUBLE AS r180,
    nullif(count(DISTINCT stock_code) FILTER ({w(90)}), 0)::DOUBLE AS prod, sum({units('quantity')}) FILTER ({w(90)})::DOUBLE / 10000.0::DOUBLE AS items,
    sum({units('unit_price')}) FILTER ({w(90)})::DOUBLE / 10000.0::DOUBLE / nullif(count(unit_price) FILTER ({w(90)}), 0)::DOUBLE AS price
  FROM {p}hist WHERE NOT is_return GROUP BY ALL),
{p}gaps AS (SELECT customer_id, event_date, event_date - lag(event_date) OVER (PARTITION BY customer_id ORDER BY event_date) AS gap
  FROM (SELECT DISTINCT customer_id, event_date FROM ev WHERE NOT is_return)),
{p}rhythm AS (SELECT snapshot_date, customer_id, count(gap)::DOUBLE AS n, sum(gap)::DOUBLE AS s, sum(gap * gap)::DOUBLE AS q
  FROM {p}gaps JOIN {p}asofs ON event_date <= snapshot_date GROUP BY ALL),
{p}rets AS (SELECT snapshot_date, customer_id, count(DISTINCT invoice_no)::DOUBLE AS nr, abs(sum({units('line_revenue')})::DOUBLE / 10000.0::DOUBLE) AS rv
  FROM {p}hist WHERE is_return AND {w(180)} GROUP BY ALL),
{p}place AS (SELECT snapshot_date, customer_id, country FROM {p}hist WHERE NOT is_return
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, customer_id ORDER BY event_date DESC, event_ts DESC, country DESC) = 1),
{p}levels AS (SELECT country FROM ev WHERE NOT is_return AND event_date <= DATE '{levels_until}' GROUP BY country ORDER BY count(*) DESC, country LIMIT 6),
{p}calc AS (
  SELECT b.customer_id, b.snapshot_date, (b.snapshot_date - ld)::DOUBLE AS recency_days, (b.snapshot_date - fd)::DOUBLE AS tenure_days,
    ((b.snapshot_date - fd)::DOUBLE - (b.snapshot_date - ld)::DOUBLE) / ((b.snapshot_date - fd)::DOUBLE + 1.0::DOUBLE) AS active_days_ratio,
    CASE WHEN n > 0 THEN s / n ELSE 999.0 END AS avg_interpurchase_gap_days,
    CASE WHEN n > 1 THEN sqrt(greatest((q - s * s / n) / (n - 1), 0)) / (s / n + 1e-9::DOUBLE) END AS interpurchase_gap_cv,
    (b.snapshot_date - ld)::DOUBLE / (CASE WHEN n > 0 THEN s / n ELSE 999.0 END + 1e-9::DOUBLE) AS recency_over_avg_gap,
    o30 AS orders_30d, o90 AS orders_90d, o180 AS orders_180d, o30 / (o90 / 3.0::DOUBLE + 1e-9::DOUBLE) AS order_freq_trend,
    r30 AS revenue_30d, r90 AS revenue_90d, r180 AS revenue_180d, life AS lifetime_revenue,
    r90 / (o90 + 1e-9::DOUBLE) AS aov_90d, r30 / (r90 / 3.0::DOUBLE + 1e-9::DOUBLE) AS revenue_trend,
    prod AS distinct_products_90d, items / (o90 + 1e-9::DOUBLE) AS avg_items_per_order_90d, price AS avg_unit_price_90d,
    prod / (items + 1e-9::DOUBLE) AS product_breadth_ratio, nr AS n_returns_180d, rv / (r180 + 1.0::DOUBLE) AS return_value_ratio_180d,
    CASE WHEN country IN (SELECT country FROM {p}levels) THEN country ELSE 'Other' END AS country_grp
  FROM {p}base b LEFT JOIN {p}rhythm USING (snapshot_date, customer_id) LEFT JOIN {p}rets USING (snapshot_date, customer_id)
  LEFT JOIN {p}place USING (snapshot_date, customer_id)),
{out} AS (SELECT customer_id, snapshot_date, {', '.join(_clip(f, ranges) for f in NUMERIC)}, country_grp FROM {p}calc)"""


USABLE = [d for d in STAR.snapshots if d != "2001-06-30"]


def training() -> str:
    """CTEs ending in ``tt``: scoped, labelled snapshots with their fold."""
    fold = " ".join(f"WHEN snapshot_date = DATE '{d}' THEN '{f}'" for d, f in STAR.split.fold_of().items())
    return f"""{EV},
{features(USABLE)},
seen AS (SELECT DISTINCT snapshot_date, customer_id FROM ev JOIN asofs ON event_date > snapshot_date AND event_date <= snapshot_date + 90 WHERE NOT is_return),
tt AS (SELECT f.*, CASE WHEN s.customer_id IS NULL THEN 1 ELSE 0 END AS churn_90d, CASE {fold} END AS fold
  FROM feats f JOIN (SELECT DISTINCT snapshot_date, customer_id FROM ev JOIN asofs ON event_date > snapshot_date - 180 AND event_date <= snapshot_date WHERE NOT is_return) USING (snapshot_date, customer_id)
  LEFT JOIN seen s USING (snapshot_date, customer_id))"""


def rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)

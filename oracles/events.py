"""SQL for the event queries."""

from ebbtide.sources.stages import LATE_DROPS
from oracles.base import EV, RAW, units

SQL = {
    "events_canonical": f"WITH {EV} SELECT * FROM ev",
    "events_until": f"WITH {EV} SELECT * FROM ev WHERE event_date <= DATE '2000-08-31'",
    "daily_partitions": f"WITH {EV} SELECT event_date, count(*) AS n_rows FROM ev GROUP BY 1",
    "clean_events": f"WITH {RAW} SELECT * FROM clean",
    "cleaning_audit": f"""WITH {RAW},
c AS (SELECT count(*) AS n0, count(*) FILTER (failed = 1) AS f1, count(*) FILTER (failed = 2) AS f2, count(*) FILTER (failed = 3) AS f3,
      (SELECT count(*) FROM clean) AS kept FROM tagged),
s AS (SELECT 1 AS step, 'drop_missing_customer_id' AS rule, n0 AS rows_before, n0 - f1 AS rows_after, f1 AS rows_removed, n0 FROM c
  UNION ALL SELECT 2, 'drop_non_product_stock_codes', n0 - f1, n0 - f1 - f2, f2, n0 FROM c
  UNION ALL SELECT 3, 'drop_non_positive_price_sales', n0 - f1 - f2, n0 - f1 - f2 - f3, f3, n0 FROM c
  UNION ALL SELECT 4, 'drop_exact_duplicate_lines', n0 - f1 - f2 - f3, kept, n0 - f1 - f2 - f3 - kept, n0 FROM c)
SELECT step, rule, rows_before, rows_after, rows_removed, round(100.0::DOUBLE * rows_removed / n0, 3) AS pct_of_raw_removed FROM s""",
    "merge_new_events": f"WITH {RAW} SELECT * FROM clean WHERE event_date > DATE '2001-03-31'",
    "merge_idempotent": f"""WITH {EV}, k AS (SELECT DISTINCT invoice_no, stock_code, event_ts, quantity, unit_price FROM ev WHERE event_date > DATE '2001-03-31')
SELECT count(*) AS appended_first, 0::BIGINT AS appended_again FROM k""",
    "ingest_run_record": f"""WITH {RAW} SELECT (SELECT count(*) FROM tagged) AS rows_read, count(*) AS rows_after_cleaning, min(event_date) AS event_date_min, max(event_date) AS event_date_max,
  count(DISTINCT customer_id) AS n_customers, count(DISTINCT invoice_no) AS n_invoices, round(sum({units('line_revenue')})::DOUBLE / 10000, 2) AS gross_revenue,
  (SELECT count(*) FROM tagged WHERE failed = 1) AS drop_missing_customer_id, (SELECT count(*) FROM tagged WHERE failed = 2) AS drop_non_product_stock_codes,
  (SELECT count(*) FROM tagged WHERE failed = 3) AS drop_non_positive_price_sales, (SELECT count(*) FROM tagged WHERE failed IS NULL) - count(*) AS drop_exact_duplicate_lines FROM clean""",
    "ingest_run_by_year": f"""WITH {RAW}, t AS (SELECT CAST(year(event_ts) AS INTEGER) AS year, count(*) AS rows_read FROM tagged GROUP BY 1),
c AS (SELECT CAST(year(event_ts) AS INTEGER) AS year, count(*) AS rows_after_cleaning, min(event_date) AS event_date_min, max(event_date) AS event_date_max, count(DISTINCT customer_id) AS n_customers,
  count(DISTINCT invoice_no) AS n_invoices, round(sum({units('line_revenue')})::DOUBLE / 10000, 2) AS gross_revenue FROM clean GROUP BY 1)
SELECT * FROM t JOIN c USING (year)""",
    "scan_csv_roundtrip": f"WITH {RAW} SELECT country, count(*) AS n_rows, round(sum({units('line_revenue')})::DOUBLE / 10000, 2) AS net_revenue FROM clean GROUP BY 1",
    "stream_ingest": f"""WITH {RAW}, t AS (SELECT CAST(year(event_ts) AS INTEGER) AS year, count(*) AS rows_read FROM tagged GROUP BY 1),
c AS (SELECT CAST(year(event_ts) AS INTEGER) AS year, count(*) AS rows_appended, count(*) AS rows_stored FROM clean GROUP BY 1) SELECT * FROM t JOIN c USING (year)""",
    "ingest_history_summary": f"""WITH {EV}, m AS (SELECT strftime(event_date, '%Y-%m') AS f, count(*) AS n, month(max(event_date)) % 2 = 0 AS twice FROM ev GROUP BY 1)
SELECT count(*) AS files, sum(n)::BIGINT AS rows_read, sum(n)::BIGINT AS rows_appended, count(*) FILTER (twice) AS reruns, 0::BIGINT AS rows_appended_by_reruns, 0.5::DOUBLE AS mean_duration_s,
  min(n) AS warehouse_rows_min, max(n) AS warehouse_rows_max, 0::BIGINT AS rejected FROM m""",
    "ingest_history": f"""WITH {RAW}, t AS (SELECT CAST(year(event_ts) AS INTEGER) AS year, count(*) AS rows_read FROM tagged GROUP BY 1),
c AS (SELECT CAST(year(event_ts) AS INTEGER) AS year, count(*) AS rows_appended FROM clean GROUP BY 1)
SELECT year, 'ok' AS status, rows_read, coalesce(rows_appended, 0) AS rows_appended, 0::BIGINT AS n_errors FROM t LEFT JOIN c USING (year)
UNION ALL SELECT NULL, 'rejected_schema', 0, 0, 1""",
    "stream_history_summary": f"""WITH {RAW} SELECT (SELECT count(*) FROM tagged) AS rows_read, count(*) AS rows_appended, 0::BIGINT AS reruns, 0::BIGINT AS rows_appended_by_reruns,
  1::BIGINT AS rejected, count(*) AS warehouse_rows_max FROM clean""",
    "rows_since_promotion": f"""WITH {RAW}, late AS (SELECT count(*) FILTER (year(event_ts) >= {LATE_DROPS}) AS n, count(*) AS total FROM clean)
SELECT 'recency_rule' AS model, n AS rows_since, 1::BIGINT AS refused_since, total AS rows_in_all FROM late UNION ALL SELECT 'linear_fixed', total, 1, total FROM late""",
    "column_profile": f"""WITH {RAW} {' UNION ALL '.join(f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null,
  round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*), 2) AS pct_null, count(DISTINCT {c}) AS n_unique FROM raw"""
  for c in ('invoice_no', 'stock_code', 'description', 'quantity', 'event_ts', 'unit_price', 'customer_id', 'country'))}""",
    "defect_counts": f"""WITH {RAW} SELECT count(*) AS n_rows, min(event_ts) AS first_ts, max(event_ts) AS last_ts, date_diff('day', min(event_ts), max(event_ts))::INTEGER AS n_days,
  count(*) FILTER (customer_id IS NULL) AS missing_customer, count(*) FILTER (upper(invoice_no) LIKE 'C%') AS cancellations, count(*) FILTER (quantity <= 0) AS non_positive_quantity,
  count(*) FILTER (unit_price <= 0) AS non_positive_price, count(*) FILTER (abs(quantity) > 10000) AS extreme_quantity, count(DISTINCT customer_id) AS n_customers,
  count(DISTINCT invoice_no) AS n_invoices, count(DISTINCT country) AS n_countries FROM raw""",
    "clean_summary": f"""WITH {RAW} SELECT (SELECT count(*) FROM raw) AS n_raw, count(*) AS n_clean, count(DISTINCT customer_id) AS n_customers, count(*) FILTER (NOT is_return) AS n_purchases,
  count(*) FILTER (is_return) AS n_returns, round(sum({units('line_revenue')}) FILTER (NOT is_return)::DOUBLE / 10000, 2) AS sale_revenue,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM raw), 1) AS pct_retained FROM clean""",
    "weekly_revenue": f"""WITH {EV}, w AS (SELECT CAST(date_trunc('week', event_date) AS DATE) + 6 AS week_end, sum({units('line_revenue')})::DOUBLE / 10000 AS revenue FROM ev WHERE NOT is_return GROUP BY 1),
c AS (SELECT CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM w) SELECT week_end, coalesce(revenue, 0) AS revenue FROM c LEFT JOIN w USING (week_end)""",
    "monthly_active": f"""WITH {EV}, m AS (SELECT last_day(event_date) AS month_end, count(DISTINCT customer_id) AS n FROM ev WHERE NOT is_return GROUP BY 1),
c AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(month_end)), date_trunc('month', max(month_end)), INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM m)
SELECT month_end, coalesce(n, 0) AS active_customers FROM c LEFT JOIN m USING (month_end)""",
    "invoices_per_customer": f"""WITH {EV}, c AS (SELECT customer_id, count(DISTINCT invoice_no) AS n FROM ev WHERE NOT is_return GROUP BY 1)
SELECT least(n, 40) AS n_invoices, count(*) AS n_customers FROM c GROUP BY 1""",
    "invoices_per_customer_summary": f"""WITH {EV}, c AS (SELECT customer_id, count(DISTINCT invoice_no) AS n FROM ev WHERE NOT is_return GROUP BY 1)
SELECT round(avg(n), 6) AS mean, max(n) AS max, round(quantile_cont(n::DOUBLE, 0.5), 6) AS median, round(quantile_cont(n::DOUBLE, 0.95), 6) AS p95 FROM c""",
    "one_time_buyers": f"""WITH {EV}, c AS (SELECT customer_id, count(DISTINCT invoice_no) AS n FROM ev WHERE NOT is_return GROUP BY 1)
SELECT count(*) FILTER (n = 1) AS n_single, count(*) AS n_customers, round(100.0::DOUBLE * count(*) FILTER (n = 1) / count(*), 4) AS pct_single FROM c""",
    "revenue_concentration": f"""WITH {EV}, c AS (SELECT customer_id, sum({units('line_revenue')}) AS u FROM ev WHERE NOT is_return GROUP BY 1)
SELECT row_number() OVER w AS rank, customer_id, u::DOUBLE / 10000 AS revenue, round(100.0::DOUBLE * row_number() OVER w / count(*) OVER (), 6) AS pct_customers,
  round(100.0::DOUBLE * sum(u) OVER w / sum(u) OVER (), 6) AS pct_revenue FROM c WINDOW w AS (ORDER BY u DESC, customer_id)""",
    "revenue_top_share": f"""WITH {EV}, c AS (SELECT customer_id, sum({units('line_revenue')}) AS u FROM ev WHERE NOT is_return GROUP BY 1),
r AS (SELECT row_number() OVER w AS rank, count(*) OVER () AS n, sum(u) OVER w AS cum, sum(u) OVER () AS total FROM c WINDOW w AS (ORDER BY u DESC, customer_id))
SELECT n, rank AS n_top, round(100.0::DOUBLE * cum / total, 4) AS pct_revenue FROM r WHERE rank = CAST(floor(n * 0.2::DOUBLE) AS BIGINT) + 1""",
    "ingest_volume_alert": """WITH c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events WHERE ts IS NOT NULL GROUP BY 1),
d AS (SELECT g.day, coalesce(n_rows, 0) AS n_rows FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM c) g LEFT JOIN c USING (day)),
m AS (SELECT *, quantile_cont(n_rows::DOUBLE, 0.5) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS median_before FROM d)
SELECT *, coalesce(n_rows < 0.5 * median_before, false) AS alert FROM m""",
    "schema_contract": f"WITH {RAW} SELECT unnest(['InvoiceNo', 'StockCode', 'Description', 'Quantity', 'InvoiceDate', 'UnitPrice', 'CustomerID', 'Country']) AS column_name, "
    "unnest([count(invoice_no), count(stock_code), count(description), count(quantity), count(event_ts), count(unit_price), count(customer_id), count(country)]) AS n_filled, count(*) AS n_lines FROM raw",
}

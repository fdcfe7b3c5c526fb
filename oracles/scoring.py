"""SQL for lookups, re-ageing, scores and decisions."""

from datetime import date, timedelta

from ebbtide.contracts import NUMERIC, REAGED
from ebbtide.operators.scoring import LINEAR_INTERCEPT, LINEAR_WEIGHTS
from ebbtide.settings import STAR
from ebbtide.sources.stages import REQUEST_SHIFT_DAYS, SERVED_STORE_DAY
from oracles.base import EV, USABLE, features, rounded, training

Z = f"{LINEAR_INTERCEPT}::DOUBLE" + "".join(f" + ({n} - {c}::DOUBLE) * ({w})::DOUBLE" for n, c, w in LINEAR_WEIGHTS)
LINEAR = f"round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({Z}))), 9)"
STORE = f"WITH {EV}, {features([STAR.system_asof], 'store', until=USABLE[0])}"
SCORES = f"""{STORE}, ss AS (SELECT customer_id, {LINEAR} AS p FROM store),
dd AS (SELECT customer_id, p, 0.5::DOUBLE AS threshold, CAST(p >= 0.5 AS INTEGER) AS prediction,
  CASE WHEN p >= 0.70 THEN 'high' WHEN p >= 0.40 THEN 'medium' ELSE 'low' END AS risk_band,
  round(p * 0.30::DOUBLE * 45.0::DOUBLE - 8.0::DOUBLE, 3) AS expected_value FROM ss),
ranked AS (SELECT *, row_number() OVER (ORDER BY p DESC, customer_id) AS rank, count(*) OVER () AS n FROM dd),
chosen AS (SELECT rank, customer_id, p, risk_band, expected_value FROM ranked WHERE rank <= CAST(floor(n * 0.20::DOUBLE) AS BIGINT))"""
LOG = f"""{SCORES}, log AS (SELECT event_id AS request_id, CAST(user_id * 11 AS VARCHAR) AS customer_id, ts AS served_at, value AS latency_ms, event_type AS model_id,
  p AS probability, CAST(p >= 0.5 AS INTEGER) AS prediction, p IS NULL AS lookup_miss,
  greatest(date_diff('day', DATE '2024-01-15', CAST(ts AS DATE)), 0) AS feature_staleness_days
  FROM events LEFT JOIN ss ON ss.customer_id = CAST(user_id * 11 AS VARCHAR))"""
D0, D1 = "2001-05-01", "2001-05-08"
LO, HI = STAR.ranges["recency_days"]

AGED = f"""aged AS (SELECT *, least(greatest(recency_days + age, 0.0), {HI}::DOUBLE) AS r2, least(greatest(tenure_days + age, 0.0), {HI}::DOUBLE) AS t2 FROM base_rows),
re AS (SELECT * EXCLUDE (recency_days, tenure_days, active_days_ratio, recency_over_avg_gap),
  CASE WHEN age > 0 THEN r2 ELSE recency_days END AS recency_days, CASE WHEN age > 0 THEN t2 ELSE tenure_days END AS tenure_days,
  CASE WHEN age > 0 THEN least(greatest((t2 - r2) / (t2 + 1.0::DOUBLE), 0.0), 1.0) ELSE active_days_ratio END AS active_days_ratio,
  CASE WHEN age > 0 THEN least(greatest(r2 / (avg_interpurchase_gap_days + 1e-9::DOUBLE), 0.0), 200.0) ELSE recency_over_avg_gap END AS recency_over_avg_gap
  FROM aged)"""
SKEW = f"""WITH {EV}, {features([D0, D1], until=USABLE[0])},
base_rows AS (SELECT *, 7 AS age FROM feats WHERE snapshot_date = DATE '{D0}'), {AGED},
active AS (SELECT DISTINCT customer_id FROM ev WHERE NOT is_return AND event_date > DATE '{D0}' AND event_date <= DATE '{D1}'),
audit AS ({' UNION ALL '.join(f"""SELECT r.customer_id, r.customer_id IN (SELECT customer_id FROM active) AS active_in_interval, '{f}' AS feature,
  o.{f} AS stored, r.{f} AS reaged, n.{f} AS recomputed, abs(r.{f} - n.{f}) AS skew_after_reaging, abs(o.{f} - n.{f}) AS error_if_stale
  FROM re r JOIN base_rows o USING (customer_id) JOIN feats n ON n.customer_id = r.customer_id AND n.snapshot_date = DATE '{D1}'""" for f in REAGED)})"""

# The request stream: features of one day, brought forward to the day of each request.
SERVED = f"""WITH {EV}, {features([SERVED_STORE_DAY], 'store', until=USABLE[0])},
req AS (SELECT event_id AS request_id, CAST(user_id * 11 AS VARCHAR) AS customer_id, ts - INTERVAL {REQUEST_SHIFT_DAYS} DAY AS served_at,
  CAST(ts - INTERVAL {REQUEST_SHIFT_DAYS} DAY AS DATE) AS served_on, event_type AS model_id FROM events),
base_rows AS (SELECT r.*, s.* EXCLUDE (customer_id, snapshot_date), s.customer_id IS NULL AS lookup_miss, served_on - DATE '{SERVED_STORE_DAY}' AS age
  FROM req r LEFT JOIN store s USING (customer_id)), {AGED},
log AS (SELECT *, CASE WHEN NOT lookup_miss THEN {LINEAR} END AS p FROM re)"""
SERVED_DAYS = [str(date(2001, 4, 1) + timedelta(days=d)) for d in range(30)]
AT_MOMENTS = features(SERVED_DAYS, "now_rows", until=USABLE[0], prefix="m_")

SCORED = f"""{training()},
prm AS (SELECT avg(churn_90d) AS prior, quantile_cont(recency_days, 0.01) AS lo, quantile_cont(recency_days, 0.99) AS hi FROM tt WHERE fold = 'train'),
scored AS (
  SELECT 'prior' AS model, fold, snapshot_date, customer_id, churn_90d AS y, prior AS p FROM tt, prm
  UNION ALL SELECT 'recency_rule', fold, snapshot_date, customer_id, churn_90d, least(greatest((recency_days - lo) / greatest(hi - lo, 1e-9), 0.001), 0.999) FROM tt, prm
  UNION ALL SELECT 'linear_fixed', fold, snapshot_date, customer_id, churn_90d, {LINEAR} FROM tt)"""

SQL = {
    "feature_store": f"{STORE} SELECT customer_id, snapshot_date, {rounded(NUMERIC)}, country_grp, snapshot_date AS feature_timestamp FROM store",
    "feature_lookup": f"""{STORE} SELECT event_id AS request_id, CAST(user_id * 11 AS VARCHAR) AS customer_id, round(recency_days, 6) AS recency_days, round(orders_90d, 6) AS orders_90d,
  round(revenue_180d, 6) AS revenue_180d, country_grp, store.customer_id IS NULL AS lookup_miss FROM events LEFT JOIN store ON store.customer_id = CAST(user_id * 11 AS VARCHAR)""",
    "cold_start_ids": f"""{STORE} SELECT CAST(user_id * 11 AS VARCHAR) AS customer_id, count(*) AS n_requests FROM events
  WHERE CAST(user_id * 11 AS VARCHAR) NOT IN (SELECT customer_id FROM store) GROUP BY 1""",
    "reage_features": f"""{STORE}, base_rows AS (SELECT *, CAST(customer_id AS INTEGER) % 15 AS age FROM store), {AGED}
SELECT customer_id, {rounded(REAGED)}, age AS feature_staleness_days, 'feature_store' AS feature_source FROM re""",
    "skew_audit": f"{SKEW} SELECT customer_id, active_in_interval, feature, {rounded(['stored', 'reaged', 'recomputed', 'skew_after_reaging', 'error_if_stale'])} FROM audit",
    "skew_summary": f"""{SKEW} SELECT feature, active_in_interval, count(*) AS n_customers, round(max(skew_after_reaging), 6) AS max_skew,
  round(max(error_if_stale), 6) AS max_error_if_stale FROM audit GROUP BY ALL""",
    "dormant_customers": f"""WITH {EV} SELECT DISTINCT customer_id FROM ev WHERE event_date <= DATE '{D0}' AND customer_id NOT IN
  (SELECT customer_id FROM ev WHERE NOT is_return AND event_date > DATE '{D0}' AND event_date <= DATE '{D1}')""",
    "decide_contacts": f"{SCORES} SELECT * FROM dd",
    "risk_band_counts": f"{SCORES} SELECT risk_band, count(*) AS n FROM dd GROUP BY 1",
    "campaign_list": f"{SCORES} SELECT * FROM chosen",
    "campaign_summary": f"""{SCORES} SELECT count(*) AS n_contacted, min(p) AS min_p, max(p) AS max_p,
  round(sum(CAST(expected_value AS DECIMAL(18,3)))::DOUBLE, 3) AS total_expected_value FROM chosen""",
    "score_summary": f"{SCORES} SELECT count(*) AS n, round(avg(p), 6) AS mean_p, round(median(p), 6) AS p50 FROM ss",
    "predlog_by_model": f"""{LOG} SELECT model_id, count(*) AS n, round(avg(probability), 4) AS mean_prob, round(avg(latency_ms), 4) AS mean_latency_ms FROM log GROUP BY 1""",
    "ops_metrics": f"""{LOG}, w AS (SELECT CAST(served_at AS DATE) AS day, count(*) AS n_predictions, round(avg(latency_ms), 6) AS latency_mean, round(quantile_cont(latency_ms, 0.5), 6) AS latency_p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95, round(quantile_cont(latency_ms, 0.99), 6) AS latency_p99, quantile_cont(latency_ms, 0.95) > 150 AS slo_breached,
  round(avg(probability), 6) AS mean_probability, round(avg(prediction), 6) AS positive_rate FROM log WHERE NOT lookup_miss GROUP BY 1),
a AS (SELECT CAST(served_at AS DATE) AS day, count(*) AS requests_total, count(*) FILTER (lookup_miss) AS lookup_misses, count(*) FILTER (feature_staleness_days > 0) AS stale_servings FROM log GROUP BY 1)
SELECT * REPLACE (coalesce(n_predictions, 0) AS n_predictions) FROM a LEFT JOIN w USING (day)""",
    "scoring_stream": f"""{SERVED} SELECT model_id, count(*) AS n_requests, count(DISTINCT request_id) AS n_request_ids, count(*) FILTER (lookup_miss) AS n_misses,
  count(p) AS n_answers, count(*) FILTER (p >= 0.5) AS n_positive, round(avg(p), 6) AS mean_probability, max(age) FILTER (NOT lookup_miss) AS max_staleness_days FROM log GROUP BY 1""",
    "served_predictions": f"""{SERVED} SELECT request_id, customer_id, served_at, model_id, lookup_miss, CASE WHEN NOT lookup_miss THEN age END AS feature_staleness_days,
  CASE WHEN NOT lookup_miss THEN round(recency_days, 6) END AS recency_days, round(p, 6) AS probability, CAST(p >= 0.5 AS INTEGER) AS prediction,
  CASE WHEN p >= 0.70 THEN 'high' WHEN p >= 0.40 THEN 'medium' WHEN p IS NOT NULL THEN 'low' END AS risk_band,
  round(round(p * 0.30::DOUBLE * 45.0::DOUBLE - 8.0::DOUBLE, 3), 6) AS expected_value FROM log""",
    "moment_features_served": f"""WITH {EV}, {AT_MOMENTS}
SELECT customer_id, snapshot_date, {rounded(NUMERIC)}, country_grp FROM now_rows
WHERE (customer_id, snapshot_date) IN (SELECT (CAST(user_id * 11 AS VARCHAR), CAST(ts - INTERVAL {REQUEST_SHIFT_DAYS} DAY AS DATE)) FROM events)""",
    "production_skew_audit": f"""{SERVED}, {AT_MOMENTS},
audit AS ({' UNION ALL '.join(f"""SELECT model_id, '{f}' AS feature, n.recency_days < l.age AS bought_since, abs(l.{f} - n.{f}) AS skew
  FROM log l JOIN now_rows n ON n.customer_id = l.customer_id AND n.snapshot_date = l.served_on WHERE NOT lookup_miss""" for f in NUMERIC)})
SELECT model_id, feature, bought_since, count(*) AS n_answers, count(*) FILTER (skew > 1e-6) AS n_skewed, round(max(skew), 6) AS max_skew, round(avg(skew), 6) AS mean_skew
FROM audit GROUP BY ALL""",
    "flagship": f"""WITH {SCORED}, s AS (SELECT *, row_number() OVER (ORDER BY p DESC, customer_id) AS rank, count(*) OVER () AS n FROM scored
  WHERE model = 'recency_rule' AND snapshot_date = DATE '2001-01-31')
SELECT rank, s.customer_id, round(p, 6) AS p, CASE WHEN p >= 0.70 THEN 'high' WHEN p >= 0.40 THEN 'medium' ELSE 'low' END AS risk_band,
  round(p * 0.30::DOUBLE * 45.0::DOUBLE - 8.0::DOUBLE, 3) AS expected_value, round(recency_days, 6) AS recency_days, round(revenue_180d, 6) AS revenue_180d,
  country_grp, churn_90d
FROM s JOIN tt ON tt.customer_id = s.customer_id AND tt.snapshot_date = s.snapshot_date WHERE rank <= CAST(floor(n * 0.20::DOUBLE) AS BIGINT)""",
}

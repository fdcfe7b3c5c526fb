"""SQL for the queries around models that have an exact counterpart."""

from oracles.base import EV
from oracles.evaluation import CHECKS, ap, auc, panel
from oracles.scoring import SCORED, SERVED, training

S = f"WITH {SCORED}"

SQL = {
    "rare_level_pooling": f"""WITH {EV}, c AS (SELECT DISTINCT customer_id, country FROM ev), k AS (SELECT country, count(*) AS n FROM c GROUP BY 1)
SELECT CASE WHEN n >= 60 THEN country ELSE '__infrequent__' END AS level, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1""",
    "delayed_label_auc": f"""{S}, x AS (SELECT model, snapshot_date AS scored_on, s.customer_id, p, CASE WHEN EXISTS (SELECT 1 FROM ev WHERE NOT is_return AND ev.customer_id = s.customer_id
  AND event_date > s.snapshot_date AND event_date <= s.snapshot_date + 90) THEN 0 ELSE 1 END AS y FROM scored s WHERE snapshot_date + 90 <= DATE '2001-08-01'),
{auc('x', 'model, scored_on', 'xa')}, {ap('x', 'model, scored_on', 'xb')}
SELECT model, scored_on, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM xa JOIN xb USING (model, scored_on)""",
    "delayed_label_auc_logged": f"""{SERVED}, x AS (SELECT model_id AS model, p, CASE WHEN EXISTS (SELECT 1 FROM ev WHERE NOT is_return AND ev.customer_id = l.customer_id
  AND event_date > l.served_on AND event_date <= l.served_on + 90) THEN 0 ELSE 1 END AS y FROM log l WHERE NOT lookup_miss AND served_on + 90 <= DATE '2001-08-01'),
{auc('x', 'model', 'xa')}, {ap('x', 'model', 'xb')}
SELECT model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM xa JOIN xb USING (model)""",
    "early_engagement": f"""{S}, d AS (SELECT model, fold, CASE WHEN p >= 0.70 THEN 'high' WHEN p >= 0.40 THEN 'medium' ELSE 'low' END AS risk_band,
  EXISTS (SELECT 1 FROM ev WHERE NOT is_return AND ev.customer_id = s.customer_id AND event_date > s.snapshot_date AND event_date <= s.snapshot_date + 14) AS bought
  FROM scored s)
SELECT model, fold, risk_band, count(*) AS n_contacted, count(*) FILTER (bought) AS n_engaged, round(avg(bought::INT), 6) AS engagement_rate FROM d GROUP BY ALL""",
    "latest_snapshot_gate": f"""{S}, lt AS (SELECT * FROM scored WHERE snapshot_date = (SELECT max(snapshot_date) FROM scored)), {panel('lt')},
cand AS (SELECT *, NULL::DOUBLE AS incumbent_auc FROM panel), {CHECKS}
SELECT model, fold, bool_and(passed) AS promote, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (NOT passed), '') AS failed_gates,
  CASE WHEN bool_and(passed) THEN 'PROMOTE' ELSE 'DO_NOT_PROMOTE' END AS decision FROM checks GROUP BY model, fold""",
    # Isotonic fit in closed form: at each point the largest of the smallest means that end at or after it.
    "calibrate_isotonic": f"""{S}, v AS (SELECT fold, p, y FROM scored WHERE model = 'linear_fixed' AND fold = 'valid'),
c AS (SELECT p, sum(y) AS s, count(*) AS n, row_number() OVER (ORDER BY p) AS i FROM v GROUP BY p),
t AS (SELECT i, p, coalesce(sum(s) OVER w, 0) - s AS s0, sum(s) OVER w AS s1, sum(n) OVER w - n AS n0, sum(n) OVER w AS n1 FROM c WINDOW w AS (ORDER BY i)),
m AS (SELECT a.i AS j, b.i AS i, min((b.s1 - a.s0) / (b.n1 - a.n0)::DOUBLE) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS least FROM t a JOIN t b ON a.i <= b.i),
g AS (SELECT t.p, max(least) AS fit FROM m JOIN t USING (i) GROUP BY t.p),
every AS (SELECT 'raw' AS model, fold, p, y FROM v UNION ALL SELECT 'calibrated', fold, fit, y FROM v JOIN g USING (p))
SELECT model, fold, count(*) AS n, round(avg((p - y) * (p - y)), 6) AS brier,
  round(avg(-ln(CASE WHEN y = 1 THEN least(greatest(p, 1e-6), 1 - 1e-6) ELSE 1 - least(greatest(p, 1e-6), 1 - 1e-6) END)), 6) AS log_loss FROM every GROUP BY ALL""",
    **{name: f"""WITH {training()} SELECT model, fold, count(*) AS n, round(avg(churn_90d), 6) AS base_rate, true AS p_valid{more} FROM tt, (SELECT unnest({tiers}) AS model) GROUP BY ALL"""
       for name, tiers, more in (
           ("scored_long", ["trivial_prior", "heuristic_recency", "baseline_logistic", "candidate_boosted"], ""),
           ("train_logreg", ["baseline_logistic"], ", true AS settled"), ("train_gbt", ["candidate_boosted"], ", true AS rounds_in_bounds"))},
}

"""SQL for metrics, curves, campaign money and promotion gates."""

from ebbtide.operators.campaign import depth_grid
from ebbtide.settings import STAR
from oracles.base import rounded
from oracles.scoring import SCORED

S = f"WITH {SCORED}"


def auc(source: str, group: str, name: str = "auc") -> str:
    """Rank-sum form: average ranks of the positives."""
    return f"""{name}_r AS (SELECT {group}, y, rank() OVER (PARTITION BY {group} ORDER BY p) + (count(*) OVER (PARTITION BY {group}, p) - 1) / 2.0 AS r FROM {source}),
{name} AS (SELECT {group}, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / nullif(sum(y) * sum(1 - y), 0)::DOUBLE AS roc_auc FROM {name}_r GROUP BY {group})"""


def ap(source: str, group: str, name: str = "ap") -> str:
    return f"""{name}_c AS (SELECT {group}, p, sum(y) AS pos, count(*) AS n FROM {source} GROUP BY {group}, p),
{name}_t AS (SELECT {group}, p, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen, sum(pos) OVER (PARTITION BY {group}) AS pp,
  sum(n - pos) OVER w AS fp, sum(n - pos) OVER (PARTITION BY {group}) AS nn FROM {name}_c WINDOW w AS (PARTITION BY {group} ORDER BY p DESC)),
{name} AS (SELECT {group}, sum(pos::DOUBLE * tp / seen) / nullif(max(pp), 0) AS pr_auc FROM {name}_t GROUP BY {group})"""


def topk(source: str, group: str, name: str = "tk") -> str:
    return f"""{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY p DESC, customer_id, snapshot_date) AS rank,
  count(*) OVER (PARTITION BY {group}) AS n, sum(y) OVER (PARTITION BY {group}) AS n_pos,
  sum(y) OVER (PARTITION BY {group} ORDER BY p DESC, customer_id, snapshot_date) AS captured FROM {source})"""


def slices(source: str, group: str, name: str = "sl") -> str:
    part = lambda share: f"rank <= greatest(ceil(n * {share}::DOUBLE), 1)"
    cols = []
    for label, share in (("decile", 0.1), ("quintile", 0.2)):
        precision = f"avg(y) FILTER ({part(share)})"
        cols += [f"{precision} AS precision_at_top_{label}", f"coalesce(sum(y) FILTER ({part(share)}) / nullif(sum(y), 0)::DOUBLE, 0) AS recall_at_top_{label}",
                 f"{precision} / nullif(avg(y), 0) AS lift_at_top_{label}"]
    return f"{topk(source, group, name)}, {name} AS (SELECT {group}, {', '.join(cols)} FROM {name}_r GROUP BY {group})"


def panel(source: str, group: str = "model, fold", name: str = "panel") -> str:
    return f"""{auc(source, group, name + '_auc')}, {ap(source, group, name + '_ap')}, {slices(source, group, name + '_sl')},
{name}_c AS (SELECT {group}, count(*) AS n, avg(y) AS base_rate, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 0 AND p < 0.5) AS tn, avg((p - y) * (p - y)) AS brier,
  avg(-ln(CASE WHEN y = 1 THEN least(greatest(p, 1e-6), 1 - 1e-6) ELSE 1 - least(greatest(p, 1e-6), 1 - 1e-6) END)) AS log_loss FROM {source} GROUP BY {group}),
{name} AS (SELECT *, (tp + tn) / n::DOUBLE AS accuracy, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS "precision", coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1
  FROM {name}_c JOIN {name}_auc USING ({group}) JOIN {name}_ap USING ({group}) JOIN {name}_sl USING ({group}))"""


SLICE_COLS = [f"{m}_at_top_{s}" for s in ("decile", "quintile") for m in ("precision", "recall", "lift")]
PANEL_COLS = ["base_rate", "roc_auc", "pr_auc", "accuracy", '"precision"', "recall", "f1", "brier", "log_loss"]


def _rounded(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def grid(values) -> str:
    return "grid AS (SELECT unnest([" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "]) AS part)"


GAINS = [0.02 + i * (1.0 - 0.02) / 59 for i in range(60)]
DEPTHS = f"""at_k AS (SELECT r.*, part FROM tk_r r, grid WHERE rank = CAST(greatest(ceil(n * part), 1) AS BIGINT))"""
MONEY = """captured * 0.30::DOUBLE AS saved, captured * 0.30::DOUBLE * 45.0::DOUBLE AS gross, rank * 8.0::DOUBLE AS cost,
  rank * (n_pos / n::DOUBLE) * 0.30::DOUBLE * 45.0::DOUBLE - rank * 8.0::DOUBLE AS chance"""
VALUE = f"""{S}, {topk('scored', 'model, fold')}, {{grid}}, {DEPTHS}, m AS (SELECT *, {MONEY} FROM at_k),
v AS (SELECT model, fold, part AS capacity, rank AS n_contacted, CAST(captured AS BIGINT) AS true_positives, round(saved, 2) AS expected_saved, round(gross, 2) AS gross_margin,
  round(cost, 2) AS campaign_cost, round(gross - cost, 2) AS net_value, round(chance, 2) AS net_value_random, round(gross - cost - chance, 2) AS uplift_vs_random,
  round((gross - cost) / cost, 4) AS roi, 0.592593::DOUBLE AS break_even_precision, captured / rank::DOUBLE >= 8.0::DOUBLE / (0.30::DOUBLE * 45.0::DOUBLE) AS profitable FROM m)"""

G = STAR.gates
CHECKS = f"""checks AS (
  SELECT model, fold, 'roc_auc_floor' AS gate, round(roc_auc, 6) AS observed, '>=' AS operator, {G.min_roc_auc}::DOUBLE AS threshold, coalesce(roc_auc >= {G.min_roc_auc}, false) AS passed FROM cand
  UNION ALL SELECT model, fold, 'pr_auc_floor', round(pr_auc, 6), '>=', {G.min_pr_auc}, coalesce(pr_auc >= {G.min_pr_auc}, false) FROM cand
  UNION ALL SELECT model, fold, 'calibration_brier_ceiling', round(brier, 6), '<=', {G.max_brier}, coalesce(brier <= {G.max_brier}, false) FROM cand
  UNION ALL SELECT model, fold, 'recall_at_top_decile_floor', round(recall_at_top_decile, 6), '>=', {G.min_recall_at_top_decile}, coalesce(recall_at_top_decile >= {G.min_recall_at_top_decile}, false) FROM cand
  UNION ALL SELECT model, fold, 'campaign_breakeven_precision', round(precision_at_top_quintile, 6), '>=', {G.min_precision_at_top_quintile}, coalesce(precision_at_top_quintile >= {G.min_precision_at_top_quintile}, false) FROM cand
  UNION ALL SELECT model, fold, 'no_regression_vs_production', round(roc_auc - incumbent_auc, 6), CASE WHEN incumbent_auc IS NULL THEN 'n/a' ELSE '>=' END, {-G.max_auc_regression},
    coalesce(incumbent_auc IS NULL OR roc_auc - incumbent_auc >= {-G.max_auc_regression}, false) FROM cand)"""
GATES = f"""{S}, {panel('scored')},
cand AS (SELECT c.*, CASE WHEN c.model <> 'recency_rule' THEN l.roc_auc END AS incumbent_auc FROM panel c JOIN panel l ON l.fold = c.fold AND l.model = 'linear_fixed'), {CHECKS}"""
STAB = f"""{S}, {auc('scored', 'model, snapshot_date, fold')}, {slices('scored', 'model, snapshot_date, fold')},
st AS (SELECT model, snapshot_date, fold, n, churn_rate, roc_auc, precision_at_top_quintile
  FROM (SELECT model, snapshot_date, fold, count(*) AS n, avg(y) AS churn_rate FROM scored GROUP BY ALL)
  JOIN auc USING (model, snapshot_date, fold) JOIN sl USING (model, snapshot_date, fold))"""

SQL = {
    "score_prior": f"{S} SELECT customer_id, snapshot_date, round(p, 6) AS p FROM scored WHERE model = 'prior'",
    "score_recency": f"{S} SELECT customer_id, snapshot_date, round(p, 6) AS p FROM scored WHERE model = 'recency_rule'",
    "score_linear": f"{S} SELECT customer_id, snapshot_date, round(p, 6) AS p FROM scored WHERE model = 'linear_fixed'",
    "metric_auc": f"{S}, {auc('scored', 'model, fold')} SELECT model, fold, round(roc_auc, 6) AS roc_auc FROM auc",
    "metric_ap": f"{S}, {ap('scored', 'model, fold')} SELECT model, fold, round(pr_auc, 6) AS pr_auc FROM ap",
    "metric_confusion": f"""{S}, {panel('scored')} SELECT model, fold, n, tp, fp, fn, tn, {_rounded(['accuracy', '"precision"', 'recall', 'f1'])} FROM panel""",
    "metric_proba": f"{S}, {panel('scored')} SELECT model, fold, {_rounded(['base_rate', 'brier', 'log_loss'])} FROM panel",
    "topk_mask": f"""{S}, {topk('scored', 'model, fold')} SELECT model, fold, snapshot_date, customer_id, rank,
  rank <= greatest(ceil(n * 0.2::DOUBLE), 1) AS selected FROM tk_r""",
    "metric_topk": f"{S}, {slices('scored', 'model, fold')} SELECT model, fold, {_rounded(SLICE_COLS)} FROM sl",
    "roc_curve": f"""{S}, {ap('scored', 'model, fold')} SELECT model, fold, round(p, 6) AS threshold, round(fp / nn::DOUBLE, 6) AS fpr, round(tp / pp::DOUBLE, 6) AS tpr FROM ap_t
  UNION ALL SELECT DISTINCT model, fold, NULL::DOUBLE, 0.0, 0.0 FROM scored""",
    "pr_curve": f"""{S}, {ap('scored', 'model, fold')} SELECT model, fold, round(p, 6) AS threshold, round(tp / seen::DOUBLE, 6) AS "precision", round(tp / pp::DOUBLE, 6) AS recall FROM ap_t
  UNION ALL SELECT DISTINCT model, fold, NULL::DOUBLE, 1.0, 0.0 FROM scored""",
    "calibration_curve": f"""{S}, r AS (SELECT model, fold, p, row_number() OVER (PARTITION BY model, fold ORDER BY p) - 1 AS i, count(*) OVER (PARTITION BY model, fold) AS n FROM scored),
want AS (SELECT DISTINCT model, fold, k, ((n - 1) * k) // 10 AS lo, ((n - 1) * k) % 10 AS m FROM r, (SELECT unnest(range(1, 10)) AS k)),
e AS (SELECT w.model, w.fold, k, CASE WHEN m = 0 THEN a.p ELSE a.p + (b.p - a.p) * (m / 10.0::DOUBLE) END AS edge FROM want w
  JOIN r a ON a.model = w.model AND a.fold = w.fold AND a.i = lo LEFT JOIN r b ON b.model = w.model AND b.fold = w.fold AND b.i = lo + 1),
b AS (SELECT s.model, s.fold, s.p, s.y, (SELECT count(*) FROM e WHERE e.model = s.model AND e.fold = s.fold AND edge < s.p) AS bin FROM scored s)
SELECT model, fold, CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS observed_rate FROM b GROUP BY ALL""",
    "gains_curve": f"""{S}, {topk('scored', 'model, fold')}, {grid(GAINS)}, {DEPTHS}
SELECT model, fold, round(part, 6) AS part, n, CAST(n_pos AS BIGINT) AS n_pos, rank AS k, CAST(captured AS BIGINT) AS captured, round(coalesce(captured / nullif(n_pos, 0)::DOUBLE, 0), 6) AS gain FROM at_k""",
    "campaign_value": f"{VALUE.replace('{grid}', grid([0.2]))} SELECT * FROM v",
    "campaign_best_model": f"""{VALUE.replace('{grid}', grid([0.2]))} SELECT fold, arg_max(model, (net_value, model)) AS best_model, max(net_value) AS net_value,
  round(max(net_value) - max(net_value) FILTER (model = 'recency_rule'), 2) AS lead_over_recency_rule FROM v GROUP BY fold""",
    "depth_sweep": f"{VALUE.replace('{grid}', grid(depth_grid()))} SELECT model, fold, round(capacity, 6) AS capacity, n_contacted, true_positives, net_value FROM v",
    "model_comparison": f"{S}, {panel('scored')} SELECT model, fold, n, {_rounded(PANEL_COLS)}, {_rounded(SLICE_COLS)} FROM panel",
    "promotion_gates": f"{GATES} SELECT * FROM checks",
    "promotion_decision": f"""{GATES} SELECT model, fold, bool_and(passed) AS promote, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (NOT passed), '') AS failed_gates,
  CASE WHEN bool_and(passed) THEN 'PROMOTE' ELSE 'DO_NOT_PROMOTE' END AS decision FROM checks GROUP BY model, fold""",
    "gate_negative_control": f"""{S}, live AS (SELECT * FROM scored), {auc('live', 'model, fold', 'la')},
dam AS (SELECT 'scrambled_' || model AS model, fold, snapshot_date, customer_id, y,
    round(least(greatest(0.4::DOUBLE * p + 0.6::DOUBLE * (CAST('0x' || substr(md5(customer_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE), 1e-4), 1 - 1e-4), 9) AS p FROM live
  UNION ALL SELECT 'overconfident_' || model, fold, snapshot_date, customer_id, y, round(least(greatest(pow(p, 0.35::DOUBLE), 1e-4), 1 - 1e-4), 9) FROM live),
{panel('dam')}, cand AS (SELECT panel.*, la.roc_auc AS incumbent_auc FROM panel JOIN la ON la.fold = panel.fold AND la.model = regexp_replace(panel.model, '^(scrambled|overconfident)_', '')), {CHECKS} SELECT * FROM checks""",
    "snapshot_stability": f"{STAB} SELECT model, snapshot_date, fold, n, {_rounded(['churn_rate', 'roc_auc', 'precision_at_top_quintile'])} FROM st",
    "generalisation_gap": f"""{STAB} SELECT model, round(avg(roc_auc) FILTER (fold = 'train'), 6) AS auc_in_sample, round(avg(roc_auc) FILTER (fold <> 'train'), 6) AS auc_out_of_sample,
  round(avg(roc_auc) FILTER (fold = 'train') - avg(roc_auc) FILTER (fold <> 'train'), 6) AS gap FROM st GROUP BY model""",
}

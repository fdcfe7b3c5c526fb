"""SQL for profiles, drift, data quality and the retraining policy."""

from ebbtide.contracts import FAMILY, FEATURES, NUMERIC, RANGES, feature_rows
from ebbtide.operators.scoring import RULE_MODELS
from ebbtide.settings import STAR
from oracles.base import EV, training
from oracles.evaluation import auc
from oracles.scoring import SCORED

T = f"WITH {training()}, tr AS (SELECT * FROM tt WHERE fold = 'train'), te AS (SELECT * FROM tt WHERE fold = 'test')"
PROBS = [(i, 10) for i in range(11)] + [(p, 100) for p in (1, 25, 50, 75, 99)]


def long(source: str, name: str, keep: str = "") -> str:
    pairs = ", ".join(f"struct_pack(feature := '{f}', value := {f})" for f in NUMERIC)
    return f"{name} AS (SELECT {keep + ',' if keep else ''} unnest([{pairs}], recursive := true) FROM {source})"


def quantiles(source: str, name: str, probs) -> str:
    pairs = ", ".join(f"({a}, {b})" for a, b in probs)
    return f"""{name}_r AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY feature) AS n FROM {source} WHERE value IS NOT NULL),
{name}_w AS (SELECT DISTINCT feature, num, den, ((n - 1) * num) // den AS lo, ((n - 1) * num) % den AS m FROM {name}_r, (VALUES {pairs}) v(num, den)),
{name} AS (SELECT w.feature, num, den, CASE WHEN m = 0 THEN a.value ELSE a.value + (b.value - a.value) * (m / den::DOUBLE) END AS q
  FROM {name}_w w JOIN {name}_r a ON a.feature = w.feature AND a.i = lo LEFT JOIN {name}_r b ON b.feature = w.feature AND b.i = lo + 1)"""


PROFILE = f"""{T}, {long('tr', 'ltr')}, {quantiles('ltr', 'qq', PROBS)},
ed AS (SELECT feature, CASE WHEN len(u) < 3 THEN [] ELSE u[2:len(u) - 1] END AS edges FROM (SELECT feature, list_sort(list_distinct(list(q))) AS u FROM qq WHERE den = 10 GROUP BY feature)),
st AS (SELECT feature, count(*) AS n_rows, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max, avg((value IS NULL)::INT) AS null_rate FROM ltr GROUP BY feature),
prof AS (SELECT st.*, edges, {', '.join(f"(SELECT q FROM qq WHERE qq.feature = st.feature AND den = 100 AND num = {p}) AS p{p:02d}" for p in (1, 25, 50, 75, 99))}
  FROM st JOIN ed USING (feature)),
eb AS (SELECT feature, bin, edges FROM ed, LATERAL (SELECT unnest(range(0, len(edges) + 1)) AS bin)),
ec AS (SELECT feature, len(list_filter(edges, lambda e: e <= value)) AS bin, count(*) AS n FROM ltr JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY ALL),
ex AS (SELECT eb.feature, eb.bin, CASE WHEN eb.bin > 0 THEN edges[eb.bin] END AS lo, CASE WHEN eb.bin < len(edges) THEN edges[eb.bin + 1] END AS hi,
  coalesce(n, 0) / sum(n) OVER (PARTITION BY eb.feature)::DOUBLE AS expected_pct FROM eb LEFT JOIN ec USING (feature, bin))"""

SEV = "CASE WHEN psi IS NULL THEN 'unknown' WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.10 THEN 'warn' ELSE 'ok' END"


def psi(source: str, name: str, by: str = "") -> str:
    """``name``(by, feature, psi): numeric and categorical features of ``source`` against the train rows."""
    b = f"{by}, " if by else ""
    on = f"({b}feature, bin)"
    keys = f"SELECT DISTINCT {by} FROM {source}" if by else "SELECT 1 AS one"
    return f"""{long(source, name + '_l', by)},
{name}_c AS (SELECT {b}feature, len(list_filter(edges, lambda e: e <= value)) AS bin, count(*) AS n FROM {name}_l JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY ALL),
{name}_s AS (SELECT {b}feature, greatest(expected_pct, 1e-6) AS e, greatest(coalesce(n, 0) / sum(n) OVER (PARTITION BY {b}feature)::DOUBLE, 1e-6) AS a
  FROM ({keys}) CROSS JOIN ex LEFT JOIN {name}_c USING {on}),
{name}_kl AS (SELECT country_grp, count(*) / sum(count(*)) OVER ()::DOUBLE AS x FROM tr GROUP BY 1),
{name}_bl AS (SELECT {b}country_grp, count(*) AS n FROM {source} GROUP BY ALL),
{name}_bt AS (SELECT {b}sum(n) AS t, sum(n) FILTER (country_grp NOT IN (SELECT country_grp FROM tr)) AS un, count(*) FILTER (country_grp NOT IN (SELECT country_grp FROM tr)) AS n_unseen FROM {name}_bl {'GROUP BY ' + by if by else ''}),
{name}_cs AS (SELECT {'t.' + by + ', ' if by else ''}'country_grp' AS feature, greatest(x, 1e-6) AS e, greatest(coalesce(n, 0) / t::DOUBLE, 1e-6) AS a
    FROM {name}_bt t CROSS JOIN {name}_kl k LEFT JOIN {name}_bl b ON b.country_grp = k.country_grp {f'AND b.{by} = t.{by}' if by else ''}
  UNION ALL SELECT {b}'country_grp', 1e-6, greatest(un / t::DOUBLE, 1e-6) FROM {name}_bt WHERE n_unseen > 0),
{name} AS (SELECT {b}feature, sum((a2 - e2) * ln(a2 / e2)) AS psi FROM (SELECT {b}feature, e / sum(e) OVER (PARTITION BY {b}feature) AS e2, a / sum(a) OVER (PARTITION BY {b}feature) AS a2
  FROM (SELECT * FROM {name}_s UNION ALL SELECT * FROM {name}_cs)) GROUP BY {b}feature)"""


KS = f"""{long('te', 'lte')},
kc AS (SELECT feature, value, sum(r) AS r, sum(b) AS b FROM (SELECT feature, value, 1 AS r, 0 AS b FROM ltr UNION ALL SELECT feature, value, 0, 1 FROM lte) GROUP BY ALL),
kt AS (SELECT *, sum(r) OVER w AS cr, sum(b) OVER w AS cb, sum(r) OVER (PARTITION BY feature) AS n_ref, sum(b) OVER (PARTITION BY feature) AS n_batch
  FROM kc WINDOW w AS (PARTITION BY feature ORDER BY value)),
kd AS (SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_batch AS BIGINT) AS n_batch, max(abs(cr / n_ref::DOUBLE - cb / n_batch::DOUBLE)) AS d FROM kt GROUP BY ALL),
kl AS (SELECT *, sqrt(n_ref::DOUBLE * n_batch / (n_ref + n_batch)) * d AS lam FROM kd),
ks AS (SELECT feature, n_ref, n_batch, n_batch < 20 AS low_power, CASE WHEN n_batch > 0 AND n_ref > 0 THEN d END AS ks_stat, CASE WHEN n_batch > 0 AND n_ref > 0 THEN CASE WHEN lam < 0.04 THEN 1 ELSE
  least(greatest(2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * k * k * lam * lam))), 0), 1) END END AS ks_pvalue FROM kl)"""

DRIFT = f"""{PROFILE}, {KS}, {psi('te', 'ps')}, {quantiles('lte', 'bq', [(1, 2)])},
bm AS (SELECT feature, avg(value) AS batch_mean FROM lte GROUP BY feature),
drift AS (SELECT ps.feature, CASE WHEN ps.feature = 'country_grp' THEN 'categorical' ELSE 'numeric' END AS kind, psi, ks_stat, ks_pvalue, coalesce(ks_pvalue < 0.01, false) AS ks_flag,
  prof.mean AS ref_mean, batch_mean, (batch_mean - prof.mean) / greatest(std, 1e-9) AS mean_shift_in_ref_sd, p50 AS ref_p50, bq.q AS batch_p50,
  CASE WHEN ps.feature = 'country_grp' THEN (SELECT n_unseen FROM ps_bt) ELSE 0 END AS n_unseen, {SEV} AS severity
  FROM ps LEFT JOIN ks USING (feature) LEFT JOIN prof USING (feature) LEFT JOIN bq USING (feature) LEFT JOIN bm USING (feature))"""


def rollup(source: str, by: str = "", confirmed: str = "") -> str:
    return f"""SELECT {by + ',' if by else ''} count(*) AS n_features, count(*) FILTER (severity = 'alert') AS n_alert, count(*) FILTER (severity = 'warn') AS n_warn, {confirmed}
  round(count(*) FILTER (severity IN ('alert', 'warn')) / count(*)::DOUBLE, 4) AS drift_share,
  CASE WHEN count(*) FILTER (severity IN ('alert', 'warn')) / count(*)::DOUBLE >= 0.30 OR count(*) FILTER (severity = 'alert') >= 3 THEN 'alert'
       WHEN count(*) FILTER (severity IN ('alert', 'warn')) > 0 THEN 'warn' ELSE 'ok' END AS severity FROM {source} {'GROUP BY ' + by if by else ''}"""


def shifted(source: str) -> str:
    hi = STAR.ranges["recency_days"][1]
    money = ", ".join(f"{f} * 5.0::DOUBLE AS {f}" for f in ("revenue_30d", "revenue_90d", "revenue_180d", "lifetime_revenue", "aov_90d"))
    return f"SELECT * REPLACE ({money}, least(greatest(recency_days + 45, 0), {hi}) AS recency_days) FROM {source}"


def findings(source: str, ranges: dict, by: str = "") -> str:
    b, g = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    row = "SELECT {b}'{f}' AS feature, '{issue}' AS issue, CAST({value} AS DOUBLE) AS value, '{limit}' AS threshold, {sev} AS severity FROM {source} {g} HAVING {cond}"
    parts = [row.format(b=b, g=g, source=source, f=f, issue="high_null_rate", value=f"round(avg(({f} IS NULL)::INT), 4)", limit="0.02", sev="'alert'", cond=f"avg(({f} IS NULL)::INT) > 0.02") for f in FEATURES]
    for f, (lo, hi) in ranges.items():
        bad = f"count(*) FILTER ({f} < {lo} OR {f} > {hi})"
        parts.append(row.format(b=b, g=g, source=source, f=f, issue="out_of_range", value=bad, limit=f"[{lo}, {hi}]", sev=f"CASE WHEN {bad} / count(*)::DOUBLE > 0.01 THEN 'alert' ELSE 'warn' END", cond=f"{bad} > 0"))
    parts += [row.format(b=b, g=g, source=source, f=f, issue="constant_column", value=f"count(DISTINCT {f})", limit="> 1", sev="'alert'", cond=f"count(DISTINCT {f}) <= 1") for f in NUMERIC]
    parts.append(row.format(b=b, g=g, source=source, f="customer_id", issue="duplicate_entities", value="count(*) - count(DISTINCT customer_id)", limit="0", sev="'warn'", cond="count(*) > count(DISTINCT customer_id)"))
    return " UNION ALL ".join(f"({p})" for p in parts)


FAULTY = """SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN NULL ELSE lifetime_revenue END AS lifetime_revenue,
  CASE WHEN CAST(customer_id AS BIGINT) % 11 = 0 THEN -0.5 ELSE product_breadth_ratio END AS product_breadth_ratio, 77.0 AS tenure_days) FROM te"""
WORST = "CASE WHEN count(*) FILTER (severity = 'alert') > 0 THEN 'alert' WHEN count(*) > 0 THEN 'warn' ELSE 'ok' END"
CATALOGUE = "cat AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{f}', {'NULL' if d is None else d}::INT, {r})" for n, f, d, r in feature_rows()) + ") c(feature, family, window_days, reaged))"


def scores(model: str) -> str:
    return f"""WITH {SCORED}, sr AS (SELECT 'p' AS feature, p, p AS value FROM scored WHERE model = '{model}' AND fold = 'train'),
sb AS (SELECT p FROM scored WHERE model = '{model}' AND fold = 'test'), {quantiles('sr', 'pq', [(i, 10) for i in range(11)])},
pe AS (SELECT CASE WHEN len(u) < 3 THEN [0.5] ELSE u[2:len(u) - 1] END AS edges FROM (SELECT list_sort(list_distinct(list(q))) AS u FROM pq))"""


SCORES = scores("recency_rule")


def score_psi(batch: str, name: str) -> str:
    return f"""{name}_y AS (SELECT len(list_filter(edges, lambda e: e <= p)) AS bin, sum(r) AS r, sum(b) AS b FROM (SELECT p, 1 AS r, 0 AS b FROM sr UNION ALL SELECT p, 0, 1 FROM {batch}), pe GROUP BY 1),
{name}_x AS (SELECT bin, greatest(coalesce(r, 0) / sum(r) OVER ()::DOUBLE, 1e-6) AS e, greatest(coalesce(b, 0) / sum(b) OVER ()::DOUBLE, 1e-6) AS a
  FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin FROM pe) LEFT JOIN {name}_y USING (bin)),
{name} AS (SELECT sum((a2 - e2) * ln(a2 / e2)) AS psi FROM (SELECT e / sum(e) OVER () AS e2, a / sum(a) OVER () AS a2 FROM {name}_x))"""


MONTHS = ", ".join(f"DATE '{d}'" for d in STAR.snapshots if d not in STAR.split.train)
LAST = max(STAR.split.train)
LATER = "later AS (SELECT * FROM tt WHERE fold IN ('valid', 'purged', 'test'))"
SIGNALS = f"""{PROFILE}, {LATER}, {psi('later', 'pl', 'snapshot_date')}, dl AS (SELECT *, {SEV} AS severity FROM pl),
dr AS ({rollup('dl', 'snapshot_date')}), fi AS ({findings('later', STAR.ranges, 'snapshot_date')}),
{SCORED[SCORED.index('prm AS'):]}, sx AS (SELECT * FROM scored WHERE model = 'recency_rule' AND fold <> 'train'), {auc('sx', 'snapshot_date', 'sa')},
sp AS (SELECT * FROM scored WHERE model = 'recency_rule' AND fold = 'valid'), {auc('sp', 'model', 'pa')},
nights AS (SELECT DISTINCT snapshot_date, snapshot_date + 90 AS night FROM later),
sig AS (SELECT night, night - DATE '{LAST}' AS model_age_days, (SELECT count(*) FROM (SELECT unnest([{MONTHS}]) AS d) WHERE d + 90 <= night) AS new_labelled_snapshots,
  sa.roc_auc AS recent_auc, (SELECT roc_auc FROM pa) AS auc_at_promotion, drift_share, dr.severity AS drift_status, true AS schema_ok,
  NOT EXISTS (SELECT 1 FROM fi WHERE fi.snapshot_date = nights.snapshot_date AND fi.severity = 'alert') AS data_quality_ok,
  (SELECT count(*) FROM ev WHERE event_date > DATE '{LAST}' AND event_date <= night) AS rows_since_training
  FROM nights JOIN sa USING (snapshot_date) JOIN dr USING (snapshot_date))"""

def retrain_decision(broken: str = "false") -> str:
    """Decisions of all nights; a night for which ``broken`` holds had a batch without the contract's columns."""
    return f"""{SIGNALS}, f AS (SELECT *, new_labelled_snapshots >= 1 AS fresh, coalesce(round(auc_at_promotion, 6) - round(recent_auc, 6) >= 0.05, false) AS degraded FROM sig),
g AS (SELECT night, concat_ws(',', CASE WHEN degraded THEN 'performance_degradation' END, CASE WHEN model_age_days >= 30 AND fresh THEN 'model_staleness' END,
  CASE WHEN (drift_status = 'alert' OR drift_share >= 0.30) AND fresh THEN 'feature_drift' END) AS fired,
  concat_ws(',', CASE WHEN {broken} THEN 'schema_break' END, CASE WHEN NOT data_quality_ok THEN 'data_quality_failure' END) AS blocked_by, degraded FROM f)
SELECT night, blocked_by = '' AND fired <> '' AS should_retrain, CASE WHEN blocked_by <> '' THEN 'blocked' WHEN degraded THEN 'high' WHEN fired <> '' THEN 'scheduled' ELSE 'none' END AS urgency, fired, blocked_by FROM g"""


SQL = {
    "ref_profile_numeric": f"""{PROFILE} SELECT feature, n_rows, {', '.join(f'round({c}, 6) AS {c}' for c in ('mean', 'std', 'min', 'max', 'null_rate', 'p01', 'p25', 'p50', 'p75', 'p99'))} FROM prof""",
    "ref_profile_bins": f"{PROFILE} SELECT feature, CAST(bin AS INTEGER) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi, round(expected_pct, 6) AS expected_pct FROM ex",
    "ref_profile_categorical": f"{T} SELECT 'country_grp' AS feature, country_grp AS level, count(*) AS n, round(count(*) / (SELECT count(*) FROM tr)::DOUBLE, 6) AS expected_pct, 0.0::DOUBLE AS null_rate FROM tr GROUP BY country_grp",
    "ref_profile_target": f"{T} SELECT count(*) AS n_rows, round(avg(churn_90d), 6) AS base_rate FROM tr",
    "profile_by_family": f"{PROFILE}, {CATALOGUE} SELECT family, window_days, reaged, count(*) AS n_features, round(avg(null_rate), 6) AS mean_null_rate FROM prof JOIN cat USING (feature) GROUP BY ALL",
    "psi_numeric": f"{PROFILE}, {psi('te', 'ps')} SELECT feature, round(psi, 6) AS psi, {SEV} AS severity FROM ps WHERE feature <> 'country_grp'",
    "psi_categorical": f"""{PROFILE}, tx AS (SELECT * REPLACE (CASE WHEN country_grp = 'Other' THEN 'Elsewhere' ELSE country_grp END AS country_grp) FROM te), {psi('tx', 'ps')}
SELECT feature, round(psi, 6) AS psi, (SELECT n_unseen FROM ps_bt) AS n_unseen, {SEV} AS severity FROM ps WHERE feature = 'country_grp'""",
    "ks_two_sample": f"{PROFILE}, {KS} SELECT feature, n_ref, n_batch, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue, low_power FROM ks",
    "feature_drift": f"""{DRIFT} SELECT feature, kind, {', '.join(f'round({c}, 6) AS {c}' for c in ('psi', 'ks_stat', 'ks_pvalue', 'ref_mean', 'batch_mean', 'mean_shift_in_ref_sd', 'ref_p50', 'batch_p50'))},
  ks_flag, n_unseen, severity FROM drift""",
    "top_drifting": f"{DRIFT} SELECT feature, kind, round(psi, 6) AS psi, severity FROM drift ORDER BY drift.psi DESC, feature LIMIT 8",
    "drift_rollup": f"{DRIFT} {rollup('drift', confirmed='''count(*) FILTER (severity <> 'ok' AND ks_flag) AS n_confirmed,''')}",
    "drift_injected": f"""{PROFILE}, two AS (SELECT *, 'real' AS scenario FROM te UNION ALL SELECT *, 'injected' FROM ({shifted('te')})), {psi('two', 'ps', 'scenario')}
SELECT scenario, feature, round(psi, 6) AS psi, {SEV} AS severity FROM ps""",
    "drift_contrast": f"""{PROFILE}, two AS (SELECT *, 'real' AS scenario FROM te UNION ALL SELECT *, 'injected' FROM ({shifted('te')})), {psi('two', 'ps', 'scenario')},
d AS (SELECT *, {SEV} AS severity FROM ps) {rollup('d', 'scenario')}""",
    "drift_by_snapshot": f"{PROFILE}, {LATER}, {psi('later', 'pl', 'snapshot_date')}, dl AS (SELECT *, {SEV} AS severity FROM pl) {rollup('dl', 'snapshot_date')}",
    "prediction_drift": " UNION ALL ".join(f"""SELECT '{m}' AS model, x.* FROM ({scores(m)}, {score_psi('sb', 'sd')} SELECT round(psi, 6) AS psi,
  (SELECT round(avg(p), 6) FROM sr) AS ref_mean_score, (SELECT round(avg(p), 6) FROM sb) AS batch_mean_score,
  (SELECT round(avg((p >= 0.5)::INT), 6) FROM sr) AS ref_positive_rate, (SELECT round(avg((p >= 0.5)::INT), 6) FROM sb) AS batch_positive_rate, {SEV} AS severity FROM sd) x"""
        for m in RULE_MODELS),
    "dq_findings": f"{T} {findings('te', RANGES)}",
    "dq_injected": f"{T}, fb AS ({FAULTY}) {findings('fb', STAR.ranges)}",
    "dq_duplicates": f"{T} {findings('tr', STAR.ranges)}",
    "dq_rollup": f"""{T}, fb AS ({FAULTY}), f1 AS ({findings('te', STAR.ranges)}), f2 AS ({findings('fb', STAR.ranges)}), f3 AS ({findings('tr', STAR.ranges)})
SELECT count(*) AS n_findings, {WORST} AS severity, 'healthy' AS scenario FROM f1 UNION ALL SELECT count(*), {WORST}, 'faulty' FROM f2 UNION ALL SELECT count(*), {WORST}, 'repeated' FROM f3""",
    "row_contract_violations": f"""{T}, v AS (SELECT customer_id, concat_ws(',', {', '.join(f"CASE WHEN {f} < {lo} OR {f} > {hi} THEN '{f}' END" for f, (lo, hi) in RANGES.items())}) AS violations FROM te)
SELECT * FROM v WHERE violations <> ''""",
    "top_contributions": f"""{PROFILE}, {long('te', 'lte', 'customer_id')}, z AS (SELECT customer_id, abs(round((value - mean) / greatest(std, 1e-9), 3)) AS abs_z FROM lte JOIN prof USING (feature)),
r AS (SELECT customer_id, abs_z, row_number() OVER (PARTITION BY customer_id ORDER BY abs_z DESC) AS place FROM z) SELECT customer_id, CAST(place AS INTEGER) AS place, abs_z FROM r WHERE place <= 5""",
    "retrain_signals": f"""{SIGNALS} SELECT night, CAST(model_age_days AS INTEGER) AS model_age_days, CAST(new_labelled_snapshots AS INTEGER) AS new_labelled_snapshots, round(recent_auc, 6) AS recent_auc,
  round(auc_at_promotion, 6) AS auc_at_promotion, drift_share, drift_status, schema_ok, data_quality_ok, rows_since_training FROM sig""",
    "retrain_decision": retrain_decision(),
    "retrain_decision_broken_night": retrain_decision(f"night = DATE '{STAR.split.purged[0]}' + {STAR.label.horizon_days}"),
    "monitoring_suite": f"""{PROFILE}, sh AS ({shifted('te')}), {psi('te', 'pr')}, {psi('sh', 'pi')},
fr AS ({findings('te', STAR.ranges)}), fi AS ({findings('sh', STAR.ranges)}),
{SCORED[SCORED.index('prm AS'):]}, sr AS (SELECT 'p' AS feature, p, p AS value FROM scored WHERE model = 'recency_rule' AND fold = 'train'),
sb AS (SELECT p FROM scored WHERE model = 'recency_rule' AND fold = 'test'),
si AS (SELECT least(greatest((recency_days - lo) / greatest(hi - lo, 1e-9), 0.001), 0.999) AS p FROM sh, prm), {quantiles('sr', 'pq', [(i, 10) for i in range(11)])},
pe AS (SELECT CASE WHEN len(u) < 3 THEN [0.5] ELSE u[2:len(u) - 1] END AS edges FROM (SELECT list_sort(list_distinct(list(q))) AS u FROM pq)),
{score_psi('sb', 'dr')}, {score_psi('si', 'di')},
rr AS (SELECT *, {SEV} AS severity FROM pr), ri AS (SELECT *, {SEV} AS severity FROM pi), small AS (SELECT count(*) < 200 AS skip FROM te),
checks AS (SELECT 'real' AS batch, 'schema' AS "check", 'ok' AS severity UNION ALL SELECT 'injected', 'schema', 'ok' UNION ALL SELECT 'lost_column', 'schema', 'alert'
  UNION ALL SELECT 'lost_column', 'data_quality', 'skipped' UNION ALL SELECT 'real', 'data_quality', {WORST} FROM fr UNION ALL SELECT 'injected', 'data_quality', {WORST} FROM fi
  UNION ALL SELECT 'real', 'feature_drift', severity FROM ({rollup('rr')})
  UNION ALL SELECT 'injected', 'feature_drift', severity FROM ({rollup('ri')})
  UNION ALL SELECT 'real', 'prediction_drift', {SEV} FROM dr UNION ALL SELECT 'injected', 'prediction_drift', {SEV} FROM di),
every AS (SELECT * FROM checks UNION ALL SELECT batch, 'overall', CASE WHEN bool_or(severity = 'alert') THEN 'alert' WHEN bool_or(severity = 'warn') THEN 'warn' ELSE 'ok' END FROM checks GROUP BY batch)
SELECT batch, "check", severity, CASE WHEN "check" = 'data_quality' THEN severity NOT IN ('alert', 'skipped') ELSE severity IN ('ok', 'skipped') END AS passed,
  batch <> 'lost_column' AND "check" IN ('feature_drift', 'overall') AND skip AS low_power FROM every, small""",
    "feature_schema_check": f"""{T} SELECT unnest(['missing', 'unexpected', 'unexpected', 'wrong_type']) AS finding, unnest(['orders_90d', 'fold', 'note', 'tenure_days']) AS column_name, count(*) AS n_rows FROM te""",
    "align_features": f"""{T} SELECT customer_id, 0.0::DOUBLE AS recency_days, 'Unknown' AS country_grp, {', '.join(f'round({c}, 6) AS {c}' for c in NUMERIC if c != 'recency_days')} FROM te""",
}

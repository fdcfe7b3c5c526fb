"""SQL for the feature, snapshot and label queries."""

from ebbtide.contracts import FAMILY, FEATURES, NUMERIC
from ebbtide.settings import STAR
from oracles.base import EV, USABLE, asof_list, features, rounded, training, units

DAY = "2001-01-31"
AT = f"WITH {EV}, {features([DAY])}"
ALL = f"WITH {training()}"
SCOPE = f"""WITH {EV}, {asof_list(STAR.snapshots)},
scope AS (SELECT DISTINCT snapshot_date, customer_id FROM ev JOIN asofs ON event_date > snapshot_date - 180 AND event_date <= snapshot_date WHERE NOT is_return),
sized AS (SELECT snapshot_date, count(*) AS n_in_scope FROM scope GROUP BY 1)"""
FOLD = "CASE " + " ".join(f"WHEN snapshot_date = DATE '{d}' THEN '{f}'" for d, f in STAR.split.fold_of().items()) + " END"
TRAINED = ", ".join(f"DATE '{d}'" for d in STAR.split.train)


def _family(name: str) -> str:
    columns = [f for f in FEATURES if FAMILY[f] == name]
    return f"{AT} SELECT customer_id, {', '.join(f'round({c}, 6) AS {c}' if c in NUMERIC else c for c in columns)} FROM feats"


SQL = {
    "features_asof": f"{AT} SELECT customer_id, snapshot_date, {rounded(NUMERIC)}, country_grp FROM feats",
    "feat_recency": _family("recency"),
    "feat_rhythm": _family("rhythm"),
    "feat_frequency": _family("frequency"),
    "feat_monetary": _family("monetary"),
    "feat_basket": _family("basket"),
    "feat_returns": _family("returns"),
    "feat_country": _family("geo"),
    "feature_windows_extra": f"""WITH {EV} SELECT DATE '{DAY}' AS snapshot_date, customer_id, count(DISTINCT invoice_no)::DOUBLE AS orders_60d,
  sum({units('line_revenue')})::DOUBLE / 10000.0::DOUBLE AS revenue_60d
FROM ev WHERE NOT is_return AND event_date > DATE '{DAY}' - 60 AND event_date <= DATE '{DAY}' GROUP BY ALL""",
    "customers_in_scope": f"{SCOPE} SELECT snapshot_date, customer_id FROM scope",
    "churn_labels": f"""{ALL} SELECT customer_id, snapshot_date, churn_90d FROM tt WHERE snapshot_date = DATE '{DAY}'""",
    "snapshot_build": f"""WITH {training().replace(features(USABLE), features([DAY]))}
SELECT customer_id, snapshot_date, {rounded(NUMERIC)}, country_grp, churn_90d FROM tt""",
    "training_table": f"{ALL} SELECT customer_id, snapshot_date, {rounded(NUMERIC)}, country_grp, churn_90d, fold FROM tt",
    "censoring_report": f"""{SCOPE} SELECT snapshot_date, snapshot_date + 90 AS label_window_ends,
  snapshot_date + 90 <= DATE '{STAR.system_asof}' AS fully_observed, n_in_scope FROM sized""",
    "label_maturity": f"""{SCOPE} SELECT snapshot_date, snapshot_date + 90 AS labels_mature_on, snapshot_date + 90 <= DATE '{STAR.system_asof}' AS usable_today,
  CAST(greatest(snapshot_date + 90 - DATE '{STAR.system_asof}', 0) AS INTEGER) AS days_until_mature,
  snapshot_date IN ({TRAINED}) AS in_training_set, n_in_scope FROM sized""",
    "embargo_report": f"""{SCOPE}, f AS (SELECT *, {FOLD} AS fold FROM sized)
SELECT a.fold, a.snapshot_date, b.fold AS later_fold, b.snapshot_date AS later_snapshot_date,
  CAST(a.snapshot_date + 90 - b.snapshot_date AS INTEGER) AS overlap_days, a.n_in_scope
FROM f a JOIN f b ON a.fold <> b.fold AND b.snapshot_date > a.snapshot_date AND a.snapshot_date + 90 >= b.snapshot_date""",
    "temporal_split": f"{ALL} SELECT customer_id, snapshot_date, churn_90d, fold FROM tt WHERE fold IN ('train', 'valid', 'test')",
    "split_report": f"""{ALL} SELECT fold, string_agg(DISTINCT CAST(snapshot_date AS VARCHAR), ', ' ORDER BY CAST(snapshot_date AS VARCHAR)) AS snapshots,
  count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, round(avg(churn_90d), 4) AS churn_rate
FROM tt WHERE fold <> 'purged' GROUP BY fold""",
    "fold_entity_overlap": f"""{ALL}, c AS (SELECT customer_id, bool_or(fold = 'train') AS tr, bool_or(fold = 'test') AS te, count(*) AS n FROM tt GROUP BY 1)
SELECT count(*) FILTER (tr AND te) AS n_in_train_and_test, max(n) AS max_snapshots_per_customer, count(*) AS n_customers FROM c""",
    "churn_by_snapshot": f"{ALL} SELECT snapshot_date, count(*) AS n, round(avg(churn_90d), 6) AS churn_rate FROM tt GROUP BY 1",
}

"""Score metrics against brute force, campaign money, gates and decisions."""

import random
from datetime import date

import pytest
from conftest import by
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ebbtide.operators import campaign, ranking, scoring
from ebbtide.settings import Economics, GateThresholds

DAY = date(2024, 1, 31)
SCHEMA = "model string, fold string, snapshot_date date, customer_id string, y int, p double"


def _scored(spark, pairs, model="m", fold="valid"):
    return spark.createDataFrame([(model, fold, DAY, f"c{i:04d}", y, float(p)) for i, (y, p) in enumerate(pairs)], SCHEMA)


def _auc(pairs):
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for ya, a in pairs for yb, b in pairs if ya == 1 and yb == 0]
    return sum(wins) / len(wins)


def _ap(pairs):
    total, found, seen, area = sum(y for y, _ in pairs), 0, 0, 0.0
    for score in sorted({p for _, p in pairs}, reverse=True):
        group = [y for y, p in pairs if p == score]
        found, seen = found + sum(group), seen + len(group)
        area += sum(group) / total * found / seen
    return area


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=60).filter(lambda x: 0 < sum(y for y, _ in x) < len(x)))
def test_auc_and_ap_equal_pair_counts(spark, pairs):
    got = ranking.rank_metrics(_scored(spark, pairs)).first()
    assert got.roc_auc == pytest.approx(_auc(pairs), abs=1e-12)
    assert got.pr_auc == pytest.approx(_ap(pairs), abs=1e-12)


def test_one_class_has_no_auc(spark):
    assert ranking.rank_metrics(_scored(spark, [(1, 0.2), (1, 0.4)])).first().roc_auc is None


def test_groups_do_not_mix(spark):
    rng = random.Random(5)
    parts = {name: [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(80)] for name in ("a", "b")}
    both = _scored(spark, parts["a"], "a").unionByName(_scored(spark, parts["b"], "b"))
    got = by(ranking.rank_metrics(both), "model")
    assert all(got[n].roc_auc == pytest.approx(_auc(parts[n])) for n in parts)


def test_threshold_metrics(spark):
    got = ranking.threshold_metrics(_scored(spark, [(1, 0.9), (0, 0.6), (1, 0.4), (0, 0.0)])).first()
    assert (got.tp, got.fp, got.fn, got.tn, got.accuracy, got.precision, got.recall, got.f1) == (1, 1, 1, 1, 0.5, 0.5, 0.5, 0.5)
    assert got.brier == pytest.approx((0.01 + 0.36 + 0.36 + 0) / 4)
    nobody = ranking.threshold_metrics(_scored(spark, [(1, 0.1), (0, 0.2)])).first()
    assert (nobody.precision, nobody.f1) == (0.0, 0.0) and nobody.log_loss > 0


def test_topk_and_slices(spark):
    pairs = [(1, 0.9), (1, 0.9), (0, 0.9), (1, 0.5), (0, 0.4), (0, 0.3), (0, 0.2), (0, 0.1), (0, 0.05), (0, 0.01), (1, 0.0)]
    scored = _scored(spark, pairs)
    mask = ranking.topk_mask(scored, 0.2).where("selected").orderBy("rank").collect()
    assert [r.customer_id for r in mask] == ["c0000", "c0001", "c0002"]
    got = ranking.slice_metrics(scored).first()
    assert got.precision_at_top_quintile == pytest.approx(2 / 3) and got.recall_at_top_quintile == 0.5
    assert got.lift_at_top_quintile == pytest.approx((2 / 3) / (4 / 11))
    tiny = ranking.at_depths(_scored(spark, [(1, 0.3)]), [0.01]).first()
    assert (tiny.k, tiny.captured) == (1, 1)


def test_curves(spark):
    pairs = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)]
    roc = ranking.roc_curve(_scored(spark, pairs)).orderBy(F.desc_nulls_first("threshold")).collect()
    assert [(r.threshold, r.fpr, r.tpr) for r in roc] == [(None, 0, 0), (0.9, 0.5, 0.5), (0.4, 0.5, 1), (0.1, 1, 1)]
    pr = ranking.pr_curve(_scored(spark, pairs)).orderBy(F.desc_nulls_first("threshold")).collect()
    assert [(r.precision, r.recall) for r in pr] == [(1, 0), (0.5, 0.5), (pytest.approx(2 / 3), 1), (0.5, 1)]
    gains = ranking.gains_curve(_scored(spark, pairs), points=2, low=0.5).orderBy("part").collect()
    assert [r.gain for r in gains] == [0.5, 1.0]
    bins = ranking.calibration_curve(_scored(spark, [(i % 2, i / 100) for i in range(100)])).collect()
    assert len(bins) == 10 and sum(r.n for r in bins) == 100


def test_campaign_value(spark):
    scored = _scored(spark, [(1, 0.9), (0, 0.8)] + [(0, 0.1)] * 5 + [(1, 0.05)] * 3)
    got = campaign.campaign_value(scored).first()
    assert (got.n_contacted, got.true_positives, got.expected_saved, got.gross_margin, got.campaign_cost, got.net_value) == (2, 1, 0.3, 13.5, 16, -2.5)
    assert got.net_value_random == pytest.approx(2 * 0.4 * 13.5 - 16) and got.roi == -0.1563 and not got.profitable
    assert Economics().break_even_precision == pytest.approx(0.592593, abs=1e-6)
    assert len(campaign.depth_grid()) == 32


GOOD = dict(roc_auc=0.80, pr_auc=0.70, brier=0.15, recall_at_top_decile=0.2, precision_at_top_quintile=0.7, incumbent_auc=0.79)


def _decide(spark, **changes):
    row = {"model": "m", "fold": "valid", **GOOD, **changes}
    schema = "model string, fold string, " + ", ".join(f"{k} double" for k in GOOD)
    frame = spark.createDataFrame([tuple(row[k] for k in ("model", "fold", *GOOD))], schema)
    return campaign.promotion_decision(campaign.gate_checks(frame, GateThresholds())).first()


def test_gates(spark):
    assert _decide(spark).promote and _decide(spark).failed_gates == ""
    assert _decide(spark, incumbent_auc=None).promote
    assert _decide(spark, incumbent_auc=0.82).failed_gates == "no_regression_vs_production"
    assert _decide(spark, incumbent_auc=0.805).promote
    assert _decide(spark, brier=0.3).failed_gates == "calibration_brier_ceiling"
    bad = _decide(spark, roc_auc=None, precision_at_top_quintile=0.5)
    assert bad.decision == "DO_NOT_PROMOTE"
    assert set(bad.failed_gates.split(",")) == {"roc_auc_floor", "campaign_breakeven_precision", "no_regression_vs_production"}


def test_squashed_scores_keep_the_ranking_but_fail_calibration(spark):
    rng = random.Random(1)
    scored = _scored(spark, [(int(rng.random() < p), p) for p in [rng.random() for _ in range(300)]])
    panel = by(ranking.metric_panel(campaign.damaged_scores(scored)), "model")
    whole = ranking.metric_panel(scored).first()
    assert panel["overconfident_m"].roc_auc == pytest.approx(whole.roc_auc)
    assert panel["overconfident_m"].brier > whole.brier + 0.05
    assert panel["scrambled_m"].roc_auc < whole.roc_auc - 0.05


def test_decisions(spark):
    rows = spark.createDataFrame([("a", 0.70, None), ("b", 0.40, 0.3), ("c", 0.39, None), ("d", 0.5, 0.9)], "customer_id string, p double, asked double")
    got = by(scoring.decide(rows, requested="asked"), "customer_id")
    assert [got[c].risk_band for c in "abcd"] == ["high", "medium", "low", "medium"]
    assert [got[c].prediction for c in "abcd"] == [1, 1, 0, 0]
    assert got["a"].expected_value == pytest.approx(1.45)
    assert by(scoring.decide(rows, registered=F.lit(0.2)), "customer_id")["c"].prediction == 1
    assert [r.customer_id for r in scoring.campaign_list(scoring.decide(rows), 0.5).orderBy("rank").collect()] == ["a", "d"]


def test_store_lookup(spark):
    store = spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 2, 1), 2.0), ("b", date(2024, 1, 1), 3.0)], "customer_id string, feature_timestamp date, x double")
    asked = spark.createDataFrame([("a",), ("a",), ("z",)], "customer_id string")
    got = sorted((r.customer_id, r.x, r.lookup_miss) for r in scoring.feature_lookup(asked, store).collect())
    assert got == [("a", 2.0, False), ("a", 2.0, False), ("z", None, True)]
    assert [r.customer_id for r in scoring.cold_start(asked, store).collect()] == ["z"]

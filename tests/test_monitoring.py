"""Profiles, drift and quality on synthetic batches; the retraining policy table."""

import math
from datetime import date

import numpy as np
import pytest
from conftest import by
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ebbtide.contracts import CUSTOMER, NUMERIC, RANGES
from ebbtide.operators import explore, monitoring as M, retrain
from ebbtide.settings import MonitorThresholds


def _batch(spark, seed, n=800, shift=0.0, countries=("UK", "FR", "DE")):
    rng = np.random.default_rng(seed)
    columns = {}
    for f in NUMERIC:
        lo, hi = RANGES[f]
        small = hi <= 1
        values = rng.normal(0.5 if small else 10 + shift, 0.1 if small else 3, n)
        columns[f] = np.clip(values, lo, hi)
    labels = rng.choice(countries, n, p=(0.8, 0.1, 0.1))
    rows = [(f"c{i}", *[float(columns[f][i]) for f in NUMERIC], str(labels[i])) for i in range(n)]
    return spark.createDataFrame(rows, f"{CUSTOMER} string, " + ", ".join(f"{f} double" for f in NUMERIC) + ", country_grp string").repartition(2)


@pytest.fixture(scope="module")
def train(spark):
    return _batch(spark, 1).cache()


@pytest.fixture(scope="module")
def profile(train):
    whole = M.reference_profile(train)
    return M.Profile(*[part.cache() for part in whole])


def test_profile(train, profile):
    row = by(profile.numeric, "feature")["recency_days"]
    values = np.array([r.recency_days for r in train.select("recency_days").collect()])
    assert np.allclose(row.edges, np.quantile(values, np.linspace(0, 1, 11))[1:-1])
    assert (row.mean, row.std, row.p99) == (pytest.approx(values.mean()), pytest.approx(values.std()), pytest.approx(np.quantile(values, 0.99)))
    shares = profile.bins.groupBy("feature").agg(F.sum("expected_pct").alias("s"), F.count("*").alias("n")).collect()
    assert all(r.s == pytest.approx(1) and r.n == 10 for r in shares)


def test_no_drift_against_itself(train, profile):
    table = M.feature_drift(profile, train, train)
    assert all(r.psi == pytest.approx(0, abs=1e-12) and r.severity == "ok" and not r.ks_flag for r in table.collect())


def test_same_distribution_is_quiet_and_shift_alarms(spark, train, profile):
    quiet = M.drift_rollup(M.psi_table(profile, _batch(spark, 2), [])).first()
    loud = M.drift_rollup(M.feature_drift(profile, train, _batch(spark, 3, shift=6.0))).first()
    assert quiet.severity != "alert"
    assert loud.severity == "alert" and loud.drift_share > 0.30 and loud.n_confirmed == loud.n_alert + loud.n_warn


def test_psi_kernel(spark):
    rows = [("same", 0.5, 0.5), ("same", 0.5, 0.5), ("small", 0.5, 0.45), ("small", 0.5, 0.55), ("large", 0.5, 0.1), ("large", 0.5, 0.9), ("hole", 0.5, 0.0), ("hole", 0.5, 1.0), ("none", 0.5, None), ("none", 0.5, None)]
    got = {r.k: r.psi for r in M.psi_of(spark.createDataFrame(rows, "k string, expected_pct double, actual_pct double"), ["k"]).collect()}
    assert got["same"] == 0 and 0 < got["small"] < got["large"] < got["hole"] and math.isfinite(got["hole"]) and got["none"] is None


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=2, max_size=10).filter(lambda x: sum(a for a, _ in x) and sum(b for _, b in x)))
def test_psi_is_never_negative(spark, counts):
    a, b = sum(x for x, _ in counts), sum(y for _, y in counts)
    frame = spark.createDataFrame([("k", x / a, y / b) for x, y in counts], "k string, expected_pct double, actual_pct double")
    assert M.psi_of(frame, ["k"]).first().psi >= -1e-12


def test_ks_by_brute_force(spark, train):
    batch = _batch(spark, 4, n=150, shift=1.0)
    got = by(M.ks_two_sample(train, batch), "feature")["orders_90d"]
    a, b = (np.sort([r[0] for r in f.select("orders_90d").collect()]) for f in (train, batch))
    points = np.concatenate([a, b])
    gap = np.abs(np.searchsorted(a, points, "right") / len(a) - np.searchsorted(b, points, "right") / len(b)).max()
    assert got.ks_stat == pytest.approx(gap) and 0 <= got.ks_pvalue <= 1
    tiny = M.ks_two_sample(train, batch.limit(10)).first()
    assert tiny.low_power and 0 <= tiny.ks_stat <= 1 and 0 <= tiny.ks_pvalue <= 1 and not got.low_power


def test_near_constant_reference_has_one_bin(spark, train):
    flat = train.withColumn("orders_30d", F.lit(2.0))
    frozen = M.reference_profile(flat)
    assert by(frozen.numeric, "feature")["orders_30d"].edges == []
    assert by(M.psi_numeric(train, frozen), "feature")["orders_30d"].psi == 0


def test_unseen_level(spark, profile):
    batch = _batch(spark, 5, countries=("UK", "FR", "MARS"))
    got = M.psi_categorical(batch, profile).first()
    assert got.n_unseen == 1 and got.psi > 0.25
    assert [r.level for r in M.unseen_levels(batch, profile).collect()] == ["MARS"]


def test_prediction_drift(spark):
    frame = lambda values: spark.createDataFrame([(float(v),) for v in values], "p double")
    base = np.random.default_rng(0).random(500)
    assert M.prediction_drift(frame(base), frame(base)).first().psi == pytest.approx(0)
    moved = M.prediction_drift(frame(base), frame(np.clip(base + 0.3, 0, 1))).first()
    assert moved.severity == "alert" and moved.batch_positive_rate > moved.ref_positive_rate
    flat = M.prediction_drift(frame([0.4] * 50), frame([0.6] * 50)).first()
    assert flat.severity == "alert"


def test_quality(spark, train):
    assert M.quality_findings(train).count() == 0
    batch = train.withColumn("i", F.substring(CUSTOMER, 2, 9).cast("int")).withColumns({
        "revenue_90d": F.when(F.col("i") < 201, F.lit(None).cast("double")).otherwise(F.col("revenue_90d")),
        "active_days_ratio": F.when(F.col("i") < 51, F.lit(1.5)).otherwise(F.col("active_days_ratio")),
        "product_breadth_ratio": F.when(F.col("i") < 1, F.lit(-1.0)).otherwise(F.col("product_breadth_ratio")),
        "orders_90d": F.lit(1.0), "revenue_30d": F.when(F.col("i") < 400, F.lit(float("nan"))).otherwise(F.col("revenue_30d")),
    }).drop("i")
    got = {(r.feature, r.issue): (r.value, r.severity) for r in M.quality_findings(batch.unionByName(batch.limit(1))).collect()}
    assert got[("revenue_90d", "high_null_rate")][1] == "alert" and got[("revenue_30d", "high_null_rate")][1] == "alert"
    assert got[("active_days_ratio", "out_of_range")][1] == "alert" and got[("product_breadth_ratio", "out_of_range")] == (1, "warn")
    assert got[("orders_90d", "constant_column")] == (1, "alert") and got[("customer_id", "duplicate_entities")] == (1, "warn")
    assert len(got) == 6


def test_suite(spark, train, profile):
    status = lambda batch: {r.check: (r.severity, r.passed) for r in M.suite(profile, batch, "b").collect()}
    assert status(train)["overall"] == ("ok", True)
    broken = status(train.drop("recency_days"))
    assert broken == {"schema": ("alert", False), "data_quality": ("skipped", False), "overall": ("alert", False)}
    text = M.schema_findings(train.withColumn("recency_days", F.lit("x")).withColumn("more", F.lit(1)))
    assert text == {"missing": [], "unexpected": ["more"], "wrong_type": ["recency_days"]}
    small = by(M.suite(profile, train.limit(150), "b"), "check")
    assert small["feature_drift"].low_power and small["overall"].low_power and small["feature_drift"].severity in ("ok", "warn", "alert")
    assert status(_batch(spark, 6, shift=6.0))["overall"][0] == "alert"


def test_row_contract(spark, train):
    bad = train.withColumn("active_days_ratio", F.when(F.col(CUSTOMER) == "c3", 1.5).otherwise(F.col("active_days_ratio")))
    valid, quarantined = M.row_contract(bad)
    assert valid.count() == 799 and [(r.customer_id, r.violations) for r in quarantined.select(CUSTOMER, "violations").collect()] == [("c3", ["active_days_ratio"])]
    with pytest.raises(ValueError, match="surprise"):
        M.row_contract(train.withColumn("surprise", F.lit(1)))


CASES = [
    (dict(model_age_days=5, new_labelled_snapshots=0, recent_auc=0.79, auc_at_promotion=0.79), "none", [], []),
    (dict(model_age_days=1, recent_auc=0.70, auc_at_promotion=0.79), "high", ["performance_degradation"], []),
    (dict(model_age_days=90, new_labelled_snapshots=0), "none", [], []),
    (dict(model_age_days=90, new_labelled_snapshots=2), "scheduled", ["model_staleness"], []),
    (dict(drift_share=0.8, drift_status="alert", new_labelled_snapshots=0), "none", [], []),
    (dict(drift_share=0.8, drift_status="alert", new_labelled_snapshots=1), "scheduled", ["feature_drift"], []),
    (dict(model_age_days=999, new_labelled_snapshots=5, recent_auc=0.5, auc_at_promotion=0.8, drift_share=0.9, schema_ok=False), "blocked", None, ["schema_break"]),
    (dict(model_age_days=999, new_labelled_snapshots=5, data_quality_ok=False), "blocked", None, ["data_quality_failure"]),
]


def test_retraining_policy(spark):
    base = dict(model_age_days=1, new_labelled_snapshots=0, recent_auc=None, auc_at_promotion=None, drift_share=0.0, drift_status="ok", schema_ok=True, data_quality_ok=True, rows_since_training=0)
    rows = [(i, *{**base, **case}.values()) for i, (case, *_) in enumerate(CASES)]
    schema = "case int, model_age_days int, new_labelled_snapshots int, recent_auc double, auc_at_promotion double, drift_share double, drift_status string, schema_ok boolean, data_quality_ok boolean, rows_since_training bigint"
    got = by(retrain.retrain_decision(spark.createDataFrame(rows, schema)), "case")
    for i, (_, urgency, fired, blocked) in enumerate(CASES):
        assert got[i].urgency == urgency and got[i].blocked_by == blocked, CASES[i]
        assert fired is None or got[i].fired == fired
        assert got[i].should_retrain == (urgency in ("high", "scheduled")) and got[i].reasons


def test_calendars_have_no_holes(make_events):
    events = make_events([("A", "2024-01-01", "1", "p", 1, 10, "UK"), ("A", "2024-03-10", "2", "p", 1, 5, "UK"), ("B", "2024-03-10", "3", "p", -1, 5, "UK")])
    weeks = explore.weekly_revenue(events).orderBy("week_end").collect()
    assert (str(weeks[0].week_end), weeks[0].revenue, len(weeks)) == ("2024-01-07", 10, 10) and weeks[1].revenue == 0 and weeks[-1].revenue == 5
    assert [(str(r.month_end), r.active_customers) for r in explore.monthly_active(events).orderBy("month_end").collect()] == [("2024-01-31", 1), ("2024-02-29", 0), ("2024-03-31", 1)]


def test_concentration_and_volume(spark, make_events):
    events = make_events([(c, "2024-01-01", c, "p", 1, v, "UK") for c, v in zip("ABCDE", (50, 20, 15, 10, 5))])
    top = explore.top_share(explore.revenue_concentration(events)).first()
    assert (top.n_top, top.pct_revenue) == (2, 70)
    rows = spark.createDataFrame([(date(2024, 1, d), k) for d, n in enumerate((4, 4, 4, 1, 4), start=1) for k in range(n)], "day date, k int")
    assert [str(r.day) for r in explore.volume_alerts(rows, "day").where("alert").collect()] == ["2024-01-04"]

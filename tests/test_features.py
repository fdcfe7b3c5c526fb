"""Point-in-time features on hand-made histories."""

import math
from datetime import date, timedelta

import pytest
from conftest import by
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FEATURES, NUMERIC, RANGES, REAGED, SNAPSHOT_SCHEMA, feature_catalogue
from ebbtide.operators.aging import dormant_customers, reage, skew_audit
from ebbtide.operators.features import align_features, asof_features, extra_window, top_countries

DAY = "2022-09-30"
HISTORY = [
    ("nora", "2022-08-09", "101", "tea", 3, 4, "NL"), ("nora", "2022-08-24", "102", "cup", 2, 7.5, "NL"), ("nora", "2022-09-08", "103", "tea", 1, 4, "PT"),
    ("omar", "2022-08-31", "107", "pot", 1, 30, "NL"),
    ("pia", "2022-09-12", "104", "mug", 4, 6, "SE"), ("pia", "2022-09-13", "106", "lid", 2, 3, "SE"), ("pia", "2022-09-14", "C105", "mug", -1, 6, "SE"),
    ("quin", "2022-11-02", "108", "tea", 1, 4, "NL"),
]


def test_hand_computed_values(make_events):
    got = by(asof_features(make_events(HISTORY), [DAY]), CUSTOMER)
    assert set(got) == {"nora", "omar", "pia"}
    n, o, p = got["nora"], got["omar"], got["pia"]
    assert (n.recency_days, n.tenure_days, n.avg_interpurchase_gap_days, n.interpurchase_gap_cv) == (22, 52, 15, 0)
    assert n.recency_over_avg_gap == pytest.approx(22 / 15, abs=1e-6)
    assert n.active_days_ratio == pytest.approx(30 / 53)
    assert (n.orders_30d, n.revenue_30d, n.orders_90d, n.revenue_90d) == (1, 4, 3, 31)
    assert n.distinct_products_90d == 2 and n.avg_unit_price_90d == pytest.approx(15.5 / 3)
    assert n.product_breadth_ratio == pytest.approx(2 / 6)
    assert n.country_grp == "PT"
    # The window is open below: a sale exactly 30 days before is outside.
    assert (o.orders_30d, o.orders_90d, o.avg_interpurchase_gap_days, o.interpurchase_gap_cv) == (0, 1, 999, 0)
    assert (p.revenue_180d, p.n_returns_180d, p.avg_interpurchase_gap_days) == (30, 1, 1)
    assert p.return_value_ratio_180d == pytest.approx(6 / 31)
    assert all(r[f] is not None and math.isfinite(r[f]) for r in got.values() for f in NUMERIC)


def test_future_rows_change_nothing(make_events):
    before = asof_features(make_events(HISTORY), [DAY]).select(CUSTOMER, *FEATURES)
    later = HISTORY + [("nora", "2022-10-01", "109", "jar", 40, 9, "IE"), ("omar", "2022-10-03", "C110", "pot", -1, 30, "NL")]
    after = asof_features(make_events(later), [DAY]).select(CUSTOMER, *FEATURES)
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))


def test_row_order_and_batching_do_not_matter(make_events):
    days = ["2022-09-09", DAY]
    together = {(r.customer_id, str(r.snapshot_date)): tuple(r) for r in asof_features(make_events(HISTORY[::-1]), days, ["NL", "PT"]).collect()}
    apart = {(r.customer_id, str(r.snapshot_date)): tuple(r) for d in days for r in asof_features(make_events(HISTORY), [d], ["NL", "PT"]).collect()}
    assert together == apart


def test_sales_without_an_invoice_number_count_as_revenue(make_events):
    rows = [("ugo", "2022-09-20", None, "tea", 2, 4, "NL"), ("ugo", "2022-09-21", "111", "tea", 1, 4, "NL")]
    u = asof_features(make_events(rows), [DAY]).first()
    assert (u.orders_30d, u.revenue_30d, u.revenue_180d) == (1, 12, 12)


def test_return_without_recent_sale_has_no_ratio(make_events):
    rows = [("tom", "2021-02-03", "1", "pot", 1, 12, "NL"), ("tom", "2022-09-19", "C2", "pot", -1, 12, "NL")]
    a = asof_features(make_events(rows), [DAY]).first()
    assert (a.n_returns_180d, a.return_value_ratio_180d, a.revenue_180d) == (1, 0, 0)


def test_requested_ids_without_history(spark, make_events):
    ids = spark.createDataFrame([("nora",), ("zed",), ("zed",)], "customer_id string")
    got = by(asof_features(make_events(HISTORY), [DAY], customers=ids), CUSTOMER)
    assert set(got) == {"nora", "zed"}
    z = got["zed"]
    assert (z.recency_days, z.avg_interpurchase_gap_days, z.country_grp, z.has_history) == (0, 999, "Other", False)


def test_invoice_over_two_days_counts_once(make_events):
    rows = [("tom", "2022-09-02", "1", "pot", 1, 12, "NL"), ("tom", "2022-09-05", "1", "cup", 1, 8, "NL")]
    a = asof_features(make_events(rows), [DAY]).first()
    assert (a.orders_90d, a.revenue_90d, a.avg_interpurchase_gap_days) == (1, 20, 3)


def test_countries_are_pooled(make_events):
    events = make_events(HISTORY + [("nora", "2022-09-22", "112", "tea", 1, 4, None)])
    assert [r.country for r in top_countries(events, DAY, 2).collect()] == ["NL", "SE"]
    got = by(asof_features(events, [DAY], ["SE"]), CUSTOMER)
    assert (got["nora"].country_grp, got["pia"].country_grp) == ("Other", "SE")


def test_clipping_to_ranges(make_events):
    rows = [("tom", "2017-05-01", "1", "pot", 1, 12, "NL"), ("tom", "2017-05-02", "2", "pot", 1, 12, "NL")]
    a = asof_features(make_events(rows), [DAY]).first()
    assert (a.recency_days, a.tenure_days, a.recency_over_avg_gap) == (1000, 1000, 200)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 200), st.integers(1, 4)), min_size=1, max_size=25))
def test_windows_nest_and_stay_in_range(make_events, rows):
    start = date(2022, 3, 20)
    events = make_events([(c, str(start + timedelta(days=d)), f"{c}{d}", f"p{q}", q, 3, "UK") for c, d, q in rows])
    for r in asof_features(events, [DAY]).collect():
        assert r.orders_30d <= r.orders_90d <= r.orders_180d
        assert r.revenue_30d <= r.revenue_90d <= r.revenue_180d <= r.lifetime_revenue
        assert all(lo <= r[f] <= hi for f, (lo, hi) in RANGES.items())


def test_subset_of_features_equals_full(make_events):
    events = make_events(HISTORY)
    full = by(asof_features(events, [DAY]), CUSTOMER)
    for wanted in (["recency_days", "lifetime_revenue"], ["orders_30d"], ["distinct_products_90d"], ["product_breadth_ratio", "country_grp"]):
        for c, row in by(asof_features(events, [DAY], wanted=wanted), CUSTOMER).items():
            assert [row[f] for f in wanted] == [full[c][f] for f in wanted]


def test_extra_window(make_events):
    got = by(extra_window(make_events(HISTORY), [DAY], 20), CUSTOMER)
    assert set(got) == {"pia"} and (got["pia"].orders_20d, got["pia"].revenue_20d) == (2, 30)


def test_contract_alignment(spark, make_events):
    rows = asof_features(make_events(HISTORY), [DAY])
    shuffled = rows.select(*sorted(rows.columns))
    assert align_features(shuffled).columns == FEATURES
    with pytest.raises(ValueError, match="recency_days"):
        align_features(rows.drop("recency_days"))
    relaxed = align_features(rows.drop("recency_days", "country_grp"), strict=False).first()
    assert (relaxed.recency_days, relaxed.country_grp) == (0.0, "Unknown")
    assert SNAPSHOT_SCHEMA.fieldNames() == [CUSTOMER, ASOF, *FEATURES] and len(FEATURES) == 23
    assert feature_catalogue(spark).count() == 23


QUIET = [("rosa", "2022-03-04", "1", "pot", 1, 12, "NL"), ("rosa", "2022-03-18", "2", "pot", 1, 12, "NL")]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 60))
def test_reaging_equals_recomputation(make_events, days):
    stored_day, later = date(2022, 3, 31), date(2022, 3, 31) + timedelta(days=days)
    events = make_events(QUIET)
    stored = asof_features(events, [str(stored_day)]).withColumn("feature_timestamp", F.col(ASOF))
    aged = reage(stored, F.lit(later)).first()
    fresh = asof_features(events, [str(later)]).first()
    assert all(aged[f] == pytest.approx(fresh[f], abs=1e-9) for f in REAGED)
    assert aged.feature_staleness_days == days


def test_reaging_never_goes_back(make_events):
    stored = asof_features(make_events(QUIET), ["2022-03-31"]).withColumn("feature_timestamp", F.col(ASOF))
    aged = reage(stored, F.lit("2022-03-10").cast("date")).first()
    assert (aged.recency_days, aged.feature_staleness_days) == (13, 0)


def test_skew_only_for_customers_who_bought(make_events):
    rows = QUIET + [("sven", "2022-03-05", "3", "pot", 1, 12, "NL"), ("sven", "2022-04-07", "4", "pot", 1, 12, "NL")]
    events = make_events(rows)
    both = asof_features(events, ["2022-03-31", "2022-04-10"])
    audit = skew_audit(both, events, "2022-03-31", "2022-04-10").where("feature = 'recency_days'")
    got = by(audit, CUSTOMER)
    assert (got["rosa"].active_in_interval, got["rosa"].skew_after_reaging, got["rosa"].error_if_stale) == (False, 0, 10)
    assert got["sven"].active_in_interval and got["sven"].skew_after_reaging == 33
    assert [r.customer_id for r in dormant_customers(events, "2022-03-31", "2022-04-10").collect()] == ["rosa"]

"""Features at any moment, the scoring stream and the audit of what it served."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide.contracts import ASOF, CUSTOMER, FEATURES, NUMERIC
from ebbtide.operators import served
from ebbtide.operators.features import asof_features
from ebbtide.operators.moments import moment_features
from ebbtide.operators.scoring import linear_score
from ebbtide.streaming import score_requests

LEVELS = ["France", "Spain"]
START = date(2020, 1, 1)


def history(seed, customers=6, lines=500):
    """Lines with invoices that span days, zero and missing amounts, returns, and days that repeat."""
    pick = random.Random(seed)
    rows = []
    for _ in range(lines):
        day = START + timedelta(days=pick.choice([0, 1, 29, 30, 31, 89, 90, 179, 180, pick.randrange(400)]))
        quantity = pick.choice([-3, -1, 0, 1, 2, 7])
        rows.append((
            f"c{pick.randrange(customers)}", str(day), pick.choice([None, *[f"i{n}" for n in range(40)]]), pick.choice([None, "a", "b", "c", "d"]),
            quantity, pick.choice([0.0, 1.25, 9.99]), pick.choice(["France", "Spain", "Peru"])))
    return rows


def values(frame):
    return {(r[CUSTOMER], r[ASOF]): tuple(round(r[f], 9) if f in NUMERIC else r[f] for f in FEATURES) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_moment_equals_the_fan_out(spark, make_events, seed):
    events = make_events(history(seed))
    hole = F.col("invoice_no") == "i7"  # amounts and days that are missing
    events = events.withColumns({
        "line_revenue": F.when(~F.coalesce(hole, F.lit(False)), F.col("line_revenue")), "unit_price": F.when(~F.coalesce(hole, F.lit(False)), F.col("unit_price")),
        "event_date": F.when(F.coalesce(F.col("invoice_no") != "i9", F.lit(True)), F.col("event_date"))}).cache()
    days = [START + timedelta(days=d) for d in (-1, 0, 1, 29, 30, 59, 60, 90, 119, 120, 180, 181, 270, 365, 500)]
    asked = [(f"c{i}", d) for i in range(6) for d in days] + [("c1", days[3]), ("stranger", days[3]), (None, days[3]), ("c1", None)]
    moments = spark.createDataFrame(asked, f"{CUSTOMER} string, {ASOF} date")
    got = moment_features(events, moments, LEVELS)
    assert got.count() == got.select(CUSTOMER, ASOF).distinct().count()
    assert values(got) == values(asof_features(events, [str(d) for d in days], LEVELS))


def test_no_events_and_no_moments(spark, make_events):
    asked = spark.createDataFrame([("c1", START)], f"{CUSTOMER} string, {ASOF} date")
    assert moment_features(make_events(history(1)).limit(0), asked, LEVELS).count() == 0
    assert moment_features(make_events(history(1)), asked.limit(0), LEVELS).count() == 0


@pytest.fixture
def stage(spark, make_events, tmp_path):
    """A store of January 20 and requests after it: c1 buys again in between, c2 does not, c9 is unknown."""
    events = make_events([
        ("c1", "2020-01-01", "i1", "a", 2, 3.0, "France"), ("c1", "2020-01-25", "i2", "b", 1, 5.0, "France"), ("c2", "2020-01-10", "i3", "a", 1, 3.0, "Peru")])
    day = date(2020, 1, 20)
    store = asof_features(events, [str(day)], LEVELS).select(CUSTOMER, *FEATURES, F.col(ASOF).alias("feature_timestamp"))
    asked = [(1, "c1", datetime(2020, 1, 22, 8, 0, 0, 123456), 5.0, "m"), (2, "c1", datetime(2020, 1, 28), 6.0, "m"),
             (3, "c2", datetime(2020, 2, 15), 7.0, "m"), (4, "c9", datetime(2020, 2, 15), 8.0, "m"), (5, None, datetime(2020, 2, 15), 8.0, "m")]
    requests = spark.createDataFrame(asked, served.REQUEST_SCHEMA)
    requests.repartition(3).write.parquet(str(tmp_path / "requests"))
    return events, store, requests, tmp_path


def run(spark, stage, **more):
    _, store, _, root = stage
    score_requests.start(spark, str(root / "requests"), lambda: store, linear_score(), str(root / "log"), str(root / "checkpoint"), **more).awaitTermination()
    return score_requests.prediction_log(spark, str(root / "log"))


def test_each_request_is_logged_once(spark, stage):
    first = {r["request_id"]: r for r in run(spark, stage, files_per_batch=1).collect()}
    again = run(spark, stage).collect()
    assert sorted(r["request_id"] for r in again) == [1, 2, 3, 4, 5]
    assert first[1]["served_at"] == datetime(2020, 1, 22, 8, 0, 0, 123456)
    assert first[1]["features"]["recency_days"] == 21.0 and first[1]["feature_staleness_days"] == 2
    for miss in (4, 5):
        r = first[miss]
        assert r["lookup_miss"] and all(r[c] is None for c in ("features", "probability", "prediction", "risk_band", "expected_value", "threshold"))


def test_a_retried_batch_replaces_its_records(spark, stage):
    _, store, requests, root = stage
    for _ in range(2):
        score_requests.log_batch(requests, store, linear_score(), str(root / "log"), "s", 0)
    score_requests.log_batch(requests.where("request_id = 3"), store, linear_score(), str(root / "log"), "s", 1)
    assert score_requests.prediction_log(spark, str(root / "log")).count() == 6


def test_skew_of_what_was_served(spark, stage):
    events = stage[0]
    rows = {(r["request_id"], r["feature"]): r for r in served.recomputed(run(spark, stage), events, LEVELS).collect()}
    assert {i for i, _ in rows} == {1, 2, 3} and len(rows) == 3 * len(NUMERIC)
    assert rows[1, "recency_days"]["skew"] == 0 and not rows[1, "recency_days"]["bought_since"]
    assert rows[2, "recency_days"]["bought_since"] and rows[2, "recency_days"]["served"] == 27.0 and rows[2, "recency_days"]["recomputed"] == 3.0
    # Windows go on without the customer: the order of January 10 left the 30 days before the request.
    assert rows[3, "recency_days"]["skew"] == 0 and rows[3, "orders_30d"]["skew"] == 1.0
    summary = {(r["feature"], r["bought_since"]): r for r in served.skew_of_served(served.recomputed(run(spark, stage), events, LEVELS)).collect()}
    assert summary["orders_30d", False]["n_answers"] == 2 and summary["orders_30d", False]["n_skewed"] == 1

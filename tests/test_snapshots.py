"""Scope, labels, censoring and the temporal split."""

from datetime import date

from conftest import by

from ebbtide.contracts import ASOF, CUSTOMER, LABEL
from ebbtide.operators import snapshots as S
from ebbtide.operators.outcomes import next_purchase_within, realised_outcomes
from ebbtide.settings import Settings, SplitSpec

CALENDAR = Settings(
    system_asof="2022-09-15", snapshots=("2022-01-31", "2022-02-28", "2022-03-31", "2022-04-30", "2022-05-31"),
    split=SplitSpec(train=("2022-01-31", "2022-02-28"), valid=("2022-03-31",), purged=("2022-04-30",), test=("2022-05-31",)),
)
DAY = "2022-05-15"
ROWS = [
    ("kim", "2022-03-20", "11"), ("kim", "2022-04-28", "12"), ("lee", "2022-04-02", "13"), ("max", "2021-08-11", "14"), ("zoe", "2022-05-10", "15"), ("zoe", "2022-07-04", "16"),
]


def _events(make_events, rows=ROWS, returned=()):
    return make_events([(c, d, i, "p", -1 if i in returned else 1, 10, "UK") for c, d, i in rows])


def test_scope_and_labels(make_events):
    events = _events(make_events)
    scope = S.customers_in_scope(events, [DAY])
    assert {r.customer_id for r in scope.collect()} == {"kim", "lee", "zoe"}
    labels = {h: {c: r[LABEL] for c, r in by(S.with_labels(scope, events, [DAY], h), CUSTOMER).items()} for h in (30, 90)}
    assert labels[90] == {"kim": 1, "lee": 1, "zoe": 0}
    assert labels[30] == {"kim": 1, "lee": 1, "zoe": 1}


def test_returns_are_not_activity(make_events):
    events = _events(make_events, returned={"13", "16"})
    scope = S.customers_in_scope(events, [DAY])
    assert {r.customer_id for r in scope.collect()} == {"kim", "zoe"}
    assert by(S.with_labels(scope, events, [DAY]), CUSTOMER)["zoe"][LABEL] == 1


def test_window_edges(make_events):
    # 2021-11-16 is exactly 180 days before the as-of day, 2022-08-13 exactly 90 days after it.
    events = _events(make_events, [("eva", "2021-11-16", "1"), ("fox", "2021-11-17", "2"), ("fox", "2022-08-13", "3"), ("gus", "2022-05-15", "4"), ("gus", "2022-08-14", "5")])
    scope = S.customers_in_scope(events, [DAY])
    got = {c: r[LABEL] for c, r in by(S.with_labels(scope, events, [DAY]), CUSTOMER).items()}
    assert got == {"fox": 0, "gus": 1}


def test_snapshot_rows_are_the_scope(make_events):
    events = _events(make_events)
    rows = S.snapshot_build(events, [DAY], CALENDAR)
    assert {r.customer_id for r in rows.collect()} == {"kim", "lee", "zoe"}


def test_censoring():
    assert S.usable(CALENDAR.snapshots, CALENDAR.system_asof, 90) == list(CALENDAR.snapshots)
    assert S.usable(["2022-06-01", "2022-07-01"], "2022-09-09", 90) == ["2022-06-01"]
    assert S.usable(["2022-06-01"], "2022-08-30", 90) == ["2022-06-01"]


def test_split_is_disjoint(spark):
    rows = spark.createDataFrame([(str(i), date.fromisoformat(d), i % 2) for i, d in enumerate(CALENDAR.snapshots)], f"{CUSTOMER} string, {ASOF} date, {LABEL} int")
    folded = S.with_fold(rows, CALENDAR.split)
    assert {str(r[ASOF]): r.fold for r in folded.collect()} == CALENDAR.split.fold_of()
    kept = S.temporal_split(folded)
    assert kept.count() == 4 and kept.where("fold = 'purged'").count() == 0
    report = by(S.split_report(folded), "fold")
    assert report["train"].snapshots == "2022-01-31, 2022-02-28" and report["train"].n_rows == 2


def test_next_purchase(spark, make_events):
    events = _events(make_events)
    moments = spark.createDataFrame([("zoe", date(2022, 6, 25)), ("zoe", date(2022, 7, 4)), ("zoe", date(2022, 5, 12)), ("zoe", date(2022, 5, 1)), ("new", date(2022, 6, 25))], f"{CUSTOMER} string, day date")
    got = {(r[CUSTOMER], str(r.day)): r.bought for r in next_purchase_within(moments, events, "day", 14).collect()}
    assert got == {("zoe", "2022-06-25"): True, ("zoe", "2022-07-04"): False, ("zoe", "2022-05-12"): False, ("zoe", "2022-05-01"): True, ("new", "2022-06-25"): False}


def test_only_matured_predictions_are_judged(spark, make_events):
    log = spark.createDataFrame([("zoe", date(2022, 5, 15)), ("zoe", date(2022, 8, 1))], f"{CUSTOMER} string, scored_on date")
    got = realised_outcomes(log, _events(make_events), "2022-09-01").collect()
    assert [(str(r.scored_on), r.y) for r in got] == [("2022-05-15", 0)]

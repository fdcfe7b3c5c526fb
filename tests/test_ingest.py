"""Cleaning rules, source contract, merge and the stream."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import by
from pyspark.sql import functions as F

from ebbtide.contracts import EVENT_COLUMNS, SOURCE_COLUMNS
from ebbtide.operators import cleaning, merge
from ebbtide.settings import CleaningRules
from ebbtide.sources import retail
from ebbtide.streaming import daily_drops

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
GOOD = [
    "7001,LAMP1,LAMP,6,3/7/2019 8:30,3.10,4711.0,Norway",
    "7002,POST,POSTAGE,1,3/7/2019 8:30,18.0,4711,Norway",
    "C7003,LAMP1,LAMP,-1,3/7/2019 8:45,3.10,4711,Norway",
]


def _file(folder: Path, name: str, lines, header=HEADER, bom=True) -> str:
    path = folder / name
    path.write_text(("﻿" if bom else "") + "\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def _lines(spark, rows):
    schema = "invoice_no string, stock_code string, description string, quantity double, event_ts timestamp_ntz, unit_price double, customer_id string, country string"
    return spark.createDataFrame(rows, schema)


T = datetime(2019, 3, 7, 8, 30)


def test_rules_and_unknown_values(spark):
    lines = _lines(spark, [
        ("1", "A", "x", 1.0, T, 2.0, None, "UK"),
        ("2", "post", "x", 1.0, T, 2.0, "7", "UK"),
        ("3", None, None, 1.0, T, 2.0, "7.0", None),
        ("4", "A", "x", 1.0, T, 0.0, "7", "UK"),
        ("c5", "A", "x", 1.0, T, 0.0, "7", "UK"),
        ("6", "A", "x", 1.0, T, None, "7", "UK"),
        ("7", "A", "x", -2.0, T, 3.0, "7", "UK"),
        ("8", "A", "first", 1.0, T, 2.0, "7", "UK"), ("8", "A", "second", 1.0, T, 2.0, "7", "UK"),
    ])
    got = by(cleaning.clean_events(lines), "invoice_no")
    assert set(got) == {"3", "c5", "6", "7", "8"}
    assert (got["3"].customer_id, got["3"].country, got["3"].description) == ("7", "Unknown", "UNKNOWN")
    assert got["c5"].is_return and got["7"].is_return and not got["8"].is_return
    assert got["7"].line_revenue == -6 and got["6"].line_revenue is None
    assert got["8"].description == "first"
    audit = [(r.rule, r.rows_before, r.rows_after, r.rows_removed) for r in cleaning.cleaning_audit(lines).orderBy("step").collect()]
    assert audit == [("drop_missing_customer_id", 9, 8, 1), ("drop_non_product_stock_codes", 8, 7, 1),
                     ("drop_non_positive_price_sales", 7, 6, 1), ("drop_exact_duplicate_lines", 6, 5, 1)]


def test_missing_customers_may_stay(spark):
    lines = _lines(spark, [("1", "A", "x", 1.0, T, 2.0, None, "UK")])
    rules = CleaningRules(drop_missing_customer=False)
    assert cleaning.clean_events(lines, rules).first().customer_id is None
    assert cleaning.cleaning_audit(lines, rules).count() == 3


def test_empty_input(spark):
    empty = _lines(spark, [])
    assert [r.pct_of_raw_removed for r in cleaning.cleaning_audit(empty).collect()] == [0.0] * 4
    record = merge.run_record(empty, cleaning.clean_events(empty)).first()
    assert (record.rows_read, record.rows_after_cleaning, record.gross_revenue, record.event_date_min) == (0, 0, 0.0, None)


def test_text_scan_with_bom_and_moved_columns(spark, tmp_path):
    first = _file(tmp_path, "a.csv", GOOD)
    moved = _file(tmp_path, "b.csv", ["Norway,9,A,x,2,3/8/2019 9:00,1.5,12,extra"],
                  "Country,InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Channel", bom=False)
    rows = by(retail.typed(retail.scan_files(spark, [first, moved]), keep=["source_file"]), "invoice_no")
    assert len(rows) == 4 and rows["9"].country == "Norway" and rows["9"].unit_price == 1.5
    assert rows["7001"].event_ts == datetime(2019, 3, 7, 8, 30) and rows["7001"].customer_id == "4711.0"
    assert rows["9"].source_file.endswith("b.csv")


def test_contract(spark, tmp_path):
    with pytest.raises(retail.ContractError, match="UnitPrice"):
        retail.check_columns([c for c in SOURCE_COLUMNS if c != "UnitPrice"])
    assert retail.check_columns([*SOURCE_COLUMNS, "Channel"]) == ["Channel"]
    renamed = _file(tmp_path, "r.csv", GOOD, HEADER.replace("CustomerID", "ClientID"))
    with pytest.raises(retail.ContractError, match="CustomerID"):
        retail.scan_file(spark, renamed)


def test_bad_timestamp_aborts_or_nulls(spark, tmp_path):
    raw = retail.scan_file(spark, _file(tmp_path, "t.csv", ["1,A,x,1,2019-03-01 10:00,2,7,UK"]))
    with pytest.raises(Exception, match="(?i)parse"):
        retail.typed(raw).collect()
    assert retail.typed(raw, strict=False).first().event_ts is None


def test_merge_is_idempotent_and_null_safe(make_events):
    old = make_events([("A", "2024-01-01", "1", "p", 1, 2, "UK"), ("A", "2024-01-01", "1", None, 1, 2, "UK")])
    new = make_events([("A", "2024-01-01", "1", None, 1, 2, "FR"), ("A", "2024-01-02", "2", "p", 1, 2, "UK"), ("A", "2024-01-02", "2", "p", 1, 2, "UK")])
    added = merge.new_events(old, new)
    assert [r.invoice_no for r in added.collect()] == ["2"]
    assert merge.new_events(old.unionByName(added), new).count() == 0


def test_daily_partitions_and_tables(spark, make_events, tmp_path):
    events = make_events([("A", f"2024-01-0{d}", str(d), "p", 1, 2, "UK") for d in (1, 2, 4, 7)])
    out = str(tmp_path / "days")
    retail.write_by_day(events, out, last_days=3)
    assert sorted(p.name for p in Path(out).glob("event_date=*")) == ["event_date=2024-01-02", "event_date=2024-01-04", "event_date=2024-01-07"]
    assert retail.day_range(events, "2024-01-02", "2024-01-04").count() == 2
    table = str(tmp_path / "events")
    retail.write_events(events, table)
    retail.write_events(events, table)
    assert retail.read_events(spark, table).count() == 8 and retail.read_events(spark, table).columns == EVENT_COLUMNS
    report = events.groupBy("country").count()
    retail.write_report(report, str(tmp_path / "r.json"))
    retail.write_report(report, str(tmp_path / "r.csv"), "csv")
    assert spark.read.json(str(tmp_path / "r.json")).first()["count"] == 4


def test_stream(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    paths = [str(tmp_path / n) for n in ("events", "log", "checkpoint")]
    run = lambda: daily_drops.start(spark, str(incoming), *paths).awaitTermination()
    _file(incoming, "transactions_2019-03-01.csv", GOOD)
    run()
    _file(incoming, "transactions_2019-03-02.csv", GOOD[:1] + ["9,A,x,2,3/8/2019 9:00,1.5,12,France"])
    _file(incoming, "transactions_2019-03-03.csv", ["1,2"], "InvoiceNo,StockCode")
    run()
    run()
    log = sorted((r.source_file.split("_")[-1], r.status, r.rows_read, r.rows_appended, r.rows_deduplicated) for r in daily_drops.run_log(spark, paths[1]).collect())
    assert log == [("2019-03-01.csv", "ok", 3, 2, 0), ("2019-03-02.csv", "ok", 2, 1, 1), ("2019-03-03.csv", "rejected_schema", 0, 0, None)]
    stored = daily_drops.stored_events(spark, paths[0])
    assert sorted(r.invoice_no for r in stored.collect()) == ["7001", "9", "C7003"]
    first = daily_drops.run_log(spark, paths[1]).where("rows_read = 3").first()
    assert first.rows_rejected_by_rule["drop_non_product_stock_codes"] == 1 and first.warehouse_rows == 2
    assert first.gross_revenue == pytest.approx(15.5)


def test_retried_batch_stores_rows_once(spark, tmp_path):
    path = _file(tmp_path, "x.csv", GOOD)
    events, log = str(tmp_path / "events"), str(tmp_path / "log")
    for _ in range(2):
        daily_drops.ingest_files(spark, [path], events, log, batch=0)
    daily_drops.ingest_files(spark, [path], events, log, batch=1)
    daily_drops.ingest_files(spark, [path], events, log, batch=2, dry_run=True)
    assert daily_drops.stored_events(spark, events).count() == 2
    summary = merge.history_summary(daily_drops.run_log(spark, log)).first()
    assert (summary.files, summary.reruns, summary.rows_appended, summary.rows_appended_by_reruns) == (1, 1, 2, 0)
    assert merge.rows_since(daily_drops.run_log(spark, log), "2000-01-01").first().rows_since == 2


def _stored(spark, path):
    return sorted(r.invoice_no for r in daily_drops.stored_events(spark, path).collect())


def test_restart_with_a_new_checkpoint_loses_nothing(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    events, log = str(tmp_path / "events"), str(tmp_path / "log")
    line = lambda n: f"{n},CUP,cup,1,3/{n}/2019 9:00,2,12,Norway"
    _file(incoming, "a.csv", [line(1), line(2)])
    daily_drops.start(spark, str(incoming), events, log, str(tmp_path / "one")).awaitTermination()
    (incoming / "a.csv").unlink()
    _file(incoming, "b.csv", [line(2), line(3)])
    _file(incoming, "c.csv", ["1"], "InvoiceNo")
    _file(incoming, "d.csv", [line(4)])
    daily_drops.start(spark, str(incoming), events, log, str(tmp_path / "two"), files_per_batch=8).awaitTermination()
    assert _stored(spark, events) == ["1", "2", "3", "4"]
    assert sorted(r.status for r in daily_drops.run_log(spark, log).collect()) == ["ok", "ok", "ok", "rejected_schema"]
    assert daily_drops.run_log(spark, log).agg(F.max("warehouse_rows")).first()[0] == 4


def test_lines_without_a_time_are_stored_once(spark, tmp_path):
    path = _file(tmp_path, "x.csv", ["1,CUP,cup,1,,2,12,Norway", "2,CUP,cup,1,3/7/2019 9:00,2,12,Norway"])
    events, log = str(tmp_path / "events"), str(tmp_path / "log")
    for batch in range(3):
        daily_drops.ingest_files(spark, [path], events, log, batch)
    assert _stored(spark, events) == ["1", "2"]


def test_merge_opens_only_the_months_of_the_batch(spark, tmp_path):
    events, log = str(tmp_path / "events"), str(tmp_path / "log")
    line = lambda n, month: f"{n},CUP,cup,1,{month}/7/2019 9:00,2,12,Norway"
    for batch, month in enumerate((1, 2, 3)):
        daily_drops.ingest_files(spark, [_file(tmp_path, f"{month}.csv", [line(1, month), line(2, month)])], events, log, batch)
    for part in Path(events).rglob("month=2019-0[12]/*.parquet"):
        part.write_bytes(b"not a table")
        (part.parent / f".{part.name}.crc").unlink()
    # Rows of March and April, the first a copy: January and February are left alone, though April is beyond them.
    daily_drops.ingest_files(spark, [_file(tmp_path, "4.csv", [line(1, 3), line(9, 4)])], events, log, 3)
    assert daily_drops.stored_events(spark, events).where("month >= '2019-03'").count() == 3
    with pytest.raises(Exception, match="2019-01"):  # a late row of January needs January
        daily_drops.ingest_files(spark, [_file(tmp_path, "5.csv", [line(3, 1)])], events, log, 4)


def test_dry_run_leaves_real_records(spark, tmp_path):
    path = _file(tmp_path, "x.csv", GOOD)
    events, log = str(tmp_path / "events"), str(tmp_path / "log")
    daily_drops.ingest_files(spark, [path], events, log, 0)
    daily_drops.ingest_files(spark, [path], events, log, 0, dry_run=True)
    assert [(r.status, r.rows_appended) for r in daily_drops.run_log(spark, log).collect()] == [("ok", 2)]
    assert [r.status for r in daily_drops.run_log(spark, daily_drops.dry_log(log)).collect()] == ["dry_run"]
    assert not list(Path(f"{events}-staging").rglob("*.parquet"))


def test_outage_day_alerts(spark):
    from ebbtide.operators.explore import volume_alerts

    rows = spark.sql("SELECT timestamp'2020-01-01' + make_interval(0, 0, 0, cast(id / 10 AS int)) AS ts FROM range(100)").where("date(ts) <> date'2020-01-06'")
    got = {str(r.day): (r.n_rows, r.alert) for r in volume_alerts(rows, "ts").collect()}
    assert len(got) == 10 and got["2020-01-06"] == (0, True) and sum(a for _, a in got.values()) == 1


def test_log_sink(spark, tmp_path):
    from ebbtide.contracts import RUN_LOG_SCHEMA

    row = {f: None for f in RUN_LOG_SCHEMA.fieldNames()} | {"run_id": "1", "status": "ok", "ingested_at_utc": T, "rows_rejected_by_rule": {"a": 1}}
    frame = spark.createDataFrame([row], RUN_LOG_SCHEMA)
    for _ in range(2):
        retail.append_log(frame, str(tmp_path / "log"))
    got = retail.read_log(spark, str(tmp_path / "log"))
    assert got.count() == 2 and got.first().rows_rejected_by_rule == {"a": 1} and got.where(F.col("ingested_at_utc").isNull()).count() == 0


def test_rows_since_the_latest_promotion(spark):
    at = lambda day: datetime(2024, 1, day)
    log = spark.createDataFrame(
        [("ok", 10, at(1)), ("ok", 5, at(3)), ("rejected_schema", 0, at(4)), ("ok", 7, at(6))], "status string, rows_appended long, ingested_at_utc timestamp")
    promotions = spark.createDataFrame([("a", at(1)), ("a", at(5)), ("b", at(2)), ("c", at(9))], "model string, promoted_at timestamp")
    got = {r.model: (r.rows_since, r.refused_since, r.rows_in_all) for r in merge.since_promotion(log, promotions).collect()}
    assert got == {"a": (7, 0, 22), "b": (12, 1, 22), "c": (0, 0, 22)}
    assert merge.since_promotion(log, promotions.limit(0)).count() == 0

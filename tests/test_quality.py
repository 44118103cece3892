from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.plans import quality

T0 = datetime(2026, 1, 1)


def log(spark, sizes):
    rows = [(f"r{i}", T0 + timedelta(days=i)) for i, n in enumerate(sizes) for _ in range(n)]
    return spark.createDataFrame(rows, "run_id string, ingested_at timestamp")


def result(df):
    r = df.first()
    return r.status, r.severity, json.loads(r.details)


@pytest.mark.parametrize("hours, status, severity", [(26, "PASS", "INFO"), (25.9, "PASS", "INFO"),
                                                     (26.1, "FAIL", "WARNING"),
                                                     (26.004, "PASS", "INFO"),
                                                     (72, "FAIL", "WARNING")])
def test_freshness(spark, hours, status, severity):
    at = F.lit(T0 + timedelta(hours=hours)).cast("timestamp")
    got = result(quality.freshness(log(spark, [3]), "src", "src_raw", at, 26))
    assert got[:2] == (status, severity)
    assert got[2]["hours_since_last_ingest"] == round(hours, 2)


def test_never_ingested(spark):
    df = quality.freshness(log(spark, []), "src", "src_raw", F.current_timestamp(), 26)
    assert result(df) == ("FAIL", "CRITICAL", {"source": "src", "bronze_table": "src_raw"})
    assert df.first().description == "src has never been ingested"


@pytest.mark.parametrize("sizes, status, severity, pct", [
    ([100, 100, 130], "PASS", "INFO", 30.0), ([100, 100, 131], "FAIL", "WARNING", 31.0),
    ([100, 100, 70], "PASS", "INFO", 30.0), ([200, 100], "FAIL", "WARNING", 50.0)])
def test_deviation_of_newest_run(spark, sizes, status, severity, pct):
    got = result(quality.row_count_deviation(log(spark, sizes), "src", 30))
    assert got[:2] == (status, severity) and got[2]["deviation_pct"] == pct
    named = quality.row_count_deviation(log(spark, sizes), "src", 30, f"r{len(sizes) - 1}")
    assert result(named) == got


def test_deviation_without_history(spark):
    assert result(quality.row_count_deviation(log(spark, [5]), "src", 30)) == (
        "PASS", "INFO", {"source": "src", "today_count": 5, "historical_avg": None})
    empty = quality.row_count_deviation(log(spark, []), "src", 30)
    assert result(empty) == ("FAIL", "CRITICAL", {"source": "src"})
    assert empty.first().description == "src row count deviation (no ingestion history)"


def test_deviation_over_a_trailing_window(spark):
    since = F.lit(T0 + timedelta(days=2)).cast("timestamp")
    got = result(quality.row_count_deviation(log(spark, [900, 900, 10, 10]), "s", 30, since=since))
    assert got[0] == "PASS" and got[2]["historical_avg"] == 10.0


def test_uniqueness_lists_ten_keys(spark):
    df = spark.range(25).selectExpr("lpad(cast(id % 12 as string), 2, '0') k", "1 v")
    status, severity, details = result(quality.uniqueness(df, "t", ["k"]))
    assert (status, severity, details["duplicate_count"]) == ("FAIL", "CRITICAL", 12)
    assert details["duplicate_keys"] == [f"{i:02d}" for i in range(10)]
    assert result(quality.uniqueness(df.distinct(), "t", ["k"])) == (
        "PASS", "INFO", {"table": "t", "duplicate_count": 0, "duplicate_keys": []})
    assert result(quality.uniqueness(df, "t", ["k", "v"]))[2]["duplicate_count"] == 12


def test_consistency(spark):
    a, b = spark.range(5), spark.range(3)
    assert result(quality.shipment_consistency(a, a))[0] == "PASS"
    status, severity, details = result(quality.shipment_consistency(a, b))
    assert (status, severity) == ("FAIL", "CRITICAL")
    assert details == {"silver_shipment_count": 5, "gold_fact_shipment_count": 3,
                       "difference": 2}


def test_latest_run(spark):
    assert quality.latest_run(log(spark, [1, 2, 3])).first().run_id == "r2"
    assert quality.latest_run(log(spark, [])).first().run_id is None


def test_constraint_counters(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, None)], "k string, n int")
    rows = quality.not_null_violations(df, "t", ("k", "n")).unionByName(
        quality.check_violations(df, "t", {"n > 0": "n > 0"})).unionByName(
        quality.unique_violations(df, "t", ("k",))).unionByName(
        quality.foreign_key_violations(
            df, "t", "k", spark.createDataFrame([("b",)], "id string"), "p", "id"))
    assert {r.constraint_name: r.violations for r in rows.collect()} == {
        "k not null": 1, "n not null": 1, "n > 0": 1, "unique (k)": 1, "k references p": 2}


def test_foreign_keys_of_all_tables_count_rows_without_a_parent(spark):
    """Planted orphans, a hot one among them; NULL refers to nothing; absent rows count 0."""
    tables = {}
    for child, fk, parent, pk in quality.FOREIGN_KEYS:
        tables.setdefault(child, {}).setdefault(fk, [1, 2, 2, 7, 7, 7, None])
        tables.setdefault(parent, {}).setdefault(pk, [1, 2, 3, 4, 5, 6, 8])
    frames = {n: spark.createDataFrame(list(zip(*c.values(), strict=True)), ", ".join(f"{k} string" for k in c))
              for n, c in tables.items()}
    got = {(r.table_name, r.constraint_name): r.violations for r in quality.all_foreign_key_violations(frames).collect()}
    assert len(got) == len(quality.FOREIGN_KEYS)
    for child, fk, parent, pk in quality.FOREIGN_KEYS:
        known = set(tables[parent][pk])
        assert got[child, f"{fk} references {parent}"] == sum(k is not None and k not in known for k in tables[child][fk])
    none = {n: df.limit(0) for n, df in frames.items()}
    assert {r.violations for r in quality.all_foreign_key_violations(none).collect()} == {0}


def test_unique_keys_of_all_tables(spark):
    frames = {n: spark.createDataFrame([("a",) * len(k), ("a",) * len(k), ("b",) * len(k), (None,) * len(k)],
                                       ", ".join(f"{c} string" for c in k)) for n, k in quality.UNIQUE.items()}
    assert {r.violations for r in quality.all_unique_violations(frames).collect()} == {1}
    listed = quality.uniqueness_of([(frames["silver.purchase_orders"], "purchase_orders", ["po_id"]),
                                    (frames["silver.shipment_records"].limit(1), "shipment_records", ["shipment_id"])])
    assert {(r.status, json.loads(r.details)["duplicate_count"], tuple(json.loads(r.details)["duplicate_keys"]))
            for r in listed.collect()} == {("FAIL", 1, ("a",)), ("PASS", 0, ())}

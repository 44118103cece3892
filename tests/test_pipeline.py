from __future__ import annotations

import csv
import json
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from siltstone.config import SOURCES, PipelineConfig
from siltstone.operators.upsert import upsert
from siltstone.plans import gold, quality, silver, views
from siltstone.plans.pipeline import run_pipeline
from siltstone.sources.bronze import ingest_all, land
from siltstone.sources.lake import Lake
from siltstone.streaming.incremental import stream_silver

AT = datetime(2026, 3, 1, tzinfo=timezone.utc)

SUPPLIERS = [("SUP-1", "Acme", "Kenya", "", "2024-01-01", "Gold"),
             ("SUP-2", "Acme", "Kenya", "b@x.org", "2024-02-01", "Gold"),
             ("SUP-3", "Brio", "Ghana", "c@x.org", "nope", "Gold")]
MEDICINES = [("MED-1", "Amoxi", "Antibiotic", "box", "365"),
             ("MED-2", "Ibu", "Analgesic", "box", "0")]
ORDERS = [("PO-1", "SUP-1", "MED-1", "2026-01-05", "10", "100.50", "USD"),
          ("PO-2", "SUP-2", "MED-1", "2026-01-06", "20", "200.25", "USD"),
          ("PO-3", "SUP-9999", "MED-1", "2026-01-07", "5", "50", "USD"),
          ("PO-1", "SUP-2", "MED-1", "2026-01-08", "99", "999", "USD")]
SHIPMENTS = [("SHP-1", "PO-1", "WH-1", "2026-02-01", "2026-02-06", "T", "Delivered"),
             ("SHP-2", "PO-2", "WH-2", "2026-02-01", "2026-02-02", "T", "Delivered"),
             ("SHP-3", "PO-2", "WH-1", "2026-02-10", "", "T", "In Transit"),
             ("SHP-4", "PO-3", "WH-1", "2026-02-10", "", "T", "In Transit"),
             ("SHP-5", "PO-1", "WH-1", "2026-02-10", "2026-02-01", "T", "Delivered")]
INVENTORY = [("WH-1", "MED-1", "50", "2026-02-28", "B1"),
             ("WH-1", "MED-1", "500", "2026-04-01", "B2"),
             ("WH-1", "MED-1", "-5", "2026-04-01", "B3"),
             ("WH-1", "MED-1", "70", "2027-04-01", "B2")]
DATA = dict(zip(SOURCES, (SUPPLIERS, MEDICINES, ORDERS, SHIPMENTS, INVENTORY)))


def write_files(folder) -> PipelineConfig:
    specs = []
    for name, spec in SOURCES.items():
        path = folder / f"{name}.{spec.file_format}"
        if spec.file_format == "csv":
            with open(path, "w", newline="") as f:
                w = csv.writer(f)
                w.writerow(spec.columns)
                w.writerows(DATA[name])
        else:
            path.write_text(json.dumps([dict(zip(spec.columns, r)) for r in DATA[name]]))
        specs.append(replace(spec, path=str(path)))
    return PipelineConfig(sources=tuple(specs))


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    config = write_files(folder)
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    return lake, config, run_pipeline(lake, config, AT)


def counts(c):
    return (c.passed, c.quarantined, c.skipped_duplicate)


def test_outcomes(done):
    _, _, run = done
    assert {n: counts(c) for n, c in run.silver.items()} == {
        "supplier_master": (2, 1, 0), "medicine_catalogue": (1, 1, 0),
        "purchase_orders": (2, 1, 1), "shipment_records": (3, 2, 0),
        "warehouse_inventory": (2, 1, 1)}


def test_every_row_is_accounted_for(done):
    lake, config, run = done
    landed = {r.source: r.rows_loaded for r in run.landed.collect()}
    assert landed == {n: sum(counts(c)) for n, c in run.silver.items()}
    assert landed == {n: len(rows) for n, rows in DATA.items()}


def test_first_write_wins(done):
    lake, _, _ = done
    row = lake.read("silver", "purchase_orders").filter("po_id = 'PO-1'").collect()
    assert [(r.supplier_id, r.quantity) for r in row] == [("SUP-1", 10)]


def test_quarantine_keeps_the_whole_row(done):
    lake, _, run = done
    q = {r.target_table + "/" + r.rule_id: r for r in lake.read("silver", "quarantine").collect()}
    assert set(q) == {"supplier_master/VR-10", "medicine_catalogue/VR-03",
                      "purchase_orders/VR-02", "shipment_records/VR-02",
                      "shipment_records/VR-06", "warehouse_inventory/VR-07"}
    assert len({r.quarantine_id for r in q.values()}) == 6
    r = q["purchase_orders/VR-02"]
    data = json.loads(r.row_data)
    assert data["supplier_id"] == "SUP-9999" and data["bronze_id"] == r.bronze_id
    assert data["run_id"] == run.extraction_run_id and r.run_id == run.silver_run_id
    assert data["ingested_at"].startswith("2026-03-01")


def test_star_schema(done):
    lake, config, run = done
    assert run.gold == {"dim_date": 1826, "dim_country": 1, "dim_supplier": 2, "dim_medicine": 1,
                        "dim_warehouse": 2, "fact_shipment": 3}
    f = {r.shipment_id: r for r in lake.read("gold", "fact_shipment").collect()}
    assert [(f[s].delay_days, f[s].is_delayed, f[s].actual_arrival_date_key)
            for s in ("SHP-1", "SHP-2", "SHP-3")] == [
        (5, True, 20260206), (1, False, 20260202), (None, False, None)]


def test_views(done):
    lake, config, _ = done
    rows = views.performance_of(lake).collect()  # the two Acmes merge
    assert [(r.supplier_name, r.total_shipments, r.delayed_shipments, r.delay_rate_pct,
             r.avg_delay_days, float(r.total_procurement_cost)) for r in rows] == [
        ("Acme", 3, 1, 33.3, 3.0, 501.0)]
    details = views.details_of(lake)
    assert len(details.columns) == 21 and details.count() == 3
    expiry = {r.batch_number: (r.days_until_expiry, r.expiry_status) for r in views.expiry_of(
        lake, config, F.lit("2026-03-01").cast("date")).collect()}
    assert expiry == {"B1": (-1, "Expired"), "B2": (31, "At Risk (within 90 days)")}
    assert views.delayed_in_quarter(lake, 2026, 1).count() == 1
    assert views.delayed_in_quarter(lake, 2025, 4).count() == 0


def test_on_time_rate_is_null_over_no_rows(done):
    lake, _, _ = done
    fact = lake.read("gold", "fact_shipment")
    assert views.kpi_totals(fact).first().on_time_delivery_rate == pytest.approx(2 / 3)
    empty = views.kpi_totals(fact.filter("false")).first()
    assert empty.total_shipments == 0 and empty.on_time_delivery_rate is None


def test_checks_and_report(done):
    lake, _, run = done
    assert run.checks.count() == 15
    assert {r.status for r in run.checks.collect()} == {"PASS"}
    text = quality.report(lake, run.quality_run_id)
    assert "Total checks: 15   Passed: 15   Failed: 0" in text
    assert "All quality checks passed. No issues detected." in text
    assert quality.report(lake, "nope") == "No quality check results found for run_id 'nope'."


def test_constraints_hold(done):
    lake, _, _ = done
    rows = quality.verify_constraints(lake).collect()
    assert len(rows) == 79 and all(r.violations == 0 for r in rows)


def test_failing_checks_are_reported(spark, done, tmp_path):
    lake, config, _ = done
    rows = quality.run_checks(lake, config, "late", AT + timedelta(hours=40))
    c = quality.summary(rows).first()
    assert (c.total, c.failed, c.critical, c.warning) == (15, 5, 0, 5)
    text = quality.report(lake, "late")
    assert "\n[FRESHNESS]\n  [WARNING] FRESH-01: " in text and "Warnings: 5" in text
    empty = Lake(spark, str(tmp_path / "empty"))
    c = quality.summary(quality.run_checks(empty, config, "first", AT)).first()
    assert (c.total, c.failed, c.critical) == (15, 10, 10)


def test_rerun_adds_nothing(spark, tmp_path):
    config = write_files(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"))
    run_pipeline(lake, config, AT)
    keys = {r.shipment_id: r.shipment_key for r in lake.read("gold", "fact_shipment").collect()}
    again = run_pipeline(lake, config, AT)
    assert {n: counts(c) for n, c in again.silver.items()} == {
        "supplier_master": (0, 1, 2), "medicine_catalogue": (0, 1, 1),
        "purchase_orders": (0, 1, 4), "shipment_records": (0, 2, 3),
        "warehouse_inventory": (0, 1, 4)}
    assert {r.shipment_id: r.shipment_key
            for r in lake.read("gold", "fact_shipment").collect()} == keys
    # Only the new delivery is read when asked so: old copies are not counted again.
    third = run_pipeline(lake, config, AT, incremental=True)
    assert counts(third.silver["purchase_orders"]) == (0, 1, 3)
    assert lake.read("gold", "fact_shipment").count() == 3
    # With nothing landed since, an incremental load does nothing.
    none = silver.load_all_silver(lake, config, "s4", AT, only_open_runs=True)
    assert {counts(c) for c in none.values()} == {(0, 0, 0)}
    assert quality.verify_constraints(lake).agg(F.sum("violations")).first()[0] == 0


def test_incremental_fact_adds_only_missing_rows(spark, tmp_path):
    config = write_files(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"))
    run_pipeline(lake, config, AT)
    spec = config.sources[3]
    more = spark.createDataFrame(
        [("SHP-9", "PO-1", "WH-7", "2026-02-01", "2026-02-20", "T", "Delivered")],
        ", ".join(f"{c} string" for c in spec.columns))
    land(lake, more, spec, "r9", ingested_at=AT)
    silver.load_silver(lake, spec, "s9", AT, only_open_runs=True)
    assert gold.load_all_gold(lake, config, only_new=True)["fact_shipment"] == 4
    f = lake.read("gold", "fact_shipment").collect()
    assert len({r.shipment_key for r in f}) == 4
    assert {r.shipment_id: r.delay_days for r in f}["SHP-9"] == 19


def test_duplicates_can_be_quarantined(spark, tmp_path):
    config = write_files(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_all(lake, config, "r1", AT)
    c = silver.load_all_silver(lake, config, "s1", AT, on_duplicate="quarantine")
    assert counts(c["purchase_orders"]) == (2, 2, 0)
    q = silver.quarantine_of(lake.read("silver", "quarantine"), "purchase_orders")
    assert {r.rule_id: json.loads(r.row_data)["quantity"] for r in q.collect()} == {
        "VR-02": "5", "VR-09": "99"}
    assert silver.unprocessed(lake, config.sources[2]).count() == 0
    with pytest.raises(ValueError):
        silver.load_silver(lake, config.sources[0], "s2", AT, on_duplicate="drop")


def test_load_resumes_after_dying_between_writes(spark, tmp_path):
    """Silver was written, the quarantine was not: the next load adds just that."""
    config = write_files(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_all(lake, config, "r1", AT)
    real, spec = silver._quarantine, config.sources[0]

    def dies(*args):
        raise RuntimeError("lost")

    silver._quarantine = dies
    try:
        with pytest.raises(RuntimeError):
            silver.load_silver(lake, spec, "s1", AT, only_open_runs=True)
    finally:
        silver._quarantine = real
    assert counts(silver.load_silver(lake, spec, "s1", AT, only_open_runs=True)) == (0, 1, 0)
    assert lake.read("silver", "supplier_master").count() == 2
    assert lake.read("silver", "quarantine").count() == 1


def test_rows_of_a_broken_landing_are_not_loaded(spark, tmp_path):
    config = write_files(tmp_path)
    lake, spec = Lake(spark, str(tmp_path / "lake")), config.sources[0]
    stray = spark.createDataFrame([SUPPLIERS[1]], ", ".join(f"{c} string" for c in spec.columns))
    stray = stray.selectExpr("7L AS bronze_id", "*", "current_timestamp() AS ingested_at",
                             "'f' AS source_file", "'r1' AS run_id")
    lake.put_partition(stray, "bronze", spec.bronze_table, run_id="r1")
    assert counts(silver.load_silver(lake, spec, "s0", AT)) == (0, 0, 0)
    ingest_all(lake, replace(config, sources=(spec,)), "r1", AT)
    assert counts(silver.load_silver(lake, spec, "s1", AT)) == (2, 1, 0)


def test_stream_load_equals_batch_load(spark, tmp_path):
    config = write_files(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_all(lake, config, "r1", AT)
    spec = config.sources[0]
    stream_silver(lake, spec, "s", AT).awaitTermination()
    ingest_all(lake, config, "r2", AT)
    stream_silver(lake, spec, "s", AT).awaitTermination()
    assert lake.read("silver", "supplier_master").count() == 2
    assert lake.read("silver", "quarantine").count() == 2
    log = lake.read("silver", "load_log").agg(
        F.sum("rows_passed"), F.sum("rows_quarantined"), F.sum("rows_skipped_duplicate"))
    assert tuple(log.first()) == (2, 2, 2)


def test_missing_dimension_key_stops_the_load(spark, done):
    lake, config, _ = done
    t = lambda layer, n: lake.read(layer, n)
    rows = gold.fact_rows(
        t("silver", "shipment_records"), t("silver", "purchase_orders"),
        t("silver", "supplier_master"), t("silver", "medicine_catalogue"),
        t("gold", "dim_supplier"), t("gold", "dim_medicine"),
        t("gold", "dim_warehouse").filter("warehouse_id <> 'WH-2'"), t("gold", "dim_country"),
        t("gold", "dim_date"), 3)
    with pytest.raises(Exception, match="dim_warehouse has no key for 'WH-2'"):
        rows.collect()


@pytest.mark.parametrize("role", ["eta", "order_date", "actual_arrival"])
def test_missing_date_stops_the_load(spark, done, role):
    lake, config, _ = done
    t = lambda layer, n: lake.read(layer, n)
    source = "purchase_orders" if role == "order_date" else "shipment_records"
    day = t("silver", source).filter(f"{role} is not null").select(role).first()[0]
    rows = gold.fact_rows(
        t("silver", "shipment_records"), t("silver", "purchase_orders"),
        t("silver", "supplier_master"), t("silver", "medicine_catalogue"),
        t("gold", "dim_supplier"), t("gold", "dim_medicine"), t("gold", "dim_warehouse"),
        t("gold", "dim_country"), t("gold", "dim_date").filter(f"full_date <> '{day}'"), 3)
    with pytest.raises(Exception, match="dim_date has no key"):
        rows.collect()


@pytest.fixture
def own_lake(spark, tmp_path):
    config = write_files(tmp_path)
    lake = Lake(spark, str(tmp_path / "lake"))
    run_pipeline(lake, config, AT)
    return lake, config


def test_merge_rewrites_changed_quarters_only(spark, own_lake):
    lake, config = own_lake
    paths = lambda: set(lake.current_paths("gold", "fact_shipment"))
    fact = lambda: {r.shipment_id: r for r in lake.read("gold", "fact_shipment").collect()}
    rows = lake.read("gold", "fact_shipment").drop("shipment_key")
    may = rows.withColumns({"shipment_id": F.concat(F.lit("M-"), "shipment_id"), "eta_date_key": F.lit(20260505)})
    gold.merge_fact(lake, may)
    before, was = paths(), fact()
    assert len(before) == 2 and len(was) == 6
    gold.merge_fact(lake, rows)  # changes nothing, writes nothing
    assert paths() == before
    gold.merge_fact(lake, rows.where("shipment_id = 'SHP-1'").withColumn("status", F.lit("Closed")))
    now = fact()
    assert {p for p in before if p.endswith("=20262")} <= paths() and len(paths() - before) == 1
    assert {k: v.shipment_key for k, v in now.items()} == {k: v.shipment_key for k, v in was.items()}
    assert {k for k in now if now[k] != was[k]} == {"SHP-1"} and now["SHP-1"].status == "Closed"
    # A new row of a written quarter is a folder of its own, with a key above all others.
    gold.merge_fact(lake, rows.where("shipment_id = 'SHP-2'").withColumn("shipment_id", F.lit("N")))
    assert fact()["N"].shipment_key > max(v.shipment_key for v in was.values())
    assert lake.current_max("gold", "fact_shipment", "shipment_key") == fact()["N"].shipment_key
    total = views.kpi_totals(views.sums_of(lake)).first()
    assert total == views.kpi_totals(lake.read("gold", "fact_shipment")).first() and total.total_shipments == 7


def test_sums_that_are_not_of_the_current_fact_are_not_used(spark, own_lake):
    lake, config = own_lake
    rows = lake.read("gold", "fact_shipment").drop("shipment_key").withColumn("shipment_id", F.concat(F.lit("x"), "shipment_id"))
    real, gold.write_sums = gold.write_sums, lambda *a: None  # a load that dies between the two
    try:
        gold.merge_fact(lake, rows)
    finally:
        gold.write_sums = real
    assert views.kpi_totals(views.sums_of(lake)).first().total_shipments == 6
    gold.merge_fact(lake, rows.withColumn("shipment_id", F.concat(F.lit("y"), "shipment_id")))
    assert lake.note("gold", "fact_summary", "fact") == lake.snapshot("gold", "fact_shipment")
    assert views.kpi_totals(views.sums_of(lake)).first().total_shipments == 9


def test_calendar_years_come_from_the_log_or_the_rows(spark, own_lake):
    lake, config = own_lake
    config = replace(config, calendar_start_year=2026, calendar_end_year=2026)
    years = lambda: tuple(gold.calendar_years(lake, config).first())
    assert years() == (2026, 2026)
    row = lake.read("silver", "shipment_records").limit(1).withColumns(
        {"shipment_id": F.lit("late"), "eta": F.lit("2031-05-01").cast("date")})
    lake.append(row, "silver", "shipment_records")  # and its load was never logged
    assert years() == (2026, 2031)


@pytest.mark.parametrize("year, days", [(2025, 365), (2024, 366)])
def test_calendar(spark, year, days):
    rows = {r.date_key: r for r in gold.calendar(years(spark, year, year)).collect()}
    assert len(rows) == days and min(rows) == year * 10000 + 101 and max(rows) == year * 10000 + 1231
    assert [rows[year * 10000 + k].quarter for k in (331, 401, 1231)] == [1, 2, 4]
    if year == 2025:
        sat, mon = rows[20250104], rows[20250106]
        assert (sat.is_weekend, sat.day_name, sat.day_of_week) == (True, "Saturday", 5)
        assert (mon.is_weekend, mon.day_name, mon.day_of_week) == (False, "Monday", 0)
        assert mon.month_name == "January"


def test_calendar_has_no_limit(spark):
    assert gold.calendar(years(spark, 1000, 2999)).count() == 730_485


def years(spark, first, last):
    return spark.createDataFrame([(first, last)], "first_year int, last_year int")


def test_upsert_whitelist(spark):
    old = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2)],
                                "sk long, k string, s string, n int")
    new = spark.createDataFrame([("b", None, 9), ("c", "z", 3)], "k string, s string, n int")
    got = {r.k: (r.s, r.n) for r in upsert(old, new, "k", "sk", ["s"], 2).collect()}
    assert got == {"a": ("x", 1), "b": (None, 2), "c": ("z", 3)}
    keys = {r.k: r.sk for r in upsert(old, new, "k", "sk", ["s", "n"], 2).collect()}
    assert keys["a"] == 1 and keys["b"] == 2 and keys["c"] >= 2**33


def test_joined_fact_rows_are_written_before_they_are_laid_out(spark, done, tmp_path):
    """The joins' shuffle files are gone before the ranges are dealt; nothing of it stays."""
    _, config, run = done
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_all(lake, config, "r1", AT)
    silver.load_all_silver(lake, config, "s1", AT)
    staged, stage = {}, lake.stage

    def kept(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    lake.stage, laid, by_eta = kept, [], gold.by_eta
    gold.by_eta = lambda rows: laid.append(rows.inputFiles()) or by_eta(rows)
    try:
        assert gold.load_all_gold(lake, config) == run.gold
    finally:
        gold.by_eta = by_eta
    assert "fact_rows" in staged and all("/_staging/fact_rows/" in f for f in laid[0]) and laid[0]
    assert not (tmp_path / "lake/_staging/fact_rows").exists()

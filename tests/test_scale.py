"""Plan shapes, hot keys, and agreement with SQL over the provided tables."""

from __future__ import annotations

import json
import re
import time
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from siltstone.config import SOURCES
from siltstone.operators.dedup import first_per_key, insert_if_absent
from siltstone.operators.membership import flag_listed, orphan_keys, orphan_keys_of, orphan_rows
from siltstone.plans import gold, quality, silver, views
from siltstone.plans.workspace import Workspace
from siltstone.queries import QUERIES
from siltstone.sources.bronze import land
from siltstone.sources.lake import Lake

SF = "/root/testdata/sf0.001"
AT = datetime(2026, 3, 1, tzinfo=timezone.utc)
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="provided tables are absent")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|Single|range|Round)", plan(df)))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def hot(spark, rows=300_000):
    """A third of all rows share one key."""
    return spark.range(rows).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50000) END AS k",
        "id AS bronze_id", "cast(id % 7 as string) AS v")


def test_dedup_limits_each_key_before_the_shuffle(spark, no_broadcast):
    df = first_per_key(hot(spark), ["k"], ["bronze_id"])
    text = plan(df)
    exchange = text.index("Exchange hashpartitioning")
    assert text.index("WindowGroupLimit") < exchange < text.rindex("WindowGroupLimit")
    got = {r.k: r.bronze_id for r in df.collect()}
    want = {r.k: r.m for r in hot(spark).groupBy("k").agg(F.min("bronze_id").alias("m")).collect()}
    assert got == want and got["hot"] == 0


def test_insert_if_absent_shuffles_each_side_once(spark, no_broadcast):
    target = hot(spark).select("k").distinct().limit(100)
    df = insert_if_absent(hot(spark), spark.range(10).selectExpr("concat('k', id) AS k"),
                          ["k"], ["bronze_id"])
    assert shuffles(df) == 2
    assert insert_if_absent(hot(spark), target, ["k"], ["bronze_id"]).count() == (
        hot(spark).select("k").distinct().count() - 100)


def test_orphan_keys_move_once_per_task(spark, no_broadcast):
    parents = spark.range(1, 50000, 2).selectExpr("concat('k', id) AS id")
    lost = orphan_keys(hot(spark).select("k"), parents, "id")
    before = plan(lost).split("Exchange hashpartitioning")[1]
    assert "HashAggregate" in before  # distinct in the map tasks
    counted = orphan_rows(hot(spark), ["k"], parents, ["id"])
    by_key = {r.k: r.row_count for r in counted.collect()}
    assert by_key["hot"] == 100_000 and set(by_key) == {r.k for r in lost.collect()}


def test_null_keys_are_not_orphans(spark):
    parents = spark.createDataFrame([("a",)], "id string")
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = flag_listed(rows, "k", orphan_keys(rows, parents, "id"), "lost")
    assert {r.k: r.lost for r in got.collect()} == {"a": False, "b": True, None: False}


def test_silver_load_with_large_parents(spark, tmp_path):
    """One supplier on a third of all orders and one missing supplier on another."""
    sup, med, po = (SOURCES[n] for n in ("supplier_master", "medicine_catalogue",
                                         "purchase_orders"))
    suppliers = spark.range(200).selectExpr(
        "concat('S', id) supplier_id", "'n' supplier_name", "'c' country", "'' contact_email",
        "'2024-01-01' contract_start_date", "'t' performance_tier")
    medicines = spark.range(5).selectExpr(
        "concat('M', id) medicine_id", "'n' medicine_name", "'c' category", "'u' unit_of_measure",
        "'30' shelf_life_days")
    orders = spark.range(6000).selectExpr(
        "concat('P', id % 5000) po_id",
        "CASE id % 3 WHEN 0 THEN ' S1 ' WHEN 1 THEN 'GONE' ELSE concat('S', id % 200) END "
        "supplier_id", "concat('M', id % 6) medicine_id", "'2026-01-01' order_date",
        "'5' quantity", "'1.5' total_cost", "'USD' currency")
    lake = Lake(spark, str(tmp_path / "lake"))
    for spec, df in ((sup, suppliers), (med, medicines), (po, orders)):
        land(lake, df, spec, "r1", ingested_at=AT)
        counts = silver.load_silver(lake, spec, "s1", AT)
    by_rule = {r.rule_description: r["count"] for r in lake.read("silver", "quarantine").groupBy(
        "rule_description").count().collect()}
    assert by_rule["supplier_id 'GONE' does not exist in silver.supplier_master"] == 2000
    assert counts.passed + counts.quarantined + counts.skipped_duplicate == 6000


def test_new_delivery_is_not_joined_with_history(spark, tmp_path):
    spec = SOURCES["supplier_master"]
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(50).selectExpr(
        "concat('S', id) supplier_id", "'n' supplier_name", "'c' country", "'' contact_email",
        "'2024-01-01' contract_start_date", "'t' performance_tier")
    land(lake, rows, spec, "r1", ingested_at=AT)
    silver.load_silver(lake, spec, "s1", AT)
    land(lake, rows, spec, "r2", ingested_at=AT)
    runs, first = silver.open_runs(lake, spec)
    assert runs == ["r2"]
    todo = silver.unprocessed(lake, spec, silver.delivered(lake, spec, runs), first)
    assert "Join" not in plan(todo) and todo.count() == 50
    assert "run_id#" in re.search(r"PartitionFilters: \[[^\]]*", plan(todo)).group(0)


def test_hot_order_is_split_in_the_fact_join(spark, no_broadcast):
    """A third of all shipments belong to one order; adaptive execution splits it."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    shipments = spark.range(60_000).repartition(8).selectExpr(
        "concat('H', id) shipment_id",
        "CASE WHEN id % 3 = 0 THEN 'P0' ELSE concat('P', id % 5000) END po_id",
        "concat('W', id % 3) warehouse_id", "date'2026-02-01' eta",
        "date'2026-02-09' actual_arrival", "'ok' status")
    orders = spark.range(5000).selectExpr(
        "concat('P', id) po_id", "concat('S', id % 9) supplier_id", "'M' medicine_id",
        "date'2026-01-01' order_date", "5 quantity", "cast(1 as decimal(12,2)) total_cost",
        "'USD' currency")
    sup = spark.range(9).selectExpr("concat('S', id) supplier_id", "'KE' country",
                                    "id supplier_key")
    med = spark.range(1).selectExpr("'M' medicine_id", "id medicine_key")
    rows = gold.fact_rows(
        shipments, orders, sup, med, sup, med,
        spark.range(3).selectExpr("concat('W', id) warehouse_id", "id warehouse_key"),
        spark.range(1).selectExpr("'KE' country_name", "id country_key"),
        spark.createDataFrame(
            [("2026-01-01", 1), ("2026-02-01", 2), ("2026-02-09", 3)], "d string, date_key int"
        ).selectExpr("cast(d as date) full_date", "date_key").hint("broadcast"), 3)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = rows.agg(F.count(F.lit(1)), F.count_if("is_delayed"))
        assert tuple(got.first()) == (60_000, 60_000)
        rows.write.format("noop").mode("overwrite").save()
        rows.collect()
        assert "skew=true" in plan(rows)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_orphans_of_several_references_in_one_pass(spark, no_broadcast):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "y"), ("a", "z")], "p string, q string")
    one, two = (spark.createDataFrame([(v,) for v in known], "id string") for known in (["a"], ["x", "b"]))
    lost = orphan_keys_of(rows, {"p": F.col("p"), "q": F.col("q")}, {"p": (one, "id"), "q": (two, "id")})
    assert plan(lost).count("Scan ExistingRDD") == 3  # the rows once, each parent once
    assert {tuple(r) for r in lost.collect()} == {("p", "b"), ("q", "y"), ("q", "z")}


def test_a_busy_day_is_split_in_the_fact_layout(spark):
    """A third of all shipments on one eta: no task gets more than twice the median."""
    rows = spark.range(90_000).selectExpr(
        "concat('S', id) shipment_id", "IF(id % 3 = 0, 19970415, 19950101 + cast(id % 28 as int)) eta_date_key")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in gold.by_eta(rows).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 30 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_a_delivery_meets_bucketed_history_without_moving_it(spark, tmp_path, no_broadcast):
    spec = SOURCES["purchase_orders"]
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.bucket_by("silver", spec.silver_table, ["po_id"])
    rows = lambda lo, hi: spark.range(lo, hi).selectExpr(
        "concat('P', id) po_id", "'S' supplier_id", "'M' medicine_id", "date'2026-01-01' order_date", "1 quantity",
        "cast(1 as decimal(12,2)) total_cost", "'USD' currency", "id bronze_id", "timestamp'2026-01-01' validated_at")
    lake.append(rows(0, 5000), "silver", spec.silver_table)
    new = insert_if_absent(rows(4000, 6000), lake.read_bucketed("silver", spec.silver_table), ["po_id"], ["bronze_id"])
    assert shuffles(new) == 1 and "Bucketed: true" in plan(new)
    assert {r.po_id for r in new.select("po_id").collect()} == {f"P{i}" for i in range(5000, 6000)}
    lake.append(new, "silver", spec.silver_table)
    # Another application knows the buckets from the table's folder; a plain scan sees all rows.
    again = Lake(spark, str(tmp_path / "lake"))
    assert again.buckets("silver", spec.silver_table) == 8
    assert again.read("silver", spec.silver_table).count() == again.read_bucketed("silver", spec.silver_table).count() == 6000


@needs_data
def test_dashboards_do_not_scan_the_fact(spark):
    w = Workspace.of(spark, SF)
    w.star()
    for df in (views.performance_of(w.lake), views.kpi_totals(views.sums_of(w.lake)),
               views.volume_by_month(views.sums_of(w.lake))):
        assert "n:bigint" in plan(df) and not re.search("shipment_id|is_delayed|eta_date_key", plan(df))


@needs_data
def test_foreign_keys_scan_each_table_once(spark):
    w = Workspace.of(spark, SF)
    w.star()
    w.all_silver()
    text = plan(quality.verify_constraints(w.lake, ("fk",)))
    tables = {n for f in quality.FOREIGN_KEYS for n in (f[0], f[2])}
    assert text.count("FileScan parquet") == len(tables)


@needs_data
def test_scorecard_aggregates_before_joining(spark, no_broadcast):
    w = Workspace.of(spark, SF)
    w.star()
    text = plan(views.performance_of(w.lake))
    joins = [m.start() for m in re.finditer("SortMergeJoin", text)]
    first_agg = text.index("keys=[supplier_key")
    assert joins and max(joins) < first_agg  # the plan prints the last step first
    scan = text[text.index("FileScan"):]
    assert "shipment_id" not in scan.split("\n")[0]


@needs_data
def test_quarter_filter_reaches_the_scan(spark):
    w = Workspace.of(spark, SF)
    w.star()
    text = plan(views.delayed_in_quarter(w.lake, 1997, 2))
    pushed = [p for p in re.findall(r"PushedFilters: \[[^\]]*\]?", text) if "eta_date_key" in p]
    assert pushed and "19970401" in text


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


@needs_data
def test_queries_agree_with_sql_and_stay_in_the_jvm(spark):
    import __spark_entry__ as entry

    con, sqls, queries = connect(SF), entry.oracle_sql(), entry.queries()
    assert set(QUERIES) <= set(sqls) <= set(queries)  # all of the library's own have SQL
    found = {}
    for name, sql in sqls.items():
        seen = []
        diff = compare(spark, con, SF, lambda s, d: seen.append(queries[name](s, d)) or seen[0], sql)
        bad = [b for b in FORBIDDEN if name in QUERIES and b in plan(seen[0])]
        if diff or bad:
            found[name] = (diff, bad)
    assert found == {}


@needs_data
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


def _orders(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SOURCES["purchase_orders"].columns))


def test_rows_landed_after_the_last_outcome_are_not_shuffled(spark, tmp_path, no_broadcast):
    """A full load joins with earlier outcomes only the rows that may have one."""
    spec = SOURCES["supplier_master"]
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(50).selectExpr(
        "concat('S', id % 40) supplier_id", "'n' supplier_name", "'c' country", "'' contact_email",
        "IF(id < 5, 'nope', '2024-01-01') contract_start_date", "'t' performance_tier")
    land(lake, rows, spec, "r1", ingested_at=AT)
    silver.load_silver(lake, spec, "s1", AT)
    land(lake, rows, spec, "r2", ingested_at=AT)
    bronze = lake.read("bronze", spec.bronze_table, spec.bronze_schema)
    todo = silver.unprocessed(lake, spec, bronze)
    later = plan(todo).split("Union")[1:]
    assert later and "Join" not in later[0].split("SortMergeJoin")[-1] and plan(todo).count("LeftAnti") == 1
    got = {r.run_id: r["count"] for r in todo.groupBy("run_id").count().collect()}
    assert got == {"r1": 50 - 40 - 5, "r2": 50}  # the copies of the first run, the second whole
    odd = bronze.withColumn("bronze_id", F.lit(None).cast("long"))
    assert silver.unprocessed(lake, spec, odd).count() == 100


def test_staged_text_is_written_once_and_comes_back_as_delivered(spark, tmp_path):
    """Copies are ordered by their text as delivered, and the quarantine keeps that text, although the
    load writes down the text of a value only where the value does not spell it."""
    spec = replace(SOURCES["purchase_orders"], first_by=(*SOURCES["purchase_orders"].columns, "bronze_id"), references=())
    lake = Lake(spark, str(tmp_path / "lake"))
    same = ("S", "M", "2026-01-05")
    rows = [(" P1 ", *same, "07", "1.5", "USD"), ("P1", *same, "7", "1.50", " USD "), ("P2", *same, "1_0", "2", " K "),
            ("P3", "S", "M", "2026-1-5", "3", "4.00", "USD"), ("P4", *same, "x", "1.00", "USD"),
            ("P4", *same, "5", None, "USD")]
    land(lake, _orders(spark, rows), spec, "r1", ingested_at=AT)
    staged, stage = [], lake.stage
    lake.stage = lambda df, name: staged.append(stage(df, name)) or staged[-1]
    kept, unstage = [], lake.unstage
    lake.unstage = lambda name: kept.extend(
        r.asDict() for r in (staged[-1].collect() if staged else [])) or staged.clear() or unstage(name)
    flags = {f"_orphan_{c}": F.lit(False) for c in ("supplier_id", "medicine_id")}
    orphans, silver.flag_orphans = silver.flag_orphans, lambda lake, df, *rest: df.withColumns(flags)
    try:
        counts = silver.load_silver(lake, spec, "s1", AT, on_duplicate="quarantine")
    finally:
        silver.flag_orphans = orphans
    assert (counts.passed, counts.quarantined) == (3, 3)
    assert {r["po_id"]: (r["quantity"], r["total_cost"], r["order_date"]) for r in kept if r["_failed"] is None} == {
        " P1 ": ("07", "1.5", None), "P1": (None, None, None), "P2": ("1_0", "2", None), "P3": (None, None, "2026-1-5")}
    got = {r.po_id: (r.quantity, str(r.total_cost), r.currency, str(r.order_date)) for r in lake.read("silver", "purchase_orders").collect()}
    assert got == {"P1": (7, "1.50", "USD", "2026-01-05"), "P2": (10, "2.00", "K", "2026-01-05"),
                   "P3": (3, "4.00", "USD", "2026-01-05")}
    told = {(r.rule_id, *[json.loads(r.row_data)[c] for c in spec.columns]) for r in lake.read("silver", "quarantine").collect()}
    assert told == {("VR-09", *rows[1]), ("VR-03", *rows[4]), ("VR-10", *rows[5])}


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if re.search(r"shuffle_\d+_\d+_\d+\.data$", f)}


def test_a_write_leaves_only_what_it_writes(spark, tmp_path, no_broadcast):
    """Shuffle files of staged, appended, bucketed and replaced tables go with the write, the files
    are small, and the session's settings are as before."""
    spec, lake = SOURCES["purchase_orders"], Lake(spark, str(tmp_path / "lake"))
    mine = ("spark.sql.parquet.compression.codec", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.range(3000).selectExpr(
        "concat('P', id) po_id", "'S' supplier_id", "'M' medicine_id", "date'2026-01-01' order_date", "1 quantity",
        "cast(1 as decimal(12,2)) total_cost", "'USD' currency", "id bronze_id", "timestamp'2026-01-01' validated_at")
    lake.bucket_by("silver", spec.silver_table, ["po_id"])
    old = _shuffle_files(spark)
    moved = lambda: rows.repartition(4, "po_id")
    some = lake.stage(moved(), "some")
    lake.append(moved(), "silver", spec.silver_table)
    lake.put_partition(moved().withColumn("run_id", F.lit("r")), "bronze", "purchase_orders_raw", run_id="r")
    lake.replace(moved().select(F.col("bronze_id").alias("country_key"), F.col("po_id").alias("country_name"),
                                F.lit("t").alias("risk_tier")), "gold", "dim_country", key="country_key")
    until = time.monotonic() + 20  # executors remove them in the background
    while (left := _shuffle_files(spark) - old) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left and some.count() == 3000
    files = [p.name for p in (tmp_path / "lake").rglob("*.parquet")]
    assert files and all(".zstd." in f for f in files)
    assert [spark.conf.get(k, None) for k in mine] == [None, None]
    spark.conf.set(mine[0], "gzip")  # a session's own choice holds
    try:
        lake.stage(rows, "other")
    finally:
        spark.conf.unset(mine[0])
    assert all(".gz." in p.name for p in (tmp_path / "lake/_staging/other").glob("part-*"))

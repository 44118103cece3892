"""Checks over the loaded layers. Each check is a lazy one-row frame, so a whole
run is one union written in one job."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.config import CHECK_RESULTS_SCHEMA, SILVER_SCHEMAS, PipelineConfig, SourceSpec
from siltstone.functions.metrics import (
    hours_since,
    row_count_deviation_pct,
    within_deviation_tolerance,
    within_freshness_window,
)
from siltstone.operators.dedup import duplicate_keys
from siltstone.operators.keys import next_base, with_sequence
from siltstone.operators.membership import orphan_rows
from siltstone.sources.bronze import landing_log
from siltstone.sources.lake import Lake

LISTED_KEYS = 10


def _outcome(ok: Column, severity: str) -> tuple[Column, Column]:
    status = F.when(ok, "PASS").otherwise("FAIL").alias("status")
    return status, F.when(ok, "INFO").otherwise(severity).alias("severity")


def _json(*fields: Column, keep_nulls: bool = False) -> Column:
    return F.to_json(
        F.struct(*fields), {"ignoreNullFields": "false"} if keep_nulls else None)


def _number(x: float) -> str:
    return f"{x:g}"


# -- freshness ---------------------------------------------------------------


def freshness(
    bronze: DataFrame, source: str, bronze_table: str, as_of: Column, max_age_hours: float
) -> DataFrame:
    """FRESH-01: the newest row is no older than the limit."""
    newest = bronze.agg(F.max("ingested_at").alias("at"))
    return _freshness_rows(
        newest.select(F.lit(source).alias("source"), F.lit(bronze_table).alias("bronze_table"), "at"),
        as_of, max_age_hours)


def _freshness_rows(newest: DataFrame, as_of: Column, max_age_hours: float) -> DataFrame:
    """The check's row for each source, bronze_table and its newest time (NULL if none)."""
    hours, src = F.col("hours"), F.col("source")
    never, fresh = hours.isNull(), within_freshness_window(hours, max_age_hours)
    return newest.withColumn("hours", hours_since(F.col("at"), as_of)).select(
        F.lit("freshness").alias("check_category"),
        F.lit("FRESH-01").alias("check_id"),
        F.when(never, F.concat(src, F.lit(" has never been ingested")))
        .otherwise(F.concat(src, F.lit(f" ingested within {_number(max_age_hours)}h window")))
        .alias("description"),
        F.when(fresh, "PASS").otherwise("FAIL").alias("status"),
        F.when(never, "CRITICAL").when(fresh, "INFO").otherwise("WARNING").alias("severity"),
        F.when(never, _json(src, F.col("bronze_table")))
        .otherwise(
            _json(
                src,
                hours.alias("hours_since_last_ingest"),
                F.lit(max_age_hours).alias("threshold_hours"),
            )
        )
        .alias("details"),
    )


# -- completeness ------------------------------------------------------------


def run_counts(bronze: DataFrame) -> DataFrame:
    """Rows and newest landing time per run, of Bronze rows or of their landing log."""
    logged = "rows_loaded" in bronze.columns
    rows = F.sum("rows_loaded") if logged else F.count(F.lit(1))
    return (
        bronze.filter(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(rows.alias("run_count"), F.max("ingested_at").alias("last_at"))
    )


def latest_run(bronze: DataFrame) -> DataFrame:
    """The run with the newest row (no sort; ties go to the greater run id), NULL
    for an empty table."""
    newest = F.struct("ingested_at", "run_id")
    return bronze.filter(F.col("run_id").isNotNull()).agg(
        F.max_by("run_id", newest).alias("run_id"))


def rows_in_run(bronze: DataFrame, run_id: str) -> DataFrame:
    return bronze.filter(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("row_count"))


def average_of_other_runs(
    bronze: DataFrame, run_id: str, since: Column | None = None
) -> DataFrame:
    """Mean rows per run, the given run left out; ``since`` limits it to runs whose
    newest row is not older (a trailing window)."""
    runs = run_counts(bronze).filter(F.col("run_id") != run_id)
    if since is not None:
        runs = runs.filter(F.col("last_at") >= since)
    return runs.agg(F.avg("run_count").alias("historical_avg"))


def row_count_deviation(
    bronze: DataFrame,
    source: str,
    threshold_pct: float,
    target_run_id: str | None = None,
    since: Column | None = None,
) -> DataFrame:
    """COMPLETE-01: one run's row count against the mean of all other runs.

    Without ``target_run_id`` the newest run is judged; one scan gives it, its
    count and the history.
    """
    runs = run_counts(bronze)
    if target_run_id is None:
        return _deviation_rows(
            runs.agg(*_newest_and_history(since)).withColumn("source", F.lit(source)),
            *_newest_against_history(since), threshold_pct)
    else:
        other = F.col("run_id") != target_run_id
        if since is not None:
            other = other & (F.col("last_at") >= since)
        picked = runs.agg(
            F.lit(target_run_id).alias("run"),
            F.coalesce(
                F.sum(F.when(F.col("run_id") == target_run_id, F.col("run_count"))), F.lit(0)
            ).alias("today"),
            F.count_if(other).alias("n"),
            F.coalesce(F.sum(F.when(other, F.col("run_count"))), F.lit(0)).alias("total"),
        )
        run, today, others, rest = F.col("run"), F.col("today"), F.col("n"), F.col("total")
    return _deviation_rows(picked.withColumn("source", F.lit(source)), run, today, others, rest, threshold_pct)


def _newest_and_history(since: Column | None) -> list[Column]:
    newest = F.struct("last_at", "run_id")
    return [F.max_by(F.struct("run_id", "run_count"), newest).alias("t"), *_history(since)]


def _newest_against_history(since: Column | None) -> tuple[Column, Column, Column, Column]:
    """The newest run, its count, and the number and sum of the other runs."""
    run, today = F.col("t.run_id"), F.coalesce(F.col("t.run_count"), F.lit(0))
    in_history = run.isNotNull() & _in_window(F.col("newest_at"), since)
    return (run, today, F.coalesce(F.col("n"), F.lit(0)) - F.when(in_history, 1).otherwise(0),
            F.coalesce(F.col("total"), F.lit(0)) - F.when(in_history, today).otherwise(0))


def _deviation_rows(
    picked: DataFrame, run: Column, today: Column, others: Column, rest: Column, threshold_pct: float
) -> DataFrame:
    """The check's row for each source and its run."""
    base = picked.select(
        "source",
        run.alias("run"),
        today.cast("bigint").alias("today_count"),
        F.try_divide(rest.cast("double"), others.cast("double")).alias("historical_avg"),
    )
    today, avg = F.col("today_count"), F.col("historical_avg")
    deviation = row_count_deviation_pct(today, avg)
    never, no_history = F.col("run").isNull(), avg.isNull() | (avg == 0)
    ok = no_history | within_deviation_tolerance(deviation, threshold_pct)
    src = F.col("source")
    return base.select(
        F.lit("completeness").alias("check_category"),
        F.lit("COMPLETE-01").alias("check_id"),
        F.when(never, F.concat(src, F.lit(" row count deviation (no ingestion history)")))
        .when(no_history, F.concat(src, F.lit(" row count deviation (insufficient history)")))
        .otherwise(F.concat(
            src, F.lit(f" row count within {_number(threshold_pct)}% of trailing average")))
        .alias("description"),
        F.when(never, "FAIL").when(ok, "PASS").otherwise("FAIL").alias("status"),
        F.when(never, "CRITICAL").when(ok, "INFO").otherwise("WARNING").alias("severity"),
        F.when(never, _json(src))
        .when(
            no_history,
            _json(src, today, F.lit(None).cast("double").alias("historical_avg"),
                  keep_nulls=True),
        )
        .otherwise(
            _json(
                src,
                today,
                F.round(avg, 1).alias("historical_avg"),
                F.round(deviation, 1).alias("deviation_pct"),
                F.lit(threshold_pct).alias("threshold_pct"),
            )
        )
        .alias("details"),
    )


def _in_window(at: Column, since: Column | None) -> Column:
    return F.lit(True) if since is None else F.coalesce(at >= since, F.lit(False))


def _history(since: Column | None) -> list[Column]:
    inside = _in_window(F.col("last_at"), since)
    return [
        F.max("last_at").alias("newest_at"),
        F.count_if(inside).alias("n"),
        F.coalesce(F.sum(F.when(inside, F.col("run_count"))), F.lit(0)).alias("total"),
    ]


# -- uniqueness --------------------------------------------------------------


def uniqueness(table: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """UNIQUE-01: no natural key occurs twice. Lists the first ten that do."""
    return uniqueness_of([(table, name, keys)])


def uniqueness_of(tables: list[tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """UNIQUE-01 of several tables: their keys are counted by one shuffle, tagged by table."""
    dups = _repeated_keys([(df, i, keys) for i, (df, _, keys) in enumerate(tables)])
    first = Window.partitionBy("tag").orderBy("label")
    listed = dups.select("tag", F.concat_ws("|", "key").alias("label")).withColumn(
        "place", F.row_number().over(first)).where(F.col("place") <= LISTED_KEYS)
    listed = listed.groupBy("tag").agg(F.sort_array(F.collect_list("label")).alias("keys"))
    counted = dups.groupBy("tag").agg(F.count(F.lit(1)).alias("found"))
    rows = _constants(tables[0][0].sparkSession, [
        (i, name, "+".join(keys)) for i, (_, name, keys) in enumerate(tables)], "tag int, name string, columns string")
    one = rows.join(counted, "tag", "left").join(listed, "tag", "left").withColumns({
        "n": F.coalesce("found", F.lit(0).cast("long")),
        "keys": F.coalesce("keys", F.array().cast("array<string>"))})
    status, severity = _outcome(F.col("n") == 0, "CRITICAL")
    return one.select(
        F.lit("uniqueness").alias("check_category"),
        F.lit("UNIQUE-01").alias("check_id"),
        F.concat(F.lit("silver."), "name", F.lit("."), "columns", F.lit(" has no duplicate natural keys")).alias(
            "description"),
        status,
        severity,
        _json(
            F.col("name").alias("table"),
            F.col("n").alias("duplicate_count"),
            F.col("keys").alias("duplicate_keys"),
        ).alias("details"),
    )


def _repeated_keys(tables: list[tuple[DataFrame, int, list[str]]]) -> DataFrame:
    """tag, key (its columns as text) and how often it occurs, of the keys that occur twice or more."""
    tagged = [df.select(F.lit(tag).alias("tag"), F.array(*[F.col(k).cast("string") for k in keys]).alias("key"))
              for df, tag, keys in tables]
    return duplicate_keys(reduce(DataFrame.unionByName, tagged), ["tag", "key"])


def _constants(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as part of the plan."""
    names = [c.split()[0] for c in schema.split(", ")]
    values = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names, strict=True)]) for r in rows])
    return spark.range(1).select(F.inline(values))


# -- consistency -------------------------------------------------------------


def shipment_consistency(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """CONSIST-01: as many shipments in Gold as in Silver."""
    s = silver.agg(F.count(F.lit(1)).alias("s")).select("s", F.lit(0).alias("g"))
    g = gold.agg(F.count(F.lit(1)).alias("g")).select(F.lit(0).alias("s"), "g")
    both = s.unionByName(g).agg(F.sum("s").alias("s"), F.sum("g").alias("g"))
    status, severity = _outcome(F.col("s") == F.col("g"), "CRITICAL")
    return both.select(
        F.lit("consistency").alias("check_category"),
        F.lit("CONSIST-01").alias("check_id"),
        F.lit("silver.shipment_records count matches gold.fact_shipment count").alias(
            "description"),
        status,
        severity,
        _json(
            F.col("s").alias("silver_shipment_count"),
            F.col("g").alias("gold_fact_shipment_count"),
            (F.col("s") - F.col("g")).alias("difference"),
        ).alias("details"),
    )


# -- the whole suite -----------------------------------------------------------


def all_checks(
    lake: Lake,
    config: PipelineConfig,
    as_of: Column,
    composite_keys: bool = False,
    scan_bronze: bool = False,
) -> DataFrame:
    """Freshness and completeness per source, uniqueness per single-key table
    (``composite_keys`` adds the others), and Silver/Gold consistency.

    The first two are answered from the landing log, which knows every completed
    landing; ``scan_bronze`` counts the Bronze rows themselves (an audit).
    """
    checks: list[DataFrame] = []
    if scan_bronze:
        for s in config.sources:
            bronze = lake.read("bronze", s.bronze_table, s.bronze_schema)
            checks.append(
                freshness(bronze, s.name, s.bronze_table, as_of, config.freshness_max_age_hours))
            checks.append(
                row_count_deviation(bronze, s.name, config.row_count_deviation_threshold_pct))
    else:
        checks += _log_checks(lake, config, as_of)
    tables = [(lake.read("silver", s.silver_table), s.silver_table, list(s.natural_key))
              for s in config.sources
              if s.silver_table in SILVER_SCHEMAS and (len(s.natural_key) == 1 or composite_keys)]
    if tables:
        checks.append(uniqueness_of(tables))
    checks.append(
        shipment_consistency(
            lake.read("silver", "shipment_records"), lake.read("gold", "fact_shipment")))
    return reduce(DataFrame.unionByName, checks)


def _log_checks(lake: Lake, config: PipelineConfig, as_of: Column) -> list[DataFrame]:
    """Freshness and completeness of all sources, each by one aggregate of the landing log."""
    sources = _constants(lake.spark, [(s.name, s.bronze_table) for s in config.sources],
                         "source string, bronze_table string")
    log = lake.read("bronze", "load_log").filter("rows_loaded > 0").drop("source")
    at = log.groupBy("bronze_table").agg(F.max("ingested_at").alias("at"))
    runs = log.filter(F.col("run_id").isNotNull()).groupBy("bronze_table", "run_id").agg(
        F.sum("rows_loaded").alias("run_count"), F.max("ingested_at").alias("last_at"))
    picked = runs.groupBy("bronze_table").agg(*_newest_and_history(None))
    return [
        _freshness_rows(sources.join(at, "bronze_table", "left"), as_of, config.freshness_max_age_hours),
        _deviation_rows(sources.join(picked, "bronze_table", "left"), *_newest_against_history(None),
                        config.row_count_deviation_threshold_pct),
    ]


def run_checks(
    lake: Lake,
    config: PipelineConfig,
    run_id: str,
    as_of: datetime | None = None,
    composite_keys: bool = False,
) -> DataFrame:
    """Run the suite, append its rows under ``run_id`` and return them."""
    at = as_of or datetime.now(timezone.utc)
    now = F.lit(at).cast("timestamp")
    rows = all_checks(lake, config, now, composite_keys).withColumns(
        {"run_id": F.lit(run_id), "checked_at": now})
    top = lake.current_max("quality", "check_results", "check_result_id")
    columns = lake.read("quality", "check_results").columns
    rows = with_sequence(rows.coalesce(1), "check_result_id", next_base(top)).select(*columns)
    lake.append(rows, "quality", "check_results")
    return results_of(lake, run_id)


def results_of(lake: Lake, run_id: str) -> DataFrame:
    return lake.read("quality", "check_results", CHECK_RESULTS_SCHEMA).filter(
        F.col("run_id") == run_id)


# -- questions asked of the results -------------------------------------------


def summary(results: DataFrame) -> DataFrame:
    failed = F.col("status") == "FAIL"
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") != "PASS").alias("failed"),
        F.count_if(failed & (F.col("severity") == "CRITICAL")).alias("critical"),
        F.count_if(failed & (F.col("severity") == "WARNING")).alias("warning"),
    )


def failures(results: DataFrame) -> DataFrame:
    return (
        results.filter(F.col("status") == "FAIL")
        .select(
            F.upper("check_category").alias("category"),
            "check_id",
            "severity",
            "description",
            "details",
        )
        .orderBy("category", "check_id", "description")
    )


def trend(results: DataFrame, check_id: str, as_of: Column, days: int = 30) -> DataFrame:
    """Outcomes of one check per day over the trailing days."""
    day = F.to_date("checked_at")
    return (
        results.filter((F.col("check_id") == check_id) & (day > F.date_sub(as_of, days)))
        .groupBy(day.alias("checked_on"), "status")
        .agg(F.count(F.lit(1)).alias("check_count"))
    )


def report(lake: Lake, run_id: str) -> str:
    """Plain-text report of one run; an unknown run gives a message. The wording
    and rulers are a fixed format."""
    results = results_of(lake, run_id)
    counts = summary(results).first()
    if counts.total == 0:
        return f"No quality check results found for run_id '{run_id}'."
    checked_at = results.agg(F.min("checked_at")).first()[0]
    heavy, light = "=" * 70, "-" * 70
    out = [
        heavy, "DATA QUALITY REPORT", heavy,
        f"Run ID: {run_id}",
        f"Checked at: {checked_at}",
        "",
        f"Total checks: {counts.total}   Passed: {counts.passed}   Failed: {counts.failed}",
        f"  Critical failures: {counts.critical}   Warnings: {counts.warning}",
        "",
    ]
    if counts.failed:
        out += [light, "FAILURES (by category)", light]
        by_category: dict[str, list] = {}
        for r in failures(results).collect():  # one row per failed check
            by_category.setdefault(r.category, []).append(r)
        for category, rows in by_category.items():
            out.append(f"\n[{category}]")
            for r in rows:
                out.append(f"  [{r.severity}] {r.check_id}: {r.description}")
                out.append(f"      Details: {r.details}")
    else:
        out.append("All quality checks passed. No issues detected.")
    return "\n".join([*out, heavy])


# -- declared constraints, verified --------------------------------------------

# NOT NULL columns, value tests and foreign keys of the data model.
NOT_NULL: dict[str, tuple[str, ...]] = {
    "silver.supplier_master": ("supplier_id", "supplier_name", "country", "contract_start_date",
                               "performance_tier", "bronze_id", "validated_at"),
    "silver.medicine_catalogue": ("medicine_id", "medicine_name", "category", "unit_of_measure",
                                  "shelf_life_days", "bronze_id", "validated_at"),
    "silver.purchase_orders": ("po_id", "supplier_id", "medicine_id", "order_date", "quantity",
                               "total_cost", "currency", "bronze_id", "validated_at"),
    "silver.shipment_records": ("shipment_id", "po_id", "warehouse_id", "eta",
                                "transport_company", "status", "bronze_id", "validated_at"),
    "silver.warehouse_inventory": ("warehouse_id", "medicine_id", "batch_number",
                                   "quantity_on_hand", "expiry_date", "bronze_id",
                                   "validated_at"),
    "gold.fact_shipment": ("shipment_key", "shipment_id", "supplier_key", "medicine_key",
                           "warehouse_key", "country_key", "order_date_key", "eta_date_key",
                           "quantity", "total_cost", "currency", "is_delayed", "status"),
}
CHECKS: dict[str, dict[str, str]] = {
    "silver.purchase_orders": {"quantity > 0": "quantity > 0", "total_cost >= 0": "total_cost >= 0"},
    "silver.warehouse_inventory": {"quantity_on_hand >= 0": "quantity_on_hand >= 0"},
    "quality.check_results": {
        "status domain": "status IN ('PASS', 'FAIL')",
        "severity domain": "severity IN ('INFO', 'WARNING', 'CRITICAL')",
    },
}
UNIQUE: dict[str, tuple[str, ...]] = {
    "silver.supplier_master": ("supplier_id",),
    "silver.medicine_catalogue": ("medicine_id",),
    "silver.purchase_orders": ("po_id",),
    "silver.shipment_records": ("shipment_id",),
    "silver.warehouse_inventory": ("warehouse_id", "medicine_id", "batch_number"),
    "gold.dim_date": ("date_key",),
    "gold.dim_country": ("country_name",),
    "gold.dim_supplier": ("supplier_id",),
    "gold.dim_medicine": ("medicine_id",),
    "gold.dim_warehouse": ("warehouse_id",),
    "gold.fact_shipment": ("shipment_id",),
}
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("silver.purchase_orders", "supplier_id", "silver.supplier_master", "supplier_id"),
    ("silver.purchase_orders", "medicine_id", "silver.medicine_catalogue", "medicine_id"),
    ("silver.shipment_records", "po_id", "silver.purchase_orders", "po_id"),
    ("silver.warehouse_inventory", "medicine_id", "silver.medicine_catalogue", "medicine_id"),
    ("gold.dim_supplier", "country_key", "gold.dim_country", "country_key"),
    ("gold.fact_shipment", "supplier_key", "gold.dim_supplier", "supplier_key"),
    ("gold.fact_shipment", "medicine_key", "gold.dim_medicine", "medicine_key"),
    ("gold.fact_shipment", "warehouse_key", "gold.dim_warehouse", "warehouse_key"),
    ("gold.fact_shipment", "country_key", "gold.dim_country", "country_key"),
    ("gold.fact_shipment", "order_date_key", "gold.dim_date", "date_key"),
    ("gold.fact_shipment", "eta_date_key", "gold.dim_date", "date_key"),
    ("gold.fact_shipment", "actual_arrival_date_key", "gold.dim_date", "date_key"),
)


def _violations(df: DataFrame, table: str, tests: dict[str, Column]) -> DataFrame:
    """One pass over a table counts every test's violations; one row per test."""
    names = list(tests)
    wide = df.agg(*[F.count_if(tests[n]).alias(f"t{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(f"t{i}").alias("violations"))
          for i, n in enumerate(names)])
    return wide.select(F.lit(table).alias("table_name"), F.inline(pairs)).withColumnRenamed(
        "name", "constraint_name")


def not_null_violations(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    return _violations(df, table, {f"{c} not null": F.col(c).isNull() for c in columns})


def check_violations(df: DataFrame, table: str, predicates: dict[str, str]) -> DataFrame:
    return _violations(df, table, {n: ~F.expr(p) for n, p in predicates.items()})


def unique_violations(df: DataFrame, table: str, keys: tuple[str, ...]) -> DataFrame:
    return duplicate_keys(df, list(keys)).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(f"unique ({', '.join(keys)})").alias("constraint_name"),
        "violations",
    )


def foreign_key_violations(
    child: DataFrame, table: str, fk: str, parent: DataFrame, parent_table: str, pk: str
) -> DataFrame:
    lost = orphan_rows(child, [fk], parent, [pk])
    return lost.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(f"{fk} references {parent_table}").alias("constraint_name"),
        "violations",
    )


def verify_constraints(lake: Lake, kinds: tuple[str, ...] = ("null", "check", "unique", "fk")):
    """Violation counts of every declared constraint, as one frame."""
    t = lambda name: lake.read(*name.split("."))
    parts: list[DataFrame] = []
    tests: dict[str, dict[str, Column]] = {}
    if "null" in kinds:
        for n, cols in NOT_NULL.items():
            tests.setdefault(n, {}).update({f"{c} not null": F.col(c).isNull() for c in cols})
    if "check" in kinds:
        for n, predicates in CHECKS.items():
            tests.setdefault(n, {}).update({k: ~F.expr(p) for k, p in predicates.items()})
    parts += [_violations(t(n), n, told) for n, told in tests.items()]
    if "unique" in kinds:
        parts.append(all_unique_violations({n: t(n) for n in UNIQUE}))
    if "fk" in kinds:
        parts.append(all_foreign_key_violations({
            n: t(n) for n in dict.fromkeys([x for f in FOREIGN_KEYS for x in (f[0], f[2])])}))
    return reduce(DataFrame.unionByName, parts)


def _counted(spark, found: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """A row for each constraint, found (tag, violations) or not."""
    rows = _constants(spark, [(i, *n) for i, n in enumerate(names)], "tag int, table_name string, constraint_name string")
    return rows.join(found, "tag", "left").select(
        "table_name", "constraint_name", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


def all_unique_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every UNIQUE constraint by one shuffle of tagged keys."""
    dups = _repeated_keys([(tables[n], i, list(keys)) for i, (n, keys) in enumerate(UNIQUE.items())])
    found = dups.groupBy("tag").agg(F.count(F.lit(1)).alias("violations"))
    return _counted(dups.sparkSession, found, [(n, f"unique ({', '.join(k)})") for n, k in UNIQUE.items()])


def all_foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every foreign key in one pass: each table is scanned once, as child and as parent, its
    keys unfolded to (constraint, key) rows that are counted in the map tasks and meet in one
    shuffle. A NULL key refers to nothing."""
    sides = []
    for name, df in tables.items():
        rows = [F.struct(F.lit(i).alias("tag"), F.col(fk).cast("string").alias("key"), F.lit(1).alias("n"),
                         F.lit(False).alias("known"))
                for i, (child, fk, _, _) in enumerate(FOREIGN_KEYS) if child == name]
        rows += [F.struct(F.lit(i).alias("tag"), F.col(pk).cast("string").alias("key"), F.lit(0).alias("n"),
                          F.lit(True).alias("known"))
                 for i, (_, _, parent, pk) in enumerate(FOREIGN_KEYS) if parent == name]
        sides.append(df.select(F.inline(F.array(*rows))))
    met = reduce(DataFrame.unionByName, sides).where("key IS NOT NULL").groupBy("tag", "key").agg(
        F.sum("n").alias("n"), F.bool_or("known").alias("known"))
    found = met.where("NOT known").groupBy("tag").agg(F.sum("n").alias("violations"))
    return _counted(met.sparkSession, found, [(t, f"{fk} references {p}") for t, fk, p, _ in FOREIGN_KEYS])


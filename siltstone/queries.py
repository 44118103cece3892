"""The registered queries: every operator over the whole provided tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import SOURCES, load_config
from siltstone.functions.metrics import is_delayed
from siltstone.operators import history
from siltstone.operators.dedup import absent_values, duplicate_keys
from siltstone.operators.membership import orphan_rows
from siltstone.operators.upsert import upsert
from siltstone.plans import gold, quality, silver, views
from siltstone.plans.pipeline import run_pipeline
from siltstone.plans.workspace import (
    LANDED_AT,
    LANDING_RUN,
    QUALITY_RUN,
    SECOND,
    SILVER_RUN,
    Workspace,
)
from siltstone.sources import bronze as landing
from siltstone.sources import testdata
from siltstone.sources.lake import writing
from siltstone.sources.readers import READERS, SOURCE_FILE, bad_records, read_source
from siltstone.streaming.incremental import stream_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NAMES = list(SOURCES)


def query(name: str):
    def add(fn: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(Workspace.of(spark, sf_dir)))
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, so any client compares them alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- sources and Bronze --------------------------------------------------------

for _n in NAMES:
    query(f"bronze_{_n}")(lambda w, n=_n: w.bronze(n).select(*w.spec(n).columns, "run_id"))


@query("bronze_row_ids")
def bronze_row_ids(w: Workspace) -> DataFrame:
    """Row ids are positive and no two rows of a table share one."""
    return union_all([
        w.bronze(n).groupBy("bronze_id").agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_ids"),
            (F.min("bronze_id") > 0).alias("all_positive"),
        ).withColumn("source", F.lit(n))
        for n in NAMES
    ])


@query("ingest_load_metrics")
def ingest_load_metrics(w: Workspace) -> DataFrame:
    for n in NAMES:
        w.land(n)
    return landing.load_metrics(w.lake, LANDING_RUN)


@query("rows_of_run")
def rows_of_run(w: Workspace) -> DataFrame:
    for n in NAMES:
        w.land(n)
    return landing.rows_of_run(w.lake, list(w.config.sources), LANDING_RUN)


AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # when written


def _file_source(w: Workspace, name: str, fmt: str, **options: str) -> DataFrame:
    """Write a delivery out as files once, then scan it the way a source is scanned."""
    path = f"{w.lake.root}/files/{name}.{fmt}"
    if w._once(f"files/{name}"):
        rows = testdata.delivery(w.spark, w.sf_dir, name).write.mode("overwrite")
        with writing(w.spark):
            rows.csv(path, header=True, escape='"', **AS_IS) if fmt == "csv" else rows.json(path)
    spec = replace(SOURCES[name], file_format=fmt, path=path, options=options)
    return read_source(w.spark, spec).select(*spec.columns)


query("csv_source_supplier_master")(lambda w: _file_source(w, "supplier_master", "csv"))
query("csv_source_warehouse_inventory")(lambda w: _file_source(w, "warehouse_inventory", "csv"))
query("json_source_purchase_orders")(
    lambda w: _file_source(w, "purchase_orders", "json", multiLine="false"))
query("json_source_shipment_records")(
    lambda w: _file_source(w, "shipment_records", "json", multiLine="false"))


@query("csv_columns_in_any_order")
def csv_columns_in_any_order(w: Workspace) -> DataFrame:
    """Two folders of files, the second with its columns reversed: values are bound by
    name, and every row tells which file it came from."""
    path, columns = f"{w.lake.root}/files/two_orders", list(SOURCES["supplier_master"].columns)
    if w._once("files/two_orders"):
        rows = testdata.delivery(w.spark, w.sf_dir, "supplier_master")
        odd = F.substring("supplier_id", -1, 1).isin(*"13579")
        for name, part, cols in (("even", rows.filter(~odd), columns), ("odd", rows.filter(odd), columns[::-1])):
            part.select(*cols).write.mode("overwrite").csv(f"{path}/{name}", header=True, escape='"', **AS_IS)
    spec = replace(SOURCES["supplier_master"], file_format="csv", path=path)
    return read_source(w.spark, spec).groupBy(F.element_at(F.split(SOURCE_FILE, "/"), -2).alias("folder")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("supplier_id").startswith("SUP-")).alias("named_ids"),
        F.count_if(F.col("performance_tier").startswith("Tier ")).alias("tiers"))


@query("csv_quoted_line_breaks")
def csv_quoted_line_breaks(w: Workspace) -> DataFrame:
    """A third of the names hold a line break, a quote and a comma; they arrive as written, from
    files that several tasks read."""
    path, spec = f"{w.lake.root}/files/line_breaks", SOURCES["medicine_catalogue"]
    if w._once("files/line_breaks"):
        rows = testdata.delivery(w.spark, w.sf_dir, spec.name)
        third = F.substring("medicine_id", -1, 1).isin(*"147")
        name = F.when(third, F.concat("medicine_name", F.lit('\n"no, 2",\n'))).otherwise(F.col("medicine_name"))
        rows.withColumn("medicine_name", name).write.mode("overwrite").csv(
            path, header=True, escape='"', quoteAll=True, **AS_IS)
    spec = replace(spec, file_format="csv", path=path)
    return read_source(w.spark, spec, w.lake.staging("scans")).select(*spec.columns)


@query("csv_bad_records")
def csv_bad_records(w: Workspace) -> DataFrame:
    """Records with a field too few or too many beside good ones: the bad ones are kept raw with
    file and line, the others are read."""
    path, spec = f"{w.lake.root}/files/bad_records", SOURCES["supplier_master"]
    if w._once("files/bad_records"):
        last = F.substring("supplier_id", -1, 1)
        line = F.concat_ws(",", *spec.columns)
        line = (F.when(last == "1", F.concat_ws(",", *spec.columns[:-1])).when(last == "2", F.concat(line, F.lit(",x")))
                .when(last == "3", F.concat(line, F.lit(",,x"))).otherwise(line))
        testdata.delivery(w.spark, w.sf_dir, spec.name).select(line.alias(",".join(spec.columns))).write.mode(
            "overwrite").csv(path, header=True, sep="\x01", quote="", **AS_IS)
    spec = replace(spec, file_format="csv", path=path, options={"badRecords": "keep"})
    good = read_source(w.spark, spec, w.lake.staging("scans")).select(
        F.lit("read").alias("outcome"), F.concat_ws(",", *spec.columns).alias("record"), F.lit(True).alias("has_place"))
    bad = bad_records(w.spark, spec, w.lake.staging("scans")).select(
        F.lit("kept").alias("outcome"), "record",
        ((F.col("line") > 1) & F.col("source_file").endswith(".csv")).alias("has_place"))
    return good.unionByName(bad)


def _bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The objects of a task as one JSON array."""
    lead = "["
    for batch in batches:
        lines = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_pydict({"value": [f"{lead if not i else ','}{x}" for i, x in enumerate(lines)]})
        lead = "," if lines else lead
    yield pa.RecordBatch.from_pydict({"value": ["[]" if lead == "[" else "]"]})


def _write_arrays(rows: DataFrame, columns: tuple[str, ...], files: int, path: str) -> None:
    """Rows as JSON arrays, one a file and each on one line."""
    objects = rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))
    with writing(rows.sparkSession):
        objects.repartition(files).mapInArrow(_bracketed, "value string").write.mode("overwrite").option(
            "lineSep", " ").text(path)


@query("json_array_source")
def json_array_source(w: Workspace) -> DataFrame:
    """A delivery as one JSON array per file instead of a line per object."""
    path, spec = f"{w.lake.root}/files/array.json", SOURCES["medicine_catalogue"]
    if w._once("files/array"):
        rows = testdata.delivery(w.spark, w.sf_dir, spec.name)
        _write_arrays(rows, spec.columns, 2 + rows.count() // 50_000, path)
    spec = replace(spec, file_format="json", path=path)
    return read_source(w.spark, spec, w.lake.staging("scans")).select(*spec.columns)


@query("json_one_large_array")
def json_one_large_array(w: Workspace) -> DataFrame:
    """All orders as one array on one line (its one file is written by one task, and read by
    as many as its size asks for), some with brackets and quotes in their text."""
    path, spec = f"{w.lake.root}/files/large.json", SOURCES["purchase_orders"]
    if w._once("files/large"):
        rows = testdata.delivery(w.spark, w.sf_dir, spec.name)
        odd = F.substring("po_id", -1, 1).isin(*"13")
        currency = F.when(odd, F.concat("currency", F.lit('"},{[\\'))).otherwise(F.col("currency"))
        _write_arrays(rows.withColumn("currency", currency), spec.columns, 1, path)
    spec = replace(spec, file_format="json", path=path)
    return read_source(w.spark, spec, w.lake.staging("scans")).select(*spec.columns)


@query("source_formats")
def source_formats(w: Workspace) -> DataFrame:
    """One delivery through every format the registry names; an unknown one and an absent file
    are refused before anything is read."""
    spec, told = SOURCES["supplier_master"], []
    rows = testdata.delivery(w.spark, w.sf_dir, spec.name)
    for fmt in (*READERS, "xml"):
        path = f"{w.lake.root}/files/formats/{fmt}"
        if w._once(f"files/formats/{fmt}"):
            out = rows.write.mode("overwrite")
            out.csv(path, header=True, escape='"', **AS_IS) if fmt == "csv" else (
                out.json(path) if fmt == "json" else out.parquet(path))
        options = {"multiLine": "false"} if fmt == "json" else {}
        for name, place in ((fmt, path), (f"{fmt}, absent", f"{path}/none")):
            try:
                read = read_source(w.spark, replace(spec, file_format=fmt, path=place, options=options))
                told.append(read.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(
                    F.col("supplier_id").startswith("SUP-")).alias("named_ids")).withColumn("outcome", F.lit("read")))
            except (KeyError, FileNotFoundError) as e:
                told.append(w.spark.range(1).select(
                    *[F.lit(0).cast("long").alias(c) for c in ("row_count", "named_ids")],
                    F.lit(type(e).__name__).alias("outcome")))
            told[-1] = told[-1].withColumn("format", F.lit(name))
    return union_all(told)


@query("stock_levels_by_settings")
def stock_levels_by_settings(w: Workspace) -> DataFrame:
    """Stock against the limits of the settings file, whose sources are those of the registry."""
    config = load_config()
    listed = {s.name for s in config.sources} == set(NAMES)
    return views.stock_levels(
        w.silver("warehouse_inventory"), config.min_stock_units, config.max_stock_units
    ).groupBy("stock_status").agg(F.count(F.lit(1)).alias("row_count")).withColumn("all_sources", F.lit(listed))


@query("landed_source_files")
def landed_source_files(w: Workspace) -> DataFrame:
    """Bronze rows landed from files tell their own file, not the folder."""
    path, spec = f"{w.lake.root}/files/landed", SOURCES["medicine_catalogue"]
    spec = replace(spec, file_format="csv", path=path, bronze_name="medicine_files")
    if w._once("files/landed"):
        testdata.delivery(w.spark, w.sf_dir, spec.name).repartition(3, "medicine_id").write.mode(
            "overwrite").csv(path, header=True, escape='"', **AS_IS)
        landing.land(w.lake, read_source(w.spark, spec), spec, LANDING_RUN, ingested_at=LANDED_AT)
    rows = w.lake.read("bronze", spec.bronze_table, spec.bronze_schema)
    return rows.agg(F.count(F.lit(1)).alias("row_count"),
                    F.count_if(F.col("source_file").endswith(".csv")).alias("rows_with_file"),
                    (F.countDistinct("source_file") > 1).alias("several_files"))


# -- Silver ---------------------------------------------------------------------

for _n in NAMES:
    query(f"silver_{_n}")(lambda w, n=_n: w.silver(n).drop("bronze_id", "validated_at"))


@query("silver_outcomes")
def silver_outcomes(w: Workspace) -> DataFrame:
    w.all_silver()
    return silver.outcomes(w.lake, SILVER_RUN)


@query("unprocessed_rows")
def unprocessed_rows(w: Workspace) -> DataFrame:
    """What the next load would read again: the copies skipped this time."""
    w.all_silver()
    return union_all([
        silver.unprocessed(w.lake, s).agg(F.count(F.lit(1)).alias("row_count")).withColumn(
            "source", F.lit(s.name))
        for s in w.config.sources
    ])


def _variant(name: str, fn: Callable[[Workspace], DataFrame], variant: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(fn(Workspace.of(spark, sf_dir, variant)))


def _second_load(w: Workspace) -> DataFrame:
    """The same delivery again: nothing is added, copies of it are counted."""
    for n in NAMES:
        w.load_again(n)
    return silver.outcomes(w.lake, SILVER_RUN + SECOND)


def _vr09(w: Workspace) -> DataFrame:
    """Later copies of a key recorded in quarantine instead of only counted."""
    for n in NAMES:
        w.load(n, on_duplicate="quarantine")
    return w.lake.read("silver", "quarantine").groupBy("target_table", "rule_id").agg(
        F.count(F.lit(1)).alias("row_count"))


def _stream(w: Workspace) -> DataFrame:
    """Parents loaded as a batch, purchase orders through the stream of landings, beside
    the leftovers of a landing that died before it was logged."""
    spec = w.spec("purchase_orders")
    for ref in spec.references:
        w.load(ref.parent)
    w.land(spec.name)
    if w._once("dead landing"):
        dead = w.bronze(spec.name).withColumn("bronze_id", -F.col("bronze_id")).withColumn(
            "po_id", F.concat(F.lit("DEAD-"), "po_id"))
        w.lake.put_partition(dead, "bronze", spec.bronze_table, run_id="died")
    if w._once("stream"):
        stream_silver(w.lake, spec, "stream", LANDED_AT).awaitTermination()
    return w.lake.read("silver", spec.silver_table).drop("bronze_id", "validated_at")


_variant("silver_second_load_outcomes", _second_load, "again")
_variant("quarantine_vr09_duplicates", _vr09, "vr09")
_variant("silver_stream_purchase_orders", _stream, "stream")


# -- quarantine -------------------------------------------------------------------

_KEY_PATHS = {n: [f"$.{k}" for k in SOURCES[n].natural_key] for n in NAMES}


def _row_key() -> F.Column:
    key = F.lit(None).cast("string")
    for n, paths in _KEY_PATHS.items():
        text = F.concat_ws("|", *[F.get_json_object("row_data", p) for p in paths])
        key = F.when(F.col("target_table") == n, text).otherwise(key)
    return key


@query("quarantine_rows")
def quarantine_rows(w: Workspace) -> DataFrame:
    return w.quarantine().select(
        "source_name", "target_table", "rule_id", "rule_description",
        _row_key().alias("row_key"), F.get_json_object("row_data", "$.run_id").alias(
            "landing_run"), F.col("run_id").alias("load_run"))


query("quarantine_by_rule_and_day")(lambda w: silver.quarantine_by_rule_and_day(w.quarantine()))
query("quarantine_by_rule")(
    lambda w: w.quarantine().groupBy("target_table", "rule_id").agg(
        F.count(F.lit(1)).alias("row_count")))


@query("quarantine_of_purchase_orders")
def quarantine_of_purchase_orders(w: Workspace) -> DataFrame:
    """The original order as delivered, read back out of the stored JSON."""
    rows = silver.quarantine_of(w.quarantine(), "purchase_orders")
    fields = [F.get_json_object("row_data", f"$.{c}").alias(c)
              for c in SOURCES["purchase_orders"].columns]
    return rows.select("rule_id", *fields)


@query("orphan_supplier_ids")
def orphan_supplier_ids(w: Workspace) -> DataFrame:
    """Raw orders whose supplier is not in Silver, counted per id."""
    return orphan_rows(w.bronze("purchase_orders"), ["supplier_id"],
                       w.silver("supplier_master"), ["supplier_id"])


# -- Gold -------------------------------------------------------------------------

query("dim_date")(lambda w: w.gold("dim_date"))
query("dim_country")(lambda w: w.gold("dim_country").select("country_name", "risk_tier"))
query("dim_medicine")(lambda w: w.gold("dim_medicine").drop("medicine_key"))
query("dim_warehouse")(lambda w: w.gold("dim_warehouse").drop("warehouse_key"))


@query("dim_supplier")
def dim_supplier(w: Workspace) -> DataFrame:
    return w.gold("dim_supplier").join(w.gold("dim_country"), "country_key").select(
        "supplier_id", "supplier_name", "country_name", "performance_tier")


@query("surrogate_keys")
def surrogate_keys(w: Workspace) -> DataFrame:
    """Every surrogate key is set and used once."""
    w.star()
    keys = {"dim_country": "country_key", "dim_supplier": "supplier_key",
            "dim_medicine": "medicine_key", "dim_warehouse": "warehouse_key",
            "fact_shipment": "shipment_key"}
    return union_all([
        w.gold(t).groupBy(F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("row_count"), F.count("k").alias("distinct_keys")
        ).withColumn("table_name", F.lit(t))
        for t, k in keys.items()
    ])


@query("fact_shipment")
def fact_shipment(w: Workspace) -> DataFrame:
    """The fact with natural ids in place of its surrogate keys."""
    f = w.gold("fact_shipment")
    return (
        f.join(w.gold("dim_supplier").select("supplier_key", "supplier_id"), "supplier_key")
        .join(w.gold("dim_medicine").select("medicine_key", "medicine_id"), "medicine_key")
        .join(w.gold("dim_warehouse").select("warehouse_key", "warehouse_id"), "warehouse_key")
        .join(w.gold("dim_country").select("country_key", "country_name"), "country_key")
        .drop("supplier_key", "medicine_key", "warehouse_key", "country_key", "shipment_key")
    )


@query("fact_partial_upsert")
def fact_partial_upsert(w: Workspace) -> DataFrame:
    """All shipments redelivered as closed, with other quantities and a threshold of
    5 days: delay flag and status follow, the quantity stays as first written. Delayed
    ones also come under a new id, with a key of their own."""
    f = w.gold("fact_shipment")
    again = f.drop("shipment_key").withColumns({
        "status": F.lit("Closed"), "quantity": F.col("quantity") + 1,
        "is_delayed": is_delayed(F.col("delay_days"), 5)})
    new = again.filter(F.col("delay_days") > 5).withColumn(
        "shipment_id", F.concat(F.lit("NEW-"), "shipment_id"))
    top = w.lake.current_max("gold", "fact_shipment", "shipment_key")
    merged = upsert(f, again.unionByName(new), "shipment_id", "shipment_key", gold.FACT_UPDATES, top)
    return merged.select("shipment_id", "quantity", "delay_days", "is_delayed", "status",
                         (F.col("shipment_key") > top).alias("new_key"))


def _week(w: Workspace) -> DataFrame:
    """The shipments of one week redelivered as closed, with other quantities, the late ones
    under a new id as well, and merged into the written fact: folders of other quarters stay, and
    the sums beside the fact follow."""
    fact = w.gold("fact_shipment")
    if w._once("week"):
        before = w.lake.current_paths("gold", "fact_shipment")
        again = fact.where("eta_date_key BETWEEN 19970407 AND 19970413").drop("shipment_key").withColumns({
            "status": F.lit("Closed"), "quantity": F.col("quantity") + 1})
        late = again.where("delay_days > 5").withColumn("shipment_id", F.concat(F.lit("NEW-"), "shipment_id"))
        gold.merge_fact(w.lake, again.unionByName(late))
        after = w.lake.current_paths("gold", "fact_shipment")
        w.last_run = {p for p in before if not p.endswith("=19972")} <= set(after)
    rows = w.lake.read("gold", "fact_shipment")
    n = views.kpi_totals(views.sums_of(w.lake)).select(F.col("total_shipments").alias("summed"))
    return rows.select("shipment_id", "quantity", "status").withColumns({"others_kept": F.lit(w.last_run), "summed": F.lit(n.first()[0])})


_variant("fact_merge_of_a_week", _week, "week")


@query("dim_type1_upsert")
def dim_type1_upsert(w: Workspace) -> DataFrame:
    """Suppliers redelivered with a changed tier, raw rejects among them: known rows
    take every new attribute and keep their key, unknown ones are added."""
    now = w.gold("dim_supplier").drop("country_key")
    again = w.bronze("supplier_master").select(
        "supplier_id", F.upper("supplier_name").alias("supplier_name"),
        F.concat(F.lit("New "), "performance_tier").alias("performance_tier"))
    top = w.lake.current_max("gold", "dim_supplier", "supplier_key")
    merged = upsert(now, again, "supplier_id", "supplier_key",
                    ["supplier_name", "performance_tier"], top)
    before = now.select("supplier_id", F.col("supplier_key").alias("_was"))
    return merged.join(before, "supplier_id", "left").select(
        "supplier_id", "supplier_name", "performance_tier",
        (F.col("_was") == F.col("supplier_key")).alias("kept_key"))


@query("dim_supplier_versions")
def dim_supplier_versions(w: Workspace) -> DataFrame:
    """Type 2: a year after the first delivery some tiers change, some suppliers are absent
    and some are new; the history shows what held when."""
    attributes = ["supplier_name", "performance_tier"]
    rows = w.silver("supplier_master").select("supplier_id", *attributes)
    last = F.substring("supplier_id", -1, 1).cast("int")
    first = history.first_versions(
        rows.filter(last != 9), "supplier_id", attributes, F.lit("1997-01-01").cast("date"))
    again = rows.filter(last != 8).withColumn("performance_tier", F.when(
        last % 3 == 0, F.concat("performance_tier", F.lit("+"))).otherwise(F.col("performance_tier")))
    return history.next_versions(
        first, again, "supplier_id", attributes, F.lit("1998-01-01").cast("date"))


@query("insert_if_absent_values")
def insert_if_absent_values(w: Workspace) -> DataFrame:
    """Raw medicine ids that the medicine dimension does not hold."""
    return absent_values(w.bronze("medicine_catalogue"), w.gold("dim_medicine"), ["medicine_id"])


# -- views and KPIs ---------------------------------------------------------------


@query("vw_shipment_details")
def vw_shipment_details(w: Workspace) -> DataFrame:
    w.star()
    return views.details_of(w.lake).drop("shipment_key")


@query("vw_supplier_performance")
def vw_supplier_performance(w: Workspace) -> DataFrame:
    w.star()
    return views.performance_of(w.lake)


@query("vw_medicine_expiry_risk")
def vw_medicine_expiry_risk(w: Workspace) -> DataFrame:
    w.silver("warehouse_inventory")
    w.gold("dim_medicine")
    return views.expiry_of(w.lake, w.config, w.as_of())


@query("views_through_sql")
def views_through_sql(w: Workspace) -> DataFrame:
    """The three views asked through SQL, as a BI client would."""
    w.star()
    w.silver("warehouse_inventory")
    views.register_views(w.lake, w.config, w.as_of())
    return w.spark.sql("""
        SELECT 'shipment_details' AS view_name, count(*) AS row_count FROM vw_shipment_details
        UNION ALL SELECT 'supplier_performance', count(*) FROM vw_supplier_performance
        UNION ALL SELECT 'medicine_expiry_risk', count(*) FROM vw_medicine_expiry_risk""")


@query("calendar_keeps_all")
def calendar_keeps_all(w: Workspace) -> DataFrame:
    """No shipment is lost between the fact, the details and the month chart, although
    its dates lie outside the configured years."""
    w.star()
    fact = w.gold("fact_shipment")
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias("n")).withColumn("step", F.lit(c))
    arrived = views.details_of(w.lake).filter("actual_arrival_date is not null")
    months = views.volume_by_month(fact).agg(
        F.sum("total_shipments").alias("n")).withColumn("step", F.lit("months"))
    return union_all([n(fact, "fact"), n(views.details_of(w.lake), "details"),
                      n(arrived, "arrived"), months])


def _pipeline_again(w: Workspace) -> DataFrame:
    """The views through SQL after three more Gold loads: registered once, they show the
    current rows."""
    w.star()
    w.silver("warehouse_inventory")
    if w._once("reloads"):
        views.register_views(w.lake, w.config, w.as_of())
        for _ in range(3):
            gold.load_all_gold(w.lake, w.config)
    return w.spark.table("vw_shipment_details").drop("shipment_key")


_variant("views_after_reloads", _pipeline_again, "reloads")


def _unordered(w: Workspace) -> DataFrame:
    """All sources loaded from settings that list children first."""
    if w._once("unordered"):
        for n in NAMES:
            w.land(n)
        config = replace(w.config, sources=tuple(reversed(w.config.sources)))
        silver.load_all_silver(w.lake, config, SILVER_RUN, LANDED_AT)
    return silver.outcomes(w.lake, SILVER_RUN)


_variant("silver_outcomes_any_order", _unordered, "unordered")


def _whole_run(w: Workspace) -> DataFrame:
    """The whole chain from delivered files: landing, Silver, Gold and checks in one call."""
    if w._once("whole run"):
        sources = []
        for n in NAMES:
            path = f"{w.lake.root}/files/{n}.csv"
            with writing(w.spark):
                testdata.delivery(w.spark, w.sf_dir, n).write.csv(path, header=True, escape='"', **AS_IS)
            sources.append(replace(w.spec(n), file_format="csv", path=path))
        run = run_pipeline(w.lake, replace(w.config, sources=tuple(sources)), LANDED_AT)
        w.last_run = run
    run = w.last_run
    loaded = run.landed.select("source", "rows_loaded")
    gold_rows = w.spark.createDataFrame(
        [("shipment_records", run.gold["fact_shipment"])], "source string, gold_rows long")
    return silver.outcomes(w.lake, run.silver_run_id).join(loaded, "source").join(
        gold_rows, "source", "left")


_variant("whole_run_from_files", _whole_run, "files")


query("supplier_table")(lambda w: views.supplier_table(vw_supplier_performance(w)))


def _sums(w: Workspace) -> DataFrame:
    w.star()
    return views.sums_of(w.lake)


query("kpi_totals")(lambda w: views.kpi_totals(_sums(w)))
query("delayed_by_country")(lambda w: views.delayed_by_country(_sums(w), w.gold("dim_country")))
query("cost_by_country")(lambda w: views.cost_by_country(_sums(w), w.gold("dim_country")))
query("volume_by_month")(lambda w: views.volume_by_month(_sums(w)))
query("shipments_by_supplier")(lambda w: views.shipments_by_supplier(_sums(w), w.gold("dim_supplier")))
query("kpi_totals_of_the_fact")(lambda w: views.kpi_totals(w.gold("fact_shipment")))


@query("delayed_in_quarter")
def delayed_in_quarter(w: Workspace) -> DataFrame:
    w.star()
    return views.delayed_in_quarter(w.lake, 1997, 2).drop("shipment_key")


@query("stock_levels")
def stock_levels(w: Workspace) -> DataFrame:
    return views.stock_levels(
        w.silver("warehouse_inventory"), w.config.min_stock_units, w.config.max_stock_units)


# -- quality ------------------------------------------------------------------------

EVENT_DAY = "run-2024-01-15"


def _ts(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


@query("check_freshness")
def check_freshness(w: Workspace) -> DataFrame:
    """One log, asked shortly after its last row and again two days later."""
    log = w.ingest_log()
    return union_all([
        quality.freshness(log, "events", "events", _ts(at), w.config.freshness_max_age_hours)
        for at in ("2024-01-31 10:00:00", "2024-02-02 00:00:00")
    ])


@query("check_row_count_deviation")
def check_row_count_deviation(w: Workspace) -> DataFrame:
    """The newest run, a named one, a trailing week, and a tolerance of nearly 0."""
    log = w.ingest_log()
    limit = w.config.row_count_deviation_threshold_pct
    return union_all([
        quality.row_count_deviation(log, "newest", limit),
        quality.row_count_deviation(log, "named", limit, EVENT_DAY),
        quality.row_count_deviation(log, "trailing", limit, since=_ts("2024-01-24 00:00:00")),
        quality.row_count_deviation(log, "strict", 0.001, EVENT_DAY),
    ])


query("latest_run")(lambda w: quality.latest_run(w.ingest_log()))
query("run_counts")(
    lambda w: quality.run_counts(w.ingest_log()).select("run_id", "run_count"))
query("rows_in_run")(lambda w: quality.rows_in_run(w.ingest_log(), EVENT_DAY))
query("average_of_other_runs")(
    lambda w: quality.average_of_other_runs(w.ingest_log(), EVENT_DAY))
query("average_of_trailing_runs")(
    lambda w: quality.average_of_other_runs(
        w.ingest_log(), EVENT_DAY, _ts("2024-01-24 00:00:00")))
query("latest_ingest_per_source")(
    lambda w: w.ingest_log().groupBy("source_file").agg(
        F.max("ingested_at").alias("last_ingested_at")))


@query("check_uniqueness_silver")
def check_uniqueness_silver(w: Workspace) -> DataFrame:
    return quality.uniqueness_of([(w.silver(n), n, list(SOURCES[n].natural_key)) for n in NAMES])


@query("check_uniqueness_bronze")
def check_uniqueness_bronze(w: Workspace) -> DataFrame:
    """The same test on raw rows, where it fails and lists the first ten keys."""
    return quality.uniqueness_of([
        (w.bronze(n), w.spec(n).bronze_table, list(SOURCES[n].natural_key)) for n in NAMES])


query("duplicate_order_ids")(
    lambda w: duplicate_keys(w.bronze("purchase_orders"), ["po_id"]))


@query("check_consistency")
def check_consistency(w: Workspace) -> DataFrame:
    return quality.shipment_consistency(w.silver("shipment_records"), w.gold("fact_shipment"))


@query("check_suite")
def check_suite(w: Workspace) -> DataFrame:
    return w.checks().drop("check_result_id", "checked_at")


query("check_summary")(lambda w: quality.summary(w.checks()))


def _late_checks(w: Workspace) -> DataFrame:
    """The suite asked two days after landing, so freshness fails."""
    w.star()
    w.all_silver()
    at = F.lit("1998-01-03 00:00:00").cast("timestamp")
    hours_off = F.lit(LANDED_AT).cast("timestamp") + F.expr("INTERVAL 48 HOURS")
    return quality.all_checks(w.lake, w.config, hours_off, composite_keys=True).withColumn(
        "checked_at", at)


query("check_failures")(lambda w: quality.failures(_late_checks(w)))
query("check_summary_late")(lambda w: quality.summary(_late_checks(w)))


@query("check_trend")
def check_trend(w: Workspace) -> DataFrame:
    """Outcomes on two days: the stored run, and the suite asked again two days later."""
    w.checks()
    results = w.lake.read("quality", "check_results").drop("check_result_id", "run_id")
    return quality.trend(results.unionByName(_late_checks(w)), "FRESH-01",
                         F.lit("1998-01-05").cast("date"))


@query("quality_report_lines")
def quality_report_lines(w: Workspace) -> DataFrame:
    """The lines of the text report that do not name the run."""
    w.checks()
    lines = quality.report(w.lake, QUALITY_RUN).split("\n")
    return w.spark.createDataFrame(
        [(t.strip(),) for t in lines if "checks" in t or "failures" in t], "line string")


for _kind in ("null", "check", "unique", "fk"):
    @query(f"constraints_{_kind}")
    def _constraints(w: Workspace, kind: str = _kind) -> DataFrame:
        w.checks()
        return quality.verify_constraints(w.lake, (kind,))


@query("constraints_on_raw_orders")
def constraints_on_raw_orders(w: Workspace) -> DataFrame:
    """The declared tests on raw orders, where they do find violations."""
    raw = w.bronze("purchase_orders").selectExpr(
        "*", "try_cast(quantity AS int) AS q", "try_cast(total_cost AS decimal(12,2)) AS c")
    return union_all([
        quality.not_null_violations(raw, "raw", ("q", "c", "po_id")),
        quality.check_violations(raw, "raw", {"quantity > 0": "q > 0", "total_cost >= 0": "c >= 0"}),
        quality.unique_violations(raw, "raw", ("po_id",)),
        quality.foreign_key_violations(
            raw, "raw", "supplier_id", w.silver("supplier_master"), "silver.supplier_master",
            "supplier_id"),
    ])

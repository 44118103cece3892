"""Silver to Gold: calendar, dimensions and the shipment fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.config import CALENDAR_DATES, GOLD_SCHEMAS, PipelineConfig
from siltstone.functions.metrics import date_key, delay_days, is_delayed
from siltstone.operators.dedup import absent_values
from siltstone.operators.keys import next_base, with_sequence
from siltstone.operators.membership import without
from siltstone.operators.upsert import upsert
from siltstone.plans.views import sums
from siltstone.sources.lake import Lake, struct

#: The calendar's three roles in the fact.
DATE_ROLES = {"order_date_key": "order_date", "eta_date_key": "eta",
              "actual_arrival_date_key": "actual_arrival"}

def calendar(years: DataFrame) -> DataFrame:
    """One row per day from ``first_year`` to ``last_year`` (one row), both included."""
    days = years.select(
        F.explode(
            F.sequence(
                F.make_date(F.col("first_year"), F.lit(1), F.lit(1)),
                F.make_date(F.col("last_year"), F.lit(12), F.lit(31)),
            )
        ).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.weekday(d).alias("day_of_week"),  # Monday is 0
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def calendar_years(lake: Lake, config: PipelineConfig) -> DataFrame:
    """The configured years, widened to every year that an order or a shipment names.

    Silver loads log the days of the rows they add. A table of which the log does not know
    every row (a load died before logging) is scanned instead.
    """
    first, last = config.calendar_start_year, config.calendar_end_year
    bounds = [lake.spark.range(1).select(
        F.make_date(F.lit(first), F.lit(1), F.lit(1)).alias("low"), F.make_date(F.lit(last), F.lit(1), F.lit(1)).alias("high"))]
    logged = {r.source: r for r in lake.read("silver", "load_log").filter("rows_passed > 0").groupBy("source").agg(
        F.sum("rows_passed").alias("n"), F.count_if(F.col("first_day").isNull()).alias("untold"),
        F.min("first_day").alias("low"), F.max("last_day").alias("high")).collect()}  # a row per source
    for table, c in CALENDAR_DATES.items():
        rows, told = lake.read("silver", table), logged.get(table)
        if told and not told.untold and told.n == rows.count():  # a count reads footers only
            bounds.append(lake.spark.range(1).select(F.lit(told.low).alias("low"), F.lit(told.high).alias("high")))
        else:
            low, high = (F.least(*c), F.greatest(*c)) if len(c) > 1 else (F.col(c[0]), F.col(c[0]))
            bounds.append(rows.agg(F.min(low).alias("low"), F.max(high).alias("high")))
    return reduce(DataFrame.unionByName, bounds).agg(
        F.year(F.min("low")).alias("first_year"), F.year(F.max("high")).alias("last_year"))


def load_dim_date(lake: Lake, config: PipelineConfig) -> int:
    days = calendar(calendar_years(lake, config))
    new = without(days, lake.read("gold", "dim_date"), ["date_key"])
    lake.append(new.coalesce(1), "gold", "dim_date")  # one row per day
    return lake.read("gold", "dim_date").count()


def _add_values(lake: Lake, values: DataFrame, table: str, key: str, surrogate: str) -> int:
    """Insert-if-absent of distinct values; returns how many the dimension now holds."""
    new = absent_values(values, lake.read("gold", table), [key])
    base = next_base(lake.current_max("gold", table, surrogate))
    schema = lake.read("gold", table).schema
    rows = with_sequence(new, surrogate, base)
    rows = rows.select(
        *[
            F.col(f.name) if f.name in rows.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    lake.append(rows, "gold", table)
    return lake.read("gold", table).count()


def load_dim_country(lake: Lake) -> int:
    """Countries of suppliers; ``risk_tier`` has no source yet and stays NULL."""
    values = lake.read("silver", "supplier_master").select(F.col("country").alias("country_name"))
    return _add_values(lake, values, "dim_country", "country_name", "country_key")


def load_dim_warehouse(lake: Lake) -> int:
    """Warehouses seen in shipments; region and country have no source yet."""
    values = lake.read("silver", "shipment_records").select("warehouse_id")
    return _add_values(lake, values, "dim_warehouse", "warehouse_id", "warehouse_key")


def _upsert_table(
    lake: Lake, incoming: DataFrame, table: str, key: str, surrogate: str, update: list[str]
) -> int:
    known = lake.exists("gold", table)
    current = lake.read("gold", table) if known else None
    top = lake.current_max("gold", table, surrogate) or 0 if known else None
    columns = struct(GOLD_SCHEMAS[table]).names
    lake.replace(
        upsert(current, incoming, key, surrogate, update, top).select(*columns), "gold", table, key=surrogate)
    lake.expire("gold", table)
    return lake.read("gold", table).count()


def load_dim_supplier(lake: Lake) -> int:
    """Type 1: every attribute follows Silver, the surrogate key stays."""
    suppliers = lake.read("silver", "supplier_master")
    countries = lake.read("gold", "dim_country").select("country_name", "country_key")
    rows = suppliers.join(
        countries, suppliers.country == countries.country_name, "inner"
    ).select("supplier_id", "supplier_name", "country_key", "performance_tier")
    update = ["supplier_name", "country_key", "performance_tier"]
    return _upsert_table(lake, rows, "dim_supplier", "supplier_id", "supplier_key", update)


def load_dim_medicine(lake: Lake) -> int:
    rows = lake.read("silver", "medicine_catalogue").drop("bronze_id", "validated_at")
    update = ["medicine_name", "category", "unit_of_measure", "shelf_life_days"]
    return _upsert_table(lake, rows, "dim_medicine", "medicine_id", "medicine_key", update)


def _resolved(key: str, natural: str, dimension: str):
    """A key that must have been found; a miss stops the load."""
    message = F.concat(F.lit(f"{dimension} has no key for '"), F.col(natural), F.lit("'"))
    return F.coalesce(F.col(key), F.raise_error(message).cast("bigint")).alias(key)


def fact_rows(
    shipments: DataFrame,
    orders: DataFrame,
    suppliers: DataFrame,
    medicines: DataFrame,
    dim_supplier: DataFrame,
    dim_medicine: DataFrame,
    dim_warehouse: DataFrame,
    dim_country: DataFrame,
    dim_date: DataFrame,
    delay_threshold_days: int,
) -> DataFrame:
    """One row per shipment with its dimension keys and delay. A key that a dimension
    or the calendar does not hold stops the load.

    Keys are attached to the parent tables first, so each shipment row meets every
    parent once: one large join on ``po_id``, then three lookups that broadcast
    whenever the lookup is small enough.
    """
    supplier_keys = (
        suppliers.select("supplier_id", "country")
        .join(dim_supplier.select("supplier_id", "supplier_key"), "supplier_id", "left")
        .join(
            dim_country.select(F.col("country_name").alias("country"), "country_key"),
            "country", "left")
        .select("supplier_id", "country", "supplier_key", "country_key")
    )
    medicine_keys = medicines.select("medicine_id").join(
        dim_medicine.select("medicine_id", "medicine_key"), "medicine_id", "left")
    warehouse_keys = dim_warehouse.select("warehouse_id", "warehouse_key")
    orders = orders.select(
        "po_id", "supplier_id", "medicine_id", "order_date", "quantity", "total_cost", "currency")
    joined = (
        shipments.select("shipment_id", "po_id", "warehouse_id", "eta", "actual_arrival", "status")
        .join(orders, "po_id", "inner")
        .join(supplier_keys, "supplier_id", "inner")
        .join(medicine_keys, "medicine_id", "inner")
        .join(warehouse_keys, "warehouse_id", "left")
    )
    for name, day in DATE_ROLES.items():
        days = dim_date.select(F.col("full_date").alias(f"_{name}"), F.col("date_key").alias(name))
        joined = joined.join(days, F.col(day) == F.col(f"_{name}"), "left").drop(f"_{name}")
    late = delay_days(F.col("eta"), F.col("actual_arrival"))
    return joined.select(
        "shipment_id",
        _resolved("supplier_key", "supplier_id", "dim_supplier"),
        _resolved("medicine_key", "medicine_id", "dim_medicine"),
        _resolved("warehouse_key", "warehouse_id", "dim_warehouse"),
        _resolved("country_key", "country", "dim_country"),
        _resolved("order_date_key", "order_date", "dim_date").cast("int").alias("order_date_key"),
        _resolved("eta_date_key", "eta", "dim_date").cast("int").alias("eta_date_key"),
        F.when(F.col("actual_arrival").isNotNull(), _resolved(
            "actual_arrival_date_key", "actual_arrival", "dim_date")).cast("int").alias(
            "actual_arrival_date_key"),
        "quantity",
        "total_cost",
        "currency",
        late.alias("delay_days"),
        is_delayed(late, delay_threshold_days).alias("is_delayed"),
        "status",
    )


FACT_UPDATES = ["delay_days", "is_delayed", "status"]


#: Folders of the fact, by the quarter of the eta.
PART = "eta_quarter"


def by_eta(rows: DataFrame) -> DataFrame:
    """Rows in ranges of their eta, sorted, so that date filters skip files and row groups. A
    busy day is split between tasks by the shipment's hash."""
    return rows.repartitionByRange("eta_date_key", F.xxhash64("shipment_id")).sortWithinPartitions("eta_date_key")


def _quarter(month: str = "eta_date_key div 100") -> Column:
    """Year and quarter of a month like 199704: 19972."""
    return F.expr(f"({month}) div 100 * 10 + (({month}) % 100 + 2) div 3").cast("int").alias(PART)


def _laid_out(rows: DataFrame) -> DataFrame:
    return rows.select(*struct(GOLD_SCHEMAS["fact_shipment"]).names, _quarter())


def merge_fact(lake: Lake, incoming: DataFrame) -> None:
    """Partial upsert into the written fact: known shipments get new delay and status, the
    others a key of their own.

    What changes is found first, on the key and the updated columns alone, and written down.
    Only quarters that hold a changed row are read and written again; new rows are files of their
    own, and a delivery that changes nothing writes nothing. New keys are given to rows that no
    later shuffle moves.
    """
    fact = lake.read("gold", "fact_shipment")
    was = fact.select("shipment_id", F.col("eta_date_key").alias("_eta"), *[F.col(c).alias(f"_{c}") for c in FACT_UPDATES])
    known = F.col("_eta").isNotNull()
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT_UPDATES])
    delta = lake.stage(incoming.join(was, "shipment_id", "left").where(~known | changed), "fact_delta")
    parts = {str(r[0]) for r in delta.where(known).select(_quarter("_eta div 100")).distinct().collect()}  # few
    new = delta.where(~known).drop(*[c for c in delta.columns if c.startswith("_")])
    frames = []
    if parts:
        rows = lake.read("gold", "fact_shipment", parts=parts)
        updates = delta.where(known).select(
            "shipment_id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in FACT_UPDATES])
        rows = rows.join(updates, "shipment_id", "left").withColumns({
            c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in FACT_UPDATES})
        frames.append(_laid_out(by_eta(rows)))
    if not new.isEmpty():
        top = lake.current_max("gold", "fact_shipment", "shipment_key") or 0
        frames.append(_laid_out(upsert(None, by_eta(new), "shipment_id", "shipment_key", FACT_UPDATES, top)))
    if frames:
        before = lake.snapshot("gold", "fact_shipment")
        written = lake.rewrite_parts(frames, "gold", "fact_shipment", parts, key="shipment_key", part=PART)
        write_sums(lake, before, written)
        lake.expire("gold", "fact_shipment")
    lake.unstage("fact_delta")


def write_sums(lake: Lake, before: str | None, parts: set[str]) -> None:
    """Keep the views' sums beside the fact: those of the quarters just written, or all if the
    sums are not those of the fact ``before`` it was written. The commit notes the fact it is of."""
    layout = {"part": PART, "notes": {"fact": lake.snapshot("gold", "fact_shipment")}}
    some = before is not None and lake.note("gold", "fact_summary", "fact") == before
    rows = sums(lake.read("gold", "fact_shipment", parts=parts if some else None))
    rows = rows.withColumn(PART, _quarter("month")).repartition(PART)  # one file a quarter
    if some:
        lake.rewrite_parts([rows], "gold", "fact_summary", parts, **layout)
    else:
        lake.replace(rows, "gold", "fact_summary", **layout)
    lake.expire("gold", "fact_summary")


def load_fact_shipment(lake: Lake, config: PipelineConfig, only_new: bool = False) -> int:
    """Partial upsert: a shipment already in the fact gets new delay and status
    only; its arrival date, quantity and cost stay as first written.

    Silver keeps the first write, so between runs with the same delay threshold no
    known shipment can change. ``only_new`` then gives the same table by adding the
    missing shipments, without comparing the rest.

    The fact is laid out by eta. New keys are given out after that shuffle, never before one
    that a lost task could repeat differently. Joined rows are written down before it: ranges
    are found by reading them once more, and the joins' shuffle files go first.
    """
    known = lake.exists("gold", "fact_shipment")
    shipments = lake.read("silver", "shipment_records")
    if known and only_new:
        shipments = without(shipments, lake.read("gold", "fact_shipment"), ["shipment_id"])
    rows = fact_rows(
        shipments,
        lake.read("silver", "purchase_orders"),
        lake.read("silver", "supplier_master"),
        lake.read("silver", "medicine_catalogue"),
        lake.read("gold", "dim_supplier"),
        lake.read("gold", "dim_medicine"),
        lake.read("gold", "dim_warehouse"),
        lake.read("gold", "dim_country"),
        lake.read("gold", "dim_date"),
        config.delay_threshold_days,
    )
    if known and not only_new:
        merge_fact(lake, rows)
    else:
        top = (lake.current_max("gold", "fact_shipment", "shipment_key") or 0) if known else None
        rows = lake.stage(rows, "fact_rows")
        added = upsert(None, by_eta(rows), "shipment_id", "shipment_key", FACT_UPDATES, top)
        before = lake.snapshot("gold", "fact_shipment")
        write = lake.append_to_current if known else lake.replace
        written = write(_laid_out(added), "gold", "fact_shipment", key="shipment_key", part=PART)
        write_sums(lake, before, written)
        lake.unstage("fact_rows")
    return lake.read("gold", "fact_shipment").count()


def load_all_gold(
    lake: Lake, config: PipelineConfig, only_new: bool = False
) -> dict[str, int]:
    """Dimensions first, the fact last."""
    return {
        "dim_date": load_dim_date(lake, config),
        "dim_country": load_dim_country(lake),
        "dim_supplier": load_dim_supplier(lake),
        "dim_medicine": load_dim_medicine(lake),
        "dim_warehouse": load_dim_warehouse(lake),
        "fact_shipment": load_fact_shipment(lake, config, only_new),
    }

"""Reporting views over the star schema and the questions dashboards ask.

Aggregates over the fact are computed on its integer keys first and joined to
dimension names afterwards, so the joins see one row per key combination instead
of one per shipment, and a hot key is combined in the map tasks. The scorecard and the
KPIs all merge one set of sums per supplier, country and month; the Gold load keeps
those sums beside the fact, so over a lake they are asked without scanning it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.config import PipelineConfig
from siltstone.functions.metrics import days_until, expiry_status, percent, stock_status
from siltstone.sources.lake import Lake


def shipment_details(
    fact: DataFrame,
    dim_supplier: DataFrame,
    dim_country: DataFrame,
    dim_medicine: DataFrame,
    dim_warehouse: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """One wide row per shipment. The arrival role of the calendar is a left join,
    so shipments in transit stay. The optimizer broadcasts what it finds small."""

    def role(name: str) -> DataFrame:
        return dim_date.alias(name)

    f = fact.alias("f")
    return (
        f.join(role("d_order"), F.col("d_order.date_key") == F.col("f.order_date_key"))
        .join(role("d_eta"), F.col("d_eta.date_key") == F.col("f.eta_date_key"))
        .join(role("d_arr"), F.col("d_arr.date_key") == F.col("f.actual_arrival_date_key"), "left")
        .join(dim_country.alias("c"), F.col("c.country_key") == F.col("f.country_key"))
        .join(dim_warehouse.alias("w"), F.col("w.warehouse_key") == F.col("f.warehouse_key"))
        .join(dim_supplier.alias("s"), F.col("s.supplier_key") == F.col("f.supplier_key"))
        .join(dim_medicine.alias("m"), F.col("m.medicine_key") == F.col("f.medicine_key"))
        .select(
            "f.shipment_key",
            "f.shipment_id",
            "s.supplier_name",
            "s.performance_tier",
            "c.country_name",
            "m.medicine_name",
            F.col("m.category").alias("medicine_category"),
            "w.warehouse_id",
            F.col("d_order.full_date").alias("order_date"),
            F.col("d_eta.full_date").alias("eta_date"),
            F.col("d_arr.full_date").alias("actual_arrival_date"),
            "f.quantity",
            "f.total_cost",
            "f.currency",
            "f.delay_days",
            "f.is_delayed",
            "f.status",
            F.col("d_eta.year").alias("eta_year"),
            F.col("d_eta.month").alias("eta_month"),
            F.col("d_eta.quarter").alias("eta_quarter"),
            F.col("d_eta.month_name").alias("eta_month_name"),
        )
    )


def sums(fact: DataFrame) -> DataFrame:
    """Mergeable sums per supplier, country and month of eta. Sums given are merged as they are."""
    if "arrived" in fact.columns:
        return fact
    return fact.groupBy("supplier_key", "country_key", F.expr("eta_date_key div 100").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_delayed").alias("late"),
        F.sum("delay_days").alias("days"),
        F.count("delay_days").alias("arrived"),
        F.sum("total_cost").cast("decimal(38,2)").alias("cost"),
    )


def sums_of(lake: Lake) -> DataFrame:
    """The sums kept beside the fact; those of the fact itself if they are not of its current
    state (a load died between the two)."""
    noted = lake.note("gold", "fact_summary", "fact")
    if noted is not None and noted == lake.snapshot("gold", "fact_shipment"):
        return lake.read("gold", "fact_summary")
    return sums(lake.read("gold", "fact_shipment"))


def supplier_performance(
    fact: DataFrame, dim_supplier: DataFrame, dim_country: DataFrame
) -> DataFrame:
    """Scorecard per supplier name, tier and country (same-named suppliers merge)."""
    per_key = sums(fact).groupBy("supplier_key", "country_key").agg(
        *[F.sum(c).alias(c) for c in ("n", "late", "days", "arrived", "cost")])
    named = per_key.join(
        dim_supplier.select("supplier_key", "supplier_name", "performance_tier"), "supplier_key"
    ).join(dim_country.select("country_key", "country_name"), "country_key")
    total, late = F.sum("n"), F.sum("late")
    mean = F.try_divide(
        F.sum("days").cast("decimal(20,0)"), F.sum("arrived").cast("decimal(20,0)"))
    return named.groupBy("supplier_name", "performance_tier", "country_name").agg(
        total.alias("total_shipments"),
        late.alias("delayed_shipments"),
        percent(late, total).alias("delay_rate_pct"),
        F.round(mean, 1).cast("double").alias("avg_delay_days"),
        F.sum("cost").alias("total_procurement_cost"),
    )


def supplier_table(performance: DataFrame) -> DataFrame:
    """The seven columns the dashboard table shows."""
    return performance.drop("avg_delay_days")


def medicine_expiry_risk(
    inventory: DataFrame, dim_medicine: DataFrame, as_of: Column, warning_days: int = 90
) -> DataFrame:
    left = days_until(F.col("expiry_date"), as_of)
    return inventory.join(
        dim_medicine.select("medicine_id", "medicine_name", "category"), "medicine_id"
    ).select(
        "warehouse_id",
        "medicine_name",
        "category",
        "batch_number",
        "quantity_on_hand",
        "expiry_date",
        left.alias("days_until_expiry"),
        expiry_status(left, warning_days).alias("expiry_status"),
    )


def stock_levels(inventory: DataFrame, minimum: int, maximum: int) -> DataFrame:
    """Stock against the configured lower and upper limits."""
    return inventory.select(
        "warehouse_id",
        "medicine_id",
        "batch_number",
        "quantity_on_hand",
        stock_status(F.col("quantity_on_hand"), minimum, maximum).alias("stock_status"),
    )


# -- KPIs --------------------------------------------------------------------


def kpi_totals(fact: DataFrame) -> DataFrame:
    """Headline figures. A shipment in transit counts as on time, and the rate is
    NULL (not an error) over no rows."""
    n, late = (F.coalesce(F.sum(c), F.lit(0).cast("long")) for c in ("n", "late"))
    return sums(fact).agg(
        n.alias("total_shipments"), late.alias("delayed_shipments"),
        F.sum("cost").alias("total_procurement_cost"),
        F.try_divide(n - late, n).alias("on_time_delivery_rate"))


def by_country(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Delayed shipments and procurement cost per country."""
    per_key = sums(fact).groupBy("country_key").agg(
        F.sum("late").alias("delayed_shipments"), F.sum("cost").alias("total_procurement_cost"))
    return per_key.join(dim_country, "country_key").select(
        "country_name", "delayed_shipments", "total_procurement_cost")


def delayed_by_country(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    return (
        by_country(fact, dim_country)
        .select("country_name", "delayed_shipments")
        .orderBy(F.desc("delayed_shipments"), "country_name")
    )


def cost_by_country(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    return (
        by_country(fact, dim_country)
        .select("country_name", "total_procurement_cost")
        .orderBy(F.desc("total_procurement_cost"), "country_name")
    )


def volume_by_month(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Shipments per month of their eta, in calendar order."""
    return (
        sums(fact).groupBy(F.expr("month div 100").cast("int").alias("eta_year"),
                           (F.col("month") % 100).cast("int").alias("eta_month"))
        .agg(F.sum("n").alias("total_shipments"))
        .orderBy("eta_year", "eta_month")
    )


def quarter_filter(fact: DataFrame, year: int, quarter: int) -> DataFrame:
    """Fact rows whose eta lies in a quarter, as a key range the scan can prune on."""
    first = year * 10000 + (3 * quarter - 2) * 100
    return fact.filter(F.col("eta_date_key").between(first + 1, first + 231))


def shipments_by_supplier(fact: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    per_key = sums(fact).groupBy("supplier_key").agg(F.sum("n").alias("total_shipments"))
    return per_key.join(dim_supplier, "supplier_key").select("supplier_id", "total_shipments")


# -- over a lake -------------------------------------------------------------


def details_of(lake: Lake, fact: DataFrame | None = None) -> DataFrame:
    g = lambda t: lake.read("gold", t)
    return shipment_details(
        g("fact_shipment") if fact is None else fact, g("dim_supplier"), g("dim_country"),
        g("dim_medicine"), g("dim_warehouse"), g("dim_date"))


def delayed_in_quarter(lake: Lake, year: int, quarter: int) -> DataFrame:
    fact = quarter_filter(lake.read("gold", "fact_shipment"), year, quarter)
    return details_of(lake, fact.filter("is_delayed"))


def performance_of(lake: Lake) -> DataFrame:
    return supplier_performance(
        sums_of(lake), lake.read("gold", "dim_supplier"), lake.read("gold", "dim_country"))


def expiry_of(lake: Lake, config: PipelineConfig, as_of: Column | None = None) -> DataFrame:
    return medicine_expiry_risk(
        lake.read("silver", "warehouse_inventory"), lake.read("gold", "dim_medicine"),
        F.current_date() if as_of is None else as_of, config.expiry_warning_days)


def register_views(lake: Lake, config: PipelineConfig, as_of: Column | None = None) -> None:
    """Make the three views available to SQL under their fixed names. They follow
    every later change of the Silver and Gold tables made through this lake."""

    def refresh() -> None:
        details_of(lake).createOrReplaceTempView("vw_shipment_details")
        performance_of(lake).createOrReplaceTempView("vw_supplier_performance")
        expiry_of(lake, config, as_of).createOrReplaceTempView("vw_medicine_expiry_risk")

    refresh()
    lake.on_change = [f for f in lake.on_change if f.__qualname__ != refresh.__qualname__]
    lake.on_change.append(refresh)

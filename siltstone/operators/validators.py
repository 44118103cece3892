"""Rules and typed columns per source.

Rule ids, their order within a source and the message wording are fixed values:
quarantine readers depend on them.

A row is judged in three projections, so that each value is stripped once and
parsed once however many rules and columns use it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.config import SOURCES
from siltstone.functions.text import (
    fits_int,
    is_empty,
    is_negative,
    strip,
    to_date,
    to_decimal,
    to_int,
)
from siltstone.operators.rules import Rule, explanation, first_failure, quote

raw = F.col


def text(column: str) -> Column:
    return F.col(f"_text_{column}")


def value(column: str) -> Column:
    return F.col(f"_value_{column}")


def key_column(column: str) -> str:
    return f"_key_{column}"


def orphan_flag(column: str) -> str:
    return f"_orphan_{column}"


@dataclass(frozen=True)
class Validator:
    """``parsers`` turn stripped text into a value; ``typed`` names the Silver
    columns in order, each taken from the parsed value if there is one."""

    parsers: dict[str, Callable[[Column], Column]]
    rules: Callable[[], list[Rule]]
    typed: Callable[[], dict[str, Column]]


def _required(*columns: str) -> list[Rule]:
    return [
        Rule("VR-10", is_empty(text(c)), F.lit(f"Required field '{c}' is missing or blank"))
        for c in columns
    ]


def _orphan(column: str, parent: str) -> Rule:
    return Rule(
        "VR-02",
        F.col(orphan_flag(column)),
        quote(f"{column} '", raw(column), f"' does not exist in silver.{parent}"),
    )


def _bad(rule_id: str, column: str, failed: Column, what: str) -> Rule:
    return Rule(rule_id, failed, quote(f"{column} '", raw(column), f"' is not a valid {what}"))


def _not_positive(column: str) -> Column:
    return ~fits_int(value(column)) | (value(column) <= 0)


def _supplier_rules() -> list[Rule]:
    return [
        *_required("supplier_id", "supplier_name", "country", "contract_start_date",
                   "performance_tier"),
        _bad("VR-10", "contract_start_date", value("contract_start_date").isNull(), "date"),
    ]


def _supplier_columns() -> dict[str, Column]:
    return {
        "supplier_id": text("supplier_id"),
        "supplier_name": text("supplier_name"),
        "country": text("country"),
        "contact_email": F.nullif(text("contact_email"), F.lit("")),  # VR-01: may be blank
        "contract_start_date": value("contract_start_date"),
        "performance_tier": text("performance_tier"),
    }


def _medicine_rules() -> list[Rule]:
    return [
        *_required("medicine_id", "medicine_name", "category", "unit_of_measure",
                   "shelf_life_days"),
        _bad("VR-03", "shelf_life_days", _not_positive("shelf_life_days"), "positive integer"),
    ]


def _medicine_columns() -> dict[str, Column]:
    return {
        "medicine_id": text("medicine_id"),
        "medicine_name": text("medicine_name"),
        "category": text("category"),
        "unit_of_measure": text("unit_of_measure"),
        "shelf_life_days": value("shelf_life_days").try_cast("int"),
    }


def _order_rules() -> list[Rule]:
    bad_cost = value("total_cost").isNull() | is_negative(text("total_cost"))
    return [
        *_required("po_id", "supplier_id", "medicine_id", "order_date", "quantity", "total_cost",
                   "currency"),
        _orphan("supplier_id", "supplier_master"),
        _orphan("medicine_id", "medicine_catalogue"),
        _bad("VR-03", "order_date", value("order_date").isNull(), "date"),
        _bad("VR-03", "quantity", _not_positive("quantity"), "positive integer"),
        _bad("VR-03", "total_cost", bad_cost, "non-negative number"),
    ]


def _order_columns() -> dict[str, Column]:
    return {
        "po_id": text("po_id"),
        "supplier_id": text("supplier_id"),
        "medicine_id": text("medicine_id"),
        "order_date": value("order_date"),
        "quantity": value("quantity").try_cast("int"),
        "total_cost": value("total_cost"),
        "currency": text("currency"),
    }


def _shipment_rules() -> list[Rule]:
    eta, arrival = value("eta"), value("actual_arrival")
    return [
        *_required("shipment_id", "po_id", "warehouse_id", "eta", "transport_company", "status"),
        _orphan("po_id", "purchase_orders"),
        _bad("VR-04", "eta", eta.isNull(), "date"),
        Rule(
            "VR-04",
            ~is_empty(text("actual_arrival")) & arrival.isNull(),
            quote("actual_arrival '", text("actual_arrival"),
                  "' is present but not a valid date"),
        ),
        Rule(
            "VR-06",
            arrival < eta,
            F.concat(F.lit("actual_arrival '"), arrival.cast("string"), F.lit("' is before eta '"),
                     eta.cast("string"), F.lit("'")),
        ),
    ]


def _shipment_columns() -> dict[str, Column]:
    return {
        "shipment_id": text("shipment_id"),
        "po_id": text("po_id"),
        "warehouse_id": text("warehouse_id"),
        "eta": value("eta"),
        "actual_arrival": value("actual_arrival"),  # VR-05: blank means in transit
        "transport_company": text("transport_company"),
        "status": text("status"),
    }


def _inventory_rules() -> list[Rule]:
    on_hand = value("quantity_on_hand")
    too_big = ~fits_int(on_hand) & (on_hand > 0)
    return [
        *_required("warehouse_id", "medicine_id", "quantity_on_hand", "expiry_date",
                   "batch_number"),
        _orphan("medicine_id", "medicine_catalogue"),
        _bad("VR-08", "quantity_on_hand", on_hand.isNull() | too_big, "integer"),
        Rule("VR-07", on_hand < 0, quote("quantity_on_hand ", on_hand, " is negative")),
        _bad("VR-08", "expiry_date", value("expiry_date").isNull(), "date"),
    ]


def _inventory_columns() -> dict[str, Column]:
    return {
        "warehouse_id": text("warehouse_id"),
        "medicine_id": text("medicine_id"),
        "batch_number": text("batch_number"),
        "quantity_on_hand": value("quantity_on_hand").try_cast("int"),
        "expiry_date": value("expiry_date"),
    }


VALIDATORS: dict[str, Validator] = {
    "supplier_master": Validator(
        {"contract_start_date": to_date}, _supplier_rules, _supplier_columns),
    "medicine_catalogue": Validator(
        {"shelf_life_days": to_int}, _medicine_rules, _medicine_columns),
    "purchase_orders": Validator(
        {"order_date": to_date, "quantity": to_int, "total_cost": to_decimal},
        _order_rules, _order_columns),
    "shipment_records": Validator(
        {"eta": to_date, "actual_arrival": to_date}, _shipment_rules, _shipment_columns),
    "warehouse_inventory": Validator(
        {"quantity_on_hand": to_int, "expiry_date": to_date},
        _inventory_rules, _inventory_columns),
}


def stripped(df: DataFrame, source: str) -> DataFrame:
    """Add every source column without its outer white space."""
    return df.withColumns({f"_text_{c}": strip(c) for c in SOURCES[source].columns})


def parsed(df: DataFrame, source: str) -> DataFrame:
    """Add the parsed values to a stripped frame."""
    parsers = VALIDATORS[source].parsers
    return df.withColumns({f"_value_{c}": parse(text(c)) for c, parse in parsers.items()})


def judged(df: DataFrame, source: str, into: str = "_failed") -> DataFrame:
    """Add parsed values and the verdict to a stripped frame; the reference flags
    (see membership) must already be there."""
    return parsed(df, source).withColumn(into, first_failure(VALIDATORS[source].rules()))


def explained(rejected: DataFrame, source: str, verdict: str = "_failed") -> DataFrame:
    """Add ``rule_id`` and ``rule_description`` to rejected rows, from their raw
    columns and the verdict alone."""
    df = parsed(stripped(rejected, source), source)
    rule_id, message = explanation(VALIDATORS[source].rules(), F.col(verdict))
    return df.select("*", rule_id, message)


def typed_columns(source: str) -> dict[str, Column]:
    """Silver columns of a judged frame; meaningful where no rule failed."""
    return VALIDATORS[source].typed()

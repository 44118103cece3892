"""One passing and one failing row per rule, and the order of rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltstone.config import SOURCES
from siltstone.operators.validators import explained, judged, orphan_flag, stripped, typed_columns

GOOD = {
    "supplier_master": dict(supplier_id=" S1 ", supplier_name="Acme", country="KE",
                            contact_email="a@x.org", contract_start_date="2024-01-01",
                            performance_tier="A"),
    "medicine_catalogue": dict(medicine_id="M1", medicine_name="n", category="c",
                               unit_of_measure="u", shelf_life_days="30"),
    "purchase_orders": dict(po_id="P1", supplier_id="S1", medicine_id="M1",
                            order_date="2024-01-02", quantity="5", total_cost="10.005",
                            currency="USD"),
    "shipment_records": dict(shipment_id="H1", po_id="P1", warehouse_id="W1", eta="2024-02-01",
                             actual_arrival="2024-02-03", transport_company="t", status="ok"),
    "warehouse_inventory": dict(warehouse_id="W1", medicine_id="M1", quantity_on_hand="0",
                                expiry_date="2024-06-01", batch_number="B1"),
}


def verdicts(spark, source, cases):
    """(rule, message) or None for each (unknown references, changed columns), in one
    query over all of them."""
    spec = SOURCES[source]
    refs = [r.column for r in spec.references]
    rows = [
        (i, *[{**GOOD[source], **changes}[c] for c in spec.columns], *[r in unknown for r in refs])
        for i, (unknown, changes) in enumerate(cases)
    ]
    schema = ["i int", *[f"{c} string" for c in spec.columns],
              *[f"{orphan_flag(r)} boolean" for r in refs]]
    df = spark.createDataFrame(rows, ", ".join(schema))
    decided = judged(stripped(df, source), source).select("i", *spec.columns, "_failed")
    got = explained(decided, source).orderBy("i").collect()
    return [None if r._failed is None else (r.rule_id, r.rule_description) for r in got]


REQUIRED = {
    "supplier_master": ["supplier_id", "supplier_name", "country", "contract_start_date",
                        "performance_tier"],
    "medicine_catalogue": list(SOURCES["medicine_catalogue"].columns),
    "purchase_orders": list(SOURCES["purchase_orders"].columns),
    "shipment_records": ["shipment_id", "po_id", "warehouse_id", "eta", "transport_company",
                         "status"],
    "warehouse_inventory": list(SOURCES["warehouse_inventory"].columns),
}


@pytest.mark.parametrize("source", list(REQUIRED))
def test_required_fields_and_a_good_row(spark, source):
    cases, want = [((), {})], [None]
    for column in REQUIRED[source]:
        for blank in ("", " \t", None):
            cases.append(((), {column: blank}))
            want.append(("VR-10", f"Required field '{column}' is missing or blank"))
    assert verdicts(spark, source, cases) == want


def by_source(cases):
    out = {}
    for source, *rest in cases:
        out.setdefault(source, []).append(rest)
    return out


FAILING = [
    ("supplier_master", (), dict(contract_start_date="soon"), "VR-10",
     "contract_start_date 'soon' is not a valid date"),
    ("medicine_catalogue", (), dict(shelf_life_days="5.0"), "VR-03",
     "shelf_life_days '5.0' is not a valid positive integer"),
    ("medicine_catalogue", (), dict(shelf_life_days="0"), "VR-03",
     "shelf_life_days '0' is not a valid positive integer"),
    ("medicine_catalogue", (), dict(shelf_life_days="3000000000"), "VR-03",
     "shelf_life_days '3000000000' is not a valid positive integer"),
    ("purchase_orders", ("supplier_id",), dict(supplier_id=" S9"), "VR-02",
     "supplier_id ' S9' does not exist in silver.supplier_master"),
    ("purchase_orders", ("medicine_id",), {}, "VR-02",
     "medicine_id 'M1' does not exist in silver.medicine_catalogue"),
    ("purchase_orders", (), dict(order_date="x"), "VR-03", "order_date 'x' is not a valid date"),
    ("purchase_orders", (), dict(quantity="-1"), "VR-03",
     "quantity '-1' is not a valid positive integer"),
    ("purchase_orders", (), dict(total_cost="n/a"), "VR-03",
     "total_cost 'n/a' is not a valid non-negative number"),
    ("purchase_orders", (), dict(total_cost="-0.001"), "VR-03",
     "total_cost '-0.001' is not a valid non-negative number"),
    ("shipment_records", ("po_id",), {}, "VR-02",
     "po_id 'P1' does not exist in silver.purchase_orders"),
    ("shipment_records", (), dict(eta="bad"), "VR-04", "eta 'bad' is not a valid date"),
    ("shipment_records", (), dict(actual_arrival=" bad "), "VR-04",
     "actual_arrival 'bad' is present but not a valid date"),
    ("shipment_records", (), dict(actual_arrival="2024-1-31"), "VR-06",
     "actual_arrival '2024-01-31' is before eta '2024-02-01'"),
    ("warehouse_inventory", ("medicine_id",), {}, "VR-02",
     "medicine_id 'M1' does not exist in silver.medicine_catalogue"),
    ("warehouse_inventory", (), dict(quantity_on_hand="x"), "VR-08",
     "quantity_on_hand 'x' is not a valid integer"),
    ("warehouse_inventory", (), dict(quantity_on_hand=" -3"), "VR-07",
     "quantity_on_hand -3 is negative"),
    ("warehouse_inventory", (), dict(quantity_on_hand="-99999999999"), "VR-07",
     "quantity_on_hand -99999999999 is negative"),
    ("warehouse_inventory", (), dict(expiry_date="2001-02-30"), "VR-08",
     "expiry_date '2001-02-30' is not a valid date"),
]


def test_each_rule(spark):
    for source, cases in by_source(FAILING).items():
        got = verdicts(spark, source, [(unknown, change) for unknown, change, _, _ in cases])
        assert got == [(rule, message) for _, _, rule, message in cases]


ACCEPTED = [
    ("supplier_master", dict(contact_email="")), ("supplier_master", dict(contact_email=None)),
    ("shipment_records", dict(actual_arrival=" ")),
    ("shipment_records", dict(actual_arrival=None)),
    ("shipment_records", dict(actual_arrival="2024-02-01")),
    ("purchase_orders", dict(total_cost="0")), ("purchase_orders", dict(total_cost="-0")),
]


def test_acceptable_gaps(spark):
    for source, cases in by_source(ACCEPTED).items():
        got = verdicts(spark, source, [((), change) for (change,) in cases])
        assert set(got) == {None}


TWO_DEFECTS = [
    ("purchase_orders", ("supplier_id",), dict(currency=""), "VR-10", "Required"),
    ("purchase_orders", ("supplier_id", "medicine_id"), dict(quantity="x"), "VR-02", "supplier"),
    ("purchase_orders", ("medicine_id",), dict(order_date="x"), "VR-02", "medicine"),
    ("purchase_orders", (), dict(order_date="x", quantity="x"), "VR-03", "order_date"),
    ("purchase_orders", (), dict(quantity="x", total_cost="x"), "VR-03", "quantity"),
    ("shipment_records", ("po_id",), dict(eta="x"), "VR-02", "po_id"),
    ("shipment_records", (), dict(eta="x", actual_arrival="x"), "VR-04", "eta"),
    ("warehouse_inventory", (), dict(quantity_on_hand="-1", expiry_date="x"), "VR-07", "quant"),
]


def test_first_failing_rule_wins(spark):
    for source, cases in by_source(TWO_DEFECTS).items():
        got = verdicts(spark, source, [(unknown, change) for unknown, change, _, _ in cases])
        for (rule, message), (_, _, want, start) in zip(got, cases):
            assert rule == want and message.startswith(start)


def typed(spark, source, **changes):
    spec = SOURCES[source]
    row = {**GOOD[source], **changes}
    df = spark.createDataFrame([tuple(row[c] for c in spec.columns)],
                               ", ".join(f"{c} string" for c in spec.columns))
    for ref in spec.references:
        df = df.withColumn(orphan_flag(ref.column), F.lit(False))
    return judged(stripped(df, source), source).select(
        *[col.alias(name) for name, col in typed_columns(source).items()]).first()


def test_typed_columns(spark):
    assert tuple(typed(spark, "purchase_orders")) == (
        "P1", "S1", "M1", dt.date(2024, 1, 2), 5, Decimal("10.01"), "USD")


def test_optional_blank_becomes_null_and_keys_are_stripped(spark):
    got = typed(spark, "supplier_master", contact_email="  ")
    assert got.supplier_id == "S1" and got.contact_email is None

"""Thresholds, source registry and table layouts."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path

DEFAULT_CONFIG = Path(__file__).resolve().parent.parent / "conf" / "pipeline.yaml"


@dataclass(frozen=True)
class Reference:
    """``column`` must name an existing ``parent_key`` of Silver table ``parent``."""

    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class SourceSpec:
    """One delivered source and where its rows go.

    ``first_by`` orders copies of one natural key inside a load: the first one is
    kept. The default is landing order. ``bucketed`` tables grow without end: Silver keeps
    them in buckets of the natural key.
    """

    name: str
    columns: tuple[str, ...]
    natural_key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    file_format: str = "csv"
    path: str = ""
    first_by: tuple[str, ...] = ("bronze_id",)
    options: dict[str, str] = field(default_factory=dict)
    bronze_name: str = ""
    bucketed: bool = False

    @property
    def bronze_table(self) -> str:
        return self.bronze_name or f"{self.name}_raw"

    @property
    def silver_table(self) -> str:
        return self.name

    @property
    def bronze_schema(self) -> str:
        return ", ".join(
            ["bronze_id BIGINT"]
            + [f"{c} STRING" for c in self.columns]
            + ["ingested_at TIMESTAMP", "source_file STRING", "run_id STRING"]
        )


# The five sources in load order (parents first), with the column
# names, natural keys and references the data model prescribes.
SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec(
            "supplier_master",
            ("supplier_id", "supplier_name", "country", "contact_email", "contract_start_date",
             "performance_tier"),
            ("supplier_id",),
        ),
        SourceSpec(
            "medicine_catalogue",
            ("medicine_id", "medicine_name", "category", "unit_of_measure", "shelf_life_days"),
            ("medicine_id",),
        ),
        SourceSpec(
            "purchase_orders",
            ("po_id", "supplier_id", "medicine_id", "order_date", "quantity", "total_cost",
             "currency"),
            ("po_id",),
            (
                Reference("supplier_id", "supplier_master", "supplier_id"),
                Reference("medicine_id", "medicine_catalogue", "medicine_id"),
            ),
            file_format="json",
            bucketed=True,
        ),
        SourceSpec(
            "shipment_records",
            ("shipment_id", "po_id", "warehouse_id", "eta", "actual_arrival",
             "transport_company", "status"),
            ("shipment_id",),
            (Reference("po_id", "purchase_orders", "po_id"),),
            file_format="json",
            bucketed=True,
        ),
        SourceSpec(
            "warehouse_inventory",
            ("warehouse_id", "medicine_id", "quantity_on_hand", "expiry_date", "batch_number"),
            ("warehouse_id", "medicine_id", "batch_number"),
            (Reference("medicine_id", "medicine_catalogue", "medicine_id"),),
            bucketed=True,
        ),
    )
}

# Typed table layouts.
SILVER_SCHEMAS = {
    "supplier_master": "supplier_id STRING, supplier_name STRING, country STRING, "
    "contact_email STRING, contract_start_date DATE, performance_tier STRING, "
    "bronze_id BIGINT, validated_at TIMESTAMP",
    "medicine_catalogue": "medicine_id STRING, medicine_name STRING, category STRING, "
    "unit_of_measure STRING, shelf_life_days INT, bronze_id BIGINT, validated_at TIMESTAMP",
    "purchase_orders": "po_id STRING, supplier_id STRING, medicine_id STRING, order_date DATE, "
    "quantity INT, total_cost DECIMAL(12,2), currency STRING, bronze_id BIGINT, "
    "validated_at TIMESTAMP",
    "shipment_records": "shipment_id STRING, po_id STRING, warehouse_id STRING, eta DATE, "
    "actual_arrival DATE, transport_company STRING, status STRING, bronze_id BIGINT, "
    "validated_at TIMESTAMP",
    "warehouse_inventory": "warehouse_id STRING, medicine_id STRING, batch_number STRING, "
    "quantity_on_hand INT, expiry_date DATE, bronze_id BIGINT, validated_at TIMESTAMP",
    "quarantine": "quarantine_id BIGINT, source_name STRING, target_table STRING, "
    "rule_id STRING, rule_description STRING, row_data STRING, bronze_id BIGINT, "
    "run_id STRING, quarantined_at TIMESTAMP",
    "load_log": "run_id STRING, source STRING, rows_passed BIGINT, rows_quarantined BIGINT, "
    "rows_skipped_duplicate BIGINT, loaded_at TIMESTAMP, bronze_runs ARRAY<STRING>, "
    "first_day DATE, last_day DATE",
}

#: Silver dates that the calendar has to hold.
CALENDAR_DATES = {"purchase_orders": ("order_date",), "shipment_records": ("eta", "actual_arrival")}

GOLD_SCHEMAS = {
    "dim_date": "date_key INT, full_date DATE, day_of_month INT, month INT, month_name STRING, "
    "quarter INT, year INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN",
    "dim_country": "country_key BIGINT, country_name STRING, risk_tier STRING",
    "dim_supplier": "supplier_key BIGINT, supplier_id STRING, supplier_name STRING, "
    "country_key BIGINT, performance_tier STRING",
    "dim_medicine": "medicine_key BIGINT, medicine_id STRING, medicine_name STRING, "
    "category STRING, unit_of_measure STRING, shelf_life_days INT",
    "dim_warehouse": "warehouse_key BIGINT, warehouse_id STRING, region STRING, "
    "country_key BIGINT",
    "fact_shipment": "shipment_key BIGINT, shipment_id STRING, supplier_key BIGINT, "
    "medicine_key BIGINT, warehouse_key BIGINT, country_key BIGINT, order_date_key INT, "
    "eta_date_key INT, actual_arrival_date_key INT, quantity INT, total_cost DECIMAL(12,2), "
    "currency STRING, delay_days INT, is_delayed BOOLEAN, status STRING",
    "fact_summary": "supplier_key BIGINT, country_key BIGINT, month INT, n BIGINT, late BIGINT, "
    "days BIGINT, arrived BIGINT, cost DECIMAL(38,2)",
}

BRONZE_LOG_SCHEMA = (
    "run_id STRING, source STRING, bronze_table STRING, rows_loaded BIGINT, "
    "min_bronze_id BIGINT, max_bronze_id BIGINT, ingested_at TIMESTAMP"
)

BAD_RECORDS_SCHEMA = "run_id STRING, source STRING, source_file STRING, line BIGINT, record STRING"

CHECK_SCHEMA = (
    "check_category STRING, check_id STRING, description STRING, status STRING, "
    "severity STRING, details STRING"
)
CHECK_RESULTS_SCHEMA = (
    f"check_result_id BIGINT, run_id STRING, {CHECK_SCHEMA}, checked_at TIMESTAMP"
)


def table_schema(layer: str, table: str) -> str:
    if layer == "bronze":
        if table == "load_log":
            return BRONZE_LOG_SCHEMA
        if table == "bad_records":
            return BAD_RECORDS_SCHEMA
        return SOURCES[table.removesuffix("_raw")].bronze_schema
    if layer == "silver":
        return SILVER_SCHEMAS[table]
    if layer == "gold":
        return GOLD_SCHEMAS[table]
    return {"check_results": CHECK_RESULTS_SCHEMA}[table]


@dataclass(frozen=True)
class PipelineConfig:
    delay_threshold_days: int = 3
    expiry_warning_days: int = 90
    min_stock_units: int = 100
    max_stock_units: int = 10000
    freshness_max_age_hours: float = 26
    row_count_deviation_threshold_pct: float = 30
    calendar_start_year: int = 2023
    calendar_end_year: int = 2027
    sources: tuple[SourceSpec, ...] = tuple(SOURCES.values())


def load_config(path: str | Path = DEFAULT_CONFIG) -> PipelineConfig:
    """Read a YAML or JSON settings file; a missing file raises FileNotFoundError.

    A source the registry does not list may name its own ``columns`` and
    ``natural_key``, so a new delivery needs settings only.
    """
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"Pipeline config not found at '{path}'")
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        raw = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - depends on the image
            raise ImportError("PyYAML is needed for YAML settings; use a .json file") from e
        raw = yaml.safe_load(text)
    base = PipelineConfig()
    stock, quality = raw.get("inventory_thresholds", {}), raw.get("data_quality", {})
    calendar = raw.get("calendar", {})
    return PipelineConfig(
        delay_threshold_days=raw.get("shipment_delay", {}).get(
            "delay_threshold_days", base.delay_threshold_days),
        expiry_warning_days=raw.get("medicine_expiry", {}).get(
            "expiry_warning_days", base.expiry_warning_days),
        min_stock_units=stock.get("default_min_stock_units", base.min_stock_units),
        max_stock_units=stock.get("default_max_stock_units", base.max_stock_units),
        freshness_max_age_hours=quality.get(
            "freshness_max_age_hours", base.freshness_max_age_hours),
        row_count_deviation_threshold_pct=quality.get(
            "row_count_deviation_threshold_pct", base.row_count_deviation_threshold_pct),
        calendar_start_year=calendar.get("start_year", base.calendar_start_year),
        calendar_end_year=calendar.get("end_year", base.calendar_end_year),
        sources=tuple(_source(s) for s in raw.get("internal_sources", [])) or base.sources,
    )


def _source(entry: dict) -> SourceSpec:
    name = entry["name"]
    spec = SOURCES.get(name) or SourceSpec(
        name, tuple(entry["columns"]), tuple(entry["natural_key"]))
    return replace(
        spec,
        file_format=entry["file_format"],
        path=entry["path"],
        options={k: str(v) for k, v in entry.get("options", {}).items()},
        bronze_name=entry.get("bronze_table", ""),
    )

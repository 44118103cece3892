"""A lake filled on demand from the provided tables, shared by the queries of one
Spark application. Each layer is written once and read by whatever needs it."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.plans import gold, quality, silver
from siltstone.sources import testdata
from siltstone.sources.bronze import land
from siltstone.sources.lake import Lake, work_root

# Around noon, so that the day is the same in most session time zones.
LANDED_AT = datetime(1998, 1, 1, 12, tzinfo=timezone.utc)
CHECKED_AT = datetime(1998, 1, 1, 13, tzinfo=timezone.utc)
LANDING_RUN, SILVER_RUN, QUALITY_RUN = "landing-1", "silver-1", "quality-1"
SECOND = "-again"

_open: dict[tuple[str, str, str], Workspace] = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, variant: str = "main"):
        self.spark, self.sf_dir = spark, sf_dir
        self.config = testdata.CONFIG
        tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
        app = spark.sparkContext.applicationId
        self.lake = Lake(spark, f"{work_root(spark)}/siltstone-{app}/{tag}-{variant}")
        self._done: set[str] = set()
        self.last_run = None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, variant: str = "main") -> Workspace:
        key = (spark.sparkContext.applicationId, sf_dir, variant)
        if key not in _open:
            _open[key] = cls(spark, sf_dir, variant)
        return _open[key]

    def _once(self, step: str) -> bool:
        if step in self._done:
            return False
        self._done.add(step)
        return True

    def spec(self, name: str):
        return next(s for s in self.config.sources if s.name == name)

    # -- layers --------------------------------------------------------------

    def land(self, name: str, run_id: str = LANDING_RUN) -> None:
        if self._once(f"bronze/{name}/{run_id}"):
            rows = testdata.delivery(self.spark, self.sf_dir, name)
            land(self.lake, rows, self.spec(name), run_id, ingested_at=LANDED_AT)

    def load(self, name: str, run_id: str = SILVER_RUN, **options) -> None:
        spec = self.spec(name)
        for ref in spec.references:
            self.load(ref.parent, **options)
        self.land(name)
        if self._once(f"silver/{name}/{run_id}"):
            silver.load_silver(self.lake, spec, run_id, LANDED_AT, **options)

    def load_again(self, name: str) -> None:
        """The same delivery once more, then a second load over both."""
        for ref in self.spec(name).references:
            self.load_again(ref.parent)
        self.load(name)
        self.land(name, LANDING_RUN + SECOND)
        if self._once(f"silver/{name}/{SILVER_RUN + SECOND}"):
            silver.load_silver(self.lake, self.spec(name), SILVER_RUN + SECOND, LANDED_AT)

    def bronze(self, name: str) -> DataFrame:
        self.land(name)
        spec = self.spec(name)
        return self.lake.read("bronze", spec.bronze_table, spec.bronze_schema)

    def silver(self, name: str) -> DataFrame:
        self.load(name)
        return self.lake.read("silver", name)

    def all_silver(self) -> None:
        for s in self.config.sources:
            self.load(s.name)

    def quarantine(self) -> DataFrame:
        self.all_silver()
        return self.lake.read("silver", "quarantine")

    def gold(self, table: str) -> DataFrame:
        if table == "dim_date":
            self.load("shipment_records")  # and the orders it refers to
            build = lambda: gold.load_dim_date(self.lake, self.config)
        elif table == "dim_country":
            self.load("supplier_master")
            build = lambda: gold.load_dim_country(self.lake)
        elif table == "dim_supplier":
            self.gold("dim_country")
            build = lambda: gold.load_dim_supplier(self.lake)
        elif table == "dim_medicine":
            self.load("medicine_catalogue")
            build = lambda: gold.load_dim_medicine(self.lake)
        elif table == "dim_warehouse":
            self.load("shipment_records")
            build = lambda: gold.load_dim_warehouse(self.lake)
        else:
            for dim in ("dim_date", "dim_country", "dim_supplier", "dim_medicine",
                        "dim_warehouse"):
                self.gold(dim)
            build = lambda: gold.load_fact_shipment(self.lake, self.config)
        if self._once(f"gold/{table}"):
            build()
        return self.lake.read("gold", table)

    def star(self) -> None:
        self.gold("fact_shipment")

    def checks(self) -> DataFrame:
        self.all_silver()
        self.star()
        if self._once("quality"):
            quality.run_checks(self.lake, self.config, QUALITY_RUN, CHECKED_AT)
        return quality.results_of(self.lake, QUALITY_RUN)

    def ingest_log(self) -> DataFrame:
        """One row per landed record, a run per day (read straight from the table)."""
        return testdata.delivery(self.spark, self.sf_dir, "ingest_log")

    @staticmethod
    def as_of() -> F.Column:
        return F.lit("1998-01-01").cast("date")

"""Wall time of the pipeline stages and the headline queries, as one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Stages
write their layer; queries read the written tables and are run to completion
without collecting (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from siltstone.plans.workspace import Workspace  # noqa: E402
from siltstone.queries import QUERIES  # noqa: E402

HEADLINE = [
    "quarantine_by_rule", "quarantine_rows", "silver_outcomes", "vw_shipment_details",
    "vw_supplier_performance", "vw_medicine_expiry_risk", "kpi_totals", "delayed_by_country",
    "cost_by_country", "volume_by_month", "shipments_by_supplier", "delayed_in_quarter",
    "stock_levels", "fact_partial_upsert", "check_freshness", "check_row_count_deviation",
    "check_uniqueness_silver", "check_consistency", "constraints_null", "constraints_check",
    "constraints_unique", "constraints_fk",
]
DIMENSIONS = ["dim_date", "dim_country", "dim_supplier", "dim_medicine", "dim_warehouse"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siltstone-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK_DIR", "/tmp/checkpoints"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before timing
    w = Workspace.of(spark, sf_dir)
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    for s in w.config.sources:
        timed(f"land_{s.name}", lambda n=s.name: w.land(n))
    for s in w.config.sources:
        timed(f"load_{s.name}", lambda n=s.name: w.load(n))
    for d in [*DIMENSIONS, "fact_shipment"]:
        timed(f"build_{d}", lambda t=d: w.gold(t))
    timed("run_checks", w.checks)
    for name in HEADLINE:
        timed(name, lambda n=name: QUERIES[n](spark, sf_dir).write.format("noop").mode(
            "overwrite").save())
    print(json.dumps({
        "metric": "pipeline and headline query wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "lineitem_rows": spark.read.parquet(f"{sf_dir}/lineitem.parquet").count(),
        "spark": spark.version,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()

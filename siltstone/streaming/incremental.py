"""Silver load as a stream over the landing log: each micro-batch is the landings that
were completed since the last.

Bronze files of a landing that died are never read. A batch may be replayed after a
failure; the load leaves out rows that already have an outcome, so a replay adds
nothing twice.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.config import BRONZE_LOG_SCHEMA, SourceSpec
from siltstone.plans.silver import load_silver
from siltstone.sources.lake import Lake


def stream_silver(
    lake: Lake,
    spec: SourceSpec,
    run_id: str,
    at: datetime | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load everything landed and not yet seen, then stop (``availableNow``)."""
    reader = lake.spark.readStream.schema(BRONZE_LOG_SCHEMA)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def load(batch: DataFrame, batch_id: int) -> None:
        landed = batch.filter(F.col("bronze_table") == spec.bronze_table).select(
            "run_id", "min_bronze_id").collect()  # a row per landing of this batch
        if not landed:
            return
        runs = sorted(r.run_id for r in landed)
        first = min((r.min_bronze_id for r in landed if r.min_bronze_id is not None), default=None)
        load_silver(lake, spec, f"{run_id}-{batch_id}", at, runs=runs, first_id=first)

    return (
        reader.parquet(lake.path("bronze", "load_log"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{lake.root}/_streams/{spec.silver_table}")
        .trigger(availableNow=True)
        .start()
    )

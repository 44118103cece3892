"""The whole chain: files to Bronze to Silver to Gold, then the checks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from siltstone.config import PipelineConfig
from siltstone.plans.gold import load_all_gold
from siltstone.plans.quality import run_checks
from siltstone.plans.silver import LoadCounts, load_all_silver
from siltstone.sources.bronze import ingest_all
from siltstone.sources.lake import Lake


@dataclass(frozen=True)
class PipelineRun:
    """The three run ids are independent: rows carry the one of their own stage."""

    extraction_run_id: str
    silver_run_id: str
    quality_run_id: str
    landed: DataFrame
    silver: dict[str, LoadCounts]
    gold: dict[str, int]
    checks: DataFrame


def run_pipeline(
    lake: Lake, config: PipelineConfig, at: datetime | None = None, incremental: bool = False
) -> PipelineRun:
    """Every stage needs the one before it, so they run in order.

    ``incremental`` reads only new deliveries and adds only new facts, for runs
    whose cost should follow the delivery and not the history.
    """
    extraction, silver, quality = (str(uuid.uuid4()) for _ in range(3))
    landed = ingest_all(lake, config, extraction, at)
    counts = load_all_silver(lake, config, silver, at, only_open_runs=incremental)
    gold = load_all_gold(lake, config, only_new=incremental)
    checks = run_checks(lake, config, quality, at)
    return PipelineRun(extraction, silver, quality, landed, counts, gold, checks)

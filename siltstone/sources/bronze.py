"""Landing: audit columns, row ids and the append-only Bronze tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siltstone.config import PipelineConfig, SourceSpec
from siltstone.operators.keys import next_base, with_sequence
from siltstone.sources.lake import Lake
from siltstone.sources.readers import SOURCE_FILE, bad_records, keeps_bad_records, read_source


def add_audit_columns(
    df: DataFrame, source_file: str | None, run_id: str, ingested_at: datetime | None = None
) -> DataFrame:
    """Lineage of each row. Without ``source_file`` the scanned file's own path is
    taken; ``ingested_at`` is the storage side's clock and may be left to landing."""
    name = F.lit(source_file) if source_file is not None else F.col("_metadata.file_path")
    cols = {"source_file": name, "run_id": F.lit(run_id)}
    if ingested_at is not None:
        cols["ingested_at"] = F.lit(ingested_at).cast("timestamp")
    return df.withColumns(cols)


def landing_log(lake: Lake, spec: SourceSpec) -> DataFrame:
    """Log rows of the source's runs whose landing is complete."""
    return lake.read("bronze", "load_log").filter(F.col("bronze_table") == spec.bronze_table)


def _max_bronze_id(lake: Lake, spec: SourceSpec, log: DataFrame) -> int | None:
    """Highest id handed out, from the load log; only runs that crashed before
    they were logged are scanned."""
    known = [log.agg(F.max("max_bronze_id")).first()[0]]
    folders = lake.partitions("bronze", spec.bronze_table, "run_id")
    if folders:
        names = lake.spark.createDataFrame([(f,) for f in folders], "run_id string")
        loose = [r.run_id for r in names.join(log, "run_id", "left_anti").collect()]
        if loose:
            known.append(
                lake.read("bronze", spec.bronze_table, spec.bronze_schema)
                .filter(F.col("run_id").isin(loose))
                .agg(F.max("bronze_id"))
                .first()[0])
    return max((k for k in known if k is not None), default=None)


def land(
    lake: Lake,
    df: DataFrame,
    spec: SourceSpec,
    run_id: str,
    source_file: str | None = None,
    ingested_at: datetime | None = None,
) -> int:
    """Add one run to a Bronze table and return its row count.

    A run owns one directory. Earlier runs are never touched; an attempt that died
    half way is replaced when the same run is tried again.
    """
    log = landing_log(lake, spec)
    if not log.filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run '{run_id}' has already landed in {spec.bronze_table}")
    at = ingested_at or datetime.now(timezone.utc)
    if source_file is None and SOURCE_FILE in df.columns:  # each row's own file
        rows = df.select(*spec.columns, F.col(SOURCE_FILE).alias("source_file"),
                         F.lit(run_id).alias("run_id"), F.lit(at).cast("timestamp").alias("ingested_at"))
    else:
        rows = add_audit_columns(df.select(*spec.columns), source_file or spec.path, run_id, at)
    rows = with_sequence(rows, "bronze_id", next_base(_max_bronze_id(lake, spec, log)))
    seen = Observation()
    rows = rows.select(
        "bronze_id", *spec.columns, "ingested_at", "source_file", "run_id"
    ).observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.min("bronze_id").alias("low"),
        F.max("bronze_id").alias("top"),
    )
    lake.put_partition(rows, "bronze", spec.bronze_table, run_id=run_id)
    got = seen.get
    lake.log(
        "bronze", run_id=run_id, source=spec.name, bronze_table=spec.bronze_table,
        rows_loaded=got["n"], min_bronze_id=got["low"], max_bronze_id=got["top"],
        ingested_at=at)
    return got["n"]


def ingest_all(
    lake: Lake, config: PipelineConfig, run_id: str, ingested_at: datetime | None = None
) -> DataFrame:
    """Land every configured source under one run id; returns the load metrics. Records that a
    source leaves out (``badRecords: keep``) go to ``bad_records`` as they stand."""
    # Resolve all sources first, so a missing file stops the run before any table is written.
    scratch = lake.staging(f"scans-{run_id}")
    plans = [(spec, read_source(lake.spark, spec, scratch)) for spec in config.sources]
    for spec, df in plans:
        land(lake, df, spec, run_id, ingested_at=ingested_at)
        if keeps_bad_records(spec):
            bad = bad_records(lake.spark, spec, scratch).select(
                F.lit(spec.name).alias("source"), "source_file", "line", "record")
            lake.put_partition(bad, "bronze", "bad_records", run_id=run_id, source=spec.name)
    lake.unstage(f"scans-{run_id}")
    return load_metrics(lake, run_id)


def load_metrics(lake: Lake, run_id: str) -> DataFrame:
    return (
        lake.read("bronze", "load_log")
        .filter(F.col("run_id") == run_id)
        .select("run_id", "source", "bronze_table", "rows_loaded")
    )


def rows_of_run(lake: Lake, specs: list[SourceSpec], run_id: str) -> DataFrame:
    """Everything one run landed, counted per Bronze table (partition-pruned)."""
    counts = [
        lake.read("bronze", s.bronze_table, s.bronze_schema)
        .filter(F.col("run_id") == run_id)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(s.bronze_table).alias("bronze_table"), "row_count")
        for s in specs
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out

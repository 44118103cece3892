"""Bronze to Silver: incremental, idempotent, every row accounted for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import CALENDAR_DATES, SILVER_SCHEMAS, PipelineConfig, SourceSpec
from siltstone.functions.text import strip
from siltstone.operators.dedup import insert_if_absent
from siltstone.operators.keys import next_base, with_sequence
from siltstone.operators.membership import flag_listed, orphan_keys_of, without
from siltstone.operators.rules import split_by_verdict
from siltstone.operators.validators import (
    VALIDATORS,
    explained,
    judged,
    key_column,
    orphan_flag,
    stripped,
    typed_columns,
)
from siltstone.sources.bronze import landing_log
from siltstone.sources.lake import Lake, struct


@dataclass(frozen=True)
class LoadCounts:
    passed: int
    quarantined: int
    skipped_duplicate: int


def delivered(lake: Lake, spec: SourceSpec, runs: list[str] | None = None) -> DataFrame:
    """The Bronze rows a load looks at: some runs, or by default all runs whose landing
    is complete (what a broken landing left is not read)."""
    bronze = lake.read("bronze", spec.bronze_table, spec.bronze_schema)
    if runs is not None:  # the runs of this delivery
        return bronze.filter(F.col("run_id").isin(runs))
    # All history: joined with the landing log, so that no plan lists every run.
    return bronze.join(landing_log(lake, spec).select("run_id"), "run_id", "left_semi")


def unprocessed(
    lake: Lake, spec: SourceSpec, bronze: DataFrame | None = None, first_id: int | None = None
) -> DataFrame:
    """Bronze rows that have produced neither a Silver row nor a quarantine row.

    ``first_id`` is the least row id in ``bronze``, if known: outcomes of older rows
    are then skipped by file statistics, and if there is no younger outcome (no
    earlier attempt at these rows) there is nothing to join.
    """
    bronze = delivered(lake, spec) if bronze is None else bronze
    seen = []
    if lake.exists("silver", spec.silver_table):
        seen.append(lake.read("silver", spec.silver_table).select("bronze_id"))
    if lake.exists("silver", f"quarantine/target_table={spec.silver_table}"):
        rejected = lake.read("silver", "quarantine")
        seen.append(
            rejected.filter(F.col("target_table") == spec.silver_table).select("bronze_id"))
    if first_id is not None:
        seen = [ids.filter(F.col("bronze_id") >= first_id) for ids in seen]
        seen = [ids for ids in seen if not ids.isEmpty()]
    if not seen:
        return bronze
    ids, at = reduce(DataFrame.unionByName, seen), F.col("bronze_id")
    top = ids.agg(F.max(at)).first()[0]
    if top is None:
        return bronze
    later = bronze.filter((at > top) | at.isNull())
    return without(bronze.filter(at <= top), ids, ["bronze_id"]).select(*later.columns).unionByName(later)


def open_runs(lake: Lake, spec: SourceSpec) -> tuple[list[str], int | None]:
    """Landed Bronze runs of a source that no finished Silver load has covered, and
    their least row id."""
    log = lake.read("silver", "load_log").filter(F.col("source") == spec.name)
    covered = log.select(F.explode("bronze_runs").alias("run_id"))
    left = landing_log(lake, spec).join(covered, "run_id", "left_anti").select(
        "run_id", "min_bronze_id").collect()  # only what no load has finished
    return (sorted(r.run_id for r in left),
            min((r.min_bronze_id for r in left if r.min_bronze_id is not None), default=None))


def flag_orphans(
    lake: Lake, df: DataFrame, spec: SourceSpec, keys_from: DataFrame, stage: str
) -> DataFrame:
    """Flag, per reference, rows whose parent is not in Silver.

    The missing keys are found first, from the key columns alone in one pass, and written;
    there are few as a rule, so the wide rows are joined without being shuffled. A
    NULL key has no parent to miss and is not flagged (its own rule rejects it).
    """
    if not spec.references:
        return df
    lost = lake.stage(orphan_keys_of(
        keys_from, {r.column: strip(r.column) for r in spec.references},
        {r.column: (lake.read("silver", r.parent), r.parent_key) for r in spec.references}), f"{stage}-orphans")
    for ref in spec.references:
        key, flag = key_column(ref.column), orphan_flag(ref.column)
        mine = lost.filter(F.col("reference") == ref.column).select("key")
        df = flag_listed(df.withColumn(key, strip(ref.column)), key, mine, flag).drop(key)
    return df


def judge(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add stripped and parsed values and the verdict to rows with orphan flags:
    which rule rejects the row, NULL if none does."""
    return judged(stripped(df, spec.name), spec.name)


def _parsed(spec: SourceSpec) -> list[str]:
    """Silver columns that are parsed from text; the others are text that is stripped."""
    fields = struct(SILVER_SCHEMAS[spec.silver_table])
    return [c for c in spec.columns if not isinstance(fields[c].dataType, T.StringType)]


def outcome_rows(judged_rows: DataFrame, spec: SourceSpec, keep_raw: bool = False) -> DataFrame:
    """What each row becomes: the delivered text, and of valid rows the parsed values (``_new_*``).

    The text that a value was parsed from is kept of rejected rows; ``keep_raw`` keeps that of valid
    rows too, and so does a column that orders copies of a key. If the value's own text is the same
    it is not written twice (``delivered_text`` gives it back).
    """
    rejected, parsed = F.col("_failed").isNotNull(), _parsed(spec)
    typed = typed_columns(spec.name)

    def raw(c: str) -> Column:
        wanted = keep_raw or c in spec.first_by
        if c in parsed:
            other = ~F.col(c).eqNullSafe(typed[c].cast("string"))
            return F.when(rejected | other if wanted else rejected, F.col(c)).alias(c)
        return (F.col(c) if wanted or c in spec.columns else F.when(rejected, F.col(c))).alias(c)

    return judged_rows.select(
        "bronze_id",
        "_failed",
        *[raw(c) for c in (*spec.columns, "ingested_at", "source_file", "run_id")],
        *[F.when(~rejected, typed[c]).alias(f"_new_{c}") for c in parsed],
    )


def delivered_text(spec: SourceSpec, column: str) -> Column:
    """A column of an outcome as it was delivered."""
    kept = F.col(column)
    return F.coalesce(kept, F.col(f"_new_{column}").cast("string")) if column in _parsed(spec) else kept


def valid_rows(outcome: DataFrame, spec: SourceSpec) -> DataFrame:
    """Valid rows as they meet the copies of their key: the key and parsed values as Silver has
    them, other text as delivered, and ``_by_*`` where copies are ordered by something else."""
    parsed, typed = _parsed(spec), typed_columns(spec.name)
    rows = outcome.withColumns({f"_text_{c}": strip(c) for c in spec.natural_key})
    return rows.select(
        *[F.col(f"_new_{c}").alias(c) if c in parsed else typed[c].alias(c) if c in spec.natural_key else F.col(c)
          for c in _typed_names(spec)],
        "bronze_id",
        *[delivered_text(spec, c).alias(f"_by_{c}") for c in spec.first_by if f"_by_{c}" in _order(spec)],
    )


def _order(spec: SourceSpec) -> list[str]:
    """Columns of ``valid_rows`` that order copies of a key."""
    changed = {*_parsed(spec), *spec.natural_key}
    return [f"_by_{c}" if c in changed else c for c in spec.first_by]


def silver_rows(new: DataFrame, spec: SourceSpec) -> DataFrame:
    """Silver columns of ``valid_rows`` without copies: the other text is stripped now."""
    done, typed = {*_parsed(spec), *spec.natural_key}, typed_columns(spec.name)
    rows = new.withColumns({f"_text_{c}": strip(c) for c in spec.columns if c not in done})
    return rows.select(*[F.col(c) if c in done else typed[c].alias(c) for c in _typed_names(spec)], "bronze_id")


def row_json(spec: SourceSpec) -> Column:
    """The whole Bronze row as JSON text, NULLs included."""
    return F.to_json(
        F.struct(
            "bronze_id", *spec.columns, F.col("ingested_at").cast("string").alias("ingested_at"),
            "source_file", "run_id"
        ),
        {"ignoreNullFields": "false"},
    )


def quarantine_rows(
    rejected: DataFrame, spec: SourceSpec, run_id: str, at: datetime
) -> DataFrame:
    """Rejected rows with ``rule_id`` and ``rule_description``, as the quarantine
    keeps them: the original row as JSON and its lineage. ``run_id`` is the Silver
    load's own; the landing run stays inside ``row_data``."""
    return rejected.select(
        F.lit(spec.name).alias("source_name"),
        F.lit(spec.silver_table).alias("target_table"),
        "rule_id",
        "rule_description",
        row_json(spec).alias("row_data"),
        "bronze_id",
        F.lit(run_id).alias("run_id"),
        F.lit(at).cast("timestamp").alias("quarantined_at"),
    )


def _typed_names(spec: SourceSpec) -> list[str]:
    return _silver_columns(spec)[:-2]  # without bronze_id and validated_at


def _quarantine(lake: Lake, rows: DataFrame, spec: SourceSpec) -> None:
    top = lake.current_max("silver", "quarantine", "quarantine_id")
    rows = with_sequence(rows, "quarantine_id", next_base(top))
    lake.append(rows, "silver", "quarantine", target_table=spec.silver_table)


def load_silver(
    lake: Lake,
    spec: SourceSpec,
    run_id: str,
    at: datetime | None = None,
    on_duplicate: str = "skip",
    only_open_runs: bool = False,
    runs: list[str] | None = None,
    first_id: int | None = None,
) -> LoadCounts:
    """Validate and load what is new in one source.

    ``on_duplicate="quarantine"`` records later copies of a key under VR-09; by
    default they are only counted, and a later load reads and skips them again.
    ``only_open_runs`` reads just the Bronze runs no load has finished, so the
    cost follows the delivery and not the history. ``runs`` names the landings to load
    (a micro-batch of a stream) and ``first_id`` their least row id.
    """
    if on_duplicate not in ("skip", "quarantine"):
        raise ValueError(f"on_duplicate must be 'skip' or 'quarantine', not '{on_duplicate}'")
    at = at or datetime.now(timezone.utc)
    few = only_open_runs or runs is not None
    if runs is None:
        runs, first_id = open_runs(lake, spec)
    todo = unprocessed(
        lake, spec, delivered(lake, spec, runs if few else None), first_id if few else None)
    stage = f"{run_id}/{spec.name}"

    # One pass decides every row; the consumers below read its result back, so the
    # joins run once and a lost executor costs a re-read, not a re-join.
    seen = Observation()
    todo = flag_orphans(lake, todo, spec, todo, stage)
    decided = outcome_rows(
        judge(todo, spec), spec, keep_raw=on_duplicate == "quarantine"
    ).observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_failed").isNotNull()).alias("rejected"),
    )
    decided = lake.stage(decided, stage)
    total, rejected_n = seen.get["n"], seen.get["rejected"]
    valid, rejected = split_by_verdict(decided, "_failed")

    passed = duplicates = 0
    days = (None, None)
    if total > rejected_n:
        if spec.bucketed:
            lake.bucket_by("silver", spec.silver_table, list(spec.natural_key))
        new = insert_if_absent(
            valid_rows(valid, spec),
            lake.read_bucketed("silver", spec.silver_table),
            list(spec.natural_key),
            _order(spec),
        )
        added = Observation()
        new = silver_rows(new, spec).withColumn("validated_at", F.lit(at).cast("timestamp")).select(
            *_silver_columns(spec)).observe(added, F.count(F.lit(1)).alias("n"), *_day_range(spec))
        lake.append(new, "silver", spec.silver_table)
        passed, days = added.get["n"], (added.get["first"], added.get["last"])
        duplicates = total - rejected_n - passed
    if rejected_n:
        told = explained(rejected, spec.name)
        _quarantine(lake, quarantine_rows(told, spec, run_id, at), spec)
    if duplicates and on_duplicate == "quarantine":
        copies = without(valid, lake.read("silver", spec.silver_table), ["bronze_id"])
        told = copies.withColumns({c: delivered_text(spec, c) for c in spec.columns}).withColumns({
            "rule_id": F.lit("VR-09"),
            "rule_description": F.lit(f"duplicate natural key ({', '.join(spec.natural_key)})"),
        })
        _quarantine(lake, quarantine_rows(told, spec, run_id, at), spec)
        rejected_n, duplicates = rejected_n + duplicates, 0
    lake.unstage(stage)
    lake.unstage(f"{stage}-orphans")

    counts = LoadCounts(passed, rejected_n, duplicates)
    lake.log(
        "silver", run_id=run_id, source=spec.name, rows_passed=passed,
        rows_quarantined=rejected_n, rows_skipped_duplicate=duplicates, loaded_at=at,
        bronze_runs=runs, first_day=days[0], last_day=days[1])
    return counts


def _day_range(spec: SourceSpec) -> list[Column]:
    """First and last day the calendar needs for new rows."""
    dates = CALENDAR_DATES.get(spec.silver_table, ())
    if not dates:
        return [F.max(F.lit(None).cast("date")).alias(n) for n in ("first", "last")]
    low, high = (F.least(*dates), F.greatest(*dates)) if len(dates) > 1 else (F.col(dates[0]),) * 2
    return [F.min(low).alias("first"), F.max(high).alias("last")]


def _silver_columns(spec: SourceSpec) -> list[str]:
    return struct(SILVER_SCHEMAS[spec.silver_table]).names


def load_all_silver(
    lake: Lake, config: PipelineConfig, run_id: str, at: datetime | None = None, **options
) -> dict[str, LoadCounts]:
    """All sources that have rules, parents before children whatever the settings'
    order: references are checked against what this run has already loaded."""
    order = load_order([s for s in config.sources if s.name in VALIDATORS])
    return {s.name: load_silver(lake, s, run_id, at, **options) for s in order}


def load_order(sources: list[SourceSpec]) -> list[SourceSpec]:
    """Parents first, else as given. A parent that is not among the sources, or a
    cycle, raises ValueError before anything is written."""
    by_name = {s.name: s for s in sources}
    done: list[SourceSpec] = []
    left = list(sources)
    for s in sources:
        absent = [r.parent for r in s.references if r.parent not in by_name]
        if absent:
            raise ValueError(f"source '{s.name}' refers to {absent}, which no source delivers")
    while left:
        ready = [s for s in left if all(by_name[r.parent] in done or r.parent == s.name
                                        for r in s.references)]
        if not ready:
            raise ValueError(f"sources refer to each other: {[s.name for s in left]}")
        done += ready
        left = [s for s in left if s not in ready]
    return done


def outcomes(lake: Lake, run_id: str) -> DataFrame:
    """Passed, quarantined and skipped rows per source of one load."""
    return (
        lake.read("silver", "load_log")
        .filter(F.col("run_id") == run_id)
        .select("source", "rows_passed", "rows_quarantined", "rows_skipped_duplicate")
    )


# -- questions asked of the quarantine --------------------------------------


def quarantine_by_rule_and_day(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy(
        "rule_id", F.to_date("quarantined_at").alias("quarantined_on")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def quarantine_of(quarantine: DataFrame, target_table: str) -> DataFrame:
    return quarantine.filter(F.col("target_table") == target_table)

"""File sources: every column arrives as text, nothing is inferred."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import SourceSpec
from siltstone.sources import records

#: Column in which a scan tells each row's own file.
SOURCE_FILE = "_source_file"
#: What Spark's parser puts a record into whose fields are more or fewer than its header's.
_BAD = "_bad_record"
#: Own settings among a source's options; the others are Spark's.
OWN_OPTIONS = ("badRecords",)


def _text_schema(columns: tuple[str, ...], *more: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *more)])


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a file, folder or pattern."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out: list[str] = []
    todo = list(fs.globStatus(p) or [])
    while todo:
        at = todo.pop()
        name = at.getPath().getName()
        if at.isDirectory():
            if not name.startswith(("_", ".")) or at.getPath().equals(p):
                todo += list(fs.listStatus(at.getPath()))
        elif not name.startswith(("_", ".")) and at.getLen() > 0:
            out.append(at.getPath().toString())
    return sorted(out)


def scratch_folder(spark: SparkSession) -> str:
    """Where scans are written down: under ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/siltstone-scans"


def _nothing(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    return spark.range(0).select(
        *[F.lit(None).cast("string").alias(c) for c in (*spec.columns, SOURCE_FILE)])


# -- CSV -------------------------------------------------------------------------


def _spark_options(spec: SourceSpec) -> dict[str, str]:
    return {"escape": '"', **{k: v for k, v in spec.options.items() if k not in OWN_OPTIONS}}


def _separator(spec: SourceSpec) -> str:
    return spec.options.get("sep", spec.options.get("delimiter", ","))


def _probe(spark: SparkSession, spec: SourceSpec) -> list[tuple[str, tuple[str, ...], bool]]:
    """Each file with its header and whether a line of it ends inside quotes.

    One distributed scan over the raw lines; what comes back is one row per file.
    """
    files = _files(spark, spec.path)
    if not files:
        return []
    sep = _separator(spec)
    lines = records.pieces(spark, files, "\n").withColumn("row", F.monotonically_increasing_id())
    told = lines.groupBy("file").agg(
        F.min_by("value", F.struct("block", "row")).alias("header"),
        F.bool_or(records.opens_quote(F.rtrim(F.col("value"), F.lit("\r")), sep)).alias("breaks"),
    ).collect()
    out = []
    for r in sorted(told, key=lambda r: r.file):
        line = r.header.removeprefix("﻿").rstrip("\r")
        out.append((r.file, tuple(next(csv.reader([line], delimiter=sep), ())), r.breaks))
    return out


def _checked(spec: SourceSpec, file: str, header: tuple[str, ...]) -> None:
    unknown = [c for c in header if c not in spec.columns]
    if unknown or len(set(header)) != len(header):
        raise ValueError(
            f"Source '{spec.name}': {file} has columns {list(header)}, of which {unknown or 'some'} "
            f"{'are unknown' if unknown else 'occur twice'}; known are {list(spec.columns)}")


def _parsed(spark: SparkSession, spec: SourceSpec, scratch: str, numbered: bool = False,
            only: set[str] | None = None) -> DataFrame:
    """All records with their file, the columns of the source, and ``_BAD`` where a record is
    not one of its header. ``numbered`` adds each record's line.

    Files without line breaks inside quotes are read by Spark's own scan; for the others, and
    for line numbers, records are assembled first.
    """
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for file, header, breaks in _probe(spark, spec):
        _checked(spec, file, header)
        if only is None or file in only:
            groups.setdefault((header, breaks or numbered), []).append(file)
    bad = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    options = _spark_options(spec) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parts = []
    for (header, assemble), files in groups.items():
        schema = _text_schema(header, bad)
        if assemble:
            line = F.rtrim(F.col("value"), F.lit("\r"))
            found = records.assembled(spark, files, "\n", records.csv_effects(line, _separator(spec)), scratch,
                                      what=f"Source '{spec.name}'")
            body = F.rtrim(F.col("text"), F.lit("\r"))
            value = F.from_csv(body, ", ".join(f"`{c}` STRING" for c in schema.names), options | {"multiLine": "true"})
            # As a generator, so that no filter on its result is moved to pieces of records.
            df = found.where((F.col("position") > 1) & (F.trim(body) != "")).select(
                F.col("file").alias(SOURCE_FILE), F.col("position").alias("_line"), F.inline(F.array(value)))
        else:
            df = spark.read.schema(schema).option("header", True).options(**options).csv(files).select(
                F.col("_metadata.file_path").alias(SOURCE_FILE), F.lit(None).cast("long").alias("_line"), *schema.names)
            # A scan of some columns only does not miss the others, so all of them go with it.
            df = df.withColumn(bad, F.when(F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in header])) >= 0, F.col(bad)))
        df = df.withColumnRenamed(bad, _BAD)
        present = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in header
                   else F.lit(None).cast("string").alias(c) for c in spec.columns]
        parts.append(df.select(*present, SOURCE_FILE, "_line", _BAD))
    if not parts:
        return _nothing(spark, spec).withColumns(
            {"_line": F.lit(None).cast("long"), _BAD: F.lit(None).cast("string")})
    return reduce(DataFrame.unionByName, parts)


def read_csv(spark: SparkSession, spec: SourceSpec, scratch: str | None = None) -> DataFrame:
    """CSV with a header, bound by name file by file. Quoted and unquoted empties arrive as
    ``""``; a column that a file's header lacks is NULL. Line breaks inside quotes stay in
    their field, and files that hold some are still read by many tasks.

    An unknown or repeated header column raises ValueError, and so does a file that ends inside
    quotes. A record with more or fewer fields than its header stops the read, or is left out
    with the option ``badRecords: keep``; ``bad_records`` gives those as they stand.
    """
    rows = _parsed(spark, spec, scratch or scratch_folder(spark))
    bad = F.col(_BAD)
    if keeps_bad_records(spec):
        rows = rows.where(bad.isNull())
    else:
        rows = rows.where(F.when(bad.isNull(), True).otherwise(F.raise_error(F.concat(
            F.lit(f"Source '{spec.name}': a record of "), SOURCE_FILE,
            F.lit(" has other fields than its header: "), F.substring(bad, 1, 200))).cast("boolean")))
    return rows.select(*spec.columns, SOURCE_FILE)


def keeps_bad_records(spec: SourceSpec) -> bool:
    chosen = spec.options.get("badRecords", "stop")
    if chosen not in ("stop", "keep"):
        raise ValueError(f"Source '{spec.name}': badRecords must be 'stop' or 'keep', not '{chosen}'")
    return spec.file_format == "csv" and chosen == "keep"


def bad_records(spark: SparkSession, spec: SourceSpec, scratch: str | None = None) -> DataFrame:
    """source_file, line (from 1, the header's) and the record itself, for each record whose
    fields are not those of its header. Only files that hold some are numbered."""
    scratch = scratch or scratch_folder(spark)
    found = _parsed(spark, spec, scratch).where(F.col(_BAD).isNotNull())
    files = {r[0] for r in found.select(SOURCE_FILE).distinct().collect()}  # at most one a file
    rows = _parsed(spark, spec, scratch, numbered=True, only=files).where(F.col(_BAD).isNotNull())
    return rows.select(F.col(SOURCE_FILE).alias("source_file"), F.col("_line").alias("line"),
                       F.col(_BAD).alias("record"))


# -- JSON ------------------------------------------------------------------------


def read_json(spark: SparkSession, spec: SourceSpec, scratch: str | None = None) -> DataFrame:
    """JSON, values kept as written (``5000`` stays ``"5000"``). Text that is not JSON
    stops the read.

    By default each file is one array of objects, on one line or many, and is read by as many
    tasks as its size asks for. With the option ``multiLine: false`` it is JSON Lines.
    """
    schema = _text_schema(spec.columns)
    options = {k: v for k, v in spec.options.items() if k not in (*OWN_OPTIONS, "multiLine")}
    if spec.options.get("multiLine", "true").lower() == "false":
        return spark.read.schema(schema).options(mode="FAILFAST", **options).json(spec.path).select(
            *spec.columns, F.col("_metadata.file_path").alias(SOURCE_FILE))
    files = _files(spark, spec.path)
    if not files:
        return _nothing(spark, spec)
    found = records.assembled(spark, files, "}", records.json_effects(F.col("value")),
                              scratch or scratch_folder(spark), end_depth=-1, what=f"Source '{spec.name}'")
    lead = F.when(F.col("position") == 1, F.lit(r"^﻿?\s*\[\s*\{")).otherwise(F.lit(r"^\s*,\s*\{"))
    known = F.when(F.regexp_like("text", lead), F.regexp_replace("text", r"^[^{]*", "")).otherwise(
        F.raise_error(F.concat(F.lit(f"Source '{spec.name}': "), "file", F.lit(" is no array of objects: "),
                               F.substring("text", 1, 200))))
    value = F.from_json(F.concat(known, F.lit("}")), schema, {"mode": "FAILFAST", **options})
    return found.select(F.inline(F.array(value)), F.col("file").alias(SOURCE_FILE))


def read_parquet(spark: SparkSession, spec: SourceSpec, scratch: str | None = None) -> DataFrame:
    df = spark.read.options(**spec.options).parquet(spec.path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in spec.columns],
                     F.col("_metadata.file_path").alias(SOURCE_FILE))


READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "json": read_json,
    "parquet": read_parquet,
}


def read_source(spark: SparkSession, spec: SourceSpec, scratch: str | None = None) -> DataFrame:
    """Scan one source as text. ``scratch`` is a shared folder for scans written down on the way.

    Raises FileNotFoundError if the path is absent, then KeyError if the format is
    unknown; both before anything is written.
    """
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(spec.path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(p):
        raise FileNotFoundError(f"Source file not found: {spec.path}")
    if spec.file_format not in READERS:
        raise KeyError(
            f"Unsupported file_format '{spec.file_format}' for source '{spec.name}'; "
            f"known formats: {sorted(READERS)}"
        )
    try:
        return READERS[spec.file_format](spark, spec, scratch)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"Source file not found: {spec.path}") from e
        raise

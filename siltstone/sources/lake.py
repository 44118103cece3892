"""Parquet tables addressed by layer and name.

Append tables are one directory. Tables that are rewritten keep numbered
snapshots: a small file, written after the data and put in place by a rename, lists
the folders a snapshot consists of. The newest one is current, so a reader never
sees a half-written table or half an append, whatever markers Spark's committer
leaves, and a plan may read the snapshot it replaces. The same file keeps the highest
surrogate key, so that no later write has to look for it.

Append tables that are joined with on a key may be bucketed by it (Spark's own buckets), so
that the join moves the new rows only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import table_schema

SNAPSHOTS = "_snapshots"
_BUCKETS = "_buckets"
#: Held while a table is written, unless the session sets them: delivered text takes a third less
#: room than with Spark's own codec, and a write's shuffle files go when it has ended (else they
#: stay until the driver happens to collect its garbage). Stages are still repeated if lost.
_WRITING = {"spark.sql.parquet.compression.codec": "zstd",
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables, named in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Around a write: what it leaves on disk is small and is what it writes, nothing else."""
    mine = [k for k in _WRITING if spark.conf.get(k, None) is None]
    for k in mine:
        spark.conf.set(k, _WRITING[k])
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


@lru_cache(maxsize=None)
def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _literal(value, data_type: T.DataType) -> Column:
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value]).cast(data_type)
    return F.lit(value).cast(data_type)


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        #: Called after every change of a Silver or Gold table (registered views).
        self.on_change: list[Callable[[], None]] = []

    # -- locations ---------------------------------------------------------

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(p))

    def exists(self, layer: str, table: str) -> bool:
        """Whether anything was written; a snapshot counts once it is committed."""
        path = self.path(layer, table)
        if self._snapshots(path):
            return True
        return any(not c.startswith(("v=", "_", ".")) for c in self._children(path))

    def size(self, layer: str, table: str) -> int:
        """Bytes on disk, all snapshots together; 0 if absent."""
        fs, p = self._fs(self.path(layer, table))
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    # -- reading -----------------------------------------------------------

    def read(self, layer: str, table: str, schema: str | None = None, parts: set[str] | None = None) -> DataFrame:
        """Typed scan; an absent table reads as empty with the same columns. ``parts`` limits it
        to folders of those values.

        Snapshot folders of which none is committed are an error, not an empty table.
        """
        ddl = struct(schema or table_schema(layer, table))
        path = self.path(layer, table)
        paths = self.current_paths(layer, table)
        if parts is not None:
            paths = [p for p in paths if p.split("=")[-1] in parts]
        if not paths:
            children = [] if parts is not None else self._children(path)
            if any(c.startswith("v=") for c in children):
                raise RuntimeError(f"{path} holds snapshot folders, but none was committed")
            if not children:
                return self.spark.range(0).select(
                    *[F.lit(None).cast(f.dataType).alias(f.name) for f in ddl.fields])
            paths = [path]
        return self.spark.read.schema(ddl).parquet(*paths).select(*ddl.names)

    def current_paths(self, layer: str, table: str) -> list[str]:
        """Folders of the current snapshot; none for append tables."""
        path = self.path(layer, table)
        taken = self._snapshots(path)
        return [f"{path}/{c}" for c in self._folders(path, taken[-1])] if taken else []

    def partitions(self, layer: str, table: str, column: str) -> list[str]:
        """Values of a partition column, from the directory listing alone."""
        prefix = f"{column}="
        return [c[len(prefix):] for c in self._children(self.path(layer, table))
                if c.startswith(prefix)]

    # -- writing -----------------------------------------------------------

    def append(self, df: DataFrame, layer: str, table: str, **partition: str) -> None:
        """Append; ``partition`` names the one directory all rows belong to."""
        path = self.path(layer, table)
        if self.buckets(layer, table):
            name, columns = self._bucketed(layer, table), struct(table_schema(layer, table)).names
            with writing(self.spark):
                df.select(*columns).write.insertInto(name)
        else:
            for column, value in partition.items():
                path = f"{path}/{column}={value}"
                df = df.drop(column)
            with writing(self.spark):
                df.write.mode("append").parquet(path)
        self._changed(layer)

    def put_partition(self, df: DataFrame, layer: str, table: str, **partition: str) -> None:
        """Write one directory whole, replacing what a failed attempt left there."""
        path = self.path(layer, table)
        for column, value in partition.items():
            path = f"{path}/{column}={value}"
            df = df.drop(column)
        with writing(self.spark):
            df.write.mode("overwrite").parquet(path)

    def replace(self, df: DataFrame, layer: str, table: str, **layout) -> set[str]:
        """Write the next snapshot and let it become current on commit.

        ``key`` names a surrogate key whose highest value the commit keeps, ``part`` a column
        (not one of the table) by whose values the rows go to folders of their own, ``notes``
        further values the commit keeps. Returns the parts written.
        """
        return self._write_snapshot([df], layer, table, [], **layout)

    def append_to_current(self, df: DataFrame, layer: str, table: str, **layout) -> set[str]:
        """The current snapshot's folders and one more, visible together once written."""
        return self.rewrite_parts([df], layer, table, set(), **layout)

    def rewrite_parts(
        self, frames: list[DataFrame], layer: str, table: str, parts: set[str], **layout
    ) -> set[str]:
        """A snapshot of the current one's folders but those of the named parts, and of the
        frames' rows, each written to a folder of its own."""
        path = self.path(layer, table)
        current = self._folders(path, self._snapshots(path)[-1])
        if parts and any("/" not in f for f in current):
            raise ValueError(f"{path} was not written in parts")
        kept = [f for f in current if f.split("=")[-1] not in parts]
        return self._write_snapshot(frames, layer, table, kept, **layout)

    def _write_snapshot(
        self, frames: list[DataFrame], layer: str, table: str, keep: list[str],
        key: str | None = None, part: str | None = None, notes: dict[str, str] | None = None,
    ) -> set[str]:
        path = self.path(layer, table)
        taken = [int(c[2:]) for c in self._children(path) if c.startswith("v=")]
        snapshots = self._snapshots(path)
        number = max([0, *taken, *(int(c) for c in snapshots)]) + 1
        highest = self.current_max(layer, table, key) if key and keep else None
        listed, written = list(keep), set()
        for df in frames:
            folder, seen = f"v={number:08d}", Observation()
            if key:
                df = df.observe(seen, F.max(key).alias("key"))
            out = df.write.mode("errorifexists")
            with writing(self.spark):
                (out.partitionBy(part) if part else out).parquet(f"{path}/{folder}")
            if key:
                highest = max((k for k in (highest, seen.get["key"]) if k is not None), default=None)
            dirs = [c for c in self._children(f"{path}/{folder}") if part and c.startswith(f"{part}=")]
            listed += [f"{folder}/{c}" for c in dirs] if part else [folder]
            written |= {c.split("=")[1] for c in dirs}
            number += 1
        number -= 1
        if key and highest is not None:
            notes = {**(notes or {}), key: highest}
        listed += [f"#{k}={v}" for k, v in (notes or {}).items()]
        fs, draft = self._fs(f"{path}/{SNAPSHOTS}/.{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray("\n".join(listed).encode()))
        out.close()
        _, final = self._fs(f"{path}/{SNAPSHOTS}/{number:08d}")
        if not fs.rename(draft, final):
            raise RuntimeError(f"snapshot {number} of {path} was committed by someone else")
        self._changed(layer)
        return written

    def snapshot(self, layer: str, table: str) -> str | None:
        """Number of the current snapshot."""
        taken = self._snapshots(self.path(layer, table))
        return taken[-1] if taken else None

    def note(self, layer: str, table: str, name: str) -> str | None:
        """A value that the current commit keeps."""
        path, current = self.path(layer, table), self.snapshot(layer, table)
        for line in self._listed(path, current) if current else []:
            if line.startswith(f"#{name}="):
                return line.split("=", 1)[1]
        return None

    def _changed(self, layer: str) -> None:
        if layer in ("silver", "gold"):
            for refresh in self.on_change:
                refresh()

    def _snapshots(self, path: str) -> list[str]:
        return [c for c in self._children(f"{path}/{SNAPSHOTS}") if c.isdigit()]

    def _listed(self, path: str, snapshot: str) -> list[str]:
        fs, p = self._fs(f"{path}/{SNAPSHOTS}/{snapshot}")
        stream = fs.open(p)
        try:
            return [line for line in bytes(stream.readAllBytes()).decode().split("\n") if line]
        finally:
            stream.close()

    def _folders(self, path: str, snapshot: str) -> list[str]:
        return [line for line in self._listed(path, snapshot) if not line.startswith("#")]

    def expire(self, layer: str, table: str, keep: int = 2) -> list[str]:
        """Drop all but the newest ``keep`` snapshots and the folders only they used;
        returns the folders. Folders above the newest snapshot may be in the making."""
        path = self.path(layer, table)
        taken = self._snapshots(path)
        old = taken[:-keep] if keep > 0 else []
        if not old:
            return []
        used = {c for s in taken[-keep:] for c in self._folders(path, s)}
        whole = {c.split("/")[0] for c in used}
        settled = [c for c in self._children(path) if c.startswith("v=") and c[2:] <= taken[-1]]
        lost = [c for c in settled if c not in whole]
        lost += [f"{c}/{part}" for c in settled if c in whole and c not in used
                 for part in self._children(f"{path}/{c}") if "=" in part and f"{c}/{part}" not in used]
        for name in [*(f"{SNAPSHOTS}/{s}" for s in old), *lost]:
            fs, p = self._fs(f"{path}/{name}")
            fs.delete(p, True)
        return lost

    # -- buckets -------------------------------------------------------------

    def buckets(self, layer: str, table: str) -> int | None:
        """Number of buckets of a bucketed table, else None."""
        counts = [c for c in self._children(self.path(layer, table)) if c.startswith(f"{_BUCKETS}-")]
        return int(counts[0].removeprefix(f"{_BUCKETS}-")) if counts else None

    def bucket_by(self, layer: str, table: str, keys: list[str]) -> None:
        """Let a table that holds nothing yet be bucketed by its keys, into as many buckets as
        a shuffle has partitions, so that neither side of a join on them moves twice."""
        if self.exists(layer, table) or self.buckets(layer, table):
            return
        count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        fs, p = self._fs(f"{self.path(layer, table)}/{_BUCKETS}-{count}")
        out = fs.create(p)
        out.write(bytearray(",".join(keys).encode()))
        out.close()

    def _bucketed(self, layer: str, table: str) -> str:
        """The table's name in this application's catalog."""
        path, count = self.path(layer, table), self.buckets(layer, table)
        fs, p = self._fs(f"{path}/{_BUCKETS}-{count}")
        stream = fs.open(p)
        try:
            keys = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        name = f"siltstone_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({table_schema(layer, table)}) USING parquet "
                           f"CLUSTERED BY ({keys}) INTO {count} BUCKETS LOCATION '{path}'")
        return name

    def read_bucketed(self, layer: str, table: str) -> DataFrame:
        """A scan that tells its buckets to the optimizer; a plain one if there are none."""
        if not self.buckets(layer, table):
            return self.read(layer, table)
        return self.spark.table(self._bucketed(layer, table))

    def log(self, layer: str, **values) -> None:
        """Add one row to the load log of a layer."""
        ddl = struct(table_schema(layer, "load_log"))
        row = self.spark.range(1, numPartitions=1).select(
            *[_literal(values[f.name], f.dataType).alias(f.name) for f in ddl.fields])
        self.append(row, layer, "load_log")

    # -- intermediate tables -------------------------------------------------

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate result that several later plans read.

        Unlike a cached frame it outlives lost executors, and the joins behind it
        run once.
        """
        path = self.staging(name)
        with writing(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def staging(self, name: str) -> str:
        return f"{self.root}/_staging/{name}"

    def unstage(self, name: str) -> None:
        fs, p = self._fs(self.staging(name))
        fs.delete(p, True)

    # -- identifiers ---------------------------------------------------------

    def current_max(self, layer: str, table: str, column: str) -> int | None:
        """Highest value of a surrogate key: from the current commit if it keeps that, else
        from the column."""
        if not self.exists(layer, table):
            return None
        noted = self.note(layer, table, column)
        return int(noted) if noted else self.read(layer, table).agg(F.max(column)).first()[0]

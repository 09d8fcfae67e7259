"""Versioned tables: Parquet folders and one small manifest per version.

A lake folder holds tables, each written in runs, partitioned by the table's
columns (Hive folders as Spark names them)::

    root/data/<table>/_run=<id>/<partition folder>/part-*.parquet
    root/versions/v00000007.json      table -> schema, partition folder -> runs

Nothing that was written is changed. A change writes new runs, builds the next
manifest on the driver (its size is the number of partition folders, never of
rows) and publishes it with one rename, for all tables at once: readers see
the version before or the one after, never a gap. Two writers that start from
the same version cannot both publish: the first claims the number.

Rows leave a partition by rewriting it without them; rows enter it by a
further run that is listed next to the others. So a batch rewrites the
folders that hold its keys and nothing else.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .io import CODEC

RUN = "_run"
BUCKET = "_bucket"


class VersionConflict(RuntimeError):
    """Another writer has published, or is publishing, the version after the one this change began with."""


@dataclass(frozen=True)
class Entry:
    """One table in a manifest: its schema (JSON), partition columns, and runs by partition folder."""

    schema: str
    by: tuple[str, ...] = ()
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class Files:
    """The few file-system calls a manifest needs, on whatever store the root names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str, folders_only: bool = False) -> list[str]:
        p = self.path(folder)
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p) if s.isDirectory() or not folders_only]

    def state(self, name: str) -> list[tuple[str, int, int]]:
        """(path, size, modification time) of a file, or of each entry of a folder."""
        return [(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in self.fs.listStatus(self.path(name))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Written beside its place and renamed into it: the file is there whole or not at all."""
        beside = self.path(f"{os.path.dirname(name)}/.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(beside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(beside, self.path(name)):
            raise OSError(f"cannot rename to {name}")

    def claim(self, name: str) -> bool:
        self.fs.mkdirs(self.path(os.path.dirname(name)))
        return self.fs.createNewFile(self.path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Snapshot:
    """The tables of one version."""

    def __init__(self, lake: Lake, version: int, entries: dict[str, Entry], notes: dict):
        self.lake, self.version, self.entries, self.notes = lake, version, entries, notes

    def read(self, name: str, folders: Iterable[str] | None = None) -> DataFrame:
        """A table, or only some of its partition folders (those it does not have are left out)."""
        entry = self.entries[name]
        wanted = entry.parts if folders is None else {f: entry.parts[f] for f in folders if f in entry.parts}
        return self.lake.read_runs(name, entry, [(run, f) for f, ids in wanted.items() for run in ids])


class Lake:
    """Versioned tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)
        self._dealt: dict[str, str] = {}  # run -> this session's catalog table on it

    def _manifest(self, version: int, ending: str = "json") -> str:
        return f"{self.root}/versions/v{version:08d}.{ending}"

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.root}/versions")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version (default: the latest; version 0 has no tables)."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Snapshot(self, 0, {}, {})
        stored = json.loads(self.files.read(self._manifest(version)))
        entries = {name: Entry(e["schema"], tuple(e["by"]), {f: tuple(r) for f, r in e["parts"].items()})
                   for name, e in stored["tables"].items()}
        return Snapshot(self, version, entries, stored["notes"])

    def begin(self) -> Change:
        return Change(self.snapshot())

    def publish(self, base: int, entries: dict[str, Entry], notes: dict) -> int:
        version = base + 1
        if max(self.versions(), default=0) != base or not self.files.claim(self._manifest(version, "claim")):
            raise VersionConflict(f"version {version} of {self.root} is taken (a claim without a manifest is a run that "
                                  "ended early: withdraw() frees it)")
        tables = {name: {"schema": e.schema, "by": e.by, "parts": e.parts} for name, e in entries.items()}
        self.files.write(self._manifest(version), json.dumps({"notes": notes, "tables": tables}))
        return version

    def withdraw(self) -> None:
        """Free the next version number of a run that claimed it and ended before it published."""
        self.files.delete(self._manifest(max(self.versions(), default=0) + 1, "claim"))

    def data(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def write_run(self, name: str, df: DataFrame, by: Sequence[str], placed: bool = False,
                  dealt: tuple[int, str] | None = None) -> tuple[str, list[str]]:
        """Write rows as a new run of a table: (run id, its partition folders).

        ``placed``: the rows of a partition folder lie in few tasks already, so they are not dealt out again.
        ``dealt``: the rows were dealt out by ``repartition(*dealt)``; their files are written so that this session
        (see ``dealt``) joins the run by that column without a shuffle.
        """
        run = uuid.uuid4().hex[:16]
        path = f"{self.data(name)}/{RUN}={run}"
        rows = df if placed or dealt or not by else df.hint("rebalance", *by)
        out = rows.write.option("compression", CODEC)
        if by:
            out = out.partitionBy(*by).option("maxRecordsPerFile", 5_000_000)
        if dealt:
            table = f"tessera_{name}_{run}"
            out.format("parquet").option("path", path).bucketBy(*dealt).saveAsTable(table)
            self._dealt[run] = table
        else:
            out.parquet(path)
        folders = [""]
        for _ in by:
            folders = [f"{f}/{n}".lstrip("/") for f in folders for n in self.files.names(f"{path}/{f}", folders_only=True)
                       if "=" in n]
        return run, folders

    def read_runs(self, name: str, entry: Entry, parts: Sequence[tuple[str, str]], extra: Sequence[Column] = ()) -> DataFrame:
        """Rows of (run, partition folder) pairs: the table's columns, then ``extra`` columns (of the files' metadata)."""
        if not parts:
            return self.spark.createDataFrame([], entry.struct)
        schema = T.StructType([*entry.struct, T.StructField(RUN, T.StringType())])
        paths = [f"{self.data(name)}/{RUN}={run}/{f}".rstrip("/") for run, f in parts]
        rows = self.spark.read.schema(schema).option("basePath", self.data(name)).parquet(*paths)
        return rows.select(*entry.struct.fieldNames(), *extra)

    def dealt(self, entry: Entry) -> DataFrame | None:
        """The table's rows as dealt out, if they are one run that this session wrote so."""
        runs = {ids for ids in entry.parts.values()}
        table = self._dealt.get(next(iter(runs))[0]) if len(runs) == 1 and len(next(iter(runs))) == 1 else None
        return self.spark.table(table).select(*entry.struct.fieldNames()) if table else None

    def input_bytes(self, df: DataFrame) -> int:
        """Bytes of the files that a table is read from."""
        return sum(size for name in df.inputFiles() for _, size, _ in self.files.state(name))

    def run_bytes(self, name: str, run: str, folders: Iterable[str]) -> int:
        """Bytes of a run's files in partition folders."""
        return sum(size for f in folders for _, size, _ in self.files.state(f"{self.data(name)}/{RUN}={run}/{f}".rstrip("/")))

    def broadcast_limit(self) -> int:
        """Bytes up to which the session broadcasts a table to a join (0: never)."""
        limit = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().rstrip("b")
        unit = {"k": 10, "m": 20, "g": 30}.get(limit[-1])
        return max(0, int(limit[:-1]) << unit if unit else int(limit))

    def vacuum(self, keep: int = 2) -> int:
        """Delete runs that none of the latest ``keep`` versions lists, and older manifests; returns the runs deleted."""
        versions = self.versions()
        live: dict[str, set] = {}
        for v in versions[-keep:]:
            for name, e in self.snapshot(v).entries.items():
                live.setdefault(name, set()).update(r for ids in e.parts.values() for r in ids)
        gone = 0
        for name, runs in live.items():
            for folder in self.files.names(self.data(name), folders_only=True):
                if folder.startswith(f"{RUN}=") and folder.removeprefix(f"{RUN}=") not in runs:
                    self.files.delete(f"{self.data(name)}/{folder}")
                    gone += 1
        for v in versions[:-keep]:
            self.files.delete(self._manifest(v))
        return gone


class Change:
    """The next version in the making: nothing is visible before ``publish``."""

    def __init__(self, base: Snapshot):
        self.lake, self.base = base.lake, base
        self.entries, self.notes = dict(base.entries), {}
        self.aside: dict[str, str] = {}  # catalog table -> folder: scratch that goes when the change is published

    def read(self, name: str, folders: Iterable[str] | None = None) -> DataFrame:
        """The table as the change has it so far."""
        return Snapshot(self.lake, self.base.version, self.entries, {}).read(name, folders)

    def bytes(self, name: str, folders: Iterable[str] | None = None) -> int:
        """Bytes of a table as the change has it so far, or of some of its partition folders."""
        parts = self.entries[name].parts
        return sum(self.lake.run_bytes(name, run, [f]) for f in (parts if folders is None else folders) for run in parts.get(f, ()))

    def write(self, name: str, df: DataFrame, by: Sequence[str] = (), placed: bool = False,
              dealt: tuple[int, str] | None = None) -> DataFrame:
        """Replace (or create) a whole table."""
        run, folders = self.lake.write_run(name, df, by, placed, dealt)
        self.entries[name] = Entry(df.schema.json(), tuple(by), {f: (run,) for f in folders})
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> list[str]:
        """Add rows (with the table's columns); returns their partition folders."""
        entry = self.entries[name]
        run, folders = self.lake.write_run(name, df.select(*entry.struct.fieldNames()), entry.by)
        self.add_run(name, run, folders)
        return folders

    def add_run(self, name: str, run: str, folders: Iterable[str]) -> None:
        """List a run that ``Lake.write_run`` wrote for the table."""
        entry = self.entries[name]
        self.entries[name] = replace(entry, parts=entry.parts | {f: (*entry.parts.get(f, ()), run) for f in folders})

    def rewrite(self, name: str, folders: Iterable[str], rows: DataFrame, placed: bool = False,
                dealt: tuple[int, str] | None = None) -> None:
        """Replace partition folders by ``rows`` (rows of other partitions are added to theirs)."""
        entry = self.entries[name]
        run, made = self.lake.write_run(name, rows.select(*entry.struct.fieldNames()), entry.by, placed, dealt)
        gone = set(folders)
        parts = {f: ids for f, ids in entry.parts.items() if f not in gone}
        self.entries[name] = replace(entry, parts=parts | {f: (*parts.get(f, ()), run) for f in made})

    def remove(self, name: str, match: DataFrame, keys: Sequence[str], among: Iterable[str] | None = None) -> list[str]:
        """Rewrite the folders that hold rows with the keys of ``match`` (NULL is a key) without these rows.

        ``among`` names the folders that can hold them (default: all). Returns those that do.

        Where ``match`` is small enough to be broadcast, the other rows are
        written back by the tasks that read them, without a shuffle.
        """
        small = self.lake.input_bytes(match) <= self.lake.broadcast_limit()
        match = F.broadcast(match) if small else match
        found = self.holding(name, match, keys, among)
        if found:
            rows = self.read(name, found)
            rest = rows.join(match, [rows[k].eqNullSafe(match[k]) for k in keys], "left_anti")
            self.rewrite(name, found, rest, placed=small)
        return found

    def holding(self, name: str, match: DataFrame, keys: Sequence[str], among: Iterable[str] | None = None) -> list[str]:
        """Partition folders with a row whose keys are in ``match``: one scan of the key columns."""
        entry = self.entries[name]
        wanted = entry.parts if among is None else {f: entry.parts[f] for f in among if f in entry.parts}
        if not wanted or not entry.by:
            return list(wanted)
        parts = [(run, f) for f, ids in wanted.items() for run in ids]
        rows = self.lake.read_runs(name, entry, parts, extra=[folder_column()]).select(*keys, "_folder")
        held = rows.join(match, [rows[k].eqNullSafe(match[k]) for k in keys], "left_semi")
        return folder_names(held)

    def publish(self, **notes) -> int:
        """Make the change the next version. ``notes`` are small values kept with it (earlier ones stay)."""
        version = self.lake.publish(self.base.version, self.entries, self.base.notes | self.notes | notes)
        while self.aside:
            table, path = self.aside.popitem()
            self.lake.spark.sql(f"DROP TABLE IF EXISTS {table}")
            Files(self.lake.spark, path).delete(path)
        return version


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the column ``_bucket``: equal keys lie in equal buckets, in every table with as many buckets."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def folder_column(file: Column | None = None) -> Column:
    """The partition folder of a file (default: of the row's file), still percent-encoded, for ``folder_names``."""
    path = F.col("_metadata.file_path") if file is None else file
    return F.regexp_extract(path, rf"/{RUN}=[^/]*/(.*)/[^/]*$", 1).alias("_folder")


def run_column(file: Column) -> Column:
    """The run that a file belongs to."""
    return F.regexp_extract(file, rf"/{RUN}=([^/]*)/", 1)


def folder_names(rows: DataFrame) -> list[str]:
    """Distinct folders of rows that carry ``folder_column`` (as many as partitions, like the manifest)."""
    return sorted(unquote(r[0]) for r in rows.select("_folder").distinct().collect())

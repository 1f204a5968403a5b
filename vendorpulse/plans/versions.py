"""Partitioned tables whose versions are published, all together, by one rename.

``data/staged_as=<id>/<column>=<value>/`` holds what a write staged; ``_versions/<n>.json``
names, for version n, each table's schema and the folder of each of its
partitions.  A write stages its files first, then writes the manifest under a
temporary name and renames it: until then readers see the version before, and
after it the whole new one, of every table.  A write that ends between leaves
files that no manifest names.  A table may be staged in buckets of a column
(``Deal``): each of its partitions holds one file a bucket, and it is read back
dealt by that column as a shuffle would deal it.  A writer names the version that it builds on; if
another has published meanwhile the rename finds its name taken and the write
is refused.  Readers are pinned to the version they opened; old versions stay
until :meth:`Versions.vacuum`.

Paths are Hadoop paths.  The rename must not replace an existing file, which
``FileContext`` sees to (atomically on HDFS; a store whose rename is a copy
needs one that checks).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFEST = re.compile(r"(\d{10})\.json")


class Conflict(RuntimeError):
    """Another writer has published this version."""


@dataclass(frozen=True)
class Deal:
    """Rows dealt by the hash of ``key`` into ``buckets``."""

    key: str
    buckets: int


@dataclass(frozen=True)
class Staged:
    """Written partitions of a table that no version names yet."""

    table: str
    partition: str
    schema: T.StructType
    folders: dict[str, str]
    deal: Deal | None = None


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.path).getFileSystem(conf)
        self._context = hadoop.FileContext.getFileContext(self._fs.getUri(), conf)
        self._options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)  # none: nothing is replaced

    # --- manifests
    def _names(self, folder: str) -> list[str]:
        p = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def numbers(self) -> list[int]:
        return sorted(int(m[1]) for m in map(_MANIFEST.fullmatch, self._names("_versions")) if m)

    def latest(self) -> int:
        """The newest version; 0 before the first."""
        return max(self.numbers(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``{"tables": {name: {"partition", "schema", "folders"}}, "info"}`` of a version (the newest)."""
        version = self.latest() if version is None else version
        if not version:
            return {"tables": {}, "info": {}}
        stream = self._fs.open(self._path(f"{self.path}/_versions/{version:010}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    # --- writes
    def stage(self, table: str, df: DataFrame, partition: str, deal: Deal | None = None, placed: bool = False) -> Staged:
        """Write the rows.  Nothing is visible yet.

        ``deal``: in buckets; the rows of one are to come in one task.  ``placed``: the tasks' rows lie as they are to be
        written (a task holds few partitions).  Otherwise they are dealt by partition first.
        """
        folder = f"data/staged_as={uuid.uuid4().hex}"
        rows = df.select(*(f"`{c}`" for c in df.columns if c != partition), f"`{partition}`")
        if deal is None:
            rows_out = rows if placed else rows.hint("rebalance", partition)
            rows_out.write.partitionBy(partition).option("compression", "zstd").parquet(f"{self.path}/{folder}")
        else:
            name = f"staged_{uuid.uuid4().hex}"
            (rows.write.partitionBy(partition).bucketBy(deal.buckets, deal.key).option("compression", "zstd")
                 .format("parquet").option("path", f"{self.path}/{folder}").saveAsTable(name))
            self.spark.sql(f"DROP TABLE {name}")  # the files stay
        found = {name.partition("=")[2]: f"{folder}/{name}" for name in self._names(folder) if name.startswith(f"{partition}=")}
        return Staged(table, partition, rows.schema, found, deal)

    def publish(self, staged: Iterable[Staged], replaced: dict[str, Iterable | None] | None = None, on: int | None = None,
                info: dict | None = None) -> int:
        """Make staged partitions visible, as the version after ``on`` (the newest).

        ``replaced``: by table, the partitions that the write stands for; one
        that was not staged is empty now.  A table that it doesn't name (or
        with None) is written whole.  Tables that aren't staged stay.
        """
        on = self.latest() if on is None else on
        after = self.manifest(on)
        for s in staged:
            scope = (replaced or {}).get(s.table)
            old = after["tables"].get(s.table, {"folders": {}})["folders"] if scope is not None else {}
            gone = set(map(str, scope or ()))
            kept = {k: v for k, v in old.items() if k not in gone}
            deal = None if s.deal is None else [s.deal.key, s.deal.buckets]
            if kept and after["tables"][s.table].get("deal") != deal:
                deal = None  # partitions of several layouts are read as plain files
            after["tables"][s.table] = {"partition": s.partition, "schema": s.schema.json(), "deal": deal,
                                        "folders": {**kept, **s.folders}}
        after["info"].update(info or {})
        hidden = self._path(f"{self.path}/_versions/.{uuid.uuid4().hex}")
        final = self._path(f"{self.path}/_versions/{on + 1:010}.json")
        stream = self._fs.create(hidden)
        stream.write(bytearray(json.dumps(after, sort_keys=True).encode()))
        stream.close()
        try:
            self._context.rename(self._fs.makeQualified(hidden), self._fs.makeQualified(final), self._options)
        except Exception as e:
            self._fs.delete(hidden, False)
            if self._fs.exists(final):
                raise Conflict(f"version {on + 1} of {self.path} has been published by another write") from e
            raise
        return on + 1

    # --- reads
    def read(self, table: str, partitions: Sequence | None = None, version: int | None = None) -> DataFrame:
        """A table's rows in a version (the newest), of the given partitions alone; only their folders are listed."""
        known = self.manifest(version)["tables"].get(table)
        if known is None:
            raise FileNotFoundError(f"no table {table!r} has been published at {self.path}")
        folders = known["folders"]
        if partitions is not None:
            folders = {k: folders[k] for k in dict.fromkeys(map(str, partitions)) if k in folders}
        return self._scan(T.StructType.fromJson(json.loads(known["schema"])), known["partition"], folders,
                          Deal(*known["deal"]) if known.get("deal") else None)

    def staged(self, s: Staged) -> DataFrame:
        """The rows that were staged, read back."""
        return self._scan(s.schema, s.partition, s.folders, s.deal)

    def deal(self, table: str, version: int | None = None) -> Deal | None:
        """How a version's table is dealt."""
        known = self.manifest(version)["tables"].get(table) or {}
        return Deal(*known["deal"]) if known.get("deal") else None

    def _scan(self, schema: T.StructType, partition: str, folders: dict[str, str], deal: Deal | None) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        if deal is None:
            full = T.StructType([*schema.fields, T.StructField("staged_as", T.StringType())])
            return (self.spark.read.schema(full).option("basePath", f"{self.path}/data")
                    .parquet(*(f"{self.path}/{p}" for p in folders.values())).select(*(f"`{f.name}`" for f in schema)))
        # buckets are known by the catalog alone: a name of its own for these folders
        name, text = f"dealt_{uuid.uuid4().hex}", lambda p: f"{self.path}/{p}".replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) "
                       f"CLUSTERED BY (`{deal.key}`) INTO {deal.buckets} BUCKETS LOCATION '{text('data')}'")
        self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"PARTITION (`{partition}`='{k}') LOCATION '{text(p)}'" for k, p in folders.items()))
        return self.spark.table(name).select(*(f"`{f.name}`" for f in schema))

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the newest ``keep`` versions, and the folders that none of those names; returns their number.

        Not while a write is staging: its files aren't named yet.
        """
        if keep < 1:
            raise ValueError("the newest version stays")
        for n in self.numbers()[:-keep]:
            self._fs.delete(self._path(f"{self.path}/_versions/{n:010}.json"), False)
        held = {p for n in self.numbers() for t in self.manifest(n)["tables"].values() for p in t["folders"].values()}
        gone = 0
        for folder in self._names("data"):
            parts = [f"data/{folder}/{p}" for p in self._names(f"data/{folder}") if "=" in p]
            dead = [p for p in parts if p not in held]
            for p in dead if len(dead) < len(parts) else [f"data/{folder}"]:
                self._fs.delete(self._path(f"{self.path}/{p}"), True)
                gone += 1
        return gone

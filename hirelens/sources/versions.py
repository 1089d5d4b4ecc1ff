"""Tables that change in one step: data in folders that are never written twice, one small manifest.

A version is a manifest, a JSON file that names for every table the folders of its parts. A build
writes new folders beside the old ones and, when all is written and checked, adds the next manifest.
The manifest is written under another name and renamed, which fails if its number is taken: a
reader sees a version whole or not at all, a build that dies leaves nothing that a reader would see,
and of two builds that started from the same version the second to end is refused.

A reader resolves the newest version once and goes on reading its folders, whatever is published
meanwhile. A part that a build does not touch keeps its folder, so an increment writes what changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_versions"
#: The only part of a table that is not divided.
WHOLE = "all"
_PART = "_part"


class Conflict(RuntimeError):
    """Another build published first."""


@dataclass(frozen=True)
class Version:
    """What readers see: for every table the folder of each part (relative to the root), and notes."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict[str, int] = field(default_factory=dict)


class Store:
    """The versions below one root folder, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder, files = self._path(MANIFESTS), self._files()
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def _manifest(self, number: int) -> str:
        return f"{MANIFESTS}/{number:012d}.json"

    def version(self, number: int) -> Version:
        path = f"{self.root}/{self._manifest(number)}"
        body = json.loads(self.spark.read.text(path, wholetext=True).first()[0])
        return Version(number, body["tables"], body["notes"])

    def current(self) -> Version:
        """The newest version; one without tables if nothing is published."""
        numbers = self._numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def folders(self, version: Version, table: str, parts: Iterable[str] | None = None) -> list[str]:
        there = version.tables.get(table, {})
        return [f"{self.root}/{there[p]}" for p in sorted(there if parts is None else set(parts) & there.keys())]

    def read(
        self, version: Version, table: str, schema: T.StructType, parts: Iterable[str] | None = None
    ) -> DataFrame:
        """A table of a version, or some of its parts; empty if there are none."""
        folders = self.folders(version, table, parts)
        if not folders:
            return self.spark.createDataFrame([], schema).limit(0)  # known to be empty when joins are planned
        return self.spark.read.schema(schema).parquet(*folders)

    def draft(self, base: Version | None = None) -> Draft:
        return Draft(self, self.current() if base is None else base)

    def add(self, version: Version) -> None:
        """Make a version visible, unless its number is taken."""
        jvm, files = self.spark._jvm, self._files()
        files.mkdirs(self._path(MANIFESTS))
        path = self._path(f"{MANIFESTS}/.{uuid.uuid4().hex}")
        out = files.create(path, False)
        out.write(json.dumps({"tables": version.tables, "notes": version.notes}).encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        refuse = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(path), files.makeQualified(self._path(self._manifest(version.number))), refuse)
        except Exception as error:
            files.delete(path, False)
            if self._files().exists(self._path(self._manifest(version.number))):
                raise Conflict(f"version {version.number} of {self.root} was published by another build") from error
            raise

    def discard(self, folder: str) -> None:
        """Delete a folder that a build has written and does not publish."""
        self._files().delete(self._path(folder), True)

    def expire(self, keep: int) -> list[str]:
        """Drop all but the newest ``keep`` manifests and the folders that only they name.

        Folders of unfinished builds are not named anywhere and stay. Readers of a dropped version
        lose its files, so ``keep`` has to cover the longest read.
        """
        numbers = self._numbers()
        old, new = numbers[:-keep], numbers[-keep:]
        used = {f for n in new for parts in self.version(n).tables.values() for f in parts.values()}
        gone = {f for n in old for parts in self.version(n).tables.values() for f in parts.values()} - used
        for n in old:  # manifests first: no reader finds one whose folders are going
            self._files().delete(self._path(self._manifest(n)), False)
        for folder in sorted(gone):
            self._files().delete(self._path(folder), True)
        return sorted(gone)


class Draft:
    """A version in the making. Until ``publish`` nobody sees it."""

    def __init__(self, store: Store, base: Version):
        self.store, self.base = store, base
        self.run = uuid.uuid4().hex
        self.notes = dict(base.notes)
        self._changed: dict[str, dict[str, str | None]] = {}

    def folder(self, table: str) -> str:
        """Where this build writes a table, relative to the root."""
        return f"{table}/{self.run}"

    def put(self, table: str, folder: str | None = None) -> None:
        """The table is what was written to ``folder``, whole."""
        gone = {part: None for part in self.base.tables.get(table, {})}
        self._changed[table] = {**gone, WHOLE: folder or self.folder(table)}

    def part(self, table: str, part: str, folder: str | None) -> None:
        """One part is what was written to ``folder``, or is dropped."""
        self._changed.setdefault(table, {})[part] = folder

    def append(self, table: str, rows: DataFrame) -> None:
        """The table has these rows as well."""
        rows.write.parquet(f"{self.store.root}/{self.folder(table)}")
        self._changed[table] = {self.run: self.folder(table)}

    @property
    def layer_name(self) -> str:
        """Layers of a table sort by the version that added them."""
        return f"v{self.base.number + 1:012d}"

    def layer(self, table: str, rows: DataFrame) -> None:
        """The table has these rows as well, as a part that sorts behind those there are."""
        rows.write.parquet(f"{self.store.root}/{self.folder(table)}")
        self._changed[table] = {self.layer_name: self.folder(table)}

    def drop(self, table: str) -> None:
        """The table has no parts."""
        self._changed[table] = {part: None for part in self.base.tables.get(table, {})}

    def fold(self, table: str, rows: DataFrame) -> None:
        """The table is these rows, which may come from its own layers, as a single layer."""
        folder = f"{self.folder(table)}-folded"
        rows.write.parquet(f"{self.store.root}/{folder}")
        self.drop(table)
        self._changed[table][self.layer_name] = folder

    def replace(self, table: str, rows: DataFrame, part: Column, touched: Iterable[str]) -> None:
        """The touched parts of the table are these rows; a part without rows is dropped.

        A part is one file, or several where it outgrows a task: small parts share a task and large
        ones are dealt to as many as their size asks for. ``touched`` is what the caller has read and
        changed, and all rows belong to it.
        """
        touched, home = sorted(set(touched)), f"{self.store.root}/{self.folder(table)}"
        marked = rows.withColumn(_PART, part.cast("string"))
        marked.hint("rebalance", F.col(_PART)).write.partitionBy(_PART).parquet(home)
        files, path = self.store._files(), self.store._path(self.folder(table))
        written = {s.getPath().getName().removeprefix(f"{_PART}=") for s in files.listStatus(path) if s.isDirectory()}
        if not written <= set(touched):
            raise ValueError(f"{table}: rows of parts that were not read: {sorted(written - set(touched))[:5]}")
        self._changed[table] = {
            p: f"{self.folder(table)}/{_PART}={p}" if p in written else None for p in touched
        }

    def preview(self) -> Version:
        """The version as it would be published now."""
        tables = {name: dict(parts) for name, parts in self.base.tables.items()}
        for name, parts in self._changed.items():
            merged = {**tables.get(name, {}), **parts}
            tables[name] = {part: folder for part, folder in merged.items() if folder is not None}
        return Version(self.base.number + 1, tables, self.notes)

    def publish(self) -> Version:
        """Check that every folder of the version is there, then make it visible."""
        version, files = self.preview(), self.store._files()
        for table, parts in self._changed.items():
            for folder in parts.values():
                done = None if folder is None else self.store._path(f"{folder.split('/_part=')[0]}/_SUCCESS")
                if done is not None and not files.exists(done):
                    raise FileNotFoundError(f"{table}: {folder} was not written to its end")
        self.store.add(version)
        return version

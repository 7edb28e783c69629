"""Versions of a set of tables, published together.

Every version is a manifest: a small table that says in which folders each table's rows lie.
Data folders are written first, under new names, and the manifest last; Spark marks it as
complete when all of it is there.  A reader binds to the newest complete manifest, so it sees
all tables of one version whatever is written meanwhile, and a run that ends between
two tables leaves the version before it as it was.  Tables that a version does not change
are listed with their old folders; appended ones with one more.

One writer at a time: two that publish at once from one version are not told apart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plaudit.sources.tables import write_table

_MANIFEST = "kind string, name string, path string, columns string"


@dataclass(frozen=True)
class Snapshot:
    """Tables of one version, each a list of folders, and the batches that it holds."""

    spark: SparkSession
    root: str
    version: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    batches: frozenset[str] = frozenset()

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"version {self.version} of {self.root} has no table {name}")
        schema = StructType.fromJson(json.loads(self.schemas[name]))
        return self.spark.read.schema(schema).parquet(*self.tables[name])


def _manifests(spark: SparkSession, root: str) -> dict[int, bool]:
    """Numbers of all manifests, and whether each is complete."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/manifests")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    found = {}
    for status in files.listStatus(folder):
        path = status.getPath()
        found[int(path.getName().removeprefix("v"))] = files.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
    return found


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The newest complete version; an empty one where nothing was published."""
    complete = [n for n, whole in _manifests(spark, root).items() if whole]
    return at_version(spark, root, max(complete)) if complete else Snapshot(spark, root)


def at_version(spark: SparkSession, root: str, version: int) -> Snapshot:
    # one row for each folder of a table and for each batch
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/v{version:010d}").collect()
    tables: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: r["path"] or ""):
        if row["kind"] == "table":
            tables.setdefault(row["name"], []).append(row["path"])
    schemas = {r["name"]: r["columns"] for r in rows if r["kind"] == "table"}
    return Snapshot(spark, root, version, tables, schemas, frozenset(r["name"] for r in rows if r["kind"] == "batch"))


def put(base: Snapshot, name: str, rows: DataFrame) -> tuple[str, DataFrame]:
    """Write rows under a new name among the data of the versions; they belong to none until
    ``publish`` lists their folder."""
    path = f"{base.root}/data/{name}-{uuid.uuid4().hex}"
    write_table(rows, path, mode="errorifexists")
    return path, base.spark.read.schema(rows.schema).parquet(path)


def publish(
    base: Snapshot,
    replace: Mapping[str, DataFrame],
    append: Mapping[str, DataFrame] | None = None,
    batch: str | None = None,
    placed: Mapping[str, tuple[str, DataFrame]] | None = None,
) -> Snapshot:
    """A version after ``base``: some tables new, some with rows appended, the others as they are.
    ``placed`` are appended rows that ``put`` has written."""
    spark, root = base.spark, base.root
    number = max(_manifests(spark, root), default=0) + 1
    folder = f"{root}/data/{number:010d}-{uuid.uuid4().hex}"
    tables, schemas = dict(base.tables), dict(base.schemas)
    for name, rows in {**replace, **(append or {})}.items():
        path = f"{folder}/{name}"
        write_table(rows, path, mode="errorifexists")
        schemas[name] = rows.schema.json()
        tables[name] = [path] if name in replace else [*tables.get(name, []), path]
    for name, (path, rows) in (placed or {}).items():
        schemas[name] = rows.schema.json()
        tables[name] = [*tables.get(name, []), path]
    batches = base.batches | ({batch} if batch is not None else set())
    listed = [("table", name, path, schemas[name]) for name, paths in tables.items() for path in paths]
    listed += [("batch", name, None, None) for name in sorted(batches)]
    manifest = spark.createDataFrame(listed, _MANIFEST).coalesce(1)
    write_table(manifest, f"{root}/manifests/v{number:010d}", mode="errorifexists")
    return at_version(spark, root, number)


def compact(base: Snapshot, name: str, order_by: str) -> Snapshot:
    """A version in which an appended table lies in one folder again, files ordered by a column."""
    return publish(base, {name: base.read(name).repartitionByRange(order_by).sortWithinPartitions(order_by)})

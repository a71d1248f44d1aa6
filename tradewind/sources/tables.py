"""Writing layers of tables: single tables, atomic layer swaps, BI publication."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession

_VERSIONS = "_versions"
WRITERS = 8  # tables written side by side by one driver

# Shuffle files of a finished query lie on the executors' disks until the driver happens to
# collect its garbage.  With this setting Spark removes them when the query ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SETTING = Lock()
_WRITING: dict[int, tuple[int, str | None]] = {}  # by session: writers, and the setting before them


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside leave no shuffle files; the session's own setting comes back."""
    session = spark._jsparkSession.hashCode()
    with _SETTING:
        writers, before = _WRITING.get(session, (0, None))
        if not writers:
            before = spark.conf.get(_DROP_SHUFFLES, None)
            spark.conf.set(_DROP_SHUFFLES, "true")
        _WRITING[session] = writers + 1, before
    try:
        yield
    finally:
        with _SETTING:
            writers, before = _WRITING.pop(session)
            if writers > 1:
                _WRITING[session] = writers - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def materialize_table(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "overwrite"
) -> DataFrame:
    """Write `df` as Parquet and return the table read back from storage.

    With partition columns the rows go through a rebalance first: each partition value
    gets few well-filled files, and a value holding a large part of the rows is split
    over several tasks by AQE instead of landing in one.  What it shuffled is removed at once.
    """
    columns = list(partition_by)
    out = df.hint("rebalance", *columns) if columns else df
    # Layers are written once and read by many: zstd takes a quarter less room than the default.
    writer = out.write.mode(mode).option("compression", "zstd")
    if columns:
        writer = writer.partitionBy(*columns)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(_stored_schema(df, columns)).parquet(path)


def _stored_schema(df: DataFrame, partition_columns: list[str]):
    """The written schema, so that reading back needs no footer scan."""
    fields = {f.name: f for f in df.schema.fields}
    ordered = [n for n in df.columns if n not in partition_columns] + partition_columns
    schema = type(df.schema)()
    for name in ordered:
        schema = schema.add(name, fields[name].dataType, True)
    return schema


class StoredTables(Mapping):
    """Tables that are stored below `root` when they are first read, each of them once.

    A plan is only made when its table is asked for, and may read other tables of the mapping.
    A reader of one table does not pay for the others; `all` stores many side by side.
    """

    def __init__(
        self,
        plans: Mapping[str, Callable[[], DataFrame]],
        root: str,
        layouts: Mapping[str, list[str]] | None = None,
    ):
        self._plans, self._root, self._layouts = dict(plans), root.rstrip("/"), dict(layouts or {})
        self._locks = {name: Lock() for name in self._plans}
        self._stored: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._stored:
                path, layout = f"{self._root}/{name}", self._layouts.get(name, ())
                self._stored[name] = materialize_table(self._plans[name](), path, layout)
            return self._stored[name]

    def holds(self, name: str) -> bool:
        """Whether a table is stored already."""
        return name in self._stored

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)

    def all(self, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Several tables, by default every one, written side by side."""
        names = list(self if names is None else names)
        with ThreadPoolExecutor(max_workers=min(max(1, len(names)), WRITERS)) as pool:
            return dict(zip(names, pool.map(self.__getitem__, names)))


class StaleVersion(RuntimeError):
    """Somebody else has published since this version was begun."""


class LayerVersion:
    """A new version of layers: tables are put one after another, then published together.

    Tables go into a folder of their own.  Publishing creates the next numbered entry of the
    manifest, a small file that names every table of every layer, and fails if that number is
    taken: of two runs that began from the same version only one gets through, and a run that
    dies half-way never gets there.  Readers stay on the previous version until then, for all
    layers at once; a re-run starts from scratch.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = f"v-{uuid.uuid4().hex}"
        self.folder = f"{self.root}/{self.version}"
        self._follows = max((e["number"] for e in _manifest(spark, self.root)), default=0)
        self._tables: list[dict[str, str]] = []

    def place(self, layer: str = "") -> str:
        return f"{self.folder}/{layer}".rstrip("/")

    def put(self, tables: Mapping[str, DataFrame], layer: str = "") -> dict[str, DataFrame]:
        """Store tables that do not read each other side by side; returns them read back."""

        def store(name: str) -> DataFrame:
            return materialize_table(tables[name], f"{self.place(layer)}/{name}", mode="errorifexists")

        with ThreadPoolExecutor(max_workers=min(max(1, len(tables)), WRITERS)) as pool:
            stored = dict(zip(tables, pool.map(store, tables)))
        self.name(layer, tables)
        return stored

    def name(self, layer: str, names: Iterable[str]) -> None:
        """Tables that were written below `place(layer)` by other means."""
        self._tables += [{"layer": layer, "name": n} for n in names]

    def publish(self) -> None:
        entry = {
            "number": self._follows + 1,
            "version": self.version,
            "written_at": time.time_ns() // 1000,
            "tables": self._tables,
        }
        path = self.spark._jvm.org.apache.hadoop.fs.Path(
            f"{self.root}/{_VERSIONS}/{entry['number']:012d}.json"
        )
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if files.exists(path):
            raise StaleVersion(f"{self.root} has moved on from version {self._follows}")
        try:
            out = files.create(path, False)
        except Py4JJavaError as problem:
            raise StaleVersion(f"{self.root} has moved on from version {self._follows}") from problem
        out.write(bytearray(json.dumps(entry).encode() + b"\n"))
        out.close()


_ENTRY = "number bigint, version string, written_at bigint, tables array<struct<layer string, name string>>"


def _manifest(spark: SparkSession, root: str) -> list[Row]:
    """The entries of a root's manifest by number; one that is being written does not count yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{_VERSIONS}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    entries = spark.read.schema(_ENTRY).json(path.toString())
    return entries.where("number IS NOT NULL AND tables IS NOT NULL").orderBy("number").collect()


def overwrite_layer(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> str:
    """Replace every table of a layer, all or nothing; returns the new version's folder."""
    version = LayerVersion(spark, root)
    version.put(tables)
    version.publish()
    return version.folder


def layer_paths(spark: SparkSession, root: str, layer: str = "") -> dict[str, str]:
    """Where the tables of the current version of a layer lie."""
    root = root.rstrip("/")
    entries = _manifest(spark, root)
    if not entries:
        raise FileNotFoundError(f"no complete version below {root}")
    newest = entries[-1]
    folder = f"{root}/{newest.version}/{layer}".rstrip("/")
    return {t.name: f"{folder}/{t.name}" for t in newest.tables if t.layer == layer}


def read_layer(spark: SparkSession, root: str, layer: str = "") -> dict[str, DataFrame]:
    """The tables of the layer's current version."""
    paths = layer_paths(spark, root, layer)
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def expire_versions(spark: SparkSession, root: str, keep: int = 2, least_age_hours: float = 24) -> list[str]:
    """Remove the files of old versions; returns their names.

    The newest `keep` published versions stay, and so do folders that were changed in the last
    `least_age_hours`: a run may still be writing one, a reader may still be reading the other.
    What runs that died left behind goes too.
    """
    root = root.rstrip("/")
    kept = {e.version for e in _manifest(spark, root)[-keep:]}
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(path):
        name = status.getPath().getName()
        age = time.time() - status.getModificationTime() / 1000
        if name.startswith("v-") and name not in kept and age >= least_age_hours * 3600:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone


def register_tables(spark: SparkSession, paths: Mapping[str, str], database: str) -> dict[str, DataFrame]:
    """Point external catalog tables at stored tables; dropping one never deletes its files.

    A table of the same columns only gets a new location, in one step of the catalog.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in paths.items():
        table, schema = f"{database}.{name}", spark.read.parquet(path).schema
        place = path.replace("'", "\\'")
        if spark.catalog.tableExists(table) and spark.table(table).schema == schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{place}'")
        spark.catalog.refreshTable(table)
    return {name: spark.table(f"{database}.{name}") for name in paths}


def publish_bi_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    path: str,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Expose tables to a BI tool: a layer that changes as a whole, and catalog tables when named.

    All files are complete and published before the first catalog table is turned to them.
    """
    overwrite_layer(spark, tables, path)
    if database:
        return register_tables(spark, layer_paths(spark, path), database)
    return read_layer(spark, path)

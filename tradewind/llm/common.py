"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPE: ContextVar[dict[str, None] | None] = ContextVar("scope", default=None)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared scratch folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor, and is not
    computed again by each of several readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    if (scope := _SCOPE.get()) is not None:
        scope[path] = None
    return spark.read.schema(df.schema).parquet(path)


class Scope:
    def __init__(self):
        self.kept: list[DataFrame] = []

    def keep(self, *frames: DataFrame) -> None:
        """Frames that are read after the scope has ended: their files stay."""
        self.kept.extend(frames)


@contextmanager
def steps_of(spark: SparkSession) -> Iterator[Scope]:
    """Steps stored inside are removed at the end, but for files that kept frames read.

    What stays belongs to the scope around this one.  When the work fails everything stays.
    """
    outer, own, scope = _SCOPE.get(), {}, Scope()
    token = _SCOPE.set(own)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
    read = [name for frame in scope.kept for name in frame.inputFiles()]
    for path in own:
        if any(f"{path}/" in name for name in read):
            if outer is not None:
                outer[path] = None
            continue
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def key_text(column: Column | str) -> Column:
    """The decimal text of an id; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def fold_of(column: Column | str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo the number of folds."""
    return F.crc32(key_text(column).cast("binary")) % folds


def with_fields(df: DataFrame, more: dict[str, str]) -> T.StructType:
    """The frame's schema and more fields, name -> type; all may be null."""
    own = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    extra = [T.StructField(n, T._parse_datatype_string(t)) for n, t in more.items()]
    return T.StructType([*own, *extra])

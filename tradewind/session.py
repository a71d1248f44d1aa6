"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the plans are written for.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth an extra exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Looking up the Python line of every expression takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Shuffled bytes a task should start from, and the least number of partitions.  AQE merges
# what turns out too small; it never adds partitions, so the number grows with the input.
_BYTES_PER_PARTITION = 256 << 20
_LEAST_PARTITIONS = 200

_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()


def sizing_conf(input_bytes: int) -> dict[str, str]:
    """Partition settings for a given size of the raw input.

    The default of 200 shuffle partitions would give half a terabyte to each task at
    100 TB; this asks for enough to keep sorts and aggregations within memory.
    """
    partitions = max(input_bytes // _BYTES_PER_PARTITION, _LEAST_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    }


def input_bytes(spark: SparkSession, folder: str) -> int:
    """The size of all files below a folder, as Spark's file systems list it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def size_for(spark: SparkSession, size: int) -> None:
    """Apply the partition settings for an input size to a running session."""
    for key, value in sizing_conf(size).items():
        spark.conf.set(key, value)


def open_session(
    app_name: str = "tradewind",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the recommended settings; `conf` uses `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sizing = sizing_conf(input_bytes) if input_bytes else {}
    for key, value in {**RECOMMENDED_CONF, **sizing}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in Python workers are found there by import, and a worker does not see
    the driver's module path.  Spark serves the archive from the driver to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tradewind-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session without the setting gets a temporary folder of its own: on a
    cluster a machine-local path would not be visible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tradewind-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return _fresh(spark, "tradewind", label)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a step's own rows, apart from the tables of layers."""
    return _fresh(spark, "tradewind-work", label)


def _fresh(spark: SparkSession, kind: str, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{kind}/{app}/{label}-{uuid.uuid4().hex[:12]}"

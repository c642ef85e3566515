"""Session settings and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import functools
import importlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app_name: str = "statuslight", **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as the session zone."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession, *packages: str) -> None:
    """Send this package, and ``packages``, to the Python workers of a session started elsewhere.

    Model calls run in Python workers, which import their code. A job submitted with
    ``--py-files`` does not need this.
    """
    for name in ("statuslight", *packages):
        if (spark.sparkContext.applicationId, name) in _SHIPPED:
            continue
        root = os.path.dirname(os.path.dirname(os.path.abspath(importlib.import_module(name).__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add((spark.sparkContext.applicationId, name))


_SHIPPED: set[tuple[str, str]] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a
    cluster a missing setting is an error, since a machine-local folder would be
    lost together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="statuslight-")


def written(df: DataFrame, label: str = "stage", paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Used where a value must not be computed twice (paid model calls) or must not
    change between two uses (slice numbers of a range partitioning). The table's path is
    added to ``paths``, for a caller that knows when it is read no more (``discard``).
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``written`` has made and that nothing reads any more."""
    while paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

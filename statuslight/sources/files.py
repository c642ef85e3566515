"""Documents in a folder as a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def discover_files(spark: SparkSession, folder: str, suffix: str = ".pdf", content: bool = False) -> DataFrame:
    """One row per file with the suffix: uri, name, id, length, modified.

    ``id`` is the name without its last extension. File contents are read only with
    ``content=True``, and then by the tasks that use them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.col("path").alias("uri"),
        name.alias("name"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("id"),
        "length",
        F.col("modificationTime").alias("modified"),
        *(["content"] if content else []),
    )


def incremental_discovery(found: DataFrame, known: DataFrame) -> DataFrame:
    """Found files whose id is not known yet."""
    return found.join(known.select("id"), "id", "left_anti")

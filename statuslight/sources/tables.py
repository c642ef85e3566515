"""Table writes: replace by partition, append by name, and verified copies to another place."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuslight.session import written


def read_spread(spark: SparkSession, path: str, min_bytes: int = 2 << 20) -> DataFrame:
    """A Parquet table, spread over all tasks when its files give fewer splits than there are cores.

    A table of one large row group is one split, so one task would do all the work up
    to the first shuffle. Tables with enough splits are read as they are.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    key = (spark.sparkContext.applicationId, path, min_bytes)
    if key not in _NARROW:
        _NARROW[key] = df.rdd.getNumPartitions() < cores and _file_bytes(spark, path) >= min_bytes
    return df.repartition(cores) if _NARROW[key] else df


_NARROW: dict[tuple, bool] = {}


def _file_bytes(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg({"length": "sum"}).first()[0] or 0


def replace_partitions(df: DataFrame, path: str, by: str = "deal_id") -> None:
    """Create or replace the partitions of ``by`` that occur in ``df``, and leave the others.

    The rebalance hint lets adaptive execution split a partition value that holds
    most rows over several files and put small ones together.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def append(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append the named columns."""
    df.select(*columns).write.mode("append").parquet(path)


class Copied(NamedTuple):
    """How many partitions a copy wrote, and how many files of vanished partitions it removed."""

    partitions: int
    removed_files: int


def digests(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``*by, n_rows, digest_1, digest_2``: a digest of the rows of every partition that does not depend on their order.

    Sums of two row hashes, combined before the shuffle. A NULL is told from a value that
    is missing beside it, repeated rows count as often as they occur.
    """

    def content(field: T.StructField) -> list[Column]:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return [F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})]
        return [value, value.isNull()]

    columns = [c for field in df.schema.fields for c in content(field)]
    sums = [F.sum(F.xxhash64(F.lit(n), *columns).cast("decimal(38,0)")).alias(f"digest_{n}") for n in (1, 2)]
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *sums)


def _matching(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    other = right.select(*[F.col(name).alias(f"__{name}") for name in on])
    return left.join(other, reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in on]), how)


def _loaded(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path`` as it is now, or nothing."""
    try:
        spark.catalog.refreshByPath(path)
        spark.read.format(fmt).load(path)
    except AnalysisException:
        return None
    return spark.read.format(fmt).schema(schema).load(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def replicate_table(
    spark: SparkSession, source: str, staging: str, target: str, fmt: str = "parquet", source_fmt: str = "parquet",
    by: Sequence[str] = (),
) -> Copied:
    """Make ``target`` a copy of ``source``, by an export in a self-describing nested format.

    ``by`` names the columns that ``source`` is partitioned by; ``target`` keeps them. Only
    partitions whose digest differs are exported and replaced, those that are gone from
    ``source`` are removed; an equal table is not touched. Export and target are compared
    with ``source`` after they are written; a difference raises and leaves the export, and
    the next run copies what differs then. After success the export is removed. Without
    ``by`` the table is one partition. An empty text cannot be a partition's value (it is
    read back as NULL) and raises. ``fmt='avro'`` needs the spark-avro module on the class path.
    """
    rows = spark.read.format(source_fmt).load(source)
    wanted = written(digests(rows, by), "digests")
    names = wanted.columns
    there = _loaded(spark, target, source_fmt, rows.schema)
    if there is None:
        changed, gone = wanted, None
    else:
        held = written(digests(there, by), "digests")
        changed = written(_matching(wanted, held, names, "left_anti"), "changed")
        gone = _matching(held, wanted, by, "left_anti") if by else None
    count = changed.count()
    if count:
        part = _matching(rows, changed, by, "left_semi") if by else rows
        _write(part, staging, fmt, by)
        exported = _loaded(spark, staging, fmt, rows.schema)
        _compare(exported, changed, by, "the export")
        _write(exported, target, source_fmt, by)
        copied = _loaded(spark, target, source_fmt, rows.schema)
        _compare(_matching(copied, changed, by, "left_semi") if by else copied, changed, by, "the copy")
        _delete(spark, staging)
    removed = 0
    if gone is not None:
        located = there.select(*by, F.col("_metadata.file_path").alias("__file")).distinct()
        for row in written(_matching(located, gone, by, "left_semi"), "gone").toLocalIterator():
            _delete(spark, row["__file"])
            removed += 1
    return Copied(count, removed)


def _write(df: DataFrame, path: str, fmt: str, by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``, or the whole table if it has none."""
    if by:
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(fmt).save(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def _compare(found: DataFrame | None, wanted: DataFrame, by: Sequence[str], what: str) -> None:
    if found is None:
        if wanted.agg(F.sum("n_rows")).first()[0]:
            raise ValueError(f"{what} is missing")
        return
    seen = written(digests(found, by), "digests")
    if seen.count() != wanted.count() or not _matching(wanted, seen, wanted.columns, "left_anti").isEmpty():
        raise ValueError(f"{what} differs from its source")

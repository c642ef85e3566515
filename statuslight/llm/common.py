"""Helpers shared by the operators: input columns, scratch tables, byte-wise lower case."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuslight.session import shared_dir

#: bytes.translate table that lower-cases A-Z and nothing else
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def id_and_text(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id bigint, text string)`` of every row that has an id; a null text becomes empty.

    A row without an id cannot be named in a result, so it takes no part.
    """
    return documents.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("doc_id").isNotNull())


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables an operator writes to the folder all executors share, to cut lineage."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_buckets(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A table in buckets of ``key``, which is not shuffled when it is grouped or joined by it in as many partitions."""
        entry = f"scratch_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, key).option("path", f"{self.root}/{name}").format("parquet").saveAsTable(entry)
        found = self.spark.table(entry)
        self.spark.sql(f"DROP TABLE {entry}")  # the entry of the catalog; the files stay
        return found

    def drop(self, name: str) -> None:
        """Remove a table of this operator that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

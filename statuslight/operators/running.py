"""Exact running sums over data that does not fit one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuslight.session import written


def running_sums(
    df: DataFrame,
    order_by: list[str],
    values: list[str],
    partition_by: list[str] | None = None,
    descending: set[str] | None = None,
    slices: int | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """Add ``<value>_to_date`` for every value: its sum up to and including the row.

    A plain window without a partition would send every row to one task. Here the
    rows are range-partitioned on the order into even slices, each slice is summed
    on its own, and the sums of the earlier slices are added from a table with one
    row per slice. The slice numbers are written out once, because two evaluations
    of a sampled range partitioning need not agree.

    ``order_by`` has to be unique within ``partition_by``. The path of the written rows is
    added to ``paths``.
    """
    keys = partition_by or []
    down = descending or set()
    order = [F.col(c).desc_nulls_last() if c in down else F.col(c).asc_nulls_first() for c in order_by]
    count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lead = [F.col(k).asc_nulls_first() for k in keys]
    sliced = written(
        df.repartitionByRange(count, *lead, *order).withColumn("__slice", F.spark_partition_id()), "slices", paths
    )

    earlier = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "__slice")
        .agg(*[F.sum(v).alias(v) for v in values])
        .select(
            *[F.col(k).alias(f"__{k}") for k in keys],
            F.col("__slice").alias("__offset_slice"),
            *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"__before_{v}") for v in values],
        )
    )
    inside = W.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = sliced.withColumns({f"__local_{v}": F.sum(v).over(inside) for v in values})
    same = [local["__slice"] == offsets["__offset_slice"]]
    same += [local[k].eqNullSafe(offsets[f"__{k}"]) for k in keys]
    joined = local.join(offsets, reduce(lambda a, b: a & b, same))
    totals = {f"{v}_to_date": F.col(f"__local_{v}") + F.col(f"__before_{v}") for v in values}
    return joined.withColumns(totals).select(*df.columns, *totals)

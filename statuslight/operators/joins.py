"""Equi-joins that stay balanced when one key holds a large share of the rows.

Two plans, picked from measured sizes and never from guesses:

* the lookup side is small by count and by bytes: broadcast it;
* otherwise both sides are shuffled once on the key. Adaptive execution splits the fact
  side's partitions that turn out large and hands each piece the lookup rows it needs.

Where adaptive execution does not do that, or a caller gives ``hot_rows``, hot keys are
found by a mergeable sketch and salted: the lookup rows of a hot key are copied to each of
its salts. The sketch is one more pass over the fact side with all that it is made of, so
it is left out where the sizes of the shuffled partitions tell the same. Fact rows with a
NULL key match nothing; they are salted in a left join, so that no task receives all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 2_000_000
#: rows that a task sorts or groups where the number of partitions is set by the rows
TASK_ROWS = 500_000
HOT_KEYS = 10_000
#: keys that a sketch follows, and parts that NULL keys are spread over
TRACKED_KEYS, NULL_PARTS = 100_000, 1_024


def _row_bytes(schema: T.StructType) -> Column:
    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(field.name)))
        return F.lit(16)

    widths = [F.coalesce(width(f), F.lit(0)) + F.lit(16) for f in schema.fields]
    return reduce(lambda a, b: a + b, widths, F.lit(0)).cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count the rows and bytes of ``df`` in one map-side aggregate and check both bounds."""
    seen = df.select(_row_bytes(df.schema).alias("b")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")
    ).first()
    return seen["n"] <= max_rows and seen["b"] <= max_bytes


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions of about ``TASK_ROWS`` rows each, but at least one per core.

    Adaptive execution leaves a stated number as it is. Left to itself it joins small partitions
    up to a size on the wire, which is a small part of what sorts and hash tables hold of it.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS, tracked: int = TRACKED_KEYS) -> DataFrame | None:
    """``__hot, __salts``: hashes of the keys with more than ``hot_rows`` rows and the number of parts they need.

    A frequent-items sketch per task holds ``tracked`` keys and is merged with the others,
    so what is shuffled and collected is bounded by ``tracked`` and not by the keys. A key
    whose rows exceed both ``hot_rows`` and a share of about ``4 / tracked`` is always found;
    one below that share is smaller than the tasks of a table of that size.
    """
    keys = df.where(_present(on)).select(F.xxhash64(*on).alias("__hot"))
    seen = keys.agg(F.expr(f"approx_top_k(__hot, {tracked // 4}, {tracked})").alias("top"))
    found = seen.select(F.inline("top").alias("__hot", "rows")).where(F.col("rows") > hot_rows)
    rows = found.select("__hot", F.ceil(F.col("rows") / F.lit(hot_rows)).cast("int").alias("__salts"))
    listed = rows.collect()  # at most tracked / 4 pairs of numbers
    return df.sparkSession.createDataFrame(listed, rows.schema) if listed else None


def _splits_large_partitions(df: DataFrame) -> bool:
    """Whether adaptive execution splits the partitions of a join that turn out large."""
    return all(df.sparkSession.conf.get(f"spark.sql.adaptive.{name}", "true") == "true" for name in ("enabled", "skewJoin.enabled"))


def _present(on: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in on])


def _equi(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({name: f"__{name}" for name in on})
    matches = [left[name].eqNullSafe(renamed[f"__{name}"]) for name in on]
    return left.join(renamed, reduce(lambda a, b: a & b, matches), how).drop(*[f"__{name}" for name in on])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
) -> DataFrame:
    """``facts`` joined to ``lookup`` on columns of the same name, ``how`` = left or inner; ``hot_rows`` as in ``salted_join``."""
    if fits_broadcast(lookup, broadcast_rows, broadcast_bytes):
        return _equi(facts, F.broadcast(lookup), on, how, null_safe)

    if null_safe:
        # NULL is an ordinary key here: give it a flag so that it can be a hot key as well.
        flags = {f"__null_{n}": F.col(n).isNull() for n in on}
        blanks = {f"__key_{n}": _blank(facts, n) for n in on}
        keyed = [*flags, *blanks]
        joined = lookup_join(
            facts.withColumns({**flags, **blanks}),
            lookup.withColumns({**flags, **{f"__key_{n}": _blank(lookup, n) for n in on}}).drop(*on),
            keyed, how, False, broadcast_rows, broadcast_bytes, hot_rows,
        )
        return joined.drop(*keyed)

    return salted_join(facts, lookup, on, how, hot_rows)


def _blank(df: DataFrame, name: str) -> Column:
    """A stand-in for a NULL key; the flag next to it keeps it apart from real values."""
    kind = df.schema[name].dataType
    zero = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}
    return F.coalesce(F.col(name), F.lit(zero.get(kind.simpleString(), "0")).cast(kind))


def _spread(columns: list[str]) -> Column:
    """Equal rows differ in their partition, which spreads them.

    Both inputs of the hash stay the same when a task runs again, so a lost executor
    cannot send a row elsewhere.
    """
    return F.xxhash64(*[F.col(f"`{name}`") for name in columns], F.spark_partition_id())


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", hot_rows: int | None = None
) -> DataFrame:
    """Join that never broadcasts the right side, as its rows may be many or large (whole texts).

    Without ``hot_rows`` the left side is computed once and adaptive execution splits what
    is large. With it the rows of a key that has more than so many go to several tasks by
    a hash of their content and partition, and the right rows of that key are copied to
    each of them; the left side is computed a second time to find these keys.
    """
    if hot_rows is None and not _splits_large_partitions(left):
        hot_rows = HOT_ROWS
    hot = None if hot_rows is None else hot_keys(left, on, hot_rows)
    present = _present(on)
    if how == "inner":
        left = left.where(present)
        if hot is None:
            return left.join(right, on, how)
    nulls = F.when(~present, F.pmod(_spread(left.columns), F.lit(NULL_PARTS)))
    if hot is None:
        salts, copies = nulls, right.withColumn("__salt", F.lit(0).cast("bigint"))
        spread = left.withColumn("__salt", F.coalesce(salts, F.lit(0)).cast("bigint"))
    else:
        marks = F.broadcast(hot)  # bounded by the sketch
        key = F.xxhash64(*on).alias("__hot")
        parts = F.when(present, F.pmod(_spread(left.columns), F.col("__salts")))
        spread = left.select("*", key).join(marks, "__hot", "left").withColumn(
            "__salt", F.coalesce(parts, nulls, F.lit(0)).cast("bigint")
        ).drop("__hot", "__salts")
        copies = right.select("*", key).join(marks, "__hot", "left").withColumn(
            "__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("__salts"), F.lit(1)).cast("bigint") - 1))
        ).drop("__hot", "__salts")
    return spread.join(copies, [*on, "__salt"], how).drop("__salt")

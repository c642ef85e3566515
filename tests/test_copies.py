"""Copies write what differs, and nothing else."""

import os

import pytest
from pyspark.sql import functions as F

from statuslight.sources import tables


def state(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.startswith("part-")}


def values(df):
    return sorted(df.selectExpr("g", "id", "to_json(list) AS list", "x").collect(), key=str)


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / n) for n in ("source", "staging", "target")]


def grouped(spark, n=60):
    return spark.range(n).select(
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("g"), F.col("id") % 4)).alias("g"), "id",
        F.when(F.col("id") % 5 > 0, F.array(F.struct(F.col("id").cast("string").alias("a"), F.lit(None).cast("int").alias("b")))).alias("list"),
        (F.col("id") / 7).alias("x"),
    )


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_only_changed_partitions_are_written(spark, places, fmt):
    source, staging, target = places
    tables.replace_partitions(grouped(spark), source, "g")

    def copy():
        return tables.replicate_table(spark, source, staging, target, fmt=fmt, by=["g"])

    assert copy() == (4, 0) and not os.path.exists(staging)
    assert sorted(n for n in os.listdir(target) if n.startswith("g=")) == ["g=__HIVE_DEFAULT_PARTITION__", "g=g1", "g=g2", "g=g3"]
    assert values(spark.read.parquet(target)) == values(grouped(spark))
    first = state(target)
    assert copy() == (0, 0) and state(target) == first
    changed = grouped(spark).where("g = 'g2'").withColumn("x", F.col("x") + 1)
    tables.replace_partitions(changed, source, "g")
    assert copy() == (1, 0)
    later = state(target)
    assert {k: v for k, v in later.items() if "g=g2" not in k} == {k: v for k, v in first.items() if "g=g2" not in k}
    assert values(spark.read.parquet(target)) == values(grouped(spark).where("g IS DISTINCT FROM 'g2'").unionByName(changed))


def test_vanished_partitions_are_removed(spark, places):
    source, staging, target = places
    tables.replace_partitions(grouped(spark), source, "g")
    tables.replicate_table(spark, source, staging, target, by=["g"])
    less = grouped(spark).where("g = 'g1' OR g = 'g3'")
    smaller = f"{source}-2"
    tables.replace_partitions(less, smaller, "g")
    done = tables.replicate_table(spark, smaller, staging, target, by=["g"])
    assert done.partitions == 0 and done.removed_files >= 2
    assert values(spark.read.parquet(target)) == values(less)


def test_a_damaged_copy_is_mended(spark, places):
    source, staging, target = places
    tables.replace_partitions(grouped(spark), source, "g")
    tables.replicate_table(spark, source, staging, target, by=["g"])
    tables.replace_partitions(grouped(spark).where("g = 'g3' AND id > 10"), target, "g")
    assert tables.replicate_table(spark, source, staging, target, by=["g"]) == (1, 0)
    assert values(spark.read.parquet(target)) == values(grouped(spark))


def test_tables_without_partitions_and_without_rows(spark, places):
    source, staging, target = places
    grouped(spark).write.parquet(source)
    assert tables.replicate_table(spark, source, staging, target) == (1, 0)
    assert tables.replicate_table(spark, source, staging, target) == (0, 0)
    grouped(spark).limit(0).write.mode("overwrite").parquet(source)
    assert tables.replicate_table(spark, source, staging, target) == (1, 0)
    assert spark.read.parquet(target).count() == 0


def test_digests_tell_nulls_repeats_and_places_apart(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a string, b string, c array<string>").repartition(3)
        return tuple(tables.digests(df).first())

    one = [("x", None, ["p", None]), ("y", "z", [])]
    assert digest(one) == digest(one[::-1])
    others = [[(None, "x", ["p", None]), one[1]], [("x", None, [None, "p"]), one[1]], one + one[:1], [("x", None, None), one[1]], one[:1]]
    assert len({digest(rows) for rows in [one, *others]}) == 6

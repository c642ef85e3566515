"""Joins give the plain join's rows whatever plan the sizes lead to."""

import pytest
from pyspark.sql import functions as F

from statuslight.operators.joins import fits_broadcast, hot_keys, lookup_join, salted_join
from statuslight.operators.running import running_sums
from tests.conftest import rows

SMALL = {"broadcast_rows": 0, "hot_rows": 50}
SPLIT = {"broadcast_rows": 3, "hot_rows": 50}


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on key 1, equal copies among them, and some NULL keys."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 40)
    return spark.range(900).select(key.cast("bigint").alias("k"), (F.col("id") % 7).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    base = spark.range(35).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    return base.unionByName(base.where("k in (1, 5)"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limits", [{}, SMALL, SPLIT, {"broadcast_rows": 0, "hot_rows": 10_000}])
def test_lookup_join(facts, lookup, how, limits):
    assert rows(lookup_join(facts, lookup, ["k"], how, **limits)) == rows(facts.join(lookup, ["k"], how))


@pytest.mark.parametrize("limits", [{}, SMALL, SPLIT])
def test_null_safe_lookup(facts, lookup, limits):
    extra = lookup.unionByName(lookup.limit(1).select(F.lit(None).cast("bigint").alias("k"), F.lit("none").alias("name")))
    got = lookup_join(facts, extra, ["k"], "left", null_safe=True, **limits)
    right = extra.withColumnRenamed("k", "k2")
    want = facts.join(right, facts.k.eqNullSafe(right.k2), "left").drop("k2")
    assert rows(got.select("k", "v", "name")) == rows(want)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join(facts, lookup, how):
    assert rows(salted_join(facts, lookup, ["k"], how, hot_rows=20)) == rows(facts.join(lookup, ["k"], how))


def test_hot_keys_skip_nulls_and_tell_the_parts(facts):
    n = facts.where("k = 1").count()
    key = facts.where("k = 1").select(F.xxhash64("k")).first()[0]
    assert [tuple(r) for r in hot_keys(facts, ["k"], 50).collect()] == [(key, -(-n // 50))]
    assert hot_keys(facts, ["k"], 10_000) is None


def test_sketch_finds_every_hot_key_among_many(spark):
    """60 keys of 100 rows among 30,000 keys of one row, with room for 1,000 keys."""
    df = spark.range(36_000).select(F.when(F.col("id") < 6_000, F.col("id") % 60).otherwise(F.col("id")).alias("k")).repartition(8)
    found = {r["__hot"] for r in hot_keys(df, ["k"], 50, tracked=4_000).collect()}
    assert found == {r[0] for r in df.where("k < 60").select(F.xxhash64("k")).distinct().collect()}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_the_fact_side_is_read_once(spark, facts, lookup, how, tmp_path):
    facts.write.parquet(f"{tmp_path}/facts")
    lookup.write.parquet(f"{tmp_path}/lookup")
    stored, names = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("facts", "lookup"))
    joined = lookup_join(stored, names, ["k"], how, **SMALL)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Union" not in plan
    assert rows(joined) == rows(stored.join(names, ["k"], how))


def test_rows_without_a_key_are_spread(spark):
    facts = spark.range(20_000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
    lookup = spark.range(5).select(F.col("id").alias("k"))
    got = lookup_join(facts, lookup, ["k"], broadcast_rows=0).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in got) == 20_000


def test_fits_broadcast_checks_rows_and_bytes(lookup):
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=10)
    assert not fits_broadcast(lookup.withColumn("text", F.repeat(F.lit("x"), 1000)), max_bytes=10_000)


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("slices", [1, 5])
def test_running_sums(spark, keys, slices):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
        F.when(F.col("id") != 7, (F.col("id") * 37) % 401).alias("o"),
        (F.col("id") % 11).cast("decimal(10,2)").alias("x"),
    )
    from pyspark.sql import Window as W

    window = W.partitionBy(*keys).orderBy(F.col("o").desc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    got = running_sums(df, ["o"], ["x"], partition_by=keys, descending={"o"}, slices=slices)
    want = df.withColumn("x_to_date", F.sum("x").over(window))
    assert [tuple(map(str, r)) for r in rows(got)] == [tuple(map(str, r)) for r in rows(want)]


def test_the_fact_side_is_not_computed_to_plan_the_join(spark, lookup):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    facts = spark.range(300).select((F.col("id") % 40).alias("k")).mapInArrow(count, "k bigint")
    joined = lookup_join(facts, lookup, ["k"], "left", broadcast_rows=0)
    assert seen.value == 0
    assert joined.count() == rows(spark.range(300).select((F.col("id") % 40).alias("k")).join(lookup, "k", "left").groupBy().count())[0][0]

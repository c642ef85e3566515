"""Ranges meet each of their points once, in few rows."""

import datetime as dt

from pyspark.sql import functions as F

from statuslight.operators import evidence
from statuslight.operators.intervals import levels_for, point_nodes, range_nodes

NTZ = "timestamp_ntz"


def test_every_range_is_the_points_between_its_bounds(spark):
    for points in (1, 2, 3, 8, 21):
        levels = levels_for(points)
        ends = spark.range(points).select(F.col("id").cast("int").alias("a"))
        ranges = ends.crossJoin(ends.withColumnRenamed("a", "b"))
        covered = ranges.withColumn("node", F.explode(range_nodes(F.col("a"), F.col("b"), levels)))
        held = ends.select(F.col("a").alias("p"), F.explode(point_nodes(F.col("a"), levels)).alias("node"))
        got = covered.join(held, "node").groupBy("a", "b").agg(F.sort_array(F.collect_list("p")).alias("met")).collect()
        assert {(r.a, r.b): r.met for r in got} == {(a, b): list(range(a, b + 1)) for a in range(points) for b in range(a, points)}
        most = covered.groupBy("a", "b").count().agg(F.max("count")).first()[0]
        assert most <= max(1, 2 * levels)


def test_missing_and_crossed_bounds_have_no_nodes(spark):
    bounds = spark.createDataFrame([(None, 3), (2, None), (3, 2)], "a int, b int")
    assert bounds.select(F.explode(range_nodes(F.col("a"), F.col("b"), 2))).count() == 0


def test_open_tasks_take_a_logarithm_of_the_months(spark):
    """200 months, tasks from the first one on: 200 rows a task would be met, at most 16 are written."""
    stamp = F.lit(dt.datetime(2000, 1, 5)).cast(NTZ)
    tasks = spark.range(50).select(
        F.col("id").alias("task"), F.lit(1).alias("delivery_project_fk"), F.lit(True).alias("is_latest_task_version"), F.lit("Doing").alias("task_status"),
        (stamp + F.make_ym_interval(F.lit(0), F.col("id").cast("int"))).alias("task_start_ts"), F.lit(None).cast(NTZ).alias("task_completed_ts"),
    )
    projects = spark.createDataFrame([(1, 9)], "delivery_project_pk int, company_fk int")
    months = spark.range(200).select(
        F.lit(9).alias("company_pk"), F.lit("x").alias("company_name"), F.lit(1).cast("bigint").alias("copies"),
        F.add_months(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("engagement_month"),
    )
    base, points = evidence.month_points(months)
    levels = levels_for(points)
    nodes = evidence.task_ranges(tasks, base, points).select(F.explode(range_nodes(F.col("first_point"), F.col("last_point"), levels)))
    assert points == 200 and nodes.count() <= 50 * 2 * levels
    met = evidence.tasks_by_month(tasks, projects, months)
    assert met.count() == sum(200 - n for n in range(50))
    assert met.select("task", "engagement_month").distinct().count() == met.count()


def test_no_months_no_tasks(spark):
    months = spark.createDataFrame([], "company_pk int, company_name string, copies bigint, engagement_month date")
    projects = spark.createDataFrame([(1, 9)], "delivery_project_pk int, company_fk int")
    tasks = spark.createDataFrame(
        [(1, True, "Done", dt.datetime(2000, 1, 1), None)],
        "delivery_project_fk int, is_latest_task_version boolean, task_status string, task_start_ts timestamp_ntz, task_completed_ts timestamp_ntz",
    )
    assert evidence.tasks_by_month(tasks, projects, months).count() == 0

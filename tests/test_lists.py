"""Stored lists: exact where all may be searched, near otherwise, and only probed folders are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statuslight.operators import retrieval
from statuslight.operators.lists import VectorLists, lists_for


def frame(spark, data, start=0):
    rows = [(start + i, i % 3, [float(x) for x in v]) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "id bigint, deal_id int, embedding array<double>")


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """3,000 vectors in 25 clusters, some of them twice."""
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(25, 8)) * 6)[rng.integers(0, 25, 3000)] + rng.normal(size=(3000, 8))
    data[1500:1520] = data[:20]
    base = frame(spark, data)
    asked = [(f"q{i}", [float(x) for x in data[i * 70] + 0.1]) for i in range(40)]
    questions = spark.createDataFrame(asked, "question string, vector array<double>")
    path = str(tmp_path_factory.mktemp("lists"))
    return base, questions, VectorLists.train(base, lists_for(3000)).store(base, path)


def found(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_every_row_is_stored_once(clustered):
    base, _, stored = clustered
    assert stored.rows.count() == base.count() == stored.lists.agg(F.sum("n_rows")).first()[0]
    assert stored.rows.select("id").distinct().count() == base.count()


@pytest.mark.parametrize("within", [None, ["deal_id"]])
@pytest.mark.parametrize("k", [1, 10])
def test_all_lists_give_the_exact_result(clustered, within, k):
    base, questions, stored = clustered
    assert found(stored.topk(questions, k, 1.0, within)) == found(retrieval.vector_topk(base, questions, k, within))


def test_more_neighbours_than_a_list_holds(spark, tmp_path):
    base = frame(spark, np.random.default_rng(4).normal(size=(60, 3)))
    questions = spark.createDataFrame([("a", [0.0, 0.0, 0.0]), ("b", [9.0, 9.0, 9.0])], "question string, vector array<double>")
    stored = VectorLists.train(base, 8).store(base, str(tmp_path))
    for k in (25, 100):
        assert found(stored.topk(questions, k, 1.0)) == found(retrieval.vector_topk(base, questions, k))


def test_recall_and_lists_left_out(clustered):
    """A quarter of the lists finds 0.9 of the neighbours; the bound leaves out most lists of an exact search."""
    base, questions, stored = clustered
    exact = {r[:2] for r in retrieval.vector_topk(base, questions, 10).select("question", "id").collect()}
    near = {r[:2] for r in stored.topk(questions, 10, 0.25).select("question", "id").collect()}
    assert len(near & exact) / len(exact) >= 0.9
    asked = questions.withColumn("bar", F.lit(float("inf")))
    first = stored.probes(asked, 10, 1.0, True)
    reached = retrieval.ranked(stored.search(first, 10, []), [], 10).where("rank = 10").select("question", F.col("distance").alias("bar"))
    second = stored.probes(questions.join(reached, "question").select("question", "vector", "bar"), 10, 1.0, False)
    assert first.count() + second.count() < 0.5 * 40 * stored.lists.count()


def test_only_probed_folders_are_read(spark, clustered):
    _, questions, stored = clustered
    one = stored.probes(questions.limit(1).withColumn("bar", F.lit(float("inf"))), 1, 1.0, True)
    plan = stored.search(one, 1, [])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_odd_rows(spark, tmp_path):
    """NULL vectors take no part, NaN comes last, no question gives no row."""
    base = spark.createDataFrame(
        [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [4.0, 4.0])],
        "id bigint, embedding array<double>",
    )
    stored = VectorLists.train(base, 2).store(base, str(tmp_path))
    questions = spark.createDataFrame([("q", [1.0, 1.0]), ("none", None)], "question string, vector array<double>")
    assert [r.id for r in stored.topk(questions, 5, 1.0).orderBy("rank").collect()] == [4, 5, 6, 3]
    assert stored.topk(questions.where("question = 'none'"), 5, 1.0).count() == 0
    with pytest.raises(Exception, match="differ in length"):
        stored.topk(spark.createDataFrame([("q", [1.0])], "question string, vector array<double>"), 5, 1.0).collect()

import zlib

import numpy as np

from statuslight.llm import quality
from tests.llm.conftest import AWKWARD


def walked(model, x):
    total = model.base
    for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
        total += value[node - len(feature)]
    return total


def test_vectorised_walk_matches_one_by_one():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = quality.fit_trees(x, y)
    new = rnd.normal(size=(200, 5))
    assert np.allclose(model.margin(new), [walked(model, row) for row in new])
    assert (((model.score(new) >= 0.5) == ((new[:, 0] > 0.3) ^ (new[:, 1] * new[:, 2] > 0))).mean()) > 0.85


def test_held_out_documents_are_told_apart(spark, small):
    documents, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    scored = quality.score_quality(documents, quality.fit_quality(documents, labels))
    rows = scored.join(labels.select("doc_id", "quality"), "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"])
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()
    assert scored.count() == documents.count()


def test_labels_of_held_out_rows_are_not_used(spark, small):
    documents, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    turned = labels.withColumn("quality", (1 - labels.quality).cast("int")).where(quality.held_out())
    mixed = labels.where(~quality.held_out()).select("doc_id", "quality").unionByName(turned.select("doc_id", "quality"))
    one, two = quality.fit_quality(documents, labels), quality.fit_quality(documents, mixed)
    assert np.array_equal(one.value, two.value)


def test_awkward_rows(spark, awkward, nothing):
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    for labels in (empty, spark.createDataFrame([(3, 1), (6, 0), (7, None), (None, 1), (4, 1)], "doc_id bigint, quality int")):
        model = quality.fit_quality(awkward, labels)
        rows = quality.score_quality(awkward, model).collect()
        assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in AWKWARD if i is not None)
        assert all(0 <= r.score <= 1 for r in rows)
        assert quality.score_quality(nothing, model).count() == 0
    assert quality.statistics(b"") == [0.0] * len(quality.STATISTICS)

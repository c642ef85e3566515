import numpy as np
import pytest

from statuslight.llm import toxicity as tx
from tests.llm.conftest import AWKWARD

NAMES = [*tx.CATEGORY_WORDS, "toxic"]


def test_held_out_toxic_documents_are_caught(spark, small):
    sf = small.replace("sf0.001", "sf0.1")
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = tx.fit_toxicity(documents, tx.category_labels(documents, labels), NAMES)
    rows = tx.score_toxicity(documents, chain).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    bad, good = rows[rows.toxic == 1], rows[rows.toxic == 0]
    assert (bad.predicted == 1).mean() > 0.85 and (good.predicted == 1).mean() < 0.01


def test_later_models_use_earlier_probabilities():
    rnd = np.random.default_rng(4)
    first = rnd.integers(0, 2, 900)
    noise = [np.unique(rnd.integers(10, 60, 5)) for _ in first]
    rows = tx.Rows.of([np.unique(np.r_[n, [1]]) if f else n for f, n in zip(first, noise, strict=True)])
    labels = np.stack([first, first], axis=1).astype(float)
    chain = tx.fit_chain(rows, labels, ["a", "b"], rnd.integers(0, tx.FOLDS, 900))
    assert chain.models[0].earlier.shape == (0,) and chain.models[1].earlier[0] > 0.1
    assert ((chain.probabilities(rows)[:, 1] > 0.5) == first).mean() > 0.99


def test_out_of_fold_probabilities_do_not_see_their_label(monkeypatch):
    seen = []
    real = tx.fit_linear
    monkeypatch.setattr(tx, "fit_linear", lambda rows, earlier, y: seen.append(len(y)) or real(rows, earlier, y))
    rows = tx.Rows.of([np.array([i % 7]) for i in range(90)])
    tx.fit_chain(rows, np.tile(np.arange(90) % 2, (2, 1)).T.astype(float), ["a", "b"], np.arange(90) % 3)
    assert seen == [90, 60, 60, 60, 90]


def test_awkward_rows(spark, awkward, nothing):
    for labels in ([], [(3, 1), (6, 0), (7, None), (None, 1), (9, 0), (9, 0)]):
        table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        chain = tx.fit_toxicity(awkward, tx.category_labels(awkward, table), NAMES)
        rows = tx.score_toxicity(awkward, chain).collect()
        assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in AWKWARD if i is not None)
        assert all(0 <= r.score <= 1 for r in rows)
        assert tx.score_toxicity(nothing, chain).count() == 0

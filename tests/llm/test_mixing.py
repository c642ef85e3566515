import numpy as np
import pytest

from statuslight.llm import mixing
from tests.llm.conftest import AWKWARD

TARGETS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


@pytest.fixture(scope="module")
def mixed(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    labelled = documents.select("text", documents.lang.alias("domain"))
    return mixing.mix(documents, labelled, TARGETS).toPandas()


def test_expected_domain_tokens_meet_the_targets(mixed):
    p, t = np.array(mixed.posterior.tolist()), mixed.n_tokens.to_numpy(float)
    assert (mixed.rate >= 0).all()
    reached = (p * t[:, None] * mixed.rate.to_numpy()[:, None]).sum(axis=0) / t.sum()
    assert np.abs(reached - [TARGETS[n] for n in sorted(TARGETS)]).max() < 5e-3
    assert (np.abs(mixed.copies - mixed.rate) < 1).all()


def test_rates_match_a_plain_solver(mixed):
    """The minimiser of a convex problem: compare the objective with many plain gradient steps."""
    p, t = np.array(mixed.posterior.tolist()), mixed.n_tokens.to_numpy(float)
    w = t / t.sum()
    goal = np.array([TARGETS[n] for n in sorted(TARGETS)])

    def cost(r):
        return 0.5 * ((p.T @ (w * r) - goal) ** 2).sum() + 0.5 * mixing.PENALTY * (w * (r - 1) ** 2).sum()

    r = np.ones(len(p))
    for _ in range(3000):
        r = np.maximum(0, r - 0.5 * (p @ (p.T @ (w * r) - goal) + mixing.PENALTY * (r - 1)))
    assert cost(mixed.rate.to_numpy()) <= cost(r) + 1e-6


def test_targets_out_of_reach_give_zero_rates(spark):
    rows = [(i, "the and of to in is that " * 5 if i % 2 else "der die und das ist nicht ein " * 5, "en" if i % 2 else "de") for i in range(20)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, domain string")
    rates = {r.doc_id: r.rate for r in mixing.mix(documents, documents.select("text", "domain"), {"en": 1.0}).collect()}
    assert all(rates[i] < 0.05 if i % 2 == 0 else rates[i] > 1.5 for i in rates)


def test_awkward_rows(spark, awkward, nothing):
    labelled = awkward.select("text", awkward.rep.alias("domain"))
    for taught in (labelled, labelled.limit(0), labelled.selectExpr("text", "cast(null as string) as domain")):
        rows = mixing.mix(awkward, taught, {"x": 1.0}).collect()
        assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in AWKWARD if i is not None)
        assert all(abs(r.rate - 1) < 1e-6 for r in rows)
    assert mixing.mix(nothing, nothing.selectExpr("text", "text as domain"), {"x": 1.0}).count() == 0
    taken = mixing.repeated(awkward, spark.createDataFrame([(3, 2), (4, 0), (6, 1)], "doc_id bigint, copies bigint"))
    assert taken.columns == awkward.columns
    assert sorted(r.doc_id for r in taken.collect()) == [3, 3, 6]


def test_a_target_without_labelled_rows_shows(spark):
    rows = [(i, "the and of to in is that " * 5, "en") for i in range(9)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, domain string")
    for taught, known in ((documents, True), (documents.limit(0), False)):
        shares = {s.domain: s for s in mixing.mix(documents, taught.select("text", "domain"), {"en": 0.4, "fr": 0.6}).first().shares}
        assert (shares["fr"].target, shares["fr"].reached) == (0.6, 0.0)
        assert not known or shares["en"].target == 1.0 and abs(shares["en"].reached - 1.0) < 1e-3


def test_blank_texts_have_no_tokens(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, " a  b ")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    for taught in (documents.selectExpr("'a b' as text", "'x' as domain"), documents.selectExpr("text", "text as domain").limit(0)):
        assert {r.doc_id: r.n_tokens for r in mixing.mix(documents, taught, {"x": 1.0}).collect()} == {1: 0, 2: 0, 3: 0, 4: 2}


def test_copies_of_rows_whose_columns_clash(spark):
    documents = spark.createDataFrame([(1, "a", 7, "x"), (2, "b", 8, "y")], "doc_id bigint, text string, copies int, row string")
    taken = mixing.repeated(documents, spark.createDataFrame([(1, 2), (2, 0)], "doc_id bigint, copies bigint"))
    assert taken.columns == documents.columns and [tuple(r) for r in taken.collect()] == [(1, "a", 7, "x")] * 2

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp

from statuslight.llm import queries, whitening
from statuslight.llm.whitening import Spectrum

SMALL = st.floats(-50, 50, allow_nan=False).map(lambda v: round(v, 3))


def close(spectrum, rows):
    """The spectrum's matrix is the rows' scatter, its basis orthonormal."""
    centred = rows - rows.mean(axis=0)
    scatter = centred.T @ centred
    scale = max(1.0, np.abs(rows).max() ** 2 * len(rows))
    assert np.abs(spectrum.basis @ np.diag(spectrum.values) @ spectrum.basis.T - scatter).max() < 1e-9 * scale
    assert np.abs(spectrum.basis.T @ spectrum.basis - np.eye(rows.shape[1])).max() < 1e-9
    assert (np.diff(spectrum.values) >= 0).all() and spectrum.n == len(rows)
    assert np.allclose(spectrum.mean, rows.mean(axis=0))


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_updates_give_the_spectrum(data):
    d, n = data.draw(st.integers(1, 8)), data.draw(st.integers(1, 25))
    rows = data.draw(hnp.arrays(float, (n, d), elements=SMALL | st.sampled_from([0.0, 1.0, -1.0])))
    size = data.draw(st.integers(1, 30))
    found = Spectrum.empty(d)
    for at in range(0, n, size):
        found.add(rows[at : at + size])
    close(found, rows)


def test_one_row_at_a_time_in_many_dimensions():
    rnd = np.random.default_rng(1)
    rows = rnd.normal(size=(120, 40)) @ np.diag(np.logspace(0, 5, 40)) + 1e6
    found = Spectrum.empty(40)
    for row in rows:
        found.add(row[None])
    close(found, rows)


def test_combined_spectra_and_equal_rows():
    rnd = np.random.default_rng(2)
    rows = np.repeat(rnd.integers(-3, 4, (5, 12)).astype(float), 30, axis=0)
    parts = [Spectrum.empty(12) for _ in range(4)]
    for k, found in enumerate(parts):
        found.add(rows[k::4])
    whole = Spectrum.empty(12)
    for found in parts:
        whole.merge(Spectrum.load(found.dump()))
    close(whole, rows)


def exactly(x):
    """Eigenpairs of the covariance of integer rows, with integer sums."""
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    centred = np.array([[a - s // n - (s % n) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, centred, values[::-1], basis[:, ::-1], deviation


def scaled(v):
    return [math.floor(64 * c) + 1_000_000 for c in v]


def test_query_matches_a_dense_decomposition(spark, small):
    rows = {r.vec_id: scaled(r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    found = queries.op13_whitening(spark, small).toPandas()
    ids = sorted(rows)
    n, centred, values, basis, deviation = exactly([rows[i] for i in ids])
    table = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert table.shape == (n, 32) and set(found.n) == {n}
    wanted = centred @ basis[:, :32] / np.sqrt(values[:32])
    sign = np.sign((table * wanted).sum(axis=0))
    assert np.abs(table - wanted * sign).max() < 1e-6
    explained = found.drop_duplicates("component").set_index("component").explained.loc[range(1, 33)].to_numpy()
    assert np.allclose(explained, values[:32] / values.sum(), rtol=1e-10)
    assert found.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[ids].tolist() == deviation
    assert found.identity_error.nunique() == 1
    error = np.abs((table - table.mean(axis=0)).T @ (table - table.mean(axis=0)) / n - np.eye(32)).max()
    assert found.identity_error[0] < 1e-10 and error < 1e-10


AWKWARD = [
    (1, [0.5, -0.5, 0.25]), (2, [0.5, -0.5, 0.25]), (2, [3.0, 0.0, -7.0]), (3, None), (4, [0.1, 0.2]), (5, [0.1, None, 0.2]),
    (6, [0.1, math.nan, 0.2]), (7, [0.1, math.inf, 0.2]), (8, []), (None, [1.0, -1.0, 1.0]), (9, [-2.0, 5.0, 0.0]), (10, [9.0, 9.0, 1.0]),
]


def test_awkward_rows(spark):
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in AWKWARD], "vec_id bigint, embedding array<float>, n int, component int")
    kept = [(i, scaled(v)) for i, v in AWKWARD if v is not None and len(v) == 3 and all(c is not None and math.isfinite(c) for c in v)]
    rows = whitening.whiten(table).collect()
    n, _, values, _, deviation = exactly([v for _, v in kept])
    assert sorted((str(r.vec_id), int(r.deviation)) for r in rows) == sorted((str(i), d) for (i, _), d in zip(kept, deviation, strict=True))
    assert all(r.n == n and np.allclose(r.explained, values / values.sum()) and r.identity_error < 1e-9 for r in rows)
    assert whitening.per_component(whitening.whiten(table, components=2)).count() == 2 * n


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)], [(k, [float(k), 2.0]) for k in range(9)]])
def test_directions_without_variance_have_no_whitened_value(spark, rows):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = whitening.whiten(table).collect()
    spread = len({tuple(v) for _, v in rows}) > 1
    for r in found:
        assert (r.whitened[0] is not None) == spread and r.whitened[1] is None
        assert r.explained == ([1.0, 0.0] if spread else [0.0, 0.0]) and r.identity_error < 1e-12


def test_large_numbers_stay_exact(spark):
    rows = [(k, [(-1.0) ** k * 2.0**45 + k, float(k)]) for k in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    wanted = exactly([scaled(v) for _, v in rows])[4]
    assert [int(r.deviation) for r in found.orderBy("vec_id").collect()] == wanted
    assert {r.deviation for r in whitening.per_component(found).collect()} == {None}


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert whitening.per_component(whitening.whiten(nothing)).count() == 0

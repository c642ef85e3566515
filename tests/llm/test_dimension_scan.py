import time

import numpy as np
import pyarrow as pa
import pytest

from statuslight.llm import dimension_scan as ds


def brute(rows, k, every):
    found = {}
    for i, q in rows:
        if i % every == 0:
            scores = sorted((-float(np.dot(v, q)), j) for j, v in rows if j != i)
            found[i] = scores[:k]
    return found


def frame(spark, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(2)
    middles = rnd.normal(size=(12, 24)) * 2
    return [(i, middles[rnd.integers(12)] * rnd.uniform(0.2, 2) + rnd.normal(size=24)) for i in range(1500)]


def test_all_lists_probed_is_exact(spark, vectors, monkeypatch):
    monkeypatch.setattr(ds, "EPSILON", 50.0)
    rows = [*vectors, (1500, vectors[0][1]), (1501, vectors[0][1])]
    found = ds.nearest(frame(spark, rows), k=10, probes=10_000).toPandas()
    for q, best in brute(rows, 10, 20).items():
        mine = found[found.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == [j for _, j in best]
        assert np.allclose(mine.score, [-s for s, _ in best], rtol=1e-12)


def test_production_parameters_find_most_neighbours(spark, small):
    table = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    found = ds.nearest(table).toPandas().groupby("query_id").vec_id.apply(set)
    hits = [len(found[q] & {j for _, j in best}) / len(best) for q, best in brute(rows, 20, 20).items()]
    assert np.mean(hits) >= 0.9


def test_large_lists_are_searched_in_groups(spark, vectors, monkeypatch):
    monkeypatch.setattr(ds, "GROUP_ROWS", 50)
    same = [(i, vectors[0][1]) for i in range(2000, 2600)]
    found = ds.nearest(frame(spark, [*vectors, *same]), k=5, probes=10_000).toPandas()
    best = {q: [j for _, j in b] for q, b in brute([*vectors, *same], 5, 2000).items()}
    assert found[found.query_id == 2000].sort_values("rank").vec_id.tolist() == best[2000]


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 1.0]), (5, [1.0, 2.0, 3.0]), (120, [-1.0, 0.5])]
    table = spark.createDataFrame([(i, v, 9, 1.0) for i, v in rows], "vec_id bigint, embedding array<double>, list int, score double")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ds.nearest(table).collect())
    assert found == [(0, 1, 3, 3.0), (0, 2, 4, 3.0), (0, 3, 120, 0.0), (120, 1, 0, 0.0), (120, 2, 3, -0.5), (120, 3, 4, -0.5)]
    assert ds.nearest(table.where("vec_id = 40")).count() == 0
    assert ds.nearest(table.limit(0)).count() == 0


def test_abandoned_rows_are_far():
    rnd = np.random.default_rng(1)
    rows, query = rnd.normal(size=(3000, 64)), rnd.normal(size=64)
    kept = ds.scan(query, rows, 20)
    true = np.argsort(((rows - query) ** 2).sum(axis=1))[:20]
    assert len(set(true) & set(kept)) >= 19 and len(kept) < 2000


def test_recall_where_lists_outnumber_any_fixed_number_of_probes(spark):
    rnd = np.random.default_rng(7)
    middles = rnd.normal(size=(10, 64)) * 0.3
    v = middles[rnd.integers(10, size=20_000)] + rnd.normal(size=(20_000, 64))
    found = ds.nearest(frame(spark, enumerate(v)), query_every=100).toPandas()
    asked = np.arange(0, 20_000, 100)
    scores = v[asked] @ v.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    mine = found.sort_values(["query_id", "rank"]).groupby("query_id").vec_id.apply(set)
    recall = np.mean([len(mine[q] & set(b)) / 20 for q, b in zip(asked.tolist(), best.tolist())])
    assert recall >= 0.999, recall


def test_bounds_rule_out_far_lists_only():
    rnd = np.random.default_rng(8)
    means = rnd.normal(size=(90, 8)) * 5
    members = means[:, None, :] + rnd.normal(size=(90, 40, 8)) * 0.1
    radius = np.sqrt(((members - means[:, None, :]) ** 2).sum(axis=2)).max(axis=1)
    queries, flat = rnd.normal(size=(30, 8)), members.reshape(-1, 8)
    known = ds._known(flat, np.arange(len(flat)), 20)(np.full(30, -1), queries)
    open_to = ds.Reach(np.hstack([means, np.zeros((90, 1))]), means, radius, None)(queries, known)
    for n, best in enumerate(np.argsort(-(queries @ flat.T), axis=1)[:, :20]):
        assert open_to[n][best // 40].all()
    assert open_to.mean() < 0.3


def test_scanned_pairs_are_measured_together():
    """1,000 queries over 100 lists of 100 rows: a scan for each query and list took 14 s of CPU."""
    rnd = np.random.default_rng(3)
    n, d, lists = 10_000, 64, 100
    v = rnd.normal(size=(n, d))
    bound, rotation = float((v**2).sum(axis=1).max()), np.linalg.qr(rnd.normal(size=(d + 1, d + 1)))[0]
    reach = ds.Reach(np.zeros((lists, d + 1)), np.zeros((lists, d)), np.full(lists, 1e9), None)
    column = pa.FixedSizeListArray.from_arrays(v.ravel(), d).cast(pa.list_(pa.float64()))
    base = pa.table({"vec_id": np.arange(n), "v": column, "list": pa.array(np.arange(n) % lists, pa.int32())})
    asked = pa.table({"vec_id": np.arange(0, n, 10), "v": column.take(pa.array(np.arange(0, n, 10))), "known": np.full(n // 10, -np.inf)})
    asked = asked.append_column("seen", pa.array([[]] * (n // 10), pa.list_(pa.int64())))
    begun = time.process_time()
    found = ds._search(d, 20, rotation, bound, reach)(base, asked).to_pandas()
    assert time.process_time() - begun < 8
    scores = v[::10] @ v.T
    scores[np.arange(n // 10), np.arange(0, n, 10)] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    mine = found.sort_values(["query_id", "score"], ascending=[True, False]).groupby("query_id").vec_id.apply(set)
    assert np.mean([len(mine[10 * q] & set(b)) / 20 for q, b in enumerate(best.tolist())]) >= 0.999


def test_no_query_finds_fewer_than_it_knows_of(monkeypatch):
    monkeypatch.setattr(ds, "EPSILON", -1.0)
    rnd = np.random.default_rng(4)
    v = rnd.normal(size=(600, 32))
    asked = np.arange(0, 600, 20)
    known, seen = ds._known(v, np.arange(600), 20)(asked, v[asked], True)
    reach = ds.Reach(np.zeros((1, 33)), np.zeros((1, 32)), np.full(1, 1e9), None)
    base = pa.table({"vec_id": np.arange(600), "v": pa.array(v.tolist()), "list": pa.array(np.zeros(600, np.int32))})
    sent = pa.table({"vec_id": asked, "v": pa.array(v[asked].tolist()), "known": known, "seen": pa.array(list(seen))})
    found = ds._search(32, 20, np.eye(33), float((v**2).sum(axis=1).max()), reach)(base, sent).to_pandas()
    scores = v[asked] @ v.T
    scores[np.arange(len(asked)), asked] = -np.inf
    for n, best in enumerate(np.argsort(-scores, axis=1)[:, :20].tolist()):
        assert found[found.query_id == asked[n]].vec_id.tolist() == best

import hashlib
import math

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp

from statuslight.llm import centroid_clusters as cc
from statuslight.llm import queries


def plainly(x, centroids):
    gaps = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    return gaps.argmin(axis=1), gaps.min(axis=1)


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_walk_finds_the_nearest_and_the_smallest_number(data):
    d, k, n = data.draw(st.integers(1, 10)), data.draw(st.integers(1, 9)), data.draw(st.integers(1, 20))
    centroids = data.draw(hnp.arrays(np.int64, (k, d), elements=st.integers(-3, 3)))
    x = data.draw(hnp.arrays(np.int64, (n, d), elements=st.integers(-4, 4)))
    number, distance, met = cc.SortedLists(centroids).nearest(x)
    wanted = plainly(x, centroids)
    assert np.array_equal(number, wanted[0]) and np.array_equal(distance, wanted[1]) and (met <= k).all()


def test_walk_stops_early_near_a_centroid():
    rnd = np.random.default_rng(3)
    centroids = rnd.integers(-500, 500, (40, 64))
    x = centroids[rnd.integers(0, 40, 500)] + rnd.integers(-4, 5, (500, 64))
    number, distance, met = cc.SortedLists(centroids).nearest(x)
    assert np.array_equal(number, plainly(x, centroids)[0])
    assert met.mean() < 12  # of 40


def test_largest_components_do_not_overflow():
    centroids = np.array([[cc.LARGEST] * 64, [-cc.LARGEST] * 64])
    number, distance, _ = cc.SortedLists(centroids).nearest(-centroids)
    assert number.tolist() == [1, 0] and distance.tolist() == [0, 0]


def by_hand(rows, clusters, rounds, width, scale, seed):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        for k, vs in held.items():
            centroids[k] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {k: sum(d for _, d, kk in found if kk == k) for k in range(len(centroids))}
    return sorted([(i, k, d, inertia[k], sum(inertia.values()), centroids[k]) for i, d, k in found], key=str)


AWKWARD = [
    (1, [0.5, -0.5, 0.25]), (2, [0.5, -0.5, 0.25]), (2, [0.1, 0.0, -7.0]), (3, None), (4, [0.1, 0.2]), (5, [0.1, None, 0.2]),
    (6, [0.1, math.nan, 0.2]), (7, [0.1, math.inf, 0.2]), (8, []), (None, [1.0, 1.0, 1.0]), (9, [-0.0, 0.0, 0.0]),
    *[(10 + i, [math.sin(i * 7.0), math.cos(i * 3.0), i % 5 - 2.0]) for i in range(60)],
]


def test_awkward_rows_and_repeats(spark):
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in AWKWARD], "vec_id bigint, embedding array<float>, cluster int, x int")
    exact = [(r.vec_id, r.embedding) for r in table.collect()]
    for clusters, rounds in ((7, 3), (200, 2), (1, 0)):
        found = cc.cluster(table, clusters=clusters, rounds=rounds, width=3, scale=16)
        got = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in found.collect()]
        assert sorted(got, key=str) == by_hand(exact, clusters, rounds, 3, 16, 2)


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    found = cc.digest(cc.cluster(nothing))
    assert found.count() == 0 and "centroid_sha256" in found.columns


def test_query_matches_sql(spark, small):
    found = queries.op12_centroid_clusters(spark, small)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    wanted = db.execute(queries.ORACLES["op12_centroid_clusters"])
    names = [c[0] for c in wanted.description]
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(wanted.fetchall())

"""Nearest neighbours by inner product: inverted lists with an adaptive scan over rotated dimensions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch

K = 20
QUERY_EVERY = 20
#: vectors the lists are fitted on, lists at most
SAMPLE_ROWS, MOST_LISTS = 20_000, 4_096
#: vectors of one or more lists that a group holds, and queries that it answers
GROUP_ROWS = ASKED_ROWS = 4_096
#: queries compared with the sample at once, and pairs of query and row that are scanned at once
BOUND_ROWS, PAIRS = 128, 1 << 17
COLUMN_BLOCK = 16
CANDIDATES = 256
#: strictness of the test: larger abandons less
EPSILON = 2.1


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the vectors that take part, in double precision.

    Null ids, null or zero vectors and those with null or non-finite components are left
    out, as are vectors of another length than most (of equally frequent lengths, the
    shorter counts).
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def centres(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from rows spread over the sample."""
    found = sample[np.random.default_rng(5).permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        near = _nearest(sample, found, 1)[:, 0]
        counts = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, sample)
        found[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return found


def _nearest(x: np.ndarray, to: np.ndarray, k: int) -> np.ndarray:
    gaps = (to**2).sum(axis=1)[None, :] - 2 * x @ to.T
    return np.argsort(gaps, axis=1, kind="stable")[:, :k] if k > 1 else gaps.argmin(axis=1)[:, None]


def survivors(queries: np.ndarray, rows: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions, query and row, of the pairs that may lie within the query's limit in squared distance.

    Distances of all pairs grow block of columns by block of columns, and a pair is abandoned
    when its partial distance, scaled to all dimensions, exceeds the limit by more than the
    test allows. Rotated vectors make the columns alike. While many pairs are left, a block of
    columns is one matrix product; later the pairs that are left are measured one by one.
    """
    (asked, d), n = queries.shape, len(rows)
    slack = 1e-9 * ((queries**2).sum(axis=1) + (rows**2).sum(axis=1).max(initial=0.0))  # rounding of products
    alive, partial = np.arange(asked * n), np.zeros(asked * n)
    for begin in range(0, d, COLUMN_BLOCK):
        end = min(d, begin + COLUMN_BLOCK)
        q, r = queries[:, begin:end], rows[:, begin:end]
        if len(alive) == asked * n:
            partial += ((q**2).sum(axis=1)[:, None] + (r**2).sum(axis=1)[None, :] - 2 * (q @ r.T)).ravel()
        elif 4 * len(alive) > asked * n:
            partial = partial + ((q**2).sum(axis=1)[:, None] + (r**2).sum(axis=1)[None, :] - 2 * (q @ r.T)).ravel()[alive]
        else:
            gap = r[alive % n] - q[alive // n]
            partial = partial + np.einsum("ij,ij->i", gap, gap)
        strict = (1 + EPSILON / math.sqrt(end)) ** 2 if end < d else 1.0
        bars = limits * strict * (end / d) + slack
        far = (partial.reshape(asked, n) > bars[:, None]).ravel() if len(alive) == asked * n else partial > bars[alive // n]
        alive, partial = alive[~far], partial[~far]
        if not len(alive):
            break
    return np.divmod(alive, max(1, n))


def scan(query: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of rows that may be among the ``k`` nearest to ``query``; the limit is the k-th best of the rows before."""
    best, kept, limit = np.zeros(0), [np.zeros(0, int)], math.inf
    for at in range(0, len(rows), CANDIDATES):
        part = rows[at : at + CANDIDATES]
        found = survivors(query[None, :], part, np.array([limit]))[1]
        kept.append(found + at)
        best = np.concatenate([best, ((part[found] - query) ** 2).sum(axis=1)])
        limit = np.partition(best, k - 1)[k - 1] if len(best) >= k else math.inf
    return np.concatenate(kept)


@dataclass
class Reach:
    """Which lists can hold one of the ``k`` best of a query.

    No row of a list scores more than the query with the list's mean does, plus the
    query's norm times the list's radius; a list is ruled out if that is less than the
    query is known to reach. With ``probes``, no more than so many nearest lists remain.
    """

    middle: np.ndarray
    means: np.ndarray
    radius: np.ndarray
    probes: int | None

    def __call__(self, queries: np.ndarray, known: np.ndarray) -> np.ndarray:
        norms = np.sqrt((queries**2).sum(axis=1))[:, None]
        slack = 1e-9 * norms * (np.sqrt((self.means**2).sum(axis=1)) + self.radius)
        found = queries @ self.means.T + norms * self.radius + slack >= known[:, None]
        if self.probes is not None and self.probes < len(self.middle):
            near = _nearest(np.hstack([queries, np.zeros((len(queries), 1))]), self.middle, max(2, self.probes))[:, : self.probes]
            allowed = np.zeros_like(found)
            np.put_along_axis(allowed, near, True, axis=1)
            found &= allowed
        return found


def _known(sample: np.ndarray, sample_ids: np.ndarray, k: int):
    """What the ``k``-th best of each query scores at least: the ``k``-th best of the sample, without the query's id.

    With ``seen`` the ids of these ``k`` rows of the sample as well; none if the sample has fewer rows.
    """

    def run(ids: np.ndarray, queries: np.ndarray, seen: bool = False) -> np.ndarray | tuple[np.ndarray, list[np.ndarray]]:
        known, rows = np.full(len(queries), -math.inf), [sample_ids[:0]] * len(queries)
        for at in range(0, len(queries) if len(sample) >= k else 0, BOUND_ROWS):
            scores = queries[at : at + BOUND_ROWS] @ sample.T
            scores[ids[at : at + BOUND_ROWS, None] == sample_ids[None, :]] = -math.inf
            best = np.argpartition(scores, -k, axis=1)[:, -k:]
            rows[at : at + BOUND_ROWS] = sample_ids[best]
            best = np.take_along_axis(scores, best, axis=1).min(axis=1)
            known[at : at + BOUND_ROWS] = best - 1e-9 * np.sqrt((queries[at : at + BOUND_ROWS] ** 2).sum(axis=1) * (sample**2).sum(axis=1).max())
        return (known, rows) if seen else known

    return run


def _top(asked: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` different pairs of each query with the largest score, ties to smaller ids."""
    order = np.lexsort((row, ids[row], -score, asked))
    order = order[np.r_[True, (np.diff(asked[order]) != 0) | (np.diff(row[order]) != 0)][: len(order)]]
    asked, row, score = asked[order], row[order], score[order]
    first = np.arange(len(asked)) - np.searchsorted(asked, asked) < k
    return asked[first], row[first], score[first]


def _search(width: int, k: int, rotation: np.ndarray, bound: float, reach: Reach):
    """Of a group's rows the ``k`` best for each query sent to it that reach what is known, with exact inner products.

    What a query is known to reach, and later its k-th best of the lists before, is its limit:
    vectors are lifted, so that an inner product is a distance. The rows of the sample that it
    is known from take part whatever the test says, so no query finds fewer than ``k``.
    """

    def run(base: pa.Table, asked: pa.Table) -> pa.Table:
        ids, lists = base.column("vec_id").to_numpy(), base.column("list").to_numpy()
        best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query_ids = asked.column("vec_id").to_numpy()
        if len(ids) and len(query_ids):
            order = np.lexsort((ids, lists))
            ids, lists, v = ids[order], lists[order], _matrix(base.column("v").combine_chunks(), width)[order]
            turned = lifted(v, bound) @ rotation
            held, begins = np.unique(lists, return_index=True)
            ends = [*begins[1:].tolist(), len(lists)]
            queries, known = _matrix(asked.column("v").combine_chunks(), width), asked.column("known").to_numpy().copy()
            moved = np.hstack([queries, np.zeros((len(queries), 1))]) @ rotation
            open_to = reach(queries, known)[:, held]
            whole = (queries**2).sum(axis=1) + bound
            seen = asked.column("seen").combine_chunks()
            n = np.repeat(np.arange(len(queries)), seen.value_lengths().to_numpy(zero_copy_only=False))
            by_id, of = np.argsort(ids, kind="stable"), seen.flatten().to_numpy()
            first, last = (np.searchsorted(ids, of, side, sorter=by_id) for side in ("left", "right"))
            n, times = np.repeat(n, last - first), last - first  # an id may come with several rows
            row = by_id[np.repeat(first, times) + np.arange(len(n)) - np.repeat(np.cumsum(times) - times, times)]
            sampled = n, row, (v[row] * queries[n]).sum(axis=1)
            reached = (sampled[2] >= known[n]) & (ids[row] != query_ids[n])
            found, waiting = [tuple(x[reached] for x in sampled)], 0
            for i, (begin, end) in enumerate(zip(begins.tolist(), ends, strict=True)):
                sent = np.flatnonzero(open_to[:, i])
                step = max(1, PAIRS // (end - begin))
                for at in range(0, len(sent), step):
                    part = sent[at : at + step]
                    n, row = survivors(moved[part], turned[begin:end], np.maximum(0.0, whole[part] - 2 * known[part]))
                    n, row = part[n], row + begin
                    score = (v[row] * queries[n]).sum(axis=1)
                    reached = (score >= known[n]) & (ids[row] != query_ids[n])  # the query itself takes no part
                    found.append((n[reached], row[reached], score[reached]))
                    waiting += np.count_nonzero(reached)
                    if waiting > max(PAIRS, len(found[0][0])):
                        best = _top(*map(np.concatenate, zip(*found, strict=True)), ids, k)
                        found, waiting = [best], 0
                        counts = np.bincount(best[0], minlength=len(queries))
                        last = np.cumsum(counts)[counts >= k] - 1
                        known[counts >= k] = np.maximum(known[counts >= k], best[2][last])
            best = _top(*map(np.concatenate, zip(*found, strict=True)), ids, k)
        return pa.table({"query_id": query_ids[best[0]], "vec_id": ids[best[1]], "score": best[2]})

    return run


def lifted(v: np.ndarray, bound: float) -> np.ndarray:
    """One more component that gives all vectors the same norm: the nearest to (q, 0) then has the largest inner product."""
    rest = np.sqrt(np.maximum(0.0, bound - (v**2).sum(axis=1)))
    return np.hstack([v, rest[:, None]])


def nearest(
    vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, probes: int | None = None, sample_rows: int = SAMPLE_ROWS,
    most_lists: int = MOST_LISTS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` found with the largest inner product for each query.

    Queries are the rows whose id is divisible by ``query_every``; ties go to the smaller
    id. The lists' centres are fitted on the ``sample_rows`` rows with the smallest hash of
    their id (a bounded sample); every row is put into the list of its nearest centre.
    A list is left out for a query only if its bound rules it out (see ``Reach``), at any
    number of lists; ``probes`` sets a limit besides. Where lists overlap, all are probed,
    and the work is that of comparing every query with every row. A group holds small
    lists together up to ``GROUP_ROWS`` rows, or a part of a large list by a hash of the id,
    and answers ``ASKED_ROWS`` queries. Ids have to be unique; rows that repeat an id count
    as candidates each. Fewer candidates than ``k`` are returned all.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    rows = scratch.write(usable(vectors, id_col, vector_col), "usable")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("bound"), F.max(F.size("v")).alias("d")).first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if not facts["n"]:
        return spark.createDataFrame([], result)
    d, bound = facts["d"], facts["bound"]
    rotation = np.linalg.qr(np.random.default_rng(11).normal(size=(d + 1, d + 1)))[0]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    sample, sample_ids = np.array(sample["v"].tolist()), sample["vec_id"].to_numpy()
    lists = max(1, min(most_lists, len(sample), round(math.sqrt(facts["n"]))))
    middle = centres(lifted(sample, bound), lists)
    means = middle[:, :d]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), d)
            near = _nearest(lifted(v, bound), middle, 1)[:, 0]
            gap = np.sqrt(((v - means[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array(gap)], ["vec_id", "v", "list", "gap"])

    assigned = scratch.write(rows.mapInArrow(assign, "vec_id bigint, v array<double>, list int, gap double"), "assigned")
    # a row per list: the group it begins with, and the groups it takes
    bins, radius, group, held = [], np.full(lists, -math.inf), -1, GROUP_ROWS
    for r in assigned.groupBy("list").agg(F.count("*").alias("n"), F.max("gap").alias("gap")).orderBy("list").collect():
        parts = math.ceil(r["n"] / GROUP_ROWS)
        if parts > 1 or held + r["n"] > GROUP_ROWS:
            group, held = group + 1, 0
        bins.append((r["list"], group, parts))
        radius[r["list"]], group, held = r["gap"], group + parts - 1, GROUP_ROWS if parts > 1 else held + r["n"]
    groups_of = np.zeros((lists, group + 1), bool)
    for number, first, parts in bins:
        groups_of[number, first : first + parts] = True
    reach, known = Reach(middle, means, radius, probes), _known(sample, sample_ids, k)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("v"), d)
            least, seen = known(batch.column("vec_id").to_numpy(), q, True)
            groups = [np.flatnonzero(x).tolist() for x in reach(q, least) @ groups_of]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least), pa.array(list(seen), pa.list_(pa.int64())), pa.array(groups, pa.list_(pa.int32()))],
                ["vec_id", "v", "known", "seen", "groups"],
            )

    asks = F.col("vec_id") % query_every == 0
    blocks = math.ceil(rows.where(asks).count() / ASKED_ROWS)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))).cast("int")
    table = F.broadcast(spark.createDataFrame(bins, "list int, first int, parts int"))
    base = assigned.join(table, "list").withColumn("group", F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
    base = base.select("group", F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1)))).alias("block"), "vec_id", "v", "list")
    asked = rows.where(asks).mapInArrow(probe, "vec_id bigint, v array<double>, known double, seen array<bigint>, groups array<int>")
    sent = asked.select(F.explode("groups").alias("group"), block.alias("block"), "vec_id", "v", "known", "seen")
    found = base.groupBy("group", "block").cogroup(sent.groupBy("group", "block")).applyInArrow(
        _search(d, k, rotation, bound, reach), "query_id bigint, vec_id bigint, score double"
    )
    best = found.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)"))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

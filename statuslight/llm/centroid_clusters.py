"""Clusters around integer centroids; each vector finds its nearest one by the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 40, 5, 64, 256, 2
#: dimensions that are read one entry further before the threshold is looked at again
STEP_DIMENSIONS = 8
#: vectors that walk their lists together
WALK_ROWS = 4_096
#: largest magnitude of a component, so that squared distances fit into 64 bits
LARGEST = 1 << 27
#: frontier of a list without entries left
ENDED = (2 * LARGEST) ** 2


class SortedLists:
    """The centroids sorted in each dimension, the dimensions in which they differ most first."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, np.int64)
        spread = self.centroids.astype(float).var(axis=0)
        self.dimensions = np.argsort(-spread, kind="stable")
        self.order = np.argsort(self.centroids.T, axis=1, kind="stable")
        self.values = np.take_along_axis(self.centroids.T, self.order, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid, its squared distance, and how many were compared, for each row of ``x``.

        Every dimension's list is walked outward from the row's value. A centroid met for
        the first time is compared in full. Centroids not met yet lie, in every dimension,
        at least as far as the next entry to be read there; a row stops once the sum of
        these squared frontiers is greater than its best distance, or nothing is unmet. On a
        tie the walk goes on, since the unmet centroid may have the smaller number.
        """
        n, (k, d) = len(x), self.centroids.shape
        best, number, met = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64), np.zeros((n, k), bool)
        columns = np.ascontiguousarray(x.T)
        right = np.stack([np.searchsorted(self.values[j], columns[j]) for j in range(d)])
        left = right - 1
        gap_left, gap_right = np.empty((d, n), np.int64), np.empty((d, n), np.int64)
        for j in range(d):
            gap_left[j], gap_right[j] = self._gaps(j, columns[j], left[j], right[j])
        threshold = np.minimum(gap_left, gap_right).sum(axis=0)
        rows = np.arange(n)
        while len(rows):
            for at in range(0, d, STEP_DIMENSIONS):
                part = self.dimensions[at : at + STEP_DIMENSIONS]
                for j in part.tolist():
                    lists = columns[j], left[j], right[j], gap_left[j], gap_right[j]
                    self._read(x, rows, j, *lists, threshold, met, best, number)
                rows = rows[(threshold[rows] <= best[rows]) & ~met[rows].all(axis=1)]
                if not len(rows):
                    break
        return number, best, met.sum(axis=1)

    def _gaps(self, j: int, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances in dimension ``j`` to the next entries on both sides."""
        values, k = self.values[j], len(self.centroids)
        below = np.where(left >= 0, (x - values[np.maximum(left, 0)]) ** 2, ENDED)
        above = np.where(right < k, (values[np.minimum(right, k - 1)] - x) ** 2, ENDED)
        return below, above

    def _read(self, x, rows, j, column, left, right, gap_left, gap_right, threshold, met, best, number) -> None:
        """Read the nearer next entry of dimension ``j`` for ``rows`` and compare it if it is new."""
        below, above, at_left, at_right = gap_left[rows], gap_right[rows], left[rows], right[rows]
        go_left = below <= above
        entry = np.clip(np.where(go_left, at_left, at_right), 0, len(self.centroids) - 1)
        centroid = self.order[j, entry]
        left[rows] = at_left = at_left - go_left
        right[rows] = at_right = at_right + ~go_left
        new_below, new_above = self._gaps(j, column[rows], at_left, at_right)
        gap_left[rows], gap_right[rows] = new_below, new_above
        threshold[rows] += np.minimum(new_below, new_above) - np.minimum(below, above)
        new = ~met[rows, centroid]
        fresh, centroid = rows[new], centroid[new]
        met[fresh, centroid] = True
        gap = x[fresh] - self.centroids[centroid]
        distance = np.einsum("ij,ij->i", gap, gap)
        better = (distance < best[fresh]) | ((distance == best[fresh]) & (centroid < number[fresh]))
        best[fresh[better]], number[fresh[better]] = distance[better], centroid[better]


def integer_vectors(
    vectors: DataFrame, width: int = WIDTH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, x``: the floors of ``scale`` times the components, as little-endian 64-bit integers in one binary value.

    Vectors that are null, of another width, or hold null or non-finite components are left
    out. A component beyond ``LARGEST`` raises an error, since distances would not fit.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            found = np.floor(scale * v)
            if np.abs(found).max(initial=0) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            x = [row.tobytes() for row in found.astype("<i8")]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(x, pa.binary())], ["vec_id", "x"])

    kept = rows.where(F.col("v").isNotNull() & (F.size("v") == width) & fine)
    return kept.mapInArrow(pack, "vec_id bigint, x binary")


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    if not batch.num_rows:
        return np.zeros((0, 0), np.int64)
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i8").reshape(batch.num_rows, -1)


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of seed and id; rows that share an id in order of their bytes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = kept.orderBy(key.asc_nulls_last(), F.hex("x")).limit(clusters).select("x").collect()
    return np.array([np.frombuffer(r["x"], "<i8") for r in chosen], np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of the exact mean of its vectors; one without vectors stays.

    A task adds up its own vectors, so at most (width + 1) sums per cluster and task are shuffled.
    """
    k, d = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, total = SortedLists(centroids), np.zeros((k, d + 1), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, WALK_ROWS):
                x = _unpacked(batch.slice(at, WALK_ROWS))
                number = lists.nearest(x)[0]
                order = np.argsort(number, kind="stable")
                held, begins = np.unique(number[order], return_index=True)
                total[held, :d] += np.add.reduceat(x[order], begins, axis=0)
                total[held, d] += np.diff(np.r_[begins, len(x)])
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, d + 1), pa.int32()), pa.array(np.tile(np.arange(d + 1), len(at)), pa.int32()), pa.array(total[at].ravel())],
            ["cluster", "cell", "v"],
        )

    added = kept.mapInArrow(sums, "cluster int, cell int, v bigint").groupBy("cluster", "cell")
    found = {(r["cluster"], r["cell"]): int(r["v"]) for r in added.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    out = centroids.copy()
    for c in {c for c, _ in found}:
        out[c] = [found[c, j] // found[c, d] for j in range(d)]
    return out


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid, n_compared`` of every kept vector.

    Components become integers (see ``integer_vectors``, which also says what is left
    out), so all sums are exact and the result does not depend on how rows are spread.
    The first centroids are the vectors whose sha256 of "seed:id" is smallest; ``rounds``
    times every vector goes to its nearest centroid (ties: the smaller number) and the
    centroids move to the floor of their mean; then vectors are assigned once more.
    ``n_compared`` counts the centroids that the threshold algorithm compared in full.

    Only centroids and sums per cluster, whose number is a parameter, reach the driver.
    Repeated rows count each, a null id is kept as null and starts no centroid while
    others are left, fewer vectors than ``clusters`` give fewer centroids, other columns
    are ignored, an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "clusters")
    kept = scratch.write(integer_vectors(vectors, width, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>, n_compared int"
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = moved(kept, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            for at in range(0, batch.num_rows, WALK_ROWS):
                part = batch.slice(at, WALK_ROWS)
                number, distance, compared = lists.nearest(_unpacked(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance), pa.array(compared, pa.int32())],
                    ["vec_id", "cluster", "distance", "n_compared"],
                )

    assigned = scratch.write(kept.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint, n_compared int"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    whole = sum(int(r["s"]) for r in sums)
    facts = [(r["cluster"], int(r["s"]), whole, centroids[r["cluster"]].tolist()) for r in sums]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return assigned.join(F.broadcast(table), "cluster").select(  # a row per cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "n_compared"
    )


def digest(found: DataFrame) -> DataFrame:
    """The result with the sha256 of the centroid's components, joined by commas, in place of the centroid."""
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", F.sha2(text.cast("binary"), 256)).drop("centroid")


def sha256_of(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()

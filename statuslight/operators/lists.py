"""Search by inverted lists that are stored as a table with a folder per list."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuslight.operators import retrieval
from statuslight.operators.retrieval import FRACTION_LISTS_TO_SEARCH, TOP_K, matrix_of, ranked, search_blocks
from statuslight.session import written

PROBES = "question string, vector array<double>, list_id int, bound double, bar double"


class VectorLists:
    """Inverted lists: every vector belongs to the list of its nearest centre."""

    def __init__(self, model: KMeansModel):
        self.model = model

    @classmethod
    def train(cls, base: DataFrame, lists: int, seed: int = 7, rows_per_list: int = 256) -> VectorLists:
        """Place the centres. They are fitted on about ``rows_per_list`` vectors per list.

        The sample only decides where the centres lie: every row is assigned to a list.
        Vectors with NULL or non-finite entries are not fitted.
        """
        whole = F.forall(F.col("embedding").cast("array<double>"), lambda x: F.abs(x) < float("inf"))
        vectors = base.where(whole).select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        fraction = min(1.0, lists * rows_per_list / max(1, base.count()))
        seen = vectors if fraction == 1.0 else vectors.sample(fraction, seed)
        return cls(KMeans(k=lists, seed=seed, maxIter=10).fit(seen))

    def assign(self, base: DataFrame) -> DataFrame:
        """Rows with a whole vector and their ``list_id``; non-finite entries are placed as zeros.

        A list with such a row has no finite reach, so no bound leaves it out.
        """
        vector = F.col("embedding").cast("array<double>")
        whole = base.where(vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull()))
        placed = F.transform(vector, lambda x: F.when(F.abs(x) < float("inf"), x).otherwise(0.0))
        listed = self.model.setPredictionCol("list_id").transform(whole.withColumn("features", array_to_vector(placed)))
        return listed.drop("features")

    def store(self, base: DataFrame, path: str) -> StoredLists:
        """Write ``base`` with a folder per list, and next to it centre, reach and size of every list.

        The rebalance hint splits a list that holds most rows over several files.
        """
        spark = base.sparkSession
        self.assign(base).hint("rebalance", "list_id").write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/rows")
        centers = [(n, [float(x) for x in c]) for n, c in enumerate(self.model.clusterCenters())]
        placed = spark.createDataFrame(centers, "list_id int, center array<double>")
        gaps = F.zip_with(F.col("embedding").cast("array<double>"), F.col("center"), lambda x, y: (x - y) * (x - y))
        gap = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x))
        # as many rows as centres, which the driver held already
        reach = spark.read.parquet(f"{path}/rows").join(F.broadcast(placed), "list_id").groupBy("list_id").agg(
            F.max(gap).alias("reach"), F.count("*").alias("n_rows")
        )
        placed.join(reach, "list_id").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
        return StoredLists(spark, path)


class StoredLists:
    """A stored base, searched list by list."""

    def __init__(self, spark: SparkSession, path: str):
        self.rows = spark.read.parquet(f"{path}/rows")
        self.lists = spark.read.parquet(f"{path}/lists")

    def probes(self, questions: DataFrame, k: int, fraction: float, first: bool) -> DataFrame:
        """``PROBES``: the lists that a question has to search.

        Lists are taken from the nearest centre on, at most ``fraction`` of them and at least
        one. ``first`` gives the nearest ones that hold ``k`` rows together; otherwise the rest
        of them, with the distance ``bar`` (a column of ``questions``) that the question has
        reached. ``bound`` is what no row of the list is nearer than: the distance of the
        centre without the list's reach.
        """
        known = self.lists.orderBy("list_id").collect()  # one row per centre
        numbers = np.array([r["list_id"] for r in known], dtype=np.int32)
        centers = np.array([r["center"] for r in known], dtype=float)
        reach = np.array([r["reach"] for r in known], dtype=float)
        sizes = np.array([r["n_rows"] for r in known], dtype=np.int64)
        most = max(1, math.ceil(fraction * len(known)))

        def probe(question: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            gaps = np.sqrt(((centers - question) ** 2).sum(axis=1))
            order = np.argsort(gaps, kind="stable")[:most]
            begun = 1 + int(np.searchsorted(np.cumsum(sizes[order]), k))
            chosen = order[:begun] if first else order[begun:]
            with np.errstate(invalid="ignore"):
                bounds = gaps[chosen] - reach[chosen] - 1e-9 * (gaps[chosen] + reach[chosen])
            return numbers[chosen], np.where(np.isfinite(bounds), np.maximum(bounds, 0.0), 0.0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows == 0 or len(numbers) == 0:
                    continue
                asked = matrix_of(batch.column("vector"))
                if asked.shape[1] != centers.shape[1]:
                    raise ValueError("vectors and questions differ in length")
                bars = batch.column("bar").to_numpy(zero_copy_only=False)
                for row, question in enumerate(asked):
                    ids, bounds = probe(question)
                    if not first:
                        needed = ~(bounds > bars[row])
                        ids, bounds = ids[needed], bounds[needed]
                    if len(ids):
                        one = batch.slice(row, 1).take(pa.array(np.zeros(len(ids), np.int32)))
                        yield pa.RecordBatch.from_arrays(
                            [one.column("question"), one.column("vector"), pa.array(ids), pa.array(bounds), one.column("bar")],
                            ["question", "vector", "list_id", "bound", "bar"],
                        )

        return questions.mapInArrow(run, PROBES)

    def search(self, probes: DataFrame, k: int, within: list[str]) -> DataFrame:
        """The ``k`` nearest rows of each question, group and task among the probed lists.

        Folders of lists that nobody probes are not read: the probed numbers prune them
        while the query runs.
        """
        needed = probes.where(F.col("bound") <= F.col("bar"))
        wanted = F.broadcast(needed.select("list_id").distinct())  # at most one row per centre
        read = self.rows.join(wanted, "list_id", "left_semi")
        return search_blocks(read, needed.select("question", "vector", "list_id"), k, within, "list_id")

    def topk(
        self, questions: DataFrame, k: int = TOP_K, fraction: float = FRACTION_LISTS_TO_SEARCH, within: list[str] | None = None
    ) -> DataFrame:
        """Like ``vector_topk`` over the nearest ``fraction`` of the lists, at least one.

        First a question searches its nearest lists until they hold ``k`` rows; the distance
        of the k-th row then rules out every list whose rows are all farther. With a fraction
        of 1 the result is exact. With ``within`` a group may have no row in the first lists,
        so nothing is ruled out and all lists of the fraction are searched.
        """
        groups = within or []
        vector = F.col("vector").cast("array<double>")
        whole = questions.where(vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull()))
        open_bar = F.lit(float("inf")).alias("bar")
        asked = written(whole.select(F.col("question").cast("string").alias("question"), vector.alias("vector"), open_bar), "questions")
        near = written(self.search(written(self.probes(asked, k, fraction, True), "probes"), k, groups), "near")
        if groups:
            told = asked
        else:
            # a distance that is no number, or fewer than k rows, rules nothing out
            reached = ranked(near, [], k).where(F.col("rank") == k).select(
                "question", F.when(~F.isnan("distance"), F.col("distance")).alias("reached")
            )
            told = asked.join(reached, "question", "left").select("question", "vector", F.coalesce("reached", "bar").alias("bar"))
        rest = self.search(written(self.probes(told, k, fraction, False), "probes"), k, groups)
        return ranked(near.unionByName(rest), groups, k)


def lists_for(rows: int) -> int:
    """As many lists as rows in each of them."""
    return max(2, math.isqrt(rows))

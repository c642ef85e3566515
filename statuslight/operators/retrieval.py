"""Nearest chunks for a set of questions, by comparing blocks of both."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from statuslight.operators.joins import lookup_join
from statuslight.session import written

TOP_K = 10
FRACTION_LISTS_TO_SEARCH = 0.01
QUESTION_BLOCK = 64
#: base rows of a block, question bytes that are broadcast at once, rows that a task keeps
BASE_BLOCK, BROADCAST_BYTES, KEPT_ROWS = 4_096, 32 << 20, 200_000


def ranked(pairs: DataFrame, within: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*within, "question").orderBy(F.asc_nulls_last("distance"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(base: DataFrame, within: list[str]) -> DataFrame:
    """Rows with a whole vector; others have no distance and take no part."""
    vector = F.col("embedding").cast("array<double>")
    whole = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull())
    return base.where(whole).select(*within, "id", vector.alias("embedding"))


def matrix_of(lists: pa.Array) -> np.ndarray:
    """A row per vector. Vectors of different length raise."""
    sizes = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError("vectors differ in length")
    width = int(sizes[0]) if len(sizes) else 0
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), float).reshape(len(lists), width)


def question_blocks(questions: DataFrame, by: str | None = None) -> DataFrame:
    """``names, matrix, width`` and ``by``: up to ``QUESTION_BLOCK`` questions a row, their vectors as one binary value.

    Questions of one row agree in the number ``by``, if given.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(by).to_numpy() if by else np.zeros(batch.num_rows, np.int32)
            order = np.argsort(keys, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
                for at in range(0, len(rows), QUESTION_BLOCK):
                    part = batch.take(pa.array(rows[at : at + QUESTION_BLOCK]))
                    matrix = matrix_of(part.column("vector"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.column("question").to_pylist()], pa.list_(pa.string())), pa.array([matrix.tobytes()], pa.binary()),
                         pa.array([matrix.shape[1]], pa.int32()), *([part.column(by).slice(0, 1)] if by else [])],
                        ["names", "matrix", "width", *([by] if by else [])],
                    )

    vector = F.col("vector").cast("array<double>").alias("vector")
    asked = questions.select(F.col("question").cast("string").alias("question"), vector, *([by] if by else []))
    whole = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    schema = T.StructType.fromDDL("names array<string>, matrix binary, width int")
    return asked.where(whole).mapInArrow(pack, schema.add(questions.schema[by]) if by else schema)


def base_blocks(base: DataFrame, within: list[str], width: int | None) -> DataFrame:
    """``*within, ids, vectors, width``: up to ``BASE_BLOCK`` neighbouring rows of one group a row.

    A vector of another length than ``width`` raises.
    """
    schema = T.StructType([
        *[base.schema[c] for c in within], T.StructField("ids", T.ArrayType(base.schema["id"].dataType)),
        T.StructField("vectors", T.BinaryType()), T.StructField("width", T.IntegerType()),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[tuple, list[int]] = {}
            keys = zip(*[batch.column(c).to_pylist() for c in within], strict=True) if within else [()] * batch.num_rows
            for row, key in enumerate(keys):
                places.setdefault(key, []).append(row)
            for key, rows in places.items():
                for at in range(0, len(rows), BASE_BLOCK):
                    part = batch.take(pa.array(rows[at : at + BASE_BLOCK]))
                    matrix = matrix_of(part.column("embedding"))
                    if width is not None and matrix.shape[1] != width:
                        raise ValueError("vectors and questions differ in length")
                    ids = part.column("id")
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c).slice(0, 1) for c in within], pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         pa.array([matrix.tobytes()], pa.binary()), pa.array([matrix.shape[1]], pa.int32())], schema.names,
                    )

    return _usable(base, within).mapInArrow(pack, schema)


def nearest_rows(vectors: np.ndarray, ids: list, questions: np.ndarray, k: int) -> list[list[tuple]]:
    """``(distance, id)`` of the ``k`` nearest rows for every question, ties by id, NaN last.

    One matrix product gives all squared distances up to rounding; rows that may be among
    the nearest are measured again, so that equal vectors have equal distances.
    """
    norms, asked = (vectors**2).sum(axis=1), (questions**2).sum(axis=1)
    rough = norms[None, :] + asked[:, None] - 2 * (questions @ vectors.T)
    rough[np.isnan(rough)] = np.inf
    out = []
    for n, question in enumerate(questions):
        near = np.arange(len(ids))
        if len(ids) > k:
            limit = np.partition(rough[n], k - 1)[k - 1]
            if np.isfinite(limit):
                near = np.flatnonzero(rough[n] <= limit + 1e-9 * (asked[n] + abs(limit) + norms[rough[n] <= limit].max()))
        gaps = vectors[near] - question
        distance = np.sqrt(np.add.reduce(gaps * gaps, axis=1))
        out.append(sorted(zip(distance.tolist(), [ids[i] for i in near.tolist()], strict=True), key=_order)[:k])
    return out


def _order(pair: tuple) -> tuple:
    distance, row_id = pair
    return math.isnan(distance), distance if not math.isnan(distance) else 0.0, row_id is not None, row_id


def _searched(within: list[str], k: int, id_type: pa.DataType, key_types: list[pa.DataType]):
    """The ``k`` nearest of each task for every group and question: what is kept is bounded by ``KEPT_ROWS``."""

    def emit(best: dict[tuple, list[tuple]]) -> pa.RecordBatch:
        rows = [(*key, row_id, distance) for key, pairs in best.items() for distance, row_id in pairs]
        kinds = [*key_types, pa.string(), id_type, pa.float64()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*within, "question", "id", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list[tuple]] = {}
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for row in range(batch.num_rows):
                # a batch holds many blocks: they are looked at where they lie, one after another
                width = max(1, columns["width"][row].as_py())
                vectors, questions = (np.frombuffer(columns[c][row].as_buffer()).reshape(-1, width) for c in ("vectors", "matrix"))
                key = tuple(columns[c][row].as_py() for c in within)
                names, ids = columns["names"][row].as_py(), columns["ids"][row].as_py()
                for name, found in zip(names, nearest_rows(vectors, ids, questions, k), strict=True):
                    held = best.get((*key, name))
                    best[(*key, name)] = sorted(held + found, key=_order)[:k] if held else found
            if len(best) * k > KEPT_ROWS:
                yield emit(best)
                best = {}
        yield emit(best)

    return run


def vector_topk(
    base: DataFrame, questions: DataFrame, k: int = TOP_K, within: list[str] | None = None
) -> DataFrame:
    """The ``k`` nearest rows of ``base`` for every question, ties by id.

    ``base``: id, embedding and the ``within`` columns; ``questions``: question, vector.
    With ``within`` (for example deal_id) every group is searched on its own. Rows and
    questions meet in blocks: blocks of questions, as many at a time as ``BROADCAST_BYTES``
    hold, are broadcast to the blocks of base rows, which do not move; a pair of blocks is
    one matrix product. Each task keeps its best ``k`` per group and question, so that only
    these reach the sort. Rows and questions without a whole vector take no part.
    """
    groups = within or []
    return ranked(search_blocks(base, questions, k, groups), groups, k)


def search_blocks(base: DataFrame, questions: DataFrame, k: int, groups: list[str], by: str | None = None) -> DataFrame:
    """``*groups, id, question, distance``: the ``k`` nearest rows of each task. Base and questions agree in ``by``, if given."""
    asked = written(question_blocks(questions, by), "questions")
    facts = asked.agg(F.sum(F.octet_length("matrix") + F.octet_length(F.array_join("names", ""))), F.min("width"), F.max("width")).first()
    if facts[1] != facts[2]:
        raise ValueError("questions differ in length")
    turns = max(1, math.ceil((facts[0] or 0) / BROADCAST_BYTES))
    turn = F.pmod(F.xxhash64("names", *([by] if by else [])), F.lit(turns))
    packed = base_blocks(base, [*groups, *([by] if by else [])], facts[1])
    kinds = {f.name: f.dataType for f in base.schema.fields}
    arrow = [to_arrow_type(kinds[c]) for c in groups]
    shape = T.StructType([*[base.schema[c] for c in groups], T.StructField("question", T.StringType()), T.StructField("id", kinds["id"]), T.StructField("distance", T.DoubleType())])
    parts = []
    for n in range(turns):
        pairs = packed.join(F.broadcast(asked.where(turn == n) if turns > 1 else asked), ["width", *([by] if by else [])])  # of checked size
        parts.append(pairs.mapInArrow(_searched(groups, k, to_arrow_type(kinds["id"]), arrow), shape))
    return reduce(DataFrame.unionByName, parts).select(*groups, "id", "question", "distance")


def rag_context(nearest: DataFrame, chunks: DataFrame, instructions: dict[str, str], within: list[str]) -> DataFrame:
    """The prompt of every group and question: instruction and its nearest chunks, nearest first.

    ``chunks``: ``within``, id, content, uri. A chunk without content or uri is left
    out of the context, as NULL is skipped by string aggregation.
    """
    found = lookup_join(chunks.select(*within, "id", "content", "uri"), nearest, [*within, "id"], how="inner")
    line = F.concat(F.lit("context: "), "content", F.lit(" and reference: "), "uri")
    joined = found.withColumn("line", line).groupBy(*within, "question").agg(
        F.expr("listagg(line, ',') WITHIN GROUP (ORDER BY rank)").alias("context")
    )
    asked = F.create_map(*[F.lit(x) for pair in instructions.items() for x in pair])
    return joined.select(
        *within, "question", F.concat(F.element_at(asked, F.col("question")), "context").alias("prompt")
    )

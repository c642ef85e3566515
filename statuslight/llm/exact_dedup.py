"""Exact duplicates by most-significant-digit radix partitioning of the texts' bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import LOWER, Scratch, id_and_text, utf8

FIRST_WIDTH = 64
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GROWTH = 4


def _heads(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([t[:width].translate(LOWER) for t in texts], pa.binary()),
                ],
                ["doc_id", "n_bytes", "digit"],
            )

    return run


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.translate(LOWER) for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(texts, pa.binary()),
            ],
            ["doc_id", "text_sha256", "n_bytes", "rest"],
        )


def _groups(rows: DataFrame, end: int) -> DataFrame:
    """Groups of at least two rows with equal ``(grp, n_bytes, digit)``; ``open`` if bytes are left after ``end``."""
    counted = rows.groupBy("grp", "n_bytes", "digit").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return counted.where(F.col("group_size") > 1).select(
        "*", (F.col("n_bytes") > end).alias("open"), F.monotonically_increasing_id().alias("next_grp")
    )


def exact_dedup(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    first_width: int = FIRST_WIDTH, growth: int = GROWTH,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row with an id.

    Texts are equal when their bytes are, after lower-casing A-Z; a null text counts
    as empty. Each text is read as a string that starts with its length: the first
    digit is the length and the first ``first_width`` bytes, every further digit the
    bytes that follow, ``growth`` times as many each round, so that the longest text
    of n bytes takes about log(n) rounds. A round counts the rows of each (group,
    digit) with map-side aggregation and joins the counts back; rows that are alone
    leave, groups whose text has ended are duplicates, the rest goes on without the
    bytes already compared. Only bytes are compared: ``text_sha256`` is an output.

    The join is a merge join at every size, so that it spills where groups are many.
    A hot group meets a single count row per round, so the adaptive skew join can
    split it. Of equal texts the largest doc_id stays. Rows that repeat a doc_id and
    its text count in ``group_size`` and share the same ``kept``. Other columns are
    ignored, an empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession, "exact-dedup")
    rows = id_and_text(documents, id_col, text_col)
    root = F.lit(0).cast("bigint").alias("grp")
    width, end, step = first_width, first_width, 0
    first = rows.mapInArrow(_heads(width), "doc_id bigint, n_bytes bigint, digit binary").select("*", root)
    groups = scratch.write(_groups(first, end), "groups-0")
    state = rows.mapInArrow(_bodies, "doc_id bigint, text_sha256 string, n_bytes bigint, rest binary").select("*", root)
    finished = []
    while True:
        digit = F.substring("rest", 1, width)
        split = state.withColumn("digit", digit).join(
            groups.hint("merge"), ["grp", "n_bytes", "digit"], "left"
        ).select(
            "doc_id", "text_sha256", "n_bytes",
            F.coalesce("keep_id", "doc_id").alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            F.coalesce("open", F.lit(False)).alias("open"),
            F.col("next_grp").alias("grp"),
            F.when(F.col("open"), F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )
        parted = scratch.write(split, f"rows-{step}", ["open"])
        finished.append(parted.where(~F.col("open")).select("doc_id", "keep_id", "group_size", "text_sha256"))
        if step:
            scratch.drop(f"rows-{step - 1}/open=true")
        if groups.where("open").limit(1).count() == 0:
            break
        state = parted.where("open").select("doc_id", "text_sha256", "n_bytes", "rest", "grp")
        step, width = step + 1, width * growth
        end += width
        groups = scratch.write(_groups(state.withColumn("digit", F.substring("rest", 1, width)), end), f"groups-{step}")
    whole = reduce(DataFrame.unionByName, finished)
    return whole.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def kept_documents(documents: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that ``decisions`` keeps, with all their columns.

    A row is known by its id and its normalised text, so an id that comes with several
    texts keeps each of those that stays. Rows equal in both are one row; of rows that
    then differ in other columns one is chosen.
    """
    keep = decisions.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    # only A-Z are lowered: the built-in function would change other letters as well
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), UPPER, UPPER.lower())
    known = documents.select("*", F.sha2(F.encode(text, "UTF-8"), 256).alias("__sha"))
    kept = known.join(keep, (known[id_col] == keep["__id"]) & (known["__sha"] == keep["__sha"]), "left_semi")
    return kept.dropDuplicates([id_col, "__sha"]).drop("__sha")

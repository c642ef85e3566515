"""From raw documents to token ids: quality, exact copies, near copies, language mixture, encoding.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet
and read again as the documents of the next one.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statuslight.llm import exact_dedup, jaccard_join, mixing, piece_lattice, quality, queries  # noqa: E402
from statuslight.llm.common import Scratch  # noqa: E402
from statuslight.session import ship  # noqa: E402


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of ``op2`` does not reject; rows without an id go with the rejected."""
    ship(spark)
    model = quality.fit_quality(docs, queries.table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    ship(spark)
    return exact_dedup.kept_documents(docs, exact_dedup.exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    ship(spark)
    groups = jaccard_join.jaccard_groups(docs)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi")


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of ``op8`` wants them."""
    ship(spark)
    labelled = queries.labelled_languages(docs, queries.table(spark, sf_dir, "labels"))
    mixed = mixing.mix(docs, labelled, queries.TARGETS)
    return mixing.repeated(docs, mixed.select("doc_id", "copies"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, text_crc32, round_trip`` of every row, decoded again."""
    ship(spark)
    return queries.digest(piece_lattice.encode(docs, queries.piece_model()))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_languages),
    ("SentencePiece encoding", encode_pieces),
]

#: trees, connected components and Viterbi paths have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written for the next one."""
    ship(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs

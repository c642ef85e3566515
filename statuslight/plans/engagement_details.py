"""Engagement details from documents: chunks, vectors, search, answers, append."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from statuslight.operators import details, generation, retrieval
from statuslight.operators.joins import lookup_join
from statuslight.operators.ledger import CallLedger
from statuslight.session import written
from statuslight.sources.tables import append, replicate_table

Embedder = Callable[[DataFrame], DataFrame]


def question_vectors(spark: SparkSession, embed: Embedder = generation.hash_embedding) -> DataFrame:
    """The three search texts and their vectors."""
    texts = spark.createDataFrame(list(details.SEARCH_TEXTS.items()), "question string, content string")
    return embed(texts).select("question", F.col(generation.EMBEDDING).alias("vector"))


def contexts(vectors: DataFrame, questions: DataFrame, k: int = retrieval.TOP_K) -> DataFrame:
    """The prompt of every deal and question. A deal is searched in its own chunks only.

    ``vectors``: deal_id, uri, id, content, ml_generate_embedding_result.
    """
    # chunk ids are numbered per document, so the uri belongs to the identity of a chunk
    chunks = vectors.withColumn("id", F.concat_ws("#", "uri", "id"))
    base = chunks.select("deal_id", "id", F.col(generation.EMBEDDING).alias("embedding")).where(F.col("embedding").isNotNull())
    nearest = written(retrieval.vector_topk(base, questions, k, within=["deal_id"]), "nearest")
    return retrieval.rag_context(nearest, chunks, details.INSTRUCTIONS, ["deal_id"])


def extract_details(
    vectors: DataFrame, pending: DataFrame, backend: Callable[[], generation.TextBackend],
    embed: Embedder = generation.hash_embedding, callers: int | None = None,
) -> DataFrame:
    """Details of the pending deals: one search and one text call for all deals and questions.

    A deal without chunks has nothing to ask and gives a row without answers.
    """
    return details.parse_details(details.combine_extractions(ask(vectors, pending, backend, embed, callers), generation.RESULT))


def ask(
    vectors: DataFrame, pending: DataFrame, backend: Callable[[], generation.TextBackend],
    embed: Embedder = generation.hash_embedding, callers: int | None = None, ledger: CallLedger | None = None,
) -> DataFrame:
    """The answer, and its status, of every pending deal and question; without chunks both are empty.

    With a ``ledger`` answered batches survive a run that breaks off.
    """
    deals = pending.select("deal_id").where(F.col("deal_id").isNotNull()).distinct()
    chosen = lookup_join(vectors, deals, ["deal_id"], how="inner")
    prompts = written(contexts(chosen, question_vectors(vectors.sparkSession, embed)), "contexts")
    answers = (ledger or generation).generate_text(prompts, backend, generation.EXTRACTION_OPTIONS, callers=callers)
    asked = written(answers.select("deal_id", "question", generation.RESULT, generation.STATUS), "details")
    every = deals.select("deal_id", F.explode(F.array(*[F.lit(q) for q in details.SEARCH_TEXTS])).alias("question"))
    whole = every.join(asked, ["deal_id", "question"], "left")
    return whole.withColumn(generation.STATUS, F.coalesce(generation.STATUS, F.lit("")))


def extract_and_append(
    vectors: DataFrame, pending: DataFrame, backend: Callable[[], generation.TextBackend], target: str,
    embed: Embedder = generation.hash_embedding, callers: int | None = None, ledger: CallLedger | None = None,
) -> DataFrame:
    """Append the deals whose calls all succeeded; return ``deal_id, question, status`` of the failed calls.

    A deal with a failed call is not appended, so it stays pending.
    """
    answers = written(ask(vectors, pending, backend, embed, callers, ledger), "answers")
    failed = answers.where(F.col(generation.STATUS) != "")
    done = answers.join(failed.select("deal_id").distinct(), "deal_id", "left_anti")
    append(details.parse_details(details.combine_extractions(done, generation.RESULT)), target, details.DETAIL_COLUMNS)
    return failed.select("deal_id", "question", F.col(generation.STATUS).alias("status"))


def pending_deals(registry: DataFrame, target: str) -> DataFrame:
    """Deals of the registry that the details table does not hold yet; all of them before its first rows."""
    spark = registry.sparkSession
    deals = registry.select("deal_id").where(F.col("deal_id").isNotNull()).distinct()
    try:
        known = spark.read.parquet(target).select("deal_id")
    except AnalysisException:  # no details yet
        return deals
    return deals.join(known.where(F.col("deal_id").isNotNull()), "deal_id", "left_anti")


@dataclass
class DetailsRun:
    """Deals that were pending, and ``deal_id, question, status`` of the calls that failed."""

    pending: int
    failed: DataFrame


def details_job(
    vectors: DataFrame, registry: DataFrame, backend: Callable[[], generation.TextBackend], target: str, copy: str,
    embed: Embedder = generation.hash_embedding, callers: int | None = None, ledger: CallLedger | None = None,
) -> DetailsRun:
    """From the deals that lack details to the copied table: find them, ask, append, copy.

    Without pending deals nothing is asked, appended or copied. Deals are appended in one
    write at the end, and the next run finds the rest by what the table holds; what was
    answered before a break is in the ledger.
    """
    spark = vectors.sparkSession
    pending = written(pending_deals(registry, target), "pending")
    count = pending.count()
    if not count:
        return DetailsRun(0, spark.createDataFrame([], "deal_id bigint, question string, status string"))
    failed = extract_and_append(vectors, pending, backend, target, embed, callers, ledger)
    replicate_table(spark, target, f"{copy.rstrip('/')}-staging", copy)
    return DetailsRun(count, failed)

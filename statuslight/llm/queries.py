"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuslight.llm import (
    bit_planes, centroid_clusters, dimension_scan, exact_dedup, jaccard_join, language, licenses, mixing, piece_lattice, quality, toxicity,
    warc_derivatives, whitening,
)
from statuslight.llm.common import Scratch
from statuslight.session import ship

#: wanted share of the tokens of each language
TARGETS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> piece_lattice.Pieces:
    return piece_lattice.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def labelled_languages(documents: DataFrame, labels: DataFrame, rows: int = mixing.LABELLED_ROWS) -> DataFrame:
    """Texts of the labelled documents with their language as domain: the ``rows`` ids with the smallest hash, at most.

    The ids, whose number is bounded by the parameter, are broadcast, so no text is shuffled at any size.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id")).where(F.col("doc_id").isNotNull())
    chosen = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents.join(F.broadcast(chosen), "doc_id", "left_semi").select("text", F.col("lang").alias("domain"))


def digest(encoded: DataFrame) -> DataFrame:
    """Encoded documents with checksums in place of their ids and of the text that these decode to."""
    return encoded.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "text_crc32", "round_trip")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headers of both derivatives of every page, with the size and checksum of their blocks."""
    ship(spark)
    found = warc_derivatives.derivatives(warc_derivatives.responses(table(spark, sf_dir, "pages")))
    return found.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest",
        "payload_digest", "source_headers", F.octet_length("block").cast("bigint").alias("n_bytes"), F.crc32("block").alias("block_crc32"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    documents = table(spark, sf_dir, "documents")
    return quality.score_quality(documents, quality.fit_quality(documents, table(spark, sf_dir, "labels")))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    groups = jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id", "set_id")


def op5_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return bit_planes.read_documents(bit_planes.write_ids(table(spark, sf_dir, "documents"), path, Scratch(spark, "ids")))


def op6_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return dimension_scan.nearest(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    names = [*toxicity.CATEGORY_WORDS, "toxic"]
    return toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, toxicity.category_labels(documents, labels), names))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    documents = table(spark, sf_dir, "documents")
    return mixing.mix(documents, labelled_languages(documents, table(spark, sf_dir, "labels")), TARGETS)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return digest(piece_lattice.encode(table(spark, sf_dir, "documents"), piece_model()))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    documents = table(spark, sf_dir, "documents")
    pieces = [piece for piece, _, _ in piece_model().rows]
    return language.predict_languages(documents, language.fit_languages(documents, pieces))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the embeddings; ``n_compared`` depends on the walk and is left out, so that SQL can state the rest."""
    ship(spark)
    return centroid_clusters.digest(centroid_clusters.cluster(table(spark, sf_dir, "embeddings"))).drop("n_compared")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return whitening.per_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_quality": op2_quality,
    "op3_licenses": op3_licenses,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_bit_planes": op5_bit_planes,
    "op6_dimension_scan": op6_dimension_scan,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_piece_lattice": op10_piece_lattice,
    "op11_language": op11_language,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_whitening": op13_whitening,
}

A_Z = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def cluster_sql(clusters: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Every round as two common table expressions: assignments by all distances, centroids by exact means."""
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {width}),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster, x AS c
            FROM kept QUALIFY cluster < {clusters})"""]
    for k in range(rounds + 1):
        steps.append(f"""
        a{k} AS MATERIALIZED (
            SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
            FROM (SELECT vec_id, x, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
                  FROM kept CROSS JOIN c{k})
            GROUP BY vec_id, x)""")
        if k < rounds:
            steps.append(f"""
        m{k} AS (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c
            FROM (SELECT cluster, j, CAST(sum(x[j]) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
                  FROM a{k} CROSS JOIN range(1, {width + 1}) AS dims(j) GROUP BY cluster, j)
            GROUP BY cluster),
        c{k + 1} AS MATERIALIZED (
            SELECT c{k}.cluster, coalesce(list_transform(m{k}.c, lambda v: CAST(v AS BIGINT)), c{k}.c) AS c
            FROM c{k} LEFT JOIN m{k} ON c{k}.cluster = m{k}.cluster)""")
    return f"""
        WITH {",".join(steps)}
        SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
               CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
    """


ORACLES = {
    "op12_centroid_clusters": cluster_sql(),
    "op9_exact_dedup": f"""
        WITH plain AS (SELECT doc_id, {A_Z} AS norm FROM documents WHERE doc_id IS NOT NULL)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM plain WINDOW same AS (PARTITION BY norm)
    """,
}

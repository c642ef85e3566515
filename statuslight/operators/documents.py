"""Documents to chunks: word windows over text and HTML, as JSON and as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuslight.functions.json_text import answer_value, parsed
from statuslight.functions.numbers import safe_bigint
from statuslight.operators.joins import lookup_join

CHUNK_WORDS = 250

# fixed values: white space between words, and the five predefined entities
SPACE = "[ \\t\\r\\n]+"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def words(text: Column) -> Column:
    """The words of a text; one empty word if it has none."""
    return F.split(F.btrim(text, F.lit(" \t\r\n")), SPACE)


def word_windows(all_words: Column, size: int = CHUNK_WORDS) -> Column:
    """Consecutive windows of ``size`` words; NULL when there is no word.

    ``all_words`` has to be a column, not the expression that splits the text, or
    the text would be split again for every window.
    """
    starts = F.sequence(F.lit(0), F.size(all_words) - 1, F.lit(size))
    pieces = F.transform(starts, lambda i: F.array_join(F.slice(all_words, i + 1, F.lit(size)), " "))
    return F.when((F.size(all_words) > 1) | (all_words[0] != ""), pieces)


def without_tags(html: Column) -> Column:
    """Visible text of an HTML page: scripts, styles, comments and tags become blanks."""
    text = html
    for pattern in ("(?is)<script.*?</script>", "(?is)<style.*?</style>", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
        text = F.regexp_replace(text, pattern, " ")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def footers(html: Column) -> Column:
    """The texts of all footers of a page, in page order."""
    found = F.regexp_extract_all(html, F.lit("(?is)<footer[^>]*>(.*?)</footer>"), 1)
    return F.transform(found, lambda f: F.array_join(words(without_tags(f)), " "))


def chunk_documents(
    documents: DataFrame, keep: list[str], text: Column, footer_texts: Column | None = None, size: int = CHUNK_WORDS
) -> DataFrame:
    """One row per chunk: ``keep``, id, content, page_footers_text, page_span_start, page_span_end.

    A text is one page, so both ends of its span are page 1.
    """
    footer = F.lit(None).cast("string") if footer_texts is None else F.get(footer_texts, 0)
    split = documents.select(*keep, footer.alias("page_footers_text"), words(text).alias("words"))
    pieces = split.select(
        *keep, "page_footers_text", F.posexplode(word_windows(F.col("words"), size)).alias("position", "content")
    )
    return pieces.select(
        *keep,
        F.concat(F.lit("c"), (F.col("position") + 1).cast("string")).alias("id"),
        "content",
        "page_footers_text",
        F.lit("1").alias("page_span_start"),
        F.lit("1").alias("page_span_end"),
    )


def word_count(text: Column) -> Column:
    """The number of words of a text, 0 for one without any."""
    found = words(text)
    return F.when(found == F.array(F.lit("")), 0).otherwise(F.size(found)).cast("bigint")


def chunk_lines(lines: DataFrame, keep: list[str], size: int = CHUNK_WORDS) -> DataFrame:
    """The rows of ``chunk_documents`` for texts whose lines are rows, so that no task holds a text.

    ``lines``: ``keep``, ``line`` and ``first_word``, the number of words in the lines before.
    A line is cut where the windows of its text begin; the pieces of a window are put
    together again, at most ``size`` of them.
    """
    split = lines.where(word_count(F.col("line")) > 0).select(*keep, "first_word", words(F.col("line")).alias("words"))
    first, last = F.col("first_word"), F.col("first_word") + F.size("words") - 1
    windows = F.sequence(F.floor(first / size), F.floor(last / size))

    def piece(window: Column) -> Column:
        begin, end = F.greatest(window * size, first), F.least((window + 1) * size - 1, last)
        part = F.slice("words", (begin - first + 1).cast("int"), (end - begin + 1).cast("int"))
        return F.struct(window.alias("position"), F.array_join(part, " ").alias("piece"))

    pieces = split.select(*keep, "first_word", F.inline(F.transform(windows, piece)))
    content = F.expr("listagg(piece, ' ') WITHIN GROUP (ORDER BY first_word)")
    return pieces.groupBy(*keep, "position").agg(content.alias("content")).select(
        *keep,
        F.concat(F.lit("c"), (F.col("position") + 1).cast("string")).alias("id"),
        "content",
        F.lit(None).cast("string").alias("page_footers_text"),
        F.lit("1").alias("page_span_start"),
        F.lit("1").alias("page_span_end"),
    )


def process_documents(
    documents: DataFrame, keep: list[str], text: Column, footer_texts: Column | None = None, size: int = CHUNK_WORDS
) -> DataFrame:
    """One JSON result per document, holding its chunks as a layout parser returns them."""
    notes = F.coalesce(footer_texts, F.array()) if footer_texts is not None else F.array().cast("array<string>")
    footer_structs = F.transform(notes, lambda t: F.struct(t.alias("text")))
    split = documents.select(*keep, footer_structs.alias("notes"), words(text).alias("words"))
    windows = F.coalesce(word_windows(F.col("words"), size), F.array().cast("array<string>"))
    chunks = F.transform(
        windows,
        lambda piece, i: F.struct(
            F.concat(F.lit("c"), (i + 1).cast("string")).alias("chunkId"),
            piece.alias("content"),
            F.col("notes").alias("pageFooters"),
            F.struct(F.lit(1).alias("pageStart"), F.lit(1).alias("pageEnd")).alias("pageSpan"),
        ),
    )
    result = F.struct(F.struct(chunks.alias("chunks")).alias("chunkedDocument"))
    return split.select(*keep, F.to_json(result).alias("ml_process_document_result"))


def parse_chunks(results: DataFrame, keep: list[str]) -> DataFrame:
    """Chunk rows of processed documents; documents without chunks give no row.

    The array is cut into its chunks as text, so a document may be larger than a variant;
    only single chunks are parsed. A result that is not blank and no JSON raises.
    """
    result = F.col("ml_process_document_result")
    broken = (F.trim(result) != "") & F.get_json_object(result, "$").isNull()
    text = F.when(broken, F.raise_error(F.lit("a processed document is not valid JSON")).cast("string")).otherwise(
        F.get_json_object(result, "$.chunkedDocument.chunks")
    )
    chunks = F.from_json(text, "array<string>")
    # fixed values: the paths of a processed document
    paths = {
        "id": "$.chunkId",
        "content": "$.content",
        "page_footers_text": "$.pageFooters[0].text",
        "page_span_start": "$.pageSpan.pageStart",
        "page_span_end": "$.pageSpan.pageEnd",
    }
    exploded = results.select(*keep, F.explode(chunks).alias("__text")).withColumn("__chunk", parsed(F.col("__text")))
    return exploded.select(*keep, *[answer_value(F.col("__chunk"), F.col("__text"), path).alias(name) for name, path in paths.items()])


def numeric_ids(names: DataFrame, column: str = "name") -> DataFrame:
    """Names that consist of digits only, with their value as bigint (NULL beyond 64 bits)."""
    kept = names.where(F.col(column).rlike("^[0-9]+$"))
    return kept.select(column, safe_bigint(F.col(column)).alias("deal_id"))


def document_registry(chunks: DataFrame) -> DataFrame:
    """The deals that have chunks, with their number."""
    return chunks.groupBy("deal_id").agg(F.count("*").alias("chunks"))


def embedding_worklist(ids: DataFrame, registry: DataFrame) -> DataFrame:
    """Every id with ``ready``: whether its chunks exist and it can be embedded, or has to be skipped."""
    known = registry.select("deal_id").distinct().withColumn("ready", F.lit(True))
    return lookup_join(ids, known, ["deal_id"]).withColumn("ready", F.coalesce("ready", F.lit(False)))


def pending_deals(names: DataFrame, existing: DataFrame, column: str = "name") -> DataFrame:
    """Deals named in the catalog that have no details yet, with NOT IN semantics.

    A NULL among the existing ids makes NOT IN unknown for every deal, so nothing is
    pending then. The check stops at the first NULL; the rest is a plain anti join,
    which unlike the null-aware one does not need the list to fit in memory.
    """
    ids = names.select(safe_bigint(F.col(column)).alias("deal_id")).where(F.col("deal_id").isNotNull())
    if existing.where(F.col("deal_id").isNull()).limit(1).count():
        return ids.where(F.lit(False))
    return ids.join(existing.select("deal_id"), "deal_id", "left_anti")

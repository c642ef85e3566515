"""Files of a folder to chunks and vectors, incrementally and in two steps.

Three append-only tables live under one folder: ``chunks`` and ``vectors``, in a
sub-folder per batch, and the manifest ``files``, which says for every file what it was
when it was read (length, time of change, SHA-256) and which batch holds its rows. A batch
first writes its chunks and vectors; only then its files are entered in the manifest, and
only what the manifest names can be read. A run that breaks off half-way therefore leaves
nothing visible behind, and the next one takes up the files that are not entered. A file
that changed gets new rows under a new batch, the others are not touched or read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from statuslight.functions.numbers import safe_bigint
from statuslight.operators import documents, generation
from statuslight.operators.joins import lookup_join
from statuslight.operators.running import running_sums
from statuslight.session import discard, written
from statuslight.sources import files

#: files whose paths are on the driver, and that are committed, together
BATCH_FILES = 5_000

MANIFEST = "uri string, deal_id bigint, length bigint, modified timestamp, digest string, batch string, chunks bigint, turn bigint"
CHUNKS = "deal_id bigint, uri string, id string, content string, page_footers_text string, page_span_start string, page_span_end string"
VECTORS = f"uri string, id string, {generation.EMBEDDING} array<float>, {generation.STATUS} string"

Embed = Callable[[DataFrame], DataFrame]


def native_embedding(chunks: DataFrame) -> DataFrame:
    """The local embedding, which cannot fail."""
    return generation.hash_embedding(chunks).withColumn(generation.STATUS, F.lit(""))


@dataclass
class Ingested:
    """What a run did: files read, files entered as done, and ``uri, reason`` of those that failed."""

    read: int
    done: int
    failed: DataFrame


@dataclass
class Ingestion:
    """Files with ``suffix`` in ``folder``, ingested into the tables under ``target``.

    A file belongs to the deal whose number is its name without extension; other names
    have no deal and are left alone, as are empty files, which Spark does not list. Files are
    UTF-8 text and read by line, in as many tasks as their size asks for. Other files need
    ``text``, which turns the column ``content`` (bytes) into text; then a task holds a whole
    file, of 2 GB at most. ``embed`` adds a vector and a status to chunk rows, for example
    through a ``CallLedger``; a file with a chunk that could not be embedded stays pending.
    """

    spark: SparkSession
    folder: str
    target: str
    suffix: str = ".txt"
    text: Callable[[Column], Column] | None = None
    embed: Embed = native_embedding
    batch_files: int = BATCH_FILES

    def manifest(self) -> DataFrame:
        """The last entry of every file."""
        entries = self._table("files", MANIFEST)
        latest = Window.partitionBy("uri").orderBy(F.desc("turn"))
        return entries.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n", "entry")

    def chunks(self) -> DataFrame:
        """Chunk rows of the files as they are entered in the manifest."""
        return self._current("chunks", CHUNKS)

    def vectors(self) -> DataFrame:
        """Chunk rows with their vectors, the input of the details job."""
        return self.chunks().join(self._current("vectors", VECTORS).drop(generation.STATUS), ["uri", "id"])

    def registry(self) -> DataFrame:
        """The deals that are completely ingested, with their number of files and chunks."""
        return self.manifest().groupBy("deal_id").agg(F.count("*").alias("files"), F.sum("chunks").alias("chunks"))

    def pending(self) -> DataFrame:
        """Files that are new, or whose length or time of change differ from their entry."""
        found = files.discover_files(self.spark, self.folder, self.suffix)
        named = found.where(F.col("id").rlike("^[0-9]+$")).select("uri", safe_bigint(F.col("id")).alias("deal_id"), "length", "modified")
        entry = self.manifest().select(
            "uri", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"), "digest", "batch", F.col("chunks").alias("old_chunks")
        )
        both = lookup_join(named.where(F.col("deal_id").isNotNull()), entry, ["uri"], how="left")
        same = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified"))
        return both.where(~F.coalesce(same, F.lit(False))).drop("old_length", "old_modified")

    def run(self) -> Ingested:
        """Ingest what is pending. Paths of ``batch_files`` files at a time are on the driver; file contents never are."""
        if not self.spark.read.format("binaryFile").option("pathGlobFilter", f"*{self.suffix}").option("recursiveFileLookup", "true").load(self.folder).limit(1).count():
            return Ingested(0, 0, self.spark.createDataFrame([], "uri string, reason string"))
        todo = written(self.pending(), "pending")
        count = todo.count()
        batches = math.ceil(count / self.batch_files)
        todo = todo.withColumn("__batch", F.pmod(F.xxhash64("uri"), F.lit(max(1, batches))))
        turn = (self.manifest().agg(F.max("turn")).first()[0] or 0) + 1
        done, failed = 0, self.spark.createDataFrame([], "uri string, reason string")
        for number in range(batches):
            entered, problems = self._batch(todo.where(F.col("__batch") == number).drop("__batch"), turn)
            done, failed = done + entered, failed.unionByName(problems)
        return Ingested(count, done, failed)

    def _batch(self, todo: DataFrame, turn: int) -> tuple[int, DataFrame]:
        paths = [r["uri"] for r in todo.select("uri").collect()]
        name = uuid.uuid4().hex
        if not paths:
            return 0, self.spark.createDataFrame([], "uri string, reason string")
        scratch: list[str] = []  # tables that are as large as the files and are read until the chunks are written
        rows, cut = self._whole_files(paths, todo) if self.text else self._by_line(paths, todo, scratch)
        touched = rows.where(F.col("digest") == F.col("new_digest"))  # another time of change, the same bytes
        fresh = rows.where(F.col("digest").isNull() | (F.col("digest") != F.col("new_digest")))
        # first step: rows that no entry names yet
        cut(fresh).write.parquet(self._path("chunks", name))
        discard(self.spark, scratch)
        chunks = self.spark.read.schema(CHUNKS).parquet(self._path("chunks", name))
        vectors = self.embed(chunks.select("uri", "id", "content"))
        vectors.select("uri", "id", generation.EMBEDDING, generation.STATUS).write.parquet(self._path("vectors", name))
        vectors = self.spark.read.schema(VECTORS).parquet(self._path("vectors", name))
        problem = F.when(F.col(generation.EMBEDDING).isNull(), F.coalesce(F.nullif(F.col(generation.STATUS), F.lit("")), F.lit("no vector")))
        counted = vectors.groupBy("uri").agg(F.count("*").alias("chunks"), F.max(problem).alias("reason"))
        judged = lookup_join(fresh.drop("batch", *({"text"} & {*fresh.columns})), counted, ["uri"])
        # second step: the entries
        entries = judged.where(F.col("reason").isNull()).select(
            "uri", "deal_id", "length", "modified", F.col("new_digest").alias("digest"), F.lit(name).alias("batch"),
            F.coalesce("chunks", F.lit(0).cast("bigint")).alias("chunks"), F.lit(turn).cast("bigint").alias("turn"),
        )
        kept = touched.select(
            "uri", "deal_id", "length", "modified", "digest", "batch", F.col("old_chunks").alias("chunks"), F.lit(turn).cast("bigint").alias("turn")
        )
        entries.unionByName(kept).write.parquet(self._path("files", name))
        entered = self.spark.read.parquet(self._path("files", name)).count()
        return entered, judged.where(F.col("reason").isNotNull()).select("uri", "reason")

    def _whole_files(self, paths: list[str], todo: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """The files with ``new_digest`` and their text, and what cuts some of them into chunks."""
        read = self.spark.read.format("binaryFile").load(paths).select(
            F.col("path").alias("uri"), F.sha2("content", 256).alias("new_digest"), self.text(F.col("content")).alias("text")
        )
        rows = written(lookup_join(read, todo, ["uri"], how="inner"), "files")
        return rows, lambda fresh: documents.chunk_documents(fresh, ["deal_id", "uri"], F.col("text"))

    def _by_line(self, paths: list[str], todo: DataFrame, scratch: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """The files with ``new_digest``, and what cuts some of them into chunks; no task holds a whole file.

        The words and bytes before a line follow from the counts of the lines, without
        their texts. The digest is that of the length and of the sums of the SHA-256 of
        every line with its place, which are combined before they are shuffled.
        """
        uris = self.spark.read.format("binaryFile").load(paths).select(F.col("path").alias("uri"), F.col("_metadata.file_path").alias("__file"))
        read = self.spark.read.schema("value string").option("lineSep", "\n").text(paths).select(
            F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),  # ascending within a block, which one task reads
            F.decode(F.col("value").cast("binary"), "UTF-8").alias("line"),
        )
        lines = written(read.join(F.broadcast(uris), "__file").drop("__file"), "lines", scratch)
        place = ["uri", "block", "row"]
        # the reader drops a byte order mark, which belongs to the first word
        sums = lines.groupBy("uri").agg((F.sum(F.octet_length("line")) + F.count("*") + 1).alias("bytes"), F.min(F.struct("block", "row")).alias("first"))
        marked = lookup_join(todo, sums, ["uri"], how="inner").where(F.col("length") > F.col("bytes")).select("uri", "first.block", "first.row", F.lit("\ufeff").alias("mark"))
        lines = lines.join(F.broadcast(marked), place, "left").withColumn("line", F.concat(F.coalesce("mark", F.lit("")), "line")).drop("mark")
        counts = running_sums(
            lines.select(*place, documents.word_count(F.col("line")).alias("words"), (F.octet_length("line") + 1).cast("bigint").alias("bytes"), F.sha2("line", 256).alias("hash")),
            ["block", "row"], ["words", "bytes"], partition_by=["uri"], paths=scratch,
        )
        placed = F.sha2(F.concat_ws(":", "bytes_to_date", "hash"), 256)
        quarters = [F.sum(F.conv(F.substring(placed, 1 + 16 * n, 16), 16, 10).cast("decimal(20,0)")).cast("string") for n in range(4)]
        hashes = counts.groupBy("uri").agg(F.concat_ws(":", *quarters).alias("__sums"))
        rows = lookup_join(todo, hashes, ["uri"]).withColumn("new_digest", F.sha2(F.concat_ws(":", "length", "__sums"), 256)).drop("__sums")

        def cut(fresh: DataFrame) -> DataFrame:
            begun = counts.select(*place, (F.col("words_to_date") - F.col("words")).alias("first_word")).join(F.broadcast(fresh.select("uri", "deal_id")), "uri")
            return documents.chunk_lines(lines.join(begun, place), ["deal_id", "uri"])

        return written(rows, "files"), cut

    def _path(self, table: str, batch: str | None = None) -> str:
        root = f"{self.target.rstrip('/')}/{table}"
        # an entry may name an older batch, so the manifest's own folders have another name
        return f"{root}/{'entry' if table == 'files' else 'batch'}={batch}" if batch else root

    def _table(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self._path(table))
        except AnalysisException:  # nothing was ingested yet
            return self.spark.createDataFrame([], schema)

    def _current(self, table: str, schema: str) -> DataFrame:
        """Rows of the batch that the manifest names for their file. The batch is a partition column, so others are pruned."""
        entries = self.manifest().select("uri", "batch")
        rows = self._table(table, f"{schema}, batch string")
        return lookup_join(rows, entries, ["uri", "batch"], how="inner").drop("batch")

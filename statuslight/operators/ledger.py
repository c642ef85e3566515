"""Model calls that are kept as they are answered, so that none is paid for twice.

A ledger is a folder of Parquet files on storage that all executors share, one sub-folder
per bucket of keys. A key is the SHA-256 of the model's name, its options and the input.
A task owns a bucket: it reads the keys already answered there, sends the others in
batches, and commits every answered batch as one file that appears whole or not at all.
If the task, its executor or the whole job ends half-way, the next attempt finds the
committed batches. Failures are rows too; they are sent again by the next run.

Prompts that are too many to be stored or moved are sent by the tasks that make them
(``generate_text_in_place``). A task then owns a folder of its own in place of a bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.operators import generation
from statuslight.operators.generation import TextBackend, VectorBackend
from statuslight.session import written

BUCKETS = 64
KEY = "__call"


def _storage(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder; ``file:/x`` as Spark writes it is understood too."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _with_options(backend: Callable[[], TextBackend], settings: dict) -> Callable[[], Callable[[list], list]]:
    def open_backend():
        answer = backend()
        return lambda prompts: answer(prompts, settings)

    return open_backend


@dataclass(frozen=True)
class CallLedger:
    """The calls of one or more jobs under ``folder``, which pyarrow can write from every executor.

    ``buckets`` is fixed for the life of a ledger: it bounds how many tasks call at once.
    Speculative execution should be off, since two attempts of a task at the same time can
    send the same input.
    """

    folder: str
    model: str = "default"
    buckets: int = BUCKETS

    def generate_text(
        self, df: DataFrame, backend: Callable[[], TextBackend], options: dict | None = None, prompt_col: str = "prompt",
        batch_size: int = 16, retries: int = 2, wait: float = 0.5, callers: int | None = None,
    ) -> DataFrame:
        """Like ``generation.generate_text``. Equal prompts are sent once."""
        settings = dict(options or {})
        return self._called(
            df, _with_options(backend, settings), prompt_col, json.dumps(settings, sort_keys=True), "string", generation.RESULT, batch_size, retries, wait, callers
        )

    def generate_text_in_place(
        self, df: DataFrame, make: Callable[[DataFrame], DataFrame], place: list[str], backend: Callable[[], TextBackend],
        options: dict | None = None, prompt_col: str = "prompt",
        batch_size: int = 16, retries: int = 2, wait: float = 0.5, callers: int | None = None,
    ) -> DataFrame:
        """Like ``generate_text``, without storing or moving prompts; the result lacks ``prompt_col``.

        The columns ``place`` tell the rows of ``df`` apart. ``df`` is made for the keys of its
        prompts, of which one row each is chosen, and ``make`` is given ``place`` of the chosen
        rows and makes these once more, for the calls. Where no prompt is unanswered, nothing is
        made again.
        """
        settings = dict(options or {})
        keyed = self._keyed(df, prompt_col, json.dumps(settings, sort_keys=True))
        rows = written(keyed.drop(prompt_col), "calls")
        asked = rows.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min(F.struct(*place)).alias("row"))
        chosen = written(self._unanswered(asked, "string").select("row.*"), "chosen")
        if not chosen.isEmpty():
            sent = self._keyed(make(chosen), prompt_col, json.dumps(settings, sort_keys=True)).select(KEY, F.col(f"`{prompt_col}`").alias("input"))
            # no shuffle: tasks are put together, so that no more than these call at once
            sent = sent.coalesce(min(callers or self.buckets, self.buckets))
            task = self._task(_with_options(backend, settings), "string", batch_size, retries, wait, uuid.uuid4().hex)
            sent.mapInArrow(task, "sent bigint").agg(F.sum("sent")).collect()
        return self._joined(rows, rows.columns[:-1], generation.RESULT, "string")

    def generate_embedding(
        self, df: DataFrame, backend: Callable[[], VectorBackend], content_col: str = "content",
        batch_size: int = 64, retries: int = 2, wait: float = 0.5, callers: int | None = None,
    ) -> DataFrame:
        """Like ``generation.generate_embedding``, with the status of each row besides. Equal contents are sent once."""
        return self._called(df, backend, content_col, "embedding", "array<float>", generation.EMBEDDING, batch_size, retries, wait, callers)

    def _keyed(self, df: DataFrame, column: str, settings: str) -> DataFrame:
        """``df`` with the key of every input; NULL for one that is missing."""
        return df.withColumn(KEY, F.sha2(F.concat(F.lit(f"{self.model}\n{settings}\n"), F.col(f"`{column}`")).cast("binary"), 256))

    def _unanswered(self, asked: DataFrame, kind: str) -> DataFrame:
        known = self.answers(asked.sparkSession, kind)
        return asked if known is None else asked.join(known.where("status = ''").select(KEY), KEY, "left_anti")

    def _joined(self, keyed: DataFrame, columns: list[str], result: str, kind: str) -> DataFrame:
        """``columns`` with the answer and the status that the ledger has for each key."""
        done = self.answers(keyed.sparkSession, kind)
        if done is None:
            return keyed.select(*columns).withColumns({result: F.lit(None).cast(kind), generation.STATUS: F.lit("no input")})
        # the key is missing where the input is, which need not be moved for the status then
        status = F.when(F.col(KEY).isNull(), "no input").otherwise(F.coalesce("__status", F.lit("no answer")))
        found = keyed.join(done.withColumnsRenamed({"answer": "__answer", "status": "__status"}), KEY, "left")
        return found.select(*columns, F.col("__answer").alias(result), status.alias(generation.STATUS))

    # ``df`` is read twice, before and after the calls, so it should be a written table
    def _called(self, df, backend, column, settings, kind, result, batch_size, retries, wait, callers) -> DataFrame:
        keyed = self._keyed(df, column, settings)
        asked = keyed.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.first(f"`{column}`").alias("input"))
        asked = self._unanswered(asked, kind)
        # the bucket follows from the key, so a later attempt meets what an earlier one has committed
        bucket = F.conv(F.substring(KEY, 1, 6), 16, 10).cast("int") % self.buckets
        sent = asked.withColumn("bucket", bucket).repartition(min(callers or self.buckets, self.buckets), "bucket").sortWithinPartitions("bucket", KEY)
        # the action: calls are made here, once, and what they returned is in the ledger afterwards
        sent.mapInArrow(self._task(backend, kind, batch_size, retries, wait), "sent bigint").agg(F.sum("sent")).collect()
        return self._joined(keyed, df.columns, result, kind)

    def answers(self, spark, kind: str = "string") -> DataFrame | None:
        """``__call, answer, status``, one row per key, an answer before a failure; None for an empty ledger."""
        storage, root = _storage(self.folder)
        if not any(f.path.endswith(".parquet") for f in storage.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))):
            return None
        rows = spark.read.schema(f"{KEY} string, answer {kind}, status string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(self.folder)
        best = F.min(F.struct(F.when(F.col("status") == "", 0).otherwise(1).alias("failed"), F.col("answer"), F.col("status"))).alias("best")
        return rows.groupBy(KEY).agg(best).select(KEY, "best.answer", "best.status")

    def _task(self, backend, kind: str, batch_size: int, retries: int, wait: float, own: str | None = None):
        """What a task does with its rows: by bucket, or with ``own`` all in a folder of the task, which its next attempt reads."""
        folder = self.folder
        value_type = pa.string() if kind == "string" else pa.list_(pa.float32())

        def answered(storage: fs.FileSystem, root: str, bucket: int | str) -> set[str]:
            files = storage.get_file_info(fs.FileSelector(f"{root}/{bucket}", allow_not_found=True))
            found: set[str] = set()
            for file in files:
                if file.path.endswith(".parquet"):
                    rows = pq.read_table(file.path, filesystem=storage, columns=[KEY, "status"])
                    found.update(k for k, s in zip(rows[KEY].to_pylist(), rows["status"].to_pylist(), strict=True) if not s)
            return found

        def commit(storage: fs.FileSystem, root: str, bucket: int | str, keys: list[str], pairs: list[tuple]) -> None:
            table = pa.table({
                KEY: pa.array(keys, pa.string()), "answer": pa.array([a for a, _ in pairs], value_type),
                "status": pa.array([e or "" for _, e in pairs], pa.string()),
            })
            storage.create_dir(f"{root}/{bucket}", recursive=True)
            name = f"{root}/{bucket}/{uuid.uuid4().hex}"
            pq.write_table(table, f"{name}.part", filesystem=storage)
            storage.move(f"{name}.part", f"{name}.parquet")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            storage, root = _storage(folder)
            call, known, at, held, sent = None, set(), None, [], 0

            def flush() -> int:
                nonlocal call, held
                if not held:
                    return 0
                call = call or backend()
                pairs = generation._attempt(call, [text for _, text in held], retries, wait)
                commit(storage, root, at, [key for key, _ in held], pairs)
                n, held = len(held), []
                return n

            for batch in batches:
                keys, texts = (batch.column(batch.schema.get_field_index(c)) for c in (KEY, "input"))
                places = [f"{own}-{TaskContext.get().partitionId()}"] * len(keys) if own else batch.column(batch.schema.get_field_index("bucket")).to_pylist()
                # an input is taken out when its turn comes, as a batch of prompts may be large
                for bucket, key, text in zip(places, keys.to_pylist(), (t.as_py() for t in texts), strict=True):
                    if bucket != at:
                        sent += flush()
                        at, known = bucket, answered(storage, root, bucket)
                    if key not in known:
                        held.append((key, text))
                    if len(held) == batch_size:
                        sent += flush()
            sent += flush()
            yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64())], ["sent"])

        return run

"""Calls to text and embedding models as DataFrame steps, with any backend.

A backend factory runs once per partition and returns a function that answers a
batch: ``(prompts, options) -> texts`` or ``(contents) -> vectors``. Failures are
retried, then tried row by row, so one bad row costs its own answer only.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuslight.operators.documents import words

TextBackend = Callable[[list[str], dict], list[str]]
VectorBackend = Callable[[list[str]], list[list[float]]]

# fixed values: options of the two text jobs
REPORT_OPTIONS = {"temperature": 0.2, "max_output_tokens": 4096}
EXTRACTION_OPTIONS = {"max_output_tokens": 2048}

RESULT = "ml_generate_text_llm_result"
STATUS = "ml_generate_text_status"
EMBEDDING = "ml_generate_embedding_result"


def _attempt(call: Callable[[list], list], batch: list, retries: int, wait: float) -> list[tuple]:
    """(answer, error) for every element, in order."""
    error = ""
    for turn in range(retries + 1):
        try:
            answers = list(call(batch))
            if len(answers) != len(batch):
                raise ValueError(f"{len(answers)} answers for {len(batch)} inputs")
            return [(a, None) for a in answers]
        except Exception as problem:  # noqa: BLE001 - a backend may raise anything
            error = f"{type(problem).__name__}: {problem}"
            if turn < retries:
                time.sleep(wait * 2**turn)
    if len(batch) == 1:
        return [(None, error)]
    return [pair for one in batch for pair in _attempt(call, [one], 0, wait)]


def _answers(call, inputs: list, batch_size: int, retries: int, wait: float) -> list[tuple]:
    """Answers for all inputs; a NULL input is not sent."""
    out: list[tuple] = [(None, "no input")] * len(inputs)
    sent = [i for i, value in enumerate(inputs) if value is not None]
    for start in range(0, len(sent), batch_size):
        places = sent[start : start + batch_size]
        for place, pair in zip(places, _attempt(call, [inputs[i] for i in places], retries, wait)):
            out[place] = pair
    return out


def _extended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def generate_text(
    df: DataFrame,
    backend: Callable[[], TextBackend],
    options: dict | None = None,
    prompt_col: str = "prompt",
    batch_size: int = 16,
    retries: int = 2,
    wait: float = 0.5,
    callers: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Input columns, the answer, and a status ('' when answered, else the reason).

    ``callers`` caps how many tasks call the backend at the same time. ``keep`` names the
    input columns to return, all of them by default.
    """
    settings = dict(options or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = backend()
        for batch in batches:
            prompts = batch.column(batch.schema.get_field_index(prompt_col)).to_pylist()
            pairs = _answers(lambda texts: answer(texts, settings), prompts, batch_size, retries, wait)
            yield _extended(batch if keep is None else batch.select(keep), {
                RESULT: pa.array([text for text, _ in pairs], pa.string()),
                STATUS: pa.array([error or "" for _, error in pairs], pa.string()),
            })

    schema = T.StructType([*(df if keep is None else df.select(*keep)).schema.fields, T.StructField(RESULT, T.StringType()), T.StructField(STATUS, T.StringType())])
    source = df.repartition(callers) if callers else df
    return source.mapInArrow(run, schema)


def generate_embedding(
    df: DataFrame,
    backend: Callable[[], VectorBackend],
    content_col: str = "content",
    batch_size: int = 64,
    retries: int = 2,
    wait: float = 0.5,
) -> DataFrame:
    """Input columns, the vector of ``content_col``, and a status ('' when embedded, else the reason why the vector is NULL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = backend()
        for batch in batches:
            contents = batch.column(batch.schema.get_field_index(content_col)).to_pylist()
            pairs = _answers(embed, contents, batch_size, retries, wait)
            yield _extended(batch, {
                EMBEDDING: pa.array([v for v, _ in pairs], pa.list_(pa.float32())),
                STATUS: pa.array([error or "" for _, error in pairs], pa.string()),
            })

    schema = T.StructType([*df.schema.fields, T.StructField(EMBEDDING, T.ArrayType(T.FloatType())), T.StructField(STATUS, T.StringType())])
    return df.mapInArrow(run, schema)


def hash_embedding(df: DataFrame, content_col: str = "content", size: int = 64) -> DataFrame:
    """The local embedding: word counts hashed into ``size`` places, scaled to length 1."""
    tokens = F.coalesce(F.filter(words(F.lower(content_col)), lambda w: w != ""), F.array().cast("array<string>"))
    hashed = HashingTF(numFeatures=size, inputCol="__words", outputCol="__counts").transform(df.withColumn("__words", tokens))
    scaled = Normalizer(p=2.0, inputCol="__counts", outputCol="__unit").transform(hashed)
    vector = F.when(F.col(content_col).isNotNull(), vector_to_array("__unit", "float32"))
    return scaled.withColumn(EMBEDDING, vector).drop("__words", "__counts", "__unit")

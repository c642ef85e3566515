"""Toxicity categories from a chain of linear models."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import LOWER, id_and_text, utf8
from statuslight.llm.quality import held_out

#: labelled documents that the models are fitted on, at most
SAMPLE_ROWS = 6_000
#: bytes of a word's beginning that are features besides the word, so that inflected words share some
BEGINNINGS = (4, 5, 6, 7, 8)
BUCKETS = 1 << 18
FOLDS = 3
#: documents that a word has to occur in, and the least gap of its shares in and out of a category
LEAST_DOCUMENTS, LEAST_GAP = 3, 4.0
#: documents of a category count so many times, as they are fewer
INSIDE = 2.0

# fixed values: words that mark the narrower categories of toxic texts
CATEGORY_WORDS = {
    "insult": ["idiot", "moron", "stupid", "clown", "loser"],
    "contempt": ["pathetic", "worthless", "disgusting", "scum", "trash"],
}
MARKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)


class Buckets(dict):
    """Hash buckets of words seen lately and of their beginnings."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 300_000:
            self.clear()
        parts = {b"=" + word, *(word[:n] for n in BEGINNINGS if n <= len(word))}
        value = self[word] = tuple(zlib.crc32(p) % BUCKETS for p in parts)
        return value


def features(text: bytes, buckets: Buckets) -> np.ndarray:
    """The distinct buckets of a text's words."""
    words = set(text.translate(MARKS).split())
    return np.unique(np.fromiter(chain.from_iterable(map(buckets.__getitem__, words)), np.int32))


@dataclass
class Rows:
    """Binary features of documents: positions into ``items`` where each document begins."""

    items: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, found: list[np.ndarray]) -> Rows:
        return cls(np.concatenate(found) if found else np.zeros(0, np.int32), np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int64))

    def __len__(self) -> int:
        return len(self.begins) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.begins))

    def dot(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner(), weight[self.items], len(self))


@dataclass
class Linear:
    """Weights of buckets, of the probabilities of earlier categories, and a constant."""

    weight: np.ndarray
    earlier: np.ndarray
    constant: float

    def probability(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        margin = rows.dot(self.weight) + earlier @ self.earlier + self.constant
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_linear(rows: Rows, earlier: np.ndarray, y: np.ndarray, steps: int = 400, penalty: float = 1.0) -> Linear:
    """Logistic regression by accelerated gradient steps over the words whose shares in and out of the category differ.

    With a single class the probability is the smoothed share of label 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    constant = float(np.log(share / (1 - share)))
    empty = Linear(np.zeros(BUCKETS), np.zeros(earlier.shape[1]), constant)
    if len(y) == 0 or y.min() == y.max():
        return empty
    inside = np.bincount(rows.items, y[rows.owner()], BUCKETS)
    whole = np.bincount(rows.items, minlength=BUCKETS)
    n, m = y.sum(), len(y) - y.sum()
    pooled = whole / len(y)
    gap = np.abs(inside / n - (whole - inside) / m) / np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m) + 1e-12)
    use = np.flatnonzero((whole >= LEAST_DOCUMENTS) & (gap >= LEAST_GAP) & (whole < len(y)))
    at = np.full(BUCKETS, -1)
    at[use] = np.arange(len(use))
    keep = at[rows.items] >= 0
    item, owner = at[rows.items][keep], rows.owner()[keep]
    columns = np.hstack([earlier, np.ones((len(y), 1))])
    w, v = np.zeros(len(use)), np.r_[np.zeros(earlier.shape[1]), constant]
    most = np.bincount(owner, minlength=len(y)).max(initial=0) + columns.shape[1]
    rate = 4.0 / (most * len(y)) * min(len(y), 40) / INSIDE
    counts = np.where(y > 0, INSIDE, 1.0)
    aw, av, t = w, v, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, aw[item], len(y)) + columns @ av, -30, 30)))
        gap = (p - y) * counts
        new_w = aw - rate * (np.bincount(item, gap[owner], len(use)) + penalty * aw)
        new_v = av - rate * (columns.T @ gap + penalty * np.r_[av[:-1], 0.0])
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        restart = (gap @ (np.bincount(owner, (new_w - w)[item], len(y)) + columns @ (new_v - v))) > 0
        beta = 0.0 if restart else (t - 1) / s
        aw, av = new_w + beta * (new_w - w), new_v + beta * (new_v - v)
        w, v, t = new_w, new_v, 1.0 if restart else s
    weight = np.zeros(BUCKETS)
    weight[use] = w
    return Linear(weight, v[:-1], float(v[-1]))


@dataclass
class Chain:
    """Models of the categories in order; each sees the probabilities of those before."""

    names: list[str]
    models: list[Linear]

    def probabilities(self, rows: Rows) -> np.ndarray:
        found = np.zeros((len(rows), 0))
        for model in self.models:
            found = np.hstack([found, model.probability(rows, found)[:, None]])
        return found


def fit_chain(rows: Rows, labels: np.ndarray, names: list[str], fold: np.ndarray, folds: int = FOLDS) -> Chain:
    """Fit the models one after another on out-of-fold probabilities of the earlier categories.

    For each category a model per fold, fitted on the other folds, gives the
    probabilities that later models are trained with; the model kept is fitted on all rows.
    """
    earlier, models = np.zeros((len(labels), 0)), []
    for j in range(len(names)):
        y = labels[:, j]
        models.append(fit_linear(rows, earlier, y))
        if j + 1 < len(names):
            out = np.zeros(len(y))
            for f in range(folds):
                rest, part = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                model = fit_linear(_take(rows, rest), earlier[rest], y[rest])
                out[part] = model.probability(_take(rows, part), earlier[part])
            earlier = np.hstack([earlier, out[:, None]])
    return Chain(names, models)


def _take(rows: Rows, chosen: np.ndarray) -> Rows:
    return Rows.of([rows.items[rows.begins[i] : rows.begins[i + 1]] for i in chosen])


def category_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, insult, contempt, toxic``: the narrower categories are toxic texts with one of their words."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    words = F.split(F.lower("text"), "[^a-z]+")
    texts = id_and_text(documents).select("doc_id", *[
        F.arrays_overlap(words, F.array(*[F.lit(w) for w in marks])).alias(f"__{name}") for name, marks in CATEGORY_WORDS.items()
    ])
    joined = texts.join(known.where(F.col("toxic").isin(0, 1)), "doc_id")
    return joined.select("doc_id", *[(F.col(f"__{n}") & (F.col("toxic") == 1)).cast("int").alias(n) for n in CATEGORY_WORDS], "toxic")


def fit_toxicity(documents: DataFrame, labels: DataFrame, names: list[str], sample_rows: int = SAMPLE_ROWS) -> Chain:
    """Fit the chain on at most ``sample_rows`` labelled documents that are not held out.

    ``labels``: doc_id and a 0/1 column per name. The sample is the rows with the smallest
    hash of the id. Rows with a null id or label are no training rows.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out()).dropna(subset=names)
    sample = usable.select("doc_id", F.array(*[F.col(n).cast("int") for n in names]).alias("labels"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "labels").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            found = [features(t, buckets) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("labels"), pa.array([f.tobytes() for f in found], pa.binary())], ["doc_id", "labels", "x"]
            )

    joined = id_and_text(documents).join(F.broadcast(sample), "doc_id")
    rows = joined.mapInArrow(run, "doc_id bigint, labels array<int>, x binary").toPandas().sort_values("doc_id", kind="stable")
    y = np.array([list(v) for v in rows["labels"]], float).reshape(len(rows), len(names))
    fold = np.array([zlib.crc32(f"fold {i}".encode()) % FOLDS for i in rows["doc_id"]])
    found = [np.frombuffer(x, np.int32) for x in rows["x"]]
    often = np.bincount(np.concatenate(found) if found else np.zeros(0, np.int32), minlength=BUCKETS) >= LEAST_DOCUMENTS
    return fit_chain(Rows.of([x[often[x]] for x in found]), y, names, fold)


def score_toxicity(documents: DataFrame, model: Chain) -> DataFrame:
    """``doc_id, held_out, p_<category>..., score, predicted`` of every row with an id.

    ``score`` is the probability of the last category. A null or empty text has no words
    and gets the constant terms. Repeated rows are scored each, other columns ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            p = model.probabilities(Rows.of([features(t, buckets) for t in utf8(batch.column("text"))]))
            columns = [pa.array(p[:, j]) for j in range(len(model.names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *[f"p_{n}" for n in model.names]])

    names = [f"p_{n}" for n in model.names]
    rows = id_and_text(documents).mapInArrow(run, "doc_id bigint, " + ", ".join(f"{n} double" for n in names))
    return rows.select("doc_id", held_out().alias("held_out"), *names, F.col(names[-1]).alias("score"), (F.col(names[-1]) >= 0.5).cast("int").alias("predicted"))

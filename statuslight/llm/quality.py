"""Quality scores from histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import id_and_text, utf8

#: labelled documents that the trees are fitted on, at most
SAMPLE_ROWS = 20_000
STATISTICS = [
    "log_bytes", "log_words", "bytes_per_word", "distinct_words", "commonest_word", "repeated_words", "upper", "lower",
    "digits", "blanks", "sentence_marks", "pipes", "bangs", "symbols", "non_ascii", "lines_per_word", "distinct_lines",
    "longest_word", "entropy", "ends_with_mark", "capital_words", "brackets",
]


def _bytes_of(characters: str) -> np.ndarray:
    return np.frombuffer(characters.encode(), np.uint8)


UPPER, LOWER_CASE, DIGITS = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_of("abcdefghijklmnopqrstuvwxyz"), _bytes_of("0123456789")
BLANKS, MARKS, SYMBOLS, BRACKETS = _bytes_of(" \t\n\r\x0b\x0c"), _bytes_of(".,;:?"), _bytes_of("#$%&*+=@^~_/\\"), _bytes_of("<>{}[]()")


def statistics(text: bytes) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``; an empty text has zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    share = counts[counts > 0] / size
    return [
        np.log1p(size),
        np.log1p(len(words)),
        size / n,
        len(seen) / n,
        max(seen.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        counts[UPPER].sum() / size,
        counts[LOWER_CASE].sum() / size,
        counts[DIGITS].sum() / size,
        counts[BLANKS].sum() / size,
        counts[MARKS].sum() / n,
        counts[124] / n,
        counts[33] / n,
        counts[SYMBOLS].sum() / n,
        counts[128:].sum() / size,
        len(lines) / n,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(max(map(len, seen), default=0)),
        float(-(share * np.log2(share)).sum()),
        float(text.rstrip()[-1:] in (b".", b"!", b"?")),
        sum(c for w, c in seen.items() if w[:1].isupper()) / n,
        counts[BRACKETS].sum() / n,
    ]


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))


@dataclass
class Trees:
    """Complete binary trees of one depth, flattened level by level.

    ``feature`` and ``threshold`` have a row per tree and a column per inner node
    (children of node i: 2i+1 and 2i+2), ``value`` a column per leaf.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """All trees of all rows at once: one vectorised step per level."""
        inner = self.feature.shape[1]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        while inner and node.min(initial=inner) < inner:
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.value[trees, node - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15,
    least_hessian: float = 2.0, shrink: float = 1.0,
) -> Trees:
    """Boost logistic loss over binned columns; a node's histogram is one ``bincount``.

    Without rows, or with a single class, the score is the smoothed share of label 1.
    """
    inner = 2**depth - 1
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(prior / (1 - prior)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    columns = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(columns)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(columns)], axis=1)
    margin = np.full(len(y), base)
    found = []
    offsets = np.arange(columns) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * columns * bins + offsets + binned).ravel()
            shape = (many, columns, bins)
            g = np.bincount(cell, np.repeat(gradient, columns), many * columns * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(hessian, columns), many * columns * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + shrink) + (all_g - g) ** 2 / (all_h - h + shrink) - all_g**2 / (all_h + shrink)
            gain[(h < least_hessian) | (all_h - h < least_hessian)] = 0
            gain = gain.reshape(many, -1)
            best = gain.argmax(axis=1)
            for k in np.flatnonzero(gain[np.arange(many), best] > 1e-9):
                j, b = divmod(int(best[k]), bins)
                feature[first + k], threshold[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, hessian, inner + 1)
        value = -rate * g / (h + shrink)
        margin += value[leaf]
        found.append((feature, threshold, value))
    return Trees(*(np.array(part) for part in zip(*found, strict=True)), base)


def held_out(doc_id: F.Column | str = "doc_id") -> F.Column:
    """Rows that no label is learned from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def fit_quality(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    The sample is the rows with the smallest hash of the id, so it does not depend on
    the order of the tables. Rows without id or label are no training rows.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    usable = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))],
                ["doc_id", "label", "x"],
            )

    joined = id_and_text(documents).join(F.broadcast(sample), "doc_id")
    rows = joined.mapInArrow(measured, "doc_id bigint, label int, x array<double>").toPandas()
    rows = rows.sort_values(["doc_id", "label"], kind="stable")
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), len(STATISTICS))
    return fit_trees(x, rows["label"].to_numpy(np.float64), **options)


def score_quality(documents: DataFrame, model: Trees) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row with an id.

    A null text counts as empty and is scored by its zero statistics. Repeated rows
    are scored each, other columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            score = model.score(_matrix(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"]
            )

    rows = id_and_text(documents).mapInArrow(scored, "doc_id bigint, score double")
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(documents: DataFrame, model: Trees) -> DataFrame:
    """The rows of ``documents`` with a score of 0.5 or more, with all their columns.

    Scored next to the text, so no row moves. A null text counts as empty; rows without
    an id are left out as in ``score_quality``.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in utf8(batch.column("text"))]
            yield batch.filter(pa.array(model.score(_matrix(texts)) >= 0.5))

    return documents.where(F.col("doc_id").isNotNull()).mapInArrow(keep, documents.schema)

"""Languages of texts from unigram models that add up all segmentations of a word."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch, id_and_text
from statuslight.llm.quality import held_out

#: labelled documents of a language that its model is fitted on, at most
ROWS_PER_LANGUAGE = 800
ROUNDS = 3
#: expected uses that every piece has beforehand, in every language
SMOOTHING = 0.02
#: probability of a character that is no piece, the same in all languages
UNKNOWN = 1e-7
#: words of more characters teach nothing: their probabilities could leave the range of doubles
LONGEST_TAUGHT = 32
#: characters that are split together, and of a word that run through the models together
SLICE_CHARS = 500_000
#: characters of different words that run through the models together
PART_CHARS = 50_000
#: words whose probabilities a worker remembers
REMEMBERED = 400_000
BLANK = "▁"
SPACE = re.compile(r"\s")


class Trie:
    """The pieces of a vocabulary as a table of transitions, walked from all positions of many words at once."""

    def __init__(self, pieces: list[str]):
        nodes, terminal, edges = {"": 0}, {}, {}
        chars = sorted(set("".join(pieces)))
        number = {c: k + 1 for k, c in enumerate(chars)}
        self.width = len(chars) + 1
        for at, piece in enumerate(pieces):
            node = 0
            for end in range(1, len(piece) + 1):
                key = node * self.width + number[piece[end - 1]]
                node = edges.setdefault(key, len(nodes))
                if node == len(nodes):
                    nodes[piece[:end]] = node
            terminal[node] = at
        self.place = np.zeros(0x110000, np.int32)
        self.place[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.keys = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[list(terminal)] = list(terminal.values())
        self.size, self.longest = len(pieces), max(map(len, pieces), default=1)

    def edges(self, words: list[str]) -> Edges:
        """All pieces at all positions of ``words``; a character that is no piece is an edge with the number ``size``."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        chars = self.place[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        begins = np.r_[0, np.cumsum(lengths)]
        word = np.repeat(np.arange(len(words)), lengths)
        stop = begins[1:][word]
        at, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        starts, sizes, found = [], [], []
        single = np.zeros(len(chars), bool)
        for size in range(1, self.longest + 1):
            key = node * self.width + chars[at + size - 1]
            slot = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            hit = self.keys[slot] == key if len(self.keys) else np.zeros(len(key), bool)
            at, node = at[hit], self.child[slot[hit]] if len(self.keys) else node[hit]
            piece = self.piece[node]
            ends = piece >= 0
            starts.append(at[ends])
            sizes.append(np.full(ends.sum(), size, np.int64))
            found.append(piece[ends])
            if size == 1:
                single[at[ends]] = True
            more = at + size < stop[at]
            at, node = at[more], node[more]
            if not len(at):
                break
        lone = np.flatnonzero(~single)
        starts.append(lone)
        sizes.append(np.ones(len(lone), np.int64))
        found.append(np.full(len(lone), self.size, np.int32))
        start, size, piece = map(np.concatenate, (starts, sizes, found))
        first = start + word[start]  # a word of n characters has n + 1 boundaries
        return Edges(first, first + size, piece, start + size - begins[word[start]], size, lengths, begins[:-1] + np.arange(len(words)), self.longest)


@dataclass
class Edges:
    """Edges from boundary ``first`` to boundary ``last``; ``end`` counts characters from the word's begin."""

    first: np.ndarray
    last: np.ndarray
    piece: np.ndarray
    end: np.ndarray
    size: np.ndarray
    lengths: np.ndarray
    opening: np.ndarray
    longest: int

    def groups(self) -> list[np.ndarray]:
        """Edges by end and size: in a group no two edges share a boundary, and ends never fall."""
        key = self.end * (self.longest + 1) + self.size
        order = np.argsort(key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else []

    def forward(self, table: np.ndarray, given: np.ndarray | None = None, scaling: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all segmentations up to every boundary, and the logarithm that was taken out of each word.

        ``table`` has a row per piece and a column per language. Every ``longest``
        characters the boundaries still in use are scaled, so that long words neither
        overflow nor vanish. ``given`` holds the sums of the first boundaries of a single
        word that goes on from an earlier part.
        """
        total = np.zeros((int(self.lengths.sum()) + len(self.lengths), table.shape[1]))
        taken = np.zeros((len(self.lengths), table.shape[1]))
        total[self.opening] = 1.0
        known = 0
        if given is not None:
            total[: len(given)], known = given, len(given) - 1
        scaled = known
        for group in self.groups():
            end = int(self.end[group[0]])
            if end <= known:
                continue
            while scaling and end > scaled + self.longest:
                scaled += self.longest
                self._scale(total, taken, scaled)
            total[self.last[group]] += total[self.first[group]] * table[self.piece[group]]
        return total, taken

    def _scale(self, total: np.ndarray, taken: np.ndarray, at: int) -> None:
        """Divide the last ``longest`` sums up to ``at`` characters by their maximum, in words that go on."""
        words = np.flatnonzero(self.lengths > at)
        window = (self.opening[words] + at)[:, None] - np.arange(min(self.longest, at + 1))[None, :]
        part = total[window]
        most = part.max(axis=1)
        total[window] = part / most[:, None, :]
        taken[words] += np.log(most)

    def backward(self, table: np.ndarray) -> np.ndarray:
        total = np.zeros((int(self.lengths.sum()) + len(self.lengths), table.shape[1]))
        total[self.opening + self.lengths] = 1.0
        for group in reversed(self.groups()):
            total[self.first[group]] += total[self.last[group]] * table[self.piece[group]]
        return total


def word_logs(words: list[str], trie: Trie, table: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language, over all its segmentations."""
    out = np.zeros((len(words), table.shape[1]))
    if not words:
        return out
    sizes = np.array([len(w) + 1 for w in words])
    order = np.argsort(sizes, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(np.cumsum(sizes[order]) // PART_CHARS)) + 1)
    for part in parts:
        shorter = part[sizes[part] <= SLICE_CHARS]
        if len(shorter):
            edges = trie.edges([BLANK + words[i] for i in shorter])
            total, taken = edges.forward(table)
            out[shorter] = np.log(total[edges.opening + edges.lengths]) + taken
        for i in part[sizes[part] > SLICE_CHARS]:
            out[i] = _long_word(BLANK + words[i], trie, table)
    return out


def _long_word(word: str, trie: Trie, table: np.ndarray) -> np.ndarray:
    """Run through a word in parts that hand on the sums of their last boundaries."""
    log, given, at = np.zeros(table.shape[1]), None, 0
    while True:
        back = len(given) - 1 if given is not None else 0
        end = min(len(word), at + SLICE_CHARS)
        edges = trie.edges([word[at - back : end]])
        total, taken = edges.forward(table, given)
        most = total[-1]
        log += taken[0] + np.log(most)
        if end == len(word):
            return log
        given, at = total[-(trie.longest + 1) :] / most, end


def expected_uses(words: list[str], counts: np.ndarray, trie: Trie, table: np.ndarray) -> np.ndarray:
    """How often each piece is used by words seen ``counts`` times, over all segmentations weighted by their probability.

    Nothing is scaled here, so words have to be short (see ``LONGEST_TAUGHT``).
    """
    edges = trie.edges([BLANK + w for w in words])
    ahead, _ = edges.forward(table, scaling=False)
    behind = edges.backward(table)
    whole = ahead[edges.opening + edges.lengths]
    owner = np.searchsorted(edges.opening, edges.first, side="right") - 1
    share = ahead[edges.first] * table[edges.piece] * behind[edges.last] * (counts / whole)[owner]
    return np.stack([np.bincount(edges.piece, share[:, k], trie.size + 1) for k in range(table.shape[1])], axis=1)


@dataclass
class Languages:
    """Names, logarithms of their shares, and the probabilities of the pieces (rows) in each (columns)."""

    names: list[str]
    prior: np.ndarray
    pieces: list[str]
    table: np.ndarray


def slices(text: str) -> Iterator[str]:
    """A text in parts of about ``SLICE_CHARS``, cut at white space."""
    at = 0
    while len(text) - at > SLICE_CHARS:
        found = SPACE.search(text, at + SLICE_CHARS)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def fit_languages(documents: DataFrame, pieces: list[str], rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS) -> Languages:
    """Piece probabilities per value of ``lang``, by expectation maximisation over all segmentations.

    Learned from text and lang of the ``rows_per_language`` documents of each language
    that have the smallest hash of the id, are not held out, and have an id and a lang; the
    languages' shares are counted over all such documents. The words of the sample are
    counted in Spark; a round sends the probabilities to the tasks and gets back one
    expected count per piece and language. Without such documents there are no languages.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "languages")
    usable = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    shares = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(shares)
    trie = Trie(pieces)
    prior = np.log(np.array([shares[n] for n in names], float) / max(1, sum(shares.values())))
    if not names:
        return Languages([], prior, pieces, np.zeros((len(pieces) + 1, 0)))
    number = {name: k for k, name in enumerate(names)}
    first = Window.partitionBy("lang").orderBy("hash", "doc_id")
    # a share of each language that holds enough rows for sure, so that no language is sorted whole in one task
    share = spark.createDataFrame([(n, min(1.0, (2 * rows_per_language + 200) / shares[n])) for n in names], "lang string, share double")
    few = usable.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("hash")).join(F.broadcast(share), "lang")  # a row per language
    few = few.where(F.col("hash") <= F.col("share") * float(1 << 40))
    ids = few.withColumn("place", F.row_number().over(first)).where(F.col("place") <= rows_per_language)
    chosen = usable.join(F.broadcast(ids.select("doc_id", "lang").distinct()), ["doc_id", "lang"])  # bounded by the sample

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                for part in slices(text or ""):
                    seen.setdefault(lang, Counter()).update(w for w in part.split() if len(w) < LONGEST_TAUGHT)
            for lang, words in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(words), pa.string()), pa.array([number[lang]] * len(words), pa.int32()), pa.array(list(words.values()), pa.int64())],
                    ["word", "lang", "n"],
                )

    counted = chosen.select("text", "lang").mapInArrow(count, "word string, lang int, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    words = scratch.write(counted, "words")
    table = np.ones((len(pieces) + 1, len(names)))
    for step in range(rounds + 1):
        # the first pass counts every occurrence of a piece, as if all probabilities were one
        uses = _uses(words, pieces, table, plain=step == 0) + SMOOTHING
        uses[-1] = 0.0
        table = uses / uses.sum(axis=0) * (1 - UNKNOWN)
        table[-1] = UNKNOWN
    return Languages(names, prior, pieces, table)


def _uses(words: DataFrame, pieces: list[str], table: np.ndarray, plain: bool) -> np.ndarray:
    """Uses of the pieces in all counted words, added up per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total = Trie(pieces), np.zeros(table.shape)
        for batch in batches:
            listed, lang = batch.column("word").to_pylist(), batch.column("lang").to_numpy()
            n = batch.column("n").to_numpy().astype(float)
            counts = np.zeros((len(listed), table.shape[1]))
            counts[np.arange(len(listed)), lang] = n
            if plain:
                edges = trie.edges([BLANK + w for w in listed])
                owner = np.searchsorted(edges.opening, edges.first, side="right") - 1
                for k in range(table.shape[1]):
                    total[:, k] += np.bincount(edges.piece, counts[owner, k], trie.size + 1)
            else:
                total += expected_uses(listed, counts, trie, table)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "v"])

    out = np.zeros(table.shape)
    for r in words.mapInArrow(run, "piece int, lang int, v double").groupBy("piece", "lang").agg(F.sum("v").alias("v")).toLocalIterator():
        out[r["piece"], r["lang"]] = round(r["v"], 9)
    return out


class Scorer:
    """Adds up the log-probabilities of texts' words, remembering words met lately."""

    def __init__(self, model: Languages):
        self.model, self.trie = model, Trie(model.pieces)
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.names)))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Posterior of each language for every text."""
        margin = np.tile(self.model.prior, (len(texts), 1))
        parts, owners, chars = [], [], 0
        for i, text in enumerate(texts):
            for part in slices(text or ""):
                parts.append(part)
                owners.append(i)
                chars += len(part)
                if chars >= SLICE_CHARS:
                    self._add(margin, parts, owners)
                    parts, owners, chars = [], [], 0
        self._add(margin, parts, owners)
        p = np.exp(margin - margin.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def _add(self, margin: np.ndarray, parts: list[str], owners: list[int]) -> None:
        if not parts:
            return
        if len(self.place) > REMEMBERED:
            self.place, self.logs = {}, self.logs[:0]
        split = pc.utf8_split_whitespace(pa.array(parts, pa.string()))
        words = split.flatten().dictionary_encode()
        listed = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in listed if w not in self.place]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        logs = word_logs(new, self.trie, self.model.table)
        logs[[k for k, w in enumerate(new) if not w]] = 0.0  # between blanks that follow each other
        self.logs = np.concatenate([self.logs, logs])
        at = np.fromiter(map(self.place.__getitem__, listed), np.int64, len(listed))[words.indices.to_numpy()]
        sizes = split.value_lengths().to_numpy()
        full = np.flatnonzero(sizes)
        if len(full):
            sums = np.add.reduceat(self.logs.take(at, axis=0), (np.cumsum(sizes) - sizes)[full], axis=0)
            np.add.at(margin, np.array(owners)[full], sums)


#: the scorer of the last model that this worker met; its words stay known from task to task
_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Languages) -> Scorer:
    key = hashlib.sha256(model.table.tobytes() + repr((model.names, model.prior.tolist(), model.pieces)).encode()).hexdigest()
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def predict_languages(documents: DataFrame, model: Languages) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row with an id.

    ``score`` is the posterior of the predicted language; of equal ones the first name
    wins. A text that is null or has no letter, and any text if no language was learned,
    gets ``und`` and 0. Words are what white space separates; a word counts with the sum of
    the probabilities of all its segmentations. Whole texts are read, a part at a time.
    Repeated rows are predicted each, other columns are ignored.
    """
    names = np.array([*model.names, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                p = scorer(part.column("text").to_pylist()) if model.names else np.ones((part.num_rows, 1))
                best = p.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(p[np.arange(len(p)), best]), part.column("letters")],
                    ["doc_id", "found", "p", "letters"],
                )

    rows = id_and_text(documents).withColumn("letters", F.col("text").rlike(r"\p{L}"))
    found = rows.mapInArrow(run, "doc_id bigint, found string, p double, letters boolean")
    known = F.col("letters") & F.lit(bool(model.names))
    return found.select(
        "doc_id", held_out().alias("held_out"), F.when(known, F.col("found")).otherwise("und").alias("lang_pred"),
        F.when(known, F.col("p")).otherwise(0.0).alias("score"),
    )

"""Token ids in files of bit- or byte-plane shuffled, compressed blocks with a chunk index."""

from __future__ import annotations

import functools
import gc
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch, id_and_text, partitions

BLOCK_IDS = 65_536
END_ID = 1
MAGIC = b"IDP1"
#: words whose ids a worker remembers, and words encoded in one call
REMEMBERED, LEARNED = 600_000, 50_000
# fixed values: the tokenizer's own pattern for words of these characters, which neither compose nor change their number
PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
UNITS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9]+").findall
#: characters of texts that are split together
SPLIT_CHARS = 1 << 20
#: bytes of text that a shard holds, about
SHARD_BYTES = 256 << 20

INDEX = "shard int, chunk int, first bigint, n_ids int, first_doc bigint, doc_ids array<bigint>, doc_sizes array<int>, payload binary"


def pack_block(ids: np.ndarray, planes: str = "byte", level: int = 3) -> bytes:
    """One block: magic, kind of planes, number of ids and planes, sizes of the compressed planes, planes.

    Plane k of "byte" holds byte k of every 32-bit id, plane k of "bit" holds bit k of
    every id, eight ids to a byte; planes of zeros only have size 0.
    """
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        found = [raw[:, k] for k in range(4)]
    elif planes == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        found = [np.packbits(bits[:, k], bitorder="little") for k in range(32)]
    else:
        raise ValueError(f"planes are 'byte' or 'bit', not {planes!r}")
    pressed = [zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(p).tobytes()) if p.any() else b"" for p in found]
    head = MAGIC + struct.pack("<BIH", planes == "bit", len(ids), len(found)) + struct.pack(f"<{len(found)}I", *map(len, pressed))
    return head + b"".join(pressed)


def unpack_block(block: bytes) -> np.ndarray:
    if block[:4] != MAGIC:
        raise ValueError("not a block of id planes")
    bit, n, many = struct.unpack_from("<BIH", block, 4)
    sizes = struct.unpack_from(f"<{many}I", block, 11)
    at = 11 + 4 * many
    raw = np.zeros((n, 32 if bit else 4), np.uint8)
    for k, size in enumerate(sizes):
        if size:
            plane = np.frombuffer(zstandard.ZstdDecompressor().decompress(block[at : at + size]), np.uint8)
            raw[:, k] = np.unpackbits(plane, count=n, bitorder="little") if bit else plane
            at += size
    return (np.packbits(raw, axis=1, bitorder="little") if bit else raw).reshape(-1).view("<u4")


class Runs:
    """Sequences of numbers, kept one after another."""

    def __init__(self):
        self.flat, self.first, self.size = np.zeros(1 << 16, "<u4"), np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64)
        self.held = self.many = 0

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        held, many = self.held + len(flat), self.many + len(sizes)
        self.flat, self.first, self.size = _grown(self.flat, held), _grown(self.first, many), _grown(self.size, many)
        self.flat[self.held : held] = flat
        self.first[self.many : many] = self.held + np.cumsum(sizes) - sizes
        self.size[self.many : many] = sizes
        self.held, self.many = held, many

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences at these places, one after another, and their sizes."""
        size = self.size[at]
        ends = np.cumsum(size)
        whole = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.first[at] - (ends - size), size) + np.arange(whole)], size


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


class Words:
    """Ids of texts by their words, which are what ASCII white space separates.

    The tokenizer drops white space and never joins characters across it, so a text's
    ids are those of its words in turn. A word of plain letters, digits and signs is cut
    further as the tokenizer cuts it (lower case; contractions, runs of letters, single
    digits, runs of signs), and its ids are those of these units. Each different word of a
    batch is looked up once; units and other words not met before are encoded in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        # for units, which are lower-cased and cut already
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer, self.bare.pre_tokenizer = None, ByteLevel(add_prefix_space=False, use_regex=False)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.words = Runs()
        self.unit_place: dict[str, int] = {}
        self.units = Runs()

    def _learn(self, words: list[str]) -> None:
        if max(len(self.place), len(self.unit_place)) > REMEMBERED:
            self._forget()
        new = [w for w in words if w not in self.place]
        # a word that is not plain stays whole, with a sign in front that no unit begins with
        cut = [UNITS(w.lower()) if PLAIN(w) and "<|" not in w else (" " + w,) for w in new]
        fresh = set(chain.from_iterable(cut)).difference(self.unit_place)
        whole = [u for u in fresh if u[0] == " "]
        for tokenizer, listed in ((self.tokenizer, whole), (self.bare, list(fresh.difference(whole)))):
            for at in range(0, len(listed), LEARNED):
                part = listed[at : at + LEARNED]
                found = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                self.unit_place.update(zip(part, range(self.units.many, self.units.many + len(part)), strict=True))
                self.units.append(np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum())), sizes)
        many = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.unit_place.__getitem__, chain.from_iterable(cut)), np.int64, int(many.sum()))
        ids, sizes = self.units.take(at)
        self.place.update(zip(new, range(self.words.many, self.words.many + len(new)), strict=True))
        whole = np.r_[0, np.cumsum(sizes)]
        stops = np.cumsum(many)
        self.words.append(ids, whole[stops] - whole[stops - many])

    def encode(self, texts: list[str]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = split.flatten().dictionary_encode()
        listed = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(listed)
        at = np.fromiter(map(self.place.__getitem__, listed), np.int64, len(listed))[words.indices.to_numpy()]
        ids, sizes = self.words.take(at)
        stops = np.r_[0, np.cumsum(sizes)][np.cumsum(split.value_lengths().to_numpy())]
        return [ids[i:j].tobytes() for i, j in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]


@functools.cache
def _words(path: str) -> Words:
    return Words(path)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[str]]]:
    """Rows of a batch, ``SPLIT_CHARS`` characters at a time; a longer text comes alone."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        if texts and held + len(text) > SPLIT_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(doc_id)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts


def _shards(path: str, planes: str, block_ids: int):
    """Encode the documents of a shard in order and cut their ids into chunks."""

    def chunk(number: int, first: int, ids: list[bytes], docs: list[tuple[int, int]], first_doc: int) -> pa.RecordBatch:
        whole = np.frombuffer(b"".join(ids), "<u4")
        return pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int32()),
                pa.array([first], pa.int64()), pa.array([len(whole)], pa.int32()), pa.array([first_doc], pa.int64()),
                pa.array([[d for d, _ in docs]], pa.list_(pa.int64())), pa.array([[n for _, n in docs]], pa.list_(pa.int32())),
                pa.array([pack_block(whole, planes)], pa.binary()),
            ],
            ["shard", "chunk", "first", "n_ids", "first_doc", "doc_ids", "doc_sizes", "payload"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here holds itself, and looking through the words met again and again takes an eighth of the time
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _words(path), np.array([END_ID], "<u4").tobytes()
        ids, docs, held, number, first, ordinal, first_doc = [], [], 0, 0, 0, 0, 0
        for batch in batches:
            for doc_ids, texts in _parts(batch):
                for doc_id, found in zip(doc_ids, words.encode(texts), strict=True):
                    found += end
                    while found:
                        take = found[: 4 * (block_ids - held)]
                        found = found[len(take) :]
                        ids.append(take)
                        docs.append((doc_id, len(take) // 4))
                        held += len(take) // 4
                        if held == block_ids:
                            yield chunk(number, first, ids, docs, first_doc)
                            number, first, first_doc = number + 1, first + held, ordinal if found else ordinal + 1
                            ids, docs, held = [], [], 0
                    ordinal += 1
        if held:
            yield chunk(number, first, ids, docs, first_doc)

    return run


def write_ids(
    documents: DataFrame, tokenizer_path: str, scratch: Scratch, planes: str = "byte", block_ids: int = BLOCK_IDS
) -> DataFrame:
    """The chunks of all documents in ascending doc_id order, written and read as a table.

    Documents are range-partitioned into shards by doc_id, as many as the shuffle has
    partitions or as ``SHARD_BYTES`` of text each ask for, if that is more; a shard's chunks are its ids
    in order, ``block_ids`` each, every document closed by ``END_ID``. A chunk row is its
    own index entry: shard, chunk, position of its first id in the shard, number of ids,
    its documents and how many of their ids it holds. Rows without an id take no part, a
    null text is empty, rows that repeat an id are ordered by text.
    """
    rows = id_and_text(documents)
    whole = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    rows = rows.repartitionByRange(max(partitions(documents.sparkSession), math.ceil(whole / SHARD_BYTES)), "doc_id")
    ordered = rows.sortWithinPartitions("doc_id", "text")
    return scratch.write(ordered.mapInArrow(_shards(tokenizer_path, planes, block_ids), INDEX), "chunks")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and chunk; the first and last document of a chunk may go on elsewhere and keep their ids."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            raw = unpack_block(r["payload"]).tobytes()
            at, last = 0, len(r["doc_ids"]) - 1
            for k, (doc_id, size) in enumerate(zip(r["doc_ids"], r["doc_sizes"], strict=True)):
                piece = raw[4 * at : 4 * (at + size)]
                rows.append((r["shard"], r["first_doc"] + k, doc_id, r["chunk"], r["first"] + at, size, zlib.crc32(piece),
                             piece if k in (0, last) else None))
                at += size
        names = ["shard", "ordinal", "doc_id", "chunk", "position", "size", "crc", "ids"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds, strict=True)], names)


def read_documents(chunks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the chunks alone.

    ``start`` adds the position in the shard to the ids of the shards before; that sum
    runs over one row per shard.
    """
    pieces = chunks.mapInArrow(
        _documents, "shard int, ordinal bigint, doc_id bigint, chunk int, position bigint, size bigint, crc bigint, ids binary"
    )
    parts = F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("chunk", F.hex("ids").alias("h")))))
    found = pieces.groupBy("shard", "ordinal", "doc_id").agg(
        F.min("position").alias("position"), F.sum("size").alias("n_tokens"), F.max("crc").alias("crc"),
        F.count("*").alias("n"), parts.alias("parts"),
    )
    whole = F.crc32(F.unhex(F.array_join(F.expr("transform(parts, p -> p.h)"), "")))
    shards = chunks.groupBy("shard").agg(F.sum(F.col("n_ids").cast("bigint")).alias("n_shard"))
    before = F.expr("coalesce(sum(n_shard) over (order by shard rows between unbounded preceding and 1 preceding), 0)")
    offsets = F.broadcast(shards.select("shard", before.alias("before")))  # a row per shard
    return found.join(offsets, "shard").select(
        "doc_id", (F.col("before") + F.col("position")).alias("start"), "n_tokens",
        F.when(F.col("n") == 1, F.col("crc")).otherwise(whole).alias("ids_crc32"),
    )


def read_range(chunks: DataFrame, shard: int, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` of a shard; the index picks the chunks that hold them."""
    wanted = chunks.where((F.col("shard") == shard) & (F.col("first") < end) & (F.col("first") + F.col("n_ids") > begin))
    rows = wanted.orderBy("chunk").select("first", "payload").collect()
    if not rows:
        return np.zeros(0, np.uint32)
    return np.concatenate([unpack_block(r["payload"]) for r in rows])[begin - rows[0]["first"] :][: end - begin]

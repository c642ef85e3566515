"""SentencePiece encoding and decoding over a relational lattice of substrings and pieces."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, filterfalse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statuslight.llm.common import Scratch, id_and_text, partitions

BLANK = "▁"
WORD = re.compile("▁+[^▁]*")
#: UTF-8 bytes of the texts that share a dictionary
BLOCK_BYTES = 8 << 20
#: an unknown character scores this much below the worst piece
UNKNOWN = 10.0
#: code of an unknown character: this plus its code point
UNKNOWN_CODE = 1 << 23
#: ends of a word that share a row before substrings are exploded
WINDOW = 64
#: edges, and ends, that are folded before the state is cut back
SLICE = 1024
#: a piece is left out of the lattice where smaller ones score more than this above it; sums of scores err by less
MARGIN = 0.01
#: words that are cut at once
CUT_WORDS = 50_000
#: a power of two, many for each task
SLOTS = 1 << 16
#: common words, and bytes of texts, whose lattice one task holds
PART_WORDS, PART_BYTES = 20_000, 8 << 20
#: blocks that are looked through for common segments, and how many of these every task may hold
COMMON_BLOCKS, COMMON = 8, 150_000


@dataclass
class Pieces:
    """The normal pieces with their scores, the ids of the 256 byte pieces, and the pairs of characters inside pieces."""

    rows: list[tuple[str, int, float]]
    byte_ids: list[int]
    pairs: frozenset[str]
    longest: int
    worst: float

    @classmethod
    def load(cls, model_file: str) -> Pieces:
        """Read the piece table of a model with byte fallback. Its scores are used as they are."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        rows, byte_ids = [], [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                rows.append((piece, i, float(model.get_score(i))))
        if any(BLANK in piece.lstrip(BLANK) for piece, _, _ in rows):
            raise ValueError("a piece with a blank after other characters joins words")
        pairs = frozenset(piece[i : i + 2] for piece, _, _ in rows for i in range(len(piece) - 1))
        return cls(rows, byte_ids, pairs, max(len(r[0]) for r in rows), min(r[2] for r in rows))

    def shown(self) -> dict[int, bytes]:
        """What each id decodes to."""
        return {i: piece.encode() for piece, i, _ in self.rows} | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}

    def useful(self) -> list[tuple[str, int, float]]:
        """The pieces that can be part of a best path: no sequence of smaller ones scores more than each.

        A path with any other piece is beaten by the one with that sequence in its place, so
        neither best totals nor which edges reach them depend on the pieces left out.
        """
        scores, unknown = {piece: score for piece, _, score in self.rows}, self.worst - UNKNOWN

        def in_smaller(piece: str) -> float:
            best = [0.0]
            for end in range(1, len(piece) + 1):
                starts = range(1 if end == len(piece) else 0, end)
                totals = [best[i] + scores.get(piece[i:end], unknown if end - i == 1 else -np.inf) for i in starts]
                best.append(max(totals, default=-np.inf))
            return best[-1]

        return [row for row in self.rows if in_smaller(row[0]) <= row[2] + MARGIN]


class Cutter:
    """Cuts words with their blanks in front into segments, wherever no piece holds both characters."""

    def __init__(self, pairs: frozenset[str]):
        chars = sorted(set("".join(pairs)))
        self.place = np.zeros(0x110000, np.int16)
        self.place[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1,) * 2, bool)
        for a, b in pairs:
            self.joined[self.place[ord(a)], self.place[ord(b)]] = True

    def __call__(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The segments of all words one after another, and where those of each word end."""
        if not words:
            return [], np.zeros(0, np.int64)
        whole = "".join(words)
        at = self.place[np.frombuffer(whole.encode("utf-32-le"), "<u4")]
        opens = np.r_[True, ~self.joined[at[:-1], at[1:]]]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        opens[ends[:-1]] = True
        begins = np.flatnonzero(opens)
        stops = [*begins[1:].tolist(), len(whole)]
        return [whole[i:j] for i, j in zip(begins.tolist(), stops, strict=True)], np.searchsorted(begins, ends)


def words_of(text: str) -> list[str]:
    """The words of a text, blanks escaped, each without the blank in front of it; none for an empty text."""
    if not text:
        return []
    plain = text.split(" ")
    if "" not in plain and BLANK not in text:
        return plain
    return [w[1:] for w in WORD.findall(BLANK + text.replace(" ", BLANK))]


def segments(text: str, cut: Cutter) -> list[str]:
    """The segments of a text, blanks escaped and one put in front; none for an empty text."""
    return cut([BLANK + word for word in words_of(text)])[0]


def _blocks(block_bytes: int):
    """Texts in compressed blocks of consecutive rows. What is left at the end goes with the block before it if it is less than a quarter of one."""

    def pack(ids: list[int], texts: list[bytes], number: int) -> pa.RecordBatch:
        whole = np.array(ids, "<i8").tobytes() + np.array([len(t) for t in texts], "<i8").tobytes() + b"".join(texts)
        payload = len(ids).to_bytes(8, "little") + zstandard.ZstdCompressor(level=5).compress(whole)
        key = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([len(whole)]), pa.array([payload], pa.binary())], ["block", "size", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, number, full = [], [], 0, 0, ([], [])
        for batch in batches:
            column = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), column, strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text) + 16
                if full[0] and held >= block_bytes / 4:
                    yield pack(*full, number)
                    number, full = number + 1, ([], [])
                if held >= block_bytes:
                    ids, texts, held, full = [], [], 0, (ids, texts)
        if full[0] or ids:
            yield pack(full[0] + ids, full[1] + texts, number)

    return run


def _unpacked(payload: bytes) -> tuple[np.ndarray, list[bytes]]:
    n = int.from_bytes(payload[:8], "little")
    whole = zstandard.ZstdDecompressor().decompress(payload[8:])
    ids, sizes = np.frombuffer(whole, "<i8", n), np.frombuffer(whole, "<i8", n, 8 * n)
    ends = 16 * n + np.cumsum(sizes)
    return ids.copy(), [whole[e - s : e] for s, e in zip(sizes, ends, strict=True)]


def _distinct_words(texts: list[bytes]) -> list[str]:
    """The distinct words of all texts in order of appearance, which is the same in every run."""
    return list(dict.fromkeys(chain.from_iterable(words_of(text.decode()) for text in texts)))


def _segments_of(pairs: frozenset[str], common: Broadcast | None = None):
    """The distinct segments of every block that are not common, numbered from 0 in order of appearance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, held = Cutter(pairs), common.value if common else {}
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                words, asked = _distinct_words(_unpacked(payload)[1]), {}
                for at in range(0, len(words), CUT_WORDS):
                    asked.update(dict.fromkeys(filterfalse(held.__contains__, cut([BLANK + word for word in words[at : at + CUT_WORDS]])[0])))
                del words
                listed = list(asked)
                for at in range(0, len(listed), 50_000):
                    part = listed[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(part)), pa.array(range(at, at + len(part)), pa.int32()), pa.array(part)],
                        ["block", "place", "word"],
                    )

    return run


def dealt(words: DataFrame, tasks: int) -> DataFrame:
    """The words with their ``slot``, two bytes of a hash, dealt out over ``tasks`` partitions by it."""
    return words.withColumn("slot", (F.xxhash64("word").bitwiseAND(F.lit(SLOTS - 1))).cast("int")).repartition(tasks, "slot")


def lattice(words: DataFrame, pieces: Pieces, keep: str = "word") -> DataFrame:
    """``keep, path`` of words that are dealt out (``slot, word, keep``): the codes of the best-scoring sequence of pieces.

    A code is a piece's id, or ``UNKNOWN_CODE`` plus the code point of a character that is
    no piece; that has the score of an unknown. Words are cut into windows of starts, so
    that a row of the lattice never carries a long word. Substrings up to the longest piece
    are exploded and joined to the useful pieces, of which there are no more than in the
    vocabulary. Words are numbered where they lie, and their edges, which never leave that
    partition, are gathered by slot and number. They are folded in order of
    their ends; the fold keeps the best edge and its total for every end, of equal totals
    the edge that starts first. An edge is one integer of its end, its size and its code, so
    that the greatest of equal totals is the longest one.
    It runs over slices of the edges and carries the totals that the next slice can reach,
    and so does the walk back from the end, so the work grows with the length of a word,
    not with its square. Words without characters have no path.
    """
    useful = pieces.useful()
    longest = max(len(piece) for piece, _, _ in useful)
    if longest > 255 or max(i for _, i, _ in useful) >= UNKNOWN_CODE:
        raise ValueError("pieces are too long or too many for the packed edges")
    table = words.sparkSession.createDataFrame(useful, "piece string, id int, score double")
    # everything up to the grouping keeps the partitioning by slot
    group = ["slot", "number"]
    numbered = words.where(F.length("word") > 0).withColumn("number", F.monotonically_increasing_id())
    windows = numbered.select(*group, F.explode(F.expr(f"""
        transform(sequence(0, length(word) - 1, {WINDOW}), at -> named_struct(
            'at', at, 'part', substring(word, greatest(at - {longest} + 1, 0) + 1, {WINDOW} + least(at, {longest} - 1)),
            '{keep}', if(at = 0, {keep}, null)))""")).alias("w")).select(*group, "w.*")
    # `first` is the place in the window's part where its first end lies
    ends = windows.withColumn("first", F.expr(f"least(at, {longest} - 1) + 1")).select(
        *group, "at", "part", keep, "first", F.explode(F.expr("sequence(first, length(part))")).alias("stop"))
    spans = ends.select(*group, F.when(F.col("stop") == 1, F.col(keep)).alias(keep), F.expr("at + stop - first + 1").alias("end"),
                        "part", "stop", F.explode(F.expr(f"sequence(least(stop, {longest}), 1, -1)")).alias("size"))
    pieces_at = spans.select(*group, keep, "end", "size", F.expr("substring(part, stop - size + 1, size)").alias("piece"))
    met = pieces_at.join(F.broadcast(table), "piece", "left").where(F.col("id").isNotNull() | (F.col("size") == 1))
    code = F.coalesce(F.col("id"), F.ascii("piece") + UNKNOWN_CODE).cast("bigint")
    key = F.shiftleft(F.col("end").cast("bigint"), 32) + F.shiftleft(F.col("size").cast("bigint"), 24) + code
    score = F.coalesce("score", F.lit(pieces.worst - UNKNOWN)).alias("score")
    edge = F.struct(key.alias("key"), score, F.col("end"), (F.col("end") - F.col("size")).alias("start"))
    edges = met.select(*group, keep, edge.alias("edge"))
    gathered = edges.groupBy(*group).agg(F.first(keep, ignorenulls=True).alias(keep), F.sort_array(F.collect_list("edge")).alias("edges"))
    best = "struct<total:double,edge:bigint>"
    # `done` holds the best edges of finished ends, the first of them `from`; `now` that of `end`, the one in work,
    # where no edge of the same end can start
    step = """
        named_struct(
            'done', if(e.end = s.end, s.done, array_append(s.done, s.now)), 'end', e.end,
            'now', if(e.end = s.end,
                greatest(s.now, named_struct('total', e.score + get(s.done, e.start - whole.from).total, 'edge', e.key)),
                named_struct('total', e.score + if(e.start = s.end, s.now.total, get(s.done, e.start - whole.from).total), 'edge', e.key)))"""
    # end 0 has a total and no edge
    fold = f"""
        aggregate(sequence(0, (size(edges) - 1) div {SLICE}),
            named_struct('state', named_struct('done', cast(array() as array<{best}>), 'end', 0, 'now', named_struct('total', 0D, 'edge', 0L)),
                         'from', 0, 'parts', cast(array() as array<array<bigint>>)),
            (whole, k) -> aggregate(slice(edges, cast(k * {SLICE} + 1 as int), {SLICE}), whole.state, (s, e) -> {step},
                s -> named_struct(
                    'state', named_struct(
                        'done', slice(s.done, greatest(size(s.done) - {longest}, 0) + 1, {longest}), 'end', s.end, 'now', s.now),
                    'from', whole.from + greatest(size(s.done) - {longest}, 0),
                    'parts', concat(whole.parts, array(transform(
                        slice(s.done, size(whole.state.done) + 1, size(s.done)), d -> d.edge))))),
            whole -> slice(concat(flatten(whole.parts), array(whole.state.now.edge)), 2, whole.state.end))
    """
    walk = f"""
        aggregate(sequence(0, (size(best) - 1) div {SLICE}),
            named_struct('at', size(best), 'parts', cast(array() as array<array<int>>)),
            (whole, c) -> aggregate(
                sequence(cast(size(best) - c * {SLICE} as int), cast(greatest(size(best) - (c + 1) * {SLICE} + 1, 1) as int), -1),
                named_struct('at', whole.at, 'path', cast(array() as array<int>)),
                (s, k) -> if(k = s.at,
                    named_struct('at', k - cast(shiftright(best[k - 1], 24) & 255 as int),
                                 'path', array_append(s.path, cast(best[k - 1] & 16777215 as int))),
                    s),
                s -> named_struct('at', s.at, 'parts', concat(whole.parts, array(s.path)))),
            whole -> reverse(flatten(whole.parts)))
    """
    return gathered.select(keep, F.expr(fold).alias("best")).select(keep, F.expr(walk).alias("path"))


def encoded_words(words: DataFrame, pieces: Pieces, keep: str = "word") -> DataFrame:
    """``keep, ids`` of words that are dealt out, with unknown characters as the ids of their UTF-8 bytes."""
    table = F.array(*[F.lit(i) for i in pieces.byte_ids])
    byte = "table[{} + (shiftright(c, {}) & 63)]".format
    known = F.expr(f"""
        if(exists(path, c -> c >= {UNKNOWN_CODE}), flatten(transform(transform(path, p -> named_struct('p', p, 'c', p - {UNKNOWN_CODE})), x ->
            case when x.c < 0 then array(x.p)
                 when x.c < 128 then array(table[x.c])
                 when x.c < 2048 then array(table[192 + shiftright(x.c, 6)], {byte(128, 0)})
                 when x.c < 65536 then array(table[224 + shiftright(x.c, 12)], {byte(128, 6)}, {byte(128, 0)})
                 else array(table[240 + shiftright(x.c, 18)], {byte(128, 12)}, {byte(128, 6)}, {byte(128, 0)}) end)), path)
    """.replace("shiftright(c,", "shiftright(x.c,"))
    return lattice(words, pieces, keep).withColumn("table", table).select(keep, known.alias("ids"))


def _apply(pairs: frozenset[str], shown: dict[int, bytes], common: Broadcast):
    """Encode the texts of a block with the paths of its segments, and decode the ids of each row again."""

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        held = common.value
        out_id, out_ids, out_n, out_crc, out_same = [], [], [], [], []
        ids = replies.column("ids").combine_chunks()
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        known, begin = [b""] * len(ends), 0
        for place, end in zip(replies.column("place").to_pylist(), ends, strict=True):
            known[place] = flat[begin:end].tobytes()
            begin = end
        cut = Cutter(pairs)
        blank = BLANK.encode()
        texts_of = np.full(max(shown) + 1, None, object)  # what an id decodes to
        texts_of[list(shown)] = [piece.replace(blank, b" ") for piece in shown.values()]
        for payload in block.column("payload").to_pylist():
            numbers, texts = _unpacked(payload)
            places = defaultdict(count().__next__)  # numbers words from 0 as they are looked up
            codes = [np.fromiter(map(places.__getitem__, words_of(text.decode())), np.int32) for text in texts]
            words = list(places)
            del places
            table, asked, answers = np.empty(len(words), object), {}, iter(known)
            for at in range(0, len(words), CUT_WORDS):
                parts, stops = cut([BLANK + word for word in words[at : at + CUT_WORDS]])
                asked.update(zip([s for s in dict.fromkeys(filterfalse(held.__contains__, parts)) if s not in asked], answers))
                paths = [held[s] if s in held else asked[s] for s in parts]
                begins = np.r_[0, stops][:-1]
                table[at : at + len(stops)] = [paths[begin] for begin in begins.tolist()]
                several = np.flatnonzero(stops > begins + 1)
                for n, begin, stop in zip(several.tolist(), begins[several].tolist(), stops[several].tolist(), strict=True):
                    table[at + n] = b"".join(paths[begin:stop])
            if len(asked) < len(known):
                raise ValueError("paths of segments that nobody asked for")
            del words, asked, answers
            for doc_id, text, places_of in zip(numbers, texts, codes, strict=True):
                encoded = b"".join(table[places_of].tolist())
                back = b"".join(texts_of[np.frombuffer(encoded, "<u4")].tolist())
                # byte pieces may spell the sign; the blank put in front is one byte by now
                back = (back.replace(blank, b" ") if blank in back else back)[1:]
                out_id.append(int(doc_id))
                out_ids.append(encoded)
                out_n.append(len(encoded) // 4)
                out_crc.append(zlib.crc32(back))
                out_same.append(back == text)
        return pa.table({"doc_id": pa.array(out_id, pa.int64()), "n_tokens": pa.array(out_n, pa.int64()), "ids": pa.array(out_ids, pa.binary()),
                         "text_crc32": pa.array(out_crc, pa.int64()), "round_trip": pa.array(out_same, pa.bool_())})

    return run


def encode(documents: DataFrame, pieces: Pieces, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids, text_crc32, round_trip`` of every row with an id.

    ``ids`` are little-endian unsigned 32-bit integers in one binary value (see
    ``id_arrays``). Every row is decoded again from its ids, as ``decode`` does it:
    ``text_crc32`` is the checksum of the decoded text, and ``round_trip`` says that this
    is the text of the row. It is false for texts that hold the blank sign U+2581, which
    decodes to a blank. A null or empty text has no ids. Repeated rows and ids are encoded
    and decoded each, other columns are ignored.

    Texts are written in compressed blocks; the distinct segments of each block ask for
    their paths by their place in it. Who asks for a segment is gathered by one shuffle on
    it and goes with it through the lattice, which finds its path once and where it lies, so
    the answers go back to the blocks by one more shuffle, without a join on the segments;
    the blocks, written in buckets, do not move. Segments that are most common in ``COMMON_BLOCKS``
    blocks, ``COMMON`` of them at most, get their paths first; every task holds these, so
    nobody asks for them. Which they are changes no result. No dictionary is larger than
    its block and these.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "pieces")
    packed = id_and_text(documents).mapInArrow(_blocks(block_bytes), "block bigint, size bigint, payload binary")
    blocks = scratch.write_buckets(packed, "blocks", "block", partitions(spark))
    pairs, asking = pieces.pairs, "block bigint, place int, word string"
    looked = [r.block for r in blocks.select("block").orderBy(F.xxhash64("block"), "block").limit(COMMON_BLOCKS).collect()]
    seen = blocks.where(F.col("block").isin(looked)).mapInArrow(_segments_of(pairs), asking).groupBy("word").count()
    often = seen.orderBy(F.desc("count"), "word").limit(COMMON).select("word")
    first = encoded_words(dealt(often, 1 + COMMON // PART_WORDS), pieces).collect()
    common = spark.sparkContext.broadcast({r.word: np.array(r.ids, "<u4").tobytes() for r in first})
    asked = blocks.mapInArrow(_segments_of(pairs, common), asking)
    tasks = 1 + (blocks.agg(F.sum("size")).first()[0] or 0) // PART_BYTES
    gathered = dealt(asked, tasks).groupBy("slot", "word").agg(F.collect_list(F.struct("block", "place")).alias("askers"))
    # two arrays of numbers are less to carry along than an array of rows
    askers = gathered.select("slot", "word", F.struct(F.col("askers.block").alias("block"), F.col("askers.place").alias("place")).alias("askers"))
    found = encoded_words(askers, pieces, "askers")
    replies = found.selectExpr("ids", "inline(arrays_zip(askers.block, askers.place)) as (block, place)").select("block", "place", "ids")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _apply(pairs, pieces.shown(), common), "doc_id bigint, n_tokens bigint, ids binary, text_crc32 bigint, round_trip boolean"
    )


def id_arrays(encoded: DataFrame) -> DataFrame:
    """``doc_id, ids`` of encoded rows, the ids as array<int>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>")


def _decoded(ids: np.ndarray, shown: dict[int, bytes]) -> str:
    try:
        whole = b"".join(map(shown.__getitem__, ids.tolist()))
    except KeyError as e:
        raise ValueError(f"no piece has id {e.args[0]}") from None
    return whole.decode().replace(BLANK, " ")[1:]


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """The rows with their ``text``, from ``ids`` as array<int> or as the binary value of ``encode``.

    Each row is decoded by itself, so that rows that share a doc_id keep their own texts.
    Byte pieces give their byte. The blank put in front is removed, blank signs become
    blanks. A null or empty sequence gives an empty text, an unknown id raises an error.
    """
    shown = pieces.shown()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            binary = pa.types.is_binary(batch.column(at).type) or pa.types.is_large_binary(batch.column(at).type)
            begin, held, texts = 0, 0, []
            for n in range(batch.num_rows):
                value = batch.column(at)[n]
                if not value.is_valid:
                    ids = np.zeros(0, np.int64)
                elif binary:
                    ids = np.frombuffer(value.as_py(), "<u4")
                elif value.values.null_count:
                    raise ValueError("no piece has id null")
                else:
                    ids = value.values.to_numpy()
                texts.append(_decoded(ids, shown))
                held += len(texts[-1])
                if held >= BLOCK_BYTES or n + 1 == batch.num_rows:
                    part = batch.slice(begin, len(texts))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "text"])
                    begin, held, texts = n + 1, 0, []

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("text", StringType())]))

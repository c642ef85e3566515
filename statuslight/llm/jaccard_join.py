"""Near-duplicate documents: a set-similarity join with adaptive multi-match prefixes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import LOWER, Scratch, id_and_text, utf8
from statuslight.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
#: shingles that a task gathers before it sends them on
BUFFER = 1_000_000
#: shingles of a bucket: many buckets first, then larger ones, at most the second value
BUCKET, LARGEST_BUCKET, MANY_BUCKETS = 256_000, 8_000_000, 4_096
#: work of comparing two sets, in postings looked at for each shingle of the set
VERIFY_COST = 0.01
LONGEST_MATCH = 8

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
PACKET = "bucket bigint, kind int, payload binary"
OWNED = pa.schema([("doc_id", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("high", pa.int64()),
                   ("low", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M1
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[bytes], hashes: WordHashes) -> list[np.ndarray]:
    """The distinct 64-bit shingle hashes of each text, sorted."""
    sets = []
    for text in texts:
        words = text.translate(LOWER).split()
        if not words:
            sets.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        span = min(SHINGLE_WORDS, len(words))
        x = np.full(len(words) - span + 1, span, np.uint64)
        for k in range(span):
            x = _mixed(x + h[k : len(words) - span + 1 + k] * M2)
        sets.append(np.unique(x))
    return sets


def _pack(*arrays: np.ndarray) -> bytes:
    return len(arrays[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, found = int.from_bytes(payload[:8], "little"), 8, []
    for kind in kinds:
        kind = np.dtype(kind)
        found.append(np.frombuffer(payload, kind, n, at))
        at += n * kind.itemsize
    return found


def _owner_bucket(owner: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(owner.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _rows(keys: list[int], kind: int, payloads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([kind] * len(keys), pa.int32()), pa.array(payloads, pa.binary())],
        ["bucket", "kind", "payload"],
    )


def _grouped(keys: np.ndarray, *arrays: np.ndarray) -> tuple[list[int], list[bytes]]:
    """A packed payload for each key."""
    order = np.argsort(keys, kind="stable")
    ordered, arrays = keys[order], [a[order] for a in arrays]
    cuts = np.r_[0, np.flatnonzero(np.diff(ordered)) + 1, len(ordered)]
    found, payloads = [], []
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end > begin:
            found.append(int(ordered[begin]))
            payloads.append(_pack(*[a[begin:end] for a in arrays]))
    return found, payloads


def _send(buckets: int, owners: int):
    """Shingles to their buckets (kind 0) and documents to the buckets of their owners (kind 1).

    Equal sets of one buffer share an owner, the first document that has the set, whose
    shingles are sent once.
    """

    def flush(members: list[tuple], sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        table = np.array(members, np.int64).reshape(-1, 5)
        keys = _owner_bucket(table[:, 1], owners)
        spread = _mixed(table[:, 0].astype(np.uint64)) % np.uint64(buckets)
        found, payloads = _grouped(keys, *table.T)
        yield _rows([int(spread[0])] * len(found), 1, [k.to_bytes(8, "little") + p for k, p in zip(found, payloads, strict=True)])
        if sets:
            tokens = np.concatenate(list(sets.values()))
            owner = np.repeat(np.fromiter(sets, np.int64, len(sets)), [len(s) for s in sets.values()])
            found, payloads = _grouped((tokens % np.uint64(buckets)).astype(np.int64), tokens, owner)
            for at in range(0, len(found), 1000):
                yield _rows(found[at : at + 1000], 0, payloads[at : at + 1000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, members, sets, seen, held = WordHashes(), [], {}, {}, 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, s in zip(ids, shingle_sets(utf8(batch.column("text")), hashes), strict=True):
                high = int(s.sum().view(np.int64)) if len(s) else 0
                low = int(np.bitwise_xor.reduce(_mixed(s * M2)).view(np.int64)) if len(s) else 0
                key = (len(s), high, low) if len(s) else doc_id
                if key not in seen:
                    seen[key] = doc_id
                    sets.setdefault(doc_id, s)
                    held += len(s)
                members.append((doc_id, seen[key], len(s), high, low))
                if held >= BUFFER or len(members) >= BUFFER:
                    yield from flush(members, sets)
                    members, sets, seen, held = [], {}, {}, 0
        if members:
            yield from flush(members, sets)

    return run


def _count(owners: int):
    """Of a bucket's shingles keep those of two owners or more, and send them to their owners' buckets."""

    def run(table: pa.Table) -> pa.Table:
        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        keys, out, sent = [], [], []
        for kind, payload in zip(kinds, payloads, strict=True):
            if kind == 1:
                keys.append(int.from_bytes(payload[:8], "little"))
                out.append(payload[8:])
                sent.append(1)
        parts = [_unpack(p, "u8", "i8") for k, p in zip(kinds, payloads, strict=True) if k == 0]
        if parts:
            tokens, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((owner, tokens))
            tokens, owner = tokens[order], owner[order]
            once = np.r_[True, (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])]
            tokens, owner = tokens[once], owner[once]
            cuts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1], True])
            count = np.repeat(np.diff(cuts), np.diff(cuts))
            shared = count > 1
            found, packed = _grouped(
                _owner_bucket(owner[shared], owners), owner[shared], tokens[shared], count[shared].astype(np.int64)
            )
            keys += found
            out += packed
            sent += [0] * len(found)
        return pa.table({"bucket": pa.array(keys, pa.int64()), "kind": pa.array(sent, pa.int32()), "payload": pa.array(out, pa.binary())})

    return run


def _gather(table: pa.Table) -> pa.Table:
    """A row per document, and on the row of an owner its shared shingles, rarest first.

    The shingles of a set that has fewer shared ones than a link needs are left out.
    """
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
    members = [_unpack(p, "i8", "i8", "i8", "i8", "i8") for k, p in zip(kinds, payloads, strict=True) if k == 1]
    shared = [_unpack(p, "i8", "u8", "i8") for k, p in zip(kinds, payloads, strict=True) if k == 0]
    doc_id, rep, n, high, low = (np.concatenate(x) for x in zip(*members, strict=True))
    tokens, counts = [None] * len(doc_id), [None] * len(doc_id)
    if shared:
        owner, token, count = (np.concatenate(x) for x in zip(*shared, strict=True))
        order = np.lexsort((token, count, owner))
        owner, token, count = owner[order], token[order], count[order]
        cuts = np.r_[0, np.flatnonzero(np.diff(owner)) + 1, len(owner)]
        at = {int(owner[b]): (b, e) for b, e in zip(cuts[:-1], cuts[1:], strict=True)}
        texts = {}
        for i in np.flatnonzero(doc_id == rep):
            texts.setdefault(int(rep[i]), {})[n[i], high[i], low[i]] = i
        for owner_id, rows in texts.items():
            i = next(iter(rows.values()))
            begin, end = at.get(owner_id, (0, 0))
            if len(rows) == 1 and end - begin >= _least(int(n[i])):
                tokens[i], counts[i] = token[begin:end].tobytes(), count[begin:end].tobytes()
    arrays = [pa.array(doc_id), pa.array(rep), pa.array(n), pa.array(high), pa.array(low),
              pa.array(tokens, pa.binary()), pa.array(counts, pa.binary())]
    return pa.Table.from_arrays(arrays, schema=OWNED)


def _least(n: int) -> int:
    """Shingles that a set of ``n`` shares with any set it is linked to."""
    return max(1, -(-PERCENT * n // 100))


def prefix_length(n: int, counts: np.ndarray) -> tuple[int, int]:
    """How many shared shingles to index and how many of them a partner has to share.

    A set of n has ``n - len(counts)`` shingles of its own in front. With a prefix of
    ``n - least + m`` every partner shares m of its shingles, so m is chosen, from 1 to
    ``LONGEST_MATCH``, by the postings that the prefix touches and the candidates left
    to compare, estimated as those postings divided by m. 0: no partner can exist.
    """
    alone, least = n - len(counts), _least(n)
    touched = np.r_[0, np.cumsum(counts - 1)]
    best, chosen = math.inf, (0, 0)
    for m in range(1, min(LONGEST_MATCH, least) + 1):
        prefix = n - least + m - alone
        if prefix < m:
            return 0, 0
        postings = float(touched[prefix])
        cost = postings + VERIFY_COST * n * postings / m
        if cost < best:
            best, chosen = cost, (prefix, m)
    return chosen


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        token, doc, size, match, place, alone = [], [], [], [], [], []
        for rep, n, tokens, counts in zip(*(batch.column(c).to_pylist() for c in ("rep", "n", "tokens", "counts")), strict=True):
            length, m = prefix_length(n, np.frombuffer(counts, np.int64))
            if length:
                token.append(np.frombuffer(tokens, np.int64)[:length])
                doc.append(np.full(length, rep))
                size.append(np.full(length, n))
                match.append(np.full(length, m))
                place.append(n - len(counts) // 8 + np.arange(length))
                alone.append(np.full(length, n - len(counts) // 8))
        if token:
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (token, doc, size, match, place, alone)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "rep", "n", "matches", "place", "alone"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n, m, left, right in zip(*(batch.column(c).to_pylist() for c in ("an", "bn", "at", "bt")), strict=True):
            both = len(np.intersect1d(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), assume_unique=True))
            keep.append(100 * both >= PERCENT * (n + m - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, by their shared shingles."""
    def side(p):
        return sets.select(F.col("rep").alias(p), F.col("n").alias(f"{p}n"), F.col("tokens").alias(f"{p}t"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "an", "bn", "at", "bt").mapInArrow(
        _linked, "a bigint, b bigint"
    )


def _reachable(a: str, b: str) -> F.Column:
    """Sizes allow the similarity, and this shared shingle can be one of the first that a linked pair shares.

    A linked pair shares ``least`` shingles, so neither set has more than ``n - least`` of
    its own. The first m shared ones stand before ``n - least + m`` in both sets, so a
    later place says nothing about the pair.
    """
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    least = F.ceil(PERCENT * (n + m) / F.lit(100 + PERCENT))
    asked = F.least(f"{a}m", f"{b}m")
    fits = (100 * m >= PERCENT * n) & (100 * n >= PERCENT * m)
    fits = fits & (F.col(f"{a}o") <= n - least) & (F.col(f"{b}o") <= m - least)
    return fits & (F.col(f"{a}p") < n - least + asked) & (F.col(f"{b}p") < m - least + asked)


def _side(rows: DataFrame, p: str, *more: str) -> DataFrame:
    names = {"rep": p, "n": f"{p}n", "matches": f"{p}m", "place": f"{p}p", "alone": f"{p}o", "label": f"{p}l"}
    return rows.select("token", *[F.col(c).alias(names[c]) for c in ("rep", "n", "matches", "place", "alone", *more)])


def jaccard_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, set_id`` of every row with an id.

    A document's set holds the distinct five-word shingles of its text, lower-cased in
    A-Z; fewer words make one shingle, no words an empty set that is linked with
    nothing. Two documents are linked at a Jaccard similarity of 0.8 or more;
    ``component_id`` is the smallest doc_id reachable by links, ``set_id`` the smallest
    with an equal set. A null text counts as empty. Repeated rows are equal sets; an id
    that comes with several texts is linked to equal sets only. Other columns are ignored.

    Shingles are counted in buckets of bounded size, to which tasks send blocks of
    hashes; only shingles of two sets or more go on, and equal sets are one from here.
    A set needs 80% of its shingles shared to have a partner at all. Prefixes are
    chosen by ``prefix_length``. Candidates are first the best partner among the most
    typical sets of its prefix postings; groups of many alike documents become one
    component this way. Then all pairs of different components that share as many
    prefix shingles as the less demanding of the two asks for are compared. Sets are
    held as 64-bit hashes, compared exactly as such.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = id_and_text(documents, id_col, text_col)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    per_bucket = min(LARGEST_BUCKET, max(BUCKET, size // 6 // MANY_BUCKETS))
    buckets = max(1, math.ceil(size / 6 / per_bucket))
    owners = max(1, math.ceil(buckets / 2))
    sent = rows.mapInArrow(_send(buckets, owners), PACKET)
    counted = sent.groupBy("bucket").applyInArrow(_count(owners), PACKET)
    gathered = counted.groupBy("bucket").applyInArrow(
        _gather, "doc_id bigint, rep bigint, n bigint, high bigint, low bigint, tokens binary, counts binary"
    )
    table = scratch.write(gathered, "sets")

    filled = table.where(F.col("n") > 0)
    key = ["n", "high", "low"]
    equal = filled.groupBy(*key).agg(F.min("doc_id").alias("set_id"))
    owned = filled.where(F.col("tokens").isNotNull())
    first = owned.groupBy(*key).agg(F.min("rep").alias("rep")).join(equal, key)
    sets = owned.join(first, [*key, "rep"]).select(F.col("set_id").alias("rep"), "n", "tokens", "counts")
    sets = scratch.write(sets, "shared")
    columns = "token bigint, rep bigint, n bigint, matches bigint, place bigint, alone bigint"
    index = scratch.write(sets.mapInArrow(_index, columns), "index")

    # the most typical set of a shingle: the smallest share of shingles that nobody else has
    typical = index.groupBy("token").agg(F.min_by(F.struct("rep", "n", "matches", "place", "alone"), F.struct(F.col("alone") / F.col("n"), "rep")).alias("t"))
    leader = _side(typical.select("token", "t.*"), "a")
    led = _side(index, "b").join(leader, "token").where((F.col("a") != F.col("b")) & _reachable("a", "b"))
    tried = led.groupBy("a", "b").agg(F.count("*").alias("shared"))
    best = tried.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a"))
    starred = scratch.write(_verified(best.select("a", "b"), sets), "starred")
    stars = components(starred, scratch, "stars")

    placed = index.join(stars.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    placed = scratch.write(placed, "placed")
    met = _side(placed, "a", "label").join(_side(placed, "b", "label"), "token").where(
        (F.col("a") < F.col("b")) & (F.col("al") != F.col("bl")) & _reachable("a", "b")
    )
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first(F.least("am", "bm")).alias("asked"))
    crossed = scratch.write(_verified(pairs.where(F.col("shared") >= F.col("asked")).select("a", "b"), sets), "crossed")
    labels = components(starred.union(crossed), scratch, "links")

    named = table.join(equal, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("set_id")).otherwise(F.col("doc_id")).alias("set_id"),
    )
    whole = named.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    return whole.select("doc_id", "n_shingles", F.coalesce("label", "set_id").alias("component_id"), "set_id")

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm.conftest import AWKWARD

from statuslight.llm import piece_lattice as pl

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return pl.Pieces.load(MODEL)


@pytest.fixture(scope="module")
def unigram():
    """The library's own Viterbi over the same pieces and scores."""
    os.environ.setdefault("PROTOCOL_BUFFERS_PYTHON_IMPLEMENTATION", "python")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def viterbi(text, pieces):
    """Best path over the whole escaped text; of equal totals the piece that starts first."""
    whole = "▁" + text.replace(" ", "▁") if text else ""
    table = {p: (i, s) for p, i, s in pieces.rows}
    best = [(0.0, 0, [])]
    for end in range(1, len(whole) + 1):
        found = None
        for start in range(max(0, end - pieces.longest), end):
            piece = whole[start:end]
            if piece in table:
                ids, score = [table[piece][0]], table[piece][1]
            elif end - start == 1:
                ids, score = [pieces.byte_ids[b] for b in piece.encode()], pieces.worst - pl.UNKNOWN
            else:
                continue
            if found is None or best[start][0] + score > found[0]:
                found = (best[start][0] + score, start, ids)
        best.append(found)
    path, at = [], len(whole)
    while at:
        path = best[at][2] + path
        at = best[at][1]
    return path


def test_ids_match_viterbi_and_the_library(spark, small, pieces, unigram):
    documents = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 3000")
    texts = {r.doc_id: r.text for r in documents.collect()}
    scores = {i: s for _, i, s in pieces.rows} | dict.fromkeys(pieces.byte_ids, 0.0)
    rows = pl.encode(documents, pieces, block_bytes=200_000).collect()
    assert len(rows) == len(texts) > 50
    same = 0
    for r in rows:
        ids, theirs = np.frombuffer(r.ids, "<u4").tolist(), unigram.encode(texts[r.doc_id])
        assert r.round_trip and r.n_tokens == len(ids)
        assert ids == viterbi(texts[r.doc_id], pieces), r.doc_id
        # the library sums single-precision totals over the whole text, so ties may fall otherwise
        assert sum(scores[i] for i in ids) >= sum(scores[i] for i in theirs)
        same += sum(a == b for a, b in zip(ids, theirs)) / max(1, len(ids)) if len(ids) == len(theirs) else 0
    assert unigram.decode(theirs) == texts[r.doc_id]
    assert same > 0


def test_round_trip_and_awkward_rows(spark, awkward, nothing, pieces):
    rows = pl.id_arrays(pl.encode(awkward.where("doc_id != 5"), pieces))
    texts = {i: t or "" for i, t in AWKWARD if i not in (None, 5)}
    found = {r.doc_id: r.ids for r in rows.collect()}
    assert found.keys() == texts.keys()
    # a blank sign in the text itself reads as a blank
    back = {r.doc_id: r.text for r in pl.decode(rows, pieces).collect()}
    assert back == {i: t.replace("▁", " ") for i, t in texts.items()}
    assert all(found[i] == viterbi(t, pieces) for i, t in texts.items() if i not in (14, 15, 16, 17))
    assert pl.encode(nothing, pieces).count() == 0


def test_unknown_id_raises(spark, pieces):
    with pytest.raises(Exception, match="no piece has id"):
        pl.decode(spark.createDataFrame([(1, [40_000])], "doc_id bigint, ids array<int>"), pieces).collect()


def test_repeated_ids_and_blank_signs(spark, awkward, pieces):
    """Rows that share an id keep their own texts; what does not decode to the text says so."""
    rows = [(5, "first text of five"), (5, "another one, longer than the first"), (5, "first text of five"), (6, "a▁b"), (7, "a b"), (8, "▁"), (9, None), (10, "𝄞 é  ")]
    encoded = pl.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), pieces)
    back = [t.replace("▁", " ") if t else "" for _, t in rows]
    for how in (encoded, pl.id_arrays(encoded)):
        assert sorted((r.doc_id, r.text) for r in pl.decode(how, pieces).collect()) == sorted((i, t) for (i, _), t in zip(rows, back, strict=True))
    found = sorted((r.doc_id, r.text_crc32, r.round_trip) for r in encoded.collect())
    assert found == sorted((i, zlib.crc32(b.encode()), b == (t or "")) for (i, t), b in zip(rows, back, strict=True))
    kept = {(r.doc_id, r.round_trip) for r in pl.encode(awkward, pieces).collect()}
    assert kept == {(i, i != 17) for i, _ in AWKWARD if i is not None}


def test_long_unbroken_words(spark, pieces):
    """Paths across windows and slices, with unknown characters of one to four bytes."""
    rng = np.random.default_rng(3)
    letters = [*"etaoinshrdlu", "é", "𝄞", "ÿ", "\x01", "漢", "𐍈"]
    rows = [(n, "".join(rng.choice(letters, n))) for n in (63, 64, 65, 128, 129, 1500, 3000)]
    rows += [(5000, "ab" * 2500), (5001, "e" * 5001), (90_000, "".join(rng.choice([*"etaoinshrdlu"], 90_000)))]
    found = {r.doc_id: r for r in pl.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), pieces).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        assert found[doc_id].round_trip and found[doc_id].text_crc32 == zlib.crc32(text.encode())
        if doc_id < 6000:
            assert np.frombuffer(found[doc_id].ids, "<u4").tolist() == viterbi(text, pieces), doc_id


def test_paths_come_back_without_a_join_on_segments(spark, pieces):
    """Who asks for a segment goes with it through the lattice, in several blocks and for several segments of one."""
    rows = [(n, f"alpha beta{n % 3} gamma {'zeta' * (n % 5)} 漢{n % 2}") for n in range(40)]
    encoded = pl.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), pieces, block_bytes=100)
    assert "SortMergeJoin" not in encoded._jdf.queryExecution().executedPlan().toString()
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encoded.collect()}
    assert found == {n: viterbi(text, pieces) for n, text in rows}


def test_pieces_that_no_best_path_has_are_left_out(pieces):
    """A piece is left out of the lattice exactly where smaller ones score more in its place."""
    useful = {piece for piece, _, _ in pieces.useful()}
    whole = [(p, i) for p, i, _ in pieces.rows if p[0] == "▁" and len(p) > 1 and "▁" not in p[1:]][::20]
    found = [(p in useful, viterbi(p[1:], pieces) == [i]) for p, i in whole]
    assert all(a == b for a, b in found) and {a for a, _ in found} == {True, False}


def test_edges_are_gathered_where_the_segment_lies(spark, pieces):
    """Segments are shuffled once on their way to their paths, and a small rest of texts goes with the block before it."""
    rows = [(n, f"word{n} " * 5) for n in range(41)]
    encoded = pl.encode(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), pieces, block_bytes=400)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(number" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    assert {r.doc_id: r.round_trip for r in encoded.collect()} == {n: True for n, _ in rows}

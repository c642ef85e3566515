import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statuslight.llm import language, piece_lattice
from tests.llm.conftest import AWKWARD

PIECES = ["▁", "a", "b", "ab", "ba", "▁a", "aab", "abab", "é", "bé"]
TABLE = np.vstack([np.random.default_rng(2).random((len(PIECES), 3)) * 0.2, np.full((1, 3), 1e-3)])


def all_segmentations(text):
    """Every way to cut a text into pieces, a character that is no piece being a piece by itself."""
    if not text:
        return [[]]
    found = []
    for end in range(1, len(text) + 1):
        head = text[:end]
        if head in PIECES or (end == 1 and head not in PIECES):
            found += [[head, *rest] for rest in all_segmentations(text[end:])]
    return found


def probability(path):
    return np.prod([TABLE[PIECES.index(p) if p in PIECES else -1] for p in path], axis=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abéx▁", max_size=7), min_size=1, max_size=6))
def test_forward_sums_every_segmentation(words):
    trie = language.Trie(PIECES)
    wanted = [np.log(sum(probability(path) for path in all_segmentations("▁" + w))) for w in words]
    assert np.allclose(language.word_logs(words, trie, TABLE), wanted, rtol=1e-12)


def test_expected_uses_match_enumeration():
    words, counts = ["abab", "baab", "x", "aabé"], np.array([[1.0, 0, 2], [0, 3, 0], [1, 1, 1], [2, 0, 5]])
    wanted = np.zeros((len(PIECES) + 1, 3))
    for word, n in zip(words, counts, strict=True):
        paths = all_segmentations("▁" + word)
        whole = sum(map(probability, paths))
        for path in paths:
            for piece in path:
                wanted[PIECES.index(piece) if piece in PIECES else -1] += n * probability(path) / whole
    assert np.allclose(language.expected_uses(words, counts, language.Trie(PIECES), TABLE), wanted)


def test_long_words_in_parts(monkeypatch):
    trie, words = language.Trie(PIECES), ["abx" * 400, "ab" * 900, "é", "b" * 21, "b" * 20, "b" * 19]
    whole = language.word_logs(words, trie, TABLE)
    monkeypatch.setattr(language, "SLICE_CHARS", 20)
    monkeypatch.setattr(language, "PART_CHARS", 50)
    assert np.isfinite(whole).all()
    assert np.allclose(language.word_logs(words, trie, TABLE), whole, rtol=1e-11)


def test_slices_hold_the_whole_text(monkeypatch):
    monkeypatch.setattr(language, "SLICE_CHARS", 10)
    text = "some words and averyveryverylongone then more  blanks\n\nend"
    parts = list(language.slices(text))
    assert "".join(parts) == text and len(parts) > 2
    assert [w for p in parts for w in p.split()] == text.split()
    assert list(language.slices("")) == [""]


def test_words_are_remembered_without_change(monkeypatch):
    model = language.Languages(list("abc"), np.log(np.full(3, 1 / 3)), PIECES, TABLE)
    texts = ["ab ba  abab", None, "", "x é ab", " \n", "ab " * 300]
    plain = language.Scorer(model)(texts)
    trie = language.Trie(PIECES)
    for text, found in zip(texts, plain, strict=True):
        margin = sum((language.word_logs([w], trie, TABLE)[0] for w in (text or "").split()), np.zeros(3))
        wanted = np.exp(margin - margin.max())
        assert np.allclose(found, wanted / wanted.sum())
    monkeypatch.setattr(language, "REMEMBERED", 1)
    monkeypatch.setattr(language, "SLICE_CHARS", 5)
    assert np.allclose(language.Scorer(model)(texts), plain)


@pytest.fixture(scope="module")
def pieces():
    return [p for p, _, _ in piece_lattice.Pieces.load(public_tokenizers.path("piece_bpe_32k.model")).rows]


def test_held_out_languages_are_found(spark, small, pieces):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    found = language.predict_languages(documents, language.fit_languages(documents, pieces))
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(rows) > 30 and all(zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"])
    assert (rows.lang_pred == rows.lang).mean() > 0.97
    assert found.count() == documents.count()


def test_labels_of_held_out_rows_teach_nothing(spark, small, pieces):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    other = documents.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 'xx', lang) as lang")
    one, two = (language.fit_languages(d, pieces[:2000], rows_per_language=20, rounds=1) for d in (documents, other))
    assert one.names == two.names and np.array_equal(one.table, two.table) and np.array_equal(one.prior, two.prior)


def test_awkward_rows(spark, awkward, nothing):
    taught = awkward.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'aa', 'bb') as lang", "rep", "n", "score")
    model = language.fit_languages(taught, PIECES)
    rows = language.predict_languages(taught, model).collect()
    wanted = [(i, t) for i, t in AWKWARD if i is not None]
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in wanted)
    unknown = {i for i, t in wanted if not any(map(str.isalpha, t or ""))}
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in unknown)
        assert 0 <= r.score <= 1 and r.lang_pred in ("aa", "bb", "und")
    empty = nothing.selectExpr("*", "cast(null as string) as lang")
    assert language.predict_languages(empty, model).count() == 0
    none = language.fit_languages(empty, PIECES)
    assert {(r.lang_pred, r.score) for r in language.predict_languages(taught, none).collect()} == {("und", 0.0)}
    unlabelled = awkward.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert language.fit_languages(unlabelled, PIECES).names == []

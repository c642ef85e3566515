import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statuslight.llm import bit_planes as bp
from statuslight.llm.common import Scratch
from tests.llm.conftest import AWKWARD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_blocks_come_back(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32 if n == 7 else 50_000, n).astype(np.uint32)
    assert (bp.unpack_block(bp.pack_block(ids, planes)) == ids).all()


def test_bad_blocks_raise():
    with pytest.raises(ValueError):
        bp.pack_block(np.zeros(3, np.uint32), "nibble")
    with pytest.raises(ValueError):
        bp.unpack_block(b"nothing")


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    found, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [bp.END_ID]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize("planes,block", [("byte", 65_536), ("bit", 64)])
def test_documents_match_the_tokenizer(spark, small, awkward, nothing, planes, block):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = [(1000 + i, t) for i, t in enumerate(["<|endoftext|> a<|endoftext|>b", "it's I'LL é ΑΣ Σ", "a b c\td\r\ne\x1cf", "🙂🙂 １２３ ½"])]
    for table in (documents.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string")), awkward):
        chunks = bp.write_ids(table, PATH, Scratch(spark, "test-ids"), planes, block)
        rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect() if r.doc_id is not None]
        found = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in bp.read_documents(chunks).collect())
        assert found == expected(rows)
    assert bp.read_documents(bp.write_ids(nothing, PATH, Scratch(spark, "test-ids"))).count() == 0


def test_a_range_reads_some_chunks(spark):
    documents = spark.createDataFrame([(i, f"word number {i}") for i in range(200)], "doc_id bigint, text string")
    chunks = bp.write_ids(documents, PATH, Scratch(spark, "test-ids"), block_ids=16)
    shard = chunks.where("shard = 0").orderBy("chunk").collect()
    whole = np.concatenate([bp.unpack_block(r.payload) for r in shard])
    assert (bp.read_range(chunks, 0, 5, 40) == whole[5:40]).all()
    assert len(bp.read_range(chunks, 0, 10**6, 10**6 + 5)) == 0
    assert len(AWKWARD) > 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBzÀéßÿñ×÷ 0¹²9'sTrElLvVmMd.,!|<>\t\n\x0b\x1c\x85\xa0\u0301\u0130\u03a3ｓ½") | st.characters(exclude_categories=["Cs"]), max_size=25), min_size=1, max_size=4))
def test_words_and_units_give_the_ids_of_whole_texts(texts):
    words = bp._words(PATH)
    wanted = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in words.encode(texts)] == wanted


def test_many_words_are_forgotten_without_change(monkeypatch):
    monkeypatch.setattr(bp, "REMEMBERED", 5)
    monkeypatch.setattr(bp, "LEARNED", 3)
    words, texts = bp.Words(PATH), [" ".join(f"Word{i * j}'s end." for i in range(9)) for j in range(8)]
    for text in texts:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids

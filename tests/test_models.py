"""Backends: batches, failures, NULL input; local embedding; exact and list search; contexts."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from statuslight.operators import documents, generation, retrieval
from statuslight.plans import engagement_details


def test_generate_text_isolates_failures_and_keeps_columns(spark):
    def picky():
        def answer(prompts, options):
            if any("bad" in p for p in prompts):
                raise RuntimeError("refused")
            return [f"{p}:{options['max_output_tokens']}" for p in prompts]

        return answer

    df = spark.createDataFrame(
        [(1, "a", dt.date(2001, 1, 1), [1]), (2, "bad", None, None), (3, None, None, []), (None, "c", None, None)],
        "id bigint, prompt string, day date, list array<int>",
    )
    got = generation.generate_text(df, picky, {"max_output_tokens": 5}, batch_size=4, retries=1, wait=0.0)
    rows = {r.prompt: r for r in got.collect()}
    assert got.columns == [*df.columns, generation.RESULT, generation.STATUS]
    assert rows["a"][generation.RESULT] == "a:5" and rows["a"].day == dt.date(2001, 1, 1) and rows["a"].list == [1]
    assert rows["bad"][generation.RESULT] is None and "refused" in rows["bad"][generation.STATUS]
    assert rows[None][generation.RESULT] is None and rows[None][generation.STATUS] == "no input"
    assert rows["c"].id is None and rows["c"][generation.STATUS] == ""


def test_retries_and_wrong_answer_counts():
    calls = []

    def flaky(batch):
        calls.append(len(batch))
        if len(calls) < 3:
            raise TimeoutError
        return [x.upper() for x in batch]

    assert generation._answers(flaky, ["a", None, "b"], 8, 2, 0.0) == [("A", None), (None, "no input"), ("B", None)]
    assert calls == [2, 2, 2]
    short = generation._answers(lambda batch: batch[:1], ["a", "b"], 8, 0, 0.0)
    assert short == [("a", None), ("b", None)]


def test_generate_embedding(spark):
    df = spark.createDataFrame([("ab",), (None,)], "content string")
    got = generation.generate_embedding(df, lambda: lambda texts: [[float(len(t)), 0.5] for t in texts])
    assert {r.content: r[generation.EMBEDDING] for r in got.collect()} == {"ab": [2.0, 0.5], None: None}


def test_hash_embedding_by_hand(spark):
    texts = ["One two  two\nthree", "", " Zwei ", None]
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    place = HashingTF(numFeatures=16).indexOf
    for row in generation.hash_embedding(df, size=16).collect():
        vector = row[generation.EMBEDDING]
        if row.content is None:
            assert vector is None
            continue
        counts = np.zeros(16)
        for word in row.content.lower().split():
            counts[place(word)] += 1
        norm = np.linalg.norm(counts)
        assert np.allclose(vector, counts / norm if norm else counts, atol=1e-6)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(400, 8)).astype("float32")
    deals = [0 if i % 3 == 0 else i % 7 for i in range(400)]
    df = spark.createDataFrame(
        [(deals[i], i, [float(x) for x in data[i]]) for i in range(400)], "deal_id bigint, id bigint, embedding array<float>"
    )
    return df, data, np.array(deals)


def asked(spark, rng, n):
    vectors = rng.normal(size=(n, 8))
    df = spark.createDataFrame([(f"q{i}", [float(x) for x in v]) for i, v in enumerate(vectors)], "question string, vector array<double>")
    return df, vectors


def brute(data, ids, vector, k):
    distance = np.linalg.norm(data[ids].astype("float64") - vector, axis=1)
    order = sorted(range(len(ids)), key=lambda i: (distance[i], ids[i]))[:k]
    return [int(ids[i]) for i in order], [distance[i] for i in order]


@pytest.mark.parametrize("questions", [3, 70])
def test_topk_equals_brute_force(spark, vectors, questions):
    df, data, deals = vectors
    q, qv = asked(spark, np.random.default_rng(5), questions)
    got = {}
    for r in retrieval.vector_topk(df, q, 10, ["deal_id"]).orderBy("rank").collect():
        got.setdefault((r.deal_id, r.question), []).append((r.id, r.distance))
    assert len(got) == questions * len(set(deals))
    for (deal, question), found in got.items():
        ids, distance = brute(data, np.flatnonzero(deals == deal), qv[int(question[1:])], 10)
        assert [i for i, _ in found] == ids and np.allclose([d for _, d in found], distance)


def test_many_blocks_and_turns_give_the_same(spark, vectors, monkeypatch):
    df, _, _ = vectors
    q, _ = asked(spark, np.random.default_rng(8), 90)
    whole = sorted(map(tuple, retrieval.vector_topk(df, q, 5, ["deal_id"]).collect()))
    for name, value in (("BASE_BLOCK", 7), ("BROADCAST_BYTES", 2_000), ("KEPT_ROWS", 40), ("QUESTION_BLOCK", 9)):
        monkeypatch.setattr(retrieval, name, value)
    found = retrieval.vector_topk(df, q, 5, ["deal_id"])
    assert sorted(map(tuple, found.collect())) == whole and len(whole) > 90 * 5


def test_nearest_rows_with_ties_and_odd_numbers():
    nan, inf = float("nan"), float("inf")
    rows = np.array([[0.0, 0.0], [1e8, 1e8], [1e8, 1e8 + 1], [1e8, 1e8], [nan, 0.0], [inf, 1.0], [0.1, 0.2], [0.1, 0.2]])
    ids = [7, 3, 4, 1, 0, 2, 9, 8]
    near = retrieval.nearest_rows(rows, ids, np.array([[1e8, 1e8], [0.1, 0.2]]), 3)
    assert [i for _, i in near[0]] == [1, 3, 4] and [d for d, _ in near[0]] == [0.0, 0.0, 1.0]
    assert [i for _, i in near[1]] == [8, 9, 7]
    every = retrieval.nearest_rows(rows, ids, np.array([[0.0, 0.0]]), 20)[0]
    assert [i for _, i in every] == [7, 8, 9, 1, 3, 4, 2, 0] and np.isnan(every[-1][0])


def test_lengths_have_to_agree(spark):
    base = spark.createDataFrame([(1, [1.0, 2.0])], "id bigint, embedding array<double>")
    for questions in ([("q", [1.0])], [("q", [1.0, 2.0]), ("r", [1.0])]):
        with pytest.raises(Exception, match="differ in length"):
            retrieval.vector_topk(base, spark.createDataFrame(questions, "question string, vector array<double>")).collect()


def test_no_question_no_row(spark, vectors):
    q = spark.createDataFrame([], "question string, vector array<double>")
    assert retrieval.vector_topk(vectors[0], q).count() == 0


def test_context_skips_null_chunks_and_keeps_rank_order(spark):
    nearest = spark.createDataFrame(
        [(1, 5, "summary", 0.1, 1), (1, 6, "summary", 0.2, 2), (1, 7, "summary", 0.3, 3)],
        "deal_id bigint, id bigint, question string, distance double, rank int",
    )
    chunks = spark.createDataFrame(
        [(1, 7, "c7", "u7"), (1, 5, "c5", "u5"), (1, 6, None, "u6"), (2, 5, "x", "y")],
        "deal_id bigint, id bigint, content string, uri string",
    )
    got = retrieval.rag_context(nearest, chunks, {"summary": "Do: "}, ["deal_id"]).collect()
    assert [r.prompt for r in got] == ["Do: context: c5 and reference: u5,context: c7 and reference: u7"]


def test_details_only_for_pending_deals(spark):
    docs = spark.createDataFrame(
        [(1, "a.pdf", "objective " * 300), (1, "b.pdf", "deliverable plan"), (2, "c.pdf", "summary of scope"), (3, "d.pdf", "other")],
        "deal_id bigint, uri string, text string",
    )
    embedded = generation.hash_embedding(documents.chunk_documents(docs, ["deal_id", "uri"], F.col("text")))
    pending = spark.createDataFrame([(1,), (3,), (1,)], "deal_id bigint")
    got = engagement_details.extract_details(embedded, pending, lambda: lambda prompts, options: ['{"Background": "b"}'] * len(prompts))
    assert sorted((r.deal_id, r.background) for r in got.collect()) == [(1, "b"), (3, "b")]


@pytest.mark.parametrize("words, sizes", [(0, []), (1, [1]), (250, [250]), (251, [250, 1]), (750, [250, 250, 250])])
def test_chunk_sizes(spark, words, sizes):
    text = " \n" + "\t ".join(f"w{i}" for i in range(words)) + " "
    df = spark.createDataFrame([("u", text)], "uri string, text string")
    direct = documents.chunk_documents(df, ["uri"], F.col("text")).collect()
    parsed = documents.parse_chunks(documents.process_documents(df, ["uri"], F.col("text")), ["uri"]).collect()
    assert [len(r.content.split(" ")) for r in direct] == sizes
    assert sorted(direct) == sorted(parsed)
    assert " ".join(r.content for r in direct) == " ".join(f"w{i}" for i in range(words))


def test_html(spark):
    html = (
        "<html><style>p{}</style><script>var a='<p>';</script><!-- no --><p>One&nbsp;two &amp;lt; <b>three</b></p>"
        "<footer class=x>Page <i>1</i></footer><FOOTER>Page 2</FOOTER></html>"
    )
    df = spark.createDataFrame([("u", html), ("v", "<p>plain</p>"), ("w", None)], "uri string, html string")
    got = documents.chunk_documents(df, ["uri"], documents.without_tags(F.col("html")), documents.footers(F.col("html"))).collect()
    assert {r.uri: (r.content, r.page_footers_text) for r in got} == {
        "u": ("One&nbsp;two &lt; three Page 1 Page 2", "Page 1"), "v": ("plain", None),
    }


def test_a_batch_of_blocks_is_searched_where_it_lies():
    """What the search adds to a batch grows with one block, not with the batch."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, width, blocks = 500, 64, 40
    vectors, question = rng.normal(size=(blocks, n, width)), rng.normal(size=(1, width))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([width] * blocks, pa.int32()), pa.array([list(range(b * n, b * n + n)) for b in range(blocks)], pa.list_(pa.int64())),
         pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([["q"]] * blocks, pa.list_(pa.string())),
         pa.array([question.tobytes()] * blocks, pa.binary())],
        ["width", "ids", "vectors", "names", "matrix"],
    )
    tracemalloc.start()
    out = list(retrieval._searched([], 10, pa.int64(), [])(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    gaps = np.sqrt(((vectors.reshape(-1, width) - question) ** 2).sum(axis=1))
    assert out[0].column("id").to_pylist() == np.argsort(gaps, kind="stable")[:10].tolist()
    print(f"peak {peak / 1e6:.1f} MB of a batch of {batch.nbytes / 1e6:.1f} MB")
    assert peak < vectors.nbytes / 4

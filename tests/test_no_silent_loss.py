import pytest
from pyspark.sql import functions as F

from statuslight.operators import details, documents, generation, reporting, retrieval
from statuslight.plans import engagement_details


def test_a_document_larger_than_a_variant_keeps_its_chunks(spark):
    one = '{"chunkId":"c","content":"' + "word " * 50_000 + '"}'
    many = F.concat(F.repeat(F.lit(one + ","), 539), F.lit(one))
    result = F.concat(F.lit('{"chunkedDocument":{"chunks":['), many, F.lit("]}}")).alias("ml_process_document_result")
    assert documents.parse_chunks(spark.range(1).select("id", result).withColumnRenamed("id", "deal"), ["deal"]).count() == 540


def test_a_result_that_is_no_json_raises(spark):
    rows = spark.createDataFrame([(1, "{broken"), (2, None), (3, " "), (4, "{}")], "deal int, ml_process_document_result string")
    assert documents.parse_chunks(rows.where("deal > 1"), ["deal"]).count() == 0
    with pytest.raises(Exception, match="not valid JSON"):
        documents.parse_chunks(rows, ["deal"]).collect()


def test_an_answer_that_repeats_a_key_is_read(spark):
    text = '{"overall_status":"RED","overall_status":"RED","scope_status":{"a":1},"month_timeline":[{"event_date":"d","event_description":"e"}]}'
    row = reporting.parse_status(spark.createDataFrame([(1, text)], "id int, answer string"), "answer", ["id"]).first()
    assert row.overall_rag_status == "RED" and row.scope_status is None
    assert [tuple(e) for e in row.month_timeline_events] == [("d", "e")]


def test_rows_without_a_vector_do_not_rank(spark):
    rows = [("a", [3.0, 4.0]), ("b", None), ("c", [None, 1.0]), ("d", [0.0, 1.0])]
    base = spark.createDataFrame(rows, "id string, embedding array<double>")
    asked = spark.createDataFrame([("q", [0.0, 0.0])], "question string, vector array<double>")
    assert [(r.id, r.distance) for r in retrieval.vector_topk(base, asked, 3).orderBy("rank").collect()] == [("d", 1.0), ("a", 5.0)]
    longer = base.union(spark.createDataFrame([("e", [1.0])], base.schema))
    with pytest.raises(Exception, match="differ in length"):
        retrieval.vector_topk(longer, asked, 3).collect()


def test_deals_without_chunks_and_failed_calls(spark, tmp_path):
    chunks = spark.createDataFrame([(1, "u", "c1", "some text")], "deal_id bigint, uri string, id string, content string")
    vectors, pending = generation.hash_embedding(chunks), spark.createDataFrame([(1,), (2,)], "deal_id bigint")
    found = engagement_details.extract_details(vectors, pending, lambda: lambda prompts, options: ['{"Background": "b"}'] * len(prompts))
    assert sorted((r.deal_id, r.background) for r in found.collect()) == [(1, "b"), (2, None)]

    def failing():
        def answer(prompts, options):
            raise RuntimeError("down")
        return answer

    failed = engagement_details.extract_and_append(vectors, pending, failing, str(tmp_path / "details"))
    assert {r.deal_id for r in failed.collect()} == {1} and failed.count() == 3
    assert [r.deal_id for r in spark.read.parquet(str(tmp_path / "details")).collect()] == [2]


def test_repeated_keys_below_the_top_cost_nothing(spark):
    text = (
        '{"overall_status":"RED","month_timeline":[{"event_date":"b","event_date":"x","event_description":"one"},'
        '{"event_date":"a","event_description":["nested"]},{"event_description":"[two]","event_description":2}]}'
    )
    row = reporting.parse_status(spark.createDataFrame([(1, text)], "id int, answer string"), "answer", ["id"]).first()
    assert [tuple(e) for e in row.month_timeline_events] == [(None, "[two]"), ("a", None), ("b", "one")]
    listed = '[{"objective_number":1,"objective_number":2,"objective_details":"{x} y"},{"objective_number":"3","objective_details":{"a":1}}]'
    rows = spark.createDataFrame([(1, listed, '{"Background":"[b]","Background":"c","Solution":{"s":1}}', None)], "deal_id int, objectives string, summary string, deliverables string")
    found = details.parse_details(rows).first()
    assert [(o.objective_number, o.objective_details) for o in found.objectives] == [("1", "{x} y"), ("3", None)]
    assert (found.background, found.solution, found.deliverables) == ("[b]", None, [])


def test_a_chunk_that_repeats_a_key_keeps_its_content(spark):
    result = '{"chunkedDocument":{"chunks":[{"chunkId":"c1","content":"[1] text","content":"x","pageSpan":{"pageStart":1,"pageEnd":2}},{"chunkId":"c2","content":"plain"}]}}'
    rows = spark.createDataFrame([(1, result)], "deal int, ml_process_document_result string")
    found = documents.parse_chunks(rows, ["deal"]).orderBy("id").collect()
    assert [(r.id, r.content, r.page_span_end) for r in found] == [("c1", "[1] text", "2"), ("c2", "plain", None)]


def test_a_text_that_begins_with_a_bracket_is_kept(spark):
    answers = ['{"overall_status":"RED","overall_status":"x","overall_rationale":"[late] vendor"}', '{"overall_status":"RED","overall_status":"x","overall_rationale":["late"]}',
               '{"overall_status":"RED","overall_status":"x","overall_rationale":"{late"}', '{"overall_status":"RED","overall_status":"x","overall_rationale":{"a":1}}']
    rows = spark.createDataFrame(list(enumerate(answers)), "id int, answer string")
    found = {r.id: r.overall_rag_status_reason for r in reporting.parse_status(rows, "answer", ["id"]).collect()}
    assert found == {0: "[late] vendor", 1: None, 2: "{late", 3: None}


def test_a_failed_embedding_says_why(spark):
    def refusing():
        def embed(contents):
            raise RuntimeError("refused")
        return embed

    df = spark.createDataFrame([("a",), (None,)], "content string")
    found = {r.content: r for r in generation.generate_embedding(df, refusing, retries=0, wait=0.0).collect()}
    assert found["a"][generation.EMBEDDING] is None and "refused" in found["a"][generation.STATUS] and found[None][generation.STATUS] == "no input"

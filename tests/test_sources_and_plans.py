"""Files and table writes, and the shape of the physical plans."""

import datetime as dt

from pyspark.sql import functions as F

import checks.registry as registry
from checks import replies
from checks.views import AS_OF, SINCE, Views
from statuslight.operators import joins, retrieval
from statuslight.plans import status_report
from statuslight.session import written
from statuslight.sources import files, tables
from tests.conftest import SF_DIR


def test_discovery(spark, tmp_path):
    for name in ("1.pdf", "2.v2.pdf", "3.txt", "sub/4.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    found = files.discover_files(spark, str(tmp_path))
    assert sorted((r.id, r.name, r.length) for r in found.collect()) == [("1", "1.pdf", 5), ("2.v2", "2.v2.pdf", 8), ("4", "4.pdf", 9)]
    assert "content" not in found.columns
    assert files.discover_files(spark, str(tmp_path), content=True).where("id = '1'").first().content == b"xxxxx"
    known = spark.createDataFrame([("1",)], "id string")
    assert sorted(r.id for r in files.incremental_discovery(found, known).collect()) == ["2.v2", "4"]


def test_replace_partitions_leaves_others(spark, tmp_path):
    path = str(tmp_path / "chunks")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "deal_id bigint, content string")
    tables.replace_partitions(df, path)
    tables.replace_partitions(spark.createDataFrame([(1, "z"), (3, "y")], df.schema), path)
    back = spark.read.parquet(path)
    assert sorted((r.deal_id, r.content) for r in back.collect()) == [(1, "z"), (2, "c"), (3, "y")]
    pruned = back.where("deal_id = 2")
    assert "PartitionFilters: [isnotnull(deal_id" in pruned._jdf.queryExecution().toString()


def test_append_and_replicate(spark, tmp_path):
    table, staging, copy = (str(tmp_path / n) for n in ("t", "s", "c"))
    df = spark.createDataFrame([(1, [("x",)])], "id bigint, list array<struct<a:string>>")
    tables.append(df, table, ["id", "list"])
    tables.append(df.select("list", "id"), table, ["id", "list"])
    for _ in range(2):
        tables.replicate_table(spark, table, staging, copy, fmt="orc")
    assert spark.read.parquet(copy).collect() == spark.read.parquet(table).collect()
    assert spark.read.parquet(copy).count() == 2


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_evidence_plans_have_no_product_and_no_single_partition(spark):
    status = Views(spark, SF_DIR).status()
    for kind in ("messages", "docs", "meetings", "comments", "tasks"):
        text = physical(status.bundle(kind))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, kind
        assert "SinglePartition" not in text, kind
    text = physical(status.grains())
    assert "Expand" in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_shuffle_gathers_all_bundles(spark):
    status = Views(spark, SF_DIR).status()
    text = physical(status.evidence())
    assert text.count("partial_listagg") == len({"x"}) * 6
    assert text.count("Exchange hashpartitioning(company_name") <= 2 + text.count("meeting_start_time")


def test_lower_bound_and_columns_reach_the_scan(spark):
    text = plan(Views(spark, SF_DIR).status().engagements())
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00" in text
    assert "o_totalprice" not in text.split("== Physical Plan ==")[1]


def test_rejecting_filter_makes_the_join_inner(spark):
    text = plan(registry.QUERIES["left_to_inner"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "LeftOuter" not in text and "Inner" in text


def test_search_keeps_the_best_k_before_the_shuffle(spark):
    v = Views(spark, SF_DIR)
    text = physical(retrieval.vector_topk(v.vectors(), v.centroids(), within=["deal_id"]))
    assert text.count("WindowGroupLimit") == 2 and "NestedLoop" not in text and "Cartesian" not in text


def test_unused_epic_window_is_pruned(spark):
    from statuslight.operators import evidence

    v = Views(spark, SF_DIR)
    assert "Window" not in physical(evidence.task_epics(v.tasks()).select("task_name"))


def test_report_in_parts_keeps_every_row(spark):
    v = Views(spark, SF_DIR)
    whole, parts = (v.status(part_items=n).prompts() for n in (10_000, 2))
    keys = ["deal_name", "engagement_month"]
    assert whole.groupBy(*keys).count().where("count > 1").count() == 0
    assert parts.select(*keys).distinct().count() == whole.count()
    spread = parts.groupBy(*keys).agg(F.max("prompt_part").alias("last"), F.count("*").alias("n"))
    assert spread.where("last > 0").count() > 0 and spread.where("n > last + 1").count() == 0


def test_fixed_dates():
    assert (AS_OF, SINCE) == (dt.date(2001, 3, 15), dt.datetime(2000, 1, 1))


def test_evidence_is_gathered_for_the_months_of_prompts_alone(spark):
    from statuslight.operators import evidence, reporting

    status = Views(spark, SF_DIR).status()
    every = evidence.gather([status.items(kind) for kind in evidence.OUTPUTS])
    some = status.evidence()
    assert 0 < some.count() < every.count()
    columns = ["deal_name", *evidence.KEYS, "prompt_part", *evidence.OUTPUTS.values()]
    whole, pruned = (reporting.assemble_evidence(status.written_spine, e).select(*columns) for e in (every, some))
    assert pruned.exceptAll(whole).isEmpty() and whole.count() == pruned.count()


def test_a_sorted_report_reads_every_answer_once(spark):
    from statuslight.operators import reporting

    answers = spark.createDataFrame(
        [("c", "d", "e", "p", None, 0, '{"overall_status": "RED"}'), ("b", "d", "e", "p", None, 0, "none")],
        "company_name string, deal_name string, deal_description string, project_name string, engagement_month date, prompt_part bigint, answer string",
    )
    report = reporting.status_report(answers, "answer")
    assert "parseJson" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert [r.overall_rag_status for r in report.collect()] == ["RED"]


def test_partitions_of_order_lines_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100, raising=False)
    views = Views(spark, SF_DIR)
    parts = -(-views.table("lineitem").count() // 100)
    assert views.lines.rdd.getNumPartitions() >= parts
    assert registry.QUERIES["task_age"](spark, SF_DIR).rdd.getNumPartitions() >= parts


def test_prompts_are_not_written_for_a_backend(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(status_report, "written", lambda df, label="stage": (labels.append(label), written(df, label))[1])
    answers = Views(spark, SF_DIR).status().answers(replies.counting_backend)
    assert answers.count() > 0
    assert "answers" in labels and "prompts" not in labels


def test_answers_are_written_without_their_prompts(spark, monkeypatch):
    tables = {}
    monkeypatch.setattr(status_report, "written", lambda df, label="stage": tables.setdefault(label, written(df, label)))
    status = Views(spark, SF_DIR).status()
    answers = status.answers(replies.counting_backend)
    assert answers.count() == status.prompts().count() > 0
    assert "prompt" not in tables["answers"].columns

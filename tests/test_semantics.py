"""Small cases for the rules that are easy to get wrong."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from statuslight.functions.calendar import months_between_dates, whole_days
from statuslight.functions.json_text import json_array, json_query, json_record, json_value, parsed, strip_fences
from statuslight.functions.numbers import percent_text, pounds_text, ratio, safe_bigint
from statuslight.operators import details, documents, evidence, joins, reporting, spine

AS_OF = dt.date(2001, 3, 15)
NTZ = "timestamp_ntz"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def engaged(spark, start, end):
    values = [(1, "A", "d", "x", "P", start, end, "b", "r", "s", "o", "l")]
    return spark.createDataFrame(
        values,
        "company_pk bigint, company_name string, deal_name string, deal_description string, project_name string,"
        f" engagement_start_ts {NTZ}, engagement_end_ts {NTZ}, background string, requirements string,"
        " solution string, objectives_json string, deliverables_json string",
    )


@pytest.mark.parametrize("start, end, months", [
    ((2001, 1, 31), (2001, 2, 1), ["2001-01-01", "2001-02-01"]),
    ((2001, 1, 5), (2009, 1, 1), ["2001-01-01", "2001-02-01", "2001-03-01"]),
    ((2001, 3, 20), (2001, 3, 31), ["2001-03-01"]),
    ((2001, 1, 5), None, [None]),
    ((2001, 5, 5), (2001, 6, 1), [None]),
    ((2001, 2, 5), (2001, 1, 1), [None]),
])
def test_spine_months(spark, start, end, months):
    rows = spine.month_spine(engaged(spark, dt.datetime(*start), dt.datetime(*end) if end else None), AS_OF).collect()
    assert sorted(str(r.engagement_month) if r.engagement_month else None for r in rows) == months if months != [None] else (
        [r.engagement_month for r in rows] == [None]
    )


def test_inverted_range_is_null_not_an_error(spark):
    assert one(spark, months_between_dates(F.lit(dt.date(2001, 2, 1)), F.lit(dt.date(2001, 1, 1)))) is None


def test_days_are_whole_24_hour_periods(spark):
    late, early = F.lit(dt.datetime(2001, 1, 2, 1)).cast(NTZ), F.lit(dt.datetime(2001, 1, 1, 23)).cast(NTZ)
    assert one(spark, whole_days(early, late)) == 0


def test_project_names_of_equal_engagements_and_details(spark):
    source = spark.createDataFrame(
        [(1, "d", 7, "x", [("P2",), ("P1",)], dt.datetime(2001, 1, 1), None)] * 2
        + [(2, "e", 8, "y", [], dt.datetime(2001, 1, 1), None), (2, "f", 9, "y", None, dt.datetime(1999, 1, 1), None)],
        "company_fk bigint, deal_name string, deal_id bigint, deal_description string,"
        f" projects array<struct<project_name:string>>, engagement_start_ts {NTZ}, engagement_end_ts {NTZ}",
    )
    companies = spark.createDataFrame([(1, "A")], "company_pk bigint, company_name string")
    found = spark.createDataFrame(
        [(7, "b", "r", "s", "o", "l")] * 2,
        "deal_id bigint, background string, requirements string, solution string, objectives_json string, deliverables_json string",
    )
    rows = spine.engagements(source, companies, found, dt.datetime(2000, 1, 1)).orderBy("deal_id").collect()
    assert [(r.company_name, r.project_name, r.background) for r in rows] == [
        ("A", "P1,P1,P1,P1,P2,P2,P2,P2", "b"), (None, None, None),
    ]


@pytest.mark.parametrize("dedupe", [False, True])
def test_months_from_tables_equal_months_of_the_spine(spark, dedupe):
    starts = [dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 9)]
    source = spark.createDataFrame(
        [(c, f"d{c}{i}", 7 + i, "x", [("P",), ("Q",)], start, end) for c in (1, 2, 9) for i, start in enumerate(starts)
         for end in (dt.datetime(2001, 2, 20), None)] * 2,
        "company_fk bigint, deal_name string, deal_id bigint, deal_description string,"
        f" projects array<struct<project_name:string>>, engagement_start_ts {NTZ}, engagement_end_ts {NTZ}",
    )
    companies = spark.createDataFrame([(1, "A"), (2, None)], "company_pk bigint, company_name string")
    found = spark.createDataFrame(
        [(7, "b", "r", "s", "o", "l")] * 2 + [(7, None, "r", "s", "o", "l"), (None, "b", "r", "s", "o", "l")],
        "deal_id bigint, background string, requirements string, solution string, objectives_json string, deliverables_json string",
    )
    since = dt.datetime(2000, 1, 1)
    rows = spine.month_spine(spine.engagements(source, companies, found, since), AS_OF)
    want = spine.spine_months(rows, companies, dedupe).collect()
    got = spine.months_of_engagements(source, companies, found, since, AS_OF, dedupe).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 4


def test_evidence_of_unknown_companies_is_left_out(spark):
    rows = spine.month_spine(engaged(spark, dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1)), AS_OF)
    known = spark.createDataFrame([(2,)], "company_pk bigint")
    assert spine.spine_months(rows, known).count() == 0


@pytest.mark.parametrize("start, completed, months", [
    ((2001, 1, 15), (2001, 1, 20), ["2001-01-01"]),
    ((2001, 2, 1), (2001, 2, 3), ["2001-01-01", "2001-02-01"]),
    ((2001, 1, 31, 23), None, ["2001-01-01", "2001-02-01", "2001-03-01"]),
    ((2001, 4, 1), None, ["2001-03-01"]),
    ((2000, 1, 1), (2001, 1, 1), ["2001-01-01"]),
    ((2000, 1, 1), (2000, 12, 31), []),
    ((2001, 3, 5), (2001, 1, 5), []),
])
def test_task_months(spark, start, completed, months):
    tasks = spark.createDataFrame(
        [(5, dt.datetime(*start), dt.datetime(*completed) if completed else None, "Done", True)]
        + [(5, dt.datetime(2001, 1, 1), None, status, latest) for status, latest in (("To Do", True), ("Done", False), (None, True), ("Done", None))],
        f"delivery_project_fk bigint, task_start_ts {NTZ}, task_completed_ts {NTZ}, task_status string, is_latest_task_version boolean",
    )
    projects = spark.createDataFrame([(5, 1)], "delivery_project_pk bigint, company_fk bigint")
    spine_rows = [(1, "A", dt.date(2001, m, 1), 1) for m in (1, 2, 3)]
    months_df = spark.createDataFrame(spine_rows, "company_pk bigint, company_name string, engagement_month date, copies bigint")
    got = evidence.tasks_by_month(tasks, projects, months_df).collect()
    assert sorted(str(r.engagement_month) for r in got) == months


def test_epics_by_join_equal_the_window(spark):
    tasks = spark.range(60).select(
        (F.col("id") % 2).alias("delivery_project_fk"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("string").alias("epic_name"),
        (F.lit(dt.datetime(2001, 1, 1)).cast(NTZ) + F.make_dt_interval(F.col("id").cast("int"))).alias("task_start_ts"),
        (F.lit(dt.datetime(2001, 2, 1)).cast(NTZ) + F.make_dt_interval(F.col("id").cast("int"))).alias("task_end_ts"),
    )
    by_window, by_join = (evidence.task_epics(tasks, hot_rows=n) for n in (1000, 3))
    assert sorted(map(str, by_window.collect())) == sorted(map(str, by_join.select(*by_window.columns).collect()))


def test_task_age_is_null_for_done_and_unknown_status(spark):
    tasks = spark.createDataFrame(
        [("Done", dt.datetime(2001, 3, 1)), ("In Progress", dt.datetime(2001, 3, 1)), (None, dt.datetime(2001, 3, 1))],
        f"task_status string, task_start_ts {NTZ}",
    )
    assert [r[0] for r in tasks.select(evidence.days_open(AS_OF)).collect()] == [None, 14, None]


@pytest.mark.parametrize("category, score", [
    ("UNENGAGED", -1), (" CONCERNED ", -1), ("POSITIVE  ", 1), ("positive", 0), ("", 0), (None, 0),
])
def test_sentiment(spark, category, score):
    assert one(spark, evidence.sentiment_score(F.lit(category).cast("string"))) == score


def test_records_keep_nulls(spark):
    assert one(spark, json_record(a=F.lit(None).cast("string"), b=F.lit("x"))) == '{"a":null,"b":"x"}'


@pytest.mark.parametrize("path, value", [
    ("$.s", "x"), ("$.n", "1.5"), ("$.t", "true"), ("$.z", None), ("$.o", None), ("$.l", None), ("$.none", None),
    ("$.l[0].deep", "d"), ("$.o.k", "7"), ("$.brace", "{1}"),
])
def test_json_value(spark, path, value):
    text = '{"s":"x","n":1.50,"t":true,"z":null,"o":{"k":7},"l":[{"deep":"d"}],"brace":"{1}"}'
    assert one(spark, json_value(parsed(F.lit(text)), path)) == value


@pytest.mark.parametrize("text", ["not json", '{"a": 1', "", None])
def test_malformed_json_is_null(spark, text):
    assert one(spark, json_value(parsed(F.lit(text).cast("string")), "$.a")) is None


@pytest.mark.parametrize("text, size", [('[1, {"a": 2}]', 2), ("[]", 0), ('{"a": 1}', None), ('"[1]"', None), ("x", None)])
def test_json_array(spark, text, size):
    items = json_array(parsed(F.lit(text)))
    assert one(spark, F.when(items.isNotNull(), F.size(items))) == size


@pytest.mark.parametrize("path, text", [("$.o", '{"b":1,"a":2}'), ("$.l", "[1,2]"), ("$.s", '"x"'), ("$.none", None)])
def test_json_query(spark, path, text):
    assert one(spark, json_query(F.lit('{"o": {"b":1,"a":2}, "l": [1,2], "s": "x"}'), path)) == text


def test_fences(spark):
    text = F.lit("```json\n{}\n```")
    assert one(spark, strip_fences(text)) == "{}"
    assert one(spark, strip_fences(text, newlines=False)) == "\n{}\n"


@pytest.mark.parametrize("text, value", [("12", 12), ("x", None), ("99999999999999999999", None), ("12_result", None)])
def test_safe_bigint(spark, text, value):
    assert one(spark, safe_bigint(F.lit(text))) == value


def test_number_texts(spark):
    assert one(spark, percent_text(F.lit(2.5))) == "3%"
    assert one(spark, percent_text(F.lit(-2.5))) == "-3%"
    assert one(spark, pounds_text(F.lit(1234567891.2))) == "£1234567891"
    assert one(spark, percent_text(ratio(F.lit(1), F.lit(0)))) is None


def test_numeric_names(spark):
    names = spark.createDataFrame([("12",), ("12_result",), ("x1",), ("99999999999999999999",)], "name string")
    assert [tuple(r) for r in documents.numeric_ids(names).orderBy("name").collect()] == [("12", 12), ("99999999999999999999", None)]


@pytest.mark.parametrize("existing, pending", [([1], [2, 3]), ([1, None], []), ([], [1, 2, 3])])
def test_pending_follows_not_in(spark, existing, pending):
    names = spark.createDataFrame([("1",), ("2",), ("3",), ("x",), ("2_result",)], "name string")
    known = spark.createDataFrame([(i,) for i in existing], "deal_id bigint")
    assert sorted(r.deal_id for r in documents.pending_deals(names, known).collect()) == pending


def answers(spark, *texts):
    return spark.createDataFrame(
        [("A", f"d{i}", "x", "P", dt.date(2001, 1, 1), 0, t) for i, t in enumerate(texts)],
        "company_name string, deal_name string, deal_description string, project_name string, engagement_month date,"
        " prompt_part bigint, answer string",
    )


def test_report_drops_answers_without_overall_status(spark):
    good = json.dumps({"overall_status": "RED", "month_timeline": "[]"})
    report = reporting.status_report(answers(spark, "x", good, '{"overall_status": {"a": 1}}', None), "answer")
    assert [(r.engagement_name, r.overall_rag_status, r.month_timeline_events) for r in report.collect()] == [("d1", "RED", [])]


@pytest.mark.parametrize("lenient, events", [(False, []), (True, [(None, "u"), ("1", "a"), ("2", "b")])])
def test_quoted_timeline(spark, lenient, events):
    inner = [{"event_date": "2", "event_description": "b"}, {"event_description": "u"}, {"event_date": "1", "event_description": "a"}]
    text = "```json\n" + json.dumps({"overall_status": "RED", "month_timeline": json.dumps(inner)}) + "\n```"
    row = reporting.status_report(answers(spark, text), "answer", lenient).first()
    assert [tuple(e) for e in row.month_timeline_events] == events


def test_prompt_needs_a_name_and_nothing_else(spark):
    columns = {c for _, c in reporting.SECTIONS} | {"company_name"}
    blank = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in columns])
    named = blank.withColumn("company_name", F.lit("A"))
    assert blank.select(reporting.prompt_text()).first()[0] is None
    assert named.select(reporting.prompt_text()).first()[0].startswith(reporting.INSTRUCTION + "A; engagement: ; description")


def test_details_of_partial_answers(spark):
    rows = [(1, "objectives", "[]"), (1, "summary", '```json{"Background": "b"}```'), (2, "summary", "{}"), (3, "objectives", None)]
    df = spark.createDataFrame(rows, "deal_id bigint, question string, answer string")
    got = details.parse_details(details.combine_extractions(df, "answer")).orderBy("deal_id").collect()
    assert [(r.deal_id, r.background, r.objectives, r.deliverables, r.objectives_json) for r in got] == [
        (1, "b", [], [], "[]"), (3, None, [], [], None),
    ]


def test_partitions_of_epics_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100, raising=False)
    at = dt.datetime(2000, 1, 1)
    tasks = spark.createDataFrame(
        [(i // 3 if i % 7 else None, None if i % 5 == 0 else f"E{i % 2}", at + dt.timedelta(days=i), at + dt.timedelta(days=2 * i)) for i in range(4000)],
        "delivery_project_fk bigint, epic_name string, task_start_ts timestamp_ntz, task_end_ts timestamp_ntz",
    )
    found = evidence.task_epics(tasks)
    assert found.count() == 4000 and found.rdd.getNumPartitions() >= 40
    assert evidence.task_epics(tasks.limit(0)).count() == 0

"""One report row per engagement and month, out of the answers to any number of prompts."""

import datetime as dt
import json

from pyspark.sql import functions as F

from checks.views import Views
from statuslight.operators import reporting, rules
from statuslight.operators.generation import RESULT
from statuslight.plans import status_report
from statuslight.session import written
from tests.conftest import SF_DIR, rows

NAMES = list(reporting.STATUS_FIELDS)
MONTH = dt.date(2001, 1, 1)


def answer(status, reason, events=(), **more):
    fields = {n: None for n in NAMES} | {"overall_status": status, "overall_rationale": reason} | more
    return json.dumps(fields | {reporting.TIMELINE: [{"event_date": d, "event_description": e} for d, e in events]})


def answers(spark, listed):
    schema = "company_name string, deal_name string, deal_description string, project_name string, engagement_month date, prompt_part bigint, answer string"
    return spark.createDataFrame([("c", deal, None, "p", MONTH, part, text) for deal, part, text in listed], schema)


def by_deal(df):
    return {r.engagement_name: r for r in df.collect()}


def test_worst_status_reasons_in_part_order_and_joined_timeline(spark):
    listed = [
        ("a", 2, answer("RED", "late", [("2001-01-03", "x")])), ("a", 0, answer("GREEN", "fine", [("2001-01-05", "y"), ("2001-01-03", "x")])),
        ("a", 1, answer("RED", "over budget", [(None, "undated")])), ("a", 3, answer("RED", "late")),
        ("b", 0, answer("AMBER", "slow", scope_status="odd", scope_rationale="?")), ("b", 1, "no JSON at all"),
        ("c", 0, answer(None, "silent")), ("c", 1, answer("purple", "other")), ("d", 0, "broken"), ("d", 1, answer(None, None)),
    ]
    found = by_deal(reporting.merged_report(answers(spark, listed), "answer", last_part=3))
    assert set(found) == {"a", "b", "c"}
    a = found["a"]
    assert (a.overall_rag_status, a.overall_rag_status_reason, a.parts) == ("RED", "over budget late", 4)
    assert [(e.event_date, e.event_description) for e in a.month_timeline_events] == [(None, "undated"), ("2001-01-03", "x"), ("2001-01-05", "y")]
    assert (found["b"].overall_rag_status, found["b"].scope_status, found["b"].scope_status_rationale, found["b"].parts) == ("AMBER", "odd", "?", 2)
    assert (found["c"].overall_rag_status, found["c"].overall_rag_status_reason) == ("purple", "other")


def test_merging_in_rounds_gives_the_same(spark):
    colours = ["RED", "AMBER", "GREEN", None]
    listed = [
        (deal, part, answer(colours[(part * 7 + n) % 4], f"reason {part % 5}", [(f"2001-01-{part % 28 + 1:02}", f"e{part % 9}")]))
        for n, (deal, parts) in enumerate([("a", 40), ("b", 1), ("c", 9)]) for part in range(parts)
    ]
    df = answers(spark, listed)
    flat = reporting.merged_report(df, "answer", last_part=39, fan_in=1000)
    tree = reporting.merged_report(df, "answer", last_part=39, fan_in=2)
    assert rows(flat) == rows(tree) and flat.count() == 3
    assert by_deal(flat)["a"].parts == 40


def test_equal_rows_keep_their_number(spark):
    listed = [("a", part, answer("RED", f"r{part}")) for part in range(3) for _ in range(2)]
    found = reporting.merged_report(answers(spark, listed), "answer", last_part=2).collect()
    assert [(r.overall_rag_status_reason, r.parts) for r in found] == [("r0 r1 r2", 3)] * 2


def test_rules_read_the_evidence(spark):
    task = [{"task_status": "Done", "task_days_open": None}, {"task_status": "In Progress", "task_days_open": 75}]
    money = [{"project_sprints_margin_pct": "69%", "project_sprints_hours_vs_budget_pct": None, "project_sprints_hourly_rate": "£150"}]
    comments = [{"customer_meetings_contribution_sentiment_category": c} for c in ("POSITIVE", "CONCERNED", None, "x", "y")]
    meeting = [{"meeting_start_time": "2001-01-09 10:00:00", "meeting_title": "review"}] * 2
    schema = "id int, all_project_financial_metrics string, all_tasks string, all_docs_published string, meeting_summaries string, meeting_comments string"
    df = spark.createDataFrame([
        (1, json.dumps(money), json.dumps(task), None, json.dumps(meeting), json.dumps(comments)),
        (2, None, None, '[{"document":"d"}]', None, None), (3, None, None, None, None, None),
    ], schema)
    found = {r.id: json.loads(r[RESULT]) for r in rules.rule_answers(df).collect()}
    one = found[1]
    assert (one["financials_status"], one["financials_rationale"]) == ("RED", "margin 69%, hours unknown, rate £150")
    assert (one["schedule_status"], one["schedule_rationale"]) == ("AMBER", "1 of 2 tasks open, the oldest for 75 days")
    assert (one["resourcing_status"], one["resourcing_rationale"]) == ("GREEN", "1 of 5 comments worried")
    assert (one["overall_status"], one["overall_rationale"], one["scope_status"]) == ("RED", one["financials_rationale"], None)
    assert one[reporting.TIMELINE] == [{"event_date": "2001-01-09", "event_description": "review"}]
    assert (found[2]["overall_status"], found[2]["overall_rationale"]) == ("GREEN", "1 documents published")
    assert (found[3]["overall_status"], found[3]["overall_rationale"]) == ("GREEN", "no evidence")


def test_small_parts_give_as_many_rows_as_whole_evidence(spark):
    views = Views(spark, SF_DIR)
    whole, parted = views.status().report(), views.status(part_items=2).report()
    keys = reporting.REPORT_KEYS
    assert rows(whole.select(*keys)) == rows(parted.select(*keys))
    assert parted.agg(F.max("parts")).first()[0] > 2 and whole.agg(F.max("parts")).first()[0] == 1
    events = [F.to_json("month_timeline_events").alias("events")]
    assert rows(whole.select(*keys, *events)) == rows(parted.select(*keys, *events))


def test_rules_answer_the_evidence_of_a_month_once_for_all_its_engagements(spark, monkeypatch):
    """Engagements of one name and month, equal ones, ones without a name or month: the rows of answers to every prompt, out of fewer answers."""
    tables = {}
    monkeypatch.setattr(status_report, "written", lambda df, label="stage": tables.setdefault(label, written(df, label)))
    status = Views(spark, SF_DIR).status(part_items=2)
    one = status.written_spine.where(F.col("background").isNotNull() & F.col("engagement_month").isNotNull())
    more = [one.withColumn("deal_name", F.concat(F.lit(name), "deal_name")) for name in ("second ", "third ")]
    unnamed = [one.limit(3).withColumn(c, F.lit(None).cast(one.schema[c].dataType)) for c in ("company_name", "engagement_month")]
    for other in (one, *more, *unnamed):
        status.written_spine = status.written_spine.unionByName(other)
    status.written_spine = written(status.written_spine, "spine")
    found = status.report()
    n_answers = tables.pop("answers").count()
    every = status.answers()
    last = every.agg(F.max("prompt_part")).first()[0]
    plain = [c if c != "month_timeline_events" else F.to_json(c).alias(c) for c in found.columns]
    assert rows(found.select(*plain)) == rows(reporting.merged_report(every, RESULT, last).select(*plain))
    assert last > 0 and 0 < n_answers * 3 < every.count()

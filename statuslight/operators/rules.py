"""Answers to report prompts by fixed rules over the evidence, without a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuslight.functions.json_text import json_record
from statuslight.operators.evidence import OUTPUTS
from statuslight.operators.financials import target_statuses
from statuslight.operators.generation import RESULT, STATUS
from statuslight.operators.reporting import EVENT_FIELDS, STATUS_FIELDS, TIMELINE, worst_status

#: days that an open task may be old, and shares of worried comments, before a status is AMBER or RED
AMBER_DAYS, RED_DAYS = 60, 180
AMBER_SHARE, RED_SHARE = 0.25, 0.5
WORRIED = ["UNENGAGED", "CONCERNED"]


def _items(kind: str, fields: str) -> Column:
    return F.from_json(F.col(OUTPUTS[kind]), f"array<struct<{fields}>>")


def _figure(text: Column) -> Column:
    """The number in a percent or pound text."""
    return F.regexp_replace(text, "[%£]", "").try_cast("double")


def _above(value: Column, amber: float, red: float) -> Column:
    return F.when(value >= red, "RED").when(value >= amber, "AMBER").otherwise("GREEN")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def judged(rows: DataFrame) -> DataFrame:
    """Evidence rows with a status and a reason per field that the rules cover; NULL where a row has no such evidence.

    Financials by the report's targets, schedule by the age of the oldest open task,
    resourcing by the share of worried comments, scope by whether documents were published.
    """
    money = "project_sprints_margin_pct:string, project_sprints_hours_vs_budget_pct:string, project_sprints_hourly_rate:string"
    read = rows.withColumns({
        "__money": F.get(_items("financials", money), 0),
        "__tasks": _items("tasks", "task_status:string, task_days_open:bigint"),
        "__comments": _items("comments", "customer_meetings_contribution_sentiment_category:string"),
        "__docs": _items("docs", "document:string"),
        "__meetings": _items("meetings", "meeting_start_time:string, meeting_title:string"),
    })
    margin, hours, rate = (F.col(f"__money.{f.split(':')[0]}") for f in money.split(", "))
    unknown = F.lit("unknown")
    tasks, comments, docs = F.col("__tasks"), F.col("__comments"), F.col("__docs")
    n_open = F.size(F.filter(tasks, lambda t: t["task_status"] != "Done"))
    oldest = F.array_max(F.transform(tasks, lambda t: t["task_days_open"]))
    worried = F.size(F.filter(comments, lambda c: c["customer_meetings_contribution_sentiment_category"].isin(WORRIED)))
    found = {
        "financials_status": F.when(F.col("__money").isNotNull(), worst_status(F.array(*target_statuses(*map(_figure, (margin, hours, rate)))))),
        "financials_rationale": _text(
            "margin ", F.coalesce(margin, unknown), ", hours ", F.coalesce(hours, unknown), ", rate ", F.coalesce(rate, unknown)
        ),
        "schedule_status": _above(F.coalesce(oldest, F.lit(0)), AMBER_DAYS, RED_DAYS),
        "schedule_rationale": _text(
            n_open, " of ", F.size(tasks), " tasks open", F.coalesce(_text(", the oldest for ", oldest, " days"), F.lit(""))
        ),
        "scope_status": F.lit("GREEN"),
        "scope_rationale": _text(F.size(docs), " documents published"),
        "resourcing_status": _above(worried / F.size(comments), AMBER_SHARE, RED_SHARE),
        "resourcing_rationale": _text(worried, " of ", F.size(comments), " comments worried"),
    }
    present = {"financials": F.col("__money").isNotNull(), "schedule": tasks.isNotNull(), "scope": docs.isNotNull(), "resourcing": comments.isNotNull()}
    judgements = {name: F.when(present[name.split("_")[0]], value) for name, value in found.items()}
    return read.withColumns({f"__{name}": value for name, value in judgements.items()})


def rule_answers(rows: DataFrame) -> DataFrame:
    """The rows with an answer and an empty status, as ``generate_text`` gives them.

    The answer is the JSON object that the instruction asks for. The overall status is the
    worst of the others, backed by their reasons; without any evidence it is GREEN. The
    timeline holds the meetings. Technology and data quality are left NULL.
    """
    areas = ["financials", "schedule", "scope", "resourcing"]
    read = judged(rows)
    overall = F.coalesce(worst_status(F.array(*[F.col(f"__{a}_status") for a in areas])), F.lit("GREEN"))
    read = read.withColumn("__overall_status", overall)
    reasons = F.concat_ws("; ", *[F.when(F.col(f"__{a}_status") == F.col("__overall_status"), F.col(f"__{a}_rationale")) for a in areas])
    read = read.withColumn("__overall_rationale", F.when(reasons != "", reasons).otherwise("no evidence"))
    known = ["overall", *areas]
    fields = {
        key: F.col(f"__{key}") if key.rsplit("_", 1)[0] in known else F.lit(None).cast("string") for key in STATUS_FIELDS
    }
    date, description = EVENT_FIELDS
    events = F.transform("__meetings", lambda m: F.struct(F.substring(m["meeting_start_time"], 1, 10).alias(date), m["meeting_title"].alias(description)))
    empty = F.array().cast(f"array<struct<{date}:string,{description}:string>>")
    answer = json_record(**fields, **{TIMELINE: F.array_sort(F.array_distinct(F.coalesce(events, empty)))})
    return read.withColumns({RESULT: answer, STATUS: F.lit("")}).select(*rows.columns, RESULT, STATUS)

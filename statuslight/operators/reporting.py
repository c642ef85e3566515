"""Prompts from the spine and its evidence, and reports from the model's answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuslight.functions.json_text import answer_records, answer_value, json_value, parsed, strip_fences
from statuslight.operators.evidence import KEYS
from statuslight.operators.joins import lookup_join, salted_join
from statuslight.session import written

#: parts of a month that are merged at once
FAN_IN = 64

# fixed values: answer fields and the report columns they become
STATUS_FIELDS = {
    "overall_status": "overall_rag_status",
    "overall_rationale": "overall_rag_status_reason",
    "financials_status": "financials_status",
    "financials_rationale": "financials_status_rationale",
    "schedule_status": "schedule_status",
    "schedule_rationale": "schedule_status_rationale",
    "scope_status": "scope_status",
    "scope_rationale": "scope_status_rationale",
    "technology_status": "technology_status",
    "technology_rationale": "technology_rationale",
    "resourcing_status": "resourcing_status",
    "resourcing_rationale": "resourcing_rationale",
    "data_quality_qa_status": "data_quality_qa_status",
    "data_quality_qa_rationale": "data_quality_qa_rationale",
}
TIMELINE = "month_timeline"
EVENT_FIELDS = ["event_date", "event_description"]

INSTRUCTION = (
    "You write the monthly status report of a consulting engagement. Judge the overall position, scope, "
    "financials, schedule, data quality and QA, technology and resourcing as RED, AMBER or GREEN and back each "
    "judgement with a short, specific reason that names its evidence. Weigh the background, requirements, "
    "objectives, deliverables and planned solution against the documents, meetings, messages and tasks below. "
    "For discovery, planning and design work judge what the delivery team answers for; for implementations "
    "also judge the client's technology, data quality, scope, staffing and schedule. Targets: a margin of 70% or "
    "more, hours within 100% of the budget, an hourly rate of at least £140 and ideally £180. Add a timeline of the "
    "month's significant activities and outputs in date order, without routine stand-ups and small talk. Answer with "
    "one JSON object with the fields "
    + ", ".join(STATUS_FIELDS)
    + f" and {TIMELINE}, the last an array of objects with {' and '.join(EVENT_FIELDS)}. The client is "
)
CLOSING = ". For a discovery engagement, say whether the cause of a RED or AMBER status keeps the team from delivering."

# what introduces each value of the prompt, in prompt order
SECTIONS = [
    ("; engagement: ", "deal_name"),
    ("; description: ", "deal_description"),
    ("; background: ", "background"),
    ("; requirements: ", "requirements"),
    ("; objectives: ", "objectives_json"),
    ("; planned solution: ", "solution"),
    ("; deliverables due: ", "deliverables_json"),
    ("; current sprints: ", "project_name"),
    ("; financial measures: ", "all_project_financial_metrics"),
    ("; tasks: ", "all_tasks"),
    ("; documents published: ", "all_docs_published"),
    ("; messages: ", "all_messages"),
    ("; meetings: ", "meeting_summaries"),
    ("; comments made in meetings: ", "meeting_comments"),
]
PROMPT_COLUMNS = ["company_name", "deal_name", "deal_description", "project_name", "engagement_month", "prompt_part"]


def assemble_evidence(spine: DataFrame, evidence: DataFrame) -> DataFrame:
    """Spine rows with a background, joined to the bundles of their company name and month.

    Evidence in several parts gives a row per part.
    """
    joined = salted_join(spine.where(F.col("background").isNotNull()), evidence, KEYS, how="left")
    return joined.withColumn("prompt_part", F.coalesce("part", F.lit(0).cast("bigint"))).drop("part")


def prompt_text(instruction: str = INSTRUCTION, closing: str = CLOSING) -> Column:
    """NULL for an unknown client; every other missing value is left blank."""
    pieces: list[Column] = [F.lit(instruction), F.col("company_name")]
    for label, column in SECTIONS:
        pieces += [F.lit(label), F.coalesce(F.col(column), F.lit(""))]
    return F.concat(*pieces, F.lit(closing))


def assemble_prompt(
    spine: DataFrame, evidence: DataFrame, instruction: str = INSTRUCTION, closing: str = CLOSING, keep: Sequence[str] = ()
) -> DataFrame:
    """The prompt of every row of ``assemble_evidence``; ``keep`` names further columns of the spine to return."""
    rows = assemble_evidence(spine, evidence)
    return rows.withColumn("prompt", prompt_text(instruction, closing)).select(*PROMPT_COLUMNS, *keep, "prompt")


def timeline_events(document: Column, lenient: bool = False, text: Column | None = None) -> Column:
    """The events ordered by date text, NULL dates first; empty when there is no array.

    ``lenient`` also accepts a string that holds an array. ``text`` is read where it has
    no ``document``, see ``answer_value``.
    """
    path = f"$.{TIMELINE}"
    held = F.to_json(document) if text is None else text
    fields = answer_records(document, held, path, EVENT_FIELDS)
    if lenient:
        quoted = json_value(document, path) if text is None else answer_value(document, text, path)
        fields = F.coalesce(fields, answer_records(parsed(quoted), quoted, "$", EVENT_FIELDS))
    return F.coalesce(F.array_sort(fields), F.array().cast("array<struct<event_date:string,event_description:string>>"))


def parse_status(answers: DataFrame, text_col: str, keep: list[str], lenient: bool = False) -> DataFrame:
    """``keep``, the 14 report fields and the timeline of every answer."""
    bare = answers.select(*keep, strip_fences(F.col(text_col)).alias("__text"))
    read = bare.withColumn("__document", parsed(F.col("__text")))
    document, text = F.col("__document"), F.col("__text")
    fields = [answer_value(document, text, f"$.{key}").alias(name) for key, name in STATUS_FIELDS.items()]
    return read.select(*keep, *fields, timeline_events(document, lenient, text).alias("month_timeline_events"))


def worst_status(statuses: Column) -> Column:
    """RED before AMBER before GREEN before any other; NULL when there is none."""
    ranked = F.transform(F.filter(statuses, lambda s: s.isNotNull()), lambda s: F.struct(status_rank(s).alias("rank"), s.alias("status")))
    return F.array_min(ranked)["status"]


def status_rank(status: Column) -> Column:
    return F.when(status == "RED", 1).when(status == "AMBER", 2).when(status == "GREEN", 3).when(status.isNotNull(), 4).otherwise(5)


# columns of the spine and what the report calls them
REPORT_NAMES = {
    "company_name": "client_name",
    "deal_name": "engagement_name",
    "deal_description": "engagement_description",
    "project_name": "sprint_name",
    "engagement_month": "reporting_month",
}
REPORT_KEYS = list(REPORT_NAMES.values())


def _report_rows(answers: DataFrame, text_col: str, lenient: bool) -> DataFrame:
    """One parsed row per answer, with the names of the report."""
    named = answers.select(*[F.col(c).alias(name) for c, name in REPORT_NAMES.items()], "prompt_part", text_col)
    return parse_status(named, text_col, [c for c in named.columns if c != text_col], lenient)


def status_report(answers: DataFrame, text_col: str, lenient: bool = False) -> DataFrame:
    """A row per answer with an overall status, sorted by client, engagement and month.

    What was read from the answers is written before it is sorted: a sort looks at its input
    twice, to find the bounds of its ranges and to deal out the rows, and a filter below it
    once more, and each would read every answer again.
    """
    report = written(_report_rows(answers, text_col, lenient), "report")
    return report.where(F.col("overall_rag_status").isNotNull()).orderBy(
        "client_name", "engagement_name", "reporting_month", "prompt_part"
    )


def merge_parts(report: DataFrame, last_part: int, fan_in: int = FAN_IN, keys: Sequence[str] = REPORT_KEYS) -> DataFrame:
    """One row per engagement and month, or other ``keys``, out of the rows of its parts; ``parts`` says how many there were.

    Of a field's statuses the worst counts (see ``worst_status``). Its reason is made of the
    reasons of the parts with that status, in part order, each once. Timelines are put
    together in date order, each event once. ``last_part`` is the largest part number.

    Up to ``fan_in`` neighbouring parts are merged per group and round, so that a month
    whose evidence fills very many parts is spread over as many groups. Rows that are
    equal in all ``keys`` keep their number.
    """
    fields = list(zip(list(STATUS_FIELDS.values())[::2], list(STATUS_FIELDS.values())[1::2], strict=True))
    reasons = {reason: F.filter(F.array(reason), lambda r: r.isNotNull()).alias(reason) for _, reason in fields}
    whole = report.select(
        *keys, F.col("prompt_part").alias("part"), F.lit(1).cast("bigint").alias("parts"),
        F.when(F.col("prompt_part") == 0, 1).otherwise(0).cast("bigint").alias("rows"),
        *[F.struct(status_rank(F.col(s)).alias("rank"), F.col(s).alias("status"), reasons[r]).alias(s) for s, r in fields],
        "month_timeline_events",
    )
    merge = True
    while merge:
        state = [*[s for s, _ in fields], "month_timeline_events"]
        grouped = whole.groupBy(*keys, F.floor(F.col("part") / fan_in).alias("part")).agg(
            F.sum("parts").alias("parts"), F.sum("rows").alias("rows"), F.array_sort(F.collect_list(F.struct("part", *state))).alias("__all")
        )
        merged = [_merged_field(F.col("__all"), s, r).alias(s) for s, r in fields]
        events = F.array_sort(F.array_distinct(F.flatten(F.transform("__all", lambda p: p["month_timeline_events"]))))
        whole = grouped.select(*keys, "part", "parts", "rows", *merged, events.alias("month_timeline_events"))
        merge, last_part = last_part >= fan_in, last_part // fan_in
    texts = []
    for s, r in fields:
        texts += [F.col(f"{s}.status").alias(s), F.when(F.size(f"{s}.{r}") > 0, F.array_join(f"{s}.{r}", " ")).alias(r)]
    copies = F.explode(F.array_repeat(F.lit(1), F.greatest("rows", F.lit(1)).cast("int")))
    rows = whole.withColumn("parts", F.floor(F.col("parts") / F.greatest("rows", F.lit(1)))).withColumn("__row", copies)
    return rows.select(*keys, "parts", *texts, "month_timeline_events")


def _merged_field(parts: Column, status: str, reason: str) -> Column:
    """The worst status of parts in order, and the reasons of those that have it."""
    worst = F.array_min(F.transform(parts, lambda p: F.struct(p[status]["rank"].alias("rank"), p[status]["status"].alias("status"))))
    same = F.filter(parts, lambda p: p[status]["rank"] == worst["rank"])
    reasons = F.array_distinct(F.flatten(F.transform(same, lambda p: p[status][reason])))
    return F.struct(worst["rank"].alias("rank"), worst["status"].alias("status"), reasons.alias(reason))


def merged_report(answers: DataFrame, text_col: str, last_part: int, lenient: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """The report: one row per engagement and month with an overall status, however many parts its evidence has."""
    merged = merge_parts(_report_rows(answers, text_col, lenient), last_part, fan_in)
    return merged.where(F.col("overall_rag_status").isNotNull()).orderBy("client_name", "engagement_name", "reporting_month")


def shared_report(engagements: DataFrame, answers: DataFrame, text_col: str, last_part: int, lenient: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """``merged_report`` for answers that hold for all ``engagements`` of a company name and month.

    ``answers``: the keys of the evidence, ``prompt_part`` and the answer. Parts are read and
    merged once per company name and month, not once per engagement, and what comes out goes to
    each engagement. Missing names and months are keys like others.
    """
    parsed_rows = parse_status(answers, text_col, [*KEYS, "prompt_part"], lenient)
    merged = merge_parts(parsed_rows, last_part, fan_in, KEYS).where(F.col("overall_rag_status").isNotNull())
    months = written(merged, "month-reports")
    rows = lookup_join(engagements.select(*REPORT_NAMES), months, KEYS, how="inner", null_safe=True)
    values = [c for c in months.columns if c not in KEYS]
    named = rows.select(*[F.col(c).alias(name) for c, name in REPORT_NAMES.items()], *values)
    return named.orderBy("client_name", "engagement_name", "reporting_month")

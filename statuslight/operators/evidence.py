"""Evidence of a company's month: messages, documents, meetings, comments and tasks.

Each ``*_items`` function turns one fact table into bundle items keyed by company
name and month. Month ranges are equi-joins: months are disjoint, so an event
belongs to exactly the month its timestamp truncates to.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuslight.functions.calendar import MICROS, as_of_time, month_of, seconds_text, whole_days
from statuslight.functions.json_text import json_record
from statuslight.operators.bundle import PART_ITEMS, bundle
from statuslight.operators.intervals import levels_for, point_nodes, range_nodes
from statuslight.operators.joins import HOT_ROWS, lookup_join, parts_for

KEYS = ["company_name", "engagement_month"]
OUTPUTS = {
    "messages": "all_messages",
    "docs": "all_docs_published",
    "meetings": "meeting_summaries",
    "comments": "meeting_comments",
    "tasks": "all_tasks",
    "financials": "all_project_financial_metrics",
}
ASCENDING = {"docs"}
ITEM_COLUMNS = [*KEYS, "kind", "sort_key", "item", "copies"]


def in_months(facts: DataFrame, ts: str, months: DataFrame) -> DataFrame:
    """Facts of the spine's months: company_fk and the month of ``ts`` have to match.

    Facts before the first month or after the last one match nothing and are left out
    before anything is shuffled.
    """
    first, last = months.agg(F.min("engagement_month"), F.max("engagement_month")).first()
    keyed = facts.withColumns({"company_pk": F.col("company_fk"), "engagement_month": month_of(F.col(ts))})
    keyed = keyed.where(F.col("engagement_month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return lookup_join(keyed, months, ["company_pk", "engagement_month"], how="inner")


def _items(rows: DataFrame, kind: str, sort_key: Column, item: Column) -> DataFrame:
    return rows.select(
        *KEYS, F.lit(kind).alias("kind"), sort_key.alias("sort_key"), item.alias("item"), "copies"
    )


def bundle_of(items: DataFrame, kind: str, part_items: int = PART_ITEMS) -> DataFrame:
    """The bundle of one kind: company_name, engagement_month, part, and its array."""
    return bundle(items, KEYS, {kind: OUTPUTS[kind]}, ASCENDING, part_items)


def messages_by_month(messages: DataFrame, contacts: DataFrame, months: DataFrame) -> DataFrame:
    named = lookup_join(
        in_months(messages, "message_ts", months),
        contacts.select(F.col("contact_pk").alias("contact_fk"), "contact_name"),
        ["contact_fk"],
    )
    return named.select(*KEYS, "message_ts", "contact_name", "channel_name", "message_text", "copies")


def message_items(messages: DataFrame, contacts: DataFrame, months: DataFrame) -> DataFrame:
    rows = messages_by_month(messages, contacts, months)
    at = seconds_text(F.col("message_ts"))
    item = json_record(
        messages_fact_message_time=at,
        message_contacts_contact_name=F.col("contact_name"),
        messages_fact_channel_name=F.col("channel_name"),
        messages_fact_message_text=F.col("message_text"),
    )
    return _items(rows, "messages", at, item)


def docs_by_month(docs: DataFrame, months: DataFrame) -> DataFrame:
    titled = docs.where(F.col("page_title").isNotNull() & F.col("page_summary").isNotNull())
    return in_months(titled, "page_created_at_ts", months).select(
        *KEYS, "page_title", "page_created_at_ts", "page_summary", "copies"
    )


def doc_items(docs: DataFrame, months: DataFrame) -> DataFrame:
    """One text per document. The record's only field is named ``document``."""
    rows = docs_by_month(docs, months)
    published = F.concat(seconds_text(F.col("page_created_at_ts")), F.lit("+00"))
    line = F.concat(
        F.lit('"'), "page_title", F.lit('" published on '), published, F.lit(" : "), "page_summary"
    )
    order = F.date_format("page_created_at_ts", MICROS)
    return _items(rows, "docs", order, json_record(document=line))


def sentiment_score(category: Column) -> Column:
    """-1 for unengaged or concerned, 1 for positive, 0 for everything else and NULL."""
    name = F.trim(category)
    return F.when(name.isin("UNENGAGED", "CONCERNED"), -1).when(name == "POSITIVE", 1).otherwise(0)


def meetings_by_month(contributions: DataFrame, months: DataFrame) -> DataFrame:
    return in_months(contributions, "meeting_start_ts", months)


def meeting_sentiment(contributions: DataFrame, months: DataFrame) -> DataFrame:
    """Average engagement level and sentiment score of every meeting of a company's month.

    Averages are sums over counts, both weighted with ``copies`` and combined before the shuffle.
    """
    level, copies = F.col("meeting_engagement_level"), F.col("copies")
    score = sentiment_score(F.col("contribution_sentiment_category"))
    summed = meetings_by_month(contributions, months).groupBy(
        *KEYS, seconds_text(F.col("meeting_start_ts")).alias("meeting_start_time"), "meeting_title", "meeting_summary"
    ).agg(
        F.sum(level * copies).alias("levels"),
        F.sum(F.when(level.isNotNull(), copies)).alias("level_rows"),
        F.sum(score * copies).alias("scores"),
        F.sum(copies).alias("score_rows"),
    )
    return summed.select(
        *KEYS, "meeting_start_time", "meeting_title", "meeting_summary",
        F.try_divide(F.col("levels").cast("double"), "level_rows").alias("avg_meeting_engagement_level"),
        F.try_divide(F.col("scores").cast("double"), "score_rows").alias("average_contribution_sentiment_score"),
    )


def meeting_items(contributions: DataFrame, months: DataFrame) -> DataFrame:
    rows = meeting_sentiment(contributions, months).withColumn("copies", F.lit(1).cast("bigint"))
    fields = [
        "meeting_start_time", "meeting_title", "meeting_summary",
        "avg_meeting_engagement_level", "average_contribution_sentiment_score",
    ]
    return _items(rows, "meetings", F.col("meeting_start_time"), json_record(**{f: F.col(f) for f in fields}))


def comment_items(contributions: DataFrame, months: DataFrame) -> DataFrame:
    """Every contribution with its speaker and sentiment."""
    rows = in_months(contributions, "meeting_start_ts", months)
    item = json_record(
        company_name=F.col("company_name"),
        customer_meetings_meeting_start_time=seconds_text(F.col("meeting_start_ts")),
        meeting_title=F.col("meeting_title"),
        meeting_summary=F.col("meeting_summary"),
        team_member_name=F.col("contact_name"),
        meeting_comments=F.col("meeting_contribution"),
        customer_meetings_contribution_sentiment_category=F.trim("contribution_sentiment_category"),
    )
    return _items(rows, "comments", F.date_format("meeting_start_ts", MICROS), item)


def task_epics(tasks: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every task with the first start and the last end of its project's epic.

    A window gathers an epic's tasks in one task, over as many partitions as there are rows
    for. If an epic is too large for that, the extremes are aggregated instead, with
    map-side combine, and joined back.
    """
    epic = ["delivery_project_fk", "epic_name"]
    first, last = F.min("task_start_ts"), F.max("task_end_ts")
    seen = tasks.groupBy(*epic).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if (seen["most"] or 0) <= hot_rows:
        over = W.partitionBy(*epic)
        spread = tasks.repartition(parts_for(tasks.sparkSession, seen["rows"] or 0), *epic)
        return spread.withColumns({"epic_start_ts": first.over(over), "epic_end_ts": last.over(over)})
    spans = tasks.groupBy(*epic).agg(first.alias("epic_start_ts"), last.alias("epic_end_ts"))
    return lookup_join(tasks, spans, epic, how="left", null_safe=True, hot_rows=hot_rows)


def tasks_by_month(tasks: DataFrame, projects: DataFrame, months: DataFrame) -> DataFrame:
    """Latest versions of started tasks in every spine month they were active in.

    Active means: started no later than the first moment of the next month, and not
    completed before this month. The upper bound is inclusive, so a task starting
    exactly at a month's first midnight also counts for the month before. A task
    without completion stays active to the last month.

    The join is one of ranges and points (``intervals``): a task takes at most two rows
    per level, about twice the logarithm of its months, and a spine month one row per level.
    """
    current = tasks.where(F.col("is_latest_task_version") & (F.col("task_status") != "To Do"))
    owner = projects.select(F.col("delivery_project_pk").alias("delivery_project_fk"), F.col("company_fk").alias("company_pk"))
    base, points = month_points(months)
    levels = levels_for(points)
    owned = lookup_join(task_ranges(current, base, points), owner, ["delivery_project_fk"], how="inner")
    reached = owned.withColumn("node", F.explode(range_nodes(F.col("first_point"), F.col("last_point"), levels)))
    holders = months.withColumn("node", F.explode(point_nodes(month_number(F.col("engagement_month")) - base, levels)))
    return lookup_join(reached.drop("first_point", "last_point"), holders, ["company_pk", "node"], how="inner").drop("node")


def month_number(month: Column) -> Column:
    return (F.year(month) * 12 + F.month(month)).cast("int")


def month_points(months: DataFrame) -> tuple[int, int]:
    """The number of the first month, and how many months there are up to the last one."""
    number = month_number(F.col("engagement_month"))
    first, last = months.agg(F.min(number), F.max(number)).first()
    return (0, 0) if first is None else (first, last - first + 1)


def task_ranges(tasks: DataFrame, base: int, points: int) -> DataFrame:
    """``first_point`` and ``last_point`` of every task within the months; tasks outside of them are left out."""
    start, end = F.col("task_start_ts"), F.col("task_completed_ts")
    begun = month_number(start) - F.when(start == F.date_trunc("month", start), 1).otherwise(0) - base
    done = F.coalesce(month_number(end) - base, F.lit(points - 1))
    ranged = tasks.withColumns({
        "first_point": F.when(start.isNotNull(), F.greatest(begun, F.lit(0))), "last_point": F.least(done, F.lit(points - 1)),
    })
    return ranged.where(F.col("first_point") <= F.col("last_point"))


def days_open(as_of: dt.date | None = None) -> Column:
    """Whole days since the start of a task that is not done."""
    return F.when(F.col("task_status") != "Done", whole_days(F.col("task_start_ts"), as_of_time(as_of)))


def task_items(tasks: DataFrame, projects: DataFrame, months: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    rows = tasks_by_month(tasks, projects, months)
    item = json_record(
        task_start_date=F.to_date("task_start_ts"),
        task_completed_date=F.to_date("task_completed_ts"),
        task_name=F.col("task_name"),
        task_status=F.col("task_status"),
        task_story_points=F.col("task_story_points"),
        task_days_open=days_open(as_of),
        sprint_name=F.col("sprint_name"),
        epic_name=F.col("epic_name"),
    )
    return _items(rows, "tasks", F.date_format("task_start_ts", MICROS), item)


def gather(items: list[DataFrame], part_items: int = PART_ITEMS) -> DataFrame:
    """All bundles of a company's month side by side: one union, one shuffle, one row per part."""
    union = items[0].select(*ITEM_COLUMNS)
    for more in items[1:]:
        union = union.unionByName(more.select(*ITEM_COLUMNS))
    return bundle(union, KEYS, OUTPUTS, ASCENDING, part_items)

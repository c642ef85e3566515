"""Engagements and the engagement-by-month spine all evidence is joined to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.functions.calendar import as_of_date, month_of, months_between_dates
from statuslight.operators.joins import lookup_join, salted_join

DETAIL_COLUMNS = ["background", "requirements", "solution", "objectives_json", "deliverables_json"]
ENGAGEMENT_KEYS = [
    "company_pk", "deal_name", "deal_id", "deal_description", "engagement_start_ts", "engagement_end_ts",
]


def project_names(engagements: DataFrame) -> DataFrame:
    """One row per engagement with its project names, each with the number of times it occurs.

    Equal engagement rows are one engagement. Copies are counted before the
    shuffle, so a row that is stored very often does not pile up in one task.
    """
    names = engagements.select(
        *ENGAGEMENT_KEYS, F.explode_outer("projects").alias("project")
    ).select(*ENGAGEMENT_KEYS, F.col("project.project_name").alias("name"))
    counted = names.groupBy(*ENGAGEMENT_KEYS, "name").agg(F.count("*").alias("times"))
    run = F.when(F.col("name").isNotNull(), F.struct("name", "times"))
    return counted.groupBy(*ENGAGEMENT_KEYS).agg(F.array_sort(F.collect_list(run)).alias("names"))


def _joined_names(times) -> F.Column:
    flat = F.flatten(
        F.transform("names", lambda n: F.array_repeat(n["name"], (n["times"] * times).cast("int")))
    )
    return F.when(F.size("names") > 0, F.array_join(flat, ","))


def recent_engagements(source: DataFrame, since: dt.datetime) -> DataFrame:
    recent = source.where(F.col("engagement_start_ts") >= F.lit(since).cast("timestamp_ntz"))
    return recent.withColumnRenamed("company_fk", "company_pk")


def engagements(
    source: DataFrame, companies: DataFrame, details: DataFrame, since: dt.datetime
) -> DataFrame:
    """Engagements that start at or after ``since``, with company, project names and details.

    ``source``: company_fk, deal_name, deal_id, deal_description, projects,
    engagement_start_ts, engagement_end_ts. Engagements without projects stay, with
    a NULL project name. Equal detail rows of a deal multiply its project names,
    different ones give an engagement row each.
    """
    named = project_names(recent_engagements(source, since))
    named = lookup_join(named, companies.select("company_pk", "company_name"), ["company_pk"])
    per_deal = details.groupBy("deal_id", *DETAIL_COLUMNS).agg(F.count("*").alias("detail_rows"))
    full = salted_join(named, per_deal, ["deal_id"])  # whole texts, which are grouped once and not measured first
    times = F.coalesce(F.col("detail_rows"), F.lit(1))
    return full.select(
        "company_pk", "company_name", "deal_name", "deal_id", "deal_description",
        _joined_names(times).alias("project_name"),
        "engagement_start_ts", "engagement_end_ts", *DETAIL_COLUMNS,
    )


def engagement_months(as_of: dt.date | None) -> F.Column:
    """The months of an engagement up to that of ``as_of``; NULL without an end or a valid range."""
    today = as_of_date(as_of)
    end = month_of(F.col("engagement_end_ts"))
    last = F.when(end > today, F.trunc(today, "month")).otherwise(end)
    return months_between_dates(month_of(F.col("engagement_start_ts")), last)


def month_spine(engaged: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """One row per engagement and month, the last month being that of ``as_of``.

    An engagement without an end, or one that starts after its clamped end, keeps
    one row with a NULL month. The clamp is a CASE on purpose: ``least`` skips NULL
    and would close open engagements at ``as_of``.
    """
    return engaged.select("*", F.explode_outer(engagement_months(as_of)).alias("engagement_month")).select(
        "company_pk", "company_name", "deal_name", "deal_description", "project_name",
        "engagement_start_ts", "engagement_end_ts", "engagement_month", *DETAIL_COLUMNS,
    )


def spine_months(spine: DataFrame, companies: DataFrame, dedupe: bool = False) -> DataFrame:
    """Distinct months of each known company and how many spine rows share them.

    Evidence is repeated once per spine row of its company and month. Carrying that
    number as ``copies`` gives the same result as joining to the spine itself and
    never multiplies the evidence rows. ``dedupe`` counts every month once.
    """
    counted = (
        spine.where(F.col("engagement_month").isNotNull())
        .groupBy("company_pk", "company_name", "engagement_month")
        .agg((F.lit(1).cast("bigint") if dedupe else F.count("*")).alias("copies"))
    )
    return lookup_join(counted, companies.select("company_pk"), ["company_pk"], how="inner")


def months_of_engagements(
    source: DataFrame, companies: DataFrame, details: DataFrame, since: dt.datetime,
    as_of: dt.date | None = None, dedupe: bool = False,
) -> DataFrame:
    """``spine_months`` straight from the tables, without project names and detail texts.

    An engagement has a spine row for every different detail row of its deal.
    """
    distinct = recent_engagements(source, since).select(*ENGAGEMENT_KEYS).distinct()
    # a digest stands for the texts, which need not be shuffled to be told apart
    content = F.sha2(F.to_json(F.struct(*DETAIL_COLUMNS), {"ignoreNullFields": "false"}), 256)
    versions = details.select("deal_id", content.alias("content")).distinct().groupBy("deal_id").agg(F.count("*").alias("versions"))
    spread = lookup_join(distinct, versions, ["deal_id"]).select(
        "company_pk", F.coalesce(F.col("versions"), F.lit(1)).alias("versions"),
        F.explode(engagement_months(as_of)).alias("engagement_month"),
    )
    counted = spread.groupBy("company_pk", "engagement_month").agg(
        (F.lit(1).cast("bigint") if dedupe else F.sum("versions")).alias("copies")
    )
    named = lookup_join(counted, companies.select("company_pk", "company_name"), ["company_pk"], how="inner")
    return named.select("company_pk", "company_name", "engagement_month", "copies")

"""Project money and hours per company and delivery-end month.

A project has many timesheets, many expenses and several spine rows. Joining them
all at once would pair every timesheet with every expense of a project. The same
totals follow from linear work: timesheets are summed per project first, the
number of rows the other tables would have added is carried as a weight, and
expenses keep a branch of their own. One GROUPING SETS aggregate over projects and
expenses then gives the four grains.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuslight.functions.calendar import month_of
from statuslight.functions.json_text import json_record
from statuslight.functions.numbers import percent_text, pounds_text, ratio
from statuslight.operators.evidence import KEYS, in_months
from statuslight.operators.joins import lookup_join
from statuslight.operators.running import running_sums

GBP = "decimal(28,6)"
MEASURES = [
    "project_sprints_hours_budget",
    "total_project_sprints_fee_amount",
    "total_billable_hours_billed",
    "total_nonbillable_hours_billed",
    "total_timesheet_cost_amount_gbp",
    "total_contractor_cost_amount_gbp",
    "count_of_project_sprints",
]


def sum_distinct_by(df: DataFrame, group: list[str], key: str, value: str, alias: str) -> DataFrame:
    """Sum ``value`` once per ``key`` in a relation where joins have repeated it."""
    once = df.where(F.col(key).isNotNull()).groupBy(*group, key).agg(F.min(value).alias("__once"))
    return once.groupBy(*group).agg(F.sum("__once").alias(alias))


def converted_costs(costs: DataFrame, rates: DataFrame) -> DataFrame:
    """Expenses in pounds, one row per matching rate; 0 where there is no rate.

    A rate of zero raises a division error, as it would in the source query. Amounts
    are decimals to a millionth, so that later sums do not depend on their order.
    """
    quoted = rates.select(F.col("currency_code").alias("expense_currency_code"), "currency_rate")
    joined = lookup_join(costs, quoted, ["expense_currency_code"])
    amount = F.col("expense_amount_local").cast("double") / F.col("currency_rate").cast("double")
    return joined.withColumn("amount_gbp", F.coalesce(F.round(amount, 6), F.lit(0.0)).cast(GBP))


def timesheet_totals(timesheets: DataFrame) -> DataFrame:
    """Hours and cost per project. A NULL billable flag counts as not billable."""
    hours = F.coalesce(F.col("timesheet_hours_billed"), F.lit(0))
    billable = F.coalesce(F.col("timesheet_is_billable"), F.lit(False))
    cost = F.coalesce(F.col("timesheet_hours_billed") * F.col("timesheet_billable_hourly_cost_amount"), F.lit(0))
    return timesheets.groupBy(F.col("timesheet_project_fk").alias("timesheet_project_pk")).agg(
        F.coalesce(F.sum(F.when(billable, hours)), F.lit(0)).alias("billable_hours"),
        F.coalesce(F.sum(F.when(~billable, hours)), F.lit(0)).alias("nonbillable_hours"),
        F.sum(cost).alias("timesheet_cost"),
    )


def _delivered(projects: DataFrame, months: DataFrame) -> DataFrame:
    """Projects that end in a spine month of their company, with the month's spine rows as ``copies``."""
    started = projects.withColumn("start_month", month_of(F.col("project_delivery_start_ts")))
    return in_months(started, "project_delivery_end_ts", months).select(
        "company_name", "engagement_month", "start_month", "timesheet_project_pk", "project_code",
        "project_fee_amount", "project_budget_amount", "copies",
    )


def financial_grains(
    projects: DataFrame,
    timesheets: DataFrame,
    costs: DataFrame,
    rates: DataFrame,
    months: DataFrame,
    mode: str = "faithful",
) -> DataFrame:
    """Seven measures per company and delivery-end month.

    ``faithful`` repeats hours and timesheet cost once per expense, rate and spine
    row and keeps the smallest start-month total, as the source query does.
    ``corrected`` counts every timesheet once and adds up the start months.
    Budget, fee and contractor cost are counted once per project or expense in both.
    Decimal inputs stay decimal, so every total is exact; KPIs turn them into doubles.
    """
    if mode not in ("faithful", "corrected"):
        raise ValueError(f"unknown mode {mode!r}")
    delivered = _delivered(projects, months)
    in_gbp = converted_costs(costs, rates)
    # the project key is unique on both sides of these two joins, so no key can be hot
    hours = delivered.join(timesheet_totals(timesheets), "timesheet_project_pk", "left")
    if mode == "faithful":
        repeats = in_gbp.groupBy(F.col("timesheet_project_fk").alias("timesheet_project_pk")).agg(
            F.count("*").alias("expense_rows")
        )
        hours = hours.join(repeats, "timesheet_project_pk", "left")
        weight = F.col("copies") * F.coalesce(F.col("expense_rows"), F.lit(1))
    else:
        weight = F.lit(1)

    place = ["company_name", "engagement_month", "start_month"]
    project_rows = hours.select(
        *place, "timesheet_project_pk", "project_code", "project_fee_amount", "project_budget_amount",
        *[(F.coalesce(F.col(c), F.lit(0)) * weight).alias(c) for c in ("billable_hours", "nonbillable_hours", "timesheet_cost")],
        F.lit(None).cast(costs.schema["expense_pk"].dataType).alias("expense_pk"),
        F.lit(None).cast(GBP).alias("amount_gbp"),
    )
    owners = delivered.select(*place, F.col("timesheet_project_pk").alias("timesheet_project_fk"))
    spent = lookup_join(
        in_gbp.select("timesheet_project_fk", "expense_pk", "amount_gbp").where(F.col("expense_pk").isNotNull()),
        owners, ["timesheet_project_fk"], how="inner",
    )
    union = project_rows.unionByName(spent.drop("timesheet_project_fk"), allowMissingColumns=True)

    sets = [[*place, "project_code"], [*place, "timesheet_project_pk"], [*place, "expense_pk"], place]
    columns = [*place, "project_code", "timesheet_project_pk", "expense_pk"]
    grains = union.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("grain"),
        F.min("project_budget_amount").alias("budget"),
        F.min("project_fee_amount").alias("fee"),
        F.sum("billable_hours").alias("billable_hours"),
        F.sum("nonbillable_hours").alias("nonbillable_hours"),
        F.sum("timesheet_cost").alias("timesheet_cost"),
        F.min("amount_gbp").alias("amount_gbp"),
    )
    # grouping ids of the four sets: code 3, project 5, expense 6, start month alone 7
    by_code, by_project, by_expense, by_start = (F.col("grain") == g for g in (3, 5, 6, 7))
    has_project = by_project & F.col("timesheet_project_pk").isNotNull()
    has_expense = by_expense & F.col("expense_pk").isNotNull()
    per_start = F.min if mode == "faithful" else F.sum

    def start_total(column: str) -> Column:
        return per_start(F.when(by_start, F.col(column)))

    return grains.groupBy(*KEYS).agg(
        F.coalesce(F.sum(F.when(has_project, F.col("budget"))), F.lit(0)).alias(MEASURES[0]),
        F.coalesce(F.sum(F.when(has_project, F.col("fee"))), F.lit(0)).alias(MEASURES[1]),
        start_total("billable_hours").alias(MEASURES[2]),
        start_total("nonbillable_hours").alias(MEASURES[3]),
        start_total("timesheet_cost").alias(MEASURES[4]),
        F.coalesce(F.sum(F.when(has_expense, F.col("amount_gbp"))), F.lit(0)).alias(MEASURES[5]),
        F.count(F.when(by_code, F.col("project_code"))).alias(MEASURES[6]),
    )


def running_financials(grains: DataFrame, per_company: bool = False, slices: int | None = None) -> DataFrame:
    """Measures accumulated month by month.

    By default over all companies together, ordered by month and company name, as
    the source query has no partition; ``per_company`` restarts for each company.
    """
    if per_company:
        so_far = W.partitionBy("company_name").orderBy("engagement_month").rowsBetween(W.unboundedPreceding, 0)
        return grains.select(*KEYS, *[F.sum(m).over(so_far).alias(m) for m in MEASURES])
    summed = running_sums(grains, ["engagement_month", "company_name"], MEASURES, slices=slices)
    return summed.select(*KEYS, *[F.col(f"{m}_to_date").alias(m) for m in MEASURES])


def financial_kpis(running: DataFrame) -> DataFrame:
    """Ratios and amounts as numbers; NULL where a divisor is zero."""
    budget, fee, billable, nonbillable, cost, contractor = (F.col(m).cast("double") for m in MEASURES[:6])
    worked = billable + nonbillable
    profit = fee - (cost + contractor)
    return running.select(
        *KEYS,
        (F.lit(100.0) * ratio(worked, budget)).alias("hours_vs_budget_pct"),
        (F.lit(100.0) * ratio(nonbillable, worked)).alias("nonbillable_hours_pct"),
        (F.lit(100.0) * ratio(profit, fee)).alias("margin_pct"),
        ratio(fee, worked).alias("hourly_rate"),
        fee.alias("fee_amount"),
        profit.alias("profit_amount"),
        contractor.alias("contractor_cost"),
    )


def kpi_texts(kpis: DataFrame) -> DataFrame:
    """The seven KPIs as they appear in the bundle."""
    return kpis.select(
        *KEYS,
        percent_text(F.col("hours_vs_budget_pct")).alias("project_sprints_hours_vs_budget_pct"),
        percent_text(F.col("nonbillable_hours_pct")).alias("nonbillable_hours_pct"),
        percent_text(F.col("margin_pct")).alias("project_sprints_margin_pct"),
        pounds_text(F.col("hourly_rate")).alias("project_sprints_hourly_rate"),
        pounds_text(F.col("fee_amount")).alias("total_project_sprints_fee_amount"),
        pounds_text(F.col("profit_amount")).alias("total_project_sprints_profit_amount"),
        pounds_text(F.col("contractor_cost")).alias("total_contractor_resource_cost_gbp"),
    )


def financial_items(running: DataFrame) -> DataFrame:
    texts = kpi_texts(financial_kpis(running))
    fields = [c for c in texts.columns if c not in KEYS]
    return texts.select(
        *KEYS, F.lit("financials").alias("kind"), F.lit("").alias("sort_key"),
        json_record(**{f: F.col(f) for f in fields}).alias("item"), F.lit(1).cast("bigint").alias("copies"),
    )


def target_statuses(margin: Column, hours: Column, rate: Column) -> list[Column]:
    """Status of margin, hours and hourly rate by the stated targets.

    Fixed values: margin at least 70 %, hours at most 100 % of the budget, an hourly
    rate of at least 140 and ideally 180 pounds.
    """
    return [
        F.when(margin >= 70, "GREEN").when(margin < 70, "RED"),
        F.when(hours <= 100, "GREEN").when(hours > 100, "RED"),
        F.when(rate >= 180, "GREEN").when(rate >= 140, "AMBER").when(rate < 140, "RED"),
    ]


def financial_status_rules(kpis: DataFrame) -> DataFrame:
    """Red, amber or green by the stated targets (see ``target_statuses``)."""
    statuses = target_statuses(F.col("margin_pct"), F.col("hours_vs_budget_pct"), F.col("hourly_rate"))
    names = ["margin_status", "hours_status", "rate_status"]
    rated = kpis.select(*KEYS, *[status.alias(name) for status, name in zip(statuses, names, strict=True)])
    parts = F.array(*names)
    return rated.withColumn(
        "financials_status",
        F.when(F.array_contains(parts, "RED"), "RED")
        .when(F.array_contains(parts, "AMBER"), "AMBER")
        .when(F.array_contains(parts, "GREEN"), "GREEN"),
    )

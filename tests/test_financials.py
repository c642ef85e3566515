"""Money and hours against the join-everything definition and its invariants."""

import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuslight.operators import financials
from statuslight.operators.evidence import KEYS

D = decimal.Decimal
NTZ = "timestamp_ntz"


def day(month, d=1):
    return dt.datetime(2001, month, d)


@pytest.fixture(scope="module")
def inputs(spark):
    projects = spark.createDataFrame(
        [(1, 1, "c1", D(100), D(10), day(1), day(2, 9)), (2, 1, "c1", D(50), D(5), day(2), day(2, 20)),
         (3, 1, None, None, D(5), day(2), day(2, 3)), (4, 1, "c2", D(7), D(1), day(1), None), (5, 2, "c2", D(7), D(1), day(1), day(1))],
        "timesheet_project_pk bigint, company_fk bigint, project_code string, project_fee_amount decimal(18,2),"
        f" project_budget_amount decimal(18,2), project_delivery_start_ts {NTZ}, project_delivery_end_ts {NTZ}",
    )
    timesheets = spark.createDataFrame(
        [(1, True, D(3), D(2)), (1, None, D(4), D(1)), (1, False, D(5), None), (2, True, D(8), D(1)), (9, True, D(1), D(1)), (3, True, None, D(1))],
        "timesheet_project_fk bigint, timesheet_is_billable boolean, timesheet_hours_billed decimal(10,2),"
        " timesheet_billable_hourly_cost_amount decimal(12,5)",
    )
    costs = spark.createDataFrame(
        [(11, 1, 10.0, "USD"), (12, 1, 4.0, "GBP"), (13, 2, 3.0, "XXX"), (None, 2, 9.0, "GBP"), (14, 9, 1.0, "GBP")],
        "expense_pk bigint, timesheet_project_fk bigint, expense_amount_local double, expense_currency_code string",
    )
    rates = spark.createDataFrame([("GBP", 1.0), ("USD", 2.0)], "currency_code string, currency_rate double")
    months = spark.createDataFrame(
        [(1, "A", dt.date(2001, 2, 1), 2), (2, "B", dt.date(2001, 2, 1), 1)],
        "company_pk bigint, company_name string, engagement_month date, copies bigint",
    )
    return projects, timesheets, costs, rates, months


def joined(projects, timesheets, costs, rates, months):
    """Every pairing of timesheets, expenses, rates and spine rows, summed at its grain."""
    spine = months.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "col")
    p, month = projects, F.trunc(F.to_date("project_delivery_end_ts"), "month")
    base = p.join(spine, (p.company_fk == spine.company_pk) & (month == spine.engagement_month))
    base = base.join(timesheets, base.timesheet_project_pk == timesheets.timesheet_project_fk, "left").drop("timesheet_project_fk")
    base = base.join(costs, base.timesheet_project_pk == costs.timesheet_project_fk, "left").drop("timesheet_project_fk")
    base = base.join(rates, base.expense_currency_code == rates.currency_code, "left")
    flag = F.coalesce("timesheet_is_billable", F.lit(False))
    hours = F.coalesce("timesheet_hours_billed", F.lit(0))
    per_start = base.groupBy(*KEYS, F.trunc(F.to_date("project_delivery_start_ts"), "month").alias("s")).agg(
        F.coalesce(F.sum(F.when(flag, hours)), F.lit(0)).alias("b"),
        F.coalesce(F.sum(F.when(~flag, hours)), F.lit(0)).alias("n"),
        F.sum(F.coalesce(F.col("timesheet_hours_billed") * F.col("timesheet_billable_hourly_cost_amount"), F.lit(0))).alias("c"),
        F.countDistinct("project_code").alias("codes"),
    )
    hours_part = per_start.groupBy(*KEYS).agg(F.min("b").alias("b"), F.min("n").alias("n"), F.min("c").alias("c"), F.sum("codes").alias("codes"))
    money = base.select(*KEYS, "timesheet_project_pk", "project_budget_amount", "project_fee_amount").distinct().groupBy(*KEYS).agg(
        F.sum("project_budget_amount").alias("budget"), F.sum("project_fee_amount").alias("fee")
    )
    spent = base.where("expense_pk is not null").select(
        *KEYS, "expense_pk", F.coalesce(F.col("expense_amount_local") / F.col("currency_rate"), F.lit(0)).alias("g")
    ).distinct().groupBy(*KEYS).agg(F.sum("g").alias("g"))
    return hours_part.join(money, KEYS).join(spent, KEYS, "left")


def values(df):
    return {r.company_name: tuple(float(r[m]) for m in financials.MEASURES) for r in df.collect()}


def test_faithful_equals_the_join_of_everything(inputs):
    got = values(financials.financial_grains(*inputs))
    want = {
        r.company_name: (float(r.budget), float(r.fee), float(r.b), float(r.n), float(r.c), r.g or 0.0, float(r.codes))
        for r in joined(*inputs).collect()
    }
    assert got == want and set(got) == {"A"}


def test_corrected_counts_every_timesheet_once(inputs):
    got = values(financials.financial_grains(*inputs, mode="corrected"))
    assert got == {"A": (20.0, 150.0, 11.0, 9.0, 18.0, 9.0, 2.0)}


def test_more_expenses_change_hours_in_faithful_mode_only(spark, inputs):
    projects, timesheets, costs, rates, months = inputs
    more = costs.unionByName(spark.createDataFrame([(99, 2, 0.0, "GBP")], costs.schema))
    for mode, same in (("corrected", True), ("faithful", False)):
        before, after = (values(financials.financial_grains(projects, timesheets, c, rates, months, mode))["A"] for c in (costs, more))
        assert (before == after) is same
        assert before[:2] == after[:2] and before[5] == after[5]


def test_a_rate_of_zero_is_an_error(spark, inputs):
    zero = spark.createDataFrame([("USD", 0.0)], "currency_code string, currency_rate double")
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        financials.converted_costs(inputs[2], zero).collect()


def test_sum_distinct_by(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("a", 2, 7), ("a", None, 9), ("b", 1, 5)], "g string, k int, v int")
    got = financials.sum_distinct_by(df, ["g"], "k", "v", "total")
    assert {r.g: r.total for r in got.collect()} == {"a": 12, "b": 5}


@pytest.mark.parametrize("per_company", [False, True])
def test_running_sums_over_many_slices(spark, per_company):
    grains = spark.range(300).select(
        F.concat(F.lit("C"), F.col("id") % 25).alias("company_name"),
        F.add_months(F.lit(dt.date(2000, 1, 1)), (F.col("id") / 25).cast("int")).alias("engagement_month"),
        *[(F.col("id") * (i + 1)).cast("decimal(18,2)").alias(m) for i, m in enumerate(financials.MEASURES)],
    )
    order = W.partitionBy(*(["company_name"] if per_company else [])).orderBy("engagement_month", "company_name")
    want = grains.select(*KEYS, *[F.sum(m).over(order.rowsBetween(W.unboundedPreceding, 0)).alias(m) for m in financials.MEASURES])
    got = financials.running_financials(grains, per_company, slices=6)
    assert sorted(map(str, (tuple(map(str, r)) for r in got.collect()))) == sorted(map(str, (tuple(map(str, r)) for r in want.collect())))


def test_status_rules(spark):
    rows = [("g", 80.0, 90.0, 200.0), ("a", 70.0, 100.0, 150.0), ("r", 69.0, 10.0, 300.0), ("n", None, None, None), ("p", None, 101.0, None)]
    df = spark.createDataFrame(rows, "company_name string, margin_pct double, hours_vs_budget_pct double, hourly_rate double")
    got = financials.financial_status_rules(df.withColumn("engagement_month", F.lit(dt.date(2001, 1, 1))))
    assert {r.company_name: r.financials_status for r in got.collect()} == {"g": "GREEN", "a": "AMBER", "r": "RED", "n": None, "p": "RED"}

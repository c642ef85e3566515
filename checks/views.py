"""The input tables of the library, derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuslight.operators.joins import fits_broadcast, parts_for
from statuslight.plans.status_report import StatusReport
from statuslight.sources.tables import read_spread

AS_OF = dt.date(2001, 3, 15)
SINCE = dt.datetime(2000, 1, 1)
#: rows and bytes of the parts' brands that every executor may hold
BRANDS_HELD = 1_500_000, 128 << 20


def text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def number(name: str) -> Column:
    return F.col(name).cast("string")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_spread(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with the customer and date of their order."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return self.by_parts(self.table("lineitem"), "l_orderkey").join(self.by_parts(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def parts(self) -> int:
        """As many as the order lines need, so that the rows a task sorts and groups do not grow with the table."""
        return parts_for(self.spark, self.table("lineitem").count())

    def by_parts(self, df: DataFrame, *key: str) -> DataFrame:
        return df.repartition(self.parts, *key)

    def companies(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("company_pk"), F.col("c_name").alias("company_name")
        )

    def engagements(self) -> DataFrame:
        numbers = self.table("lineitem").groupBy("l_orderkey").agg(
            F.array_sort(F.collect_set("l_linenumber")).alias("numbers")
        )
        projects = F.transform("numbers", lambda n: F.struct(text("P", n.cast("string")).alias("project_name")))
        months = (F.col("o_orderkey") % 6).cast("int")
        end = F.expr("o_orderdate") + F.make_interval(months=months)
        return self.table("orders").join(numbers, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            F.col("o_custkey").alias("company_fk"),
            text("Deal ", number("o_orderkey")).alias("deal_name"),
            F.col("o_orderkey").alias("deal_id"),
            F.col("o_orderpriority").alias("deal_description"),
            projects.alias("projects"),
            F.col("o_orderdate").alias("engagement_start_ts"),
            F.when(F.col("o_orderkey") % 10 != 7, end).alias("engagement_end_ts"),
        )

    def details(self) -> DataFrame:
        """The whole text of a document in three parts."""
        third = F.floor((F.length("text") + 2) / 3).cast("int")
        return self.table("documents").select(
            F.col("doc_id").alias("deal_id"),
            F.when(F.col("doc_id") % 5 != 0, F.substring("text", F.lit(1), third)).alias("background"),
            F.substring("text", third + 1, third).alias("requirements"),
            F.substring("text", 2 * third + 1, F.length("text")).alias("solution"),
            text('[{"objective_number": "', number("n_chars"), '"}]').alias("objectives_json"),
            text('[{"deliverable_number": "', number("n_chars"), '"}]').alias("deliverables_json"),
        )

    def contacts(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("contact_pk"), F.col("s_name").alias("contact_name")
        )

    def messages(self) -> DataFrame:
        return self.lines.select(
            F.col("o_custkey").alias("company_fk"),
            F.col("l_suppkey").alias("contact_fk"),
            F.col("l_shipdate").alias("message_ts"),
            F.col("l_returnflag").alias("channel_name"),
            text("line ", number("l_linenumber"), " part ", number("l_partkey")).alias("message_text"),
        )

    def docs(self) -> DataFrame:
        customers = self.table("customer").count()
        days = (F.col("doc_id") % 430).cast("int")
        return self.table("documents").select(
            (F.col("doc_id") % customers).alias("company_fk"),
            F.when(F.col("doc_id") % 11 != 0, text("doc ", number("doc_id"))).alias("page_title"),
            (F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days)).alias("page_created_at_ts"),
            F.col("text").alias("page_summary"),
        )

    def contributions(self) -> DataFrame:
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        sentiment = (
            F.when(flag == "A", "POSITIVE").when(flag == "N", " CONCERNED ")
            .when((flag == "R") & (status == "F"), "UNENGAGED")
        )
        people = self.table("supplier").select("s_suppkey", "s_name")
        return self.lines.join(people, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
            F.col("o_custkey").alias("company_fk"),
            F.col("l_shipdate").alias("meeting_start_ts"),
            text("M", (F.col("l_partkey") % 50).cast("string")).alias("meeting_title"),
            text("S", flag).alias("meeting_summary"),
            F.col("l_quantity").alias("meeting_engagement_level"),
            sentiment.alias("contribution_sentiment_category"),
            F.col("s_name").alias("contact_name"),
            text("line ", number("l_linenumber"), " part ", number("l_partkey")).alias("meeting_contribution"),
        )

    def delivery_projects(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("delivery_project_pk"), F.col("o_custkey").alias("company_fk")
        )

    def tasks(self) -> DataFrame:
        brands = self.table("part").select("p_partkey", "p_brand")
        later = F.greatest("o_orderdate", "l_shipdate")
        flag = F.col("l_returnflag")
        lines = self.lines
        if fits_broadcast(brands, *BRANDS_HELD):
            brands = F.broadcast(brands)
        else:
            lines, brands = self.by_parts(lines, "l_partkey"), self.by_parts(brands, "p_partkey")
        return lines.join(brands, F.col("l_partkey") == F.col("p_partkey"), "left").select(
            F.col("l_orderkey").alias("delivery_project_fk"),
            F.least("o_orderdate", "l_shipdate").alias("task_start_ts"),
            later.alias("task_end_ts"),
            F.when(F.col("l_linestatus") == "F", later).alias("task_completed_ts"),
            F.when(flag == "A", "Done").when(flag == "N", "In Progress").when(flag == "R", "To Do").alias("task_status"),
            F.col("p_brand").alias("epic_name"),
            text("S", number("l_linenumber")).alias("sprint_name"),
            F.col("l_quantity").cast("int").alias("task_story_points"),
            (F.col("l_linenumber") % 2 == 1).alias("is_latest_task_version"),
            text("T", number("l_partkey")).alias("task_name"),
        )

    def timesheet_projects(self) -> DataFrame:
        end = F.col("o_orderdate") + F.make_interval(months=(F.col("o_orderkey") % 4).cast("int"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("timesheet_project_pk"),
            F.col("o_custkey").alias("company_fk"),
            F.col("o_orderpriority").alias("project_code"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("project_fee_amount"),
            (F.col("o_totalprice") / 1000).cast("decimal(18,5)").alias("project_budget_amount"),
            F.col("o_orderdate").alias("project_delivery_start_ts"),
            end.alias("project_delivery_end_ts"),
        )

    def timesheets(self) -> DataFrame:
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        billable = F.when(flag.isin("A", "N"), True).when((flag == "R") & (status == "F"), False)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("timesheet_project_fk"),
            billable.alias("timesheet_is_billable"),
            F.col("l_quantity").cast("decimal(10,2)").alias("timesheet_hours_billed"),
            (F.col("l_extendedprice") / 1000).cast("decimal(12,5)").alias("timesheet_billable_hourly_cost_amount"),
        )

    def costs(self) -> DataFrame:
        code = F.min("l_returnflag")
        return (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("expense_amount_local"),
                F.when(code == "A", "GBP").when(code == "N", "USD").otherwise("EUR").alias("expense_currency_code"),
            )
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("expense_pk"),
                F.col("l_orderkey").alias("timesheet_project_fk"),
                "expense_amount_local",
                "expense_currency_code",
            )
        )

    def rates(self) -> DataFrame:
        return self.spark.createDataFrame(
            [("GBP", 1.0), ("USD", 1.25), ("EUR", 1.16)], "currency_code string, currency_rate double"
        )

    def status(self, **options) -> StatusReport:
        return StatusReport(StatusViews(self), SINCE, AS_OF, **options)

    def vector_chunks(self) -> DataFrame:
        """The stored vectors as chunks of ten deals, with whole documents as content (empty where there is none)."""
        texts = self.table("documents").select("doc_id", "text")
        return self.table("embeddings").join(texts, F.col("vec_id") == F.col("doc_id"), "left").select(
            F.col("label").cast("bigint").alias("deal_id"),
            F.col("vec_id").alias("id"),
            text("doc/", number("vec_id")).alias("uri"),
            F.coalesce("text", F.lit("")).alias("content"),
            "embedding",
        )

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("label").cast("bigint").alias("deal_id"), F.col("vec_id").alias("id"), "embedding"
        )

    def centroids(self) -> DataFrame:
        """One question per label: the mean of its vectors."""
        places = self.table("embeddings").select("label", F.posexplode("embedding").alias("place", "x"))
        means = places.groupBy("label", "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
        ordered = F.array_sort(F.collect_list(F.struct("place", F.round("x", 9).alias("x"))))
        return means.groupBy("label").agg(ordered.alias("places")).select(
            text("q", number("label")).alias("question"), F.transform("places", lambda p: p["x"]).alias("vector")
        )

    def document_names(self) -> DataFrame:
        """Catalog-like names: every document id and its two derived tables."""
        suffixes = F.array(F.lit(""), F.lit("_result"), F.lit("_embeddings"))
        named = self.table("documents").select("doc_id", F.explode(suffixes).alias("suffix"))
        return named.select(text(number("doc_id"), F.col("suffix")).alias("name"))


class StatusViews:
    """The views under the table names of the report, each built when first used."""

    def __init__(self, views: Views):
        self._views = views

    @cached_property
    def source(self) -> DataFrame:
        return self._views.engagements()

    def __getattr__(self, name: str) -> DataFrame:
        table = getattr(self._views, name)()
        setattr(self, name, table)
        return table

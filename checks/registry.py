"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import replies
from checks.views import AS_OF, Views, number, text
from statuslight.functions.calendar import SECONDS
from statuslight.functions.json_text import json_array, json_value, parsed, strip_fences
from statuslight.functions.numbers import safe_bigint
from statuslight.operators import details, documents, evidence, financials, generation, lists, reporting, retrieval
from statuslight.operators.ledger import CallLedger
from statuslight.plans import engagement_details
from statuslight.plans.ingestion import Ingestion
from statuslight.session import shared_dir, written
from statuslight.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, nested values as JSON, so that any two engines compare equal."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, SECONDS)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
            column = F.to_json(column, {"ignoreNullFields": "false"})
        out.append(column.alias(field.name))
    return df.select(*out)


def query(run: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf_dir: plain(run(Views(spark, sf_dir)))
    return run


def rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def money(df: DataFrame) -> DataFrame:
    """Exact decimals rounded to pence, then shown as doubles."""
    return df.withColumns({c: F.round(c, 2).cast("double") for c in financials.MEASURES[:6]})


def scratch(v: Views, label: str) -> str:
    import uuid

    return f"{shared_dir(v.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# ---- spine and evidence --------------------------------------------------------------


@query
def engagements(v: Views) -> DataFrame:
    return v.status().engagements()


@query
def explode_projects(v: Views) -> DataFrame:
    return v.status().engagements().select("deal_id", "deal_name", "project_name")


@query
def month_spine(v: Views) -> DataFrame:
    return v.status().spine()


@query
def left_to_inner(v: Views) -> DataFrame:
    """A left join whose filter rejects NULLs, left to the optimizer to turn into an inner join."""
    orders = v.table("orders").select(F.col("o_custkey").alias("company_pk"), "o_totalprice", "o_orderdate")
    late = v.companies().join(orders, "company_pk", "left").where(
        F.col("o_orderdate") >= F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz")
    )
    return late.groupBy("company_pk", "company_name").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def counted(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.sum("copies").alias("copies"))


@query
def messages_by_month(v: Views) -> DataFrame:
    rows = evidence.messages_by_month(v.messages(), v.contacts(), v.status().months)
    return counted(rows, [c for c in rows.columns if c != "copies"])


@query
def docs_by_month(v: Views) -> DataFrame:
    rows = evidence.docs_by_month(v.docs(), v.status().months)
    return counted(rows, [c for c in rows.columns if c != "copies"])


@query
def meetings_by_month(v: Views) -> DataFrame:
    rows = evidence.meetings_by_month(v.contributions(), v.status().months)
    meeting = [*evidence.KEYS, "meeting_start_ts", "meeting_title", "meeting_summary"]
    return counted(rows, meeting).withColumnRenamed("copies", "contributions")


@query
def meeting_sentiment(v: Views) -> DataFrame:
    rows = evidence.meeting_sentiment(v.contributions(), v.status().months)
    return rounded(rows, 6, ["avg_meeting_engagement_level", "average_contribution_sentiment_score"])


@query
def tasks_by_month(v: Views) -> DataFrame:
    rows = evidence.tasks_by_month(v.tasks(), v.delivery_projects(), v.status().months)
    return counted(rows, [*evidence.KEYS, "task_name", "task_status", "task_start_ts", "task_completed_ts"])


@query
def task_age(v: Views) -> DataFrame:
    aged = v.tasks().withColumn("task_days_open", evidence.days_open(AS_OF))
    return v.by_parts(aged, "delivery_project_fk", "task_name").groupBy("delivery_project_fk", "task_name", "task_status", "task_start_ts", "task_days_open").agg(
        F.count("*").alias("tasks")
    )


@query
def task_epics(v: Views) -> DataFrame:
    return evidence.task_epics(v.tasks()).select(
        "delivery_project_fk", "task_name", "task_status", "sprint_name", "epic_name", "epic_start_ts", "epic_end_ts"
    )


@query
def slack_bundle(v: Views) -> DataFrame:
    return v.status().bundle("messages")


@query
def docs_bundle(v: Views) -> DataFrame:
    return v.status().bundle("docs")


@query
def meetings_bundle(v: Views) -> DataFrame:
    return v.status().bundle("meetings")


@query
def comments_bundle(v: Views) -> DataFrame:
    return v.status().bundle("comments")


@query
def tasks_bundle(v: Views) -> DataFrame:
    return v.status().bundle("tasks")


@query
def financial_bundle(v: Views) -> DataFrame:
    return v.status().bundle("financials")


@query
def slack_bundle_distinct(v: Views) -> DataFrame:
    """Every message once, however many engagements share its company's month."""
    return v.status(dedupe=True).bundle("messages")


@query
def tasks_bundle_in_parts(v: Views) -> DataFrame:
    """Arrays of at most 7 tasks: the path of groups too large for one array."""
    return v.status(part_items=7).bundle("tasks")


@query
def docs_bundle_in_parts(v: Views) -> DataFrame:
    return v.status(part_items=1).bundle("docs")


# ---- financials ------------------------------------------------------------------------


@query
def sum_distinct_by_key(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderkey", F.col("o_custkey").alias("company_fk"), F.col("o_totalprice").cast("decimal(18,2)").alias("fee"))
    lines = v.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).join(orders, "o_orderkey")
    total = financials.sum_distinct_by(lines, ["company_fk"], "o_orderkey", "fee", "fee")
    return total.withColumn("fee", F.col("fee").cast("double"))


@query
def convert_currency(v: Views) -> DataFrame:
    converted = financials.converted_costs(v.costs(), v.rates())
    return rounded(converted, 6, ["amount_gbp"]).select("expense_pk", "timesheet_project_fk", "expense_currency_code", "amount_gbp")


@query
def financial_grains(v: Views) -> DataFrame:
    return money(v.status().grains())


@query
def financial_grains_corrected(v: Views) -> DataFrame:
    return money(v.status(mode="corrected", dedupe=True).grains())


@query
def running_financials_global(v: Views) -> DataFrame:
    return money(v.status().running())


@query
def running_financials_by_company(v: Views) -> DataFrame:
    return money(v.status().running(per_company=True))


@query
def financial_kpis(v: Views) -> DataFrame:
    kpis = financials.financial_kpis(v.status().running())
    shares = ["hours_vs_budget_pct", "nonbillable_hours_pct", "margin_pct", "hourly_rate"]
    return rounded(rounded(kpis, 4, shares), 2, ["fee_amount", "profit_amount", "contractor_cost"])


@query
def financial_status_rules(v: Views) -> DataFrame:
    return financials.financial_status_rules(financials.financial_kpis(v.status().running()))


# ---- prompts and reports ------------------------------------------------------------------


@query
def assemble_evidence(v: Views) -> DataFrame:
    status = v.status()
    rows = reporting.assemble_evidence(status.written_spine, status.evidence())
    return rows.select("company_name", "deal_name", "engagement_month", "prompt_part", *evidence.OUTPUTS.values())


@query
def assemble_prompt(v: Views) -> DataFrame:
    return v.status().prompts()


@query
def generate_status_text(v: Views) -> DataFrame:
    answers = v.status().answers(replies.counting_backend)
    return answers.select("company_name", "deal_name", "engagement_month", "prompt_part", generation.RESULT, generation.STATUS)


def made_answers(v: Views) -> DataFrame:
    """An answer for every spine row; some malformed, nested, incomplete, with a quoted timeline or with repeated keys at two depths."""
    rows = v.status().spine().where(F.col("engagement_month").isNotNull())
    n = safe_bigint(F.substring("deal_name", 6, 20)) * 12 + F.month("engagement_month")
    numbered = rows.withColumn("n", n)
    shown = F.col("n").cast("string")
    status = F.element_at(F.array(*map(F.lit, ["RED", "AMBER", "GREEN"])), (F.col("n") % 3 + 1).cast("int"))
    full = F.replace(F.replace(F.lit(replies.STATUS_TEMPLATE), F.lit("@n"), shown), F.lit("@s"), status)
    timeline = [F.replace(F.lit(t), F.lit("@n"), shown) for t in (replies.TIMELINE_ARRAY, replies.TIMELINE_STRING)]
    answer = (
        F.when(F.col("n") % 13 == 0, text("no report for ", shown))
        .when(F.col("n") % 17 == 0, F.replace(full, text('"reason ', shown, '"'), F.lit('{"text": "reason"}')))
        .when(F.col("n") % 19 == 0, F.replace(full, F.lit('"overall_status"'), F.lit('"other_status"')))
        .when(F.col("n") % 23 == 0, F.replace(full, *timeline))
        .when(F.col("n") % 29 == 0, F.replace(F.replace(full, *map(F.lit, replies.TWICE)), *map(F.lit, replies.BRACKET)))
        .when(F.col("n") % 31 == 0, F.replace(full, *map(F.lit, replies.EVENT_TWICE)))
        .otherwise(full)
    )
    return numbered.withColumns({"answer": answer, "prompt_part": F.lit(0).cast("bigint")})


@query
def parse_status_response(v: Views) -> DataFrame:
    return reporting.parse_status(made_answers(v), "answer", ["deal_name", "engagement_month"])


@query
def timeline_events(v: Views) -> DataFrame:
    parsed_rows = reporting.parse_status(made_answers(v), "answer", ["deal_name", "engagement_month"])
    return parsed_rows.select(
        "deal_name", "engagement_month", F.posexplode("month_timeline_events").alias("position", "e")
    ).select("deal_name", "engagement_month", F.col("position").cast("bigint").alias("position"), "e.*")


@query
def timeline_events_lenient(v: Views) -> DataFrame:
    """Timelines given as a string that holds an array are read too."""
    answers = made_answers(v).where(F.col("n") % 23 == 0)
    return reporting.parse_status(answers, "answer", ["deal_name", "engagement_month"], lenient=True).select("deal_name", "engagement_month", "month_timeline_events")


@query
def report(v: Views) -> DataFrame:
    return reporting.status_report(made_answers(v), "answer")


@query
def status_report(v: Views) -> DataFrame:
    """From tables to report: spine, evidence, answers by fixed rules, parsed and merged rows."""
    return v.status().report()


@query
def status_report_in_parts(v: Views) -> DataFrame:
    """Evidence in arrays of at most 7 items: an engagement's month is still one row, merged from the answers to its parts."""
    return v.status(part_items=7).report()


@query
def assemble_prompt_in_parts(v: Views) -> DataFrame:
    """Every part's prompt as its length and checksum, of which there is one per 7 items of the largest kind."""
    prompts = v.status(part_items=7).prompts()
    return prompts.select(
        "company_name", "deal_name", "engagement_month", "prompt_part", F.length("prompt").cast("bigint").alias("characters"), F.md5("prompt").alias("prompt_md5")
    )


@query
def status_report_through_ledger(v: Views) -> DataFrame:
    """The report by a model that counts, twice over one ledger: the second run finds every answer and calls nothing."""
    ledger = CallLedger(scratch(v, "ledger"), buckets=16)
    status = v.status()
    status.answers(replies.counting_backend, ledger=ledger)
    answers = status.answers(replies.no_backend, ledger=ledger)
    return reporting.merged_report(answers, generation.RESULT, last_part=0)


# ---- documents ------------------------------------------------------------------------------


def source_documents(v: Views) -> DataFrame:
    return v.table("documents").select(
        (F.col("doc_id") % 10).alias("deal_id"), text("doc/", number("doc_id")).alias("uri"), "text"
    )


def document_chunks(v: Views) -> DataFrame:
    return documents.chunk_documents(source_documents(v), ["deal_id", "uri"], F.col("text"))


@query
def discover_files(v: Views) -> DataFrame:
    return files.discover_files(v.spark, v.sf_dir, ".parquet").select("name", "id", "length")


@query
def incremental_discovery(v: Views) -> DataFrame:
    found = v.document_names().withColumnRenamed("name", "id")
    return files.incremental_discovery(found, v.table("labels").select(number("doc_id").alias("id")))


@query
def chunk_documents(v: Views) -> DataFrame:
    """Chunks written by deal partition and read back."""
    path = scratch(v, "chunks")
    tables.replace_partitions(document_chunks(v), path)
    back = v.spark.read.parquet(path).withColumn("deal_id", F.col("deal_id").cast("bigint"))
    return back.select("deal_id", "uri", "id", "content", "page_footers_text", "page_span_start", "page_span_end")


@query
def parse_chunks(v: Views) -> DataFrame:
    """Documents to the layout parser's JSON and from there to chunk rows."""
    results = documents.process_documents(source_documents(v), ["uri"], F.col("text"))
    return documents.parse_chunks(results, ["uri"])


@query
def html_to_chunks(v: Views) -> DataFrame:
    pages = v.table("pages").select(F.col("url").alias("uri"), "html")
    return documents.chunk_documents(pages, ["uri"], documents.without_tags(F.col("html")), documents.footers(F.col("html")))


@query
def numeric_ids(v: Views) -> DataFrame:
    return documents.numeric_ids(v.document_names())


@query
def document_registry(v: Views) -> DataFrame:
    return documents.document_registry(document_chunks(v))


@query
def embedding_worklist(v: Views) -> DataFrame:
    ids = v.table("documents").select(F.col("doc_id").alias("deal_id"))
    return documents.embedding_worklist(ids, v.table("labels").select(F.col("doc_id").alias("deal_id")))


@query
def pending_deals(v: Views) -> DataFrame:
    return documents.pending_deals(v.document_names(), v.table("labels").select(F.col("doc_id").alias("deal_id")))


@query
def pending_deals_null(v: Views) -> DataFrame:
    """One NULL among the existing ids, and nothing is pending."""
    known = v.table("labels").select(F.when(F.col("quality") == 1, F.col("doc_id")).alias("deal_id"))
    return documents.pending_deals(v.document_names(), known)


@query
def embed_chunks(v: Views) -> DataFrame:
    return generation.hash_embedding(document_chunks(v)).select("uri", "id", generation.EMBEDDING)


@query
def strip_code_fences(v: Views) -> DataFrame:
    fenced = F.concat(F.lit("```json\n"), "text", F.lit("\n```"))
    return v.table("documents").select(
        "doc_id", strip_fences(fenced).alias("flat"), strip_fences(fenced, newlines=False).alias("lines")
    )


QUERIES["strip_fences"] = QUERIES.pop("strip_code_fences")


def samples(v: Views) -> DataFrame:
    sample = F.replace(F.lit(replies.JSON_SAMPLE), F.lit("@n"), number("doc_id"))
    return v.table("documents").select("doc_id", parsed(sample).alias("document"))


@query
def json_value_scalar(v: Views) -> DataFrame:
    return samples(v).select("doc_id", *[json_value(F.col("document"), f"$.{k}").alias(k) for k in "abcdefgh"])


@query
def json_extract_array(v: Views) -> DataFrame:
    elements = samples(v).select("doc_id", F.posexplode(json_array(F.col("document"), "$.c")).alias("position", "element"))
    return elements.select("doc_id", F.col("position").cast("bigint").alias("position"), F.to_json("element").alias("element"))


# ---- search and details ---------------------------------------------------------------------


@query
def vector_topk(v: Views) -> DataFrame:
    found = retrieval.vector_topk(v.vectors(), v.centroids())
    return rounded(found, 6, ["distance"]).withColumn("rank", F.col("rank").cast("bigint"))


@query
def vector_topk_by_deal(v: Views) -> DataFrame:
    found = retrieval.vector_topk(v.vectors(), v.centroids(), within=["deal_id"])
    return rounded(found, 6, ["distance"]).withColumn("rank", F.col("rank").cast("bigint"))


def stored_lists(v: Views) -> lists.StoredLists:
    base = v.vectors()
    return lists.VectorLists.train(base, lists.lists_for(base.count())).store(base, scratch(v, "lists"))


@query
def vector_topk_ivf(v: Views) -> DataFrame:
    return rounded(stored_lists(v).topk(v.centroids(), fraction=0.25), 6, ["distance"])


@query
def vector_topk_ivf_all_lists(v: Views) -> DataFrame:
    """Where every list may be searched, a bound leaves out those that cannot matter: the result is exact."""
    found = stored_lists(v).topk(v.centroids(), fraction=1.0)
    return rounded(found, 6, ["distance"]).withColumn("rank", F.col("rank").cast("bigint"))


@query
def rag_context(v: Views) -> DataFrame:
    questions = v.centroids()
    nearest = written(retrieval.vector_topk(v.vectors(), questions, within=["deal_id"]), "nearest")
    asked = {f"q{label}": f"Answer q{label}: " for label in range(10)}
    return retrieval.rag_context(nearest, v.vector_chunks(), asked, ["deal_id"])


def detail_answers(v: Views) -> DataFrame:
    """Answers to the three questions for every document; some deals lack one of them."""
    templates = F.create_map(*[F.lit(x) for pair in replies.DETAIL_TEMPLATES.items() for x in pair])
    asked = v.table("documents").select(F.col("doc_id").alias("deal_id"), F.explode(templates).alias("question", "template"))
    missing = ((F.col("question") == "summary") & (F.col("deal_id") % 7 == 0)) | (
        (F.col("question") == "deliverables") & (F.col("deal_id") % 9 == 0)
    )
    answer = F.replace("template", F.lit("@n"), number("deal_id"))
    return asked.where(~missing).select("deal_id", "question", answer.alias("answer"))


def made_details(v: Views) -> DataFrame:
    return details.parse_details(details.combine_extractions(detail_answers(v), "answer"))


@query
def combine_extractions(v: Views) -> DataFrame:
    combined = details.combine_extractions(detail_answers(v), "answer")
    return combined.select("deal_id", *[strip_fences(F.col(q), newlines=False).alias(q) for q in details.SEARCH_TEXTS])


@query
def extract_details_all(v: Views) -> DataFrame:
    return made_details(v)


def exploded(df: DataFrame, column: str) -> DataFrame:
    rows = df.select("deal_id", F.posexplode(column).alias("position", "e"))
    return rows.select("deal_id", F.col("position").cast("bigint").alias("position"), "e.*")


@query
def extract_objectives(v: Views) -> DataFrame:
    return exploded(made_details(v), "objectives")


@query
def extract_deliverables(v: Views) -> DataFrame:
    return exploded(made_details(v), "deliverables")


@query
def append_details(v: Views) -> DataFrame:
    """Two appends to one table, the second with its columns in another order."""
    path = scratch(v, "details")
    rows = made_details(v)
    tables.append(rows, path, details.DETAIL_COLUMNS)
    again = rows.where(F.col("deliverables_json").isNull()).select(*reversed(details.DETAIL_COLUMNS))
    tables.append(again, path, details.DETAIL_COLUMNS)
    return v.spark.read.parquet(path)


@query
def replicate_table(v: Views) -> DataFrame:
    source, staging, target = (scratch(v, name) for name in ("source", "staging", "target"))
    document_chunks(v).select("deal_id", "uri", "id", "content").write.parquet(source)
    tables.replicate_table(v.spark, source, staging, target)
    return v.spark.read.parquet(target)


@query
def replicate_partitions(v: Views) -> DataFrame:
    """A table by language is copied, one language changes, and the second copy writes that partition alone."""
    source, staging, target = (scratch(v, name) for name in ("source", "staging", "target"))
    rows = v.table("documents").select("doc_id", "lang", "text")
    tables.replace_partitions(rows, source, "lang")
    tables.replicate_table(v.spark, source, staging, target, by=["lang"])
    first = F.lit(rows.agg(F.min("lang")).first()[0])
    tables.replace_partitions(rows.where(F.col("lang") == first).withColumn("text", F.concat("text", F.lit("!"))), source, "lang")
    again = tables.replicate_table(v.spark, source, staging, target, by=["lang"])
    return v.spark.read.parquet(target).select("doc_id", "lang", "text", F.lit(again.partitions).cast("bigint").alias("written_again"))


def vowels(df: DataFrame) -> DataFrame:
    return generation.generate_embedding(df, replies.vowel_backend)


@query
def embed_chunks_by_backend(v: Views) -> DataFrame:
    """Chunks embedded by a model, twice over one ledger: the second run calls nothing."""
    ledger = CallLedger(scratch(v, "ledger"), model="vowels")
    chunks = written(document_chunks(v).select("uri", "id", "content"), "chunks")
    ledger.generate_embedding(chunks, replies.vowel_backend)
    found = ledger.generate_embedding(chunks, replies.no_backend)
    return found.select("uri", "id", generation.STATUS, *[F.col(generation.EMBEDDING)[i].cast("double").alias(x) for i, x in enumerate(replies.VOWELS)])


@query
def engagement_details_from_documents(v: Views) -> DataFrame:
    """Documents to chunks, vectors, search, answers and details, for all deals at once."""
    vectors = written(vowels(document_chunks(v)), "vectors")
    pending = documents.document_registry(vectors).select("deal_id")
    return engagement_details.extract_details(vectors, pending, replies.details_backend, vowels)


def deal_files(v: Views) -> str:
    """One text file per deal, its documents one after another."""
    rows, folder = scratch(v, "rows"), scratch(v, "files")
    ordered = source_documents(v).withColumn("doc_id", F.substring("uri", 5, 20).cast("bigint")).repartition("deal_id").sortWithinPartitions("deal_id", "doc_id")
    ordered.select("deal_id", "text").write.partitionBy("deal_id").text(rows)
    found = v.spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(rows).select("path").collect()
    hadoop = v.spark._jvm.org.apache.hadoop.fs
    for path in (r["path"] for r in found):
        source, place = hadoop.Path(path), hadoop.Path(f"{folder}/{path.split('deal_id=')[1].split('/')[0]}.txt")
        system = source.getFileSystem(v.spark._jsc.hadoopConfiguration())
        system.mkdirs(place.getParent())
        system.rename(source, place)
    return folder


def ingestion(v: Views) -> Ingestion:
    ledger = CallLedger(scratch(v, "ledger"), model="vowels")
    found = Ingestion(v.spark, deal_files(v), scratch(v, "ingested"), embed=lambda chunks: ledger.generate_embedding(chunks, replies.vowel_backend))
    found.run()
    return found


@query
def ingest_documents(v: Views) -> DataFrame:
    """Files to chunks through the manifest; a second run reads no file."""
    done = ingestion(v)
    again = done.run()
    return done.vectors().select(
        "deal_id", "id", "content", *[F.col(generation.EMBEDDING)[i].cast("double").alias(x) for i, x in enumerate(replies.VOWELS)],
        F.lit(again.read).cast("bigint").alias("read_again"),
    )


@query
def ingestion_registry(v: Views) -> DataFrame:
    return ingestion(v).registry()


@query
def engagement_details_job(v: Views) -> DataFrame:
    """From files to the copied details table; a second run finds no pending deal and changes nothing."""
    done = ingestion(v)
    vectors, registry = done.vectors().withColumn("uri", text("file ", number("deal_id"))), done.registry()
    target, copy = scratch(v, "details"), scratch(v, "copy")
    ledger = CallLedger(scratch(v, "ledger"), model="details")
    engagement_details.details_job(vectors, registry, replies.details_backend, target, copy, vowels, ledger=ledger)
    engagement_details.details_job(vectors, registry, replies.no_backend, target, copy, vowels, ledger=ledger)
    return v.spark.read.parquet(copy)

"""Structured engagement details out of the answers to the three document questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuslight.functions.json_text import answer_records, answer_value, parsed, strip_fences

# fixed values: answer fields of the three questions
OBJECTIVE_FIELDS = ["objective_number", "objective_details", "expected_benefit", "objective_metric"]
DELIVERABLE_FIELDS = ["deliverable_number", "deliverable_details", "deliverable_format", "acceptance_criteria"]
SUMMARY_FIELDS = {"Background": "background", "Requirements": "requirements", "Solution": "solution"}

# what is searched for in a deal's documents
SEARCH_TEXTS = {
    "objectives": "objectives of the project",
    "summary": "background, requirements and solution of the project",
    "deliverables": "contractual deliverables of the project",
}
# what the text model is asked, followed by the chunks found
INSTRUCTIONS = {
    "objectives": (
        "List up to 10 objectives of the project with their expected benefit and how each is measured. Answer "
        f"briefly, with a JSON array of objects with the fields {', '.join(OBJECTIVE_FIELDS)}. "
    ),
    "summary": (
        "Summarise the project from these passages, factually and briefly. Answer with one JSON object with "
        f"the fields {', '.join(SUMMARY_FIELDS)} and Assumptions. "
    ),
    "deliverables": (
        "List up to 10 deliverables the contract names, their form and when they count as accepted. Answer "
        f"briefly, with a JSON array of objects with the fields {', '.join(DELIVERABLE_FIELDS)}. "
    ),
}
DETAIL_COLUMNS = [
    "deal_id", "background", "requirements", "solution", "objectives", "deliverables", "objectives_json", "deliverables_json",
]


def listed(text: Column, fields: list[str]) -> Column:
    """The array in ``text`` as structs of strings, in its own order; empty when there is none."""
    rows = answer_records(parsed(text), text, "$", fields)
    shape = "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>"
    return F.coalesce(rows, F.array().cast(shape))


def combine_extractions(answers: DataFrame, text_col: str) -> DataFrame:
    """One row per deal with an answer about objectives, and its other two answers if any."""
    text = {
        question: F.max(F.when(F.col("question") == question, F.col(text_col))).alias(question)
        for question in SEARCH_TEXTS
    }
    asked = F.max(F.when(F.col("question") == "objectives", 1)).alias("asked")
    return answers.groupBy("deal_id").agg(*text.values(), asked).where(F.col("asked") == 1).drop("asked")


def parse_details(combined: DataFrame) -> DataFrame:
    """The eight columns of the details table. Fences are removed, line feeds stay."""
    bare = combined.select(
        "deal_id", *[strip_fences(F.col(q), newlines=False).alias(q) for q in SEARCH_TEXTS]
    ).withColumn("document", parsed(F.col("summary")))
    return bare.select(
        "deal_id",
        *[answer_value(F.col("document"), F.col("summary"), f"$.{key}").alias(name) for key, name in SUMMARY_FIELDS.items()],
        listed(F.col("objectives"), OBJECTIVE_FIELDS).alias("objectives"),
        listed(F.col("deliverables"), DELIVERABLE_FIELDS).alias("deliverables"),
        F.col("objectives").alias("objectives_json"),
        F.col("deliverables").alias("deliverables_json"),
    )

"""The monthly status report, from tables to report rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.operators import evidence, financials, generation, reporting, rules, spine
from statuslight.operators.bundle import PART_ITEMS
from statuslight.operators.joins import lookup_join
from statuslight.operators.ledger import CallLedger
from statuslight.session import written


@dataclass
class StatusTables:
    """Input tables; ``source`` holds the engagements. Any object with these attributes will do."""

    source: DataFrame
    companies: DataFrame
    details: DataFrame
    contacts: DataFrame
    messages: DataFrame
    docs: DataFrame
    contributions: DataFrame
    delivery_projects: DataFrame
    tasks: DataFrame
    timesheet_projects: DataFrame
    timesheets: DataFrame
    costs: DataFrame
    rates: DataFrame


class StatusReport:
    """Builds each stage from the one before.

    Stages are lazy, except the spine and its months: every evidence branch uses
    them, so they are written once when first asked for.
    """

    def __init__(
        self, tables: StatusTables, since: dt.datetime, as_of: dt.date | None = None,
        dedupe: bool = False, mode: str = "faithful", part_items: int = PART_ITEMS,
    ):
        self.tables, self.since, self.as_of = tables, since, as_of
        self.dedupe, self.mode, self.part_items = dedupe, mode, part_items

    def engagements(self) -> DataFrame:
        t = self.tables
        return spine.engagements(t.source, t.companies, t.details, self.since)

    def spine(self) -> DataFrame:
        return spine.month_spine(self.engagements(), self.as_of)

    @cached_property
    def written_spine(self) -> DataFrame:
        """The spine with ``spine_row``, a number that tells its rows apart."""
        return written(self.spine().withColumn("spine_row", F.monotonically_increasing_id()), "spine")

    @cached_property
    def months(self) -> DataFrame:
        t = self.tables
        if "written_spine" in self.__dict__:
            return written(spine.spine_months(self.written_spine, t.companies, self.dedupe), "months")
        months = spine.months_of_engagements(t.source, t.companies, t.details, self.since, self.as_of, self.dedupe)
        return written(months, "months")

    def grains(self) -> DataFrame:
        t = self.tables
        return financials.financial_grains(
            t.timesheet_projects, t.timesheets, t.costs, t.rates, self.months, self.mode
        )

    def running(self, per_company: bool = False) -> DataFrame:
        return financials.running_financials(self.grains(), per_company)

    @cached_property
    def prompt_months(self) -> DataFrame:
        """The months that a prompt is made for: those of a company name with an engagement that has a background."""
        asked = self.written_spine.where(F.col("background").isNotNull()).select(*evidence.KEYS).distinct()
        return written(self.months.join(asked, evidence.KEYS, "left_semi").select(*self.months.columns), "prompt-months")

    def items(self, kind: str, months: DataFrame | None = None) -> DataFrame:
        """The items of ``months``, by default of every month of the spine."""
        t = self.tables
        chosen = self.months if months is None else months
        if kind == "messages":
            return evidence.message_items(t.messages, t.contacts, chosen)
        if kind == "docs":
            return evidence.doc_items(t.docs, chosen)
        if kind == "meetings":
            return evidence.meeting_items(t.contributions, chosen)
        if kind == "comments":
            return evidence.comment_items(t.contributions, chosen)
        if kind == "tasks":
            return evidence.task_items(t.tasks, t.delivery_projects, chosen, self.as_of)
        if kind == "financials" and months is not None:  # running totals need the months before as well
            return financials.financial_items(self.running().join(months.select(*evidence.KEYS).distinct(), evidence.KEYS, "left_semi"))
        if kind == "financials":
            return financials.financial_items(self.running())
        raise KeyError(kind)

    def bundle(self, kind: str) -> DataFrame:
        return evidence.bundle_of(self.items(kind), kind, self.part_items)

    def evidence(self) -> DataFrame:
        """The bundles of the months that a prompt is made for; the others are joined to no prompt."""
        return evidence.gather([self.items(kind, self.prompt_months) for kind in evidence.OUTPUTS], self.part_items)

    @cached_property
    def written_evidence(self) -> DataFrame:
        """The bundles for a job that makes prompts more than once; they grow as the items, and prompts as that times the engagements."""
        return written(self.evidence(), "evidence")

    def prompts(self) -> DataFrame:
        rows = self.written_spine
        return reporting.assemble_prompt(rows, self.evidence())

    def prompts_again(self, chosen: DataFrame) -> DataFrame:
        """The prompts of some spine rows and parts: ``spine_row, prompt_part``."""
        parts = chosen.groupBy("spine_row").agg(F.collect_list("prompt_part").alias("__parts"))
        rows = lookup_join(self.written_spine, parts, ["spine_row"], how="inner")
        made = reporting.assemble_prompt(rows, self.written_evidence, keep=["__parts"])
        return made.where(F.array_contains("__parts", F.col("prompt_part"))).drop("__parts")

    def answers(
        self, backend: Callable[[], generation.TextBackend] | None = None, callers: int | None = None, ledger: CallLedger | None = None
    ) -> DataFrame:
        """An answer to every prompt: by the backend, or by fixed rules over the evidence without one.

        Answers are written, without their prompts, which go to the backend as they are made:
        together they grow as the engagements of a company name times its evidence. With a
        ``ledger`` every answered batch is kept there, so that a run that breaks off repeats no
        call that was answered; prompts are made once for their keys and once for the calls.
        """
        if backend is None:
            rows = reporting.assemble_evidence(self.written_spine, self.evidence())
            keep = [*reporting.PROMPT_COLUMNS, generation.RESULT, generation.STATUS]
            return written(rules.rule_answers(rows).select(*keep), "answers")
        if ledger is not None:
            prompts = reporting.assemble_prompt(self.written_spine, self.written_evidence, keep=["spine_row"])
            answers = ledger.generate_text_in_place(
                prompts, self.prompts_again, ["spine_row", "prompt_part"], backend, generation.REPORT_OPTIONS, callers=callers
            )
            return answers.drop("spine_row")
        return written(generation.generate_text(self.prompts(), backend, generation.REPORT_OPTIONS, callers=callers, keep=reporting.PROMPT_COLUMNS), "answers")

    def report(
        self, backend: Callable[[], generation.TextBackend] | None = None, callers: int | None = None, ledger: CallLedger | None = None
    ) -> DataFrame:
        """One row per engagement and month; a month whose evidence fills several prompts is merged from their answers."""
        if backend is None:
            return self.ruled_report()
        answers = self.answers(backend, callers, ledger)
        last_part = answers.agg(F.max("prompt_part")).first()[0] or 0
        return reporting.merged_report(answers, generation.RESULT, last_part)

    def ruled_report(self) -> DataFrame:
        """The report by fixed rules.

        The rules look at the evidence alone, which all engagements of a company name share in
        a month. Each part of it is answered and merged once: as many answers as evidence, and
        not that times the engagements.
        """
        asked = self.written_spine.where(F.col("background").isNotNull())
        months = asked.select(*evidence.KEYS, F.lit(True).alias("background")).distinct()
        ruled = rules.rule_answers(reporting.assemble_evidence(months, self.evidence()))
        answers = written(ruled.select(*evidence.KEYS, "prompt_part", generation.RESULT, generation.STATUS), "answers")
        last_part = answers.agg(F.max("prompt_part")).first()[0] or 0
        return reporting.shared_report(asked, answers, generation.RESULT, last_part)

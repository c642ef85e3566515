"""Bundles are whole, ordered, valid JSON, and split at the part size only."""

import json

import pytest
from pyspark.sql import functions as F

from statuslight.operators.bundle import bundle

KEYS = ["company_name", "engagement_month"]


@pytest.fixture(scope="module")
def items(spark):
    """One group with most items, a run of 500 copies in it, a NULL-named group, two kinds."""
    base = spark.range(600).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, "small").otherwise("big").alias("company_name"),
        F.lit("2001-01-01").cast("date").alias("engagement_month"),
        F.when(F.col("id") % 4 == 0, "docs").otherwise("messages").alias("kind"),
        F.lpad((F.col("id") * 7 % 90).cast("string"), 3, "0").alias("sort_key"),
        F.to_json(F.struct("id")).alias("item"),
        F.when(F.col("id") == 1, 500).otherwise(F.col("id") % 3 + 1).cast("bigint").alias("copies"),
    )
    return base


def expected(items):
    groups = {}
    for r in items.collect():
        groups.setdefault((r.company_name, r.kind), []).extend([(r.sort_key, r.item)] * r.copies)
    out = {}
    for (name, kind), found in groups.items():
        found.sort(key=lambda x: x[1])
        found.sort(key=lambda x: x[0], reverse=kind == "messages")
        out[name, kind] = [json.loads(i) for _, i in found]
    return out


@pytest.mark.parametrize("part_items", [10_000, 100, 7])
def test_parts_make_the_whole(items, part_items):
    result = bundle(items, KEYS, {"messages": "m", "docs": "d"}, {"docs"}, part_items)
    want = expected(items)
    seen = {}
    for r in sorted(result.collect(), key=lambda r: r.part):
        for kind, text in (("messages", r.m), ("docs", r.d)):
            if text is not None:
                part = json.loads(text)
                assert 0 < len(part) <= part_items
                seen.setdefault((r.company_name, kind), []).append(part)
    assert {k: [i for p in parts for i in p] for k, parts in seen.items()} == want
    for parts in seen.values():
        assert all(len(p) == part_items for p in parts[:-1])


@pytest.mark.parametrize("part_items", [100, 7])
def test_groups_too_large_for_a_task_make_the_same_parts(items, part_items):
    kinds = {"messages": "m", "docs": "d"}
    ranked, cut = (bundle(items, KEYS, kinds, {"docs"}, part_items, hot_rows=n) for n in (10_000, 50))
    shown = [sorted(map(tuple, df.select("company_name", "part", "m", "d").collect()), key=str) for df in (ranked, cut)]
    assert shown[0] == shown[1] and len(shown[0]) > 10


def test_items_are_placed_by_one_shuffle(items, tmp_path):
    items.write.parquet(f"{tmp_path}/items")
    stored = items.sparkSession.read.parquet(f"{tmp_path}/items")
    plan = bundle(stored, KEYS, {"messages": "m", "docs": "d"}, {"docs"}, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1

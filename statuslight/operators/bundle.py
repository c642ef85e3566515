"""JSON array bundles: one ordered array of records per group, in bounded pieces.

Items are rows ``(*keys, kind, sort_key, item, copies)``: ``item`` is the JSON text
of one record, ``copies`` says how often it occurs in the array.

A group of up to ``part_items`` items is one array (part 0). A larger group, which
can hold a large share of all items, is split by exact rank into arrays of
``part_items`` items: parts 0, 1, 2 ... Their concatenation is the whole array, and
no task ever holds more than one part of it. ``part_items`` times the longest item
has to fit in one cell; 5,000 items of 40,000 characters are 200 MB.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuslight.operators.joins import HOT_ROWS
from statuslight.operators.running import running_sums
from statuslight.session import written

PART_ITEMS = 5_000


def bundle(
    items: DataFrame,
    keys: list[str],
    outputs: dict[str, str],
    ascending: set[str] | None = None,
    part_items: int = PART_ITEMS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(*keys, part, <one array per kind>)``.

    ``outputs`` maps each kind to its column. Arrays are ordered by ``sort_key``,
    latest first except for kinds in ``ascending``, ties by the item text. All kinds
    are gathered in one shuffle on the keys.
    """
    rising = ascending or set()
    placed = _placed(items, keys, rising, part_items, hot_rows)
    arrays = []
    for kind, column in outputs.items():
        direction = "ASC NULLS FIRST" if kind in rising else "DESC NULLS LAST"
        arrays.append(
            F.concat(
                F.lit("["),
                F.expr(
                    f"listagg(text, ',') WITHIN GROUP (ORDER BY sort_key {direction}, item)"
                    f" FILTER (WHERE kind = '{kind}')"
                ),
                F.lit("]"),
            ).alias(column)
        )
    text = F.array_join(F.array_repeat("item", F.col("copies").cast("int")), ",")
    return placed.withColumn("text", text).groupBy(*keys, "part").agg(*arrays)


def _placed(items: DataFrame, keys: list[str], rising: set[str], part_items: int, hot_rows: int) -> DataFrame:
    """Give every item its part number.

    The sizes of the groups need the keys alone. Where one exceeds a part, the items are
    shuffled once, on the keys, and ranked in order within their groups; the bundles then
    are made where the items lie. Only groups of more than ``hot_rows`` rows, too many for
    one task to rank, are cut by ranges.
    """
    group = [*keys, "kind"]
    sizes = items.groupBy(*group).agg(F.sum("copies").alias("group_items"), F.count("*").alias("group_rows"))
    most = sizes.agg(F.max("group_items").alias("items"), F.max("group_rows").alias("rows")).first()
    if most["items"] is None or most["items"] <= part_items:
        return items.withColumn("part", F.lit(0).cast("bigint"))
    if most["rows"] <= hot_rows:
        return _ranked(items, keys, rising, part_items)

    items = written(items, "items")  # read once for each way of placing them
    sizes = items.groupBy(*group).agg(F.count("*").alias("group_rows"))
    found = sizes.where(F.col("group_rows") > hot_rows).collect()  # each stands for ``hot_rows`` rows
    hot = F.broadcast(items.sparkSession.createDataFrame(found, sizes.schema).withColumnsRenamed({name: f"__{name}" for name in group}))
    match = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in group])
    placed = _ranked(items.join(hot, match, "left_anti"), keys, rising, part_items)
    kinds = {row["kind"] for row in found}
    for down in (True, False):
        chosen = sorted(k for k in kinds if (k not in rising) == down)
        if chosen:
            part = _paged(items.join(hot, match, "left_semi").where(F.col("kind").isin(chosen)), group, down, part_items)
            placed = placed.unionByName(part.select(*placed.columns))
    return placed


def _ranked(items: DataFrame, keys: list[str], rising: set[str], part_items: int) -> DataFrame:
    """Rank within groups that a task can sort, all of them after one shuffle on the keys."""
    goes_up = F.col("kind").isin(sorted(rising))
    order = [
        F.when(goes_up, F.col("sort_key")).asc_nulls_first(), F.when(~goes_up, F.col("sort_key")).desc_nulls_last(), F.col("item").asc_nulls_first(),
    ]
    so_far = W.partitionBy(*keys, "kind").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = items.repartition(*keys).withColumn("copies_to_date", F.sum("copies").over(so_far))
    return _cut(ranked, part_items).select(*items.columns, "part")


def _paged(items: DataFrame, group: list[str], down: bool, part_items: int) -> DataFrame:
    """Split runs of equal items at the part boundaries by exact rank."""
    runs = items.groupBy(*group, "sort_key", "item").agg(F.sum("copies").alias("copies"))
    ranked = running_sums(
        runs, ["sort_key", "item"], ["copies"], partition_by=group,
        descending={"sort_key"} if down else set(),
    )
    return _cut(ranked, part_items)


def _cut(ranked: DataFrame, part_items: int) -> DataFrame:
    """Runs of equal items as one row per part that they reach into."""
    size = F.lit(part_items).cast("bigint")
    begin = F.col("copies_to_date") - F.col("copies")
    end = F.col("copies_to_date")
    spans = ranked.withColumns({"begin": begin, "end": end}).withColumn(
        "part", F.explode(F.sequence(F.floor(F.col("begin") / size), F.floor((F.col("end") - 1) / size)))
    )
    inside = F.least("end", (F.col("part") + 1) * size) - F.greatest("begin", F.col("part") * size)
    return spans.withColumn("copies", inside).drop("begin", "end", "copies_to_date")

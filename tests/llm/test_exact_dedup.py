from collections import defaultdict

import pytest
from tests.llm.conftest import AWKWARD

from statuslight.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    norm = {i: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for i, t in rows}
    for i, _ in rows:
        groups[norm[i]].append(i)
    return sorted((i, max(groups[norm[i]]), len(groups[norm[i]]), i == max(groups[norm[i]])) for i, _ in rows)


@pytest.mark.parametrize("width", [1, 64])
def test_awkward_rows_match_brute_force(awkward, width):
    found = exact_dedup.exact_dedup(awkward, first_width=width, growth=2 if width == 1 else 4).collect()
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found)
    assert got == brute([(i, t) for i, t in AWKWARD if i is not None])


def test_empty_table(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_kept_documents_have_one_row_per_text(awkward):
    kept = exact_dedup.kept_documents(awkward, exact_dedup.exact_dedup(awkward))
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 7, 8, 9, 10, 11, 12, 13, 15, 16, 17, 18]


def test_an_id_with_several_texts_keeps_each_that_stays(spark):
    rows = [(1, "first", "a"), (1, "second", "b"), (2, "First", "c"), (2, "First", "c"), (3, None, "d"), (4, "É", "e"), (5, "é", "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rep string")
    kept = exact_dedup.kept_documents(docs, exact_dedup.exact_dedup(docs))
    assert sorted(map(tuple, kept.collect())) == [(1, "second", "b"), (2, "First", "c"), (3, None, "d"), (4, "É", "e"), (5, "é", "f")]

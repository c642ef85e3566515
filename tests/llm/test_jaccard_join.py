import random

import numpy as np
import pytest
from tests.llm.conftest import AWKWARD

from statuslight.llm import jaccard_join as jj


def brute(rows):
    """``doc_id: (set size, smallest doc_id reachable)`` by comparing all pairs of sets."""
    sets = {}
    for i, t in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = top(ids[x]), top(ids[y])
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus(seed, n=160):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passages = [" ".join(rnd.choices(words, k=60)) for _ in range(3)]
    rows = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.5 and rows:
            text = rnd.choice(rows)[1].split()
            for _ in range(rnd.randint(0, 5)):
                if text:
                    text[rnd.randrange(len(text))] = rnd.choice(words)
            text = text[: len(text) - rnd.randint(0, 8)] if rnd.random() < 0.3 else text
            rows.append((i, " ".join(text)))
        else:
            body = " ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 5, 20, 80, 200])))
            rows.append((i, f"{rnd.choice(passages)} {body}" if rnd.random() < 0.4 else body))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    monkeypatch.setattr(jj, "BUCKET", 300)
    found = jj.jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert len({r.component_id for r in found}) < len(rows)


def test_awkward_rows(awkward, nothing):
    found = jj.jaccard_groups(awkward).collect()
    rows = [(i, t) for i, t in AWKWARD if i is not None]
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert jj.jaccard_groups(nothing).count() == 0


def test_an_id_with_several_texts_is_linked_to_equal_sets_only(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words)), (1, "other words " + " ".join(words)), (2, " ".join(words)), (3, " ".join(words[:39]))]
    found = jj.jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles) for r in found) == [(1, 36), (1, 38), (2, 36), (3, 35)]
    assert all(r.component_id == 1 for r in found if (r.doc_id, r.n_shingles) == (2, 36))


@pytest.mark.parametrize("n", [1, 4, 5, 50, 333])
def test_partners_share_as_many_prefix_shingles_as_asked(n):
    rnd = np.random.default_rng(n)
    counts = np.sort(rnd.integers(2, 50, n))
    length, asked = jj.prefix_length(n, counts)
    least = jj._least(n)
    assert length == n - least + asked and 1 <= asked <= min(jj.LONGEST_MATCH, least)
    assert jj.prefix_length(n, counts[: least - 1]) == (0, 0) or least == 1


def test_costly_prefixes_are_lengthened():
    cheap, costly = np.full(100, 2), np.r_[np.full(21, 1000), np.full(79, 1001)]
    assert jj.prefix_length(100, costly)[1] > 1
    assert jj.prefix_length(100, cheap)[1] >= 1

import re

import pytest

from statuslight.llm import licenses as li
from tests.llm.conftest import AWKWARD

TEMPLATE = 'Use of <<beginOptional>>the <<beginOptional>>whole <<endOptional>>work<<endOptional>> by <<var;match=".{1,20}">> is free'


@pytest.mark.parametrize("text,ok", [
    ("Use of by Ann is free", True), ("USE OF the work, by Ann and Bob; is free.", True), ("use of the whole work by x is free", True),
    ("use of whole work by x is free", False), ("use of by is free", False), ("use of by Ann was free", False),
    ("use of by Ann is free now", False), ("use of by a name that is far too long here is free", False), ("", False),
])
def test_mandatory_wording_is_matched_exactly(text, ok):
    assert li.accepts(TEMPLATE, text) is ok


@pytest.mark.parametrize("bad", ["a <<endOptional>>", "<<beginOptional>> a", "a <<var;name=\"x\">>", "a <<other>>"])
def test_bad_markup_raises(bad):
    with pytest.raises(ValueError):
        li.compile_template(bad)


def test_an_optional_region_that_starts_with_a_mandatory_word():
    template = "a <<beginOptional>>b <<endOptional>>b c"
    assert [li.accepts(template, t) for t in ("a b c", "a b b c", "a c", "a b b b c")] == [True, True, False, False]


@pytest.mark.parametrize("text,label", [
    ("x released under the MIT License. y", "mit-notice"), ("This software is licensed under the terms of the MIT license", "mit-notice"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\")", "apache-notice"), ("released under CC BY 4.0", "cc-by-notice"),
    ("under the terms of the GNU General Public License", "gpl-notice"), ("under the terms of version 2 of the GNU Lesser General Public License", "gpl-notice"),
    ("Copyright (c) 2001 Some Body. All rights reserved.", "copyright-reserved"), ("mit license", None), ("under the GNU General License", None),
])
def test_templates_inside_texts(text, label):
    assert li.Scanner().scan(f"before {text} after".encode())[3] == ([label] if label else [])


def slow(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in li.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_rows_match_brute_force(spark, small, awkward, nothing):
    odd = spark.createDataFrame([(5000, "CC-BY cc by cc BY ALL Rights reserved, General\nPublic License général public license")], "doc_id bigint, text string")
    for table in (spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").unionByName(odd), awkward):
        found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in li.scan_licenses(table).collect()), key=str)
        assert found == sorted(((r.doc_id, *slow(r.text)) for r in table.collect() if r.doc_id is not None), key=str)
    assert li.scan_licenses(nothing).count() == 0
    assert len(AWKWARD) == awkward.count()


@pytest.mark.parametrize("holder,label", [
    ("a b c d e f g h i j k l m", True), (" ".join("x" * 40), True), (" ".join("x" * 41), False), ("y" * 80, True), ("y" * 81, False),
])
def test_replaceable_runs_are_as_long_as_their_match(spark, holder, label):
    texts = spark.createDataFrame([(1, f"So: Copyright (c) 2001 {holder} All rights reserved.")], "doc_id bigint, text string")
    row = li.scan_licenses(texts).first()
    assert (row.labels, row.score) == (("copyright-reserved,reserved", 1.0) if label else ("reserved", 0.5))


def test_runs_without_a_bound():
    text = f"grant to {'someone and ' * 200}ends here"
    assert li.Scanner({}, {"g": 'grant to <<var;match=".+">> ends here'}).scan(text.encode())[3] == ["g"]


def test_scans_with_nested_and_without_mandatory_regions(spark):
    templates = {"nested": TEMPLATE, "twice": 'x <<beginOptional>>p <<beginOptional>>q <<beginOptional>>rrrrrr <<endOptional>><<endOptional>>s<<endOptional>> y',
                 "either": '<<var;match="(one|two)">> <<beginOptional>>more<<endOptional>>'}
    texts = ["now use of by Ann is free.", "use of the whole work by Ann is free", "x y", "x p s y", "x p q s y", "x p q rrrrrr s y", "x p rrrrrr s y", "one"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.labels for r in li.scan_licenses(rows, {}, templates).collect()}
    assert [found[i] for i in range(8)] == ["nested"] * 2 + ["twice"] * 4 + ["", "either"]
    assert li.compile_template(TEMPLATE).needed() == b"free"

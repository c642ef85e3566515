import os

import pytest

AWKWARD = [
    (1, None), (2, ""), (3, "One two three four five six seven."), (4, "one TWO three four five six seven."),
    (5, "One two three four five six seven."), (5, "One two three four five six seven."), (6, "a"), (7, "A"),
    (8, " \n\t "), (9, "é" * 50), (10, "É" * 50), (11, "x" * 64), (12, "x" * 64 + "y"), (13, "x" * 64 + "z"),
    (14, "long word " * 20_000), (15, "long word " * 20_000 + "."), (16, "long word " * 20_000), (None, "without id"),
    (17, "𝄞 uncommon ▁ signs \x00 and  blanks  "), (18, None),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "x", 1, 2.0, "label") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, rep string, n int, score double, label string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def words():
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    return lambda t: WORD.findall(lower(t or ""))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    long_text = " ".join(f"word{i % 977} tail{i % 31}" for i in range(60_000))
    rows = [(1, "one two three four five", "en", "a", 5), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "  \n\t ", "de", "b", 5), (5, "one two three four five", "en", "a", 5), (5, "one two three four five", "en", "a", 5), (6, long_text, "fr", "c", 1), (7, "Ünïcödé 漢字   x\x1cy", "es", "d", 2), (8, "two", None, "d", 2), (None, "no id here at all", "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 as score", "'x' as held", "2 as n", "3 as rep", "4 as block", "'y' as _text")

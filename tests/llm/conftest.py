"""Rows that every operator has to cope with."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, key double, taken string, size long"

LINE = "Wonderful morning rain over the quiet harbour town and its old mill by the river bend\n"
ODD = [
    (None, "a text without an id", "en", "s1"),
    (1, None, None, None),
    (2, "", "en", None),
    (3, " \t\n ", None, "s2"),
    (4, "word", "en", "s1"),
    (5, LINE * 3, "en", "s1"),
    (5, LINE * 3, "en", "s1"),
    (6, "Ärger mit 😀 und ﬁ " * 40, "de", "s2"),
    (6, "another text of the same id", "de", "s2"),
    (7, "x" * 30_000, "en", "s1"),
    (8, LINE * 1500, "en", "s1"),
    (9, "a mail to me@example.com, +49 30 1234567, 10.0.0.1 and 4785380592391139", "en", "s3"),
    (10, "pairs | of | words | and # signs " * 30, "en", "s3"),
    (2**62, "a far id   with odd   spaces \x1c\x85 in it <|endoftext|> end", "fr", "s1"),
    (-5, "a negative id", "fr", "s1"),
]


@pytest.fixture
def odd(spark):
    rows = [(*r, len(r[1] or ""), 1, 0.5, "t", 3) for r in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.fixture
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture
def listed():
    return pairs

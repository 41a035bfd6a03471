from __future__ import annotations

import re

import pytest

find = re.compile(r"[^\x20\x09-\x0D]+").findall
lower = lambda text: re.sub("[A-Z]", lambda m: m[0].lower(), text)

LONG = " ".join(f"wort{i * 7919 % 4001}" for i in range(6000))
NEAR = " ".join(f"w{i}" for i in range(200))
ROWS = [
    (1, "Hello World, hello", "en", "a", 7), (2, "hello world, HELLO", "en", "a", 7), (3, None, None, None, None), (4, "", "de", "b", 0),
    (5, LONG, "de", "b", 1), (6, LONG, "de", "b", 1), (7, LONG + " x", "de", "b", 1), (8, "ÄÖ É", "fr", "b", 1),
    (9, "äö é", "fr", "b", 1), (10, NEAR, "en", "c", 1), (11, NEAR + " tail", "en", "c", 1), (12, " \n\t ", "en", "c", 1),
    (13, "one two", "en", "c", 1), (13, "one two", "en", "c", 1), (None, "no id", "en", "c", 1), (None, "hello world, hello", "en", None, 1),
    (14, "a b c d e f\n" * 40, "en", "a", 1), (15, "x # y $ z | <b> " * 30, "en", "a", 1), (16, "'s 's don't  I'LL\x0b  q r", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, keep_id long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, copies, repeated rows and a column named like a result."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}

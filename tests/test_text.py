from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from solstrand.functions import text

ADDRESSES = [
    ("a@b.co", True),
    ("A.b+c%d@x-y.org", True),
    ("a@b.co\n", True),  # one final newline is let through
    ("a@b.co\n\n", False),
    ("a@b.co\r\n", False),
    ("a@b", False),
    ("a@b.c", False),
    ("a@@b.co", False),
    (" a@b.co", False),
    ("a@b.co extra", False),
    ("é@b.co", False),
    ("", False),
    (None, False),
]


def test_email_addresses(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ADDRESSES)], "i int, a string")
    got = {r["i"]: r["ok"] for r in df.select("i", text.is_email(F.col("a")).alias("ok")).collect()}
    assert got == {i: ok for i, (_, ok) in enumerate(ADDRESSES)}


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("https://m.example.com/x?y=1#z", "m.example.com"),
        ("/relative/path", None),
        ("not a url", None),
        ("", None),
        (None, None),
    ],
)
def test_url_host(spark, url, host):
    df = spark.createDataFrame([(url,)], "u string")
    row = df.select(text.url_host(F.col("u")), text.url_validity(F.col("u"))).first()
    assert tuple(row) == (host, "VALID" if host else None)


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ('"2024-01-02T03:04:05Z"', "2024-01-02 03:04:05"),
        ("2024-01-02", "2024-01-02 00:00:00"),
        ("yesterday", None),
        ("", None),
        (None, None),
    ],
)
def test_clean_timestamp(spark, value, want):
    df = spark.createDataFrame([(value,)], "t string")
    got = df.select(text.clean_timestamp(F.col("t")).cast("string")).first()[0]
    assert got == want

"""WARC archives: written, indexed, searched and read back."""

import base64
import gzip
import hashlib
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from momentloom.llm import warc
from momentloom.llm.common import shared_folder

FIELDS = "page_id long, url string, html string, key string, digest string"
PAGES = [
    (1, "https://Blog.Example.com:443/a?b=c#d", "<p>same</p>"),
    (2, "http://example.com", "<p>same</p>"),
    (3, "http://user@other.org/x y\r\nz", "<p>é 😀</p>\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n"),
    (4, None, None),
    (5, "", ""),
    (6, "http://example.com", "<p>other</p>"),
    (6, "http://example.com", "<p>other</p>"),
    (None, "http://example.com", "<p>no id</p>"),
    (None, "http://example.com", "<p>no id</p>"),
    (None, "http://example.com/same", "<p>same</p>"),
    (-7, "http://example.com/" + "long" * 2000, "x" * 300_000),
]


@pytest.fixture
def place(spark):
    return f"{shared_folder(spark)}/test-{uuid4().hex}"


def expected(rows, least=0):
    head = {}
    for i, _, h in rows:
        h = h or ""
        head[h] = max((x for x in (head.get(h), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        h = h or ""
        raw = h.encode()
        revisit = len(raw) >= least and head[h] is not None and i != head[h]
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", head[h] if revisit else None, b"" if revisit else raw))
    return sorted(out, key=str)


def test_archives_are_readable_member_by_member(spark, place):
    """Any reader of gzip sees the records one after another."""
    warc.write_archives(spark.createDataFrame([(1, "http://a.b/", "<p>é</p>", "", "")], FIELDS), "page_id", "url", "html", place)
    path = spark.read.parquet(f"{place}/captures").first()["file"].removeprefix("file:")
    text = gzip.open(path).read().decode()
    assert text.startswith("WARC/1.0\r\nWARC-Type: response\r\n") and text.endswith("\r\n\r\n<p>é</p>\r\n\r\n")


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(spark, place, least):
    df = spark.createDataFrame([(*r, "x", "x") for r in PAGES], FIELDS)
    warc.write_archives(df, "page_id", "url", "html", place, least, most=500)
    warc.write_index(spark, place, block=2)
    keys = df.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    found = warc.look_up(spark, place, keys).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in found]
    assert sorted(got, key=str) == expected(PAGES, least)
    missing = spark.createDataFrame([("com,example)/ none",), ("",), (None,), ("zzz",)], "key string")
    assert warc.look_up(spark, place, missing).collect() == []


def test_empty_table(spark, place):
    df = spark.createDataFrame([], FIELDS)
    warc.write_archives(df, "page_id", "url", "html", place)
    warc.write_index(spark, place)
    assert warc.look_up(spark, place, spark.createDataFrame([("x",)], "key string")).collect() == []


def test_damage_is_noticed(spark, place):
    df = spark.createDataFrame([(1, "http://a.b/", "<p>hello</p>", "", "")], FIELDS)
    warc.write_archives(df, "page_id", "url", "html", place)
    warc.write_index(spark, place)
    path = spark.read.parquet(f"{place}/captures").first()["file"].removeprefix("file:")
    with open(path, "r+b") as file:
        file.seek(60)
        file.write(b"damage")
    with pytest.raises(Exception, match="damaged record"):
        warc.look_up(spark, place, spark.createDataFrame([("b,a)/ 00000000000000000001",)], "key string")).collect()


def test_url_keys(spark):
    rows = spark.createDataFrame([(r[1],) for r in PAGES[:6]], "u string").select(warc.url_key(F.col("u")).alias("k")).collect()
    assert [r["k"] for r in rows] == ["com,example,blog)/a?b=c", "com,example)/", "org,other)/x%20y%20%20z", "", "", "com,example)/"]

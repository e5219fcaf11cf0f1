"""WARC archives and the merged index, against the pages themselves."""

import base64
import hashlib
import random

import pytest

from conftest import TESTDATA
from parcelmart.llm import queries
from parcelmart.llm import warc_index as m
from parcelmart.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, record string"


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload, least = (html or "").encode(), first.get(html or "")
        copy = least is not None and (page_id is None or least < page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if copy else "response", least if copy else None))
    return sorted(out, key=str)


def index(spark, rows):
    folder = shared_path(spark, "test-warc")
    m.write_archives(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), folder)
    return m.capture_index(spark, folder).collect()


def test_query_equals_the_pages(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    found = queries.op7_warc_index(spark, sf_dir).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected(pages)
    order = [(r.url_key, r.captured, r.page_id) for r in found]
    assert order == sorted(order)


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(m, "FILE_RECORDS", 3)
    odd = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nContent-Length: 3 \udbff".encode("utf-8", "ignore").decode()
    rows = [
        (5, "https://www.A.example.org:443/X?q=1", odd),
        (9, "http://a.example.org/x?q=1", odd),
        (2, None, None),
        (3, "http://b.example.org", ""),
        (None, "http://c.example.org/\r\nWARC-Type: x", odd),
        (None, "http://d.example.org/", "only here é"),
        (7, "u", "twice"),
        (7, "u", "twice"),
        (11, "http://long.example.org/", "é" * (m.LONG_BYTES + 1)),
        (12, "http://long.example.org/", "é" * (m.LONG_BYTES + 1)),
    ]
    found = index(spark, rows)
    assert sorted((tuple(getattr(r, c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found), key=str) == expected(rows)
    assert len({r.file for r in found}) > 3


def test_empty_table(spark):
    assert index(spark, []) == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merges(k):
    draw = random.Random(k)
    runs = [sorted((draw.randint(0, 50), i, n) for n in range(draw.randint(0, 30))) for i in range(k)]
    assert list(m.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_url_key():
    assert m.url_key("https://www.Shop.example.org:443/A?b=C") == "org,example,shop)/a?b=c"
    assert m.url_key("http://example.org") == "org,example)/"
    assert m.url_key(None) == ""

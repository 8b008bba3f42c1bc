import base64
import hashlib

import pytest

from sequoir.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, sha string, keeper long"


def pages(spark, data=None):
    rows = [
        (5, "http://a.example.com/x?y#z", "<p>same</p>", "d", "s", 1),
        (3, "https://B.example.com:8080/", "<p>same</p>", None, None, None),
        (9, None, "<p>same</p>", None, None, None),
        (1, "no scheme", None, None, None, None),
        (2, "http://a.example.com/x?y", "", None, None, None),
        (7, "http://a.example.com/é\r\nX: y", "größe " * 50_000, None, None, None),
        (8, "http://a.example.com/only", "\r\n\r\nWARC/1.1\r\n\r\n", None, None, None),
        (8, "http://a.example.com/only", "\r\n\r\nWARC/1.1\r\n\r\n", None, None, None),
        (None, "http://a.example.com/none", "<p>same</p>", None, None, None),
        (None, "http://z.example.com/none", "alone without id", None, None, None),
    ]
    return spark.createDataFrame(rows if data is None else data, SCHEMA), rows


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def slow(rows):
    keep = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            keep[html or ""] = min(page_id, keep.get(html or "", page_id))
    out = []
    for page_id, _, html, *_ in rows:
        k = keep.get(html or "")
        again = k is not None and page_id != k
        out.append((page_id, len((html or "").encode()), sha(html), "revisit" if again else "response", k if again else None))
    return sorted(out, key=str)


def test_round_trip_against_slow_version(spark):
    df, rows = pages(spark)
    assert sorted((tuple(r) for r in warc.round_trip(df).collect()), key=str) == slow(rows)
    assert warc.round_trip(pages(spark, [])[0]).count() == 0


def test_small_payloads_are_all_responses(spark):
    df, _ = pages(spark)
    kinds = {(r.payload_bytes, r.record_type) for r in warc.round_trip(df, min_bytes=12).collect()}
    assert {k for n, k in kinds if n < 12} == {"response"}


def test_lookup_by_bisection(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 2)
    data = [(k, f"http://h{k % 7}.example.com/p{k // 2}", f"page {k}", None, None, None) for k in range(120)]
    captures, top = warc.archive(spark, spark.createDataFrame(data, SCHEMA))
    asked = [f"https://h{k % 7}.example.com/p{k // 2}" for k in (0, 1, 17, 60, 119)] + ["http://no.example.com/", "http://zzz/"]
    found = sorted((r.surt, r.page_id) for r in warc.lookup(spark.createDataFrame([(u,) for u in asked], "url string"), top).collect())
    keys = {warc.surt(u) for u in asked}
    assert found == sorted((warc.surt(u), k) for k, u, *_ in data if warc.surt(u) in keys)
    assert warc.all_captures(top).count() == captures.count() == 120


def test_one_key_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 3)
    data = [(k, "http://hot.example.com/", f"page {k}", None, None, None) for k in range(40)] + [(100, "http://a.b/", "x", None, None, None)]
    _, top = warc.archive(spark, spark.createDataFrame(data, SCHEMA))
    assert warc.lookup(spark.createDataFrame([("http://hot.example.com/",)], "url string"), top).count() == 40


def test_keys():
    assert warc.surt("https://user@M.Example.com:81/a/b?q=1#f") == "com,example,m:81)/a/b?q=1"
    assert warc.surt("http://x.org") == "org,x)/"
    assert warc.surt(None) == ""


def test_damage_is_seen():
    good = warc.record(1, "http://a/", b"body", sha("body"), None, False)
    assert warc.parse_record(good)[2] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(good[:-1])
    assert b"body" not in warc.record(2, None, b"body", sha("body"), 1, True)


def test_the_query_goes_through_the_index(spark, monkeypatch):
    """Records are found by the URLs of the pages; archives and index are gone afterwards."""
    import os

    df, rows = pages(spark)
    asked, folders = [], []
    monkeypatch.setattr(warc, "lookup", lambda urls, top, f=warc.lookup: asked.append(top.count()) or f(urls, top))
    monkeypatch.setattr(warc, "new_folder", lambda s, f=warc.new_folder: folders.append(f(s)) or folders[-1])
    assert warc.round_trip(df).count() == len(rows)
    assert asked and not os.path.exists(folders[0].removeprefix("file://"))


def test_many_repeats_are_joined(spark, monkeypatch):
    monkeypatch.setattr(warc, "SENT_REPEATS", 0)
    df, rows = pages(spark)
    assert sorted((tuple(r) for r in warc.round_trip(df).collect()), key=str) == slow(rows)


def test_a_revisit_needs_its_response(spark):
    rows = [(1, 4, "A", "response", None), (2, 4, "A", "revisit", 1), (3, 4, "A", "revisit", 9)]
    with pytest.raises(Exception, match="no response for the revisit of page 9"):
        warc.resolved(spark.createDataFrame(rows, warc.PAYLOADS)).collect()
    good = warc.resolved(spark.createDataFrame(rows[:2], warc.PAYLOADS)).collect()
    assert sorted(tuple(r) for r in good) == rows[:2]

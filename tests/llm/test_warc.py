"""Archives: exact round trip, revisits, and look-ups by the two-level index."""

import base64
import hashlib
import os
import random

import pytest

from patchloom.llm import warc
from patchloom.session import fresh_path

PAGES = "page_id long, url string, html string, digest string"


def plain(rows):
    best = {}
    for i, _, h, _ in rows:
        h = h or ""
        best[h] = max(best.get(h) if best.get(h) is not None else -1, -1 if i is None else i)
    count = {}
    for _, _, h, _ in rows:
        count[h or ""] = count.get(h or "", 0) + 1
    out = []
    for i, _, h, _ in rows:
        data = (h or "").encode()
        refers = best[h or ""] if count[h or ""] > 1 and best[h or ""] >= 0 else None
        refers = None if refers == i else refers
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in warc.archived(df).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, "", f"http://a{i % 7}.example.com/x?{i}", "HTTPS://u:p@WWW.b.org:8080/p q\r\nX: y%41"]),
             rng.choice([None, "", "same", f"<p>é {i}\r\n\r\nWARC/1.1\0", "x" * i]), "z") for i in range(120)]
    rows += [rows[3], (None, None, "same", None), (None, "u", "alone", None), (None, "u", "alone", None)]
    assert result(spark.createDataFrame(rows, PAGES)) == plain(rows)
    assert result(spark.createDataFrame([], PAGES)) == []


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "a", "xy", None), (2, "b", "xy", None), (3, "c", "long enough", None), (4, "d", "long enough", None)], PAGES)
    rows = warc.read_archives(spark, warc.write_archives(df, fresh_path(spark, "w"), least_bytes=5)).collect()
    assert {r.page_id: r.refers_to for r in rows} == {"1": None, "2": None, "3": "4", "4": None}


def test_members_end_in_zero_and_read_back():
    data = [b"a" * n for n in (1, 1000, 1 << 20)]
    laid = b"".join(map(warc.packed, data))
    assert [r for _, _, r in warc.records(laid)] == data
    assert all(warc.packed(d).endswith(b"\0") for d in data)
    for offset, length, record in warc.records(laid):
        assert next(warc.records(laid[offset: offset + length]))[2] == record
    with pytest.raises(ValueError):
        list(warc.records(laid[:-5]))


def test_records_over_16_mib():
    big = os.urandom(1 << 20) * 17
    laid = warc.packed(b"first") + warc.packed(big) + warc.packed(b"last")
    assert [len(r) for _, _, r in warc.records(laid)] == [5, len(big), 4]


def test_look_ups(spark):
    urls = [f"http://{h}.example.com/{p}" for h in ("a", "b", "www.c") for p in range(40)] + ["http://hot.example.com/"] * 90
    rows = [(i, u, f"<p>{i}</p>", None) for i, u in enumerate(urls)]
    archive = warc.write_archives(spark.createDataFrame(rows, PAGES), fresh_path(spark, "w"))
    index = warc.write_index(warc.read_archives(spark, archive), fresh_path(spark, "c"), block_lines=7)
    assert warc.index_captures(spark, index).count() == len(rows)
    found = warc.CaptureIndex(spark, index)
    assert len(found.directory) > 20
    for i in (0, 17, 63, 119):
        captures = found.captures(urls[i])
        assert [c["page_id"] for c in captures] == [str(i)]
        assert found.record(captures[0])["payload"] == rows[i][2].encode()
    assert sorted(int(c["page_id"]) for c in found.captures("https://HOT.example.com/#top")) == list(range(120, 210))
    assert found.captures("http://none.example.com/") == [] and found.captures("http://zz.example.com/") == []


def test_whole_tables_are_read_by_range(spark, monkeypatch):
    """Many small blocks and archives, keys that fill several blocks, and the way for file systems that tasks cannot open."""
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 9)
    urls = [f"http://h{i % 13}.example.com/{i}" for i in range(150)] + ["http://hot.example.com/"] * 60 + [None] * 20
    rows = [(i, u, f"<p>{i % 100}</p>" * 3, None) for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, PAGES)
    archive = warc.write_archives(df, fresh_path(spark, "w"))
    captures = warc.read_archives(spark, archive)
    index = warc.write_index(captures, fresh_path(spark, "c"), block_lines=7)
    found = warc.looked_up(spark, index, warc.url_keys(df))
    told = sorted(map(str, captures.collect()))
    assert sorted(map(str, found.collect())) == told and captures.select("file").distinct().count() > 20
    assert sorted(map(str, warc.range_read(spark, found, archive).collect())) == told
    monkeypatch.setattr(warc.re, "match", lambda *a: None)
    elsewhere = warc.range_read(spark, found, archive)
    monkeypatch.undo()
    assert sorted(map(str, elsewhere.collect())) == told
    some = spark.createDataFrame([(warc.url_key(u),) for u in ("http://hot.example.com/x/..", urls[3], "http://none/", "http://hot.example.com")], "key string")
    assert sorted(int(r.page_id) for r in warc.looked_up(spark, index, some).collect()) == [3, *range(150, 210)]
    wrong = found.withColumn("payload_digest", warc.F.lit("x"))
    with pytest.raises(Exception, match="not the one its index line tells"):
        warc.range_read(spark, wrong, archive).collect()


def test_records_are_valid():
    records = [warc.warc_record(1, "http://a/", b"x", "D", r, "2024-05-06T07:08:09Z") for r in (None, None, 7)]
    heads = [dict(line.split(b": ", 1) for line in r.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]) for r in records]
    assert len({h[b"WARC-Record-ID"] for h in heads}) == 3
    assert all({b"WARC-Type", b"WARC-Date", b"WARC-Record-ID", b"Content-Length"} <= set(h) for h in heads)
    assert warc.parsed(records[2])["refers_to"] == "7" and warc.parsed(records[0])["page_id"] == "1"


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b#c") == "com,example)/a?b"
    assert warc.url_key("https://u@x.example.org:444") == "org,example,x:444)/"
    assert warc.url_key("http://h.de?q") == "de,h)/?q"
    assert warc.url_key(None) == ""

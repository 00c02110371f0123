"""WARC round trips, chunking and damage."""

import gzip
import hashlib
import io
from collections import defaultdict

import pytest

from llm_cases import SF01
from parapet.llm import queries, warc


def brute(rows):
    top = defaultdict(list)
    for i, _, h in rows:
        top[h or ""].append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        head = max((x for x in top[h or ""] if x is not None), default=None)
        revisit = len(b) >= 1000 and head is not None and len(top[h or ""]) > 1 and (i is None or i < head)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", head if revisit else None))
    return out


def key(rows):
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


def read(spark, df, **kw):
    found = warc.summary(warc.read_chunks(spark, warc.archive(df), **kw)).collect()
    num = lambda s: None if s is None or "none" in s else int(s.rsplit(":", 1)[1])
    return [(num(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], num(r["refers_to"])) for r in found]


@pytest.fixture(scope="module")
def odd_pages(spark):
    big = "é" * 100_000
    rows = [(1, "http://a/", "x" * 1000), (2, "http://a/", "x" * 1000), (3, None, "x" * 999), (4, "u", "x" * 999),
            (5, "bad\r\nWARC-Type: x", "p\r\n\r\nq" * 300), (6, "u", None), (7, "u", ""), (8, "u", big), (9, "u", big),
            (9, "u", big), (None, "u", big), (None, None, None), (-4, "u", big), (10, "日本", "WARC/1.1\r\n\r\n" * 200)]
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, payload string, digest int")


def test_round_trip_of_odd_pages(spark, odd_pages):
    rows = [tuple(r)[:3] for r in odd_pages.collect()]
    assert key(read(spark, odd_pages)) == key(brute(rows))
    assert key(read(spark, odd_pages.repartition(5), with_bytes=False)) == key(brute(rows))
    none = odd_pages.limit(0)
    assert read(spark, none) == []


def test_chunks_are_bounded_and_join_to_the_payload(spark, odd_pages):
    chunks = warc.read_chunks(spark, warc.archive(odd_pages.filter("page_id in (5, 8)"))).collect()
    got = defaultdict(bytes)
    for r in sorted(chunks, key=lambda r: r["chunk_no"]):
        assert len(r["chunk"]) <= warc.CHUNK
        got[r["record_id"]] += bytes(r["chunk"])
        assert r["payload_digest"] == hashlib.sha1(got[r["record_id"]]).hexdigest()
        assert r["payload_bytes"] == len(got[r["record_id"]])
    want = {f"urn:page:{r['page_id']}": r["html"].encode() for r in odd_pages.filter("page_id in (5, 8)").collect()}
    assert got == want and sum(r["record_id"] == "urn:page:8" for r in chunks) == 4


def test_op4_whole_table(spark):
    rows = [(r["page_id"], None, r["html"]) for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()]
    assert key([tuple(r) for r in queries.op4(spark, SF01).collect()]) == key(
        [(a, b, c, d, e) for a, b, c, d, e in brute(rows)])


def one_record(payload=b"hello", said=None, length=None):
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    n = len(http) + len(payload) if length is None else length
    said = hashlib.sha1(payload).hexdigest() if said is None else said
    return gzip.compress((f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Type: application/http\r\n"
                          f"WARC-Payload-Digest: sha1:{said}\r\nContent-Length: {n}\r\n\r\n").encode() + http + payload + b"\r\n\r\n")


def test_damage_is_reported():
    good = one_record()
    assert [r[7] for r in warc.records(io.BytesIO(good + one_record(b"")))] == [
        hashlib.sha1(b"hello").hexdigest(), hashlib.sha1(b"").hexdigest()]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(one_record(said="0" * 40))))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(one_record(length=22, said=hashlib.sha1(b"hel").hexdigest()))))
    with pytest.raises(EOFError):
        list(warc.records(io.BytesIO(good[:-12])))

import hashlib
import random

import pytest

from talentmatch.llm import warc as WA
from talentmatch.session import scratch_path

PAGES = "page_id long, url string, html string"


def brute(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == body and j is not None]
        first = min(same) if same and len(body) >= WA.LEAST_SHARED else None
        again = first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    big = "é<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" * 5
    rows = [(7, "http://a.example/x", big), (3, "http://a.example/y?b=2&a=1", big), (9, None, big), (4, "http://b.example/\r\nX: y", "small"),
            (5, "http://b.example/", "small"), (6, "u", None), (8, "u", ""), (3, "http://a.example/y", big), (None, "n", big), (None, "n", None)]
    df = spark.createDataFrame(rows, PAGES)
    from pyspark.sql import functions as F
    for c in ("id", "bytes", "digest", "original", "body", "n", "run", "place"):
        df = df.withColumn(c, F.lit("x"))
    got = WA.archive_pages(df).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == brute(rows)


def test_histories_are_in_global_order(spark):
    rng = random.Random(1)
    rows = [(i, f"http://www.host{rng.randint(0, 3)}.example.org/{rng.randint(0, 5)}", "x" * rng.randint(0, 5)) for i in range(400)]
    path = scratch_path(spark, "test-warc")
    WA.write_archives(spark.createDataFrame(rows, PAGES).repartition(5), path, archive_bytes=30 * WA.CLASSES[0])
    got = [(r["url_key"], r["timestamp"], r["page_id"]) for r in WA.read_index(spark, path).collect()]
    assert len(got) == 400 and got == sorted(got)
    assert spark.read.format("binaryFile").load(path).count() >= 400 // 30


def test_archives_are_bounded_by_bytes(spark):
    rng = random.Random(4)
    rows = [(i, f"http://a.example/{i}", chr(97 + i % 26) * rng.choice([10, 3_000, 20_000, 150_000, 400_000, 3_000_000]) + str(i)) for i in range(90)]
    rows += [(1000 + i, "http://b.example/", "same" * 200_000) for i in range(4)]
    path = scratch_path(spark, "test-warc")
    WA.write_archives(spark.createDataFrame(rows, PAGES).coalesce(2), path, archive_bytes=1 << 20)
    sizes = [r.length for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert max(n for n in sizes if n < 3_000_000) <= (1 << 20) + 64 * 1024
    assert sorted(n for n in sizes if n >= 3_000_000)[-1] < 3_001_000
    got = WA.read_index(spark, path).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == brute(rows)


def test_empty_table(spark):
    assert WA.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_damage_is_an_error():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2024-01-01T00:00:01Z\r\nWARC-Payload-Digest: sha256:"
            + hashlib.sha256(b"abc").hexdigest().encode() + b"\r\nContent-Length: 41\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    size = len(b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")
    good = good.replace(b"Content-Length: 41", f"Content-Length: {size}".encode())
    assert [c[2] for c in WA.captures(good, "a")] == [1]
    for bad in (good[:-3], good.replace(b"abc", b"abd"), b"x" + good):
        with pytest.raises(ValueError):
            WA.captures(bad, "a")


def test_loser_tree_merges_any_runs():
    rng = random.Random(2)
    for k in range(12):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 6))) for _ in range(k)]
        assert list(WA.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


def test_url_keys():
    assert WA.url_key("https://User@WWW.Example.com:443/a/b/?z=1&a=2#f") == "com,example)/a/b?a=2&z=1"
    assert WA.url_key("http://a.b.example:8080") == "example,b,a:8080)/"
    assert WA.url_key(None) == WA.url_key("") == ""

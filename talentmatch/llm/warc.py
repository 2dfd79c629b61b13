"""Web archives: WARC files written from pages and read back, and their merged capture index.

Writing: payloads of at least 100 bytes that several pages share are kept once, in the record of
the smallest page id; the others become revisit records that refer to it. The digests are combined
before the shuffle, and only shared ones are joined back, so neither payloads nor a payload of a
third of all pages meet in a task. Records go out by Spark's text writer, in archives of bounded
bytes, so any file system that Spark writes to will do.

Reading: every archive is parsed by its records' lengths (payloads may hold anything) and checked
against its digests. Its captures, sorted by URL key and timestamp, are a *run*; the runs are
written, dealt out by key ranges (a key with many captures is cut by timestamp and id) and merged
in each range by a loser tree, which gives the capture histories in global order. A range holds a
bounded number of captures, and Spark's sort (which spills) brings each run in order.

Defined results: a null payload is empty; records below 100 bytes never refer to others; pages that
repeat the smallest id of a payload are all responses; a null url has an empty key; a null id is
read back as null, its date is the first and it never is a payload's smallest id; an empty table
gives an empty index; only the id, url and html columns are read; a payload of any length is a record.
Damaged archives raise ValueError.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentmatch.session import scratch_path, ship_package

#: Payloads shorter than this are stored again and again.
LEAST_SHARED = 100
#: Bytes of one archive, about, unless a single record is longer; payloads are put into archives with
#: others of their size class (class i: up to CLASSES[i] bytes; the last: any).
ARCHIVE_BYTES = 64 << 20
CLASSES = (1 << 14, 1 << 17, 1 << 20, 1 << 23)
#: Captures that one task merges, about.
RANGE_CAPTURES = 100_000
_NL = "\r\n"
_FIRST = 1_704_067_200  # 2024-01-01T00:00:00Z, the date of page 0; each id is a second later
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = ("url_key string, timestamp string, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, archive string, offset long")


# ---------------------------------------------------------------------------
# Writing
# ---------------------------------------------------------------------------

def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A WARC record for each row of ``pages``, in archives below ``path``.

    An archive is read whole by one task, so its bytes are bounded: records of one size class go
    into archives of so many records as fit ``archive_bytes``. Every class that occurs is a pass over the pages."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("bytes", F.octet_length("body").cast("long")).withColumn("digest", F.sha2(F.col("body").cast("binary"), 256))
    shared_path = scratch_path(spark, "shared-payloads")
    (rows.where(F.col("bytes") >= LEAST_SHARED).groupBy("digest").agg(F.min("id").alias("original"), F.count("*").alias("n"))
     .where("n > 1 AND original IS NOT NULL").select("digest", "original").write.parquet(shared_path))
    # written, so that its size decides between a broadcast and a join whose hot keys can be split
    rows = rows.join(spark.read.parquet(shared_path), "digest", "left")
    again = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_NL}Content-Type: text/html; charset=utf-8{_NL}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(_NL + _NL))
    kept = F.when(again, F.lit("")).otherwise(F.col("body"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    date = F.date_format(F.timestamp_seconds(F.lit(_FIRST) + F.coalesce(F.col("id"), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat_ws(
        _NL, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}{_NL}WARC-Refers-To: <urn:page:"), F.col("original").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length("http") + F.octet_length("kept")).cast("string")))
    size = F.when(again, 0).otherwise(F.col("bytes"))
    of_size = sum((size > most).cast("int") for most in CLASSES)
    present = [r[0] for r in pages.select(sum((F.octet_length(body) > most).cast("int") for most in CLASSES)).distinct().collect()]
    record = rows.withColumn("http", http).withColumn("kept", kept)
    for number in sorted({0, *present}):
        most = (*CLASSES, archive_bytes)[number]
        (record.where(of_size == number).select(F.concat(head, F.lit(_NL + _NL), "http", "kept").alias("value"))
         .write.mode("append").option("lineSep", _NL + _NL).option("maxRecordsPerFile", max(1, archive_bytes // most)).text(path))


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------

_URL = re.compile(r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?")
_PORTS = {"http": ":80", "https": ":443"}


def url_key(url: str | None) -> str:
    """The sort key of a URL: host parts reversed, then path and ordered query; scheme, user, a
    leading www, default port and fragment don't count."""
    if not url:
        return ""
    scheme, host, path, query = _URL.match(url.strip()).groups()
    host = (host or "").rpartition("@")[2].lower()
    host = host.removesuffix(_PORTS.get((scheme or "").lower(), "\0"))
    name, colon, port = host.partition(":")
    parts = [p for p in name.split(".") if p]
    if len(parts) > 2 and re.fullmatch(r"www\d*", parts[0]):
        parts = parts[1:]
    query = "&".join(sorted(query.split("&"))) if query else ""
    return ",".join(reversed(parts)) + colon + port + ")" + (path.rstrip("/") or "/") + ("?" + query if query else "")


def parse_archive(content: bytes):
    """(offset, headers, block) of each record; ValueError where the bytes are no WARC record."""
    at, end = 0, len(content)
    while at < end:
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0 or content[at:at + 10] != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record at byte {at}")
        fields = [line.partition(": ") for line in content[at + 10:stop].decode("utf-8").split(_NL)]
        headers = {k.lower(): v for k, _, v in fields}
        first = stop + 4
        last = first + int(headers["content-length"])
        if content[last:last + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, headers, content[first:last]
        at = last + 4


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def captures(content: bytes, archive: str) -> list[tuple]:
    """The captures of an archive as CAPTURE names them, sorted: a run."""
    out = []
    for offset, headers, block in parse_archive(content):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(http.rpartition(b"Content-Length: ")[2])
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        kind = headers["warc-type"]
        if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"the payload at byte {offset} of {archive} is not what its digest says")
        stamp = re.sub(r"\D", "", headers["warc-date"])
        url = headers.get("warc-target-uri")
        out.append((url_key(url), stamp, _page(headers["warc-record-id"]), url, kind, _page(headers.get("warc-refers-to")), length, digest,
                    archive, offset))
    return sorted(out, key=_order)


def _order(capture: tuple):
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0


class LoserTree:
    """Merges sorted runs: every inner node holds the run that lost there, so the next row takes one
    comparison a level."""

    def __init__(self, runs: list[list], key):
        self.rows = [iter(r) for r in runs]
        self.key = key
        k = self.k = len(runs)
        self.heads = [self._next(i) for i in range(k)]
        self.lost = [-1] * max(k, 1)
        for i in range(k):
            self._climb(i)

    def _next(self, i: int):
        row = next(self.rows[i], None)
        return None if row is None else ((self.key(row), i), row)

    def _before(self, i: int, j: int) -> bool:
        if i < 0 or j < 0:          # a place not yet taken lets the first comer wait there
            return i < 0
        a, b = self.heads[i], self.heads[j]
        return a is not None and (b is None or a[0] < b[0])

    def _climb(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            if self._before(self.lost[node], i):
                self.lost[node], i = i, self.lost[node]
                if i < 0:
                    return
            node //= 2
        self.lost[0] = i

    def __iter__(self):
        while self.k and self.heads[self.lost[0]] is not None:
            i = self.lost[0]
            yield self.heads[i][1]
            self.heads[i] = self._next(i)
            self._climb(i)


_NAMES = [part.split()[0] for part in CAPTURE.split(", ")]
_ARROW = pa.schema([(part.split()[0], pa.int64() if part.endswith("long") else pa.string()) for part in CAPTURE.split(", ")])
_RUN = _ARROW.append(pa.field("run", pa.string())).append(pa.field("place", pa.int64()))


def _runs(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            path = batch.column(0)[i].as_py()
            rows = captures(batch.column(1)[i].as_py(), path.rpartition("/")[2])
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) | {"run": path, "place": n} for n, r in enumerate(rows)], _RUN)


def _merged(batches):
    """The captures of a range, whose runs come one after the other, each in order."""
    runs: list[list[tuple]] = []
    last = None
    for batch in batches:
        for *row, run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run != last:
                runs.append([])
                last = run
            runs[-1].append(tuple(row))
    out: list[tuple] = []
    for row in LoserTree(runs, _order):
        out.append(row)
        if len(out) == 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in out], _ARROW)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in out], _ARROW)


def read_index(spark, path: str) -> DataFrame:
    """The captures (see CAPTURE) of all archives below ``path``, in order of URL key, timestamp and
    page id from partition to partition: the capture histories."""
    ship_package(spark)
    run_path = scratch_path(spark, "capture-runs")
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    files.mapInArrow(_runs, CAPTURE + ", run string, place long").write.parquet(run_path)
    runs = spark.read.parquet(run_path)
    # ranges of a bounded number of captures: a task holds no more, however many there are
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_CAPTURES))
    dealt = runs.repartitionByRange(ranges, "url_key", "timestamp", "page_id").sortWithinPartitions("run", "place")
    return dealt.drop("place").mapInArrow(_merged, CAPTURE)


def archive_pages(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives and return the index read back from them."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    return read_index(pages.sparkSession, path)

"""WARC archives with a two-level capture index.

Pages are sorted by reversed-host URL key (SURT). Each partition writes one
archive, a gzip member per record, and one capture index: its lines, in key
order, in gzip blocks of ``block_lines`` lines, and a sparse directory with the
first key and the place of every block. Of equal payloads one record is a
response and the others are revisits that refer to it. A look-up finds the
archive by the first keys of all directories (one per partition), searches the
directory for the block, reads the block, then the record, by byte ranges. A
URL is looked up by its prefix of the keys: the search ends at the first line
that may have it, and reading goes on over blocks and archives while it does.

Files are written through pyarrow's file systems under the shared checkpoint
folder. A retried task writes files of another name, and only files named by
the committed directory table count, so a lost executor leaves no half archive
in the result.

Defined results: a null html is an empty payload; a null URL has the key "-"
and no target header; a null page id stays null and is smaller than every id;
of rows that share id and payload one is the response. Other columns are not
read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch_path, shuffle_width, small_batches
from .exact_dedup import NO_ID, located

DIRECTORY = "first_key string, warc string, cdx string, directory string, n long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_AHEAD = 1 << 20


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return quote(url, safe="/:?=&%")
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + port + ")" + quote(rest, safe="/:?=&%@!$'()*+,;~#[]")


def record(uid: str, url: str | None, payload: bytes, digest: str, refers: str | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header but not the payload."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: <urn:page:{uid}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe="/:?=&%@!$'()*+,;~#[]"))
    if refers:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass(frozen=True)
class Archive:
    """A written collection: its directory table and the keys it holds."""
    directory: DataFrame
    captures: DataFrame


def write(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least_bytes: int = 0, block_lines: int = 1024, partitions: int | None = None,
          broadcast_rows: int = 1 << 18, date: str = "2025-01-01T00:00:00Z") -> Archive:
    """Write every page as a record. Equal payloads of at least ``least_bytes``
    share one response, that of the greatest page id. Up to ``broadcast_rows``
    revisits are broadcast to the pages, more are joined by shuffle."""
    spark = pages.sparkSession
    rows = located(pages).select(F.col("__file").alias("file"), F.col("__at").alias("at"),
                                 F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                                 F.col(html_col).alias("html"))

    def describe(whole: bool):
        """Keys and digests of the pages, with url and html if ``whole``."""
        def describe_batches(it):
            for batch in small_batches(it):
                out = []
                for file, at, page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = (html or "").encode()
                    uid = f"{'' if page is None else page}:{file & (1 << 64) - 1:x}:{at}"
                    out.append({"id": NO_ID if page is None else page, "uid": uid, "key": f"{surt(url)} {uid}",
                                "digest": sha1(payload), "bytes": len(payload),
                                **({"url": url, "html": html} if whole else {})})
                yield pa.RecordBatch.from_pylist(out, PAGE if whole else CAPTURE)
        return describe_batches

    captures = materialize(rows.mapInArrow(describe(False), CAPTURE_SCHEMA), "warc-captures")
    large = captures.filter(F.col("bytes") >= least_bytes)
    first = (large.groupBy("digest").agg(F.max(F.struct("id", "uid")).alias("kept"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", F.col("kept.uid").alias("refers")))
    revisits = materialize(large.join(first, "digest").filter("uid <> refers").select("uid", "refers"),
                           "warc-revisits")
    revisits = F.broadcast(revisits) if revisits.count() <= broadcast_rows else revisits
    roles = rows.mapInArrow(describe(True), CAPTURE_SCHEMA + ", url string, html string").join(
        revisits, "uid", "left")
    folder = scratch_path(spark, "warc")
    n = partitions or shuffle_width(spark)
    ordered = (roles.select("key", "uid", "url", "html", "digest", "refers")
               .repartitionByRange(n, "key").sortWithinPartitions("key"))

    def store(it):
        system, base = pafs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"{base}/{uuid.uuid4().hex}"
        out, cdx, offset, place, lines, index, first_key, count = None, None, 0, 0, [], [], None, 0

        def flush():
            nonlocal place, lines
            block = gzip.compress("".join(line for _, line in lines).encode(), mtime=0)
            index.append(f"{lines[0][0]}\t{place}\t{len(block)}\n")
            cdx.write(block)
            place += len(block)
            lines = []

        for batch in small_batches(it):
            for key, uid, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, cdx = (system.open_output_stream(name + e, compression=None)
                                for e in (".warc.gz", ".cdx.gz"))
                    first_key = key
                member = gzip.compress(record(uid, url, (html or "").encode(), digest, refers, date), mtime=0)
                out.write(member)
                lines.append((key, f"{key}\t{offset}\t{len(member)}\n"))
                offset, count = offset + len(member), count + 1
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            cdx.close()
            with system.open_output_stream(name + ".idx") as f:
                f.write("".join(index).encode())
            yield pa.RecordBatch.from_pylist([{
                "first_key": first_key, "warc": name + ".warc.gz", "cdx": name + ".cdx.gz",
                "directory": name + ".idx", "n": count}])

    return Archive(materialize(ordered.mapInArrow(store, DIRECTORY), "warc-directory"), captures)


CAPTURE_SCHEMA = "id long, uid string, key string, digest string, bytes long"
CAPTURE = pa.schema([("id", pa.int64()), ("uid", pa.string()), ("key", pa.string()), ("digest", pa.string()),
                     ("bytes", pa.int64())])
PAGE = pa.schema([*CAPTURE, ("url", pa.string()), ("html", pa.string())])
FOUND = "key string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class _Shard:
    """Reader of one archive: directory, one cached block, read-ahead."""

    def __init__(self, system, row):
        with system.open_input_stream(row["directory"]) as f:
            lines = f.read().decode().splitlines()
        self.places = [(k, int(a), int(n)) for k, a, n in (line.split("\t") for line in lines)]
        self.keys = [k for k, _, _ in self.places]
        self.warc, self.cdx = system.open_input_file(row["warc"]), system.open_input_file(row["cdx"])
        self.block, self.lines, self.at, self.buffer = -1, {}, 0, b""

    def load(self, block: int) -> None:
        if block != self.block:
            _, at, n = self.places[block]
            text = gzip.decompress(self.cdx.read_at(n, at)).decode()
            self.lines = {k: (int(a), int(m)) for k, a, m in (x.split("\t") for x in text.splitlines())}
            self.block = block

    def starting(self, prefix: str):
        """The keys that start with ``prefix``, in order."""
        block = max(0, bisect.bisect_right(self.keys, prefix) - 1)
        while block < len(self.keys) and (self.keys[block] <= prefix or self.keys[block].startswith(prefix)):
            self.load(block)
            yield from [k for k in self.lines if k.startswith(prefix)]
            block += 1

    def find(self, key: str) -> bytes | None:
        block = bisect.bisect_right(self.keys, key) - 1
        if block < 0:
            return None
        self.load(block)
        if key not in self.lines:
            return None
        at, n = self.lines[key]
        if not self.at <= at or at + n > self.at + len(self.buffer):
            self.at, self.buffer = at, self.warc.read_at(max(n, READ_AHEAD), at)
        return gzip.decompress(self.buffer[at - self.at:at - self.at + n])


def _parsed(key: str, raw: bytes) -> dict:
    head, http, payload = parse(raw)
    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
    if kind == "response" and sha1(payload) != digest:
        raise ValueError(f"{key}: the payload does not have its digest")
    page, refers = (head.get(h, "").removeprefix("<urn:page:").split(":")[0]
                    for h in ("WARC-Record-ID", "WARC-Refers-To"))
    return {"key": key, "page_id": int(page) if page else None, "payload_bytes": int(http["Content-Length"]),
            "payload_digest": digest, "record_type": kind, "refers_to": int(refers) if refers else None}


def _fetched(spark: SparkSession, archive: Archive, keys: DataFrame, ends, records, schema: str) -> DataFrame:
    """``records(shard, key)`` of every key at the shards ``ends(firsts, key)`` to it."""
    # one row per archive, so as many as the partitions that wrote them
    shards = sorted((r.asDict() for r in archive.directory.collect()), key=lambda r: r["first_key"])
    if not shards:
        return spark.createDataFrame([], schema)
    firsts, folder = [r["first_key"] for r in shards], scratch_path(spark, "x")
    name = schema.split()[0]

    def route(it):
        for batch in it:
            wanted = [(k, n) for k in batch.column(0).to_pylist() for n in ends(firsts, k)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in wanted], pa.string()),
                                              pa.array([n for _, n in wanted], pa.int32())], names=["key", "shard"])

    def fetch(it):
        system, _ = pafs.FileSystem.from_uri(folder)
        number, shard = -1, None
        for batch in small_batches(it):
            out = []
            for key, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != number:
                    number, shard = at, _Shard(system, shards[at])
                for row in records(shard, key):
                    out.append(row)
                    if len(out) == 1024:
                        yield pa.RecordBatch.from_pylist(out, FOUND_SCHEMA if name == "key" else URL_SCHEMA)
                        out = []
            yield pa.RecordBatch.from_pylist(out, FOUND_SCHEMA if name == "key" else URL_SCHEMA)

    return (keys.select("key").mapInArrow(route, "key string, shard int")
            .repartitionById(len(shards), F.col("shard")).sortWithinPartitions("shard", "key")
            .mapInArrow(fetch, schema))


def read(spark: SparkSession, archive: Archive, keys: DataFrame) -> DataFrame:
    """The records of ``keys`` (key string) read back from the archives, see
    FOUND. A key that is not in the index gives no row; a payload that does
    not have its digest raises."""
    def one(shard: _Shard, key: str):
        raw = shard.find(key)
        return [] if raw is None else [_parsed(key, raw)]

    return _fetched(spark, archive, keys.filter("key IS NOT NULL"),
                    lambda firsts, k: [max(0, bisect.bisect_right(firsts, k) - 1)], one, FOUND)


def look_up(spark: SparkSession, archive: Archive, urls: DataFrame) -> DataFrame:
    """All captures of ``urls`` (url string), ``url`` and the columns of FOUND. A
    URL given twice is looked up once; one without a capture gives no row; null
    finds the pages without a URL. URLs with one sort key are one URL."""
    def span(firsts: list[str], url: str | None):
        # keys of one URL may lie in several archives, the first from its middle
        prefix = surt(url) + " "
        lo = max(0, bisect.bisect_right(firsts, prefix) - 1)
        hi = lo
        while hi + 1 < len(firsts) and firsts[hi + 1].startswith(prefix):
            hi += 1
        return range(lo, hi + 1)

    def all_of(shard: _Shard, url: str | None):
        for key in shard.starting(surt(url) + " "):
            yield {"url": url, **_parsed(key, shard.find(key))}

    return _fetched(spark, archive, urls.select(F.col("url").alias("key")).distinct(), span, all_of, "url string, " + FOUND)


FOUND_SCHEMA = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                          ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

URL_SCHEMA = pa.schema([("url", pa.string()), *FOUND_SCHEMA])


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write all pages, then look every capture up in the archives."""
    archive = write(pages, **options)
    return read(pages.sparkSession, archive, archive.captures).drop("key")

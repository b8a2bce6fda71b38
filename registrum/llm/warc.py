"""WARC archives: writing with revisit records, reading back, and a merged capture index.

Writing. Each page becomes one record. Of pages with equal payloads (of at least `min_bytes` bytes) the
one with the smallest page_id is a response, the others revisit it and carry no payload. The smallest
id per digest is a partially aggregated minimum; the join back, of ids and digests alone, is on the digest,
where adaptive execution splits one that very many pages share. Records are written by Spark's text writer (a record's text is
valid UTF-8, its last two line ends are the line separator), gzip-compressed, so a lost executor only
costs its tasks. Archives are of bounded size: pages are dealt to them by a hash, in numbers that
follow the total of bytes (and the shuffle partitions, if those are more).

Reading. Archives are read as binary files, each parsed by Content-Length, so a payload may hold
anything, even text that looks like a record.

Index. Each archive's captures, sorted by URL key and timestamp, are a run. A run is cut at splitters
(from a bounded sample of all captures) and each range merges its parts of all runs by a loser tree, which
gives globally ordered capture histories: ranges in order, captures in order within.

Defined results: null html is an empty payload; null url is an empty one; rows with a null page_id are
always responses; rows that share the smallest page_id of a payload are all responses; repeated rows
give repeated records; other columns are ignored; empty tables give no records.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.llm.common import written
from registrum.llm.loser_tree import merge

EPOCH = 1704067200  # capture time of page 0 (2024-01-01, UTC); page n was captured n seconds later
MAX_SPLITTERS = 4096
SAMPLE = 16  # sampled captures for each splitter


def base32(digest: Column) -> Column:
    """A SHA-1 in hex as bare upper-case base32: forty bits, ten hex digits, at a time."""
    part = lambda i: F.lpad(F.lower(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32)), 8, "0")
    return F.translate(F.concat(*map(part, range(4))), "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _payloads(pages: DataFrame) -> DataFrame:
    return pages.select(
        pages["page_id"].cast("long").alias("page_id"), F.coalesce(pages["url"].cast("string"), F.lit("")).alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    ).withColumns({"sha": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})


def records(pages: DataFrame, min_bytes: int = 0, parts: int | None = None) -> DataFrame:
    """(page_id, sha, url, html, size, refers_to, digest): refers_to is null for responses.

    Which pages revisit which is found on page ids and digests alone; the payloads are shuffled once, to
    `parts` partitions by page, where the revisits meet them."""
    rows = _payloads(pages)
    keys = rows.where(F.col("size") >= min_bytes).select("page_id", "sha").where("page_id IS NOT NULL")
    first = keys.groupBy("sha").agg(F.min("page_id").alias("refers_to"))
    revisits = keys.join(first, "sha").where("refers_to < page_id").select(F.col("page_id"), F.col("sha"), "refers_to").distinct()
    parts = max(parts or 1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, "page_id", "sha").join(revisits, ["page_id", "sha"], "left").withColumn("digest", base32(F.col("sha")))


def _clean(url: Column) -> Column:
    """A URL as a header value: white space and control characters percent-encoded."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x20\\x7F]", "%20")


def record_text(rows: DataFrame) -> DataFrame:
    """(page_id, record): a WARC/1.1 record without the line ends after its block."""
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    identity = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    length = F.octet_length(http) + F.when(is_revisit, F.lit(0)).otherwise(F.col("size"))
    second = F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(86400 * 3650))
    headers = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), identity(F.col("page_id")),
        F.lit("\r\nWARC-Date: "), F.date_format(F.to_utc_timestamp(F.timestamp_seconds(second), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), _clean(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(is_revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), identity(F.col("refers_to")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"),
    )
    return rows.select("page_id", F.concat(headers, http, F.when(is_revisit, "").otherwise(F.col("html")), F.lit("\r\n")).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = 16 << 20) -> None:
    """Write the records of pages as gzip-compressed archives of about archive_bytes of text each.

    A payload that is longer than archive_bytes has an archive to itself or nearly so; records are never cut.
    """
    total = pages.agg(F.sum(F.octet_length("html")).alias("bytes"), F.count("*").alias("rows")).first()
    archives = max(1, -(-((total["bytes"] or 0) + 600 * total["rows"]) // archive_bytes))
    record_text(records(pages, min_bytes, archives)).select("record").write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no record at byte {at}: {version[:40]!r}")
        headers = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(headers["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end as its length says")
        yield headers, data[start:stop]
        at = stop + 4


def _page(identity: str) -> int | None:
    number = re.fullmatch(r"<urn:x-page:(-?\d+|none)>", identity)
    if not number:
        raise ValueError(f"not a record id of ours: {identity!r}")
    return None if number[1] == "none" else int(number[1])


def url_key(url: str) -> str:
    """Sortable form of a URL: host labels from the right, then path and query, lower case."""
    scheme, sep, rest = url.partition("://")
    host, slash, path = (rest if sep else scheme).partition("/")
    return f"{','.join(reversed(host.lower().split(':')[0].split('.')))}){slash}{path.lower()}"


CAPTURE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, url_key string, captured string"
_CAPTURE_KINDS = {"long": pa.int64(), "string": pa.string()}
_CAPTURE = [(x.split(" ")[0], _CAPTURE_KINDS[x.split(" ")[1]]) for x in CAPTURE.split(", ")]


def _capture(headers: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])  # type: ignore[index]
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
    url = headers["warc-target-uri"]
    refers = headers.get("warc-refers-to")
    return {"page_id": _page(headers["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": _page(refers) if refers else None, "url": url, "url_key": url_key(url), "captured": re.sub(r"\D", "", headers["warc-date"])}


def _order(c: dict) -> tuple:
    return c["url_key"], c["captured"], c["page_id"] is None, c["page_id"] or 0


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A row per archive: its name and its captures, sorted by URL key, time and page."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    item = pa.struct(_CAPTURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                found = sorted((_capture(h, b) for h, b in parse(data)), key=_order)
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([found], pa.list_(item))], ["archive", "captures"])

    fields = ",".join(f"{n}:{'bigint' if k == pa.int64() else 'string'}" for n, k in _CAPTURE)
    # one archive a batch, so that a task holds one at a time
    return files.mapInArrow(run, f"archive string, captures array<struct<{fields}>>")


def _edge(found: list[dict], archive: str, splitter: tuple) -> int:
    """How many captures of an archive's run come before a splitter (a capture's key, its archive, its place
    in the run); equal keys are in order of their archives, as the merge gives them."""
    *key, of, place = splitter
    if archive == of:
        return place
    return (bisect.bisect_right if archive < of else bisect.bisect_left)(found, tuple(key), key=_order)


def merged_index(runs: DataFrame, per_range: int = 50_000) -> DataFrame:
    """All captures in ranges of URL key, time and page: column `range` orders the partitions, `place` the
    captures within. Splitters are quantiles of a sample over the captures of all runs, however short the runs
    are: about SAMPLE captures for each range of about per_range; MAX_SPLITTERS at most. Captures with
    equal keys are told apart by archive and place, so many of them do not make a range large."""
    runs = written(runs, "capture-runs")  # read for their number, the splitters and the ranges, made once
    captures = runs.agg(F.sum(F.size("captures"))).first()[0] or 0
    wanted = min(MAX_SPLITTERS, captures // per_range)
    splitters: list[tuple] = []
    if wanted:
        each = runs.selectExpr("archive", "posexplode(captures) AS (i, c)")
        sample = each.where(F.pmod(F.xxhash64("i", "c.url_key", "c.captured", "c.page_id"), F.lit(max(1, captures // (SAMPLE * wanted)))) == 0)
        kept = sorted(map(tuple, sample.selectExpr("c.url_key", "c.captured", "c.page_id IS NULL", "coalesce(c.page_id, 0)", "archive", "i").collect()))
        splitters = [kept[len(kept) * n // (wanted + 1)] for n in range(1, wanted + 1)] if kept else []
    item = pa.struct(_CAPTURE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, captured in zip(batch.column("archive").to_pylist(), batch.column("captures"), strict=True):
                found = captured.as_py()  # one archive's at a time
                edges = [0, *(_edge(found, name, s) for s in splitters), len(found)]
                parts = [(i, found[a:b]) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([name] * len(parts)), pa.array([p for _, p in parts], pa.list_(item))], ["range", "archive", "captures"])

    def join(rows: pa.Table) -> pa.Table:
        ordered = rows.sort_by("archive")
        out = [c for _, c in merge(ordered.column("captures").to_pylist(), _order)]
        table = pa.Table.from_pylist(out, schema=pa.schema(_CAPTURE))
        return table.append_column("range", pa.array([rows.column("range")[0].as_py()] * len(out), pa.int32())).append_column("place", pa.array(range(len(out)), pa.int64()))

    parts = runs.mapInArrow(cut, f"range int, archive string, captures {runs.schema['captures'].dataType.simpleString()}")
    return parts.groupBy("range").applyInArrow(join, CAPTURE + ", range int, place long")

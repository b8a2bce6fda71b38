"""op4: archives, revisits and the merged index."""

from __future__ import annotations

import base64
import hashlib
import random

from registrum.llm import warc
from registrum.llm.common import shared_folder, written


def run(spark, rows, schema="page_id long, url string, html string", **more):
    import uuid

    path = f"{shared_folder(spark)}/test-warc-{uuid.uuid4().hex}"
    warc.write_archives(spark.createDataFrame(rows, schema), path, **more)
    runs = written(warc.read_runs(spark, path), "test-runs")
    return runs, warc.merged_index(runs, per_range=8)


def brute(rows, least=0):
    first: dict = {}
    for page, _, html, *_ in rows:
        if page is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        refers = first.get(html or "") if page is not None and len(data) >= least else None
        refers = refers if refers is not None and refers < page else None
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def digest(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_archives(spark):
    rng = random.Random(8)
    bodies = [None, "", "a", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "<p>" * 40_000, "x\0y", "\r\n", *[f"page {i}" for i in range(20)]]
    urls = [None, "", "http://b.example.com/x y\r\nWARC-Type: z", *[f"https://{h}.example.org/{p}" for h in "abc" for p in range(5)]]
    rows = [(rng.choice([None, i, i, i, 3]), rng.choice(urls), rng.choice(bodies), "html2") for i in range(150)]
    rows += rows[:4]
    schema = "page_id long, url string, html string, digest string"
    runs, index = run(spark, rows, schema, archive_bytes=20_000)
    assert runs.count() > 3
    assert digest(index) == brute(rows)
    assert digest(run(spark, rows, schema, min_bytes=2)[1]) == brute(rows, 2)
    assert digest(run(spark, [], schema)[1]) == []


def test_global_order(spark):
    rng = random.Random(3)
    rows = [(i, f"http://{rng.choice('abcdef')}.example.com/{rng.choice('PqR')}", str(i)) for i in rng.sample(range(1000), 300)]
    runs, index = run(spark, rows, archive_bytes=30_000)
    found = sorted(index.collect(), key=lambda r: (r.range, r.place))
    keys = [(r.url_key, r.captured, r.page_id) for r in found]
    assert keys == sorted(keys) and len(keys) == 300
    assert len({r.range for r in found}) > 3
    assert max(sum(r.range == k for r in found) for k in {r.range for r in found}) < 150


def sizes(index):
    return [r["count"] for r in index.groupBy("range").count().collect()]


def test_short_runs_are_cut_into_ranges(spark):
    """More captures than per_range in archives of far fewer each, at the default per_range."""
    capture = "named_struct('page_id', id * 200 + i, 'payload_bytes', 1L, 'payload_digest', 'x', 'record_type', 'response', 'refers_to', CAST(NULL AS bigint), 'url', 'u', 'url_key', format_string('%03d', i), 'captured', format_string('%014d', id * 200 + i))"
    index = warc.merged_index(spark.range(600).selectExpr("format_string('a%04d', id) AS archive", f"transform(sequence(0L, 199L), i -> {capture}) AS captures")).cache()
    assert index.count() == 120_000
    assert len(sizes(index)) > 1 and max(sizes(index)) < 100_000
    keys = [(r.url_key, r.captured) for r in index.select("url_key", "captured", "range", "place").orderBy("range", "place").collect()]
    assert keys == sorted(keys)


def test_equal_keys_are_cut_into_ranges(spark):
    rows = [(None, "http://a.org/", str(i % 7)) for i in range(300)]
    _, index = run(spark, rows, archive_bytes=30_000)
    assert digest(index) == brute(rows)
    assert len(sizes(index)) > 3 and max(sizes(index)) < 150


def test_parse_is_strict():
    import pytest

    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [b for _, b in warc.parse(good * 2)] == [b"ab", b"ab"]
    for bad in (good[:-1], good.replace(b": 2", b": 1"), b"WORK" + good[4:]):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_time_zone_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        _, index = run(spark, [(86_400 + 61, "http://a.org/", "x")])
        assert index.first().captured == "20240102000101"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

"""The key filter never hides a known key; what it rules out is not looked up."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import registrum.plans.bronze as bronze_plan
from registrum.operators import keyfilter as K
from registrum.plans.bronze import KEY_FILTERS, ingest_bronze, unknown_keys
from registrum.sources import parquet as pq


def keys(spark, low, high):
    return spark.range(low, high).select(F.lpad(F.col("id").cast("string"), 14, "0").alias("siret"), F.lit("x").alias("siren"))


@pytest.mark.parametrize("bits", [64, 40_000, 1 << 20])
def test_filter_holds_every_key(spark, bits):
    parts = [K.key_filter(keys(spark, 0, 700), "siret", bits), K.key_filter(keys(spark, 700, 1000), "siret", bits)]
    merged = K.merged_filter(parts[0].unionByName(parts[1]))
    got = {r.siret: r.maybe for r in K.ask(keys(spark, 0, 3000), "siret", merged, bits).collect()}
    assert len(got) == 3000 and all(v for k, v in got.items() if int(k) < 1000)
    passed = sum(v for k, v in got.items() if int(k) >= 1000)
    assert passed == 2000 if bits == 64 else passed < 40 if bits > 1 << 19 else True
    assert K.ask(keys(spark, 0, 5), "siret", merged.limit(0), bits).filter("maybe").count() == 0


@pytest.mark.parametrize("bits", [512, 1 << 16])
def test_no_wrong_row_with_a_small_filter(spark, scratch, monkeypatch, bits):
    """Nearly all keys pass a small filter: the exact comparison then decides."""
    monkeypatch.setattr(bronze_plan, "filter_bits", lambda keys: bits)
    b, seen = f"{scratch}/b", set()
    for day, (low, high) in enumerate([(0, 300), (100, 400), (1000, 1200), (0, 1300)], 1):
        r = ingest_bronze(spark, keys(spark, low, high), b, "etablissements", datetime(2026, 1, day))
        assert r.new_rows == len(set(range(low, high)) - seen)
        seen |= set(range(low, high))
    assert r.total_rows == len(seen) == spark.read.parquet(b).select("siret").distinct().count()
    assert len(pq.list_names(spark, f"{b}/{KEY_FILTERS}")) == 4


def test_only_batches_that_may_hold_a_key_are_read(spark, scratch):
    b = f"{scratch}/b"
    for day, (low, high) in enumerate([(0, 3000), (3000, 6000), (6000, 9000)], 1):
        ingest_bronze(spark, keys(spark, low, high), b, "etablissements", datetime(2026, 1, day))
    registry = spark.read.parquet(b).select("siret")
    none = unknown_keys(spark, keys(spark, 50_000, 50_100), b, "siret", 0, registry)
    assert none.count() == 100 and not [f for f in none.inputFiles() if "batch_id=" in f]  # all are surely new
    some = unknown_keys(spark, keys(spark, 5_995, 6_000).union(keys(spark, 70_000, 70_010)), b, "siret", 0, registry)
    read = {f.split("batch_id=")[1].split("/")[0] for f in some.inputFiles() if "batch_id=" in f}
    assert some.count() == 10
    scanned = [line for line in some._jdf.queryExecution().executedPlan().toString().split("\n") if "batch_id" in line]
    assert scanned and len({x for line in scanned for x in __import__("re").findall(r"batch_id#\d+L? (?:=|IN) \(?(\d+)", line)}) == 1, (read, scanned)


def test_size_follows_from_the_first_batch():
    assert K.filter_bits(0) == K.filter_bits(60_000) == 1 << 20 and K.filter_bits(40_000_000) == K.MAX_BITS
    assert all(16 * n <= K.filter_bits(n) < 64 * n for n in (100_000, 2_000_000, 33_000_000))


def test_batch_without_filter_is_read(spark, scratch):
    b = f"{scratch}/b"
    ingest_bronze(spark, keys(spark, 0, 50), b, "etablissements", datetime(2026, 1, 1))
    pq.delete(spark, f"{b}/{KEY_FILTERS}")
    assert ingest_bronze(spark, keys(spark, 0, 60), b, "etablissements", datetime(2026, 1, 2)).new_rows == 10

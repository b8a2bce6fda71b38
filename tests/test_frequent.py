"""Frequent values from class counts: equal to a full count, and little is grouped."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from registrum.operators import frequent
from registrum.operators import profile as P
from registrum.operators.joins import hot_key_values, hot_keys

from .test_scale_plans import plan_of


@pytest.fixture
def skewed(spark):
    """Half a million different values, some hot ones, NULL among them."""
    i = F.col("id")
    v = F.when(i % 3 == 0, F.lit("hot")).when(i % 50 == 1, F.lit("warm")).when(i % 50 == 2, F.lit(None)).otherwise(i.cast("string"))
    return spark.range(800_000).select(v.alias("v"))


def test_top_values_equal_the_full_count(spark, skewed):
    full = skewed.groupBy("v").agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc("v")).limit(5).collect()
    got = P.top_values(skewed, "v", 5).collect()
    assert [(r["v"], r["count"]) for r in got] == [(r["v"], r["count"]) for r in full]
    assert got[0]["pct"] == round(100 * full[0]["count"] / 800_000, 1)


@pytest.mark.parametrize("classes", [1, 3, 40, 65_536])
def test_any_number_of_classes_gives_the_same(spark, classes):
    rng = random.Random(classes)
    rows = [(rng.choice([None, "a", "b", *(f"x{rng.randrange(60)}" for _ in range(3))]),) for _ in range(900)]
    df = spark.createDataFrame(rows, "v string")
    full = sorted(((r["v"], r["count"]) for r in df.groupBy("v").count().collect()), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    for k in (1, 4, 30, 100):
        counts, total = frequent.most_frequent(df, "v", k, classes)
        got = sorted(((r["v"], r["count"]) for r in counts.collect()), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
        assert got[:k] == full[:k] and total == 900
    hold = {r["v"] for r in frequent.holding(df, "v", 0.05, 0, classes).collect()}
    assert hold == {v for v, n in full if v is not None and n >= 45}


def test_only_full_classes_are_grouped(spark, skewed):
    assert sorted(hot_key_values(skewed, "v", 0.01)) == ["hot", "warm"]
    plan = plan_of(hot_keys(skewed, "v", 0.01), "simple")
    assert "pmod" in plan or "IN (" in plan or "INSET" in plan
    counts = frequent.class_counts(skewed, "v")
    grouped = frequent.counted(skewed, "v", [c for c, n in counts.items() if n >= 8000])
    assert grouped.count() < 100  # of some 500,000 values


def test_empty_column(spark):
    df = spark.createDataFrame([], "v string")
    assert P.top_values(df, "v").collect() == [] and hot_key_values(df, "v") == []

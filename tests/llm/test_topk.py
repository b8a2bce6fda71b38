from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrum.llm import bit_sliced

SCHEMA = "vec_id long, embedding array<float>, label int, row long, q string, score double, part int"


def brute(rows, k=5, step=50):
    whole = [(i, r[0], [math.floor(256 * float(x)) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, query, q in whole:
        if query is None or query % step:
            continue
        scored = [(-sum(a * b for a, b in zip(q, c)), v is None, v or 0, v) for j, v, c in whole if j != i]
        out += [(query, rank, v, -s) for rank, (s, _, _, v) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in bit_sliced.search(df, F.col("vec_id") % 50 == 0, **options).collect()), key=str)


def odd_rows(n=260, seed=3):
    rng = random.Random(seed)
    hot = [float(np.float32(rng.uniform(-1, 1))) for _ in range(7)]
    rows = []
    for i in range(n):
        v = hot if rng.random() < 0.35 else [float(np.float32(rng.gauss(0, 0.4))) for _ in range(7)]
        rows.append((i, v))
    rows += [(None, hot), (None, [0.5] * 7), (50, hot), (50, rows[50][1]), (400, []), (401, [0.25, 1.0]), (450, None), (500, [None] * 7)]
    rows += [(550, [float("nan")] * 7), (600, [float("inf")] + [0.0] * 6), (2**63 - 1, hot), (-50, [3.0] * 7)]
    return [(i, v, 1, 9, "x", 0.5, 2) for i, v in rows]


def test_equal_to_brute_force_with_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df) == brute(rows)
    monkeypatch.setattr(bit_sliced, "MIN_BLOCK_ROWS", 40)  # many blocks of rows and of queries
    monkeypatch.setattr(bit_sliced, "QUERY_VALUES", 16)
    monkeypatch.setattr(bit_sliced, "BLOCKS", 7)
    assert found(df) == brute(rows)
    assert found(df, k=400) == brute(rows, k=400)


def test_few_rows_and_none(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    one = [(0, [1.0, 2.0], 1, 1, "", 0.0, 1)]
    assert found(spark.createDataFrame(one, SCHEMA)) == []
    assert found(spark.createDataFrame([*one, (7, [1.0, 0.0], 1, 1, "", 0.0, 1)], SCHEMA)) == [(0, 1, 7, 256 * 256)]


def test_scores_beyond_a_long_are_refused(spark):
    with pytest.raises(OverflowError):
        found(spark.createDataFrame([(0, [1e30], 1, 1, "", 0.0, 1)], SCHEMA))


@pytest.mark.parametrize("value", [0, 1, -1, 7, -100, 2**40 - 1, -(2**33)])
def test_signed_digits(value):
    digits = bit_sliced.signed_digits(value)
    assert sum(sign << place for place, sign in digits) == value
    assert all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:]))


def test_score_slices_are_the_scores():
    rng = np.random.default_rng(5)
    values = rng.integers(-300, 300, (200, 9))
    values[:, 3] = 17  # an attribute without slices
    block = bit_sliced.sliced(np.arange(200), np.ones(200, np.int64), np.arange(200), values)
    queries = rng.integers(-300, 300, (4, 9))
    slices, constants = bit_sliced.score_slices(block, queries)
    bits = np.unpackbits(np.ascontiguousarray(slices).view(np.uint8), axis=2, bitorder="little")[:, :, :200].astype(np.int64)
    sums = (bits << np.arange(len(slices))[:, None, None]).sum(axis=0) + np.array(constants)[:, None]
    assert (sums == queries @ values.T).all()

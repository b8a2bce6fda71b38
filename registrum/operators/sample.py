"""Exact, reproducible first-n by a seeded hash order, without funnelling the
data through one task.

Rows are ordered by ``(md5('seed|key'), key is NULL, key, hash of the row)``. A
plain ``orderBy().limit(n)`` makes every task keep its own top n and merges them
in one task: up to tasks x n rows. Here the first hash is uniform, so a histogram
of its range (``PARTS`` counts) shows which part holds the n-th row; that part is
divided again until it holds few rows, and only its keys are ranked, with their
counts. Each of these passes reads the key column alone, nothing is written, and
the rows themselves are read once, by a filter on the place found.

A NULL key has its place in the order like any other, rows that share a key are
told apart by the row hash, and of wholly equal rows exactly as many are taken
as are missing. So the result has exactly ``min(n, rows)`` rows, always.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.functions.columns import sample_key

PARTS = 4096
#: A part of at most this many rows is ranked; larger ones are divided.
RANKED = 50_000
_RANGE = 1 << 60  # the first fifteen hex digits of the hash


PLACE = ["_h", "_null", "_k"]


def _placed(df: DataFrame, key: str, seed: int) -> DataFrame:
    k = F.col(key)
    h = F.coalesce(sample_key(seed, k), F.md5(F.lit(f"{seed}|")))
    return df.withColumns({"_h": h, "_null": k.isNull(), "_k": k}).withColumn("_p", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long"))


def first_n(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """The ``n`` first rows in the seeded order; all rows if there are no more."""
    if n <= 0:
        return df.limit(0)
    keys = _placed(df.select(key), key, seed).select("_p", *PLACE)
    low, width, below, inside = 0, _RANGE, 0, None
    while inside is None or (inside > RANKED and width > PARTS):
        part = width // PARTS
        of_part = keys.filter((F.col("_p") >= low) & (F.col("_p") < low + width))
        counts = of_part.groupBy(F.least(F.floor((F.col("_p") - low) / part), F.lit(PARTS - 1)).alias("i")).count().collect()
        if inside is None and sum(r["count"] for r in counts) <= n:
            return df
        for i, rows in sorted((r["i"], r["count"]) for r in counts):
            if below + rows >= n:
                last = i == PARTS - 1
                low, width, inside = low + i * part, width - i * part if last else part, rows
                break
            below += rows
    in_part = (F.col("_p") >= low) & (F.col("_p") < low + width)
    # the keys of the part in order, each with its rows: RANKED of them at most, or those of PARTS hash values
    ranked = keys.filter(in_part).groupBy(*PLACE).agg(F.count(F.lit(1)).alias("rows")).orderBy(*PLACE).limit(n - below).collect()
    before = below
    for at in ranked:
        if before + at["rows"] >= n:
            break
        before += at["rows"]
    here = _placed(df, key, seed)
    point, limit = F.struct(*PLACE), _literal(here, PLACE, at)
    if before + at["rows"] == n:
        return here.filter((F.col("_p") < low) | (in_part & (point <= limit))).select(*df.columns)
    # of the rows that share the last key, those with the smallest row hashes
    sure = here.filter((F.col("_p") < low) | (in_part & (point < limit))).select(*df.columns)
    equal = here.filter(in_part & (point == limit)).select(*df.columns).withColumn("_r", F.xxhash64(*[F.col(c) for c in df.columns]))
    missing = n - before
    hashes = equal.groupBy("_r").agg(F.count(F.lit(1)).alias("rows")).orderBy("_r").limit(missing).collect()
    taken = 0
    for last in hashes:
        if taken + last["rows"] >= missing:
            break
        taken += last["rows"]
    sure = sure.unionByName(equal.filter(F.col("_r") < last["_r"]).drop("_r"))
    return sure.unionByName(equal.filter(F.col("_r") == last["_r"]).drop("_r").limit(missing - taken))  # wholly equal rows


def _literal(df: DataFrame, names: list[str], values) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[F.lit(values[c]).cast(types[c]).alias(c) for c in names])


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Reproducible random sample of exactly min(n, rows) rows, no replacement."""
    return first_n(df, n, key, seed)

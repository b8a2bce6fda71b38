"""Places of rows in a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.llm.common import discard, written
from registrum.operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast

#: monotonically_increasing_id holds the partition above this bit, the row's number below it.
PARTITION_BIT = 33


def small(df: DataFrame) -> DataFrame:
    """df marked for broadcast if its measured size is under the bound, else as it is."""
    return F.broadcast(df) if fits_broadcast(df, DEFAULT_BROADCAST_BYTES) else df


def sorted_rows(df: DataFrame, order: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """The rows of df (cheap to read twice, as the ranges are sampled) in range partitions by `order`,
    written, with `part` and the row's number `index` in it. `order` must tell all rows apart, else equal
    rows meet in one partition."""
    ranges = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    rows = written(ranges.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    path = rows.written_path
    rows = rows.withColumns({"part": F.shiftright("_at", PARTITION_BIT), "index": F.col("_at").bitwiseAND(F.lit((1 << PARTITION_BIT) - 1))}).drop("_at")
    rows.written_path = path
    return rows


def positions(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """df, written, with `pos`, 0 to n - 1 within `key` (never null) by `order`, and `n`, the rows of the key. Only one
    row per key and partition is counted up; a key that holds most rows spans many partitions."""
    rows = sorted_rows(df, [key, *order], name)
    spans = rows.groupBy(key, "part").agg(F.count("*").alias("_rows"), F.min("index").alias("_first"))
    by_key = Window.partitionBy(key)
    before = F.coalesce(F.sum("_rows").over(by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(F.col(key), F.col("part"), (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(by_key).alias("n"))
    placed = written(rows.join(small(spans), [key, "part"]).withColumn("pos", F.col("index") + F.col("_shift")).drop("part", "index", "_shift"), name)
    discard(rows)
    return placed

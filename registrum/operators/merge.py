"""High-water mark and last-wins merge of an increment into Silver.

Dedup is an aggregation, not a window: ``max(struct(order..., row...))`` per
key is computed partially on the map side, so a key repeated in a third of
all rows collapses to one row per task before the shuffle instead of landing
whole in one reducer. Struct ordering puts NULL lowest, which is
``ORDER BY ... DESC NULLS LAST`` in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.functions.columns import exact_digits, ntz
from registrum.operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast
from registrum.spec import INGESTED_AT, MARK_FLOOR, DatasetSpec

SOURCE_RANK = "_source_rank"  # old Silver = 0, new increment = 1


def mark_column(col: str = INGESTED_AT) -> Column:
    """MAX(ingested_at), 1900-01-01 when there is no row."""
    return F.coalesce(F.max(col), ntz(MARK_FLOOR)).alias("mark")


def high_water_mark(df: DataFrame | None) -> datetime:
    """Mark of a Silver table; no table or no row gives 1900-01-01."""
    if df is None or INGESTED_AT not in df.columns:
        return MARK_FLOOR
    return df.select(F.max(INGESTED_AT)).first()[0] or MARK_FLOOR


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the greatest by ``order`` then by every remaining
    column (a deterministic total order, independent of partitioning)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.struct(*[F.col(c) for c in list(order) + rest])
    out = df.groupBy(*keys).agg(F.max(ranked).alias("_w"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_w.{c}").alias(c) for c in list(order) + rest]).select(
        *df.columns
    )


def merge_last_wins(existing: DataFrame | None, new: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Union old then new, re-check postal codes (no trim), keep the last row
    per id columns: later ``ingested_at`` wins, then new beats old."""
    cols = list(new.columns)
    parts = [new.withColumn(SOURCE_RANK, F.lit(1))]
    if existing is not None:
        parts.insert(0, existing.select(*cols).withColumn(SOURCE_RANK, F.lit(0)))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    if spec.postal_column and spec.postal_column in cols:
        union = union.filter(exact_digits(F.col(spec.postal_column), 5))
    merged = keep_last(union, spec.id_columns, [INGESTED_AT, SOURCE_RANK])
    return merged.select(*cols)


def merge_repeated(old: DataFrame, new: DataFrame, again: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``merge_last_wins(old, new)`` where the keys on both sides are known (``again``): only their rows
    are compared, all others pass as they are. New rows of other keys must be unique."""
    keys = again.select(F.col(spec.pk).alias("_again"))
    if fits_broadcast(keys, DEFAULT_BROADCAST_BYTES):
        keys = F.broadcast(keys)

    def split(df: DataFrame, how: str) -> DataFrame:
        return df.join(keys, df[spec.pk] == F.col("_again"), how)

    compared = merge_last_wins(split(old, "left_semi"), split(new, "left_semi"), spec)
    passed = split(old, "left_anti")
    if spec.postal_column:
        passed = passed.filter(exact_digits(F.col(spec.postal_column), 5))
    return passed.unionByName(split(new, "left_anti")).unionByName(compared)

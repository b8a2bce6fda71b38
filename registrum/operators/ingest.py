"""Bronze ingestion operators: audit column, anti-join against known keys,
deterministic in-batch dedup and the optional row cap."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.functions.columns import ntz
from registrum.operators.clean import batch_id_of
from registrum.operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast
from registrum.operators.sample import first_n
from registrum.sources.staging import staged
from registrum.spec import BATCH_ID, INGESTED_AT


def with_audit(df: DataFrame, run_ts: datetime) -> DataFrame:
    """All source columns plus the run's constant ``ingested_at`` and its
    ``batch_id`` partition value."""
    return df.withColumns(
        {
            INGESTED_AT: ntz(run_ts),
            BATCH_ID: F.lit(batch_id_of(run_ts)),
        }
    )


def empty_like(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Schema of the registry (source + audit columns), no rows."""
    return with_audit(df, run_ts).limit(0)


def dedup_batch(source: DataFrame, pk: str) -> DataFrame:
    """One row per key inside a source batch: the smallest row by its other
    columns, a NULL counting as larger than any value (the fuller row stays).

    Only rows of repeated keys are compared: they are found on the key column
    alone, all others pass untouched. ``min(struct)`` aggregates partially per
    task, so a hot key never reaches one reducer whole."""
    rest = [c for c in source.columns if c != pk]
    if not rest:
        return source.select(pk).distinct()
    repeated = source.groupBy(pk).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(F.col(pk).alias("_rk"))
    repeated = staged(repeated, "repeated-keys")
    if repeated.isEmpty():
        return source
    if fits_broadcast(repeated, DEFAULT_BROADCAST_BYTES):
        repeated = F.broadcast(repeated)
    once = source.join(repeated, source[pk].eqNullSafe(F.col("_rk")), "left_anti")
    several = source.join(repeated, source[pk].eqNullSafe(F.col("_rk")), "left_semi")
    ranked = F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c).alias(c))])
    least = several.groupBy(pk).agg(F.min(ranked).alias("_r"))
    return once.unionByName(least.select(pk, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*source.columns))


def new_keys(source: DataFrame, known_keys: DataFrame, pk: str) -> DataFrame:
    """Distinct non-NULL source keys not yet in the registry: a key-column-only
    plan (the distinct is partially aggregated, so a repeated key costs one row
    per task)."""
    keys = known_keys.select(pk).filter(F.col(pk).isNotNull())
    return source.select(pk).filter(F.col(pk).isNotNull()).distinct().join(keys, on=pk, how="left_anti")


def keys_unique(df: DataFrame, pk: str) -> bool:
    """Whether no key repeats, from the key column alone: one pass counting
    rows and distinct keys (the distinct is partially aggregated)."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(pk).alias("keys")).first()
    return r["rows"] == r["keys"]


def new_rows(
    source: DataFrame,
    known_keys: DataFrame | None,
    pk: str,
    keep_null_keys: bool = False,
    dedup: bool = True,
    max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES,
    fresh: DataFrame | None = None,
) -> DataFrame:
    """Source rows whose key is not yet in the registry. ``fresh``: those keys, if they are known.

    The unknown keys are found on the key column alone, then only their rows
    are fetched (semi-join; the key set is broadcast when measured under the
    bound, so the source is filtered map-side) and deduplicated. A daily run
    shuffles the key column and the new rows, not every column of the whole
    stock file. With no registry yet, every row is new and is only deduplicated.

    NULL keys never match a key, so they would pass on every run. By default
    they are rejected; ``keep_null_keys`` (parity mode) appends them without
    any join, so a NULL-heavy batch cannot pile up in one shuffle partition.
    """
    keyed = source.filter(F.col(pk).isNotNull())
    if known_keys is not None:
        # staged once: measured, and joined, without a second anti-join
        fresh = staged(new_keys(source, known_keys, pk) if fresh is None else fresh, "new-keys")
        if max_broadcast_bytes is not None and fits_broadcast(fresh, max_broadcast_bytes):
            fresh = F.broadcast(fresh)
        keyed = keyed.join(fresh, on=pk, how="left_semi")
    elif dedup and keys_unique(keyed, pk):
        # first load: every row is new; the key column alone shows that no key
        # repeats, so the whole stock file is not shuffled for a no-op dedup
        dedup = False
    if dedup:
        keyed = dedup_batch(keyed, pk)
    if keep_null_keys:
        keyed = keyed.unionByName(source.filter(F.col(pk).isNull()))
    return keyed


def cap(df: DataFrame, limit: int, pk: str, seed: int = 0) -> DataFrame:
    """``limit`` > 0: exactly min(limit, rows) rows, chosen by a seeded hash of
    the key (an unordered LIMIT made reproducible); rows without key and rows
    that share one take part like any other."""
    if not limit or limit <= 0:
        return df
    return first_n(df, limit, pk, seed)

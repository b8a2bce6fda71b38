"""Bronze job: idempotent, insert-only ingestion of a source stock file.

The Bronze dataset is a Parquet directory partitioned by ``batch_id`` and is
itself the registry of known keys (no second store). A run appends only the
source rows whose key is unknown, under its own ``batch_id`` partition with
dynamic partition overwrite, so a retried run replaces its own partial batch
and never touches earlier ones. Beside each batch lies a Bloom filter of its keys
(``registrum.operators.keyfilter``): source keys that no filter can hold are new
without any look at the registry; only for the others the key column is read,
and of it only the batches whose own filter can hold one of them. That
anti-join is a shuffle join: the key set grows with the registry, so it is
never force-broadcast. A batch without filter is always read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from registrum.operators.clean import batch_id_of
from registrum.operators.ingest import cap, new_keys, new_rows, with_audit
from registrum.operators.joins import fits_broadcast
from registrum.operators.keyfilter import ask, batches_asked, filter_bits, key_filter, merged_filter
from registrum.sources import parquet as pq
from registrum.sources.staging import stage, staging
from registrum.spec import BATCH_ID, bronze_pk


class StaleBatch(ValueError):
    """The run's timestamp is older than a batch that is there or that Silver has read."""


#: Names of the empty files below this folder of a Bronze table are batches that Silver has read.
READ_BY_SILVER = "_read_by_silver"
#: Keys that may be known are compared with each batch's filter up to this size; more of them read all batches.
ASKED_BYTES = 1 << 20


def batches(spark: SparkSession, bronze_path: str) -> list[int]:
    """``batch_id`` partition values present in Bronze, ascending (a listing,
    no data read)."""
    prefix = f"{BATCH_ID}="
    names = pq.list_names(spark, bronze_path)
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def seal(spark: SparkSession, bronze_path: str, batch_id: int) -> None:
    """Note that Silver has read every batch up to this one."""
    pq.write_text(spark, f"{bronze_path.rstrip('/')}/{READ_BY_SILVER}/{batch_id}", "", overwrite=True)


def sealed(spark: SparkSession, bronze_path: str) -> int | None:
    names = [int(n) for n in pq.list_names(spark, f"{bronze_path.rstrip('/')}/{READ_BY_SILVER}") if n.isdigit()]
    return max(names, default=None)


def require_new_batch(spark: SparkSession, bronze_path: str, run_ts: datetime) -> None:
    """Batches come in the order of time: Silver reads on from the last it has seen, so
    an older one would never reach it. The newest may be written again (a retry) until
    Silver has read it."""
    own, there, read = batch_id_of(run_ts), batches(spark, bronze_path), sealed(spark, bronze_path)
    if there and own < there[-1]:
        raise StaleBatch(f"{bronze_path}: batch {own} is older than batch {there[-1]}, which is there already")
    if read is not None and own <= read:
        raise StaleBatch(f"{bronze_path}: Silver has read up to batch {read}; batch {own} would be missed")


@dataclass(frozen=True)
class BronzeResult:
    dataset: str
    batch_id: int
    new_rows: int
    null_keys: int
    total_rows: int


def known_keys(spark: SparkSession, bronze_path: str, pk: str, exclude_batch: int | None = None) -> DataFrame | None:
    reg = pq.read_if_any(spark, bronze_path)
    if reg is None:
        return None
    if exclude_batch is not None:
        reg = reg.filter(F.col(BATCH_ID) != F.lit(exclude_batch))
    return reg.select(pk)


#: One Parquet table per batch below this folder of a Bronze table, named by size and batch.
KEY_FILTERS = "_key_filters"


def key_filters(spark: SparkSession, bronze_path: str) -> tuple[int | None, dict[int, str]]:
    """The size of a table's filters (None: it has none yet) and the paths of the whole ones, by batch."""
    root = f"{bronze_path.rstrip('/')}/{KEY_FILTERS}"
    named = [(n, *map(int, n.split("-"))) for n in pq.list_names(spark, root)]
    whole = {batch: f"{root}/{n}" for n, _, batch in named if pq.exists(spark, f"{root}/{n}/_SUCCESS")}
    return (named[0][1] if named else None), whole


def unknown_keys(spark: SparkSession, source: DataFrame, bronze_path: str, pk: str, own_batch: int, registry: DataFrame) -> DataFrame:
    """Distinct non-NULL source keys that the registry does not hold, exactly: those that the filters rule
    out need no look; the others are compared with the batches that may hold them."""
    there = [b for b in batches(spark, bronze_path) if b != own_batch]
    bits, filters = key_filters(spark, bronze_path)
    filters = {b: p for b, p in filters.items() if b in there}
    if not filters or len(filters) < len(there):
        return new_keys(source, registry, pk)
    each = reduce(DataFrame.unionByName, [spark.read.parquet(p).withColumn(BATCH_ID, F.lit(b)) for b, p in filters.items()])
    merged, _ = stage(merged_filter(each), "key-filter")
    keys, _ = stage(ask(source.select(pk).filter(F.col(pk).isNotNull()).distinct(), pk, merged, bits), "asked-keys")
    surely_new, maybe = keys.filter(~F.col("maybe")).select(pk), keys.filter("maybe").select(pk)
    if fits_broadcast(maybe, ASKED_BYTES):
        wanted = batches_asked(maybe, pk, each, BATCH_ID, bits)
        if not wanted:
            return keys.select(pk)
        registry = pq.read_if_any(spark, bronze_path).filter(F.col(BATCH_ID).isin(wanted)).select(pk)
    return surely_new.unionByName(new_keys(maybe, registry, pk))


def write_filter(spark: SparkSession, bronze_path: str, batch: int, pk: str, written: int) -> None:
    """The filter of a written batch, from its key column; the first one sets the size."""
    rows, (bits, _) = pq.read_if_any(spark, bronze_path), key_filters(spark, bronze_path)
    if rows is not None:
        bits = bits or filter_bits(written)
        keys = rows.filter(F.col(BATCH_ID) == F.lit(batch)).select(pk)
        key_filter(keys, pk, bits).write.mode("overwrite").parquet(f"{bronze_path.rstrip('/')}/{KEY_FILTERS}/{bits}-{batch}")


def ingest_increment(
    spark: SparkSession,
    source: DataFrame,
    bronze_path: str,
    dataset_name: str,
    run_ts: datetime,
    limit: int = 0,
    keep_null_keys: bool = False,
) -> DataFrame:
    """The rows this run appends: unknown keys, deduplicated, capped. The unknown keys
    (and, with a cap, the row order) are staged when this is called; the rest is lazy."""
    pk = bronze_pk(dataset_name)
    own = batch_id_of(run_ts)
    registry = known_keys(spark, bronze_path, pk, exclude_batch=own)
    fresh = unknown_keys(spark, source, bronze_path, pk, own, registry) if registry is not None else None
    fresh = new_rows(source, registry, pk, keep_null_keys=keep_null_keys, fresh=fresh)
    return with_audit(cap(fresh, limit, pk), run_ts)


def ingest_bronze(
    spark: SparkSession,
    source_path: str | DataFrame,
    bronze_path: str,
    dataset_name: str,
    run_ts: datetime,
    limit: int = 0,
    keep_null_keys: bool = False,
) -> BronzeResult:
    """Append this run's unknown rows to Bronze; the new rows are counted during the
    write, NULL keys on the key column."""
    require_new_batch(spark, bronze_path, run_ts)
    source = spark.read.parquet(source_path) if isinstance(source_path, str) else source_path
    pk = bronze_pk(dataset_name)
    # counted on the key column alone; an observation would be answered by whichever job runs first
    nulls = source.filter(F.col(pk).isNull()).count()
    obs = Observation(f"bronze_{dataset_name}")
    own = batch_id_of(run_ts)
    # what an earlier attempt of this batch says of its keys ends here; without a filter it is read
    if path := key_filters(spark, bronze_path)[1].get(own):
        pq.delete(spark, path)
    with staging(spark):
        rows = ingest_increment(spark, source, bronze_path, dataset_name, run_ts, limit, keep_null_keys)
        rows = rows.observe(obs, F.count(F.lit(1)).alias("new_rows"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_ID).parquet(bronze_path)
    added = int(obs.get.get("new_rows", 0))
    if not added:
        # an empty result overwrites no partition: drop what an earlier attempt of this batch left
        pq.delete(spark, f"{bronze_path.rstrip('/')}/{BATCH_ID}={own}")
    else:
        write_filter(spark, bronze_path, own, pk, added)
    written = pq.read_if_any(spark, bronze_path)
    total = written.count() if written is not None else 0
    return BronzeResult(dataset_name, batch_id_of(run_ts), added, nulls, total)

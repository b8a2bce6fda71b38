"""Silver job: incremental read of Bronze, cleaning, last-wins merge, contract
gate and atomic publication.

One lazy lineage (increment -> clean -> merge) is written once as a new
snapshot version; the contract is checked on the written files; only then is
the version committed. A failed gate leaves the previous version current.

The table is dealt into buckets by a hash of its key. New keys are appended; a
key that comes again rewrites its bucket only, and in it only the rows of the
repeated keys are compared. Small segments are taken up by later ones (see
``registrum.sources.store``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from registrum.operators.clean import date_spellings, increment_predicates, silver_increment
from registrum.operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast
from registrum.operators.merge import high_water_mark, merge_last_wins, merge_repeated
from registrum.operators.profile import sketch_rows
from registrum.operators.quality import DuplicateKeys, coerce, coerce_metrics, require_coerced, validate
from registrum.plans.bronze import batches as bronze_batches
from registrum.plans.bronze import seal, sealed
from registrum.sources import parquet as pq
from registrum.sources.staging import stage, staged, staging
from registrum.sources.store import Layout, Snapshot, SnapshotStore, buckets_for
from registrum.spec import BATCH_ID, INGESTED_AT, MARK_FLOOR, REGION_DEPARTMENTS, spec_for

#: Segments of one level that the next one takes up.
MAX_SEGMENTS = 8


@dataclass(frozen=True)
class SilverResult:
    dataset: str
    mark: datetime
    new_rows: int
    rejected_postal: int
    version: int | None
    total_rows: int
    #: spellings other than ISO in which text dates of this run were read, by column
    date_spellings: dict = field(default_factory=dict)


def current_mark(store: SnapshotStore) -> datetime:
    """Mark from the commit marker; falls back to a MAX scan; 1900 if none."""
    snap = store.current()
    if snap is None:
        return MARK_FLOOR
    if snap.facts.get("mark"):
        return datetime.fromisoformat(snap.facts["mark"])
    return high_water_mark(store.read())


def seal_committed(spark: SparkSession, snap: Snapshot | None, bronze_path: str) -> None:
    """Seal the batches a committed version has read, if the run that committed it ended before its
    seal: a retry of such a batch must not be accepted any more, Silver would never read it."""
    done = snap.facts.get("bronze_batch") if snap else None
    if done is not None and (sealed(spark, bronze_path) or 0) < int(done):
        seal(spark, bronze_path, int(done))


def build_silver(
    spark: SparkSession,
    dataset_name: str,
    bronze_path: str,
    silver_root: str,
    as_of_year: int,
    departments: Sequence[str] = REGION_DEPARTMENTS,
    max_segments: int = MAX_SEGMENTS,
    buckets: int | None = None,
) -> SilverResult:
    """``buckets`` is used by the first run alone; unset, it follows from the size of Bronze."""
    spec = spec_for(dataset_name)  # ValueError for an unknown dataset
    pq.require(spark, bronze_path)
    store = SnapshotStore(spark, f"{silver_root.rstrip('/')}/{dataset_name}")
    mark = current_mark(store)
    prev_snap = store.current()
    bronze = pq.read_if_any(spark, bronze_path)
    # Batches are listed once: this run reads batches newer than the last
    # processed one (kept in the marker) up to the newest listed now, so a
    # batch whose rows were all rejected is not read again, and a batch that
    # lands while the job runs waits for the next run.
    batches = bronze_batches(spark, bronze_path)
    done_batch = (prev_snap.facts.get("bronze_batch") if prev_snap else None) or None
    seal_committed(spark, prev_snap, bronze_path)
    if bronze is not None and batches and BATCH_ID in bronze.columns:
        window = F.col(BATCH_ID) <= F.lit(batches[-1])
        if done_batch is not None:
            window = window & (F.col(BATCH_ID) > F.lit(int(done_batch)))
        bronze = bronze.filter(window)
    seen = {"bronze_batch": batches[-1]} if batches else {}
    obs = Observation(f"silver_{dataset_name}")
    if bronze is None:
        return _publish(spark, spec, store, None, mark, seen, done_batch, max_segments, None, obs, {}, bronze_path)
    with staging(spark):
        # The increment is computed once, as the columns come; probes, type check and
        # merge read the staged files.
        read = bronze.filter(reduce(and_, increment_predicates(bronze, spec, mark, departments)))
        spellings = date_spellings(read.select(*[c for c in spec.selected_columns if c != INGESTED_AT]))
        rows = silver_increment(bronze, spec, mark, departments, as_of_year, obs, spellings)
        added = Observation(f"silver_new_{dataset_name}")
        rows = rows.observe(added, F.count(F.lit(1)).alias("new_rows"), *coerce_metrics(rows, spec))
        increment, _ = stage(rows, f"silver-{dataset_name}")
        layout = prev_snap.layout if prev_snap else None
        layout = layout or Layout(spec.pk, buckets or buckets_for(pq.size_of(spark, bronze_path)))
        result = _publish(spark, spec, store, increment, mark, seen, done_batch, max_segments, layout, obs, added.get, bronze_path)
        return replace(result, date_spellings=spellings)


def repeated_keys(store: SnapshotStore, increment: DataFrame, layout: Layout) -> DataFrame:
    """The keys of the increment that Silver holds already, staged. Only the key column of the
    buckets that the increment falls into is read; the new keys are broadcast when measured small,
    so the old ones are scanned in place."""
    key = layout.key
    new = increment.select(key, layout.bucket().alias("_b")).distinct()
    snap = store.current()
    # bucket numbers, bounded by the layout
    hit = None if layout.buckets == 1 else {r[0] for r in new.select("_b").distinct().collect()}
    old = store.rows_of(snap, buckets=hit).select(key)
    if fits_broadcast(new, DEFAULT_BROADCAST_BYTES):
        found = old.join(F.broadcast(new), key, "left_semi").distinct()
    else:
        found = new.select(key).join(old.distinct(), key, "left_semi")
    return staged(found, "repeated-silver-keys")


def _publish(spark, spec, store, increment, mark, seen, done_batch, max_segments, layout, obs, added, bronze_path) -> SilverResult:
    """Check the staged increment's types, merge it and publish the result."""
    dataset_name = spec.name
    if increment is None or increment.isEmpty():
        snap = store.current()
        if snap is not None and seen and seen["bronze_batch"] != done_batch:
            snap = store.touch(seen)  # remember the batches read, no data written
            seal(spark, bronze_path, seen["bronze_batch"])
        total = int(snap.facts.get("rows", 0)) if snap else 0
        return SilverResult(dataset_name, mark, 0, 0, snap.version if snap else None, total)
    # Before any cast: a value that does not fit its column's type stops the run.
    require_coerced(added, spec)

    prev = store.current()
    once, dedup = coerce(increment, spec), coerce(merge_last_wins(None, increment, spec), spec)
    options = {"layout": layout, "mode": "append", "fan_in": max_segments}
    if prev is None:
        attempts = [once, dedup]
    elif prev.layout is None:
        # a table written before buckets: merged whole, and dealt from now on
        options["mode"] = "replace"
        attempts = [coerce(merge_last_wins(store.read(), increment, spec), spec)]
    else:
        again = repeated_keys(store, increment, layout)
        touched = {r[0] for r in again.select(layout.bucket()).distinct().collect()}
        if touched:
            old = store.rows_of(prev, buckets=touched).select(*spec.silver_columns)
            options["replaces"] = touched
            attempts = [merge_repeated(old, rows, again, spec) for rows in (once, dedup)]
        else:
            attempts = [once, dedup]
    base_mark = prev.facts.get("mark") if prev else None

    def gate(written):
        # Keys from an insert-only Bronze are unique: the increment is written as is and
        # the uniqueness check (a shuffle of the key column only) proves it. Buckets that
        # are not rewritten hold none of its keys.
        counts, facts = validate(written, spec, [F.max(INGESTED_AT).alias("mark")])
        marks = [m for m in (facts["mark"].isoformat() if facts["mark"] else None, base_mark) if m]
        return {"mark": max(marks) if marks else None, "rules": counts, **seen}

    for i, df in enumerate(attempts):
        try:
            snap = store.publish(df, validate=gate, profile=sketch_rows, **options)
            break
        except DuplicateKeys:
            if i == len(attempts) - 1:
                raise
    if seen:
        seal(spark, bronze_path, seen["bronze_batch"])
    metrics = obs.get if spec.postal_column else {}
    return SilverResult(
        dataset_name,
        mark,
        int(added.get("new_rows", 0)),
        int(metrics.get("rejected_postal", 0)),
        snap.version,
        int(snap.facts["rows"]),
    )

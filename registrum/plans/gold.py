"""Gold job: the master table and three KPI tables.

Full build: the master (establishments left-joined to legal units) is
published as a snapshot version (written files, lineage cut), dealt into
buckets by siren; one scan of three of its columns gives the (department,
sector, size) counts, stored as the small ``kpi_base`` table, from which the
three KPIs are derived.

Update: the rows that Silver has inserted or changed since the version the last
build has followed are known from its segments (those with new rows only) and,
where a segment mixes old and new, from the mark. New establishments are joined
and appended. A master bucket is rewritten only if it holds a changed
establishment or the siren of a new or changed legal unit; all others are
neither read nor written. ``kpi_base`` gains the counts of the written rows and
loses those of the rows they replace. Only ``force``, or a Silver table whose
changes cannot be told (no mark), takes the full build. When the Silver
versions are unchanged, nothing is done.

KPI tables are a handful of rows, so they are written as a single file; the
master keeps the parallelism of the join.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.operators.gold import (
    KPI_DIMENSIONS,
    kpi_base,
    kpi_by_department,
    kpi_company_size,
    kpi_dominant_sector,
    master_table,
)
from registrum.functions.columns import ntz
from registrum.operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast, left_join_checked
from registrum.sources import parquet as pq
from registrum.sources.staging import stage, staging
from registrum.sources.store import Layout, Snapshot, SnapshotStore, buckets_for
from registrum.spec import INGESTED_AT, KPI_BUSINESS_SIZE, KPI_BY_DEPARTMENT, KPI_DOMINANT_SECTORS, MASTER_LEGAL_UNIT_COLUMNS, MASTER_TABLE

KPI_NAMES = (KPI_BY_DEPARTMENT, KPI_DOMINANT_SECTORS, KPI_BUSINESS_SIZE)
KPI_BASE = "kpi_base"
INPUTS = ("etablissements", "unites_legales")
#: Segments of one level that the next one takes up.
MAX_SEGMENTS = 8
# A siren is split off the shuffle join only when it also holds this many
# establishments: below it, its rows fit comfortably in one task.
HOT_MIN_ROWS = 1_000_000


@dataclass(frozen=True)
class GoldResult:
    master_rows: int
    version: int
    kpis: dict
    mode: str = "replace"


def _silver(spark: SparkSession, silver_root: str, name: str) -> tuple[SnapshotStore, Snapshot]:
    store = SnapshotStore(spark, f"{silver_root.rstrip('/')}/{name}")
    snap = store.current()
    if snap is None:
        raise pq.MissingInput(f"Silver table {name} missing in {silver_root}. Run the Silver job first.")
    return store, snap


def followed(snap: Snapshot) -> dict:
    """What a build remembers of a Silver table."""
    return {"version": snap.version, "mark": snap.facts.get("mark"), "newest": snap.segments[-1].name if snap.segments else None}


def _follows(store: SnapshotStore, done) -> bool:
    """Whether the table is the one that was followed, not one made anew under its name."""
    then = store.version(done["version"]) if isinstance(done, dict) else None
    return then is not None and followed(then) == done


def changed_rows(store: SnapshotStore, snap: Snapshot, done: dict) -> DataFrame | None:
    """The rows inserted or changed since the version that was followed, as they are now; None if they
    cannot be told. Increments are strictly later than the mark, so a segment that mixes old and new rows
    is filtered by it."""
    newer = snap.newer_than(done["version"])
    rows = store.rows_of(snap, newer)
    if all(s.fresh for s in newer):
        return rows
    if not done.get("mark") or INGESTED_AT not in rows.columns:
        return None
    return rows.filter(F.col(INGESTED_AT) > ntz(datetime.fromisoformat(done["mark"])))


def _numbers(rows: DataFrame, layout: Layout) -> set[int]:
    """The buckets that rows fall into: bounded by the layout."""
    if layout.buckets == 1:
        return set() if rows.isEmpty() else {0}
    return {r[0] for r in rows.select(layout.bucket()).distinct().collect()}


def _matching(old: DataFrame, new: DataFrame, on: str, how: str) -> DataFrame:
    """Semi- or anti-join of old rows with the keys of new ones, broadcast when measured small."""
    keys = new.select(F.col(on).alias("_k")).distinct()
    keys = F.broadcast(keys) if fits_broadcast(keys, DEFAULT_BROADCAST_BYTES) else keys
    return old.join(keys, old[on] == F.col("_k"), how)


def touched_buckets(store: SnapshotStore, master: Snapshot, etab: DataFrame, ul: DataFrame) -> set[int]:
    """Master buckets that hold a changed establishment or the siren of a new or changed legal unit. Of
    the buckets the new rows fall into only the key columns are read."""
    out: set[int] = set()
    for new, key in ((ul, "siren"), (etab, "siret")):
        if len(out) == master.layout.buckets:
            break
        candidates = _numbers(new, master.layout)
        if candidates:
            held = store.rows_of(master, buckets=candidates).select("siret", "siren")
            out |= _numbers(_matching(held, new, key, "left_semi"), master.layout)
    return out


def updated_rows(old: DataFrame, etab: DataFrame, ul: DataFrame, max_broadcast_bytes: int | None) -> DataFrame:
    """Old master rows without the changed establishments, with the legal-unit columns of the changed units."""
    kept = _matching(old, etab, "siret", "left_anti")
    late = ul.select("siren", *[F.col(c).alias(f"_late_{c}") for c in MASTER_LEGAL_UNIT_COLUMNS], F.lit(True).alias("_late"))
    joined = left_join_checked(kept, late, "siren", max_broadcast_bytes, True, None, HOT_MIN_ROWS)
    legal = {c: F.when(F.col("_late"), F.col(f"_late_{c}")).otherwise(F.col(c)) for c in MASTER_LEGAL_UNIT_COLUMNS}
    return joined.withColumns(legal).select(*old.columns)


def replaced_rows(store: SnapshotStore, before: Snapshot, after: Snapshot) -> DataFrame:
    """The rows of ``before`` whose directories ``after`` does not list: rewritten or taken up."""
    live = {p for s in after.segments for p in s.paths()}
    gone = [replace(s, buckets={b: n for b, n in s.buckets.items() if s.paths({b})[0] not in live}) for s in before.segments]
    return store.rows_of(before, gone)


def signed_base(base: DataFrame, written: DataFrame, replaced: DataFrame) -> DataFrame:
    """``kpi_base`` with the counts of the written rows added and those of the replaced ones taken off."""
    minus = kpi_base(replaced).withColumn("n", -F.col("n"))
    total = base.unionByName(kpi_base(written)).unionByName(minus).groupBy(*KPI_DIMENSIONS).agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") != 0)


def legal_units_of(store: SnapshotStore, snap: Snapshot, etab: DataFrame) -> DataFrame:
    """The legal units that can match: of the buckets that the establishments' sirens fall into."""
    if snap.layout is None or snap.layout.key != "siren":
        return store.rows_of(snap)
    return store.rows_of(snap, buckets=_numbers(etab.filter(F.col("siren").isNotNull()), snap.layout))


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES,
    force: bool = False,
    buckets: int | None = None,
) -> GoldResult:
    """``buckets`` is used by full builds alone; unset, it follows from the size of Silver."""
    gold_root = gold_root.rstrip("/")
    tables = {n: _silver(spark, silver_root, n) for n in INPUTS}
    (etab_store, etab_snap), (ul_store, ul_snap) = (tables[n] for n in INPUTS)
    inputs = {n: followed(s) for n, (_, s) in tables.items()}
    # row counts from the commit markers, no scan
    ul_rows, etab_rows = ul_snap.facts.get("rows"), etab_snap.facts.get("rows")

    master_store = SnapshotStore(spark, f"{gold_root}/{MASTER_TABLE}")
    base_store = SnapshotStore(spark, f"{gold_root}/{KPI_BASE}")
    kpi_stores = {n: SnapshotStore(spark, f"{gold_root}/{n}") for n in KPI_NAMES}
    done, base_done = master_store.current(), base_store.current()
    prev = (done.facts.get("inputs") or {}) if done else {}

    def derived_from(snap: Snapshot | None, master: Snapshot) -> bool:
        return snap is not None and snap.facts.get("master_version") == master.version

    same = not force and done is not None and all(n in prev and _follows(store, prev[n]) for n, (store, _) in tables.items())
    if same and not any(snap.newer_than(prev[n]["version"]) for n, (_, snap) in tables.items()):
        kpis = [s.current() for s in kpi_stores.values()]
        if derived_from(base_done, done) and all(derived_from(k, done) for k in kpis):
            # Same Silver versions as the last build: Gold is already current.
            paths = {n: k.path for n, k in zip(KPI_NAMES, kpis)}
            return GoldResult(int(done.facts["rows"]), done.version, paths, "unchanged")
        # the master was committed but a KPI commit was lost: finish from it
        return _publish_kpis(spark, done, base_store, kpi_stores, kpi_base(master_store.read()), "resumed")

    known = same and done.layout is not None and derived_from(base_done, done)
    changes = [changed_rows(store, snap, prev[n]) if known else None for n, (store, snap) in tables.items()]
    if known and all(c is not None for c in changes):
        with staging(spark):
            # read several times: the increments alone
            etab, ul = (stage(df, f"gold-{n}")[0] for df, n in zip(changes, INPUTS))
            touched = touched_buckets(master_store, done, etab, ul)
            old = master_store.rows_of(done, buckets=touched) if touched else None
            left = None if etab_rows is None else max(0, int(etab_rows) - int(done.facts["rows"]))
            rows = master_table(etab, legal_units_of(ul_store, ul_snap, etab), max_broadcast_bytes, True, None, HOT_MIN_ROWS, left)
            if touched:
                rows = updated_rows(old, etab, ul, max_broadcast_bytes).unionByName(rows.select(*old.columns))
            snap = master_store.publish(rows, mode="append", facts={"inputs": inputs}, layout=done.layout, replaces=touched, fan_in=MAX_SEGMENTS)
            base = signed_base(base_store.read(), master_store.rows_of(snap, snap.newer_than(done.version)), replaced_rows(master_store, done, snap))
            return _publish_kpis(spark, snap, base_store, kpi_stores, base, "update" if touched else "append")

    etab, ul = etab_store.rows_of(etab_snap), ul_store.rows_of(ul_snap)
    layout = Layout("siren", buckets or buckets_for(sum(pq.size_of(spark, s.root) for s in (etab_store, ul_store))))
    snap = master_store.publish(
        master_table(etab, ul, max_broadcast_bytes, True, ul_rows, HOT_MIN_ROWS, etab_rows),
        facts={"inputs": inputs},
        layout=layout,
    )
    # one scan of three master columns; a few thousand rows whatever the size
    return _publish_kpis(spark, snap, base_store, kpi_stores, kpi_base(master_store.read()), "replace")


def _publish_kpis(
    spark: SparkSession,
    master: Snapshot,
    base_store: SnapshotStore,
    kpi_stores: dict[str, SnapshotStore],
    base: DataFrame,
    mode: str,
) -> GoldResult:
    """Publish ``kpi_base`` and the three KPIs, each stamped with the master
    version they come from, so a lost commit is detected and finished."""
    stamp = {"master_version": master.version}
    base_snap = base_store.publish(base, files=1, facts=stamp)
    stored = spark.read.parquet(base_snap.path)
    kpis = {
        KPI_BY_DEPARTMENT: kpi_by_department(stored, "n"),
        KPI_DOMINANT_SECTORS: kpi_dominant_sector(stored, "n"),
        KPI_BUSINESS_SIZE: kpi_company_size(stored, "n"),
    }
    out = {name: kpi_stores[name].publish(df, files=1, facts=stamp).path for name, df in kpis.items()}
    return GoldResult(int(master.facts["rows"]), master.version, out, mode)


def read_gold(spark: SparkSession, gold_root: str, name: str):
    df = SnapshotStore(spark, f"{gold_root.rstrip('/')}/{name}").read()
    if df is None:
        raise pq.MissingInput(f"Gold table {name} missing in {gold_root}")
    return df


def dominant_sector_for(spark: SparkSession, gold_root: str, department: str):
    return read_gold(spark, gold_root, KPI_DOMINANT_SECTORS).filter(F.col("departement") == department)

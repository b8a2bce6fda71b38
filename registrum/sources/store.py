"""Versioned snapshot store on plain Parquet.

Overwriting a Parquet path that the same job reads empties it on failure, and
plain Parquet has no transaction log. Each publication therefore writes a new
directory ``<root>/v=<n>-<attempt>/`` (unique per attempt, so two writers
racing for version n never write into the same directory), validates the
written files, and only then puts the commit marker ``<root>/_commits/<n>`` in
place: a tiny file written under another name and renamed without overwriting, so
a marker is whole or absent (the loser of a race fails here and its directory is
left unreferenced). A torn marker from elsewhere is ignored and its number left. The marker lists the directories that make up the table at
that version:

* ``replace``: the table is ``[v=n]`` alone (a full rewrite);
* ``append``: the table is the previous list plus ``v=n`` (an increment whose
  keys are all new, so nothing older has to be rewritten).

A table with a ``Layout`` is dealt into buckets by a hash of its key, each a
subdirectory of its segment, and the marker says which buckets of a segment are
live. A publication may then name buckets that it ``replaces``: their older
directories leave the list, those of all other buckets are neither read nor
written. With ``fan_in``, an append takes up the newest segments once that many
of one level are there, as a counter carries: a row is rewritten once per level,
n log n in all, and a carry beyond ``max_carry_rows`` is left out, which bounds
what one run writes. Each segment keeps the newest version whose rows it holds
(``upto``) and whether it holds new rows only (``fresh``), so a reader that has
followed the table up to a version sees which segments can hold anything newer.

Readers resolve the highest committed version and read exactly its listed
directories; an uncommitted or failed directory is invisible and is simply
rewritten by the next attempt. The marker also carries small facts (row
count, high-water mark) so later jobs read them without a scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from registrum.sources import parquet as pq

COMMITS = "_commits"
PROFILES = "_profiles"
#: Rows that one run carries into its segment at most; larger segments stay as they are.
MAX_CARRY_ROWS = 200_000_000


BUCKET = "_bucket"


@dataclass(frozen=True)
class Layout:
    """Rows dealt into ``buckets`` by a hash of ``key``."""

    key: str
    buckets: int

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Segment:
    """A directory of the table; ``buckets`` maps its live buckets to their rows (None: not dealt)."""

    name: str
    buckets: dict[int, int] | None = None
    upto: int = 0
    fresh: bool = False
    level: int = 0

    @property
    def rows(self) -> int:
        return sum((self.buckets or {}).values())

    def paths(self, only: set[int] | None = None) -> list[str]:
        if self.buckets is None:
            return [self.name]
        return [f"{self.name}/{BUCKET}={b}" for b in sorted(self.buckets) if only is None or b in only]

    def without(self, buckets: set[int]) -> Segment:
        return replace(self, buckets={b: n for b, n in self.buckets.items() if b not in buckets})

    def entry(self) -> dict:
        return {"name": self.name, "buckets": self.buckets, "upto": self.upto, "fresh": self.fresh, "level": self.level}

    @classmethod
    def of(cls, entry) -> Segment:
        """From a marker entry; a bare name or number is a whole directory of an older marker."""
        if not isinstance(entry, dict):
            name = f"v={entry:08d}" if isinstance(entry, int) else entry
            return cls(name, upto=int(name[2:10]))
        buckets = entry["buckets"]
        return cls(entry["name"], None if buckets is None else {int(b): n for b, n in buckets.items()}, entry["upto"], entry["fresh"], entry["level"])


@dataclass(frozen=True)
class Snapshot:
    version: int
    paths: tuple[str, ...]
    facts: dict = field(default_factory=dict)
    segments: tuple[Segment, ...] = ()
    layout: Layout | None = None
    schema: StructType | None = None

    @property
    def path(self) -> str:
        """The directory written by this version."""
        return self.paths[-1]

    def newer_than(self, version: int) -> list[Segment]:
        """The segments that can hold rows of later versions."""
        return [s for s in self.segments if s.upto > version]


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 24 * 3600.0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self.grace_seconds = grace_seconds

    def _marker(self, n: int) -> str:
        return f"{self.root}/{COMMITS}/{n:08d}"

    def _snapshot(self, n: int, facts: dict, segments: list[Segment], layout: Layout | None, schema: StructType | None) -> Snapshot:
        paths = tuple(f"{self.root}/{p}" for s in segments for p in s.paths())
        return Snapshot(n, paths, facts, tuple(segments), layout, schema)

    def _load(self, n: int) -> Snapshot | None:
        """The version's snapshot, or None if its marker is torn (empty, cut off or
        without its directories): such a version was never committed."""
        try:
            facts = json.loads(pq.read_text(self.spark, self._marker(n)))
            segments = [Segment.of(x) for x in facts.pop("segments")]
            layout, schema = facts.pop("layout", None), facts.pop("schema", None)
        except (ValueError, KeyError, AttributeError):
            return None
        return self._snapshot(n, facts, segments, Layout(**layout) if layout else None, StructType.fromJson(schema) if schema else None)

    def numbers(self) -> list[int]:
        """Version numbers that have a marker, torn ones included."""
        names = pq.list_names(self.spark, f"{self.root}/{COMMITS}")
        return sorted(int(x) for x in names if x.isdigit())

    def committed(self) -> list[int]:
        return [n for n in self.numbers() if self._load(n) is not None]

    def _head(self) -> tuple[Snapshot | None, int]:
        """The newest snapshot and the number of the next version, from one listing: a
        number that no marker has, so a torn marker is left behind, not replaced, and a
        writer that commits meanwhile takes that number first."""
        numbers = self.numbers()
        loaded = (self._load(n) for n in reversed(numbers))
        return next((s for s in loaded if s is not None), None), max(numbers, default=0) + 1

    def current(self) -> Snapshot | None:
        return self._head()[0]

    def version(self, n: int) -> Snapshot | None:
        """A committed version, None if there is none of that number."""
        return self._load(n) if pq.exists(self.spark, self._marker(n)) else None

    def _commit(self, n: int, facts: dict, segments: list[Segment], layout: Layout | None, schema: StructType | None) -> Snapshot:
        """Put the marker in place whole: written under another name, then renamed."""
        marker = {**facts, "segments": [s.entry() for s in segments]}
        if layout:
            marker |= {"layout": {"key": layout.key, "buckets": layout.buckets}, "schema": schema.jsonValue()}
        pq.write_text_once(self.spark, self._marker(n), json.dumps(marker, default=str))
        return self._snapshot(n, facts, segments, layout, schema)

    def read(self) -> DataFrame | None:
        snap = self.current()
        return None if snap is None else self.rows_of(snap)

    def rows_of(self, snap: Snapshot, segments: Sequence[Segment] | None = None, buckets: set[int] | None = None) -> DataFrame:
        """Rows of a snapshot, or of some of its segments and buckets: only their directories are listed."""
        chosen = snap.segments if segments is None else segments
        paths = [f"{self.root}/{p}" for s in chosen for p in s.paths(buckets)]
        reader = self.spark.read if snap.schema is None else self.spark.read.schema(snap.schema)
        if not paths:
            whole = snap.schema or self.spark.read.parquet(*snap.paths).schema
            return self.spark.createDataFrame([], whole)
        return reader.parquet(*paths)

    def profiles(self, snap: Snapshot) -> DataFrame | None:
        """The profile rows of a snapshot's live buckets; None if one of its segments has none."""
        if snap.layout is None or not snap.segments or not all(pq.exists(self.spark, f"{self.root}/{PROFILES}/{s.name}") for s in snap.segments):
            return None
        parts = [self.spark.read.parquet(f"{self.root}/{PROFILES}/{s.name}").filter(F.col(BUCKET).isin(sorted(s.buckets))) for s in snap.segments]
        return reduce(DataFrame.unionByName, parts)

    def publish(
        self,
        df: DataFrame,
        validate: Callable[[DataFrame], dict] | None = None,
        files: int | None = None,
        mode: str = "replace",
        facts: dict | None = None,
        layout: Layout | None = None,
        replaces: set[int] | None = None,
        fan_in: int = 0,
        max_carry_rows: int = MAX_CARRY_ROWS,
        profile: Callable[[DataFrame, str], DataFrame] | None = None,
    ) -> Snapshot:
        """Write ``df`` as the next version, validate the written files, commit.

        ``validate`` receives the written directory read back from storage (so
        the lineage is cut and executors lost later cannot force a recompute);
        it raises to abort, or returns facts stored in the commit marker.
        Nothing becomes visible unless it returns. ``mode="append"`` keeps the
        previous directories in the new version, without the buckets that ``df``
        ``replaces`` and the segments that it carries (``fan_in``); with a layout
        the marker's ``rows`` count the whole table. ``facts`` are stored as given.
        ``profile`` makes rows per bucket from the written rows and the bucket column's
        name; they are kept beside the segment (``profiles``).
        """
        if mode not in ("replace", "append"):
            raise ValueError(mode)
        cur, n = self._head()
        if mode == "append" and cur is not None and cur.layout != layout:
            raise ValueError(f"{self.root}: {layout} appended to a table with {cur.layout}")
        kept = list(cur.segments) if cur is not None and mode == "append" else []
        if replaces:
            kept = [s for s in (s.without(replaces) for s in kept) if s.buckets]
        kept, carried, level = carry(kept, fan_in, max_carry_rows) if layout else (kept, [], 0)
        if carried:
            df = df.unionByName(self.rows_of(cur, carried).select(*df.columns))
        name = f"v={n:08d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}"
        schema = df.schema
        if layout:
            # dealt by bucket; a bucket of a hot key is split into several files, small ones share a task
            out = df.withColumn(BUCKET, layout.bucket()).hint("rebalance", F.col(BUCKET))
            out.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
            staged = self.spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())])).parquet(path)
            buckets = {r[0]: r[1] for r in staged.groupBy(BUCKET).count().collect()}  # one row per bucket
            if profile:
                profile(staged, BUCKET).write.mode("overwrite").parquet(f"{self.root}/{PROFILES}/{name}")
            staged = staged.drop(BUCKET)
        else:
            # repartition, not coalesce: what makes the rows keeps its parallelism
            (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)
            staged, buckets = self.spark.read.parquet(path), None
        facts = {**(facts or {}), **(validate(staged) if validate else {})}
        fresh = mode == "append" and not replaces and not carried
        segments = [*kept, Segment(name, buckets, n, fresh, level)]
        if layout:
            segments = [s for s in segments if s.buckets]
            facts["rows"] = sum(s.rows for s in segments)
        snap = self._commit(n, facts, segments, layout, schema if layout else None)
        self._prune(n)
        return snap

    def touch(self, facts: dict) -> Snapshot | None:
        """Commit a new version with the same directories and updated facts
        (metadata only: e.g. a run that read batches but accepted no row)."""
        cur, n = self._head()
        if cur is None:
            return None
        return self._commit(n, {**cur.facts, **facts}, list(cur.segments), cur.layout, cur.schema)

    def _prune(self, newest: int) -> None:
        """Drop directories that the newest ``keep`` versions do not reference and that
        are older than the grace period, so that a long reader finishes its scan."""
        live = {p for v in self.committed()[-self.keep :] for s in self._load(v).segments for p in s.paths()}
        names = {p.split("/")[0] for p in live}
        for name, age in pq.list_ages(self.spark, self.root):
            if not (name.startswith("v=") and name[2:10].isdigit()) or int(name[2:10]) >= newest or age < self.grace_seconds:
                continue
            if name not in names:
                pq.delete(self.spark, f"{self.root}/{name}")
                pq.delete(self.spark, f"{self.root}/{PROFILES}/{name}")
            elif name not in live:
                for part in pq.list_names(self.spark, f"{self.root}/{name}"):
                    if part.startswith(f"{BUCKET}=") and f"{name}/{part}" not in live:
                        pq.delete(self.spark, f"{self.root}/{name}/{part}")


def carry(segments: list[Segment], fan_in: int, max_rows: int) -> tuple[list[Segment], list[Segment], int]:
    """(kept, taken up, level): the newest segments of one level are taken up while there are ``fan_in``
    of them and the rows stay within ``max_rows``, as a counter to that base carries."""
    kept, taken, level = list(segments), [], 0
    while fan_in > 1 and len(kept) >= fan_in:
        last = kept[-fan_in:]
        if any(s.level != level for s in last) or sum(s.rows for s in [*taken, *last]) > max_rows:
            break
        kept, taken, level = kept[:-fan_in], [*last, *taken], level + 1
    return kept, taken, level


def buckets_for(input_bytes: int, bucket_bytes: int = 512 << 20, most: int = 8192) -> int:
    """Buckets of a new table, from the size of its first input."""
    return max(1, min(most, -(-input_bytes // bucket_bytes)))

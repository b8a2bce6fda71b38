"""Exact Jaccard join of word-shingle sets, by recursive regions of the metric space.

Jaccard distance is a metric. Documents link at a distance of 1 - p / 100 or less (p: `percent`).

1. Equal sets are one point (their smallest doc_id stands for them), so exact copies cost nothing more.
2. Unrelated documents all lie at distances near 1 from any pivot, where Voronoi regions of documents
   separate nothing. So the first split uses another metric that the same pivots serve: the symmetric
   difference, which links bound by T = 2 (100 - p) / (100 + p) times the size. Pivots are classes of
   shingles (by hash), a point's regions are its exact projections on T + 1 + j of the classes that it has
   shingles in (T: of the point and its largest partner; j: a quarter of the ring's largest T, and one): those with
   most shingles, ties by class. Two points within T differ in at most T classes (each costs 1 at least). The
   order of projections is the same for both, so at most T of either's come before or among the first j + 1 that
   they have in common: no link is lost, and a linked point shares j + 1 of its regions with others (all but T, if
   it has fewer than T + 1 + j). Points that
   share fewer leave before an edge is made: a passage in common or chance gives one or two. Points with
   shingles in T classes or fewer may have none in common; they also meet by single shingles, as many
   of the smallest hashes as one more than a link may differ in. Sizes are cut into rings, and a point joins
   its own ring and the next, as far as a partner's size can reach; the two count apart (slots).
3. The regions' graph falls into connected candidates, mostly families of near copies. A candidate
   of up to `most` points (or as many times 4,000 bytes) is joined in one task. Of larger ones the points
   that share too few shingles with all others for any link drop out (they have a passage in common,
   no more), and the rest is cut into candidates anew, by their rarest shingles: a link holds p percent of either
   point's shingles, so the rarest one that the two have in common is among the first size - p percent + 1 of
   either, rarest first. Families that only share a passage, whose shingles are common, so fall apart. What is still
   too large is split: pivots are documents of it, each
   point goes to the Voronoi region of its nearest pivot and, by the triangle inequality, to every region whose
   pivot is at most 2 * (1 - p / 100) further away, where a partner could be. The places are found without moving a
   text; where the regions would repeat the points too often or hardly shrink, the texts stay where they are and are
   joined block by block, all pairs of blocks, so memory and disk stay bounded and the result exact. Regions that are
   still too large are split again.
4. In a task, points whose shingles are too rarely shared for any link drop out first (again and again, as that
   makes others rare). Then one pivot after another is compared with the points that are left, linked
   ones join its component, and triangle windows leave only those to compare that could link elsewhere.

Shingles and sets are 64 and 128 bit hashes; sets are compared as such.

Defined results: null text and text without words have no shingles and link with nothing; fewer words
than a shingle has are one shingle; rows with equal doc_id are one document, which links by any of
its texts; a null doc_id links with nothing and has a null component; repeated rows are repeated in
the result; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.llm.common import as_bytes, discard, may_be_in, scratch, slices, text_column, written
from registrum.llm.common import release as _release
from registrum.llm.components import components
from registrum.llm.suffix_dedup import _by_bucket, _pack, _unpack

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _tidy(function: Callable) -> Callable:
    """The function on one table or two, after which the worker, which lives on beside others, gives its memory back."""

    def done(*tables: pa.Table) -> pa.Table:
        try:
            return function(*tables)
        finally:
            _WORDS.clear()
            _release()

    def of_one(rows: pa.Table) -> pa.Table:
        return done(rows)

    def of_two(rows: pa.Table, others: pa.Table) -> pa.Table:
        return done(rows, others)

    return of_one if function.__code__.co_argcount == 1 else of_two


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the sorted distinct shingle hashes of each text, one after the other."""
    if len(_WORDS) > 200_000:
        _WORDS.clear()
    split = [x.lower().split() for x in texts]  # ASCII letters and white space only, as bytes
    counts = np.array([len(x) for x in split], np.int64)
    flat = np.fromiter((h for x in split for h in map(_WORDS.__getitem__, x)), np.uint64, int(counts.sum()))
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(flat)) - np.repeat(ends - counts, counts)
    n = len(flat) - words + 1
    if n > 0:
        hashes = np.zeros(n, np.uint64)
        for i in range(words):
            hashes = _mix(hashes * _B + flat[i : i + n] * _A + np.uint64(1))
        on = place[:n] <= np.repeat(counts, counts)[:n] - words
        hashes, owner = hashes[on], owner[:n][on]
    else:
        hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < words))
    if len(few):
        whole = np.array([xxhash.xxh3_64_intdigest(b"\0".join(split[i])) for i in few.tolist()], np.uint64)
        hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(hashes) else np.zeros(0, bool)
    return hashes[new], np.cumsum(np.bincount(owner[new], minlength=len(texts)))


def rings(percent: int, largest: int) -> np.ndarray:
    """Lower limits of the size rings up to `largest` and one more; a link spans two rings at most. A ring is as
    wide as two links reach, so that only some of its points have a partner in the next one."""
    limits = [1]
    while limits[-1] <= largest:
        limits.append(_reach(_reach(limits[-1], percent), percent) + 1)
    return np.array([*limits, _reach(_reach(limits[-1], percent), percent) + 1], np.int64)


def _reach(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Size of a point's largest partner."""
    return size * 100 // percent


#: Least and most bits of a region's id; two that get the same id only meet without need.
MIN_REGION_BITS, REGION_BITS = 40, 56


def region_bits(text_bytes: int) -> int:
    """Bits for the regions of so much text (a tenth of a region a byte): one in some thousands meets without need."""
    return min(REGION_BITS, max(MIN_REGION_BITS, text_bytes.bit_length() + 10))


#: Slots of a point: its own ring, the next one, single shingles.
SLOTS = 3


def signatures(hashes: np.ndarray, ends: np.ndarray, percent: int, bits: int = REGION_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(regions, slots, needs): the region ids (of `bits` bits) of each set, by slot (SLOTS * set + 0 to 2), and how many regions each
    slot must share with other sets for a link. Of two different sets that link, a slot each shares
    that many with the other's."""
    sizes = np.diff(ends, prepend=0)
    partner = _reach(sizes, percent)
    limits = rings(percent, int(partner.max(initial=1)) + 1)
    own = np.searchsorted(limits, sizes, side="right") - 1
    reach = np.searchsorted(limits, partner, side="right") - 1
    out: list[tuple[np.ndarray, np.ndarray]] = []
    needs = np.ones((len(sizes), SLOTS), np.int64)
    short = np.uint64(64 - bits)
    owner_all = np.repeat(np.arange(len(sizes)), sizes)
    sparse = np.zeros(len(sizes), bool)
    for slot, (ring, takes) in enumerate(((own, sizes > 0), (own + 1, (sizes > 0) & (reach > own)))):
        most = limits[ring + 1] - 1  # largest size in the ring
        largest = 2 * (100 - percent) * most // (100 + percent)
        classes = largest + 1 + np.maximum(2, -(-8 * largest // 10))
        more = 1 + largest // 4  # j
        differ = (100 - percent) * (sizes + np.minimum(most, partner)) // (100 + percent)  # T
        takes = takes & (differ > 0)  # at T = 0 only equal sets link
        on = takes[owner_all]
        owner, h = owner_all[on], hashes[on]
        cls = (_mix(h + ring[owner].astype(np.uint64) * _A) % classes[owner].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((cls, owner))
        owner, cls, h = owner[order], cls[order], _mix(h[order] * _B + _C)
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (cls[1:] != cls[:-1])])) if len(owner) else np.zeros(0, np.int64)
        if len(first):
            total = np.add.reduceat(h, first)
            held = np.diff(np.append(first, len(owner)))
            owner, cls = owner[first], cls[first]
            order = np.argsort(owner * (held.max() + 1) - held, kind="stable")  # most shingles first, then by class
            owner, cls, total = owner[order], cls[order], total[order]
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            rank = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
            region = _mix(total + _mix(cls.astype(np.uint64) * _B + ring[owner].astype(np.uint64))) >> short
            kept = rank <= (differ + more)[owner]
            out.append((region[kept], owner[kept] * SLOTS + slot))
        filled = np.bincount(owner, minlength=len(sizes)) if len(first) else np.zeros(len(sizes), np.int64)
        sparse |= takes & (filled <= differ)
        needs[:, slot] = np.minimum(more + 1, filled - differ)
        if len(first):  # two of its own regions with one id count once
            region, owner = region[kept], owner[kept]
            order = np.lexsort((region, owner))
            region, owner = region[order], owner[order]
            needs[:, slot] -= np.bincount(owner[1:][(region[1:] == region[:-1]) & (owner[1:] == owner[:-1])], minlength=len(sizes))
    on = sparse[owner_all]
    owner, h = owner_all[on], _mix(hashes[on] * _A + _B)
    if len(owner):
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        rank = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
        kept = rank <= sizes[owner] - -(-sizes[owner] * percent // 100)
        out.append((_mix(h[kept] + _C) >> short, owner[kept] * SLOTS + 2))
    needs = np.maximum(1, needs).ravel()
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), needs
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out]), needs


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of n points' component."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return np.array([top(x) for x in range(n)], np.int64)


def links_within(hashes: np.ndarray, ends: np.ndarray, percent: int, sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the sets as all links do (a spanning set of them): pairs (a, b) of positions.

    With `sides` (0 or 1 for each set) at least all links between the two sides count, those inside one
    may be left to other tasks."""
    begins, n = np.concatenate([[0], ends[:-1]]).astype(np.int64), len(ends)
    sizes = ends - begins
    alive = sizes > 0
    names, ids = np.unique(hashes, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    on = np.ones(len(ids), bool)  # shingles of live points that are shared
    while True:  # a point needs percent of its shingles in other live points
        on &= alive[owner]
        spread = np.bincount(ids[on], minlength=len(names))
        on &= spread[ids] > 1
        enough = np.bincount(owner[on], minlength=n) * 100 >= percent * sizes
        if (alive & ~enough).any():
            alive &= enough
        else:
            break
    points = np.flatnonzero(alive)
    ids, owner = ids[on], owner[on]
    out: list[tuple[int, int]] = []
    order = points[np.lexsort((points, sizes[points]))]
    number = np.full(n, -1)
    number[order] = np.arange(len(order))
    resort = np.argsort(number[owner], kind="stable")
    ids, held = ids[resort], np.bincount(number[owner], minlength=len(order))
    stops = np.cumsum(held)
    starts = stops - held
    size = sizes[order]
    label = np.arange(len(order))  # component of each point so far
    open_ = np.ones(len(order), bool)
    mark = np.zeros(len(names), np.int64)
    near = (100 - percent) / 100 + 1e-9
    away = np.ones(len(order))

    def overlaps(p: int, others: np.ndarray) -> np.ndarray:
        """Shared shingles of p and each of the others."""
        mark[ids[starts[p] : stops[p]]] = 1
        lengths = held[others]
        at = np.repeat(starts[others] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(int(lengths.sum()))
        hit = np.concatenate([[0], np.cumsum(mark[ids[at]])])
        bounds = np.cumsum(lengths)
        mark[ids[starts[p] : stops[p]]] = 0
        return hit[bounds] - hit[bounds - lengths]

    def join(a: int, b: int) -> None:
        if label[a] != label[b]:
            out.append((int(order[a]), int(order[b])))
            label[label == max(label[a], label[b])] = min(label[a], label[b])

    while open_.any():
        p = int(open_.argmax())
        open_[p] = False
        # partners by size: the triangle inequality with the empty set as pivot
        others = np.flatnonzero(open_ & (size * percent <= 100 * size[p]) & (size[p] * percent <= 100 * size))
        if not len(others):
            continue
        both = overlaps(p, others)
        union = size[p] + size[others] - both
        distance = 1 - both / union
        linked = others[100 * both >= percent * union]
        if sides is None:
            for x in linked.tolist():
                join(p, x)
        else:
            for x in linked.tolist():
                if sides[order[x]] != sides[order[p]]:
                    join(p, x)
            continue
        # A partner y of a linked x has distance(p, y) <= 2 near; y must also be open and of another component.
        # Sizes outside p's window belong to such y too, so the shell is taken from all open points.
        if len(linked):
            wide = np.flatnonzero(open_ & (label != label[p]) & (size * percent * percent <= 10_000 * size[p]) & (size[p] * percent * percent <= 10_000 * size))
            away[others] = distance
            missing = np.setdiff1d(wide, others, assume_unique=True)
            if len(missing):
                more = overlaps(p, missing)
                away[missing] = 1 - more / (size[p] + size[missing] - more)
            wide = wide[away[wide] <= 2 * near]
            for x in linked.tolist():
                shell = wide[(away[wide] <= away[x] + near) & (label[wide] != label[x]) & open_[wide]]
                if len(shell):
                    again = overlaps(x, shell)
                    for y in shell[100 * again >= percent * (size[x] + size[shell] - again)].tolist():
                        join(x, y)
                open_[x] = False  # all its possible partners are joined or compared
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _distances(pivot: np.ndarray, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(pivot):
        return np.ones(len(ends))
    found = pivot[np.minimum(np.searchsorted(pivot, hashes), len(pivot) - 1)] == hashes
    inside = np.concatenate([[0], np.cumsum(found)])
    sizes = np.diff(ends, prepend=0)
    both = inside[ends] - inside[ends - sizes]
    return 1 - both / np.maximum(1, len(pivot) + sizes - both)


PLACE = "region string, pivot long, doc_id long, mark long, bytes long"
#: Regions are split if the splits' squares come to this share of its square at most, and their points to so many times its own.
SHRINKS, REPEATS = 0.64, 4


def _places(points: DataFrame, sizes: DataFrame, words: int, percent: int, most: int) -> DataFrame:
    """Rows of PLACE, without texts: for the points of large regions (sizes: region, n) the Voronoi regions (by pivot) of
    pivots among them; a point on the border has one for each region where a partner could be. mark: of the text."""
    wanted = F.least(F.lit(64), F.ceil(F.col("n") / most) * 2 + 1)
    large = points.join(sizes, "region")
    # pivots by hash: `wanted` of them expected, so their number and bytes are bounded for each region
    pivots = large.where(F.pmod(F.xxhash64("region", "doc_id"), F.col("n")) < wanted).select("region", F.col("doc_id").alias("pivot"), F.col("text").alias("pivot_text"))
    salts = F.ceil(F.col("n") / most).cast("int")
    left = large.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), salts).cast("int")).select("region", "salt", "doc_id", F.xxhash64("text").alias("mark"), "text")
    right = pivots.join(sizes, "region").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select(F.col("region").alias("of"), F.col("salt").alias("part"), "pivot", "pivot_text")
    reach = 2 * (100 - percent) / 100 + 1e-9

    def place(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        schema = pa.schema([("region", pa.string()), *[(x, pa.int64()) for x in ("pivot", "doc_id", "mark", "bytes")]])
        if not rows.num_rows:
            return schema.empty_table()
        names = pivots.column("pivot").to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        own_hashes, own_ends = shingle_sets(as_bytes(pivots.column("pivot_text").combine_chunks()), words)
        starts = np.concatenate([[0], own_ends[:-1]]).astype(int)
        far = np.zeros((max(1, len(names)), rows.num_rows), np.float32)
        at = 0
        for piece in slices(iter(rows.to_batches()), "text", 2 << 20):
            hashes, ends = shingle_sets(as_bytes(piece.column("text")), words)
            for k, i in enumerate(order):
                far[k, at : at + piece.num_rows] = _distances(own_hashes[starts[i] : own_ends[i]], hashes, ends)
            at += piece.num_rows
        row, where = np.nonzero((far <= far.min(0) + np.float32(reach + 1e-6)).T)  # single precision, rounded up
        pivot = np.array([names[i] for i in order] or [0], np.int64)[where]
        taken = rows.select(["doc_id", "mark"]).take(pa.array(row))
        weight = pc.binary_length(rows.column("text")).cast(pa.int64()).take(pa.array(row))
        parent = pa.repeat(rows.column("region")[0].cast(pa.string()), len(row))
        return pa.table([parent, pa.array(pivot), taken.column("doc_id"), taken.column("mark"), weight], schema=schema)

    return left.groupBy("region", "salt").cogroup(right.groupBy("of", "part")).applyInArrow(_tidy(place), PLACE)


def _split_regions(points: DataFrame, sizes: DataFrame, words: int, percent: int, most: int) -> tuple[DataFrame | None, DataFrame]:
    """(points, stuck): the points of large regions (sizes: region, n) in Voronoi regions, where those shrink without
    repeating too many points (None: nowhere); and the sizes of the regions where they do not."""
    places = written(_places(points, sizes, words, percent, most).distinct(), "places")
    parts = places.groupBy("region", "pivot").agg(F.greatest(F.count("*"), F.ceil(F.sum("bytes") / 4_000)).cast("double").alias("part"))
    cost = parts.groupBy("region").agg(F.sum("part").alias("all"), F.sum(F.col("part") * F.col("part")).alias("squares"))
    judged = written(sizes.join(cost, "region", "left").select("region", "n", F.expr(f"coalesce(squares <= {SHRINKS} * n * n AND all <= {REPEATS} * n, false)").alias("splits")), "judged")
    stuck, chosen = judged.where("NOT splits").select("region", "n"), judged.where("splits").select("region")
    if chosen.isEmpty():
        return None, stuck
    there = places.join(chosen, "region").select("region", "doc_id", "mark", F.concat_ws("/", "region", F.col("pivot").cast("string")).alias("part"))
    moved = points.join(chosen, "region", "left_semi").withColumn("mark", F.xxhash64("text")).join(there, ["region", "doc_id", "mark"])
    return moved.select(F.col("part").alias("region"), "doc_id", "text"), stuck


def _sets_of(texts: pa.Array, rows: list[int], words: int, max_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """shingle_sets of these rows' texts, about max_bytes of text at once."""
    batch = pa.RecordBatch.from_arrays([texts.take(pa.array(rows, pa.int64()))], ["text"])
    parts = [shingle_sets(as_bytes(piece.column("text")), words) for piece in slices(iter([batch]), "text", max_bytes)]
    shift = np.cumsum([0, *[len(h) for h, _ in parts]])
    return np.concatenate([h for h, _ in parts]), np.concatenate([e + s for (_, e), s in zip(parts, shift, strict=False)])


def _joined(points: DataFrame, words: int, percent: int, tasks: int | None) -> DataFrame:
    """Links (a, b) inside the regions of points (region, doc_id, text, side), many small regions a task, or (tasks None) one."""

    def join(rows: pa.Table) -> pa.Table:
        _release()
        regions = rows.column("region").to_pylist()
        ids, sides = rows.column("doc_id").to_pylist(), rows.column("side").to_pylist()
        texts = rows.column("text").combine_chunks()
        order = sorted(range(len(ids)), key=lambda i: (regions[i], ids[i]))
        a_all: list[int] = []
        b_all: list[int] = []
        at = 0
        while at < len(order):
            end = at
            while end < len(order) and regions[order[end]] == regions[order[at]]:
                end += 1
            group = order[at:end]
            at = end
            if len(group) > 1:
                hashes, ends = _sets_of(texts, group, words)
                crossed = np.array([sides[i] or 0 for i in group]) if any(sides[i] is not None for i in group) else None
                for x, y in zip(*links_within(hashes, ends, percent, crossed), strict=True):
                    a_all.append(ids[group[x]])
                    b_all.append(ids[group[y]])
        return pa.table({"a": pa.array(a_all, pa.int64()), "b": pa.array(b_all, pa.int64())})

    dealt = points if tasks is None else points.withColumn("task", F.pmod(F.xxhash64("region"), F.lit(tasks)))
    return dealt.groupBy("region" if tasks is None else "task").applyInArrow(_tidy(join), "a long, b long")


def _weights(points: DataFrame) -> DataFrame:
    """(region, n): the number of points, or of 4,000 bytes of text if that is more."""
    size = F.ceil(F.sum(F.octet_length("text")) / 4_000)
    return points.groupBy("region").agg(F.greatest(F.count("*"), size).cast("long").alias("n"))


def _in_regions(points: DataFrame, words: int, percent: int, most: int, tasks: int, depth: int = 4) -> DataFrame:
    """Links of all regions, splitting those of more than `most` points."""
    found = []
    now = points
    for level in range(depth + 1):
        large = written(_weights(now).where(F.col("n") > most), "large-regions")
        any_large = not large.isEmpty()
        small = now.join(large.select("region"), "region", "left_anti") if any_large else now
        found.append(_joined(small.withColumn("side", F.lit(None).cast("int")), words, percent, tasks))
        if not any_large:
            break
        # a region that its splits would repeat or hardly shrink stays whole; the last level splits none
        parts, stuck = _split_regions(now, large, words, percent, most) if level < depth else (None, large)
        blocks = F.ceil(F.col("n") / F.lit(max(1, most // 2))).cast("int")
        rows = now.join(stuck, "region").withColumn("blocks", blocks)
        rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pair = F.concat_ws("x", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
        side = F.when(F.col("own") == F.col("other"), F.lit(None)).otherwise((F.col("own") > F.col("other")).cast("int"))
        found.append(_joined(rows.select(F.concat_ws(":", "region", pair).alias("region"), "doc_id", "text", side.alias("side")), words, percent, None))
        if parts is None:
            break
        now = written(parts, "regions")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


PASS = "doc_id long, n_shingles long, key binary, name long, need_0 long, need_1 long, bucket int, regions binary, places binary, names binary, slots binary"


def _summaries(source: DataFrame, words: int, percent: int, buckets: int, bits: int) -> DataFrame:
    """Written rows of two kinds (PASS): a document's set key and size, with what its slots need (once for equal
    sets of a batch); packed region ids of many sets. A set's name is 64 bits of its key: two
    sets of one name count as one until their texts are compared."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in PASS.split(", ")]
        kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split(" ")[1]] for x in PASS.split(", ")]

        def rows(columns: dict[str, list], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names)

        seen: dict[bytes, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                regions, places = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
                set_names = np.frombuffer(b"".join(seen), "<i8")[::2]
                order = np.lexsort((places, regions))
                regions, places = regions[order], places[order]
                edges = np.searchsorted(regions, np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << bits) // buckets))
                for b, (lo, hi) in enumerate(zip([0, *edges.tolist()], [*edges.tolist(), len(regions)], strict=True)):
                    if lo < hi:
                        used, local = np.unique(places[lo:hi], return_inverse=True)
                        fresh_name = np.diff(used // SLOTS, prepend=-1) > 0  # a name is sent once for all its slots
                        packed = {"regions": _pack(np.diff(regions[lo:hi], prepend=np.uint64(0))), "places": _pack(local), "names": set_names[used[fresh_name] // SLOTS].tobytes(), "slots": _pack(used % SLOTS + SLOTS * fresh_name)}
                        yield rows({"bucket": [b]} | {c: [x] for c, x in packed.items()}, 1)
            held.clear()
            seen.clear()

        count = 0
        for piece in slices(batches, "text", 1 << 20):
            ids = piece.column("doc_id").to_pylist()
            hashes, ends = shingle_sets(as_bytes(piece.column("text")), words)
            begins = np.concatenate([[0], ends[:-1]]).astype(int)
            keys = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            need: dict[int, list[int]] = {}
            fresh = [i for i, k in enumerate(keys) if ids[i] is not None and begins[i] < ends[i] and (k not in seen and seen.setdefault(k, len(seen)) >= 0)]
            if fresh:
                parts = [hashes[begins[i] : ends[i]] for i in fresh]
                regions, places, needs = signatures(np.concatenate(parts), np.cumsum([len(x) for x in parts]), percent, bits)
                held.append((regions, np.array([seen[keys[i]] for i in fresh], np.int64)[places // SLOTS] * SLOTS + places % SLOTS))
                need = dict(zip(fresh, needs.reshape(-1, SLOTS)[:, :2].tolist(), strict=True))
                count += len(regions)
            named = {"name": [int.from_bytes(k[:8], "little", signed=True) for k in keys]}
            for slot in (0, 1):
                named[f"need_{slot}"] = [need[i][slot] if i in need else None for i in range(len(ids))]
            yield rows({"doc_id": ids, "n_shingles": (ends - begins).tolist(), "key": keys} | named, len(ids))
            if count > 500_000:
                yield from flush()
                count = 0
        yield from flush()
        _WORDS.clear()  # the worker's process lives on, with other tasks
        _release()

    return written(source.mapInArrow(summarise, PASS), "shingle-regions")


def _candidates(first: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Of _summaries' rows: the documents' rows, (key, point) of each distinct set, links between the sets of
    one doc_id, and (node, component) of the points that share a region with another."""
    rows = written(first.where("bucket IS NULL").select("doc_id", "n_shingles", "key", "name", "need_0", "need_1"), "set-keys")

    def meet(parts: pa.Table) -> pa.Table:
        """The regions of this bucket that several slots have, with their slots."""
        _release()
        slots_in = [_unpack(x).astype(np.int8) for x in parts.column("slots").to_pylist()]
        shift = np.concatenate([[0], np.cumsum([len(x) for x in slots_in])])
        slots_in = np.concatenate(slots_in)
        names_in = np.frombuffer(b"".join(parts.column("names").to_pylist()), "<i8")[np.cumsum(slots_in >= SLOTS) - 1]
        slots_in %= SLOTS
        order = np.lexsort((slots_in, names_in))
        names_in, slots_in = names_in[order], slots_in[order]
        new = np.concatenate([[True], (names_in[1:] != names_in[:-1]) | (slots_in[1:] != slots_in[:-1])])
        same = np.empty(len(order), np.int32)
        same[order] = np.cumsum(new) - 1
        names, kinds = names_in[new], slots_in[new]
        del names_in, slots_in, order, new
        regions = np.concatenate([np.cumsum(_unpack(x)) for x in parts.column("regions").to_pylist()])
        places = np.concatenate([same[_unpack(x).astype(np.int64) + s] for x, s in zip(parts.column("places").to_pylist(), shift, strict=False)])
        del same
        order = np.lexsort((places, regions))
        regions, places = regions[order], places[order]
        new = np.concatenate([[True], (regions[1:] != regions[:-1]) | (places[1:] != places[:-1])])
        regions, places = regions[new], places[new]  # a set that several batches have is one
        begins = np.flatnonzero(np.concatenate([[True], regions[1:] != regions[:-1]]))
        held = np.diff(np.append(begins, len(regions)))
        on = np.repeat(held > 1, held)
        met = places[on]
        return pa.table({"region": pa.array(regions[on].astype(np.int64)), "name": pa.array(names[met]), "slot": pa.array(kinds[met].astype(np.int32))})

    parts = first.where("bucket IS NOT NULL").select("bucket", "regions", "places", "names", "slots")
    met = written(parts.groupBy("bucket").applyInArrow(_tidy(meet), "region long, name long, slot int"), "shared-regions")
    # equal sets are one point, named by the smallest doc_id
    equal = rows.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("key")
    points = written(equal.agg(F.min("doc_id").alias("point"), F.first("name").alias("name"), F.max("need_0").alias("need_0"), F.max("need_1").alias("need_1")), "points")
    # points whose slots share too few regions for any link leave
    slot = F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), need.alias("need")) for i, need in enumerate((F.col("need_0"), F.col("need_1"), F.lit(1).cast("long")))]))
    wanted = points.select("point", "name", slot.alias("of")).select("point", "name", "of.*")
    counted = met.withColumn("n", F.count("*").over(Window.partitionBy("name", "slot")))  # one shuffle, for the join too
    left = written(counted.join(wanted, ["name", "slot"]).where("n >= need").select("region", "point"), "met")
    least = written(left.groupBy("region").agg(F.min("point").alias("least")), "least-of-region")
    near = left.join(least, "region").where("point <> least").select(F.col("point").alias("a"), F.col("least").alias("b"))
    # rows of one doc_id with different sets are one document
    filled = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    several = filled.groupBy("doc_id").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most").select("doc_id")
    one_document = written(filled.join(several, "doc_id").join(points, "key").where("doc_id <> point").select(F.col("doc_id").alias("a"), F.col("point").alias("b")), "one-document")
    found = components(near.union(one_document))
    discard(first, met, left, least)
    return rows, points, one_document, found


def _shared_enough(points: DataFrame, words: int, percent: int, blocks: int) -> DataFrame:
    """The points (doc_id, text) whose shingles are in other points often enough for any link, with `rare`: of their
    rarest shingles those that others have too, as many as one more than a link may lack. Two points that link have one
    of them in common. Blocks of points send their shingles' hashes, buckets answer how often each occurs (a collision counts more)."""
    buckets = max(4, blocks // 2)
    dealt = points.select("doc_id", "text").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    shift = np.uint64(24)

    def sets(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        texts = rows.column("text").combine_chunks()
        return _sets_of(texts, list(range(len(texts))), words)

    def ask(rows: pa.Table) -> pa.Table:
        _release()
        hashes, _ = sets(rows)
        distinct, counts = np.unique(hashes >> shift, return_counts=True)
        edges = _by_bucket(distinct, buckets).tolist()
        parts = [(i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]
        return pa.table({
            "bucket": pa.array([i for i, _, _ in parts], pa.int32()), "block": pa.array([rows.column("block")[0].as_py()] * len(parts), pa.int32()),
            "hashes": pa.array([_pack(np.diff(distinct[a:b], prepend=np.uint64(0))) for _, a, b in parts], pa.binary()),
            "counts": pa.array([_pack(counts[a:b]) for _, a, b in parts], pa.binary()),
        })

    def answer(rows: pa.Table) -> pa.Table:
        _release()
        sent = [np.cumsum(_unpack(x)) for x in rows.column("hashes").to_pylist()]
        counts = np.concatenate([_unpack(x) for x in rows.column("counts").to_pylist()]).astype(np.float64)
        ends = np.cumsum([len(x) for x in sent])
        names, same = np.unique(np.concatenate(sent), return_inverse=True)
        total = np.bincount(same.ravel(), counts, len(names))[same.ravel()].astype(np.int64)
        return pa.table({"block": rows.column("block").combine_chunks(), "bucket": rows.column("bucket").combine_chunks(), "totals": pa.array([_pack(x) for x in np.split(total, ends[:-1])], pa.binary())})

    def keep(rows: pa.Table, answers: pa.Table) -> pa.Table:
        _release()
        hashes, ends = sets(rows)
        distinct, at = np.unique(hashes >> shift, return_inverse=True)
        edges, totals = _by_bucket(distinct, buckets), np.zeros(len(distinct), np.int64)
        for bucket, packed in zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist(), strict=True):
            totals[edges[bucket] : edges[bucket + 1]] = _unpack(packed)
        totals = totals[at.ravel()]
        sizes = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((hashes, totals, owner))  # rarest first, in the same order for all points; owners stay together
        rank = np.arange(len(order)) - np.repeat(ends - sizes, sizes)
        rare = (rank <= (sizes - -(-percent * sizes // 100))[owner]) & (totals[order] > 1)
        held = np.bincount(owner[rare], minlength=len(sizes))
        enough = held > 0
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held[enough])]), pa.int32()), pa.array(hashes[order][rare].view(np.int64)))
        left = rows.select(["doc_id", "text"]).filter(pa.array(enough)).combine_chunks()
        return pa.table({"doc_id": left.column("doc_id"), "text": left.column("text"), "rare": lists})

    asked = dealt.groupBy("block").applyInArrow(_tidy(ask), "bucket int, block int, hashes binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(_tidy(answer), "block int, bucket int, totals binary")
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(_tidy(keep), "doc_id long, text binary, rare array<long>")


def _recut(points: DataFrame, words: int, percent: int, most: int, rounds: int = 3) -> DataFrame:
    """Points whose large candidate regions are cut anew: points that cannot link (they only share passages)
    drop out, and the others fall into parts that have no rare shingle in common. As often as that helps."""
    done = []
    before = None
    for cut in range(1, rounds + 1):
        large = written(_weights(points).where(F.col("n") > most), "large-candidates")
        total = large.agg(F.sum("n").alias("n")).first()["n"]
        if not total or (before and total > 0.8 * before):
            break
        before = total
        done.append(points.join(large.select("region"), "region", "left_anti"))
        blocks = max(4, -(-total * 4_000 // (3 << 20)))
        left = written(_shared_enough(points.join(large.select("region"), "region", "left_semi"), words, percent, blocks), "shared-enough")
        met = written(left.select(F.explode("rare").alias("shingle"), "doc_id"), "met")
        least = written(met.groupBy("shingle").agg(F.min("doc_id").alias("least")), "least-of-shingle")
        near = met.join(least, "shingle").where("doc_id <> least").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
        found = components(near)
        discard(met, least)
        points = written(left.join(found.select(F.col("node").alias("doc_id"), F.concat(F.lit(f"{cut}."), F.col("component").cast("string")).alias("region")), "doc_id").select("region", "doc_id", "text"), "candidates")
    for more in done:
        points = points.union(more)
    return points


def join_components(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text", most: int = 3_000, bucket_bytes: int = 24 << 20) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; component_id is the smallest doc_id reachable."""
    if not 50 <= percent <= 99:
        raise ValueError("percent is between 50 and 99")
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).cast("binary").alias("text"))
    total = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(4, -(-total // bucket_bytes))

    with scratch(docs.sparkSession) as keep:
        rows, points, one_document, candidates = _candidates(_summaries(source, words, percent, buckets, region_bits(total)))
        # texts that are surely in no candidate stay out of the shuffle
        near = may_be_in(source, "doc_id", candidates.select(F.col("node").alias("doc_id"))).where("maybe").drop("maybe")
        texts = near.join(candidates.select(F.col("node").alias("doc_id"), F.col("component").cast("string").alias("region")).hint("shuffle_hash"), "doc_id")
        near = _recut(written(texts.select("region", "doc_id", "text"), "candidates"), words, percent, most)
        found = components(_in_regions(near, words, percent, most, 4 * buckets).union(one_document))
        named = rows.select("doc_id", "n_shingles", "key").join(points.select("key", "point"), "key", "left").join(found, F.col("point") == F.col("node"), "left")
        alone = F.col("n_shingles") == 0
        component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "point"))
        return keep(written(named.select("doc_id", "n_shingles", component.alias("component_id")), "components"))

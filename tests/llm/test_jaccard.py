"""op5: the join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from registrum.llm import jaccard_join as jj
from registrum.llm.components import components
from tests.llm.conftest import texts


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < n else set(zip(*[words[i:] for i in range(n)], strict=False))


def brute(rows, n, percent):
    sets, up = [shingles(t, n) for _, t in rows], {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is not None and b is not None and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return sorted([(a, len(s), None if a is None else top(a) if s else a) for (a, _), s in zip(rows, sets, strict=True)], key=repr)


def near_copies(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.choice([2, 5, 12, 30, 60, 120]))] for _ in range(9)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases)) if rng.random() < 0.75 else [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        out.append((rng.choice([i] * 12 + [None, i // 2]), " ".join(w[rng.randint(0, 3) if rng.random() < 0.2 else 0 :])))
    return out


@pytest.mark.parametrize(("n", "percent", "most"), [(3, 90, 20_000), (5, 80, 20_000), (5, 80, 12)])
def test_components(spark, n, percent, most):
    rows = near_copies(percent + most, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jj.join_components(df, n, percent, most=most, bucket_bytes=4_000).collect()), key=repr)
    assert got == brute(rows, n, percent)


def links_of(rows):
    return np.array([r.a for r in rows], np.int64), np.array([r.b for r in rows], np.int64)


def test_large_candidates_are_cut_anew(spark):
    """Documents that share a passage are one candidate; those that cannot link drop out of it."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(90):
        own = " ".join(f"o{rng.randrange(10_000)}" for _ in range(rng.choice([3, 8, 60])))
        rows.append((i, f"{own} {passage}"))
    rows += [(100 + i, f"{rows[i][1]} {rng.choice('xyz')}") for i in range(0, 90, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    points = df.selectExpr("'1' AS region", "doc_id", "cast(text as binary) AS text")
    left = jj._recut(points, 5, 80, 10)
    assert 1 < left.count() < len(rows)
    got = sorted((tuple(r) for r in jj.join_components(df, 5, 80, most=10, bucket_bytes=4_000).collect()), key=repr)
    assert got == brute(rows, 5, 80)


def families(rng, n, size):
    """Families of near copies, one word in a copy changed, of documents that all hold one passage."""
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for f in range(n):
        base = [f"f{f}w{i}" for i in range(100)]
        for _ in range(size):
            own = list(base)
            own[rng.randrange(100)] = f"x{rng.randrange(100_000)}"
            rows.append((len(rows), " ".join(own + passage)))
    return rows


def test_families_that_share_a_passage_fall_apart(spark):
    """A large candidate of several families is cut by the rarest shingles: the passage holds none together."""
    rows = families(random.Random(7), 6, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    points = df.selectExpr("'1' AS region", "doc_id", "cast(text as binary) AS text")
    left = jj._recut(points, 5, 80, 20)
    sizes = [r["count"] for r in left.groupBy("region").count().collect()]
    assert sizes == [12] * 6  # one region of 72 with the regions of the first cut
    got = sorted((tuple(r) for r in jj.join_components(df, 5, 80, most=20, bucket_bytes=4_000).collect()), key=repr)
    assert got == brute(rows, 5, 80)


def test_a_large_family_is_not_repeated_by_its_pivots(spark, monkeypatch):
    """All points of a family are near every pivot: its texts are neither copied to each pivot's region nor sent in one table."""
    made, old = [], jj.written
    monkeypatch.setattr(jj, "written", lambda df, name: made.append((name, old(df, name))) or made[-1][1])
    rows = families(random.Random(8), 1, 60)
    points = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("'1' AS region", "doc_id", "cast(text as binary) AS text")
    links = jj._in_regions(points, 5, 80, 6, 4).collect()
    assert jj._roots(len(rows), *links_of(links)).tolist() == [c for _, _, c in sorted(brute(rows, 5, 80))]
    assert sum(df.count() for name, df in made if "text" in df.columns) <= 4 * len(rows)  # over 20 regions of nearly all, before
    joined = []
    monkeypatch.setattr(jj, "_joined", lambda points, *_: joined.append(points.count()) or points.selectExpr("doc_id AS a", "doc_id AS b"))
    jj._in_regions(points, 5, 80, 6, 4)
    assert sum(joined) <= len(rows) * (len(rows) // 3 + 1)  # each point once a block


def test_regions_that_shrink_are_split(spark):
    """Families without a passage in common: Voronoi regions separate them, and no link is lost."""
    rows = [(i, t.rsplit(" p0 ", 1)[0]) for i, t in families(random.Random(9), 8, 8)]
    points = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("'1' AS region", "doc_id", "cast(text as binary) AS text")
    for most in (6, 20):
        links = jj._in_regions(points, 5, 80, most, 4).collect()
        assert jj._roots(len(rows), *links_of(links)).tolist() == [c for _, _, c in sorted(brute(rows, 5, 80))]


def test_odd_documents(odd_documents, no_documents):
    df, rows = odd_documents
    got = sorted((tuple(r) for r in jj.join_components(df, 3, 90).collect()), key=repr)
    assert got == brute([r[:2] for r in rows], 3, 90)
    assert jj.join_components(no_documents).collect() == []


def test_every_link_shares_a_region_and_is_found():
    """The pigeonhole holds for all links: a slot of either shares as many regions with the other's as it needs.
    And a task's spanning links connect what all links do."""
    for seed in range(40):
        rows = [t for t in texts(seed, 40) if t and t.split()] + [t for _, t in near_copies(seed, 40) if t]
        hashes, ends = jj.shingle_sets([t.encode() for t in rows], 3)
        sets = [shingles(t, 3) for t in rows]
        assert [len(s) for s in sets] == [b - a for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
        for percent in (60, 80, 90):
            where: dict = {}
            regions, slots, needs = (x.tolist() for x in jj.signatures(hashes, ends, percent))
            for region, slot in zip(regions, slots, strict=True):
                where.setdefault(slot // jj.SLOTS, {}).setdefault(slot, set()).add(region)
            for i, a in enumerate(sets):
                for j in range(i):
                    if a != sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                        shared = [(needs[x], needs[y], len(where[i][x] & where[j][y])) for x in where[i] for y in where[j]]
                        assert any(n >= max(1, own, other) for own, other, n in shared)
            a, b = jj.links_within(hashes, ends, percent)
            assert jj._roots(len(rows), a, b).tolist() == [c for _, _, c in sorted(brute(list(enumerate(rows)), 3, percent))]


def test_a_set_sends_no_more_regions_than_its_links_need():
    """T is of the set and its largest partner, and a ring's points join the next only if a partner may be there."""
    rng = random.Random(3)
    sizes = [rng.randint(60, 600) for _ in range(300)]
    rows = [" ".join(f"w{rng.randrange(100_000)}" for _ in range(n + 4)).encode() for n in sizes]
    hashes, ends = jj.shingle_sets(rows, 5)
    regions, _, _ = jj.signatures(hashes, ends, 80)
    assert len(regions) < 0.55 * len(hashes)  # 0.7 with narrow rings and the ring's largest T
    few, _, _ = jj.signatures(hashes, ends, 80, 40)
    assert len(few) == len(regions) and int(few.max()) < 1 << 40
    assert [jj.region_bits(1 << n) for n in (3, 29, 35, 60)] == [40, 40, 46, 56]


def test_a_name_is_sent_once_for_all_slots_of_a_bucket(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(150))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "cast(text AS binary) AS text").coalesce(1)
    packed = jj._summaries(df, 5, 80, 4, 40).where("bucket IS NOT NULL").collect()
    assert {r.bucket for r in packed} == set(range(4))  # ids of as many bits as the buckets' limits
    regions = [len(jj._unpack(bytes(r.regions))) for r in packed]
    assert max(regions) < 2 * min(regions)
    names = [len(r.names) // 8 for r in packed]
    assert names == [len(set(zip(*[iter(bytes(r.names))] * 8, strict=True))) for r in packed]
    assert sum(names) <= 4 * len(rows)


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(5, 5)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}

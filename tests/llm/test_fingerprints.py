"""op6: sketches against true sets; native plans only."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from registrum.llm import fingerprints as fp
from registrum.llm.common import table
from tests.conftest import SF001


def neighbours(rows):
    """(text, next text or None) of each row, in descending doc_id, equal ids by text, round to the first."""
    known = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (-r[0], r[1]))
    out = [(i, t, known[(k + 1) % len(known)][1]) for k, (i, t) in enumerate(known)]
    return out + [(None, t or "", None) for i, t in rows if i is None]


def test_against_true_sets(spark):
    docs = table(spark, SF001, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in fp.compare_neighbours(docs).collect()}
    errors, contained = [], []
    for i, text, other in neighbours(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (shingles_of(x) for x in (text, edited, other))
        for estimate, x, y in ((r.near_edited, a, b), (r.near_next, a, c)):
            errors.append(abs(estimate - (len(x & y) / len(x | y) if x | y else 1)))
        contained.append(abs(r.contained_in_edited - (len(a & b) / len(a) if a else 1)))
        if len(a) < fp.K:
            assert r.distinct_shingles == len(a) and errors[-1] < 1e-9
    assert sum(errors) / len(errors) < 0.05 and max(errors) < 0.3 and sum(contained) / len(contained) < 0.1


def shingles_of(text):
    words = text.encode().split()
    return {tuple(words)} if 0 < len(words) < 5 else set(zip(*[words[i:] for i in range(5)], strict=False))


def test_order_over_many_buckets(odd_documents, no_documents):
    df, rows = odd_documents
    got = sorted(((r.doc_id, r.text, r.next.text if r.next else None) for r in fp.with_next(df, bucket_rows=3).collect()), key=repr)
    assert got == sorted(neighbours([r[:2] for r in rows]), key=repr)
    assert fp.with_next(no_documents).collect() == [] and fp.compare_neighbours(no_documents).collect() == []
    one = df.where("doc_id = 500")
    assert [r.near_next for r in fp.compare_neighbours(one).collect()] == [1.0]
    assert fp.compare_neighbours(df).count() == len(rows)


def test_equal_texts_and_merging(spark):
    rows = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(k, k + 200)), k) for k in (0, 100, 150)] + [(1, None, 9), (2, "a b", 1), (2, "a b", 2)], "g int, text string, k int")
    sketched = rows.withColumn("sketch", fp.sketch(F.col("text")))
    whole = {r.g: r.sketch for r in fp.merge_all(sketched, ["g"]).collect()}
    parts = {r.k: r.sketch for r in sketched.where("g = 1").collect()}
    assert whole[1] == sorted({h for s in parts.values() for h in s})[: fp.K]
    pair = sketched.where("g = 2").collect()
    assert pair[0].sketch == pair[1].sketch == whole[2] and len(whole[2]) == 1


def test_plan_is_native(spark):
    plan = fp.compare_neighbours(table(spark, SF001, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow")) and "CartesianProduct" not in plan

"""op1: exact removal of repeated strings against brute force; loser trees against sorting."""

from __future__ import annotations

import random

import pytest

from registrum.llm.loser_tree import merge, merge_front_coded, shared
from registrum.llm.suffix_dedup import remove_repeats


def brute(rows, length=50):
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        if i is not None:
            for p in range(len(t) - length + 1):
                w = t[p : p + length]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        if i is not None:
            for p in range(len(t) - length + 1):
                if first[t[p : p + length]] < i:
                    gone[p : p + length] = b"\1" * length
        runs = sum(1 for q in range(len(t)) if gone[q] and not (q and gone[q - 1]))
        out.append((i, len(t), runs, bytes(x for x, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def found(df, **more):
    return sorted(((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in remove_repeats(df, **more).collect()), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abcdefg é"])
def test_random_texts(spark, letters):
    rng = random.Random(len(letters))
    parts = ["".join(rng.choice(letters) for _ in range(rng.randint(30, 180))) for _ in range(6)]
    rows = []
    for i in range(50):
        cut = lambda: rng.choice(parts)[rng.randint(0, 30) : rng.randint(20, 180)]
        rows.append((rng.choice([i, i, 3, None]), "".join(cut() if rng.random() < 0.6 else rng.choice(letters) * rng.randint(0, 9) for _ in range(rng.randint(0, 5)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, block_bytes=2_000) == brute(rows)
    assert found(df, block_bytes=2_000, length=30) == brute(rows, 30)


def test_odd_documents(odd_documents, no_documents):
    df, rows = odd_documents
    short = [r for r in rows if r[0] != 500]
    assert found(df.where("doc_id IS NULL OR doc_id <> 500"), block_bytes=3_000) == brute([r[:2] for r in short])
    assert found(no_documents) == []
    # the long text repeats itself, which removes nothing of it
    kept = {r.doc_id: len(r.kept) for r in remove_repeats(df).where("doc_id = 500").collect()}
    assert kept == {500: 300_000}


def test_many_contexts_of_one_gram(spark):
    """Over a dozen different surroundings of one passage take the place-by-place way."""
    core = "the very same passage of forty bytes here"
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("xyz") for _ in range(rng.randint(0, 3))) + core + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 9)))) for i in range(120)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=500) == brute(rows)


def passage_in_all(n):
    """Documents that share a passage, each with bytes of its own before and after it; some whole copies."""
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghij klmnop") for _ in range(k))
    passage = word(130)
    rows = [(i, word(rng.randint(0, 60)) + passage[rng.randint(0, 3) :] + word(rng.randint(0, 60))) for i in range(n)]
    return [*rows, (n, rows[3][1]), (2, rows[5][1]), (None, rows[7][1])]


@pytest.mark.parametrize("length", [30, 50])
def test_grams_with_very_many_entries(spark, length):
    rows = passage_in_all(200)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (0, 20):
        assert found(df, block_bytes=3_000, length=length, most=most) == brute(rows, length)


def test_no_bucket_gathers_a_common_gram(monkeypatch):
    """The stages one after another in this process: groups stay under the limit, however many documents
    share a passage."""
    import pyarrow as pa
    import pyarrow.compute as pc

    from registrum.llm import suffix_dedup

    most, buckets, rows = 50, 4, [r for r in passage_in_all(400) if r[0] is not None]
    largest, resolve = [], suffix_dedup._resolve
    monkeypatch.setattr(suffix_dedup, "_resolve", lambda group, *more: (largest.append(len(group)), resolve(group, *more)))
    blocks = [suffix_dedup._Block(pa.table({"doc_id": [i for i, _ in part], "text": pa.array([t.encode() for _, t in part], pa.binary())}), 50) for part in (rows[k::8] for k in range(8))]
    by = lambda table, name: [table.filter(pc.equal(table[name], k)) for k in sorted(set(table[name].to_pylist()))]
    asked = pa.concat_tables(suffix_dedup._ask(b, k, buckets) for k, b in enumerate(blocks))
    for limit, is_heavy in ((1 << 15, False), (most, True)):
        answers = pa.concat_tables(suffix_dedup._answer(x, limit) for x in by(asked, "bucket"))
        sent = pa.concat_tables(suffix_dedup._runs(b, k, answers.filter(pc.equal(answers["block"], k)), buckets) for k, b in enumerate(blocks))
        assert (min(sent["bucket"].to_pylist()) < 0) == is_heavy
        largest.clear()
        for group in by(sent, "bucket"):
            if group["bucket"][0].as_py() >= 0:
                suffix_dedup._merge(group, 50)
        assert (max(largest) <= most) == is_heavy


def test_loser_trees():
    rng = random.Random(7)
    for k in (0, 1, 2, 5, 8):
        runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(rng.randint(0, 40))) for _ in range(k)]
        coded = [[(shared(a, b, 0), b[shared(a, b, 0) :]) for a, b in zip([b"", *r], r, strict=False)] for r in runs]
        text, out = b"", []
        for known, _, rest in merge_front_coded(coded):
            assert shared(text, text[:known] + rest, 0) == known or not out
            text = text[:known] + rest
            out.append(text)
        assert out == sorted(x for r in runs for x in r)
        assert [x for _, x in merge(runs, lambda x: x)] == out


def test_anchors_do_not_depend_on_the_chunks(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from registrum.llm import suffix_dedup

    rng = random.Random(11)
    rows = pa.table({"doc_id": list(range(30)), "text": pa.array(["".join(rng.choice("abc d") for _ in range(rng.randint(0, 300))).encode() for _ in range(30)], pa.binary())})
    whole = suffix_dedup._Block(rows, 50).anchors()
    for chunk in (1, 37, 512):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        assert all(np.array_equal(a, b) for a, b in zip(whole, suffix_dedup._Block(rows, 50).anchors(), strict=True))

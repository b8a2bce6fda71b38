"""op2 and op3: the rule ledger and the additive model."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from registrum.llm import quality_gam as gam
from registrum.llm import quality_rules as rules
from registrum.llm.common import table
from tests.conftest import SF01


def brute(text):
    data = text or ""
    space = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in space else c for c in data).split(" ")
    words = [w for w in words if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    lines, seen, duplicates = data.split("\n"), set(), 0
    for line in lines:
        if line.strip(space):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in data), duplicates, len(covered)


def test_measures(odd_documents, no_documents):
    df, rows = odd_documents
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.ledger(df).collect())
    assert got == sorted((r[0] or -1, *brute(r[1])) for r in rows)
    assert rules.ledger(no_documents).collect() == []
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab \n\t#é|\x0b\x85") for _ in range(rng.randint(0, 60)))
        assert rules.measure(text.encode())[:5] == brute(text), text


def test_policies_and_ablation(spark):
    rows = rules.ledger(table(spark, SF01, "documents"))
    kept = {p.version: rows.where(rules.passes(p)).count() for p in rules.POLICIES}
    total = rows.count()
    facts = [r.fail_bits for r in rows.collect()]
    for r in rules.ablation(rows).collect():
        policy = next(p for p in rules.POLICIES if p.version == r.version)
        bit = rules.BIT[r.rule]
        assert r.rejected == total - kept[r.version] if r.failing else True
        assert r.failing == sum(bool(f & bit) for f in facts)
        assert r.only_this_rule == sum(f & policy.mask == bit for f in facts)
    assert kept["v2"] <= kept["v1"]


def test_rules_reject_junk_and_keep_clean(spark):
    rows = rules.ledger(table(spark, SF01, "documents")).join(table(spark, SF01, "labels"), "doc_id")
    by = {r.quality: r.kept / r.n for r in rows.where("n_words >= 50").groupBy("quality").agg(F.count("*").alias("n"), F.sum(rules.passes(rules.DEFAULT_POLICY).cast("int")).alias("kept")).collect()}
    assert by[1] > 0.97 and by[0] < 0.05


def test_additive_model_finds_curves_and_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 4))
    curve = ((x[:, 0] > 0.3) & (x[:, 0] < 0.6)).astype(float)
    cross = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    for y in (curve, cross):
        model = gam.fit(x[:5000], y[:5000])
        assert ((model.score(x[5000:]) > 0.5) == y[5000:]).mean() > 0.95
    assert model.pairs[0] == (2, 1)
    assert np.allclose(gam.fit(x[:0], y[:0]).score(x), 0.5)
    assert gam.fit(x[:9], np.ones(9)).score(x).min() > 0.9
    assert 0.0 <= model.score(np.full((1, 4), 1e9))[0] <= 1.0


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    scored = gam.score(docs, gam.learn(docs, labels)).select("row.doc_id", "score").join(labels, "doc_id").collect()
    unseen = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.3) == bool(r.quality) for r in unseen) / len(unseen) > 0.97


def test_scores_of_odd_documents(spark, odd_documents, no_documents):
    df, rows = odd_documents
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    out = gam.score(df, gam.learn(df, labels)).select("row.*", F.col("score").alias("p"))
    assert out.columns == [*df.columns, "p"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.p <= 1 for r in got)
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in gam.score(df, gam.learn(df, nothing)).collect()} == {0.5}
    assert gam.score(no_documents, gam.Gam()).collect() == []
    assert [r.h for r in spark.sql("SELECT explode(array(1L, 7L, null)) AS d").select(gam.held_out(F.col("d")).alias("h")).collect()] == [zlib.crc32(b"1") % 5 == 0, zlib.crc32(b"7") % 5 == 0, False]

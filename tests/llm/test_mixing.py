"""op10: posteriors, rates and copies."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from registrum.llm import soft_mixing as sm
from registrum.llm.common import table
from registrum.llm.queries import domains
from tests.conftest import SF01


@pytest.fixture(scope="module")
def fitted(spark):
    docs = table(spark, SF01, "documents")
    rows, model, found = sm.rates(docs, domains(docs, table(spark, SF01, "labels")))
    return docs, rows.cache(), model, found


def test_posteriors(fitted):
    docs, rows, model, _ = fitted
    got = rows.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(model.domains[max(range(len(model.domains)), key=lambda k: r.posterior[k])] == r.lang for r in got) / len(got) > 0.9
    assert all(abs(sum(r.posterior) - 1) < 1e-9 and min(r.posterior) >= 0 for r in got)


def test_brute_force_posterior(spark):
    texts = [(1, "ein der Die"), (2, "the of the"), (3, "the DER"), (4, ""), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labelled = spark.createDataFrame([(1, "de"), (2, "en"), (3, None), (9, "xx"), (None, "en")], "doc_id long, domain string")
    model = sm.learn(docs, labelled)
    assert model.domains == ("de", "en") and model.prior == (math.log(0.5),) * 2
    buckets = {r.doc_id: r.b for r in docs.select("doc_id", sm._buckets(F.col("text")).alias("b")).collect()}
    for r in sm.membership(docs, model, keep="doc_id").collect():
        b = buckets[r.row]
        s = [model.prior[k] + sum(model.words[k][i] for i in b) / math.sqrt(max(1, len(b))) for k in range(2)]
        e = [math.exp(x - max(s)) for x in s]
        assert r.tokens == len(b) and all(abs(x / sum(e) - y) < 1e-9 for x, y in zip(e, r.posterior, strict=True))


def test_targets_are_met_and_rates_follow_the_steps(fitted):
    _, rows, model, found = fitted
    got = rows.collect()
    size = sum(r.tokens for r in got)
    for k, wanted in enumerate(found.targets):
        assert abs(sum(r.rate * r.tokens * r.posterior[k] for r in got) / size - wanted) < 1e-5
    for r in got[:100]:
        rate = 1.0
        for step in found.steps:
            rate = max(0.0, rate - sum(p * v for p, v in zip(r.posterior, step, strict=True)))
        assert abs(rate - r.rate) < 1e-9
        assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
    assert abs(sum(r.copies for r in got) / sum(r.rate for r in got) - 1) < 0.05


def test_given_targets_with_an_unwanted_domain(spark):
    rows = [(i, ("der die das " if i % 3 else "the of and ") * (1 + i % 5)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "de" if i % 3 else "en") for i in range(30)], "doc_id long, domain string")
    got, model, found = sm.rates(docs, labelled, {"en": 1.0})
    assert max(abs(a - b) for a, b in zip(found.targets, found.reached, strict=True)) < 0.01
    assert all(r.rate >= 0 for r in got.collect())
    with pytest.raises(ValueError):
        sm.fit(got.select("tokens", "posterior"), 2, [1.0, -1.0])


def test_mix_loses_nothing(spark, odd_documents, no_documents):
    df, rows = odd_documents
    labelled = df.select("doc_id", F.col("lang").alias("domain"))
    out = sm.mixed(df, labelled)
    assert out.columns == df.columns
    key = lambda r: tuple(r)
    assert {key(r) for r in out.collect()} == {key(r) for r in df.collect()}
    assert sm.mixed(no_documents, labelled).collect() == []
    none = labelled.limit(0)
    assert sorted(map(repr, sm.mixed(df, none).collect())) == sorted(map(repr, df.collect()))
    assert sm.rates(df, none)[0].count() == len(rows)


def test_least_rate_keeps_the_targets(spark):
    """One document that the targets would rule out neither loses them nor multiplies all others."""
    rows = [(10, [0.6, 0.4])] * 200 + [(10, [0.4, 0.6])] * 200 + [(10, [0.0, 1.0])]
    members = spark.createDataFrame(rows, "tokens long, posterior array<double>").coalesce(1).cache()
    for wanted in (0.55, 0.58):
        found = sm.fit(members, 2, [wanted, 1 - wanted], least_rate=1.0)
        rate = [r.rate for r in members.select(found.of(F.col("posterior")).alias("rate")).collect()]
        assert min(rate) > 1 - 1e-9 and max(rate) < 30
        share = sum(r * p[0] for r, (_, p) in zip(rate, rows, strict=True)) / sum(rate)
        assert abs(share - wanted) < 0.002 and found.miss() <= sm.MISS
    with pytest.warns(RuntimeWarning, match="reached"):
        assert sm.fit(members, 2, [0.9, 0.1], least_rate=1.0).checked().miss() > sm.MISS


def test_mix_does_not_miss_targets_silently(spark):
    docs = spark.createDataFrame([(i, ("der die das " if i % 3 else "the of and ") * (1 + i % 5)) for i in range(60)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "de" if i % 3 else "en") for i in range(30)], "doc_id long, domain string")
    with pytest.raises(ValueError, match="target 0"):
        sm.mixed(docs, labelled, {"en": 1.0})
    rows, found = sm.mix(docs, labelled, {"en": 0.4, "de": 0.6})
    assert found.targets == (0.6, 0.4) and found.miss() <= sm.MISS and rows.select("doc_id").distinct().count() == 60


def test_plan_is_native(fitted):
    docs, _, model, _ = fitted
    plan = sm.membership(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))

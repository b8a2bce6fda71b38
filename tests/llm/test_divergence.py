from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrum.llm import divergence
from tests.llm.conftest import texts

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, top=200):
    """docs as (lang, source, text); the contract term by term, without runs."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        groups[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= 3]
        mine = [s for (x, s) in groups if x == lang]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        whole = Counter()
        for s in mine:
            whole.update(groups[lang, s])
        p, q = shares(groups[lang, source]), shares(whole)
        pairs = []
        for other in mine:
            if other != source:
                r = shares(groups[lang, other])
                pairs.append((-sum((p[t] - r[t]) ** 2 // r[t] for t in kept), other))
        terms = [(-((p[t] - q[t]) ** 2 // q[t]), t) for t in kept if groups[lang, source][t] and p[t] > q[t]]
        for part, rows in (("pair", pairs), ("term", terms)):
            ranked = sorted(rows, key=lambda r: (r[0], r[1].encode()))
            out += [(lang, source, part, item, -value, rank) for rank, (value, item) in enumerate(ranked, 1) if part == "pair" or rank <= top]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def corpus():
    docs = []
    for i, text in enumerate(texts(11, 150)):
        lang = ["en", "fr", None, "", "xx"][i % 9 if i % 9 < 5 else 0]
        docs.append((lang, ["a", "b", None, "c", "É", "a"][i % 6], text))
    docs += [("lone", "one", "just one group here just one"), ("dead", "s", "!!! 12"), ("dead", "t", None), ("en", "empty", "")]
    docs += docs[20:30] + [("en", "long", "Straße ÉCOLE word " * 20_000)]
    return docs


@pytest.mark.parametrize("options", [{}, {"chunk_terms": 5, "block_sources": 2}])
def test_equal_to_brute_force(spark, options):
    docs = corpus()
    rows = [(lang, source, text, 1, 2.0, "p") for lang, source, text in docs]
    df = spark.createDataFrame(rows, "lang string, source string, text string, n long, p double, term string").repartition(4)
    assert rows_of(divergence.audit(df, **options)) == brute(docs)


def test_limit_holds_for_terms_only(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert rows_of(divergence.audit(df, top_terms=3)) == brute(docs, top=3)


def test_no_documents(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_sums_over_intersected_runs():
    rng = np.random.default_rng(2)
    a, b = (np.sort(rng.integers(0, 4, 40)) * 1000 + 1 for _ in range(2))
    encode = lambda x: (np.flatnonzero(np.diff(x, prepend=-1)), x[np.flatnonzero(np.diff(x, prepend=-1))])
    want = int(((a - b) ** 2 // b).sum()), int(((a - b) ** 2 // a).sum())
    assert divergence._sums(encode(a), encode(b), 40) == want


def test_vocabulary_clusters_equal_columns(spark):
    """Terms with the same counts everywhere are neighbours, so a group has few runs."""
    docs = [("en", s, " ".join(f"{s}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))) for s in "abcd" for _ in range(3)]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    terms = divergence.vocabulary(divergence.term_columns(divergence.task_counts(df, max_entries=50)))
    columns = divergence._runs(terms.select("*", F.inline("column")).withColumn("p", F.col("n"))).collect()
    assert len(columns) == 4 and all(len(c["runs"]) == 1 for c in columns)

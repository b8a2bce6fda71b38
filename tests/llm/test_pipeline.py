"""The pipeline's stages on odd rows, and the whole against its parts."""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as cp
from registrum.llm import bpe_duckdb, jaccard_join, pii_crf, quality_gam
from registrum.llm.bpe_duckdb import VOCABULARY
from registrum.llm.common import may_be_in, table, written
from tests.conftest import SF001


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.fixture(scope="module")
def parts(spark):
    docs = table(spark, SF001, "documents")
    out = [docs]
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF001), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_whole(spark, parts):
    assert same(cp.run(spark, SF001).collect(), parts[-1].collect())


def test_brute_force(spark, parts):
    docs, good, single, clean, mixed, coded = [p.collect() for p in parts]
    model = quality_gam.learn(parts[0], table(spark, SF001, "labels"))
    scores = model.score(np.array([quality_gam.features(r.text.encode()) for r in docs]))
    assert same(good, [r for r, s in zip(docs, scores, strict=True) if s >= 0.3])
    from tests.llm.test_jaccard import brute

    first = {i for i, _, c in brute([(r.doc_id, r.text) for r in good], 5, 80) if i == c}
    assert same(single, [r for r in good if r.doc_id in first])
    crf = pii_crf.train()
    for before, after in zip(sorted(single), sorted(clean), strict=True):
        spans = pii_crf.merged(pii_crf.base_spans(before.text), pii_crf.crf_spans([before.text], crf)[0])
        assert after.text == pii_crf.redact(before.text, spans) and (not spans or after.n_chars == len(after.text))
    assert set(mixed) == set(clean) and len(mixed) >= len(clean)
    with open(public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in coded:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == public.encode_ordinary(r.text) and r.n_tokens == len(r.ids) // 4
    assert same([r[:5] for r in map(tuple, coded)], [tuple(r) for r in mixed])


def test_stages_on_odd_rows(spark, odd_documents, no_documents):
    df, rows = odd_documents
    for name, stage in cp.STAGES:
        got = stage(spark, df, SF001)
        assert got.columns[: len(df.columns)] == df.columns, name
        got.collect()
        assert stage(spark, no_documents, SF001).collect() == [], name


def test_one_row_of_each_group_stays(spark, odd_documents):
    df, _ = odd_documents
    kept = [r.doc_id for r in cp.near_duplicates(spark, df, SF001).collect()]
    groups = jaccard_join.join_components(df, 5, 80).collect()
    assert sorted(i for i in kept if i is not None) == sorted({r.component_id for r in groups if r.doc_id is not None})
    assert kept.count(None) == sum(r.doc_id is None for r in groups)


def test_rows_that_surely_go_are_not_shuffled(spark, monkeypatch):
    """Copies leave by the key filters; only rows of repeated ids (and a filter's few errors) reach the join."""
    rows = [(i, " ".join(f"w{i // 20}x{j}" for j in range(30))) for i in range(400)]
    rows += [(7, "twice"), (7, "twice"), (20, "again"), (None, "none"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []

    def watched(*args):
        asked.append(written(may_be_in(*args), "asked"))
        return asked[-1]

    monkeypatch.setattr(cp, "may_be_in", watched)
    got = cp.near_duplicates(spark, df, SF001).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == list(range(0, 400, 20)) and sum(r.doc_id is None for r in got) == 2
    assert asked[-1].where("maybe").count() <= 10


def test_columns_named_as_the_stage_s_own_give_way(spark, odd_documents):
    from pyspark.sql import functions as F

    df, _ = odd_documents
    clash = df.withColumns({"ids": F.lit("x"), "N_tokens": F.lit(-1)})
    got = written(cp.encode(spark, clash, SF001), "clash")
    assert got.columns == [*df.columns, "ids", "n_tokens"] and got.schema["ids"].dataType.simpleString() == "binary"
    assert got.count() == df.count()


def test_join_leaves_its_result_only(spark, odd_documents):
    from registrum.llm.common import shared_folder
    from registrum.sources.parquet import list_names

    df, _ = odd_documents
    before = set(list_names(spark, shared_folder(spark)))
    jaccard_join.join_components(df, 5, 80)
    assert [n.split("-")[0] for n in set(list_names(spark, shared_folder(spark))) - before] == ["components"]


def test_a_stage_sends_each_text_to_its_workers_once(spark, odd_documents):
    import re

    df, _ = odd_documents
    for made in (quality_gam.score(df, quality_gam.Gam()), pii_crf.redacted(df), bpe_duckdb.encode(df)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"MapInArrow \w+\(([^)]*)\)", plan)[1].startswith("row#") and "text#" not in re.search(r"MapInArrow \w+\(([^)]*)\)", plan)[1], plan


def test_text_columns_of_any_kind_and_name(spark):
    rows = spark.createDataFrame([(1, "a b", 12, bytearray(b"c d")), (2, None, None, None)], "doc_id long, Words string, n int, raw binary")
    for column, texts in (("words", ["a b", None]), ("n", ["12", None]), ("raw", ["c d", None])):
        wanted = bpe_duckdb.codec().encode([x or "" for x in texts])
        got = sorted((r.row.doc_id, bytes(r.ids), tuple(r.row)) for r in bpe_duckdb.encode(rows, column).collect())
        assert [x[1] for x in got] == wanted and [x[2] for x in got] == sorted(map(tuple, rows.collect()), key=lambda r: r[0])
        wanted = quality_gam.Gam().score(np.zeros((2, len(quality_gam.FEATURES)))).tolist()
        assert [r.score for r in quality_gam.score(rows, quality_gam.Gam(), column).collect()] == wanted

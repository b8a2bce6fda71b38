"""Profiles from groupings and from kept sketches, date spellings found in the data, sampling by histogram."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from registrum.operators import profile as P
from registrum.operators.clean import batch_id_of, date_spellings
from registrum.operators.sample import first_n
from registrum.plans import catalog as C
from registrum.plans.bronze import ingest_bronze
from registrum.plans.reports import silver_sketch_profile
from registrum.plans.silver import build_silver
from registrum.session import ensure_checkpoint_dir
from registrum.sources import parquet as pq
from registrum.sources.store import SnapshotStore

from .conftest import SF001
from .test_scale_plans import plan_of
from .test_silver import ETAB_SCHEMA, etab_row


def odd_values(spark):
    rows = [(i % 7 if i % 5 else None, [2**53, 2**53 + 1, -3][i % 3], [0.0, -0.0, 10.5, 9.0, None][i % 5], f"v{i % 11}" if i % 4 else None, i % 2 == 0, None) for i in range(60)]
    return spark.createDataFrame(rows, "a int, b long, c double, d string, e boolean, f string")


def test_exact_profile_equals_the_plain_aggregates(spark):
    df = odd_values(spark)
    got = {r.column_name: tuple(r) for r in P.table_profile(df, exact=True).collect()}
    assert list(got) and set(got) == set(df.columns)
    for c in df.columns:
        r = df.agg(F.round(F.avg(F.col(c).isNull().cast("double")) * 100, 2), F.count_distinct(c), F.min(c).cast("string"), F.max(c).cast("string")).first()
        want = [r[0], r[1], *(("0.0" if x == "-0.0" else x) for x in r[2:])]
        assert got[c] == (c, *want), c
    empty = P.table_profile(df.limit(0), exact=True).collect()
    assert [tuple(r)[1:] for r in empty] == [(0.0, 0, None, None)] * 6


def test_exact_profile_expands_nothing(spark):
    plan = plan_of(P.table_profile(C.etab_silver(spark, SF001), exact=True), "simple")
    assert "Expand" not in plan


def test_share_gathers_no_groups_in_one_task(spark):
    plan = plan_of(P.share(spark.range(1000).withColumn("k", F.col("id") % 50), "k", 2), "simple")
    main = plan.split("Subquery")[0].split("scalar-subquery")[0]
    assert "Window" not in plan and "SinglePartition" not in main
    out = P.share(spark.range(1000).withColumn("k", F.col("id") % 50), "k", 2)
    assert {r["percentage"] for r in out.collect()} == {2.0} and out.count() == 50


def test_sketches_merge_alike_under_any_cut(spark):
    df = spark.range(20_000).select((F.col("id") * 7 % 5000).cast("string").alias("s"), (F.col("id") % 640).cast("double").alias("n"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("k"))
    cuts = [F.lit(0), F.col("id") % 13, F.pmod(F.xxhash64("s"), F.lit(5)), F.when(F.col("n") < 3, 1).otherwise(2)]
    profiles = []
    for cut in cuts:
        part = df.withColumn("id", F.monotonically_increasing_id()).withColumn("p", cut.cast("int")).drop("id")
        profiles.append({r.column_name: r for r in P.merged_profile(P.sketch_rows(part, "p")).collect()})
    exact = {r.column_name: r for r in P.table_profile(df, exact=True).collect()}
    for found in profiles:
        for c, e in exact.items():
            r = found[c]
            assert (r.null_percentage, r.min, r.max) == (e.null_percentage, e.min, e.max)
            assert r.approx_unique == profiles[0][c].approx_unique and abs(r.approx_unique - e.unique_count) <= 0.05 * e.unique_count
        assert abs(found["n"]["median"] - 319.5) <= 640 * 0.01 and found["s"]["median"] is None


def test_report_reads_the_kept_sketches_only(spark, scratch):
    silver, b = f"{scratch}/silver", f"{scratch}/bronze"
    for day in (1, 2, 3):
        rows = [etab_row(f"{day}{i:013d}", cp=f"75{i % 20:03d}", enseigne=f"e{i % 9}") for i in range(40)]
        ingest_bronze(spark, spark.createDataFrame(rows, ETAB_SCHEMA), b, "etablissements", datetime(2026, 1, day))
        build_silver(spark, "etablissements", b, silver, 2026, buckets=3)
    again = spark.createDataFrame([etab_row(f"{1}{5:013d}", enseigne="only once")], ETAB_SCHEMA).withColumn("ingested_at", F.lit("2026-02-01").cast("timestamp_ntz"))
    again.withColumn("batch_id", F.lit(batch_id_of(datetime(2026, 2, 1)))).write.mode("append").partitionBy("batch_id").parquet(b)
    build_silver(spark, "etablissements", b, silver, 2026)
    report = silver_sketch_profile(spark, silver)
    assert all("_profiles" in f for f in report.inputFiles()) and report.inputFiles()
    exact = {r.column_name: r for r in P.table_profile(SnapshotStore(spark, f"{silver}/etablissements").read(), exact=True).collect()}
    for r in report.collect():
        e = exact[r.column_name]
        assert (r.null_percentage, r.approx_unique, r.min, r.max) == (e.null_percentage, e.unique_count, e.min, e.max), r.column_name


@pytest.mark.parametrize("texts, want", [
    (["2020-01-31", None, "2020-02-30"], {}),
    (["31/01/2020", "1.2.2020", "02/13/2020"], {"the_date": ("day first",)}),
    (["01/31/2020", "02/13/2020", "13/02/2020"], {"the_date": ("month first",)}),
    (["20200131", "20200201", "2020/02/01", " 2020/2/1 10:11:12 ", "2020/12/31"], {"the_date": ("year first", "digits")}),
])
def test_spellings_are_found_in_the_data(spark, texts, want):
    df = spark.createDataFrame([(t, "31/12/1999") for t in texts], "the_date string, other string")
    assert date_spellings(df) == want


def test_silver_reads_and_reports_other_spellings(spark, scratch):
    days = ["15/03/2001", "20020416", "2003/05/17", "2004-06-18", "19.07.2005", "31/02/2006", "none"]
    rows = [(*etab_row(f"{i:014d}")[:3], d, *etab_row("x")[4:]) for i, d in enumerate(days)]
    stock = spark.createDataFrame(rows, ETAB_SCHEMA.replace("dateCreationEtablissement date", "dateCreationEtablissement string"))
    ingest_bronze(spark, stock, f"{scratch}/b", "etablissements", datetime(2026, 1, 1))
    r = build_silver(spark, "etablissements", f"{scratch}/b", f"{scratch}/silver", 2026)
    assert r.date_spellings == {"dateCreationEtablissement": ("day first", "year first", "digits")}
    got = {x.siret: x.dateCreationEtablissement for x in SnapshotStore(spark, f"{scratch}/silver/etablissements").read().collect()}
    want = [datetime(2001, 3, 15), datetime(2002, 4, 16), datetime(2003, 5, 17), datetime(2004, 6, 18), datetime(2005, 7, 19), None, None]
    assert [got[f"{i:014d}"] for i in range(7)] == want


def test_first_n_stages_nothing_and_counts_repeated_keys(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "hot", f"k{i}"]), i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged"
    before = pq.list_names(spark, folder)
    order = df.selectExpr("*", "coalesce(md5(concat('7|', k)), md5('7|')) AS h", "k IS NULL AS z", "xxhash64(k, v) AS r").orderBy("h", "z", "k", "r").select("k", "v").collect()
    for n in (1, 700, 1500, 2999, 3000, 5000):
        got = first_n(df, n, "k", 7).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, order[:n]), key=str), n
    assert pq.list_names(spark, folder) == before

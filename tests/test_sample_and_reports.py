import hashlib

import pytest
from pyspark.sql import functions as F

from registrum.operators import profile as P
from registrum.operators.quality import duplicate_keys
from registrum.operators.sample import first_n


def brute_force(keys, n, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}|{k}".encode()).hexdigest(), k))[:n]


@pytest.mark.parametrize("n", [0, 1, 7, 100, 999, 1000, 5000])
def test_first_n_matches_brute_force(spark, n):
    keys = [f"k{i:05d}" for i in range(1000)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, v int").repartition(5)
    got = sorted(r.key for r in first_n(df, n, "key", 42).collect())
    assert got == sorted(brute_force(keys, n, 42))


def test_value_counts_drop_nulls_and_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), (None,), ("c",)], "d string")
    assert [tuple(r) for r in P.value_counts(df, "d", 2).collect()] == [("b", 2), ("a", 1)]


def test_age_profile(spark):
    df = spark.createDataFrame([(float(x),) for x in [-1, -1, 0, 1, 2, 3, 10]], "age_entreprise double")
    r = P.age_profile(df).first()
    assert (r.min_age, r.avg_age, r.max_age, r.median_age) == (0.0, 3.2, 10.0, 2.0)
    approx = P.age_profile(df, exact_median=False).first()
    assert approx.median_age == 2.0


def test_table_profile_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("a", 4)], "s string, n int")
    prof = {r.column_name: r for r in P.table_profile(df, exact=True).collect()}
    assert prof["s"].null_percentage == 25.0 and prof["s"].unique_count == 2
    assert (prof["n"].min, prof["n"].max) == ("1", "4")
    nulls = {r.column_name: r.null_pct for r in P.null_percentages(df, ["s", "n"]).collect()}
    assert nulls == {"s": 25.0, "n": 25.0}


def test_id_quality_and_duplicates(spark):
    df = spark.createDataFrame([("1", "Indéterminé"), ("1", "62"), (None, "In")], "siret string, secteur_activite string")
    r = P.id_quality(df, "siret").first()
    assert (r.total_rows, r.unique_ids, r.missing_ids, r.is_unique) == (3, 1, 1, False)
    assert r.pct_indeterminate_sector == 33.33 and r.pct_in_sector == 33.33
    assert [tuple(x) for x in duplicate_keys(df.filter(F.col("siret").isNotNull()), ["siret"]).collect()] == [("1", 2)]


def _plan(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_dedups_pre_aggregate_before_the_shuffle(spark):
    """A key holding a third of all rows collapses map-side, not in one reducer."""
    from registrum.operators.ingest import dedup_batch
    from registrum.operators.merge import keep_last

    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    for df in (dedup_batch(hot, "k"), keep_last(hot, ["k"], ["v"])):
        plan = _plan(df)
        assert plan.index("Exchange hashpartitioning(k") < plan.rindex("partial_m")
        assert df.count() == 2001
    assert keep_last(hot, ["k"], ["v"]).filter("k = 'hot'").first().v == 2997


def test_expected_columns_reads_the_data(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "secteur_activite string, age_entreprise double")
    got = {r.column_name: r for r in P.expected_columns(df, ["secteur_activite", "department"]).collect()}
    assert got["age_entreprise"].null_pct == 50.0 and got["age_entreprise"].data_type == "double"
    assert got["department"].present is False and got["department"].null_pct is None


def test_cluster_conf_scales_partitions():
    from registrum.session import cluster_conf

    small, mid, big = cluster_conf(1 << 30), cluster_conf(10 << 40), cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(mid["spark.sql.shuffle.partitions"]) == (10 << 40) // (256 << 20) + 1
    assert big["spark.sql.shuffle.partitions"] == "200000"  # capped; AQE splits further
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_first_n_counts_rows_without_key(spark):
    keys = [f"k{i}" for i in range(50)]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 200, "key string")
    for n in (1, 30, 80, 249, 250, 1_000_000):
        assert first_n(df, n, "key", 7).count() == min(n, 250)
    assert first_n(df, 250, "key", 7).filter("key IS NULL").count() == 200


def test_first_n_is_exact_with_repeated_keys(spark):
    rows = [(f"k{i}", j % 4) for i in range(10) for j in range(10)]
    df = spark.createDataFrame(rows, "key string, v int").repartition(3)
    for n in (1, 5, 13, 99, 100, 101):
        one = sorted(map(tuple, first_n(df, n, "key", 42).collect()))
        assert len(one) == min(n, 100) and one == sorted(map(tuple, first_n(df.repartition(7), n, "key", 42).collect()))


def test_first_n_divides_large_parts(spark, monkeypatch):
    from registrum.operators import sample

    monkeypatch.setattr(sample, "RANKED", 3)
    monkeypatch.setattr(sample, "PARTS", 8)
    keys = [f"k{i:05d}" for i in range(400)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert sorted(r.key for r in first_n(df, 123, "key", 1).collect()) == sorted(brute_force(keys, 123, 1))


def test_approximate_profile_offers_both_count_names(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "s string")
    r = P.table_profile(df, exact=False).first()
    assert r.unique_count == r.approx_unique == 2

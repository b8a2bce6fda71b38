from datetime import datetime

from registrum.operators.ingest import dedup_batch, new_rows
from registrum.plans.bronze import ingest_bronze

T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 1, 2), datetime(2026, 1, 3)


def _source(spark, scratch, rows, schema="siret string, data string"):
    path = f"{scratch}/source.parquet"
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
    return path


def test_second_run_of_the_same_stock_adds_nothing(spark, scratch):
    rows = [("30120045600017", "Boulangerie du Pont"), ("41255500100026", None), ("41255500100026", "Garage Est"), (None, "sans numéro")]
    src = _source(spark, scratch, rows)
    bronze = f"{scratch}/bronze"
    first = ingest_bronze(spark, src, bronze, "etablissements_stock", T1)
    assert (first.new_rows, first.null_keys, first.total_rows) == (2, 1, 2)
    second = ingest_bronze(spark, src, bronze, "etablissements_stock", T2)
    assert (second.new_rows, second.null_keys, second.total_rows) == (0, 1, 2)
    assert {(r.siret, r.data) for r in spark.read.parquet(bronze).collect()} == {("30120045600017", "Boulangerie du Pont"), ("41255500100026", "Garage Est")}


def test_insert_only_first_write_wins(spark, scratch):
    bronze = f"{scratch}/bronze"
    ingest_bronze(spark, _source(spark, scratch, [("1", "old")]), bronze, "etablissements", T1)
    ingest_bronze(spark, _source(spark, scratch, [("1", "new"), ("2", "x")]), bronze, "etablissements", T2)
    got = {r.siret: r.data for r in spark.read.parquet(bronze).collect()}
    assert got == {"1": "old", "2": "x"}


def test_cap_adds_next_unseen_rows_each_run(spark, scratch):
    src = _source(spark, scratch, [("a", "1"), ("b", "2"), ("c", "3")])
    bronze = f"{scratch}/bronze"
    counts = [ingest_bronze(spark, src, bronze, "etablissements", t, limit=1).total_rows for t in (T1, T2, T3)]
    assert counts == [1, 2, 3]


def test_null_keys_rejected_by_default_kept_in_parity_mode(spark, scratch):
    src = _source(spark, scratch, [("a", "1"), (None, "2")])
    strict = ingest_bronze(spark, src, f"{scratch}/b1", "etablissements", T1)
    assert (strict.new_rows, strict.null_keys) == (1, 1)
    ingest_bronze(spark, src, f"{scratch}/b2", "etablissements", T1, keep_null_keys=True)
    again = ingest_bronze(spark, src, f"{scratch}/b2", "etablissements", T2, keep_null_keys=True)
    # a NULL key never matches, so parity mode re-inserts it on every run
    assert again.new_rows == 1 and again.total_rows == 3


def test_duplicate_keys_inside_batch_are_deduplicated_deterministically(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("j", "z")] * 50, "siret string, data string")
    one = {tuple(r) for r in dedup_batch(df, "siret").collect()}
    other = {tuple(r) for r in dedup_batch(df.repartition(7), "siret").collect()}
    assert one == other == {("k", "a"), ("j", "z")}


def test_retry_of_same_run_replaces_its_own_batch(spark, scratch):
    src = _source(spark, scratch, [("a", "1"), ("b", "2")])
    bronze = f"{scratch}/bronze"
    ingest_bronze(spark, src, bronze, "etablissements", T1)
    # same run timestamp again (a retried run): its own batch is excluded from
    # the known keys and overwritten, never duplicated
    r = ingest_bronze(spark, src, bronze, "etablissements", T1)
    assert r.total_rows == 2


def test_pk_choice_by_dataset_name(spark):
    src = spark.createDataFrame([("1", "9")], "siret string, siren string")
    known = spark.createDataFrame([("9",)], "siren string")
    assert new_rows(src, known, "siren").count() == 0
    assert new_rows(src, known.withColumnRenamed("siren", "siret"), "siret").count() == 1


def test_anti_join_plan_reads_only_key_column(spark, scratch):
    bronze = f"{scratch}/bronze"
    ingest_bronze(spark, _source(spark, scratch, [("1", "x" * 50)]), bronze, "etablissements", T1)
    known = spark.read.parquet(bronze).select("siret")
    plan = new_rows(spark.read.parquet(f"{scratch}/source.parquet"), known, "siret")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<siret:string>" in plan


def test_empty_first_run_then_rows(spark, scratch):
    from registrum.plans.silver import build_silver

    empty = _source(spark, scratch, [], "siret string, data string")
    bronze = f"{scratch}/bronze"
    r = ingest_bronze(spark, empty, bronze, "etablissements", T1)
    assert (r.new_rows, r.total_rows) == (0, 0)
    res = build_silver(spark, "etablissements", bronze, f"{scratch}/silver", 2026)
    assert res.new_rows == 0 and res.version is None
    r = ingest_bronze(spark, _source(spark, scratch, [("1", "x")]), bronze, "etablissements", T2)
    assert (r.new_rows, r.total_rows) == (1, 1)


def test_first_load_dedups_only_when_a_key_repeats(spark, scratch):
    from registrum.operators.ingest import keys_unique

    dup = _source(spark, scratch, [("1", "b"), ("1", "a"), ("2", "c")])
    r = ingest_bronze(spark, dup, f"{scratch}/b1", "etablissements", T1)
    assert r.total_rows == 2
    got = {x.siret: x.data for x in spark.read.parquet(f"{scratch}/b1").collect()}
    assert got == {"1": "a", "2": "c"}  # smallest row by the other columns
    assert keys_unique(spark.read.parquet(f"{scratch}/b1"), "siret")
    assert not keys_unique(spark.read.parquet(dup), "siret")


def test_registry_schema_without_rows(spark):
    from registrum.operators.ingest import empty_like

    df = empty_like(spark.createDataFrame([("1", 2.5)], "siret string, x double"), T1)
    assert df.dtypes == [("siret", "string"), ("x", "double"), ("ingested_at", "timestamp_ntz"), ("batch_id", "bigint")]
    assert df.collect() == []


def test_cap_above_the_input_is_no_cap(spark, scratch):
    src = _source(spark, scratch, [(str(i) if i % 2 else None, "x") for i in range(60)])
    free = ingest_bronze(spark, src, f"{scratch}/b0", "etablissements", T1, keep_null_keys=True)
    capped = ingest_bronze(spark, src, f"{scratch}/b1", "etablissements", T1, limit=1_000_000, keep_null_keys=True)
    assert free.total_rows == capped.total_rows == 60
    assert ingest_bronze(spark, src, f"{scratch}/b2", "etablissements", T1, limit=45, keep_null_keys=True).total_rows == 45


def test_batches_come_in_the_order_of_time(spark, scratch):
    import pytest

    from registrum.plans.bronze import StaleBatch, batches, seal

    bronze = f"{scratch}/bronze"
    ingest_bronze(spark, _source(spark, scratch, [("1", "x")]), bronze, "etablissements", T2)
    more = _source(spark, scratch, [("1", "x"), ("2", "y")])
    with pytest.raises(StaleBatch):
        ingest_bronze(spark, more, bronze, "etablissements", T1)
    assert ingest_bronze(spark, more, bronze, "etablissements", T2).total_rows == 2  # a retry
    seal(spark, bronze, batches(spark, bronze)[-1])
    with pytest.raises(StaleBatch):
        ingest_bronze(spark, more, bronze, "etablissements", T2)
    assert ingest_bronze(spark, more, bronze, "etablissements", T3).new_rows == 0
    assert spark.read.parquet(bronze).count() == 2

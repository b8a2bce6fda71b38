from datetime import datetime

from registrum.plans.export import export_sampled_master
from registrum.plans.gold import read_gold
from registrum.plans.run_all import run_medallion
from registrum.sources import testdata as td
from registrum.spec import MASTER_TABLE
from registrum.streaming.bronze_stream import start_bronze_stream

from .conftest import SF001


def _sources(spark, scratch):
    etab = f"{scratch}/src/etab.parquet"
    ul = f"{scratch}/src/ul.parquet"
    td.establishments(spark, SF001).drop("ingested_at").write.parquet(etab)
    td.legal_units(spark, SF001).drop("ingested_at").write.parquet(ul)
    return {"etablissements": etab, "unites_legales": ul}


def test_end_to_end_run_twice(spark, scratch):
    sources = _sources(spark, scratch)
    root = f"{scratch}/lake"
    rep = run_medallion(spark, sources, root, datetime(2026, 1, 1), 2026)
    assert all(s["ok"] for s in rep.steps), rep.steps
    master = read_gold(spark, f"{root}/gold", MASTER_TABLE)
    n = master.count()
    assert n > 0
    # a second identical run adds nothing anywhere
    rep2 = run_medallion(spark, sources, root, datetime(2026, 1, 2), 2026)
    assert all(s["ok"] for s in rep2.steps), rep2.steps
    assert read_gold(spark, f"{root}/gold", MASTER_TABLE).count() == n
    out = f"{scratch}/export_csv"
    from registrum.sources.store import SnapshotStore

    master_paths = list(SnapshotStore(spark, f"{root}/gold/{MASTER_TABLE}").current().paths)
    assert export_sampled_master(spark, master_paths, out, n_rows=50) == min(50, n)
    assert rep.to_df(spark).count() == 5


def test_gold_skipped_when_a_silver_fails(spark, scratch):
    sources = _sources(spark, scratch)
    sources["unites_legales"] = f"{scratch}/does_not_exist.parquet"
    rep = run_medallion(spark, sources, f"{scratch}/lake", datetime(2026, 1, 1), 2026)
    layers = {(s["layer"], s["dataset"]): s["ok"] for s in rep.steps}
    assert layers[("bronze", "unites_legales")] is False
    assert layers[("silver", "etablissements")] is True
    assert layers[("gold", "all")] is False


def test_streaming_delivery_is_idempotent(spark, scratch):
    src_dir = f"{scratch}/incoming"
    stock = td.establishments(spark, SF001).drop("ingested_at")
    stock.limit(100).write.mode("append").parquet(src_dir)
    bronze = f"{scratch}/bronze"
    q = start_bronze_stream(spark, src_dir, stock.schema, bronze, "etablissements", f"{scratch}/ckpt")
    q.awaitTermination(120)
    first = spark.read.parquet(bronze).count()
    # a new file with overlapping and new keys
    stock.write.mode("append").parquet(src_dir)
    q = start_bronze_stream(spark, src_dir, stock.schema, bronze, "etablissements", f"{scratch}/ckpt")
    q.awaitTermination(120)
    assert first == stock.limit(100).select("siret").distinct().count()
    assert spark.read.parquet(bronze).count() == stock.select("siret").distinct().count()


def test_report_jobs(spark, scratch):
    from registrum.plans import reports as R

    sources = _sources(spark, scratch)
    root = f"{scratch}/lake"
    run_medallion(spark, sources, root, datetime(2026, 1, 1), 2026)
    prof = R.silver_profile(spark, f"{root}/silver")
    assert {r.dataset for r in prof.select("dataset").distinct().collect()} == {"etablissements", "unites_legales"}
    checks = {r.dataset: r for r in R.silver_checks(spark, f"{root}/silver").collect()}
    assert checks["etablissements"].missing_columns == "" and checks["etablissements"].batches == 1
    gold = {r.table: r.rows for r in R.gold_checks(spark, f"{root}/gold").collect()}
    assert gold[MASTER_TABLE] == checks["etablissements"].rows
    assert "master_without_legal_unit" in gold
    assert R.silver_region_distribution(spark, f"{root}/silver").count() > 0
    assert R.gold_preview(spark, f"{root}/gold")[MASTER_TABLE].count() == 3
    assert R.silver_quality(spark, f"{root}/silver").count() == 2
    batches = R.bronze_checks(spark, f"{root}/bronze").collect()
    assert {b.dataset for b in batches} == {"etablissements", "unites_legales"}
    assert R.bronze_columns(spark, f"{root}/bronze").filter("column_name = 'batch_id'").count() == 2


def test_run_reports_are_kept(spark, scratch):
    sources = _sources(spark, scratch)
    root = f"{scratch}/lake"
    run_medallion(spark, sources, root, datetime(2026, 1, 1), 2026)
    run_medallion(spark, sources, root, datetime(2026, 1, 2), 2026)
    runs = spark.read.parquet(f"{root}/_runs")
    assert runs.select("run_ts").distinct().count() == 2
    assert runs.filter("NOT ok").count() == 0


def test_streaming_replay_after_lost_commit_adds_nothing(spark, scratch):
    import os

    src_dir = f"{scratch}/incoming"
    stock = td.establishments(spark, SF001).drop("ingested_at")
    stock.write.mode("append").parquet(src_dir)
    bronze, ckpt = f"{scratch}/bronze", f"{scratch}/ckpt"
    q = start_bronze_stream(spark, src_dir, stock.schema, bronze, "etablissements", ckpt)
    q.awaitTermination(120)
    n = spark.read.parquet(bronze).count()
    # simulate a crash after the Bronze write but before the batch commit:
    # the micro-batch is replayed on restart and must not append twice
    commits = sorted(os.listdir(f"{ckpt}/commits"), key=lambda x: (len(x), x))
    last = [c for c in commits if c.isdigit()][-1]
    os.remove(f"{ckpt}/commits/{last}")
    if os.path.exists(f"{ckpt}/commits/.{last}.crc"):
        os.remove(f"{ckpt}/commits/.{last}.crc")
    q = start_bronze_stream(spark, src_dir, stock.schema, bronze, "etablissements", ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == n


def test_command_line(spark, scratch, capsys):
    from registrum.__main__ import main

    sources = _sources(spark, scratch)
    root = f"{scratch}/lake"
    args = ["run", "--establishments", sources["etablissements"], "--legal-units", sources["unites_legales"]]
    assert main(args + ["--root", root, "--as-of-year", "2026"]) == 0
    assert main(["check-gold", "--root", root]) == 0
    assert main(["check-bronze", "--root", root]) == 0
    assert main(["export-sample", "--root", root, "--output", f"{scratch}/csv", "--rows", "10"]) == 0
    assert "exported 10 rows" in capsys.readouterr().out


def test_streaming_default_checkpoint_under_checkpoint_dir(spark, scratch):
    src_dir = f"{scratch}/incoming"
    stock = td.establishments(spark, SF001).drop("ingested_at")
    stock.limit(10).write.parquet(src_dir)
    q = start_bronze_stream(spark, src_dir, stock.schema, f"{scratch}/bronze", f"etablissements_{abs(hash(scratch))}")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{scratch}/bronze").count() == 10


def test_stream_loses_no_row_over_several_runs(spark, scratch):
    """Whole micro-batches, and a replay after Silver has read changes nothing."""
    from pyspark.sql import functions as F

    from registrum.plans import catalog as C
    from registrum.plans.bronze import batches as bronze_batches
    from registrum.plans.bronze import seal
    from registrum.streaming.bronze_stream import epoch_timestamp

    stock = C.etab_stock(spark, SF001)
    src, bronze, ckpt = f"{scratch}/in", f"{scratch}/bronze", f"{scratch}/ckpt"
    total = 0
    for part in range(3):
        rows = stock.filter(F.col("siret").cast("long") % 3 == part)
        rows.write.mode("append").parquet(src)
        start_bronze_stream(spark, src, stock.schema, bronze, "etablissements", ckpt).awaitTermination()
        total += rows.count()
        assert spark.read.parquet(bronze).count() == total
    ids = bronze_batches(spark, bronze)
    assert len(ids) == 3 and epoch_timestamp(spark, f"{ckpt}-epochs", 2, bronze) == epoch_timestamp(spark, f"{ckpt}-epochs", 2, bronze)
    seal(spark, bronze, ids[-1])
    start_bronze_stream(spark, src, stock.schema, bronze, "etablissements", f"{scratch}/other").awaitTermination()
    assert spark.read.parquet(bronze).count() == total

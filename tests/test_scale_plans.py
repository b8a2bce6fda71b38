"""Plan regression checks: the physical properties the scale design relies on."""

import contextlib
import io
from datetime import datetime

from pyspark.sql import functions as F

from registrum.operators import gold as G
from registrum.operators.clean import silver_increment
from registrum.operators.sample import first_n
from registrum.plans import catalog as C
from registrum.plans.bronze import ingest_bronze, ingest_increment
from registrum.spec import ESTABLISHMENTS, REGION_DEPARTMENTS

from .conftest import SF001


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_bronze_increment_reads_keys_only_for_detection(spark, scratch):
    stock = C.etab_stock(spark, SF001)
    stock.filter(F.col("siret").cast("long") % 10 != 0).write.parquet(f"{scratch}/src1")
    stock.write.parquet(f"{scratch}/src2")
    ingest_bronze(spark, f"{scratch}/src1", f"{scratch}/bronze", "etablissements", datetime(2026, 1, 1))
    inc = ingest_increment(
        spark, spark.read.parquet(f"{scratch}/src2"), f"{scratch}/bronze", "etablissements", datetime(2026, 1, 2)
    )
    plan = plan_of(inc)
    # the new keys are found once and staged: what is left reads them, and no registry
    assert plan.count("ReadSchema: struct<siret:string>") == 1 and "staged/new-keys" in plan
    assert f"{scratch}/bronze" not in plan
    # they were measured small and no key repeats: the stock file is filtered map-side, without a shuffle
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "Exchange hashpartitioning" not in plan
    assert inc.count() == stock.count() - stock.filter(F.col("siret").cast("long") % 10 != 0).count()


def test_silver_increment_prunes_batches_and_pushes_region(spark, scratch):
    ingest_bronze(spark, C.etab_stock(spark, SF001), f"{scratch}/bronze", "etablissements", datetime(2026, 1, 1))
    bronze = spark.read.parquet(f"{scratch}/bronze")
    plan = plan_of(silver_increment(bronze, ESTABLISHMENTS, datetime(2025, 1, 1), REGION_DEPARTMENTS, 2026))
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "(batch_id" in plan
    assert "StringStartsWith(codePostalEtablissement,75)" in plan


def test_dominant_sector_uses_group_limit(spark):
    plan = plan_of(G.kpi_dominant_sector(C.etab_silver(spark, SF001)), "simple")
    assert "WindowGroupLimit" in plan


def test_sample_result_is_a_filter_not_a_global_sort(spark):
    df = C.etab_silver(spark, SF001)
    plan = plan_of(first_n(df, 50, "siret", 42), "simple")
    assert "TakeOrderedAndProject" not in plan
    assert "], true, 0" not in plan  # no global sort; only aggregates' local sorts


def test_no_python_udf_in_headline_plans(spark):
    for name in ("q09_anti_join_new_rows", "q17_silver_merge", "q20_master", "q22_kpi_dominant_sector", "q33_table_profile"):
        plan = plan_of(C.QUERIES[name](spark, SF001), "simple")
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name

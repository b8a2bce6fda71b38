"""Benchmark: headline catalogue queries plus one end-to-end Bronze -> Silver ->
Gold run, on $BENCH_SF_DIR (default /root/testdata/sf0.1) with local[$BENCH_CPUS].

Each query is fully executed with the ``noop`` sink (no driver collect), so
the time is the plan's own work. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from registrum.plans import catalog as C  # noqa: E402
from registrum.plans.run_all import run_medallion  # noqa: E402
from registrum.session import local_session  # noqa: E402
from registrum.sources import testdata as td  # noqa: E402

HEADLINE = [
    "q09_anti_join_new_rows",
    "q12_region_filter",
    "q16_capped_increment",
    "q17_silver_merge",
    "q17b_lineitem_last_wins",
    "q18_rule_violations",
    "q19_duplicate_keys",
    "q20_master",
    "q21_kpi_by_department",
    "q22_kpi_dominant_sector",
    "q23_kpi_company_size",
    "q26_region_share",
    "q28_age_profile",
    "q30_id_quality",
    "q33_table_profile",
    "q37_hash_sample",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8, app="registrum-bench")
    # warm-up (JVM, codegen caches); not timed
    run_noop(C.q07_engineered(spark, sf_dir))

    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = C.QUERIES[name]
        t0 = time.perf_counter()
        run_noop(fn(spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    # End-to-end runs on a scratch lake: a first load of 90% of the companies
    # (legal units and their establishments), then the whole stock (10% new
    # companies: the daily increment), then the same stock again (nothing new).
    scratch = tempfile.mkdtemp(prefix="run-")
    etab = td.establishments(spark, sf_dir).drop("ingested_at")
    ul = td.legal_units(spark, sf_dir).drop("ingested_at")
    first = {"etablissements": f"{scratch}/src1/e.parquet", "unites_legales": f"{scratch}/src1/u.parquet"}
    full = {"etablissements": f"{scratch}/src2/e.parquet", "unites_legales": f"{scratch}/src2/u.parquet"}
    etab.filter(F.col("siren").cast("long") % 10 != 0).write.parquet(first["etablissements"])
    ul.filter(F.col("siren").cast("long") % 10 != 0).write.parquet(first["unites_legales"])
    etab.write.parquet(full["etablissements"])
    ul.write.parquet(full["unites_legales"])
    lake = f"{scratch}/lake"
    reports = []
    for label, src, day in (
        ("medallion_first_load", first, 1),
        ("medallion_daily_increment", full, 2),
        ("medallion_noop_rerun", full, 3),
    ):
        t0 = time.perf_counter()
        reports.append(run_medallion(spark, src, lake, datetime(2026, 1, day), 2026))
        times[label] = round(time.perf_counter() - t0, 3)
    ok = all(s["ok"] for rep in reports for s in rep.steps)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "spark": spark.version,
                "runs_ok": ok,
            }
        )
    )


if __name__ == "__main__":
    main()

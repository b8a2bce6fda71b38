"""Command line: ``python -m registrum <command>``.

  run            Bronze -> Silver -> Gold for the two stock files
  check-bronze   batches (rows, audit time) and columns of Bronze
  check-silver   profile, quality and region distribution of Silver
  check-gold     row counts, join integrity and previews of Gold
  export-sample  reproducible sample of the master table as CSV

On a cluster the session comes from ``spark-submit``; locally a
``local[*]`` session is created.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    if master:
        from registrum.session import local_session

        cores = master[len("local[") : -1] if master.startswith("local[") else "*"
        return local_session(cores=cores, partitions=8)
    from registrum.session import ensure_checkpoint_dir

    spark = SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _show(title: str, df, n: int = 50) -> None:
    print(f"\n== {title}")
    df.show(n, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="registrum")
    p.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("run", help="Bronze, Silver and Gold in sequence")
    r.add_argument("--establishments", required=True, help="establishment stock Parquet path")
    r.add_argument("--legal-units", required=True, help="legal-unit stock Parquet path")
    r.add_argument("--root", required=True, help="lake root (bronze/, silver/, gold/ below it)")
    r.add_argument("--as-of-year", type=int, default=datetime.now().year)
    r.add_argument("--limit", type=int, default=0, help="rows per dataset per run (0 = all)")
    r.add_argument("--departments", default=None, help="comma list; default: the region's eight")

    cb = sub.add_parser("check-bronze")
    cb.add_argument("--root", required=True)
    cs = sub.add_parser("check-silver")
    cs.add_argument("--root", required=True)
    cg = sub.add_parser("check-gold")
    cg.add_argument("--root", required=True)

    ex = sub.add_parser("export-sample")
    ex.add_argument("--root", required=True)
    ex.add_argument("--output", required=True)
    ex.add_argument("--rows", type=int, default=None)

    a = p.parse_args(argv)
    spark = _session(a.master)

    if a.cmd == "run":
        from registrum.plans.run_all import run_medallion
        from registrum.spec import REGION_DEPARTMENTS

        deps = tuple(a.departments.split(",")) if a.departments else REGION_DEPARTMENTS
        rep = run_medallion(
            spark,
            {"etablissements": a.establishments, "unites_legales": a.legal_units},
            a.root,
            datetime.now(UTC).replace(tzinfo=None),  # as the stream stamps its batches
            a.as_of_year,
            a.limit,
            deps,
        )
        for step in rep.steps:
            print(json.dumps(step))
        return 0 if all(s["ok"] for s in rep.steps) else 1

    if a.cmd == "check-bronze":
        from registrum.plans import reports as R

        bronze = f"{a.root.rstrip('/')}/bronze"
        _show("batches", R.bronze_checks(spark, bronze))
        _show("columns", R.bronze_columns(spark, bronze), 200)
        return 0

    if a.cmd == "check-silver":
        from registrum.plans import reports as R

        silver = f"{a.root.rstrip('/')}/silver"
        _show("checks", R.silver_checks(spark, silver))
        _show("quality", R.silver_quality(spark, silver))
        _show("profile", R.silver_profile(spark, silver), 200)
        _show("region distribution", R.silver_region_distribution(spark, silver))
        _show("distributions", R.silver_distributions(spark, silver))
        _show("ages", R.silver_ages(spark, silver))
        _show("top departments", R.silver_top_departments(spark, silver))
        return 0

    if a.cmd == "check-gold":
        from registrum.plans import reports as R

        gold = f"{a.root.rstrip('/')}/gold"
        _show("row counts and integrity", R.gold_checks(spark, gold))
        for name, df in R.gold_preview(spark, gold).items():
            _show(f"preview {name}", df)
        return 0

    if a.cmd == "export-sample":
        from registrum.plans.export import export_sampled_master
        from registrum.sources.store import SnapshotStore
        from registrum.spec import MASTER_TABLE, SAMPLE_ROWS

        snap = SnapshotStore(spark, f"{a.root.rstrip('/')}/gold/{MASTER_TABLE}").current()
        if snap is None:
            print("no master table yet", file=sys.stderr)
            return 1
        n = export_sampled_master(spark, list(snap.paths), a.output, a.rows or SAMPLE_ROWS)
        print(f"exported {n} rows to {a.output}")
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())

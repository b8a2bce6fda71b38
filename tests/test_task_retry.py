"""Task failures: the first attempt of a task dies mid-stage, Spark retries it,
and the published results are exact (no lost or doubled rows).

Runs in a subprocess: task retries need a ``local[n, maxFailures]`` master,
which cannot be changed inside the test session's JVM.
"""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = textwrap.dedent(
    """
    import json, sys, tempfile
    sys.path.insert(0, {root!r})
    from datetime import datetime
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from registrum.plans.bronze import ingest_bronze
    from registrum.plans.silver import build_silver
    from registrum.sources import testdata as td
    from registrum.sources.store import SnapshotStore

    spark = (SparkSession.builder.master("local[2,4]")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    d = tempfile.mkdtemp(prefix="registrum-retry-")
    stock = td.establishments(spark, "/root/testdata/sf0.001").drop("ingested_at").repartition(4)
    stock.write.parquet(d + "/src")
    expected = stock.select("siret").distinct().count()

    def flaky(batches):
        # test-only failure injector: the first attempt of partition 1 dies
        ctx = TaskContext.get()
        for b in batches:
            if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
                raise RuntimeError("simulated executor loss")
            yield b

    src = spark.read.parquet(d + "/src")
    src = src.mapInPandas(flaky, src.schema)
    r = ingest_bronze(spark, src, d + "/bronze", "etablissements", datetime(2026, 1, 1))
    s = build_silver(spark, "etablissements", d + "/bronze", d + "/silver", 2026)
    silver = SnapshotStore(spark, d + "/silver/etablissements").read()
    print(json.dumps({{
        "expected": expected, "bronze": r.total_rows,
        "silver": s.total_rows, "silver_distinct": silver.select("siret").distinct().count(),
        "silver_rows": silver.count()}}))
    """
)


def test_results_exact_after_task_retries(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "simulated executor loss" in out.stderr  # the failure really happened and was retried
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["bronze"] == res["expected"]
    assert res["silver"] == res["silver_rows"] == res["silver_distinct"] > 0

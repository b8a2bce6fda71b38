"""End-to-end run: Bronze for every dataset, Silver for each dataset whose Bronze
succeeded, Gold only when every Silver succeeded. Failures are isolated per
dataset and reported as data, not raised."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from registrum.functions.columns import ntz
from registrum.plans.bronze import ingest_bronze
from registrum.plans.gold import build_gold
from registrum.plans.silver import build_silver
from registrum.spec import REGION_DEPARTMENTS

log = logging.getLogger("registrum")


@dataclass
class RunReport:
    steps: list[dict] = field(default_factory=list)

    def add(self, layer: str, dataset: str, ok: bool, seconds: float, detail) -> None:
        metric = lambda *names: next((int(v) for n in names if (v := getattr(detail, n, None)) is not None), None)
        self.steps.append(
            {
                "layer": layer, "dataset": dataset, "ok": ok, "seconds": round(seconds, 3), "detail": str(detail),
                "new_rows": metric("new_rows"), "total_rows": metric("total_rows", "master_rows"),
                "null_keys": metric("null_keys"), "rejected_postal": metric("rejected_postal"),
            }
        )

    def ok(self, layer: str) -> list[str]:
        return [s["dataset"] for s in self.steps if s["layer"] == layer and s["ok"]]

    def to_df(self, spark: SparkSession) -> DataFrame:
        schema = (
            "layer string, dataset string, ok boolean, seconds double, detail string, "
            "new_rows long, total_rows long, null_keys long, rejected_postal long"
        )
        return spark.createDataFrame([tuple(s.values()) for s in self.steps], schema)

    def save(self, spark: SparkSession, path: str, run_ts: datetime) -> None:
        """Append this run's step report to the run-metrics table."""
        (
            self.to_df(spark)
            .withColumn("run_ts", ntz(run_ts))
            .coalesce(1)
            .write.mode("append")
            .parquet(path)
        )


def _timed(report: RunReport, layer: str, dataset: str, fn):
    t0 = time.time()
    try:
        res = fn()
        report.add(layer, dataset, True, time.time() - t0, res)
        return res
    except Exception as e:  # noqa: BLE001 - isolation is the point
        log.error("%s failed for %s: %s", layer, dataset, e)
        report.add(layer, dataset, False, time.time() - t0, repr(e))
        return None


def run_medallion(
    spark: SparkSession,
    sources: dict[str, str | DataFrame],
    root: str,
    run_ts: datetime,
    as_of_year: int,
    limit: int = 0,
    departments=REGION_DEPARTMENTS,
) -> RunReport:
    """``sources`` maps dataset name -> source path (or DataFrame)."""
    root = root.rstrip("/")
    report = RunReport()
    for name, src in sources.items():
        _timed(
            report,
            "bronze",
            name,
            lambda n=name, s=src: ingest_bronze(spark, s, f"{root}/bronze/{n}", n, run_ts, limit),
        )
    for name in report.ok("bronze"):
        _timed(
            report,
            "silver",
            name,
            lambda n=name: build_silver(spark, n, f"{root}/bronze/{n}", f"{root}/silver", as_of_year, departments),
        )
    if len(report.ok("silver")) == len(sources):
        _timed(report, "gold", "all", lambda: build_gold(spark, f"{root}/silver", f"{root}/gold"))
    else:
        report.add("gold", "all", False, 0.0, f"skipped: silver ok for {report.ok('silver')}")
    report.save(spark, f"{root}/_runs", run_ts)
    return report

"""The stream into Silver, killed at each point between its commits and started again."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from registrum.plans import catalog as C
from registrum.plans.silver import build_silver
from registrum.sources.store import SnapshotStore
from registrum.spec import REGION_DEPARTMENTS
from registrum.streaming.silver_stream import start_silver_stream

from .conftest import SF001

REPO = Path(__file__).resolve().parents[1]
#: The process ends inside the second micro-batch: after the Bronze write, with the Silver files written but
#: not committed, committed but not sealed, sealed but not noted by the stream.
KILLED = """
import os, sys
sys.path.insert(0, {repo!r})
from registrum.session import local_session
spark = local_session(2, 2)
import registrum.plans.silver as silver
import registrum.streaming.bronze_stream as bronze
from registrum.sources.store import SnapshotStore
point, calls = {point!r}, dict()

def end_at(owner, name, when):
    real = getattr(owner, name)
    def run(*a, **k):
        calls[name] = calls.get(name, 0) + 1
        last = calls[name] == 2
        if last and when == "before":
            os._exit(9)
        out = real(*a, **k)
        if last:
            os._exit(9)
        return out
    setattr(owner, name, run)

end_at(*{{"bronze": (bronze, "ingest_bronze", "after"), "written": (SnapshotStore, "_commit", "before"), "committed": (silver, "seal", "before"), "sealed": (silver, "seal", "after")}}[point])
from tests.test_silver_stream import consume
consume(spark, {root!r})
"""


def consume(spark, root):
    schema = C.etab_stock(spark, SF001).schema
    start_silver_stream(spark, f"{root}/in", schema, f"{root}/bronze", f"{root}/silver", "etablissements", 2026, REGION_DEPARTMENTS, f"{root}/ckpt", 1, 3).awaitTermination(300)


def deliveries(spark, root):
    """Three files: new keys, some that come again, and all at last."""
    stock = C.etab_stock(spark, SF001)
    for i, part in enumerate(("siret % 3 = 0", "siret % 3 <= 1", "true")):
        stock.filter(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        newest = max((p for p in Path(f"{root}/in").glob("*.parquet")), key=lambda p: p.stat().st_mtime_ns)
        os.utime(newest, (1_700_000_000 + i, 1_700_000_000 + i))  # consumed in this order


def rows_of(spark, root):
    df = SnapshotStore(spark, f"{root}/silver/etablissements").read()
    return sorted(map(tuple, df.drop("ingested_at").collect()), key=str)


@pytest.fixture(scope="module")
def batch_result(spark, tmp_path_factory):
    from datetime import datetime

    from registrum.plans.bronze import ingest_bronze

    root = str(tmp_path_factory.mktemp("batch"))
    ingest_bronze(spark, C.etab_stock(spark, SF001), f"{root}/bronze", "etablissements", datetime(2026, 1, 1))
    build_silver(spark, "etablissements", f"{root}/bronze", f"{root}/silver", 2026)
    return rows_of(spark, root)


def test_stream_equals_batch(spark, scratch, batch_result):
    deliveries(spark, scratch)
    consume(spark, scratch)
    assert rows_of(spark, scratch) == batch_result and len(batch_result) > 100
    assert len(SnapshotStore(spark, f"{scratch}/silver/etablissements").committed()) == 3


@pytest.mark.parametrize("point", ["bronze", "written", "committed", "sealed"])
def test_killed_and_started_again(spark, scratch, batch_result, point):
    deliveries(spark, scratch)
    code = KILLED.format(repo=str(REPO), root=scratch, point=point)
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=300)
    assert done.returncode == 9, done.stderr[-2000:]
    assert rows_of(spark, scratch) != batch_result  # it did end on the way
    consume(spark, scratch)
    assert rows_of(spark, scratch) == batch_result
    consume(spark, scratch)  # nothing more comes
    assert rows_of(spark, scratch) == batch_result

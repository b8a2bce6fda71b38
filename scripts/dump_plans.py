"""Write PLANS.md: the physical plans of the operators that matter at scale,
taken after execution (AQE final plans) on a lake built from the driver tables.

    python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
import tempfile
from datetime import datetime
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from registrum.operators.clean import silver_increment  # noqa: E402
from registrum.operators.gold import master_table  # noqa: E402
from registrum.plans import catalog as C  # noqa: E402
from registrum.plans.bronze import ingest_increment  # noqa: E402
from registrum.plans.run_all import run_medallion  # noqa: E402
from registrum.session import local_session  # noqa: E402
from registrum.sources import testdata as td  # noqa: E402
from registrum.sources.store import SnapshotStore  # noqa: E402
from registrum.spec import ESTABLISHMENTS, REGION_DEPARTMENTS  # noqa: E402


def plan(df) -> str:
    df.collect()  # execute this very plan so explain shows the AQE final plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"#\d+", "", buf.getvalue())
    text = re.sub(r"file:/tmp/[^\]\s,]+", "<lake>", text)
    text = re.sub(r"file:/root/testdata/[^\]\s,]+", "<testdata>", text)
    return text.strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    lake = tempfile.mkdtemp(prefix="run-")
    src = {"etablissements": f"{lake}/src/e.parquet", "unites_legales": f"{lake}/src/u.parquet"}
    td.establishments(spark, sf).drop("ingested_at").write.parquet(src["etablissements"])
    td.legal_units(spark, sf).drop("ingested_at").write.parquet(src["unites_legales"])
    run_medallion(spark, src, f"{lake}/lake", datetime(2026, 1, 1), 2026)
    bronze = spark.read.parquet(f"{lake}/lake/bronze/etablissements")
    etab = SnapshotStore(spark, f"{lake}/lake/silver/etablissements").read()
    ul = SnapshotStore(spark, f"{lake}/lake/silver/unites_legales").read()

    sections = [
        (
            "Bronze: unknown keys found on the key column, only their rows fetched (broadcast semi-join) and deduplicated",
            ingest_increment(
                spark, spark.read.parquet(src["etablissements"]), f"{lake}/lake/bronze/etablissements",
                "etablissements", datetime(2026, 1, 2),
            ),
        ),
        (
            "Silver increment from Bronze: mark and region predicates pushed to Parquet, batch partitions pruned",
            silver_increment(bronze, ESTABLISHMENTS, datetime(2025, 12, 31), REGION_DEPARTMENTS, 2026),
        ),
        (
            "Gold master with hot-key split (legal units not broadcast whole)",
            master_table(etab, ul, max_broadcast_bytes=0, split_hot_keys=True),
        ),
        ("Gold master, measured broadcast (legal units fit under the bound)", master_table(etab, ul, 64 << 20)),
        ("KPI 2 from the master files: partial aggregation, WindowGroupLimit", C.G.kpi_dominant_sector(etab)),
        ("Last-wins dedup on lineitem (partial aggregation before the exchange)", C.q17b_lineitem_last_wins(spark, sf)),
        ("Share report: scalar subquery denominator", C.P.region_share(etab)),
        ("Exact hash sample: distributed final filter", C.P.row_count(C.hash_sample(etab, 500, "siret", 42))),
    ]
    out = ["# Physical plans", "", f"Generated by `scripts/dump_plans.py` on `{Path(sf).name}` after execution (AQE final plans).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()

"""Report jobs over the published layers (profiling, quality, previews).

Each returns a DataFrame; datasets are discovered from the layer directories,
one read per dataset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.operators import gold as G
from registrum.operators import profile as P
from registrum.sources import parquet as pq
from registrum.sources.store import BUCKET, SnapshotStore
from registrum.spec import (
    AGE,
    DEPARTMENT,
    INGESTED_AT,
    KPI_BUSINESS_SIZE,
    KPI_BY_DEPARTMENT,
    KPI_DOMINANT_SECTORS,
    MASTER_TABLE,
    SECTOR,
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def published(spark: SparkSession, layer_root: str) -> dict[str, DataFrame]:
    """Every committed table under a layer directory, by name."""
    out = {}
    for name in pq.list_names(spark, layer_root):
        df = SnapshotStore(spark, f"{layer_root.rstrip('/')}/{name}").read()
        if df is not None:
            out[name] = df
    return out


def silver_profile(spark: SparkSession, silver_root: str, exact: bool = False) -> DataFrame:
    """Per dataset and column: null percentage, distinct count, min, max."""
    tables = published(spark, silver_root)
    if not tables:
        raise pq.MissingInput(f"No Silver table under {silver_root}")
    return _union([P.table_profile(df, exact).select(F.lit(n).alias("dataset"), "*") for n, df in tables.items()])


def silver_sketch_profile(spark: SparkSession, silver_root: str) -> DataFrame:
    """The profile of every Silver table from the sketches kept with its segments: no table is scanned. A
    table with a segment that has none is sketched whole."""
    parts = []
    for name in pq.list_names(spark, silver_root):
        store = SnapshotStore(spark, f"{silver_root.rstrip('/')}/{name}")
        snap = store.current()
        if snap is not None:
            kept = store.profiles(snap)
            if kept is None:
                kept = P.sketch_rows(store.rows_of(snap).withColumn(BUCKET, F.lit(0)), BUCKET)
            parts.append(P.merged_profile(kept).select(F.lit(name).alias("dataset"), "*"))
    if not parts:
        raise pq.MissingInput(f"No Silver table under {silver_root}")
    return _union(parts)


def silver_region_distribution(spark: SparkSession, silver_root: str) -> DataFrame:
    df = SnapshotStore(spark, f"{silver_root.rstrip('/')}/etablissements").read()
    if df is None:
        raise pq.MissingInput(f"No establishments under {silver_root}")
    return P.region_share(df)


def silver_checks(spark: SparkSession, silver_root: str) -> DataFrame:
    """Per dataset: rows, engineered columns present, load span, batches,
    mean positive age."""
    rows = []
    for name, df in published(spark, silver_root).items():
        expected = [SECTOR, AGE, INGESTED_AT] + ([DEPARTMENT] if "etablissements" in name else [])
        missing = [c for c in expected if c not in df.columns]
        aggs = [F.count(F.lit(1)).alias("rows")]
        if INGESTED_AT in df.columns:
            aggs += [
                F.min(INGESTED_AT).alias("first_load"),
                F.max(INGESTED_AT).alias("last_load"),
                F.count_distinct(INGESTED_AT).alias("batches"),
            ]
        if AGE in df.columns:
            aggs.append(F.avg(F.when(F.col(AGE) > 0, F.col(AGE))).alias("avg_positive_age"))
        rows.append(
            df.agg(*aggs).select(
                F.lit(name).alias("dataset"), "*", F.lit(",".join(missing)).alias("missing_columns")
            )
        )
    return _union(rows)


#: Columns whose most frequent values the quality report shows, by dataset.
DISTRIBUTIONS = {
    "etablissements": (DEPARTMENT, SECTOR, "etatAdministratifEtablissement"),
    "unites_legales": (SECTOR, "economieSocialeSolidaireUniteLegale"),
}


def silver_distributions(spark: SparkSession, silver_root: str, k: int = 5) -> DataFrame:
    """The k most frequent values of each reported column, with their share of the rows."""
    tables = published(spark, silver_root)
    parts = [P.top_values_tagged(tables[n], n, c, k) for n, cols in DISTRIBUTIONS.items() if n in tables for c in cols if c in tables[n].columns]
    if not parts:
        raise pq.MissingInput(f"No Silver table under {silver_root}")
    return _union(parts)


def silver_ages(spark: SparkSession, silver_root: str) -> DataFrame:
    """The age profile of every dataset that has ages."""
    parts = [P.age_profile(df).select(F.lit(n).alias("dataset"), "*") for n, df in published(spark, silver_root).items() if AGE in df.columns]
    if not parts:
        raise pq.MissingInput(f"No Silver table under {silver_root}")
    return _union(parts)


def silver_top_departments(spark: SparkSession, silver_root: str, k: int = 3) -> DataFrame:
    df = SnapshotStore(spark, f"{silver_root.rstrip('/')}/etablissements").read()
    if df is None:
        raise pq.MissingInput(f"No establishments under {silver_root}")
    return P.value_counts(df, DEPARTMENT, k)


def gold_checks(spark: SparkSession, gold_root: str) -> DataFrame:
    """Row count of every Gold table plus the join-integrity count."""
    tables = published(spark, gold_root)
    parts = [P.row_count(df).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    if MASTER_TABLE in tables:
        parts.append(
            G.unmatched(tables[MASTER_TABLE]).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit("master_without_legal_unit").alias("table"), "rows"
            )
        )
    return _union(parts)


def gold_preview(spark: SparkSession, gold_root: str, n: int = 3) -> dict[str, DataFrame]:
    """First rows of each Gold table (master by siret; KPIs in their order)."""
    tables = published(spark, gold_root)
    out = {}
    for name, df in tables.items():
        if name == MASTER_TABLE:
            out[name] = df.select("siret", "denominationUniteLegale", DEPARTMENT, AGE).orderBy("siret").limit(n)
        elif name in (KPI_BY_DEPARTMENT, KPI_BUSINESS_SIZE, KPI_DOMINANT_SECTORS):
            out[name] = df.limit(n)
    return out


def silver_quality(spark: SparkSession, silver_root: str) -> DataFrame:
    """nb02-style quality block per dataset: ids, undetermined sectors."""
    parts = []
    for name, df in published(spark, silver_root).items():
        key = "siret" if "siret" in df.columns else "siren"
        parts.append(P.id_quality(df, key).select(F.lit(name).alias("dataset"), "*"))
    return _union(parts)


def bronze_checks(spark: SparkSession, bronze_root: str) -> DataFrame:
    """Per dataset and batch: the audit timestamp and the row count."""
    parts = []
    for name in pq.list_names(spark, bronze_root):
        df = pq.read_if_any(spark, f"{bronze_root.rstrip('/')}/{name}")
        if df is None or "batch_id" not in df.columns:
            continue
        parts.append(
            df.groupBy("batch_id")
            .agg(F.max(INGESTED_AT).alias(INGESTED_AT), F.count(F.lit(1)).alias("rows"))
            .select(F.lit(name).alias("dataset"), "batch_id", INGESTED_AT, "rows")
        )
    if not parts:
        raise pq.MissingInput(f"No Bronze dataset under {bronze_root}")
    return _union(parts).orderBy("dataset", "batch_id")


def bronze_columns(spark: SparkSession, bronze_root: str) -> DataFrame:
    """Per dataset: every column with its type and null percentage."""
    parts = []
    for name in pq.list_names(spark, bronze_root):
        df = pq.read_if_any(spark, f"{bronze_root.rstrip('/')}/{name}")
        if df is not None:
            parts.append(P.expected_columns(df, []).select(F.lit(name).alias("dataset"), "*"))
    if not parts:
        raise pq.MissingInput(f"No Bronze dataset under {bronze_root}")
    return _union(parts)

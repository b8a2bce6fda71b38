"""Gold: denormalised master table and the three KPI tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.operators.joins import left_join_checked
from registrum.spec import DEPARTMENT, MASTER_LEGAL_UNIT_COLUMNS, SECTOR


def master_table(
    etab: DataFrame,
    ul: DataFrame,
    max_broadcast_bytes: int | None = None,
    split_hot_keys: bool = False,
    ul_rows: int | None = None,
    hot_min_rows: int = 0,
    etab_rows: int | None = None,
) -> DataFrame:
    """All establishment columns plus six legal-unit columns, left join on siren.

    Legal units are unique per siren, so the join never fans out. The legal
    unit side is broadcast only after its measured size is under the bound;
    otherwise it is a shuffle join where hot sirens (one legal unit with a
    large share of all establishments) are split off to a bounded broadcast
    join (``split_hot_keys``) or, without it, split by AQE's skew handling.
    """
    right = ul.select("siren", *MASTER_LEGAL_UNIT_COLUMNS)
    joined = left_join_checked(
        etab, right, "siren", max_broadcast_bytes, split_hot_keys, ul_rows, hot_min_rows, etab_rows
    )
    return joined.select(*etab.columns, *MASTER_LEGAL_UNIT_COLUMNS)


SIZE = "categorieEntreprise"
KPI_DIMENSIONS = (DEPARTMENT, SECTOR, SIZE)


def _rows(weight: str | None):
    """Row count, or the sum of a count column of a pre-aggregated input."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def kpi_base(master: DataFrame) -> DataFrame:
    """Row counts per (department, sector, size): all three KPIs derive from
    this small table, so the master is scanned once (three columns)."""
    return master.groupBy(*KPI_DIMENSIONS).agg(F.count(F.lit(1)).alias("n"))


def kpi_by_department(master: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per department, most first (ties by department)."""
    return (
        master.groupBy(DEPARTMENT)
        .agg(_rows(weight).alias("total_establishments"))
        .orderBy(F.desc("total_establishments"), F.asc(DEPARTMENT))
    )


def sector_counts(master: DataFrame, weight: str | None = None) -> DataFrame:
    return master.groupBy(DEPARTMENT, SECTOR).agg(_rows(weight).alias("count"))


def kpi_dominant_sector(master: DataFrame, weight: str | None = None) -> DataFrame:
    """Most frequent sector per department, exactly one row each; a tie goes
    to the first sector by name. The window runs on the (department, sector)
    counts, which are tiny after partial aggregation."""
    w = Window.partitionBy(DEPARTMENT).orderBy(F.desc("count"), F.asc(SECTOR))
    return (
        sector_counts(master, weight)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(DEPARTMENT, SECTOR, "count")
    )


def kpi_company_size(master: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per company size, NULL (unmatched) excluded, most first."""
    return (
        master.filter(F.col(SIZE).isNotNull())
        .groupBy(SIZE)
        .agg(_rows(weight).alias("total"))
        .orderBy(F.desc("total"), F.asc("categorieEntreprise"))
    )


def unmatched(master: DataFrame) -> DataFrame:
    """Join integrity: master rows with neither a denomination nor a name."""
    return master.filter(F.col("denominationUniteLegale").isNull() & F.col("nomUniteLegale").isNull())


def unmatched_count(master: DataFrame) -> DataFrame:
    return unmatched(master).agg(F.count(F.lit(1)).alias("unmatched"))


def kpi_lookup(kpi: DataFrame, department: str) -> DataFrame:
    return kpi.filter(F.col(DEPARTMENT) == F.lit(department))

"""Dataset specifications: columns, keys, fills, rules and contract schemas."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for the same results.
# ---------------------------------------------------------------------------
ESTABLISHMENT_COLUMNS = (
    "siret",
    "siren",
    "etatAdministratifEtablissement",
    "dateCreationEtablissement",
    "codePostalEtablissement",
    "libelleCommuneEtablissement",
    "activitePrincipaleEtablissement",
    "trancheEffectifsEtablissement",
    "etablissementSiege",
    "enseigne1Etablissement",
)
LEGAL_UNIT_COLUMNS = (
    "siren",
    "denominationUniteLegale",
    "nomUniteLegale",
    "prenom1UniteLegale",
    "categorieEntreprise",
    "categorieJuridiqueUniteLegale",
    "activitePrincipaleUniteLegale",
    "etatAdministratifUniteLegale",
    "dateCreationUniteLegale",
    "economieSocialeSolidaireUniteLegale",
)
# Default for NULL, per column (applied only where the column exists).
DEFAULT_FILLS = {
    "etatAdministratifEtablissement": "A",
    "trancheEffectifsEtablissement": "00",
    "enseigne1Etablissement": "Non renseigné",
    "economieSocialeSolidaireUniteLegale": "N",
}
# Remaining NULLs in every string column become this text.
UNKNOWN_TEXT = "Indéterminé"
# Departments of the Ile-de-France region (region filter on establishments).
REGION_DEPARTMENTS = ("75", "77", "78", "91", "92", "93", "94", "95")
# Creation dates outside this closed range become NULL.
DATE_LOWER = "1678-01-01"
DATE_UPPER = "2261-12-31"
# High-water mark when no Silver data exists yet.
MARK_FLOOR = datetime(1900, 1, 1)
# Legal-unit columns carried into the Gold master table, in this order.
MASTER_LEGAL_UNIT_COLUMNS = (
    "denominationUniteLegale",
    "nomUniteLegale",
    "prenom1UniteLegale",
    "categorieEntreprise",
    "categorieJuridiqueUniteLegale",
    "economieSocialeSolidaireUniteLegale",
)
# Engineered column names.
DEPARTMENT = "departement"
SECTOR = "secteur_activite"
AGE = "age_entreprise"
INGESTED_AT = "ingested_at"
# Sample export defaults.
SAMPLE_SEED = 42
SAMPLE_ROWS = 500_000
# Gold table names.
MASTER_TABLE = "master_enriched"
KPI_BY_DEPARTMENT = "kpi_establishments_by_dept"
KPI_DOMINANT_SECTORS = "kpi_dominant_sectors"
KPI_BUSINESS_SIZE = "kpi_business_size"
# ---------------------------------------------------------------------------

BATCH_ID = "batch_id"


@dataclass(frozen=True)
class Rule:
    """Row rule of the Silver contract for one column."""

    column: str
    length: int | None = None
    digits: int | None = None  # exactly this many ASCII digits
    nullable: bool = True
    unique: bool = False


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    pk: str
    id_columns: tuple[str, ...]
    columns: tuple[str, ...]
    date_column: str
    activity_column: str
    postal_column: str | None
    region_filtered: bool
    schema: T.StructType
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    @property
    def selected_columns(self) -> tuple[str, ...]:
        """Configured columns, always with the audit column."""
        if not self.columns:
            raise KeyError(f"dataset {self.name} lists no column to keep")
        if INGESTED_AT in self.columns:
            return self.columns
        return self.columns + (INGESTED_AT,)

    @property
    def silver_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields)


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


S, TS, D, B = T.StringType(), T.TimestampNTZType(), T.DoubleType(), T.BooleanType()

ESTABLISHMENTS = DatasetSpec(
    name="etablissements",
    pk="siret",
    id_columns=("siret", "siren"),
    columns=ESTABLISHMENT_COLUMNS,
    date_column="dateCreationEtablissement",
    activity_column="activitePrincipaleEtablissement",
    postal_column="codePostalEtablissement",
    region_filtered=True,
    schema=_fields(
        [
            ("siret", S),
            ("siren", S),
            ("etatAdministratifEtablissement", S),
            ("dateCreationEtablissement", TS),
            ("codePostalEtablissement", S),
            ("libelleCommuneEtablissement", S),
            ("activitePrincipaleEtablissement", S),
            ("trancheEffectifsEtablissement", S),
            ("etablissementSiege", B),
            ("enseigne1Etablissement", S),
            (INGESTED_AT, TS),
            (DEPARTMENT, S),
            (SECTOR, S),
            (AGE, D),
        ]
    ),
    rules=(
        Rule("siret", length=14, digits=14, nullable=False, unique=True),
        Rule("siren", length=9, digits=9, nullable=False),
        Rule("codePostalEtablissement", length=5, digits=5, nullable=True),
    ),
)

LEGAL_UNITS = DatasetSpec(
    name="unites_legales",
    pk="siren",
    id_columns=("siren",),
    columns=LEGAL_UNIT_COLUMNS,
    date_column="dateCreationUniteLegale",
    activity_column="activitePrincipaleUniteLegale",
    postal_column=None,
    region_filtered=False,
    schema=_fields(
        [
            ("siren", S),
            ("denominationUniteLegale", S),
            ("nomUniteLegale", S),
            ("prenom1UniteLegale", S),
            ("categorieEntreprise", S),
            ("categorieJuridiqueUniteLegale", D),
            ("activitePrincipaleUniteLegale", S),
            ("etatAdministratifUniteLegale", S),
            ("dateCreationUniteLegale", TS),
            ("economieSocialeSolidaireUniteLegale", S),
            (INGESTED_AT, TS),
            (SECTOR, S),
            (AGE, D),
        ]
    ),
    rules=(Rule("siren", length=9, digits=9, nullable=False, unique=True),),
)

SPECS = {s.name: s for s in (ESTABLISHMENTS, LEGAL_UNITS)}


def spec_for(dataset_name: str) -> DatasetSpec:
    """Spec by dataset name; an unknown name is a ValueError."""
    try:
        return SPECS[dataset_name]
    except KeyError:
        raise ValueError(f"unknown dataset {dataset_name!r}; known: {sorted(SPECS)}") from None


def bronze_pk(dataset_name: str) -> str:
    """Registry key: siret for establishment datasets, siren otherwise."""
    return "siret" if "etablissement" in dataset_name.lower() else "siren"

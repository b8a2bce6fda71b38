"""DuckDB SQL equivalents of the catalogue queries (independent re-statement
of the same semantics over the same tables, used as the correctness oracle)."""

from __future__ import annotations

from registrum.operators.clean import batch_id_of
from registrum.plans.catalog import BATCH_1, RUN_TS

RUN_BID = batch_id_of(RUN_TS)
REGION = "('75', '77', '78', '91', '92', '93', '94', '95')"
U = "'Indéterminé'"

ETAB_RAW = """
etab_raw AS (
  SELECT
    lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS siret,
    lpad(CAST(CASE WHEN o_custkey % 19 = 0 THEN o_custkey + 900000000 ELSE o_custkey END AS VARCHAR), 9, '0') AS siren,
    nullif(o_orderstatus, 'P') AS etatAdministratifEtablissement,
    make_date(CAST(1650 + o_orderkey % 640 AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1)
      AS dateCreationEtablissement,
    CASE WHEN o_orderkey % 53 = 0 THEN substring(b, 1, 2) || 'x' || substring(b, 4, 2)
         WHEN o_orderkey % 59 = 0 THEN NULL
         WHEN o_orderkey % 61 = 0 THEN b || ' '
         ELSE b END AS codePostalEtablissement,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL
         ELSE 'COMMUNE ' || CAST(o_custkey % 1000 AS VARCHAR) END AS libelleCommuneEtablissement,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL
         ELSE lpad(CAST((o_orderkey * 31) % 97 AS VARCHAR), 2, '0') || '.1' || substring(o_orderpriority, 1, 1)
    END AS activitePrincipaleEtablissement,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         ELSE lpad(CAST(o_orderkey % 54 AS VARCHAR), 2, '0') END AS trancheEffectifsEtablissement,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS etablissementSiege,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
         ELSE 'ENS' || CAST(o_orderkey % 100 AS VARCHAR) END AS enseigne1Etablissement,
    CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2026-01-01 00:00:00'
         ELSE TIMESTAMP '2026-02-01 00:00:00' END AS ingested_at
  FROM (SELECT *, CAST(71 + o_custkey % 25 AS VARCHAR) || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS b
        FROM orders)
)"""

UL_RAW = """
ul_raw AS (
  SELECT
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS siren,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS denominationUniteLegale,
    CASE WHEN c_custkey % 17 = 0 THEN 'NOM' || CAST(c_custkey AS VARCHAR) END AS nomUniteLegale,
    CASE WHEN c_custkey % 34 = 0 THEN 'Alex' END AS prenom1UniteLegale,
    CASE WHEN c_custkey % 7 <= 2 THEN 'PME' WHEN c_custkey % 7 = 3 THEN 'ETI'
         WHEN c_custkey % 7 = 4 THEN 'GE' END AS categorieEntreprise,
    CAST(5499 + c_custkey % 300 AS DOUBLE) AS categorieJuridiqueUniteLegale,
    CASE WHEN c_custkey % 43 = 0 THEN NULL
         ELSE lpad(CAST((c_custkey * 13) % 97 AS VARCHAR), 2, '0') || '.2Z' END AS activitePrincipaleUniteLegale,
    CASE WHEN c_custkey % 11 = 0 THEN 'C' ELSE 'A' END AS etatAdministratifUniteLegale,
    make_date(CAST(1900 + c_custkey % 125 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER), 1)
      AS dateCreationUniteLegale,
    CASE WHEN c_custkey % 3 = 1 THEN 'O' WHEN c_custkey % 3 = 2 THEN 'N' END
      AS economieSocialeSolidaireUniteLegale,
    TIMESTAMP '2026-01-01 00:00:00' AS ingested_at
  FROM customer
)"""


def clamp(c: str) -> str:
    return f"CASE WHEN {c} < DATE '1678-01-01' THEN NULL WHEN {c} > DATE '2261-12-31' THEN NULL ELSE {c} END"


def etab_silver_from(source: str, name: str, mark: str, region: bool = True) -> str:
    """Silver establishments computed from a Bronze-shaped CTE ``source``."""
    where = f"ingested_at > TIMESTAMP '{mark}'"
    if region:
        where += f" AND substring(codePostalEtablissement, 1, 2) IN {REGION}"
    return f"""
{name}_inc AS (
  SELECT siret, siren, etatAdministratifEtablissement,
         {clamp('dateCreationEtablissement')} AS dateCreationEtablissement,
         regexp_replace(codePostalEtablissement, '^\\s+|\\s+$', '', 'g') AS codePostalEtablissement,
         libelleCommuneEtablissement, activitePrincipaleEtablissement, trancheEffectifsEtablissement,
         etablissementSiege, enseigne1Etablissement, ingested_at
  FROM {source}
  WHERE {where} AND siret IS NOT NULL AND siren IS NOT NULL
),
{name} AS (
  SELECT siret, siren,
    coalesce(etatAdministratifEtablissement, 'A') AS etatAdministratifEtablissement,
    CAST(dateCreationEtablissement AS TIMESTAMP) AS dateCreationEtablissement,
    codePostalEtablissement,
    coalesce(libelleCommuneEtablissement, {U}) AS libelleCommuneEtablissement,
    coalesce(activitePrincipaleEtablissement, {U}) AS activitePrincipaleEtablissement,
    coalesce(trancheEffectifsEtablissement, '00') AS trancheEffectifsEtablissement,
    etablissementSiege,
    coalesce(enseigne1Etablissement, 'Non renseigné') AS enseigne1Etablissement,
    ingested_at,
    coalesce(substring(codePostalEtablissement, 1, 2), {U}) AS departement,
    coalesce(substring(activitePrincipaleEtablissement, 1, 2), {U}) AS secteur_activite,
    coalesce(CAST(2026 - year(dateCreationEtablissement) AS DOUBLE), -1.0) AS age_entreprise
  FROM {name}_inc
  WHERE regexp_full_match(codePostalEtablissement, '[0-9]{{5}}')
)"""


UL_SILVER = f"""
ul_silver AS (
  SELECT siren,
    coalesce(denominationUniteLegale, {U}) AS denominationUniteLegale,
    coalesce(nomUniteLegale, {U}) AS nomUniteLegale,
    coalesce(prenom1UniteLegale, {U}) AS prenom1UniteLegale,
    coalesce(categorieEntreprise, {U}) AS categorieEntreprise,
    categorieJuridiqueUniteLegale,
    coalesce(activitePrincipaleUniteLegale, {U}) AS activitePrincipaleUniteLegale,
    coalesce(etatAdministratifUniteLegale, {U}) AS etatAdministratifUniteLegale,
    CAST({clamp('dateCreationUniteLegale')} AS TIMESTAMP) AS dateCreationUniteLegale,
    coalesce(economieSocialeSolidaireUniteLegale, 'N') AS economieSocialeSolidaireUniteLegale,
    ingested_at,
    coalesce(substring(activitePrincipaleUniteLegale, 1, 2), {U}) AS secteur_activite,
    coalesce(CAST(2026 - year({clamp('dateCreationUniteLegale')}) AS DOUBLE), -1.0) AS age_entreprise
  FROM ul_raw
  WHERE ingested_at > TIMESTAMP '1900-01-01' AND siren IS NOT NULL
)"""

MASTER = """
master AS (
  SELECT e.*, u.denominationUniteLegale, u.nomUniteLegale, u.prenom1UniteLegale, u.categorieEntreprise,
         u.categorieJuridiqueUniteLegale, u.economieSocialeSolidaireUniteLegale
  FROM etab_silver e LEFT JOIN ul_silver u ON e.siren = u.siren
)"""

ETAB_STOCK_COLS = (
    "siret, siren, etatAdministratifEtablissement, dateCreationEtablissement, codePostalEtablissement, "
    "libelleCommuneEtablissement, activitePrincipaleEtablissement, trancheEffectifsEtablissement, "
    "etablissementSiege, enseigne1Etablissement"
)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_ctes(ETAB_RAW, UL_RAW, etab_silver_from("etab_raw", "etab_silver", "1900-01-01"), UL_SILVER, MASTER)
RAW = with_ctes(ETAB_RAW)
ETAB_SILVER = with_ctes(ETAB_RAW, etab_silver_from("etab_raw", "etab_silver", "1900-01-01"))
UL_ONLY = with_ctes(UL_RAW, UL_SILVER)
AUDIT = f"TIMESTAMP '2026-03-01 00:00:00' AS ingested_at, CAST({RUN_BID} AS BIGINT) AS batch_id"

SILVER_COLS = [
    "siret", "siren", "etatAdministratifEtablissement", "dateCreationEtablissement", "codePostalEtablissement",
    "libelleCommuneEtablissement", "activitePrincipaleEtablissement", "trancheEffectifsEtablissement",
    "etablissementSiege", "enseigne1Etablissement", "ingested_at", "departement", "secteur_activite",
    "age_entreprise",
]
UL_COLS = [
    "siren", "denominationUniteLegale", "nomUniteLegale", "prenom1UniteLegale", "categorieEntreprise",
    "categorieJuridiqueUniteLegale", "activitePrincipaleUniteLegale", "etatAdministratifUniteLegale",
    "dateCreationUniteLegale", "economieSocialeSolidaireUniteLegale", "ingested_at", "secteur_activite",
    "age_entreprise",
]


MASTER_MORE = [
    "denominationUniteLegale", "nomUniteLegale", "prenom1UniteLegale", "categorieEntreprise",
    "categorieJuridiqueUniteLegale", "economieSocialeSolidaireUniteLegale",
]


def _profile_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, "
            f"round(100.0 * (count(*) - count({c})) / greatest(count(*), 1), 2) AS null_percentage, "
            f"count(DISTINCT {c}) AS unique_count, CAST(min({c}) AS VARCHAR) AS min, "
            f"CAST(max({c}) AS VARCHAR) AS max FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


REDELIVERY = """
redelivered AS (
  SELECT * FROM etab_raw
  UNION ALL
  SELECT siret, siren, etatAdministratifEtablissement, dateCreationEtablissement, codePostalEtablissement,
         libelleCommuneEtablissement, activitePrincipaleEtablissement, trancheEffectifsEtablissement,
         etablissementSiege, 'REDELIVERED' AS enseigne1Etablissement, TIMESTAMP '2026-03-01 00:00:00' AS ingested_at
  FROM etab_raw WHERE CAST(siret AS BIGINT) % 4 = 0
),
batch1 AS (SELECT * FROM redelivered WHERE ingested_at <= TIMESTAMP '2026-01-01 00:00:00')"""

SILVER_LIST = ", ".join(SILVER_COLS)

# Creation dates as text, parsed leniently before they are clamped.
TEXT_DATES = """
etab_text AS (
  SELECT * REPLACE (TRY_CAST(CASE WHEN k % 13 = 0 THEN 'not-a-date' WHEN k % 17 = 0 THEN '2020-13-01'
      WHEN k % 19 = 0 THEN '1678-01-01' WHEN k % 23 = 0 THEN '1677-12-31' WHEN k % 29 = 0 THEN '2261-12-31'
      WHEN k % 31 = 0 THEN '2262-01-01' ELSE CAST(dateCreationEtablissement AS VARCHAR) END AS DATE)
    AS dateCreationEtablissement)
  FROM (SELECT *, CAST(siret AS BIGINT) AS k FROM etab_raw)
)"""

REST = [c for c in ETAB_STOCK_COLS.split(", ") if c != "siret"]
# NULL keys, and every fourth key again without its commune.
REPEATED = f"""
keyed AS (
  SELECT CASE WHEN CAST(siret AS BIGINT) % 23 = 0 THEN NULL ELSE siret END AS siret, {", ".join(REST)} FROM etab_raw
),
repeated AS (
  SELECT * FROM keyed
  UNION ALL
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS libelleCommuneEtablissement) FROM keyed WHERE CAST(siret AS BIGINT) % 4 = 0
)"""
TYPES = {"etablissementSiege": "boolean", "dateCreationEtablissement": "timestamp_ntz", "ingested_at": "timestamp_ntz",
         "age_entreprise": "double"}


def _top_sql(table: str, dataset: str, column: str) -> str:
    return (
        f"SELECT * FROM (SELECT '{dataset}' AS dataset, '{column}' AS column_name, {column} AS value, count(*) AS count, "
        f"round(count(*) * 100.0 / (SELECT count(*) FROM {table}), 1) AS pct "
        f"FROM {table} GROUP BY {column} ORDER BY count DESC, {column} LIMIT 5)"
    )


def _age_sql(table: str) -> str:
    return (
        "min(age_entreprise) AS min_age, round(avg(age_entreprise), 1) AS avg_age, max(age_entreprise) AS max_age, "
        f"median(age_entreprise) AS median_age FROM {table} WHERE age_entreprise >= 0"
    )


def _csv_text(column: str) -> str:
    if column in ("dateCreationEtablissement", "ingested_at"):
        return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%g') AS {column}"
    return f"nullif(CAST({column} AS VARCHAR), '') AS {column}"

SQL: dict[str, str] = {
    "q01_bronze_scan_audit": RAW + f"SELECT {ETAB_STOCK_COLS}, {AUDIT} FROM etab_raw",
    "q02_select_columns": RAW + f"SELECT {ETAB_STOCK_COLS}, TIMESTAMP '2026-03-01 00:00:00' AS ingested_at FROM etab_raw",
    "q03_clamp_dates": RAW
    + f"SELECT siret, {clamp('dateCreationEtablissement')} AS dateCreationEtablissement FROM etab_raw",
    "q04_lenient_timestamp": RAW
    + """SELECT siret, TRY_CAST(CASE WHEN CAST(siret AS BIGINT) % 13 = 0 THEN 'not-a-date'
                        WHEN CAST(siret AS BIGINT) % 17 = 0 THEN '2020-13-01'
                        ELSE CAST(dateCreationEtablissement AS VARCHAR) END AS TIMESTAMP) AS dateCreationEtablissement
       FROM etab_raw""",
    "q04c_date_spellings": RAW
    + """SELECT siret, CASE WHEN CAST(siret AS BIGINT) % 13 = 0 OR CAST(siret AS BIGINT) % 17 = 0 THEN NULL
                        WHEN CAST(siret AS BIGINT) % 5 = 1 THEN try_strptime(strftime(dateCreationEtablissement, '%d/%m/%Y'), '%d/%m/%Y')
                        WHEN CAST(siret AS BIGINT) % 5 = 2 THEN try_strptime(strftime(dateCreationEtablissement, '%Y%m%d'), '%Y%m%d')
                        WHEN CAST(siret AS BIGINT) % 5 = 3 THEN try_strptime(strftime(dateCreationEtablissement, '%Y/%m/%d'), '%Y/%m/%d')
                        WHEN CAST(siret AS BIGINT) % 5 = 4 THEN try_strptime(strftime(dateCreationEtablissement, '%d.%m.%Y') || ' 06:07:08', '%d.%m.%Y %H:%M:%S')
                        ELSE CAST(dateCreationEtablissement AS TIMESTAMP) END AS dateCreationEtablissement
       FROM etab_raw""",
    "q04b_text_dates_to_silver": with_ctes(ETAB_RAW, TEXT_DATES, etab_silver_from("etab_text", "etab_silver", "1900-01-01"))
    + f"SELECT {SILVER_LIST} FROM etab_silver",
    "q05_default_fills": RAW
    + """SELECT siret, coalesce(etatAdministratifEtablissement, 'A') AS etatAdministratifEtablissement,
              coalesce(trancheEffectifsEtablissement, '00') AS trancheEffectifsEtablissement,
              coalesce(enseigne1Etablissement, 'Non renseigné') AS enseigne1Etablissement FROM etab_raw""",
    "q06_string_fill": RAW
    + f"""SELECT coalesce(siret, {U}) AS siret, coalesce(siren, {U}) AS siren,
              coalesce(etatAdministratifEtablissement, {U}) AS etatAdministratifEtablissement,
              dateCreationEtablissement,
              coalesce(codePostalEtablissement, {U}) AS codePostalEtablissement,
              coalesce(libelleCommuneEtablissement, {U}) AS libelleCommuneEtablissement,
              coalesce(activitePrincipaleEtablissement, {U}) AS activitePrincipaleEtablissement,
              coalesce(trancheEffectifsEtablissement, {U}) AS trancheEffectifsEtablissement,
              etablissementSiege,
              coalesce(enseigne1Etablissement, {U}) AS enseigne1Etablissement, ingested_at FROM etab_raw""",
    "q07_engineered": ETAB_SILVER + "SELECT siret, departement, secteur_activite, age_entreprise FROM etab_silver",
    "q09_anti_join_new_rows": RAW
    + f"""SELECT {ETAB_STOCK_COLS}, {AUDIT} FROM etab_raw s
       WHERE s.siret IS NOT NULL AND NOT EXISTS (
         SELECT 1 FROM etab_raw t WHERE t.ingested_at = TIMESTAMP '2026-01-01 00:00:00' AND t.siret = s.siret)""",
    "q09b_repeated_and_null_keys": with_ctes(ETAB_RAW, REPEATED)
    + f"""SELECT {ETAB_STOCK_COLS}, {AUDIT} FROM (
         SELECT *, row_number() OVER (PARTITION BY siret ORDER BY {", ".join(f"{c} NULLS LAST" for c in REST)}) AS rn
         FROM repeated WHERE siret IS NOT NULL) WHERE rn = 1
       UNION ALL SELECT {ETAB_STOCK_COLS}, {AUDIT} FROM repeated WHERE siret IS NULL""",
    "q10_idempotent_union": RAW
    + f"""SELECT {ETAB_STOCK_COLS}, TIMESTAMP '2026-01-01 00:00:00' AS ingested_at,
              CAST({batch_id_of(BATCH_1)} AS BIGINT) AS batch_id
       FROM etab_raw WHERE siret IS NOT NULL""",
    "q11_increment_filter": RAW
    + f"""SELECT siret, siren, etatAdministratifEtablissement,
              {clamp('dateCreationEtablissement')} AS dateCreationEtablissement, codePostalEtablissement,
              libelleCommuneEtablissement, activitePrincipaleEtablissement, trancheEffectifsEtablissement,
              etablissementSiege, enseigne1Etablissement, ingested_at
       FROM etab_raw WHERE ingested_at > TIMESTAMP '2026-01-01 00:00:00'""",
    "q12_region_filter": RAW
    + f"""SELECT siret, siren, etatAdministratifEtablissement,
              {clamp('dateCreationEtablissement')} AS dateCreationEtablissement, codePostalEtablissement,
              libelleCommuneEtablissement, activitePrincipaleEtablissement, trancheEffectifsEtablissement,
              etablissementSiege, enseigne1Etablissement, ingested_at
       FROM etab_raw WHERE ingested_at > TIMESTAMP '1900-01-01 00:00:00'
         AND substring(codePostalEtablissement, 1, 2) IN {REGION}""",
    "q13_drop_null_keys": RAW
    + """SELECT * FROM (
         SELECT CASE WHEN CAST(siret AS BIGINT) % 23 = 0 THEN NULL ELSE siret END AS siret,
                CASE WHEN CAST(siret AS BIGINT) % 31 = 0 THEN NULL ELSE siren END AS siren,
                etatAdministratifEtablissement, dateCreationEtablissement, codePostalEtablissement,
                libelleCommuneEtablissement, activitePrincipaleEtablissement, trancheEffectifsEtablissement,
                etablissementSiege, enseigne1Etablissement, ingested_at FROM etab_raw)
       WHERE siret IS NOT NULL AND siren IS NOT NULL""",
    "q14_postal_clean": RAW
    + """SELECT count(*) AS rows_in,
              CAST(count_if(coalesce(regexp_full_match(regexp_replace(codePostalEtablissement, '^\\s+|\\s+$', '', 'g'), '[0-9]{5}'), false)) AS BIGINT) AS valid,
              CAST(count_if(NOT coalesce(regexp_full_match(regexp_replace(codePostalEtablissement, '^\\s+|\\s+$', '', 'g'), '[0-9]{5}'), false)) AS BIGINT) AS rejected
       FROM etab_raw WHERE siret IS NOT NULL AND siren IS NOT NULL""",
    "q15_high_water_mark": RAW
    + "SELECT coalesce(max(ingested_at), TIMESTAMP '1900-01-01 00:00:00') AS mark FROM etab_raw",
    "q16_capped_increment": RAW
    + f"""SELECT {ETAB_STOCK_COLS} FROM etab_raw s
       WHERE s.siret IS NOT NULL AND NOT EXISTS (
         SELECT 1 FROM etab_raw t WHERE t.ingested_at = TIMESTAMP '2026-01-01 00:00:00' AND t.siret = s.siret)
       ORDER BY md5('42|' || siret), siret LIMIT 500""",
    "q16b_cap_with_null_and_repeated_keys": with_ctes(ETAB_RAW, REPEATED)
    + "SELECT siret FROM repeated ORDER BY md5('42|' || coalesce(siret, '')), siret IS NULL, siret LIMIT 500",
    "q16c_cap_above_input": with_ctes(ETAB_RAW, REPEATED) + "SELECT siret, siren, codePostalEtablissement FROM repeated",
    "q17_silver_merge": with_ctes(
        ETAB_RAW,
        REDELIVERY,
        etab_silver_from("batch1", "old_silver", "1900-01-01"),
        etab_silver_from("redelivered", "new_silver", "2026-01-01 00:00:00"),
    )
    + f"""SELECT {SILVER_LIST} FROM (
         SELECT *, row_number() OVER (PARTITION BY siret, siren ORDER BY ingested_at DESC, src DESC) AS rn
         FROM (SELECT *, 0 AS src FROM old_silver UNION ALL SELECT *, 1 AS src FROM new_silver)
       ) WHERE rn = 1""",
    "q17b_lineitem_last_wins": """
       SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus, l_shipdate FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
           l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
           l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
           l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
         FROM lineitem) WHERE rn = 1""",
    "q18_rule_violations": RAW
    + """, bad AS (
         SELECT CASE WHEN CAST(siret AS BIGINT) % 101 = 0 THEN 'X' || substring(siret, 2, 13) ELSE siret END AS siret,
                CASE WHEN CAST(siret AS BIGINT) % 103 = 0 THEN substring(siren, 1, 8) ELSE siren END AS siren,
                codePostalEtablissement AS cp
         FROM etab_raw)
       SELECT 'dateCreationEtablissement:coerce' AS rule, CAST(0 AS BIGINT) AS violations
       UNION ALL SELECT 'etablissementSiege:coerce', CAST(count_if(CAST(siret AS BIGINT) % 107 = 0) AS BIGINT) FROM etab_raw
       UNION ALL SELECT 'ingested_at:coerce', CAST(count_if(CAST(siret AS BIGINT) % 109 = 0) AS BIGINT) FROM etab_raw
       UNION ALL SELECT 'siret:not_null', CAST(count_if(siret IS NULL) AS BIGINT) FROM bad
       UNION ALL SELECT 'siret:str_length', CAST(count_if(siret IS NOT NULL AND length(siret) <> 14) AS BIGINT) FROM bad
       UNION ALL SELECT 'siret:str_matches', CAST(count_if(siret IS NOT NULL AND NOT regexp_full_match(siret, '[0-9]{14}')) AS BIGINT) FROM bad
       UNION ALL SELECT 'siren:not_null', CAST(count_if(siren IS NULL) AS BIGINT) FROM bad
       UNION ALL SELECT 'siren:str_length', CAST(count_if(siren IS NOT NULL AND length(siren) <> 9) AS BIGINT) FROM bad
       UNION ALL SELECT 'siren:str_matches', CAST(count_if(siren IS NOT NULL AND NOT regexp_full_match(siren, '[0-9]{9}')) AS BIGINT) FROM bad
       UNION ALL SELECT 'codePostalEtablissement:str_length', CAST(count_if(cp IS NOT NULL AND length(cp) <> 5) AS BIGINT) FROM bad
       UNION ALL SELECT 'codePostalEtablissement:str_matches', CAST(count_if(cp IS NOT NULL AND NOT regexp_full_match(cp, '[0-9]{5}')) AS BIGINT) FROM bad""",
    "q18b_rule_violations_legal_units": with_ctes(UL_RAW)
    + """SELECT 'categorieJuridiqueUniteLegale:coerce' AS rule,
              CAST(count_if(CAST(siren AS BIGINT) % 9 = 0) AS BIGINT) AS violations FROM ul_raw
       UNION ALL SELECT 'dateCreationUniteLegale:coerce', CAST(0 AS BIGINT)
       UNION ALL SELECT 'siren:not_null', CAST(count_if(siren IS NULL) AS BIGINT) FROM ul_raw
       UNION ALL SELECT 'siren:str_length', CAST(count_if(length(siren) <> 9) AS BIGINT) FROM ul_raw
       UNION ALL SELECT 'siren:str_matches', CAST(count_if(NOT regexp_full_match(siren, '[0-9]{9}')) AS BIGINT) FROM ul_raw""",
    "q19_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "q20_master": BASE + "SELECT * FROM master",
    "q20b_master_hot_key_split": BASE + "SELECT * FROM master",
    "q21_kpi_by_department": BASE
    + """SELECT departement, count(*) AS total_establishments FROM master GROUP BY departement
       ORDER BY total_establishments DESC, departement""",
    "q22_kpi_dominant_sector": BASE
    + """, sector_counts AS (SELECT departement, secteur_activite, count(*) AS count FROM master GROUP BY ALL)
       SELECT departement, secteur_activite, count FROM sector_counts
       QUALIFY row_number() OVER (PARTITION BY departement ORDER BY count DESC, secteur_activite) = 1""",
    "q23_kpi_company_size": BASE
    + """SELECT categorieEntreprise, count(*) AS total FROM master WHERE categorieEntreprise IS NOT NULL
       GROUP BY categorieEntreprise ORDER BY total DESC, categorieEntreprise""",
    "q23b_kpis_from_one_scan": BASE
    + """, sector_counts AS (SELECT departement, secteur_activite, count(*) AS count FROM master GROUP BY ALL)
       SELECT 'by_department' AS kpi, departement AS k1, CAST(NULL AS VARCHAR) AS k2, count(*) AS value
       FROM master GROUP BY departement
       UNION ALL
       SELECT 'dominant_sector', departement, secteur_activite, count FROM sector_counts
       QUALIFY row_number() OVER (PARTITION BY departement ORDER BY count DESC, secteur_activite) = 1
       UNION ALL
       SELECT 'company_size', categorieEntreprise, CAST(NULL AS VARCHAR), count(*) FROM master
       WHERE categorieEntreprise IS NOT NULL GROUP BY categorieEntreprise""",
    "q24_join_integrity": BASE
    + "SELECT count(*) AS unmatched FROM master WHERE denominationUniteLegale IS NULL AND nomUniteLegale IS NULL",
    "q25_kpi_lookup": BASE
    + """SELECT * FROM (SELECT departement, count(*) AS total_establishments FROM master GROUP BY departement)
       WHERE departement = '75'""",
    "q26_region_share": ETAB_SILVER
    + """SELECT substring(codePostalEtablissement, 1, 2) AS dept, count(*) AS count,
              round(count(*) * 100.0 / (SELECT count(*) FROM etab_silver), 2) AS percentage
       FROM etab_silver GROUP BY dept ORDER BY dept""",
    "q27_top_five_distribution": ETAB_SILVER
    + """SELECT secteur_activite, count(*) AS count,
              round(count(*) * 100.0 / (SELECT count(*) FROM etab_silver), 1) AS pct
       FROM etab_silver GROUP BY 1 ORDER BY count DESC, secteur_activite LIMIT 5""",
    "q27b_distributions": BASE
    + " UNION ALL ".join(
        _top_sql(t, d, c)
        for t, d, cols in (
            ("etab_silver", "etablissements", ("departement", "secteur_activite", "etatAdministratifEtablissement")),
            ("ul_silver", "unites_legales", ("secteur_activite", "economieSocialeSolidaireUniteLegale")),
        )
        for c in cols
    ),
    "q28b_age_profile_approx": ETAB_SILVER
    + """SELECT min(age_entreprise) AS min_age, round(avg(age_entreprise), 1) AS avg_age,
              max(age_entreprise) AS max_age, true AS within_tolerance
       FROM etab_silver WHERE age_entreprise >= 0""",
    "q28c_age_profiles": BASE
    + f"SELECT 'etablissements' AS dataset, {_age_sql('etab_silver')} UNION ALL SELECT 'unites_legales', {_age_sql('ul_silver')}",
    "q28_age_profile": ETAB_SILVER
    + """SELECT min(age_entreprise) AS min_age, round(avg(age_entreprise), 1) AS avg_age,
              max(age_entreprise) AS max_age, median(age_entreprise) AS median_age
       FROM etab_silver WHERE age_entreprise >= 0""",
    "q29_row_counts": BASE
    + """SELECT 'bronze_etablissements' AS "table", count(*) AS rows FROM etab_raw
       UNION ALL SELECT 'bronze_unites_legales', count(*) FROM ul_raw
       UNION ALL SELECT 'silver_etablissements', count(*) FROM etab_silver
       UNION ALL SELECT 'silver_unites_legales', count(*) FROM ul_silver
       UNION ALL SELECT 'gold_master', count(*) FROM master
       UNION ALL SELECT 'kpi_by_department', count(DISTINCT departement) FROM master
       UNION ALL SELECT 'kpi_dominant_sectors', count(DISTINCT departement) FROM master
       UNION ALL SELECT 'kpi_business_size', count(DISTINCT categorieEntreprise) FROM master""",
    "q30_id_quality": ETAB_SILVER
    + f"""SELECT count(*) AS total_rows, count(DISTINCT siret) AS unique_ids, count(*) - count(siret) AS missing_ids,
              round(avg(CASE WHEN secteur_activite = {U} THEN 1 ELSE 0 END) * 100, 2) AS pct_indeterminate_sector,
              round(avg(CASE WHEN secteur_activite = 'In' THEN 1 ELSE 0 END) * 100, 2) AS pct_in_sector,
              count(*) = count(DISTINCT siret) AS is_unique
       FROM etab_silver""",
    "q30b_id_quality_legal_units": UL_ONLY
    + f"""SELECT count(*) AS total_rows, count(DISTINCT siren) AS unique_ids, count(*) - count(siren) AS missing_ids,
              round(avg(CASE WHEN secteur_activite = {U} THEN 1 ELSE 0 END) * 100, 2) AS pct_indeterminate_sector,
              round(avg(CASE WHEN secteur_activite = 'In' THEN 1 ELSE 0 END) * 100, 2) AS pct_in_sector,
              count(*) = count(DISTINCT siren) AS is_unique
       FROM ul_silver""",
    "q31_load_span": ETAB_SILVER
    + """SELECT min(ingested_at) AS first_load, max(ingested_at) AS last_load,
              count(DISTINCT ingested_at) AS batches FROM etab_silver""",
    "q32_mean_positive_age": ETAB_SILVER
    + "SELECT avg(age_entreprise) AS avg_age FROM etab_silver WHERE age_entreprise > 0",
    "q33_table_profile": ETAB_SILVER + _profile_sql("etab_silver", SILVER_COLS),
    "q33b_table_profile_legal_units": UL_ONLY + _profile_sql("ul_silver", UL_COLS),
    "q33c_table_profile_approx": ETAB_SILVER
    + f"SELECT column_name, null_percentage, min, max, true AS within_tolerance FROM ({_profile_sql('etab_silver', SILVER_COLS)})",
    "q33d_profile_from_sketches": ETAB_SILVER
    + f"SELECT column_name, null_percentage, min, max, true AS within_tolerance FROM ({_profile_sql('etab_silver', SILVER_COLS)})",
    "q35_describe": ETAB_SILVER
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{TYPES.get(c, 'string')}' AS data_type, true AS present, "
        f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS null_pct FROM etab_silver"
        for c in SILVER_COLS
    ),
    "q34_top_three_departments": ETAB_SILVER
    + """SELECT departement, count(*) AS count FROM etab_silver WHERE departement IS NOT NULL
       GROUP BY departement ORDER BY count DESC, departement LIMIT 3""",
    "q36_view_query": BASE
    + """SELECT departement, count(*) AS total_establishments FROM master GROUP BY departement
       ORDER BY total_establishments DESC, departement""",
    "q37_hash_sample": BASE + "SELECT * FROM master ORDER BY md5('42|' || siret), siret LIMIT 500",
    "q38_preview": BASE
    + """SELECT siret, denominationUniteLegale, departement, age_entreprise FROM master
       ORDER BY siret LIMIT 3""",
    "q39_csv_roundtrip": BASE
    + "SELECT " + ", ".join(_csv_text(c) for c in [*SILVER_COLS, *MASTER_MORE])
    + " FROM (SELECT * FROM master ORDER BY md5('42|' || siret), siret LIMIT 500)",
    "q40_ul_engineered": UL_ONLY
    + "SELECT siren, secteur_activite, age_entreprise, economieSocialeSolidaireUniteLegale FROM ul_silver",
    "q41_clean_increment_counts": ETAB_SILVER
    + f"""SELECT count(*) AS rows, CAST(count_if(dateCreationEtablissement IS NULL) AS BIGINT) AS null_dates,
              CAST(count_if(secteur_activite = {U}) AS BIGINT) AS undetermined_sectors,
              CAST(count_if(NOT regexp_full_match(codePostalEtablissement, '[0-9]{{5}}')) AS BIGINT) AS bad_postal
       FROM etab_silver""",
}

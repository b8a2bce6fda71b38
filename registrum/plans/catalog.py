"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver tables shaped by ``registrum.sources.testdata``: orders
become the establishment stock, customer the legal-unit stock, lineitem the
dedup fixture. Each query runs the library's own operators over whole tables;
``registrum.plans.oracle`` holds the equivalent DuckDB SQL under the same key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.functions.columns import clamp_date, exact_digits, lenient_timestamp, ntz
from registrum.operators import gold as G
from registrum.operators import profile as P
from registrum.operators.clean import (
    clean_increment,
    date_spellings,
    drop_null_keys,
    fill_defaults,
    fill_strings,
    postal_audit,
    select_increment,
    silver_increment,
)
from registrum.operators.ingest import new_rows, with_audit
from registrum.operators.joins import DEFAULT_BROADCAST_BYTES
from registrum.operators.merge import keep_last, mark_column, merge_last_wins
from registrum.operators.quality import coerce, duplicate_keys, rule_violations
from registrum.operators.sample import first_n, hash_sample
from registrum.plans.reports import DISTRIBUTIONS
from registrum.session import ensure_checkpoint_dir
from registrum.sources import testdata as td
from registrum.spec import (
    ESTABLISHMENTS,
    LEGAL_UNITS,
    MARK_FLOOR,
    REGION_DEPARTMENTS,
    SAMPLE_SEED,
    UNKNOWN_TEXT,
)

# Fixed parameters of the catalogue.
AS_OF_YEAR = 2026
RUN_TS = datetime(2026, 3, 1)
BATCH_1 = datetime(2026, 1, 1)
REDELIVERY_TS = datetime(2026, 3, 1)
CAP_ROWS = 500
SAMPLE_N = 500
LINEITEM_KEYS = ("l_orderkey", "l_linenumber")


# --- shared chains ---------------------------------------------------------
def etab_raw(spark: SparkSession, sf: str) -> DataFrame:
    return td.establishments(spark, sf)


def etab_stock(spark: SparkSession, sf: str) -> DataFrame:
    """The establishment source file (no audit column)."""
    return etab_raw(spark, sf).drop("ingested_at")


def ul_raw(spark: SparkSession, sf: str) -> DataFrame:
    return td.legal_units(spark, sf)


def etab_silver(spark: SparkSession, sf: str) -> DataFrame:
    new = silver_increment(etab_raw(spark, sf), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS, AS_OF_YEAR)
    return merge_last_wins(None, new, ESTABLISHMENTS)


def ul_silver(spark: SparkSession, sf: str) -> DataFrame:
    new = silver_increment(ul_raw(spark, sf), LEGAL_UNITS, MARK_FLOOR, (), AS_OF_YEAR)
    return merge_last_wins(None, new, LEGAL_UNITS)


def master(spark: SparkSession, sf: str) -> DataFrame:
    """As the Gold job builds it: the legal-unit side is broadcast only after
    one pass measured it under the bound, else a shuffle join."""
    return G.master_table(etab_silver(spark, sf), ul_silver(spark, sf), DEFAULT_BROADCAST_BYTES)


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return td.table(spark, sf, "lineitem")


# --- queries ---------------------------------------------------------------
def q01_bronze_scan_audit(spark, sf):
    return with_audit(etab_stock(spark, sf), RUN_TS)


def q02_select_columns(spark, sf):
    bronze = with_audit(etab_stock(spark, sf), RUN_TS)
    return bronze.select(*ESTABLISHMENTS.selected_columns)


def q03_clamp_dates(spark, sf):
    d = ESTABLISHMENTS.date_column
    return etab_raw(spark, sf).select("siret", clamp_date(F.col(d)).alias(d))


def q04_lenient_timestamp(spark, sf):
    d = ESTABLISHMENTS.date_column
    k = F.col("siret").cast("long")
    text = (
        F.when(k % 13 == 0, F.lit("not-a-date"))
        .when(k % 17 == 0, F.lit("2020-13-01"))
        .otherwise(F.col(d).cast("string"))
    )
    raw = etab_raw(spark, sf).select("siret", text.alias(d))
    return raw.select("siret", lenient_timestamp(F.col(d), raw.schema[d].dataType).alias(d))


def _text_dates(spark, sf):
    """Bronze with creation dates as text: malformed ones, both bounds and values beyond them."""
    d = ESTABLISHMENTS.date_column
    k = F.col("siret").cast("long")
    text = (
        F.when(k % 13 == 0, F.lit("not-a-date"))
        .when(k % 17 == 0, F.lit("2020-13-01"))
        .when(k % 19 == 0, F.lit("1678-01-01"))
        .when(k % 23 == 0, F.lit("1677-12-31"))
        .when(k % 29 == 0, F.lit("2261-12-31"))
        .when(k % 31 == 0, F.lit("2262-01-01"))
        .otherwise(F.col(d).cast("string"))
    )
    return etab_raw(spark, sf).withColumn(d, text)


def q04b_text_dates_to_silver(spark, sf):
    new = silver_increment(_text_dates(spark, sf), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS, AS_OF_YEAR)
    return merge_last_wins(None, coerce(new, ESTABLISHMENTS), ESTABLISHMENTS)


def q04c_date_spellings(spark, sf):
    """Dates in five spellings, malformed ones and days that are none; the spellings are found in the data."""
    d = ESTABLISHMENTS.date_column
    k = F.col("siret").cast("long")
    part = lambda f: F.date_format(F.col(d), f)
    text = (
        F.when(k % 13 == 0, F.lit("31/02/2020"))
        .when(k % 17 == 0, F.lit("20201301"))
        .when(k % 5 == 1, F.concat_ws("/", part("dd"), part("MM"), part("yyyy")))
        .when(k % 5 == 2, part("yyyyMMdd"))
        .when(k % 5 == 3, F.concat_ws("/", part("yyyy"), part("MM"), part("dd")))
        .when(k % 5 == 4, F.concat(part("dd.MM.yyyy"), F.lit(" 06:07:08")))
        .otherwise(F.col(d).cast("string"))
    )
    raw = etab_raw(spark, sf).select("siret", text.alias(d))
    return raw.select("siret", lenient_timestamp(F.col(d), raw.schema[d].dataType, date_spellings(raw).get(d, ())).alias(d))


def q05_default_fills(spark, sf):
    return fill_defaults(etab_raw(spark, sf)).select(
        "siret", "etatAdministratifEtablissement", "trancheEffectifsEtablissement", "enseigne1Etablissement"
    )


def q06_string_fill(spark, sf):
    return fill_strings(etab_raw(spark, sf))


def q07_engineered(spark, sf):
    return etab_silver(spark, sf).select("siret", "departement", "secteur_activite", "age_entreprise")


def _batch1_registry(spark, sf):
    return etab_raw(spark, sf).filter(F.col("ingested_at") == ntz(BATCH_1))


def q09_anti_join_new_rows(spark, sf):
    fresh = new_rows(etab_stock(spark, sf), _batch1_registry(spark, sf), "siret")
    return with_audit(fresh, RUN_TS)


def _repeated_keys(spark, sf):
    """The stock file with NULL keys and with keys that come again, less complete."""
    k = F.col("siret").cast("long")
    src = etab_stock(spark, sf).withColumn("siret", F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("siret")))
    again = src.filter(F.col("siret").cast("long") % 4 == 0).withColumn("libelleCommuneEtablissement", F.lit(None).cast("string"))
    return src.unionByName(again)


def q09b_repeated_and_null_keys(spark, sf):
    """First load of a batch with repeated keys: the fullest, then smallest row of each stays."""
    return with_audit(new_rows(_repeated_keys(spark, sf), None, "siret", keep_null_keys=True), RUN_TS)


def q10_idempotent_union(spark, sf):
    src = etab_stock(spark, sf)
    run1 = with_audit(new_rows(src, None, "siret"), BATCH_1)
    run2 = with_audit(new_rows(src, run1, "siret"), RUN_TS)
    return run1.unionByName(run2)


def q11_increment_filter(spark, sf):
    return select_increment(etab_raw(spark, sf), ESTABLISHMENTS, BATCH_1, ())


def q12_region_filter(spark, sf):
    return select_increment(etab_raw(spark, sf), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS)


def _null_keyed(spark, sf):
    k = F.col("siret").cast("long")
    raw = etab_raw(spark, sf)
    return raw.withColumns(
        {
            "siret": F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("siret")),
            "siren": F.when(k % 31 == 0, F.lit(None)).otherwise(F.col("siren")),
        }
    )


def q13_drop_null_keys(spark, sf):
    return drop_null_keys(_null_keyed(spark, sf), ESTABLISHMENTS)


def q14_postal_clean(spark, sf):
    return postal_audit(drop_null_keys(etab_raw(spark, sf), ESTABLISHMENTS), ESTABLISHMENTS)


def q15_high_water_mark(spark, sf):
    return etab_raw(spark, sf).agg(mark_column())


def q16_capped_increment(spark, sf):
    fresh = new_rows(etab_stock(spark, sf), _batch1_registry(spark, sf), "siret")
    return first_n(fresh, CAP_ROWS, "siret", SAMPLE_SEED)


def _null_and_repeated(spark, sf):
    return _repeated_keys(spark, sf).select("siret", "siren", "codePostalEtablissement")


def q16b_cap_with_null_and_repeated_keys(spark, sf):
    """Exactly as many rows as the cap says, whatever the keys."""
    return first_n(_null_and_repeated(spark, sf), CAP_ROWS, "siret", SAMPLE_SEED).select("siret")


def q16c_cap_above_input(spark, sf):
    return first_n(_null_and_repeated(spark, sf), 1_000_000_000, "siret", SAMPLE_SEED)


def _redelivery(spark, sf):
    """Batch 2 plus a later redelivery of every fourth key with a new sign."""
    raw = etab_raw(spark, sf)
    k = F.col("siret").cast("long")
    again = raw.filter(k % 4 == 0).withColumns(
        {
            "enseigne1Etablissement": F.lit("REDELIVERED"),
            "ingested_at": ntz(REDELIVERY_TS),
        }
    )
    return raw.unionByName(again)


def q17_silver_merge(spark, sf):
    spec = ESTABLISHMENTS
    raw = _redelivery(spark, sf)
    b1 = raw.filter(F.col("ingested_at") <= ntz(BATCH_1))
    existing = merge_last_wins(None, silver_increment(b1, spec, MARK_FLOOR, REGION_DEPARTMENTS, AS_OF_YEAR), spec)
    new = silver_increment(raw, spec, BATCH_1, REGION_DEPARTMENTS, AS_OF_YEAR)
    return merge_last_wins(existing, new, spec)


def q17b_lineitem_last_wins(spark, sf):
    return keep_last(lineitem(spark, sf), LINEITEM_KEYS, ["l_shipdate"])


def _bad_ids(spark, sf):
    k = F.col("siret").cast("long")
    raw = etab_raw(spark, sf)
    return raw.withColumns(
        {
            "siret": F.when(k % 101 == 0, F.concat(F.lit("X"), F.substring("siret", 2, 13))).otherwise(F.col("siret")),
            "siren": F.when(k % 103 == 0, F.substring("siren", 1, 8)).otherwise(F.col("siren")),
            "etablissementSiege": F.when(k % 107 == 0, F.lit("maybe")).otherwise(F.col("etablissementSiege").cast("string")),
            "ingested_at": F.when(k % 109 == 0, F.lit("yesterday")).otherwise(F.col("ingested_at").cast("string")),
        }
    )


def q18b_rule_violations_legal_units(spark, sf):
    k = F.col("siren").cast("long")
    number = F.when(k % 9 == 0, F.lit("abc")).otherwise(F.col("categorieJuridiqueUniteLegale").cast("string"))
    return rule_violations(ul_raw(spark, sf).withColumn("categorieJuridiqueUniteLegale", number), LEGAL_UNITS)


def q18_rule_violations(spark, sf):
    return rule_violations(_bad_ids(spark, sf), ESTABLISHMENTS)


def q19_duplicate_keys(spark, sf):
    return duplicate_keys(lineitem(spark, sf), LINEITEM_KEYS)


def q20_master(spark, sf):
    return master(spark, sf)


def q20b_master_hot_key_split(spark, sf):
    """Master with the legal-unit side never broadcast whole: hot sirens go
    through a bounded broadcast join, the rest through the shuffle join."""
    return G.master_table(etab_silver(spark, sf), ul_silver(spark, sf), max_broadcast_bytes=0, split_hot_keys=True)


def q21_kpi_by_department(spark, sf):
    return G.kpi_by_department(master(spark, sf))


def q22_kpi_dominant_sector(spark, sf):
    return G.kpi_dominant_sector(master(spark, sf))


def q23_kpi_company_size(spark, sf):
    return G.kpi_company_size(master(spark, sf))


def q23b_kpis_from_one_scan(spark, sf):
    """The three KPIs as the Gold job computes them: from one (department,
    sector, size) count over the master. Returned as one tagged table."""
    base = G.kpi_base(master(spark, sf))
    d = G.kpi_by_department(base, "n").select(
        F.lit("by_department").alias("kpi"), F.col("departement").alias("k1"), F.lit(None).cast("string").alias("k2"),
        F.col("total_establishments").alias("value"))
    s = G.kpi_dominant_sector(base, "n").select(
        F.lit("dominant_sector").alias("kpi"), F.col("departement").alias("k1"), F.col("secteur_activite").alias("k2"),
        F.col("count").alias("value"))
    z = G.kpi_company_size(base, "n").select(
        F.lit("company_size").alias("kpi"), F.col("categorieEntreprise").alias("k1"), F.lit(None).cast("string").alias("k2"),
        F.col("total").alias("value"))
    return d.unionByName(s).unionByName(z)


def q24_join_integrity(spark, sf):
    return G.unmatched_count(master(spark, sf))


def q25_kpi_lookup(spark, sf):
    return G.kpi_lookup(G.kpi_by_department(master(spark, sf)), "75")


def q26_region_share(spark, sf):
    return P.region_share(etab_silver(spark, sf))


def q27_top_five_distribution(spark, sf):
    return P.top_values(etab_silver(spark, sf), "secteur_activite", 5, 1)


def q27b_distributions(spark, sf):
    """The five distributions of the quality report."""
    tables = {"etablissements": etab_silver(spark, sf), "unites_legales": ul_silver(spark, sf)}
    parts = [P.top_values_tagged(tables[n], n, c, 5) for n, cols in DISTRIBUTIONS.items() for c in cols]
    return reduce(DataFrame.unionByName, parts)


def q28_age_profile(spark, sf):
    return P.age_profile(etab_silver(spark, sf))


#: Years by which the approximate median may be off (whole-year values; Spark's default rank
#: error of 1/10,000), and the share by which a sketch's distinct count may be (three times its 5 %).
MEDIAN_TOLERANCE, DISTINCT_TOLERANCE = 1.0, 0.15


def q28b_age_profile_approx(spark, sf):
    """The approximate profile, with whether its median is within tolerance of the exact one."""
    e = etab_silver(spark, sf)
    exact = P.age_profile(e).select(F.col("median_age").alias("exact"))
    off = F.abs(F.col("median_age") - F.col("exact")) <= MEDIAN_TOLERANCE
    both = P.age_profile(e, exact_median=False).join(exact, F.lit(True))
    return both.select("min_age", "avg_age", "max_age", off.alias("within_tolerance"))


def q28c_age_profiles(spark, sf):
    parts = [P.age_profile(df).select(F.lit(n).alias("dataset"), "*") for n, df in (("etablissements", etab_silver(spark, sf)), ("unites_legales", ul_silver(spark, sf)))]
    return parts[0].unionByName(parts[1])


def q29_row_counts(spark, sf):
    m = master(spark, sf)
    return P.layer_counts(
        {
            "bronze_etablissements": etab_raw(spark, sf),
            "bronze_unites_legales": ul_raw(spark, sf),
            "silver_etablissements": etab_silver(spark, sf),
            "silver_unites_legales": ul_silver(spark, sf),
            "gold_master": m,
            "kpi_by_department": G.kpi_by_department(m),
            "kpi_dominant_sectors": G.kpi_dominant_sector(m),
            "kpi_business_size": G.kpi_company_size(m),
        }
    )


def q30_id_quality(spark, sf):
    return P.id_quality(etab_silver(spark, sf), "siret")


def q30b_id_quality_legal_units(spark, sf):
    return P.id_quality(ul_silver(spark, sf), "siren")


def q31_load_span(spark, sf):
    return P.load_span(etab_silver(spark, sf))


def q32_mean_positive_age(spark, sf):
    return P.mean_positive(etab_silver(spark, sf))


def q33_table_profile(spark, sf):
    return P.table_profile(etab_silver(spark, sf), exact=True)


def q33b_table_profile_legal_units(spark, sf):
    return P.table_profile(ul_silver(spark, sf), exact=True)


def q33c_table_profile_approx(spark, sf):
    """The sketch-based profile, with whether each distinct count is within tolerance of the exact one."""
    e = etab_silver(spark, sf)
    exact = P.table_profile(e, exact=True).select("column_name", F.col("unique_count").alias("exact"))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * DISTINCT_TOLERANCE)
    both = P.table_profile(e, exact=False).join(exact, "column_name")
    return both.select("column_name", "null_percentage", "min", "max", near.alias("within_tolerance"))


def q33d_profile_from_sketches(spark, sf):
    """The profile merged from sketches of seven parts, with whether each distinct count is within three
    standard errors of the exact one."""
    e = etab_silver(spark, sf)
    parts = P.sketch_rows(e.withColumn("part", F.pmod(F.xxhash64("siret"), F.lit(7))), "part")
    exact = P.table_profile(e, exact=True).select("column_name", F.col("unique_count").alias("exact"))
    near = F.abs(F.col("approx_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.05)
    return P.merged_profile(parts).join(exact, "column_name").select("column_name", "null_percentage", "min", "max", near.alias("within_tolerance"))


def q34_top_three_departments(spark, sf):
    return P.value_counts(etab_silver(spark, sf), "departement", 3)


def q35_describe(spark, sf):
    return P.expected_columns(etab_silver(spark, sf), ["secteur_activite", "age_entreprise", "ingested_at", "departement"])


def q36_view_query(spark, sf):
    view = f"master_{abs(hash(sf)) % 10_000_000}"
    master(spark, sf).createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT departement, COUNT(*) AS total_establishments FROM {view} "
        "GROUP BY departement ORDER BY total_establishments DESC, departement"
    )


def q37_hash_sample(spark, sf):
    return hash_sample(master(spark, sf), SAMPLE_N, "siret", SAMPLE_SEED)


def q38_preview(spark, sf):
    return (
        master(spark, sf)
        .select("siret", "denominationUniteLegale", "departement", "age_entreprise")
        .orderBy("siret")
        .limit(3)
    )


def q39_csv_roundtrip(spark, sf):
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv_roundtrip_{uuid.uuid4().hex}"
    hash_sample(master(spark, sf), SAMPLE_N, "siret", SAMPLE_SEED).write.mode("overwrite").option(
        "header", True
    ).csv(out)
    return spark.read.option("header", True).csv(out)


def q40_ul_engineered(spark, sf):
    return ul_silver(spark, sf).select("siren", "secteur_activite", "age_entreprise", "economieSocialeSolidaireUniteLegale")


def q41_clean_increment_counts(spark, sf):
    inc = clean_increment(
        select_increment(etab_raw(spark, sf), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS),
        ESTABLISHMENTS,
        AS_OF_YEAR,
    )
    return inc.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("dateCreationEtablissement").isNull()).alias("null_dates"),
        F.count_if(F.col("secteur_activite") == UNKNOWN_TEXT).alias("undetermined_sectors"),
        F.count_if(~exact_digits(F.col("codePostalEtablissement"), 5)).alias("bad_postal"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("q") and name[1:3].isdigit() and callable(fn)
}

"""Adapters that give the driver's TPC-H-like tables the registry's shape.

``orders`` becomes an establishment stock file and ``customer`` a legal-unit
stock file. The expressions are deterministic functions of each input row, so
the adapted tables grow with the inputs and need no shuffle. The same
expressions are written in DuckDB SQL by ``registrum.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed audit timestamps of the two simulated Bronze batches.
BATCH_1 = "2026-01-01 00:00:00"
BATCH_2 = "2026-02-01 00:00:00"


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _str(c: Column) -> Column:
    return c.cast("string")


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def establishments_from_orders(orders: DataFrame) -> DataFrame:
    """Raw establishment stock rows (with ``ingested_at`` of two batches)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    base = F.concat(_str(F.lit(71) + c % 25), F.lpad(_str(c % 1000), 3, "0"))
    postal = (
        F.when(k % 53 == 0, F.concat(F.substring(base, 1, 2), F.lit("x"), F.substring(base, 4, 2)))
        .when(k % 59 == 0, F.lit(None))
        .when(k % 61 == 0, F.concat(base, F.lit(" ")))
        .otherwise(base)
    )
    activity = F.concat(
        F.lpad(_str((k * 31) % 97), 2, "0"), F.lit(".1"), F.substring("o_orderpriority", 1, 1)
    )
    return orders.select(
        F.lpad(_str(k), 14, "0").alias("siret"),
        F.lpad(_str(F.when(c % 19 == 0, c + 900_000_000).otherwise(c)), 9, "0").alias("siren"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("etatAdministratifEtablissement"),
        F.make_date(
            (F.lit(1650) + k % 640).cast("int"), F.month("o_orderdate").cast("int"), F.lit(1)
        ).alias("dateCreationEtablissement"),
        postal.alias("codePostalEtablissement"),
        _null_if(k % 37 == 0, F.concat(F.lit("COMMUNE "), _str(c % 1000))).alias(
            "libelleCommuneEtablissement"
        ),
        _null_if(k % 41 == 0, activity).alias("activitePrincipaleEtablissement"),
        _null_if(k % 7 == 0, F.lpad(_str(k % 54), 2, "0")).alias("trancheEffectifsEtablissement"),
        _null_if(k % 29 == 0, k % 2 == 0).alias("etablissementSiege"),
        _null_if(k % 5 == 0, F.concat(F.lit("ENS"), _str(k % 100))).alias("enseigne1Etablissement"),
        F.when(k % 3 == 0, _ts(BATCH_1)).otherwise(_ts(BATCH_2)).alias("ingested_at"),
    )


def legal_units_from_customer(customer: DataFrame) -> DataFrame:
    """Raw legal-unit stock rows, one for every customer."""
    k = F.col("c_custkey")
    size = (
        F.when(k % 7 <= 2, F.lit("PME"))
        .when(k % 7 == 3, F.lit("ETI"))
        .when(k % 7 == 4, F.lit("GE"))
        .otherwise(F.lit(None))
    )
    return customer.select(
        F.lpad(_str(k), 9, "0").alias("siren"),
        _null_if(k % 17 == 0, F.col("c_name")).alias("denominationUniteLegale"),
        F.when(k % 17 == 0, F.concat(F.lit("NOM"), _str(k))).alias("nomUniteLegale"),
        F.when(k % 34 == 0, F.lit("Alex")).alias("prenom1UniteLegale"),
        size.alias("categorieEntreprise"),
        (F.lit(5499) + k % 300).cast("double").alias("categorieJuridiqueUniteLegale"),
        _null_if(k % 43 == 0, F.concat(F.lpad(_str((k * 13) % 97), 2, "0"), F.lit(".2Z"))).alias(
            "activitePrincipaleUniteLegale"
        ),
        F.when(k % 11 == 0, F.lit("C")).otherwise(F.lit("A")).alias("etatAdministratifUniteLegale"),
        F.make_date(
            (F.lit(1900) + k % 125).cast("int"), (F.lit(1) + k % 12).cast("int"), F.lit(1)
        ).alias("dateCreationUniteLegale"),
        F.when(k % 3 == 1, F.lit("O"))
        .when(k % 3 == 2, F.lit("N"))
        .alias("economieSocialeSolidaireUniteLegale"),
        _ts(BATCH_1).alias("ingested_at"),
    )


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return establishments_from_orders(table(spark, sf_dir, "orders"))


def legal_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legal_units_from_customer(table(spark, sf_dir, "customer"))

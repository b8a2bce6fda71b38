"""A training corpus from `documents`: five stages, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the columns
of documents (the last adds the encoded ids). Repeated rows, nulls and clashing extra columns are
handled as the operators' docstrings define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.llm import bpe_duckdb, jaccard_join, pii_crf, quality_gam, soft_mixing
from registrum.llm.common import discard, may_be_in, ship_package, table, written
from registrum.llm.queries import domains

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _columns(df: DataFrame) -> list:
    """The fields of the struct `row`, whatever their names."""
    return [F.col("row").getField(name).alias(name) for name in df.schema["row"].dataType.names]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.3 or more), row by row."""
    scored = quality_gam.score(docs, quality_gam.learn(docs, table(spark, sf_dir, "labels")))
    return scored.where("score >= 0.3").select(*_columns(scored))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones (five-word shingles, similarity of 0.8 or more): that
    with the smallest doc_id. Rows that share a doc_id are one document: of them the one whose row has
    the smallest hash stays. Rows with a null doc_id link with nothing and stay."""
    groups = jaccard_join.join_components(docs, words=5, percent=80)
    # ids whose rows do not simply stay; the rows of all others are neither joined nor shuffled
    ids = groups.where("doc_id IS NOT NULL")
    marks = ids.groupBy("doc_id").agg(F.min("component_id").alias("least"), F.count("*").alias("rows"))
    marks = written(marks.where("rows > 1 OR least <> doc_id"), "marked-documents")
    asked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.struct("*").alias("row"))
    asked = may_be_in(asked, "doc_id", marks.select("doc_id"))
    clear = asked.where("doc_id IS NULL OR NOT maybe").select("row")
    # of the others, rows that surely go need no shuffle either: the ids that stay are found without the rows
    stay = may_be_in(ids.select("doc_id"), "doc_id", marks.select("doc_id")).where("maybe").select("doc_id")
    stay = written(stay.join(marks.where("least <> doc_id").select("doc_id"), "doc_id", "left_anti"), "staying-documents")
    asked = may_be_in(asked.where("doc_id IS NOT NULL AND maybe").drop("maybe"), "doc_id", stay)
    open_ = asked.where("maybe").drop("maybe").join(marks, "doc_id", "left")
    once = open_.where("least IS NULL").select("row")
    chosen = open_.where("least = doc_id").groupBy("doc_id").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    kept = clear.union(once).union(chosen)
    return kept.select(*_columns(kept))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    return pii_crf.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The languages mixed to their target weights by repeating rows; no document is lost."""
    return soft_mixing.mixed(docs, domains(docs, table(spark, sf_dir, "labels")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with `ids` (binary, little-endian 32-bit) and n_tokens, in place of columns so named."""
    encoded = bpe_duckdb.encode(docs)
    # a column of that name gives way to the stage's own
    kept = [F.col("row").getField(c).alias(c) for c in encoded.schema["row"].dataType.names if c.lower() not in ("ids", "n_tokens")]
    return encoded.select(*kept, "ids", F.expr("octet_length(ids) div 4").alias("n_tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", pii),
    ("mixing", mixing),
    ("byte-level BPE", encode),
]

#: SQL can express neither the classifier nor the random field; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{i}")
            if before is not None:
                discard(before)  # the stage before has been read
            before = docs
    return docs

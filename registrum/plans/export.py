"""Export job: reproducible sample of the master table as CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registrum.operators.sample import hash_sample
from registrum.spec import SAMPLE_ROWS, SAMPLE_SEED


def sample_master(master: DataFrame, n_rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    return hash_sample(master, n_rows, "siret", seed)


def export_sampled_master(
    spark: SparkSession,
    input_path: str | list[str],
    output_path: str,
    n_rows: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
    single_file: bool = True,
) -> int:
    """Write min(n_rows, rows) sampled master rows as CSV; returns the count.

    The sample is bounded by ``n_rows`` (the feature: a file a BI tool can
    open), so one output file is allowed; the selection itself is distributed.
    """
    paths = [input_path] if isinstance(input_path, str) else list(input_path)
    sample = sample_master(spark.read.parquet(*paths), n_rows, seed)
    # repartition: the scan of the master keeps its tasks, only the sample meets in one
    out = sample.repartition(1) if single_file else sample
    out.write.mode("overwrite").option("header", True).csv(output_path)
    return spark.read.option("header", True).csv(output_path).count()

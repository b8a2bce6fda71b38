"""Silver as a stream: each micro-batch of new stock files goes through Bronze and on into Silver.

There is no second state: how far Silver has come is in its commit marker (the mark and the newest batch
read), the stream's checkpoint only says which files were consumed. So a run may end at any point, and the
replayed micro-batch finds what is done: a batch that was written is written again under its own id until a
Silver version has read it; a version that was committed is sealed first and not merged twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from registrum.plans.silver import build_silver, seal_committed
from registrum.sources import parquet as pq
from registrum.sources.store import SnapshotStore
from registrum.spec import REGION_DEPARTMENTS
from registrum.streaming.bronze_stream import start_bronze_stream


def start_silver_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    bronze_path: str,
    silver_root: str,
    dataset_name: str,
    as_of_year: int,
    departments: Sequence[str] = REGION_DEPARTMENTS,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Consume the files that are there, Bronze and Silver after each micro-batch."""
    root = f"{silver_root.rstrip('/')}/{dataset_name}"

    def before(session: SparkSession) -> None:
        seal_committed(session, SnapshotStore(session, root).current(), bronze_path)

    def after(session: SparkSession) -> None:
        if pq.exists(session, bronze_path):
            build_silver(session, dataset_name, bronze_path, silver_root, as_of_year, departments, buckets=buckets)

    return start_bronze_stream(spark, source_dir, schema, bronze_path, dataset_name, checkpoint_location, False, max_files_per_trigger, before, after)

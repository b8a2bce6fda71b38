"""Bronze ingestion as a Structured Streaming file source.

New stock files dropped into a directory are picked up with
``trigger(availableNow=True)`` and each micro-batch goes through the same
anti-join ingestion as the batch job (``foreachBatch``), whole: there is no row
cap, as the checkpoint takes a file as consumed.

The streaming checkpoint records which files were consumed. The batch id of an
epoch is chosen at its first attempt (now in UTC, after the newest batch) and
kept beside the checkpoint, so a micro-batch that is replayed after a failure
overwrites its own partition and appends nothing twice. One that Silver has
read meanwhile was complete and is left as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from registrum.operators.clean import EPOCH, batch_id_of
from registrum.plans.bronze import batches, ingest_bronze, sealed
from registrum.session import ensure_checkpoint_dir
from registrum.sources import parquet as pq


def epoch_timestamp(spark: SparkSession, folder: str, epoch_id: int, bronze_path: str) -> datetime:
    """The run timestamp of an epoch: the one kept for it, or a new one later than every batch."""
    path = f"{folder}/{epoch_id}"
    if pq.exists(spark, path) and (kept := pq.read_text(spark, path)):
        return EPOCH + timedelta(microseconds=int(kept))
    there = [*batches(spark, bronze_path), *filter(None, [sealed(spark, bronze_path)])]
    own = max(batch_id_of(datetime.now(UTC).replace(tzinfo=None)), max(there, default=0) + 1)
    if pq.exists(spark, path):
        pq.delete(spark, path)
    pq.write_text_once(spark, path, str(own))
    return EPOCH + timedelta(microseconds=own)


def start_bronze_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    bronze_path: str,
    dataset_name: str,
    checkpoint_location: str | None = None,
    keep_null_keys: bool = False,
    max_files_per_trigger: int | None = None,
    before: Callable[[SparkSession], None] | None = None,
    after: Callable[[SparkSession], None] | None = None,
) -> StreamingQuery:
    """``before`` and ``after`` are run with each micro-batch, a replayed one included."""
    if checkpoint_location is None:
        # the shared folder the cluster names; set only where it is unset (tests)
        base = ensure_checkpoint_dir(spark)
        checkpoint_location = f"{base.rstrip('/')}/bronze_stream_{dataset_name}"
    epochs = f"{checkpoint_location.rstrip('/')}-epochs"

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        if before:
            before(session)
        run_ts = epoch_timestamp(session, epochs, epoch_id, bronze_path)
        read = sealed(session, bronze_path)
        # a batch that Silver has read was written before
        if read is None or batch_id_of(run_ts) > read:
            ingest_bronze(session, batch, bronze_path, dataset_name, run_ts, 0, keep_null_keys)
        if after:
            after(session)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.parquet(source_dir)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )

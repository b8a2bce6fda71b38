"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from registrum.session import ensure_checkpoint_dir
from registrum.sources.parquet import delete

_open: list[list[str]] = []


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once and read it back, with the path (to delete when done): whatever
    is derived from it afterwards reads the files, and its own lineage is cut."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/staged/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    return stage(df, name)[0]


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside is deleted at the end, also after a failure: a job
    that has written its result needs none of it. Results that stay lazy are staged outside."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)

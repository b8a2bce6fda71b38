"""Parquet scans and filesystem probes (Hadoop FileSystem, so HDFS/S3/GCS work)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class MissingInput(FileNotFoundError):
    """A required input table does not exist."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def require(spark: SparkSession, *paths: str) -> None:
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise MissingInput(f"Missing required input(s): {', '.join(missing)}")


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a Parquet table; with ``columns`` only those reach ``ReadSchema``."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when it is missing or holds no data file
    yet (an empty first write leaves only the commit marker)."""
    if not exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return None
        raise


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a directory (empty if it is missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a whole file or fail if it exists: written beside it, then renamed."""
    import uuid

    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    beside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp"
    write_text(spark, beside, text)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if target.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(jvm.org.apache.hadoop.fs.Path(beside), target, none)
    except Exception:
        delete(spark, beside)
        raise


def list_ages(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names of the direct children of a directory and the seconds since they changed."""
    import time

    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    now = time.time()
    return sorted((str(s.getPath().getName()), now - s.getModificationTime() / 1000) for s in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)

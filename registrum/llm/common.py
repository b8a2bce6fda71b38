"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from registrum.operators import keyfilter
from registrum.sources.parquet import delete

#: ASCII white space that separates words: [\x20\x09-\x0D].
WORD_SPACE = "\\x20\\x09-\\x0D"
#: UTF-8 continuation bytes; all others start a code point.
CONTINUATION = bytes(range(0x80, 0xC0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_column(df: DataFrame, column: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, without decoding; null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def code_points(data: bytes) -> int:
    return len(data.translate(None, CONTINUATION))


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose `column` holds about max_bytes (one row at least), so that
    vectorised work over a slice has bounded memory whatever the batch size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def map_slices(df: DataFrame, column: str, schema: str, function: Callable[[pa.RecordBatch], dict], max_bytes: int = 8 << 20) -> DataFrame:
    """mapInArrow with `function` over slices of bounded text; the function gives columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column, max_bytes):
            yield pa.RecordBatch.from_pydict(function(piece))

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the system: a worker's process lives on, beside others."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not on every platform
        ctypes.CDLL(None).malloc_trim(0)


Batches = Iterator[pa.RecordBatch]


def map_rows(docs: DataFrame, text: str, added: StructType, function: Callable[[Batches], Batches]) -> DataFrame:
    """mapInArrow over all columns of docs in a struct `row` and their `text`; the function gives `row` and
    the added columns. A string column is sent once, in the row, and read from there."""
    read = text_column(docs, text).alias("text")
    places = [i for i, name in enumerate(docs.columns) if name.lower() == text.lower()]
    place = places[0] if len(places) == 1 and isinstance(docs.schema[places[0]].dataType, StringType) else None
    source = docs.select(F.struct("*").alias("row"), *([read] if place is None else []))

    def run(batches: Batches) -> Batches:
        if place is not None:
            batches = (pa.RecordBatch.from_arrays([b.column("row"), b.column("row").field(place)], ["row", "text"]) for b in batches)
        yield from function(batches)
        release()  # what the function held is free by now

    return source.mapInArrow(run, StructType([source.schema["row"], *added]))


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir: the folder that driver and executors share. Unset, a local session
    (tests) gets one; any other session must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    import tempfile

    folder = f"file://{tempfile.mkdtemp(prefix='llm-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables `written` inside are deleted at the end, also after a failure, but for those that the given
    function has marked to be kept (they belong to the caller's scratch, if there is one)."""
    _scratch.append([])

    def keep(df: DataFrame) -> DataFrame:
        _scratch[-1].remove(df.written_path)
        if len(_scratch) > 1:
            _scratch[-2].append(df.written_path)
        return df

    try:
        yield keep
    finally:
        for path in _scratch.pop():
            delete(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder, under a fresh name, and read it."""
    import uuid

    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    if _scratch:
        _scratch[-1].append(path)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by `written` that no later job reads any more."""
    for df in frames:
        delete(df.sparkSession, df.written_path)
        if _scratch and df.written_path in _scratch[-1]:
            _scratch[-1].remove(df.written_path)


def may_be_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """df with `maybe`: False where its key is surely not among `keys` (one column of that name). The filter is
    written and broadcast; its size is set by the number of keys and bounded (64 MB, beyond which more rows are True)."""
    bits = keyfilter.filter_bits(keys.count())
    return keyfilter.ask(df, key, written(keyfilter.key_filter(keys, key, bits), "key-filter"), bits)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, unless their PYTHONPATH has it already."""
    import os
    import zipfile
    from pathlib import Path
    from tempfile import mkdtemp

    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    listed = [os.path.realpath(x) for x in os.environ.get("PYTHONPATH", "").split(os.pathsep) if x]
    if str(package.parent) in listed or any(x.endswith(f"/{package.name}.zip") for x in context.listFiles):
        return
    path = Path(mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))

"""Byte-level BPE encoding and decoding by DuckDB queries inside Spark tasks.

Spark deals out the documents; each task splits its texts by the pre-tokenizer's pattern and hands the
distinct matches that are no whole token to DuckDB. There a recursive query unnests each match into
token-position rows, joins adjacent pairs with the merge table, contracts each match's leftmost
pair of least rank, and goes on with the matches that changed, until none does. Decoding joins the ids
with the vocabulary and concatenates by an ordered aggregation.

The ids of matches are kept in a bounded dictionary per worker, so a match costs a query once while
it is remembered.

Matches of over LONG bytes are contracted in a table that each step replaces, all non-overlapping
occurrences of the least pair at once. In a vocabulary in which every token encodes to itself a merge
only makes pairs of higher rank, so that is the same order (tests compare both with the public library).

Defined results: null or empty text has no ids and decodes to no bytes; rows are treated one by
one; other columns are ignored; an empty table gives an empty result. The vocabulary file is named by
a parameter and read on the executors; it is never copied.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.llm.common import map_rows, release, slices, text_column

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG = 256
KEPT = 300_000  # entries of a worker's dictionary; it is emptied beyond, and after each task
ROUND = 30_000  # matches in one recursive query
SLICE = 1 << 20  # bytes of text whose matches are in memory at once

#: White space, and for texts without characters above U+024F the letters and numbers of the pattern.
_SPACE = "\t-\r \x85\xa0  -     　"
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_OTHER = re.compile("[ɐ-\U0010ffff]")

_ENCODE = """
WITH RECURSIVE words AS (
    SELECT 0 AS step, w, ids FROM fresh
    UNION ALL
    SELECT step + 1, w,
           list_concat(list_concat(ids[:(best & 4294967295) - 1], [(best >> 32)::INTEGER]), ids[(best & 4294967295) + 2:])
    FROM words JOIN (
        SELECT w, min(rank + place) AS best
        FROM (SELECT w, unnest(ids[:-2])::BIGINT * 65536 + unnest(ids[2:]) AS pair,
                     unnest(range(1, len(ids))) AS place FROM words)
        JOIN merges USING (pair) GROUP BY w
    ) USING (w)
)
SELECT w, arg_max(ids, step) AS ids FROM words GROUP BY w ORDER BY w
"""

_STEP = """
CREATE OR REPLACE TEMP TABLE after AS
WITH pairs AS (
    SELECT w, place, id, row_number() OVER o AS n, id::BIGINT * 65536 + lead(id) OVER o AS pair
    FROM long_words WINDOW o AS (PARTITION BY w ORDER BY place)
), ranked AS (
    SELECT pairs.*, rank, min(rank) OVER (PARTITION BY w) AS best FROM pairs LEFT JOIN merges USING (pair)
), runs AS (
    SELECT *, n - row_number() OVER (PARTITION BY w, rank = best ORDER BY n) AS run FROM ranked
), chosen AS (
    SELECT *, coalesce(rank = best, false) AND row_number() OVER (PARTITION BY w, rank = best, run ORDER BY n) % 2 = 1 AS hit FROM runs
)
SELECT w, place, CASE WHEN hit THEN (best >> 32)::INTEGER ELSE id END AS id
FROM (SELECT *, lag(hit, 1, false) OVER (PARTITION BY w ORDER BY n) AS joined FROM chosen) WHERE NOT joined
"""


#: One thread aggregates the rows in the order of the subquery.
_DECODE = """
SELECT n, string_agg(bytes, '') AS bytes
FROM (SELECT n, bytes FROM given JOIN vocabulary USING (id) ORDER BY place) GROUP BY n
"""


def vocabulary_path(name: str) -> str:
    """A path as it is; a bare file name is looked up among the public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Encoder and decoder of one worker process."""

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        import duckdb
        import public_tokenizers
        import regex

        with open(vocabulary_path(vocabulary), "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        by_id = {rank: token for token, rank in self.ranks.items()}
        merges = [(self.ranks[t[:k]] * 65536 + self.ranks[t[k:]], rank << 32) for t, rank in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        pairs, ranks = (pa.array(x, pa.int64()) for x in zip(*merges, strict=True))
        self._table("merges", pa.table({"pair": pairs, "rank": ranks}))
        # bytes as the characters U+0000 to U+00FF, so that text functions join them
        self._table("vocabulary", pa.table({"id": pa.array(by_id, pa.int32()), "bytes": [t.decode("latin-1") for t in by_id.values()]}))
        self.known: dict[str, bytes] = {}

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def matches(self, text: str) -> list[str]:
        return (self.pattern if _OTHER.search(text) else _LATIN).findall(text)

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        for at in range(0, len(short), ROUND):
            part = short[at : at + ROUND]
            joined = np.frombuffer(b"".join([words[i] for i in part]), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(words[i]) for i in part])])
            fresh = pa.table({"w": pa.array(np.arange(len(part)), pa.int32()), "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.single[joined]))})
            self.db.register("fresh", fresh)
            found = self.db.sql(_ENCODE).to_arrow_table().column("ids").combine_chunks()
            self.db.unregister("fresh")
            flat, ends = found.flatten().to_numpy().astype("<u4").tobytes(), found.offsets.to_numpy() * 4
            first = int(ends[0])
            for i, a, b in zip(part, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                out[i] = flat[a - first : b - first]
        for i in (i for i, w in enumerate(words) if len(w) > LONG):
            ids = self.single[np.frombuffer(words[i], np.uint8)]
            self._table("long_words", pa.table({"w": pa.array(np.zeros(len(ids)), pa.int32()), "place": pa.array(np.arange(len(ids)), pa.int32()), "id": pa.array(ids)}))
            size = len(ids)
            while True:
                self.db.execute(_STEP)
                left = self.db.execute("SELECT count(*) FROM after").fetchall()[0][0]
                if left == size:
                    break
                size = left
                self.db.execute("CREATE OR REPLACE TABLE long_words AS SELECT * FROM after")
            out[i] = self.db.sql("SELECT id FROM after ORDER BY place").to_arrow_table().column("id").to_numpy().astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        split = [self.matches(text) if text else [] for text in texts]
        if len(self.known) > KEPT:
            self.known.clear()
        fresh = list(set(chain.from_iterable(split)) - self.known.keys())
        data = [x.encode() for x in fresh]
        whole = [self.ranks.get(x) for x in data]
        self.known.update((x, rank.to_bytes(4, "little")) for x, rank in zip(fresh, whole, strict=True) if rank is not None)
        rest = [i for i, rank in enumerate(whole) if rank is None]
        self.known.update(zip([fresh[i] for i in rest], self._contract([data[i] for i in rest]), strict=True))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """The bytes that each row of ids stands for, whatever text it came from."""
        sizes = [len(x) // 4 for x in rows]
        ids = np.frombuffer(b"".join(rows), "<u4").astype(np.int32)
        self.db.register("given", pa.table({"n": pa.array(np.repeat(np.arange(len(rows)), sizes), pa.int32()), "place": pa.array(np.arange(len(ids)), pa.int32()), "id": pa.array(ids)}))
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("given")
        out = [b""] * len(rows)
        for n, joined in zip(found.column("n").to_pylist(), found.column("bytes").to_pylist(), strict=True):
            out[n] = joined.encode("latin-1")
        return out


_CODECS: dict[str, Codec] = {}


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """The worker's codec for a vocabulary, made at its first use."""
    if vocabulary not in _CODECS:
        _CODECS[vocabulary] = Codec(vocabulary)
    return _CODECS[vocabulary]


def encode(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Row by row: all input columns as struct `row`, with `ids` (binary, little-endian 32-bit)."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for piece in slices(batches, "text", SLICE):
            ids = own.encode(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(ids, pa.binary())], ["row", "ids"])
        own.known.clear()  # the worker's process lives on, with other tasks

    return map_rows(docs, text, StructType([StructField("ids", BinaryType())]), run)


def decode(rows: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of rows and `decoded` (binary)."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for piece in slices(batches, ids, 8 << 20):
            out = own.decode([x or b"" for x in piece.column(ids).to_pylist()])
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(out, pa.binary())], [*piece.schema.names, "decoded"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", BinaryType())]))


def digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode and decode in one pass, keeping digests only: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    import hashlib

    source = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        digest = lambda data: pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string())
        for piece in slices(batches, "text", SLICE):
            ids = own.encode(piece.column("text").to_pylist())
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), sizes, digest(ids), digest(own.decode(ids))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        own.known.clear()
        release()

    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to whole numbers. The index deals the rows into blocks; in a block each attribute,
less its least value there, is stored as bit slices: one bitmap over the block's rows per binary digit. For a
query the slices are added with bitmap arithmetic: a nonzero signed digit 2 ** c of component j adds the slices
of attribute j (or their complements) at their place plus c, and full adders over whole bitmaps reduce every
place to one slice of the score. The best rows are then selected from the most significant slice downward:
rows known to be in, rows still equal. Rows that are equal to the end lie on the boundary and are resolved
exactly, by vec_id. The lists of the blocks are merged at last, one short list per query and block.

Cells of (index block, query block) are the unit of work and of recovery; both sides have a bounded size.

Defined results: vectors that are null, or hold null or non-finite components, are neither queries nor
candidates. Missing components of a shorter vector count as 0. Rows with equal vec_id are rows of their own,
each with its own list if it is a query; a null vec_id is a candidate, after all others among equals. Fewer
than k candidates give fewer rows; an empty table gives none. If a score could pass 2 ** 62 an OverflowError
says so. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrum.llm.common import written

#: Largest numbers of components in one index block and in one query block.
BLOCK_VALUES = 1 << 23
QUERY_VALUES = 1 << 21
MIN_BLOCK_ROWS = 4096
#: An index has this many blocks at least, if they hold MIN_BLOCK_ROWS.
BLOCKS = 64
#: Words (of 64 rows) that one addition may hold at a time.
ADD_WORDS = 1 << 21


def quantised(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """(row, vec_id, q): floor(scale * x) of each component; only whole, finite vectors."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    rows = vectors.where(F.col(column).isNotNull() & F.forall(column, finite))
    scaled = F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    large = F.exists(column, lambda x: F.abs(x.cast("double")) >= float(2**52 // scale))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("q"), large.alias("large"))


@dataclass
class Block:
    """An index block: `slices[s]` are bitmaps over the rows, those of attribute j from `start[j]`, its digits
    `width[j]`, its least value `low[j]`. Rows are in the order of ids, so of equal rows the first wins; those
    without id (`known` is 0) come last."""

    ids: np.ndarray
    known: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    width: np.ndarray
    slices: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.width)[:-1]]).astype(np.int64)


def _matrix(vectors: pa.ChunkedArray, dimension: int) -> np.ndarray:
    """Vectors as rows of one matrix, the missing components 0."""
    out = np.zeros((len(vectors), dimension), np.int64)
    at = 0
    for chunk in vectors.chunks:
        sizes = np.diff(chunk.offsets.to_numpy())
        values = chunk.flatten().to_numpy(zero_copy_only=False)
        line = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[at + line, place] = values
        at += len(sizes)
    return out


def _pack(bits: np.ndarray, words: int) -> np.ndarray:
    padded = np.zeros((bits.shape[0], words * 64), np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def sliced(ids: np.ndarray, known: np.ndarray, rows: np.ndarray, values: np.ndarray) -> Block:
    """The bit-sliced index of one block."""
    order = np.lexsort((rows, ids, 1 - known))
    values = values[order]
    low = values.min(axis=0)
    width = np.array([int(x).bit_length() for x in values.max(axis=0) - low], np.int64)
    words = -(-len(ids) // 64)
    pieces = [_pack(((values[:, j] - low[j])[None, :] >> np.arange(w)[:, None] & 1).astype(np.uint8), words) for j, w in enumerate(width) if w]
    slices = np.concatenate(pieces) if pieces else np.zeros((0, words), np.uint64)
    return Block(ids[order], known[order], rows[order], low, width, slices)


def signed_digits(value: int) -> list[tuple[int, int]]:
    """(place, sign) of the nonadjacent form: as few nonzero binary digits as there can be."""
    digits, place = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            digits.append((place, sign))
            value -= sign
        value >>= 1
        place += 1
    return digits


def _places(block: Block, query: np.ndarray) -> tuple[list[list[int]], int]:
    """Which bitmaps a query adds at which place (complements come after the slices), and the constant that
    the least values and the complements leave."""
    start, count = block.start, len(block.slices)
    places: list[list[int]] = []
    constant = int(np.dot(query.astype(object), block.low.astype(object))) if len(query) else 0
    for j, value in enumerate(query):
        width, first = int(block.width[j]), int(start[j])
        for place, sign in signed_digits(int(value)) if width else ():
            if place + width > len(places):
                places.extend([] for _ in range(place + width - len(places)))
            # - u = (2 ** width - 1 - u) - (2 ** width - 1)
            constant -= ((1 << width) - 1 << place) if sign < 0 else 0
            for b in range(width):
                places[place + b].append(first + b + (count if sign < 0 else 0))
    return places, constant


def _add(stacks: np.ndarray, carries: list[np.ndarray]) -> np.ndarray:
    """Full adders over stacks (query, bitmap, word) of one place until one bitmap is left; what they carry
    goes to the next place."""
    while stacks.shape[1] > 1:
        third = max(1, stacks.shape[1] // 3)
        a, b, rest = stacks[:, :third], stacks[:, third : 2 * third], stacks[:, 2 * third :]
        half = a ^ b
        if stacks.shape[1] == 2:
            carries.append(a & b)
            return half
        c, rest = rest[:, :third], rest[:, third:]
        carries.append((a & b) | (half & c))
        half ^= c
        stacks = np.concatenate([half, rest], axis=1) if rest.shape[1] else half
    return stacks


def score_slices(block: Block, queries: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Slices of the scores (place, query, word), least place first, and the constants to add."""
    words = block.slices.shape[1]
    bitmaps = np.concatenate([block.slices, ~block.slices, np.zeros((1, words), np.uint64)])
    empty = len(bitmaps) - 1
    wanted, constants = zip(*[_places(block, q) for q in queries])
    out, carried, place = [], [], 0
    while place < max(map(len, wanted)) or carried:
        lists = [w[place] if place < len(w) else [] for w in wanted]
        longest = max(map(len, lists))
        index = np.full((len(queries), longest), empty)
        for i, x in enumerate(lists):
            index[i, : len(x)] = x
        stacks = np.concatenate([bitmaps[index], *carried], axis=1) if longest or carried else np.zeros((len(queries), 1, words), np.uint64)
        carried = []
        out.append(_add(stacks, carried)[:, 0] if stacks.shape[1] else np.zeros((len(queries), words), np.uint64))
        place += 1
    return np.array(out, np.uint64).reshape(len(out), len(queries), words), list(constants)


def select_top(slices: np.ndarray, taking: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """From the most significant slice downward: bitmaps (query, word) of the rows that are in, and of those
    that are equal on the boundary. `taking` are the rows that take part."""
    sure, equal = np.zeros_like(taking), taking.copy()
    for digit in slices[::-1]:
        upper = equal & digit
        trial = sure | upper
        enough = np.bitwise_count(trial).sum(axis=1) >= k
        equal = np.where(enough[:, None], upper, equal & ~digit)
        sure = np.where(enough[:, None], sure, trial)
    return sure, equal


def _members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.ascontiguousarray(bitmap).view(np.uint8), bitorder="little"))


def block_top(block: Block, query_rows: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (its place in queries): the k best rows of the block but the query's own, and their scores."""
    words = block.slices.shape[1]
    everyone = _pack(np.ones((1, len(block.ids)), np.uint8), words)
    at = {int(r): i for i, r in enumerate(block.rows)}
    step = max(1, ADD_WORDS // (max(1, len(block.slices)) * words))
    out = []
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        slices, constants = score_slices(block, part)
        taking = np.repeat(everyone, len(part), axis=0)
        for i, row in enumerate(query_rows[start : start + step]):
            if int(row) in at:
                own = at[int(row)]
                taking[i, own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        sure, equal = select_top(slices, taking, k)
        for i in range(len(part)):
            inside = _members(sure[i])
            chosen = np.concatenate([inside, _members(equal[i])[: k - len(inside)]])
            bits = slices[:, i, chosen // 64] >> (chosen % 64).astype(np.uint64) & np.uint64(1)
            scores = (bits.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0) + constants[i]
            out.append((start + i, chosen, scores))
    return out


PARTS = ("ids", "known", "rows", "low", "width", "slices")


def _packed(block: Block) -> dict:
    return {k: np.ascontiguousarray(getattr(block, k)).tobytes() for k in PARTS}


def _unpacked(row: dict) -> Block:
    ids, known, rows, low, width = (np.frombuffer(row[k], np.int64) for k in PARTS[:-1])
    return Block(ids, known, rows, low, width, np.frombuffer(row["slices"], np.uint64).reshape(int(width.sum()), -(-len(ids) // 64)))


def index(rows: DataFrame, blocks: int, dimension: int) -> DataFrame:
    """(block, ids, known, rows, low, width, slices): every row of `rows` in one of the blocks."""

    def build(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id")
        known = ids.is_valid().to_numpy().astype(np.int64)
        block = sliced(ids.fill_null(0).to_numpy(), known, group.column("row").to_numpy(), _matrix(group.column("q"), dimension))
        packed = _packed(block)
        return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int64()), **{k: pa.array([v], pa.binary()) for k, v in packed.items()}})

    dealt = rows.select("row", "vec_id", "q", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    return dealt.groupBy("block").applyInArrow(build, f"block long, {', '.join(f'{k} binary' for k in PARTS)}")


def search(vectors: DataFrame, is_query: Column, k: int = 5, column: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row where `is_query` (over vec_id), its own
    left out, by score and then vec_id."""
    rows = written(quantised(vectors, column, scale), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("d"), F.max(F.array_max(F.transform("q", F.abs))).alias("top"), F.max("large").alias("large"), F.count_if(is_query).alias("queries")).first()
    dimension = max(1, size["d"] or 0)
    if size["large"] or dimension * (2 * (size["top"] or 0) + 1) ** 2 >= 2**62:
        raise OverflowError(f"scores of {dimension} components up to {size['top']} may not fit a long")
    block_rows = max(1, min(BLOCK_VALUES // dimension, max(MIN_BLOCK_ROWS, -(-size["n"] // BLOCKS))))
    blocks = max(1, -(-size["n"] // block_rows))
    groups = max(1, -(-size["queries"] * dimension // QUERY_VALUES))
    built = written(index(rows, blocks, dimension), "bit-sliced-index")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cells = built.withColumn("part", each(groups))
    asked = rows.where(is_query).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "q", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part")).withColumn("block", each(blocks))

    def run(cell: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "vec_id", "score"]
        columns: list[list] = [[], [], [], []]
        if len(cell) and len(queries):
            block = _unpacked(cell.to_pylist()[0])
            query_rows = queries.column("query_row").to_numpy()
            query_ids = queries.column("query_id").to_pylist()
            for i, chosen, scores in block_top(block, query_rows, _matrix(queries.column("q"), dimension), k):
                columns[0] += [int(query_rows[i])] * len(chosen)
                columns[1] += [query_ids[i]] * len(chosen)
                columns[2] += [int(x) if is_known else None for x, is_known in zip(block.ids[chosen], block.known[chosen])]
                columns[3] += scores.tolist()
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    found = cells.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(run, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

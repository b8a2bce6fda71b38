"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature's share of the score is a lookup table over its bins, learned by cyclic boosting:
round after round, feature after feature, a shallow regression tree over the bins is fitted to the
gradient of the log loss and its leaves, shrunk, are added to the table. Then the feature pairs that
explain most of what is left get two-dimensional tables, boosted the same way with trees of one cut
on each side. Scoring a batch is one bin search per feature and additions of table cells.

The model is fitted on the driver from a bounded sample of labelled rows (`max_rows`, 20,000 by
default: those with the smallest hash of the id); features are computed on the executors, and
only the sample's numbers (16 doubles a row) reach the driver. Every row is scored in full.

Defined results: a null or empty text has all features 0 and is scored like any other; a null
id is never held out nor learned from; without labelled rows, or with labels of one kind only, the
score is constant (0.5 without any); labels that are null or not 0/1 are ignored; a document labelled
twice counts twice; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from registrum.llm.common import as_bytes, code_points, map_rows, release, slices, text_column
from registrum.llm.quality_rules import LETTERS, UPPER

FEATURES = ("log_words", "word_length", "symbols", "bangs", "bars", "digits", "upper", "letters", "other_signs", "repeated_pairs", "same_next", "distinct_words", "top_word", "distinct_lines", "stops", "wide_bytes")
SIGNS = b"#*$%&<>{}[]=\\^~_@"
DIGITS = b"0123456789"


def features(data: bytes) -> tuple[float, ...]:
    """Numbers of one text, none of which knows its id, source, language mark or labels."""
    words = data.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    bare = b"".join(words)
    size = len(bare)
    without = lambda kind: size - len(bare.translate(None, kind))
    letters = without(LETTERS)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False))) if len(counts) < n else n - 1
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return (
        float(np.log1p(n)),
        code_points(bare) / n,
        without(SIGNS) / n,
        bare.count(b"!") / n,
        bare.count(b"|") / n,
        without(DIGITS) / size,
        without(UPPER) / max(letters, 1),
        letters / size,
        without(b".,;:?'\"()-") / n,
        1 - pairs / max(n - 1, 1),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values()) / n,
        len(set(lines)) / max(len(lines), 1),
        bare.count(b".") / n,
        (size - code_points(bare)) / size,
    )


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cut points at quantiles; equal values fall into one bin."""
    cuts = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
    return cuts[cuts < column.max()] if len(column) else cuts


def _tree(gradient: np.ndarray, hessian: np.ndarray, depth: int, least: float = 8.0) -> np.ndarray:
    """Leaf value of each bin of a shallow tree over ordered bins (Newton steps, gain-based cuts)."""
    out = np.full(len(gradient), gradient.sum() / (hessian.sum() + 1.0))
    if depth == 0 or len(gradient) < 2:
        return out
    g, h = gradient.cumsum()[:-1], hessian.cumsum()[:-1]
    rest_g, rest_h = gradient.sum() - g, hessian.sum() - h
    gain = np.where((h * 4 >= least) & (rest_h * 4 >= least), g**2 / (h + 1) + rest_g**2 / (rest_h + 1), -1)
    cut = int(gain.argmax()) + 1
    if gain[cut - 1] <= gradient.sum() ** 2 / (hessian.sum() + 1):
        return out
    return np.concatenate([_tree(gradient[:cut], hessian[:cut], depth - 1, least), _tree(gradient[cut:], hessian[cut:], depth - 1, least)])


def _cross(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree with one cut on each side of a two-dimensional grid: its gain and its cells' values."""
    g, h = gradient.cumsum(0).cumsum(1), hessian.cumsum(0).cumsum(1)
    total = lambda x: (x[:-1, :-1], x[:-1, -1:] - x[:-1, :-1], x[-1:, :-1] - x[:-1, :-1], x[-1, -1] - x[:-1, -1:] - x[-1:, :-1] + x[:-1, :-1])
    parts = list(zip(total(g), total(h), strict=True))
    gain = sum(a**2 / (b + 1) for a, b in parts)
    if not gain.size:
        return 0.0, np.zeros_like(gradient)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    value = [float(a[i, j] / (b[i, j] + 1)) for a, b in parts]
    cells = np.empty_like(gradient)
    cells[: i + 1, : j + 1], cells[: i + 1, j + 1 :], cells[i + 1 :, : j + 1], cells[i + 1 :, j + 1 :] = value
    return float(gain[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + 1)), cells


@dataclass
class Gam:
    """Lookup tables by feature and by feature pair; a few thousand numbers whatever the data."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of a matrix with a row per document: bin searches and additions of cells."""
        total = np.full(len(x), self.intercept)
        for k, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, x[:, k])]
        if self.pairs:
            bins = [np.searchsorted(c, x[:, k]) for k, c in enumerate(self.coarse)]
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                total += grid[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 64, grid_bins: int = 8, pairs: int = 6, depth: int = 2) -> Gam:
    """Cyclic boosting of the one-feature tables, then of the tables of the strongest pairs."""
    if not len(y):
        return Gam()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(intercept=float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    model.edges = [_edges(column, bins) for column in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, column) for e, column in zip(model.edges, x.T, strict=True)]
    total = np.full(len(y), model.intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, values in enumerate(model.tables):
            g, h = slope()
            step = rate * _tree(np.bincount(at[k], g, len(values)), np.bincount(at[k], h, len(values)), depth)
            values += step
            total += step[at[k]]
    model.coarse = [_edges(column, grid_bins) for column in x.T]
    low = [np.searchsorted(c, column) for c, column in zip(model.coarse, x.T, strict=True)]

    def cells(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slope()
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        where = low[i] * shape[1] + low[j]
        return _cross(np.bincount(where, g, shape[0] * shape[1]).reshape(shape), np.bincount(where, h, shape[0] * shape[1]).reshape(shape))

    ranked = sorted(((cells(i, j)[0], i, j) for i in range(x.shape[1]) for j in range(i)), key=lambda t: (-t[0], t[1:]))
    model.pairs = [(i, j) for gain, i, j in ranked[:pairs] if gain > 0]
    model.grids = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(rounds // 3):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            step = rate * cells(i, j)[1]
            grid += step
            total += step[low[i], low[j]]
    return model


def held_out(id_column: Column) -> Column:
    """Rows kept out of learning: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000) -> Gam:
    """Fit on at most max_rows labelled rows that are not held out. The ids of the sample are at most
    max_rows rows, so their broadcast is bounded."""
    rows = labels.select(labels[id_column].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            x = [list(features(data)) for data in as_bytes(piece.column("text"))]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("label"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])
        release()

    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x array<double>")
    found = sorted((r.doc_id, r.label, tuple(r.x)) for r in sample.collect())
    return fit(np.array([r[2] for r in found]).reshape(-1, len(FEATURES)), np.array([r[1] for r in found], float))


def score(docs: DataFrame, model: Gam, text: str = "text") -> DataFrame:
    """All columns of docs, row by row, in a struct `row`, with `score` (0 to 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            x = np.array([features(data) for data in as_bytes(piece.column("text"))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(model.score(x))], ["row", "score"])

    return map_rows(docs, text, StructType([StructField("score", DoubleType())]), run)

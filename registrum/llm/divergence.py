"""Divergence of sources: how far each source's term shares are from every other source's of its language.

Counts of a (lang, source) group are columns over the language's vocabulary. The vocabulary is reordered so
that terms with equal counts in every source are neighbours: by total, number of sources and a hash of the
counts. Each group is then run-length encoded along that order, absent terms as runs of zero; for a pair of
sources the run boundaries are intersected, and f, computed once per stretch, is multiplied by its length.
The order is cut into bounded chunks, so a task holds two blocks of sources over one chunk whatever the size
of the vocabulary; the sums of the chunks are added.

Arithmetic is in whole numbers: shares in units of 10 ** -9, divisions of decimals rounded down, squares
below 2 ** 63.

Defined results: null text, lang and source are read as ''. A group without a kept term has count 0 for all;
a language without kept terms gives each pair 0 and no terms. Repeated rows are documents of their own; an
empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrum.llm.common import as_bytes, discard, text_column, written
from registrum.llm.ordering import small, sorted_rows

#: Bytes of a term: letters of any case and all of a longer code point.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
UNIT = 1_000_000_000
MIN_DOCUMENTS = 3
TOP_TERMS = 200
#: Terms of one chunk of the order (about), and sources of one block.
CHUNK_TERMS = 16_384
BLOCK_SOURCES = 64
#: Counts that a task holds at most before it hands them on.
HELD_ENTRIES = 400_000


def _named(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def _rows(found: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, documents) in found.items():
        terms = pa.array(list(n), pa.binary()).cast(pa.string())
        held = pa.array([documents[t] for t in n], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms, pa.array(list(n.values()), pa.int64()), held], ["lang", "source", "term", "n", "documents"])


def task_counts(docs: DataFrame, max_entries: int = HELD_ENTRIES) -> DataFrame:
    """(lang, source, term, n, documents): occurrences and documents, added up inside the task over as many
    texts as have max_entries different (group, term), a text at least."""
    rows = docs.select(*_named(docs), text_column(docs).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), as_bytes(batch.column("text"))):
                n, documents = found.setdefault((lang, source), (Counter(), Counter()))
                terms = TERM.findall(text.lower())  # bytes: only A to Z change
                before = len(n)
                n.update(terms)
                documents.update(set(terms))
                entries += len(n) - before
                if entries > max_entries:
                    yield from _rows(found)
                    found.clear()
                    entries = 0
        yield from _rows(found)

    return rows.mapInArrow(count, "lang string, source string, term string, n long, documents long")


def term_columns(counts: DataFrame) -> DataFrame:
    """(lang, term, total, documents, column): one row per term with its counts by source. Tasks have added up
    theirs, so a term comes as often as there are tasks and sources, however often it occurs; both groupings
    follow the one exchange by (lang, term)."""
    added = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    return added.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("column"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10 ** 9 * (n + 1) / (total + terms)), exactly."""
    top = (n + 1).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top, (total + terms).cast("decimal(19,0)")) + 1


def vocabulary(columns: DataFrame, min_documents: int = MIN_DOCUMENTS, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """The kept terms (lang, term, total, column) with `part` and `index`, their place in the order: terms with
    equal counts in every source are neighbours."""
    kept = columns.where(F.col("documents") >= min_documents).drop("documents")
    signature = F.xxhash64(F.array_sort("column"))
    kept = written(kept.select("*", F.size("column").alias("sources"), signature.alias("signature")), "kept-terms")
    parts = max(1, -(-kept.count() // chunk_terms))
    rows = sorted_rows(kept, ["lang", "total", "sources", "signature", "term"], "vocabulary", parts).drop("sources", "signature")
    discard(kept)
    return rows


def _runs(entries: DataFrame) -> DataFrame:
    """(lang, source, part, runs): stretches of equal counts along the order, absent terms left out. A place
    less its row number among the group's equal counts is the same all along a stretch."""
    place = F.row_number().over(Window.partitionBy("lang", "source", "part", "n").orderBy("index"))
    runs = entries.withColumn("_island", F.col("index") - place).groupBy("lang", "source", "part", "n", "_island").agg(F.min("index").alias("start"), F.count("*").alias("length"), F.first("p").alias("p"))
    return runs.groupBy("lang", "source", "part").agg(F.array_sort(F.collect_list(F.struct("start", "length", "p"))).alias("runs"))


def _filled(first: int, size: int, p0: int, starts: np.ndarray, lengths: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run starts and their shares over a whole chunk, zero runs put where none of the given ones is."""
    free = np.concatenate([[first], starts + lengths])
    gap = free < np.concatenate([starts, [first + size]])
    at = np.concatenate([starts, free[gap]])
    order = np.argsort(at)
    return at[order], np.concatenate([shares, np.full(gap.sum(), p0)])[order]


def _sums(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], end: int) -> tuple[int, int]:
    """The sums of f(a, b) and f(b, a): boundaries intersected, f of each stretch by its length."""
    if not len(a[0]):
        return 0, 0
    starts = np.union1d(a[0], b[0])
    lengths = np.diff(starts, append=end)
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    square = (p - q) ** 2
    return int((square // q * lengths).sum()), int((square // p * lengths).sum())


def pair_sums(columns: DataFrame, blocks: Column) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources: columns (lang, source, part, first, size,
    p0, runs, n_blocks) are dealt to pairs of source blocks, chunk by chunk."""
    own = F.pmod(F.xxhash64("source"), blocks)
    cells = columns.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    cells = cells.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(group: pa.Table) -> pa.Table:
        rows = group.select(["source", "own", "first", "size", "p0"]).to_pylist()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        lang = group.column("lang")[0].as_py()
        runs = group.column("runs").combine_chunks()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(runs), 0).to_numpy())[:-1]
        starts, lengths, shares = (np.split(pc.struct_field(runs.flatten(), k).to_numpy(), ends) for k in ("start", "length", "p"))
        filled = [_filled(r["first"], r["size"], r["p0"], *x) for r, *x in zip(rows, starts, lengths, shares)]
        out: list[tuple[str, str, str, int]] = []
        for i, r in enumerate(rows):
            for j in range(i):
                s = rows[j]
                if low != high and r["own"] == s["own"]:
                    continue
                there, back = _sums(filled[i], filled[j], r["first"] + r["size"])
                out += [(lang, r["source"], s["source"], there), (lang, s["source"], r["source"], back)]
        columns = zip(*out) if out else [[]] * 4
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "source", "item", "value"])

    sums = cells.groupBy("lang", "part", "low", "high").applyInArrow(compare, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, chunk_terms: int = CHUNK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank) as the module says; part is pair or term."""
    terms = vocabulary(term_columns(task_counts(docs)), min_documents, chunk_terms)
    chunks = terms.groupBy("lang", "part").agg(F.min("index").alias("first"), F.count("*").alias("size"), F.sum("total").alias("lang_n"))
    langs = chunks.groupBy("lang").agg(F.sum("size").alias("v"), F.sum("lang_n").alias("lang_n"))
    entries = terms.select("lang", "term", "total", "part", "index", F.inline("column"))
    held = entries.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = docs.select(*_named(docs)).distinct().join(held, ["lang", "source"], "left").join(small(langs), "lang", "left")
    sources = F.count("*").over(Window.partitionBy("lang"))
    groups = groups.select("lang", "source", F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("v", F.lit(0)).alias("v"), "lang_n", F.ceil(sources / block_sources).cast("long").alias("n_blocks"))
    groups = written(groups.withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0), F.col("group_n"), F.col("v"))).otherwise(1)), "term-groups")
    shared = entries.join(small(groups), ["lang", "source"])
    shared = written(shared.select("lang", "source", "term", "part", "index", "n", _share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"), _share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")), "term-shares")
    # a language without terms has one empty chunk, so that its pairs are there
    spread = groups.join(small(chunks.drop("lang_n")), "lang", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("part", "first", "size")})
    columns = spread.join(_runs(shared), ["lang", "source", "part"], "left")
    pairs = pair_sums(columns, F.col("n_blocks"))
    off = F.col("p") - F.col("q")
    over = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), F.call_function("div", off * off, F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")) for part, df in (("pair", pairs), ("term", over))]
    return ranked[0].union(ranked[1].where(F.col("rank") <= top_terms))

"""Profiling and data-quality reports over any layer.

Every report is one aggregate (partial on the map side, so hot values cost
nothing extra) or a grouped count followed by a bounded top-k; denominators
are scalar subqueries, so nothing but the small report reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.operators.frequent import most_frequent
from registrum.spec import AGE, INGESTED_AT, SECTOR, UNKNOWN_TEXT


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for several tables, one small aggregate each."""
    parts = [row_count(df).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def share(df: DataFrame, key, digits: int, total: int | None = None) -> DataFrame:
    """Count per key and its percentage of all rows, rounded to ``digits``.

    The denominator is a scalar subquery over the grouped counts, which share their
    exchange with it: the input is read once, and however many groups there are, none
    of them meet in one task. A known ``total`` may be passed instead.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    whole = counts.select(F.sum("count")).scalar() if total is None else F.lit(total)
    return counts.withColumn("percentage" if digits == 2 else "pct", F.round(F.col("count") * F.lit(100.0) / whole, digits))


def region_share(silver_etab: DataFrame) -> DataFrame:
    """Departments (first two postal characters) with count and percentage."""
    dept = F.substring("codePostalEtablissement", 1, 2).alias("dept")
    return share(silver_etab, dept, 2).orderBy("dept")


def top_values(df: DataFrame, column: str, k: int = 5, digits: int = 1) -> DataFrame:
    """Top-k values by frequency with their percentage; ties by value. Of a column with very many
    values only those are counted that can be among the k."""
    counts, total = most_frequent(df, column, k)
    share_of = F.round(F.col("count") * F.lit(100.0) / F.lit(total), digits)
    return counts.withColumn("percentage" if digits == 2 else "pct", share_of).orderBy(F.desc("count"), F.asc(column)).limit(k)


def top_values_tagged(df: DataFrame, dataset: str, column: str, k: int = 5) -> DataFrame:
    """``top_values`` as rows (dataset, column_name, value, count, pct)."""
    top = top_values(df, column, k, 1)
    return top.select(F.lit(dataset).alias("dataset"), F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"), "count", "pct")


def value_counts(df: DataFrame, column: str, k: int = 3) -> DataFrame:
    """pandas-style value_counts().head(k): NULL dropped, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
        .limit(k)
    )


def age_profile(df: DataFrame, column: str = AGE, exact_median: bool = True) -> DataFrame:
    """MIN, AVG (1 decimal), MAX and median of non-negative ages.

    Ages are whole years, so the exact median's value map is bounded by the
    number of distinct years; ``exact_median=False`` gives the approximate
    quantile (fixed-size sketch) for unbounded numeric columns.
    """
    c = F.col(column)
    med = F.median(c) if exact_median else F.percentile_approx(c, 0.5)
    return df.filter(c >= 0).agg(
        F.min(c).alias("min_age"),
        F.round(F.avg(c), 1).alias("avg_age"),
        F.max(c).alias("max_age"),
        med.alias("median_age"),
    )


def id_quality(df: DataFrame, id_column: str) -> DataFrame:
    """Totals, distinct and missing ids, share of undetermined sectors, and the
    uniqueness verdict (rows = distinct ids)."""
    total = F.count(F.lit(1))
    unique = F.count_distinct(id_column)
    undetermined = F.when(F.col(SECTOR) == UNKNOWN_TEXT, 1).otherwise(0)
    two_letter = F.when(F.col(SECTOR) == "In", 1).otherwise(0)
    return df.agg(
        total.alias("total_rows"),
        unique.alias("unique_ids"),
        (total - F.count(id_column)).alias("missing_ids"),
        F.round(F.avg(undetermined) * 100, 2).alias("pct_indeterminate_sector"),
        F.round(F.avg(two_letter) * 100, 2).alias("pct_in_sector"),
        (total == unique).alias("is_unique"),
    )


def load_span(df: DataFrame) -> DataFrame:
    """First and last load and the number of distinct batches."""
    return df.agg(
        F.min(INGESTED_AT).alias("first_load"),
        F.max(INGESTED_AT).alias("last_load"),
        F.count_distinct(INGESTED_AT).alias("batches"),
    )


def mean_positive(df: DataFrame, column: str = AGE) -> DataFrame:
    return df.filter(F.col(column) > 0).agg(F.avg(column).alias("avg_age"))


def null_percentages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_pct) for the given columns, one pass."""
    aggs = [F.avg(F.col(c).isNull().cast("double")) * 100 for c in columns]
    wide = df.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_pct)")


def _number(col: Column, kind: T.DataType) -> Column:
    """What orders the values of a numeric column; NULL for others, whose text orders them."""
    return col.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


def _text(col: Column, kind: T.DataType) -> Column:
    """A value as text; both zeros of a floating-point column are one."""
    return (col + F.lit(0.0).cast(kind)).cast("string") if isinstance(kind, (T.DoubleType, T.FloatType)) else col.cast("string")


def _cells(df: DataFrame) -> DataFrame:
    """(i, number, whole, value): one row per row and column."""
    kinds = [f.dataType for f in df.schema.fields]
    whole = lambda c, k: (F.col(c) if isinstance(k, T.IntegralType) else F.lit(None)).cast("long")
    cells = [F.struct(F.lit(i).alias("i"), _number(F.col(c), k).alias("number"), whole(c, k).alias("whole"), _text(F.col(c), k).alias("value")) for i, (c, k) in enumerate(zip(df.columns, kinds))]
    return df.select(F.inline(F.array(*cells)))


def _exact_profile(df: DataFrame) -> DataFrame:
    """Rows turned into (column, value), counted in each task before the one shuffle by both; distinct
    counts, minima and maxima are those of the grouping."""
    values = _cells(df).groupBy("i", "number", "whole", "value").agg(F.count(F.lit(1)).alias("n"))
    there = F.col("value").isNotNull()
    place = F.when(there, F.struct("number", "whole", "value"))
    by_column = values.groupBy("i").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).alias("nn"), F.count("value").alias("unique_count"),
        F.min(place).getField("value").alias("min"), F.max(place).getField("value").alias("max"),
    )
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "i int, column_name string")
    out = names.join(by_column, "i", "left")
    n, nn = (F.coalesce(c, F.lit(0)) for c in ("n", "nn"))
    share_null = F.round(F.lit(100.0) * (n - nn) / F.greatest(n, F.lit(1)), 2)
    return out.select("column_name", share_null.alias("null_percentage"), F.coalesce("unique_count", F.lit(0)).cast("long").alias("unique_count"), "min", "max")


def table_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """SUMMARIZE-like profile: per column null percentage, distinct count, min
    and max (as text).

    ``exact=False`` uses HyperLogLog (``approx_count_distinct``) in one plain
    partial aggregation at any size; ``exact=True`` counts distinct values
    exactly, by one grouping on (column, value).
    """
    if exact:
        return _exact_profile(df)
    cols = df.columns
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")]
    for i, c in enumerate(cols):
        col = F.col(c)
        aggs += [
            F.count(col).alias(f"nn{i}"),
            F.approx_count_distinct(col).alias(f"d{i}"),
            F.min(col).cast("string").alias(f"lo{i}"),
            F.max(col).cast("string").alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    rows = ", ".join(
        f"'{c}', round(100.0D * (_n - nn{i}) / greatest(_n, 1), 2), d{i}, lo{i}, hi{i}" for i, c in enumerate(cols)
    )
    out = wide.selectExpr(f"stack({len(cols)}, {rows}) AS (column_name, null_percentage, unique_count, min, max)")
    # both names of the sketch-based count, as profile readers expect either
    return out.select("column_name", "null_percentage", "unique_count", F.col("unique_count").alias("approx_unique"), "min", "max")


#: Hashes of a distinct-count sketch (2 ** 12: exact up to as many, then a standard error of 1.6 %; the union
#: keeps the smallest ones, so it does not depend on the cut), and size of a quantile sketch
#: (rank error about 0.1 %).
THETA_K, KLL_K = 12, 4096


def sketch_rows(df: DataFrame, by: str) -> DataFrame:
    """Mergeable profile of each part ``by`` (a bucket): rows, present values, minimum and maximum, a
    distinct-count sketch, and for numbers a quantile sketch, per column. Partial aggregation only."""
    fields = [f for f in df.schema.fields if f.name != by]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        text, number = _text(F.col(f.name), f.dataType), _number(F.col(f.name), f.dataType)
        aggs += [
            F.count(f.name).alias(f"nn{i}"), F.min(f.name).alias(f"lo{i}"), F.max(f.name).alias(f"hi{i}"),
            F.theta_sketch_agg(text, THETA_K).alias(f"d{i}"), F.kll_sketch_agg_double(number, KLL_K).alias(f"q{i}"),
        ]
    wide = df.groupBy(by).agg(*aggs)

    def edge(c: str, f: T.StructField) -> Column:
        return F.struct(_number(F.col(c), f.dataType).alias("number"), _text(F.col(c), f.dataType).alias("value"))

    cells = [
        F.struct(
            F.lit(i).alias("i"), F.lit(f.name).alias("column_name"), F.lit(isinstance(f.dataType, T.NumericType)).alias("numeric"),
            F.col(f"nn{i}").alias("nn"), edge(f"lo{i}", f).alias("lo"), edge(f"hi{i}", f).alias("hi"), F.col(f"d{i}").alias("d"), F.col(f"q{i}").alias("q"),
        )
        for i, f in enumerate(fields)
    ]
    return wide.select(by, "rows", F.inline(F.array(*cells)))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of the whole from the sketches of its parts, without reading the table: null percentage,
    distinct count (estimated), min, max and the median of numbers (estimated). However the table was cut, the
    distinct-count sketch of the whole is the same."""
    held = F.col("nn") > 0
    merged = sketches.groupBy("i", "column_name", "numeric").agg(
        F.sum("rows").alias("n"), F.sum("nn").alias("nn"),
        F.min(F.when(held, F.col("lo"))).getField("value").alias("min"), F.max(F.when(held, F.col("hi"))).getField("value").alias("max"),
        F.theta_sketch_estimate(F.theta_union_agg("d", THETA_K)).alias("approx_unique"),
        F.kll_merge_agg_double(F.when(F.col("numeric") & held, F.col("q"))).alias("q"),
    )
    median = F.when(F.col("numeric") & (F.col("nn") > 0), F.kll_sketch_get_quantile_double("q", F.lit(0.5)))
    share_null = F.round(F.lit(100.0) * (F.col("n") - F.col("nn")) / F.greatest(F.col("n"), F.lit(1)), 2)
    return merged.select("column_name", share_null.alias("null_percentage"), "approx_unique", "min", "max", median.alias("median"))


def expected_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, data_type, present, null_pct) for every column of ``df``
    plus each wanted name it lacks; the null percentages come from one
    aggregate pass over the data."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = list(df.columns)
    missing = [n for n in names if n not in types]
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = [f"'{c}', '{types[c]}', true, c{i}" for i, c in enumerate(cols)]
    rows += [f"'{n}', CAST(NULL AS STRING), false, CAST(NULL AS DOUBLE)" for n in missing]
    return wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (column_name, data_type, present, null_pct)")


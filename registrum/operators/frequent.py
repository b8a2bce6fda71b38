"""Frequent values of a column with very many, exactly and without counting every value.

One pass counts the rows per hash class of the value (``CLASSES`` of them, added up in each task, so the
shuffle is as small whatever the column holds). A class count bounds the count of every value in it: values
that can be frequent lie in the few classes that hold enough rows, and only the rows of those classes are
grouped by value in a second pass. Nothing is estimated and no value is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = 65_536


def value_class(column: str, classes: int = CLASSES) -> Column:
    """The hash class of a value; NULL has one like any other."""
    return F.pmod(F.xxhash64(column), F.lit(classes)).cast("int")


def class_counts(df: DataFrame, column: str, classes: int = CLASSES) -> dict[int, int]:
    """Rows per class: at most ``classes`` numbers, whatever the size of the table."""
    rows = df.select(value_class(column, classes).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["c"]: r["n"] for r in rows}


def counted(df: DataFrame, column: str, wanted: list[int], classes: int = CLASSES) -> DataFrame:
    """(column, count) of the values in the wanted classes."""
    some = df.select(column)
    if len(wanted) < classes:
        some = some.filter(value_class(column, classes).isin(wanted))
    return some.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def holding(df: DataFrame, column: str, share: float, min_rows: int = 0, classes: int = CLASSES) -> DataFrame:
    """(column, count) of the present values that hold at least ``share`` of all rows (those with NULL
    included) and ``min_rows`` rows: never more than 1 / share values."""
    found = class_counts(df, column, classes)
    least = max(sum(found.values()) * share, min_rows, 1)
    wanted = sorted(c for c, n in found.items() if n >= least)
    if not wanted:
        return df.select(column, F.lit(0).cast("long").alias("count")).limit(0)
    return counted(df.filter(F.col(column).isNotNull()), column, wanted, classes).filter(F.col("count") >= F.lit(least))


def most_frequent(df: DataFrame, column: str, k: int, classes: int = CLASSES) -> tuple[DataFrame, int]:
    """((column, count) with the k most frequent values among its rows, all rows): the values of the k
    fullest classes are counted first. Whatever is in a class that holds fewer rows than the k-th of them
    cannot be among the k; if other classes hold as many, they are counted too, once."""
    found = class_counts(df, column, classes)
    order = sorted(found, key=lambda c: (-found[c], c))
    wanted = order[:k]
    if len(order) > k:
        counts = counted(df, column, wanted, classes).orderBy(F.desc("count")).limit(k).select("count").collect()
        least = counts[-1]["count"] if len(counts) == k else 0
        wanted = [c for i, c in enumerate(order) if i < k or found[c] >= least]
    return counted(df, column, sorted(wanted), classes), sum(found.values())

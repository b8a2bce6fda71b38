"""Silver contract: type coercion, row rules, uniqueness and the closed column set.

All row rules are evaluated in one aggregate pass; uniqueness is one grouped
count on the key. The gate raises before anything is published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.functions.columns import exact_digits
from registrum.spec import DatasetSpec


class SchemaViolation(ValueError):
    """The data does not satisfy the Silver contract."""


class DuplicateKeys(SchemaViolation):
    """The only violated rules are key uniqueness rules."""


def check_columns(df: DataFrame, spec: DatasetSpec) -> None:
    """Closed column set: an extra or a missing column fails."""
    want, have = set(spec.silver_columns), set(df.columns)
    extra, missing = sorted(have - want), sorted(want - have)
    if extra or missing:
        raise SchemaViolation(f"{spec.name}: extra columns {extra}, missing columns {missing}")


def coerce(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Cast every column to its contract type (try_cast: a failure becomes NULL;
    ``coerce_failures`` counts them beforehand)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def coerce_failures(df: DataFrame, spec: DatasetSpec) -> list[tuple[str, Column]]:
    """(rule, condition) for each column whose values may not cast to its contract type:
    the value is there and its cast is not."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        (f"{f.name}:coerce", F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        for f in spec.schema.fields
        if f.name in types and types[f.name] != f.dataType
    ]


def coerce_metrics(df: DataFrame, spec: DatasetSpec) -> list[Column]:
    """The counts of ``coerce_failures`` as observable metrics, named by rule."""
    return [F.count_if(cond).alias(rule) for rule, cond in coerce_failures(df, spec)]


def require_coerced(counts: dict[str, int], spec: DatasetSpec) -> None:
    bad = {k: int(v) for k, v in counts.items() if k.endswith(":coerce") and v}
    if bad:
        raise SchemaViolation(f"{spec.name}: values that do not fit their column's type: {bad}")


def _rule_checks(df: DataFrame, spec: DatasetSpec) -> list[tuple[str, Column]]:
    checks = coerce_failures(df, spec)
    for r in spec.rules:
        c = F.col(r.column)
        if not r.nullable:
            checks.append((f"{r.column}:not_null", c.isNull()))
        if r.length is not None:
            checks.append((f"{r.column}:str_length", c.isNotNull() & (F.length(c) != r.length)))
        if r.digits is not None:
            checks.append((f"{r.column}:str_matches", c.isNotNull() & ~exact_digits(c, r.digits)))
    return checks


def _rule_aggregate(df: DataFrame, spec: DatasetSpec, extra: Sequence[Column] = ()):
    checks = _rule_checks(df, spec)
    agg = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)], *extra)
    return checks, agg


def rule_violations(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(rule, violations) for every row rule, one pass over the data."""
    checks, agg = _rule_aggregate(df, spec)
    pairs = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(checks))
    return agg.selectExpr(f"stack({len(checks)}, {pairs}) AS (rule, violations)")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def uniqueness_violations(df: DataFrame, spec: DatasetSpec) -> dict[str, int]:
    out = {}
    for r in spec.rules:
        if r.unique:
            dups = duplicate_keys(df.filter(F.col(r.column).isNotNull()), [r.column])
            out[f"{r.column}:unique"] = int(dups.agg(F.count(F.lit(1))).first()[0])
    return out


def validate(df: DataFrame, spec: DatasetSpec, facts: Sequence[Column] = ()) -> tuple[dict[str, int], dict]:
    """Gate: raise ``SchemaViolation`` if any rule fails, else return the
    per-rule counts (all zero) and the values of the ``facts`` aggregates,
    which ride along in the same pass as the row rules."""
    check_columns(df, spec)
    checks, agg = _rule_aggregate(df, spec, facts)
    row = agg.first().asDict()
    counts = {name: int(row.pop(f"c{i}")) for i, (name, _) in enumerate(checks)}
    counts.update(uniqueness_violations(df, spec))
    bad = {k: v for k, v in counts.items() if v}
    if bad:
        only_keys = all(k.endswith(":unique") for k in bad)
        raise (DuplicateKeys if only_keys else SchemaViolation)(f"{spec.name}: contract violated: {bad}")
    return counts, row

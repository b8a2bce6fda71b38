"""Silver cleaning: increment selection, key/postal filters, typing, fills and
engineered columns. Each step is ``DataFrame -> DataFrame`` for ``df.transform``;
the whole chain is narrow (no shuffle)."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.functions.columns import (
    DATE_SPELLINGS,
    age_in_years,
    clamp_date,
    exact_digits,
    first_chars,
    lenient_timestamp,
    ntz,
    prefix_in,
    spelled_timestamp,
    strip_whitespace,
)
from registrum.spec import (
    AGE,
    BATCH_ID,
    DEFAULT_FILLS,
    DEPARTMENT,
    INGESTED_AT,
    SECTOR,
    UNKNOWN_TEXT,
    DatasetSpec,
)

EPOCH = datetime(1970, 1, 1)


def batch_id_of(ts: datetime) -> int:
    """Bronze partition id of an audit timestamp: microseconds since epoch."""
    delta = ts - EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def increment_predicates(df: DataFrame, spec: DatasetSpec, mark: datetime, departments: Sequence[str]) -> list[Column]:
    """Mark predicate (strictly greater) and, for establishments, the region
    predicate on the raw postal code. A ``batch_id`` partition column, when
    present, gets the same mark so whole batches are pruned at listing time."""
    preds = [F.col(INGESTED_AT) > ntz(mark)]
    if BATCH_ID in df.columns:
        preds.append(F.col(BATCH_ID) > F.lit(batch_id_of(mark)))
    if spec.region_filtered and departments and spec.postal_column:
        wrong = [d for d in departments if len(d) != 2]
        if wrong:
            raise ValueError(f"a department is the first two characters of a postal code, not {wrong}")
        preds.append(prefix_in(F.col(spec.postal_column), departments))
    return preds


Spellings = dict[str, Sequence[str]]


def date_spellings(df: DataFrame) -> Spellings:
    """The spellings in which the text date columns hold days that ISO does not read, most frequent
    first: one aggregate over those columns. Day first and month first exclude each other: the one that
    reads more rows is taken (day first if both read the same)."""
    texts = [c for c in date_columns(df) if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return {}
    counts = []
    for c in texts:
        text = strip_whitespace(F.col(c))
        other = text.isNotNull() & text.try_cast("timestamp_ntz").isNull()
        counts += [F.count_if(other & spelled_timestamp(text, s).isNotNull()).alias(f"{c}:{s}") for s in DATE_SPELLINGS]
    found = df.agg(*counts).first().asDict()
    out = {}
    for c in texts:
        rows = {s: found[f"{c}:{s}"] for s in DATE_SPELLINGS}
        rows.pop("month first" if rows["day first"] >= rows["month first"] else "day first")
        if chosen := sorted((s for s in rows if rows[s]), key=lambda s: -rows[s]):
            out[c] = tuple(chosen)
    return out


def select_increment(
    bronze: DataFrame, spec: DatasetSpec, mark: datetime, departments: Sequence[str], spellings: Spellings | None = None
) -> DataFrame:
    """Rows newer than ``mark`` (and in the region), configured columns only,
    creation date clamped to the supported range. A creation date that comes as
    text is parsed before it is clamped, so a malformed one is NULL."""
    cond = functools.reduce(operator.and_, increment_predicates(bronze, spec, mark, departments))
    types = {f.name: f.dataType for f in bronze.schema.fields}

    def creation(c: str) -> Column:
        col = F.col(c)
        return clamp_date(lenient_timestamp(col, types[c], (spellings or {}).get(c, ())) if isinstance(types[c], T.StringType) else col).alias(c)

    cols = [creation(c) if c == spec.date_column else F.col(c) for c in spec.selected_columns]
    return bronze.filter(cond).select(*cols)


def drop_null_keys(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.dropna(how="any", subset=list(spec.id_columns))


def clean_postal(df: DataFrame, spec: DatasetSpec, observation: Observation | None = None) -> DataFrame:
    """Trim the postal code and keep exactly five ASCII digits (NULL dropped).

    With an ``Observation`` the number of rejected rows is reported as the
    metric ``rejected_postal`` at no extra pass over the data.
    """
    col = spec.postal_column
    if not col or col not in df.columns:
        return df
    trimmed = df.withColumn(col, strip_whitespace(F.col(col)))
    flagged = trimmed.withColumn("_valid_postal", exact_digits(F.col(col), 5))
    if observation is not None:
        flagged = flagged.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(~F.col("_valid_postal")).alias("rejected_postal"),
        )
    return flagged.filter(F.col("_valid_postal")).drop("_valid_postal")


def date_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower() or INGESTED_AT in c]


def parse_dates(df: DataFrame, spellings: Spellings | None = None) -> DataFrame:
    """Every date-like column becomes TIMESTAMP_NTZ; unparseable -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: lenient_timestamp(F.col(c), types[c], (spellings or {}).get(c, ())) for c in date_columns(df)})


def fill_defaults(df: DataFrame) -> DataFrame:
    present = {c: v for c, v in DEFAULT_FILLS.items() if c in df.columns}
    return df.fillna(present) if present else df


def engineer(df: DataFrame, spec: DatasetSpec, as_of_year: int) -> DataFrame:
    """departement, secteur_activite and age_entreprise."""
    new = {}
    if spec.postal_column and spec.postal_column in df.columns:
        new[DEPARTMENT] = first_chars(F.col(spec.postal_column), 2)
    if spec.activity_column in df.columns:
        new[SECTOR] = first_chars(F.col(spec.activity_column), 2)
    if spec.date_column in df.columns:
        new[AGE] = age_in_years(F.col(spec.date_column), as_of_year)
    return df.withColumns(new)


def fill_strings(df: DataFrame) -> DataFrame:
    """Remaining NULLs in string columns -> 'Indéterminé' (booleans stay NULL)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(UNKNOWN_TEXT, subset=strings) if strings else df


def clean_increment(
    df: DataFrame, spec: DatasetSpec, as_of_year: int, observation: Observation | None = None, spellings: Spellings | None = None
) -> DataFrame:
    """The Silver cleaning chain, in the reference's order."""
    return (
        df.transform(drop_null_keys, spec)
        .transform(clean_postal, spec, observation)
        .transform(parse_dates, spellings)
        .transform(fill_defaults)
        .transform(engineer, spec, as_of_year)
        .transform(fill_strings)
    )


def silver_increment(
    bronze: DataFrame,
    spec: DatasetSpec,
    mark: datetime,
    departments: Sequence[str],
    as_of_year: int,
    observation: Observation | None = None,
    spellings: Spellings | None = None,
) -> DataFrame:
    """select_increment + clean_increment: new Silver rows from Bronze."""
    return clean_increment(select_increment(bronze, spec, mark, departments, spellings), spec, as_of_year, observation, spellings)


def postal_audit(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows in, postal codes valid after trimming, rows the filter rejects."""
    valid = exact_digits(strip_whitespace(F.col(spec.postal_column)), 5)
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("rejected"),
    )

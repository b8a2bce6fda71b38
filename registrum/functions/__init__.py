"""Column-expression helpers (all built-in Spark functions, codegen-friendly)."""

from registrum.functions.columns import (
    age_in_years,
    clamp_date,
    exact_digits,
    first_chars,
    lenient_timestamp,
    ntz,
    prefix_in,
    sample_key,
    strip_whitespace,
)

__all__ = [
    "age_in_years",
    "clamp_date",
    "exact_digits",
    "first_chars",
    "lenient_timestamp",
    "ntz",
    "prefix_in",
    "sample_key",
    "strip_whitespace",
]

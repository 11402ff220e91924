"""Column expressions used across the engine.  All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default nudge before flooring expm1(log1p(n)): without it, floating error
# turns an integer n into n - 1 for roughly 40% of integers.
INVERSE_EPS = 1e-9


def col(name: str) -> Column:
    """Column reference that tolerates dots and spaces in the name."""
    return F.col(f"`{name}`")


def first_digit_run(c: Column) -> Column:
    """First run of digits in the string form of ``c`` as a double; NULL when
    the value is NULL or has no digits.  (Under ANSI mode a bare cast of ''
    raises, hence the ``nullif``.)"""
    digits = F.regexp_extract(c.cast("string"), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).cast("double")


def log_target(c: Column) -> Column:
    return F.log1p(c)


def inverse_log_target(c: Column, eps: float = INVERSE_EPS) -> Column:
    """floor(expm1(x)) with a small nudge; result is a double like the
    original's NumPy floor."""
    return F.floor(F.expm1(c) + F.lit(eps)).cast("double")


def clip_nonneg(c: Column) -> Column:
    """Clip at zero from below; NULL stays NULL."""
    return F.when(c.isNull(), c).otherwise(F.greatest(c, F.lit(0.0)))


def hash_unit(key: Column, salt: str) -> Column:
    """Deterministic value in [0, 1) from a key: the first 32 bits of
    md5('<salt>:<key>').  The same row lands in the same place on every run,
    on any partitioning, and DuckDB can compute the identical value."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string"))), 1, 8), 16, 10)
    return h.cast("double") / F.lit(4294967296.0)


def hash_bucket(key: Column, salt: str, buckets: int) -> Column:
    """Deterministic bucket 0..buckets-1 from the same 32-bit md5 prefix."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string"))), 1, 8), 16, 10)
    return (h.cast("bigint") % F.lit(buckets)).cast("int")


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den with 0/0 and x/0 mapped to ``default`` (ANSI raises)."""
    q = F.try_divide(num, den)
    return q if default is None else F.coalesce(q, F.lit(default))

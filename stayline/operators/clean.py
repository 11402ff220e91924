"""Cleaning and imputation (drop listed columns, extract frailty digits,
fill per-column defaults).  Pure projections: no shuffle, and Catalyst prunes
the dropped columns out of the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RoleConfig
from ..functions.scalar import col, first_digit_run


def drop_listed(df: DataFrame, cfg: RoleConfig) -> DataFrame:
    """Drop the configured columns that exist; missing names are ignored."""
    present = cfg.present(cfg.drop_list(), df.columns)
    return df.drop(*present) if present else df


def extract_frailty(df: DataFrame, cfg: RoleConfig) -> DataFrame:
    """Replace the frailty text (e.g. "6 - ...") with its first digit run."""
    names = cfg.present([cfg.frailty_col], df.columns)
    if not names:
        return df
    name = names[0]
    return df.withColumn(name, first_digit_run(col(name)))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in floating columns, so that one missing marker
    remains (the pandas original treats both alike)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = col(f.name)
            exprs.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            exprs.append(col(f.name))
    return df.select(*exprs)


def _fill_value(value, dtype: T.DataType):
    """Coerce a default to the column's type, refusing silent re-typing (a
    number into a string column, text into a numeric column)."""
    if isinstance(dtype, T.StringType):
        if not isinstance(value, str):
            raise TypeError(f"number {value!r} as default of a string column")
        return value
    if isinstance(dtype, T.NumericType):
        if isinstance(value, str):
            raise TypeError(f"text default {value!r} for numeric column of type {dtype}")
        if isinstance(dtype, T.IntegralType) and isinstance(value, float) and not float(value).is_integer():
            raise TypeError(f"fractional default {value!r} for integer column")
        return value
    if isinstance(dtype, T.BooleanType):
        return bool(value)
    raise TypeError(f"no default supported for type {dtype}")


def fill_defaults(df: DataFrame, cfg: RoleConfig) -> DataFrame:
    """Fill NULL (and NaN) with the configured per-column constants, for the
    columns that exist."""
    defaults = cfg.defaults_for(df.columns)
    if not defaults:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for name in df.columns:
        if name in defaults:
            dtype = types[name]
            v = _fill_value(defaults[name], dtype)
            c = col(name)
            if isinstance(dtype, (T.DoubleType, T.FloatType)):
                c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
            exprs.append(F.coalesce(c, F.lit(v).cast(dtype)).alias(name))
        else:
            exprs.append(col(name))
    return df.select(*exprs)


def clean(df: DataFrame, cfg: RoleConfig) -> DataFrame:
    """drop → frailty digits → NaN to NULL."""
    return nan_to_null(extract_frailty(drop_listed(df, cfg), cfg))


def clean_and_impute(df: DataFrame, cfg: RoleConfig) -> DataFrame:
    return fill_defaults(clean(df, cfg), cfg)


__all__ = ["drop_listed", "extract_frailty", "nan_to_null", "fill_defaults",
           "clean", "clean_and_impute"]

"""Numeric column helpers with the pandas/numpy semantics the pipeline is defined by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text pandas ``to_numeric`` accepts: a decimal literal with optional surrounding spaces,
# or an infinity spelled inf/infinity in any case without spaces.  Unit suffixes such as
# '1d' (which Spark's cast would read as a double literal), '1_000' and '0x10' are
# rejected; 'nan' parses to NaN, which becomes 0 like a null.
_NUMERIC_TEXT = r"^(\s*[+-]?((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?\s*|[+-]?(?i:inf|infinity))$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_numeric_zero(col, dtype: str = "double") -> Column:
    """``pd.to_numeric(x, errors='coerce').fillna(0)``: unparsable, null and NaN become 0."""
    c = _c(col)
    as_text = c.cast("string")
    parsed = F.when(as_text.rlike(_NUMERIC_TEXT), F.trim(as_text).try_cast("double"))
    clean = F.nanvl(parsed, F.lit(None).cast("double"))
    return F.coalesce(clean, F.lit(0.0)).cast(dtype)


def numeric_or_zero(col, dtype: str = "double") -> Column:
    """Same as :func:`to_numeric_zero` for columns that are already numeric (no text parse)."""
    c = _c(col).cast("double")
    return F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(0.0)).cast(dtype)


def safe_ratio(num, den) -> Column:
    """``where(den > 0, num / maximum(den, 1), 0.0)``."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n / F.greatest(d, F.lit(1.0))).otherwise(F.lit(0.0))


def clip_scalar(col, lo: float, hi: float) -> Column:
    """``np.clip(x, lo, hi)`` with scalar bounds (lo <= hi)."""
    return F.least(F.greatest(_c(col), F.lit(lo)), F.lit(hi))


def clip_columns(col, lo, hi) -> Column:
    """``np.clip(series, lo_series, hi_series)`` as pandas 2.x evaluates it.

    Both bounds are tested against the original value: above ``hi`` gives ``hi``,
    otherwise below ``lo`` gives ``lo`` (so x=5, lo=10, hi=7 gives 10, x=8 gives 7).
    A null bound is no bound.
    """
    x, lo_c, hi_c = _c(col), _c(lo), _c(hi)
    return (F.when(hi_c.isNotNull() & (x > hi_c), hi_c)
            .when(lo_c.isNotNull() & (x < lo_c), lo_c)
            .otherwise(x))


def excluded_flag(col) -> Column:
    """``astype(str).str.upper() == 'Y'``; null is not excluded, no trimming."""
    return F.coalesce(F.upper(_c(col).cast("string")) == F.lit("Y"), F.lit(False))


def coerce_numeric(df, cols, dtype: str = "double") -> dict:
    """Column map coercing each present column to a number with nulls/NaN/unparsable as 0:
    numeric columns are cast directly, text columns are parsed."""
    from pyspark.sql.types import NumericType
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in cols:
        if c not in types:
            continue
        out[c] = numeric_or_zero(c, dtype) if isinstance(types[c], NumericType) else to_numeric_zero(c, dtype)
    return out

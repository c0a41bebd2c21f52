"""Payment-history parsing as native column expressions.

A 12-character string holds one status character per cycle.  Each character maps to a
delinquency level 0-7; some letters are also external risk statuses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Character -> delinquency level, and the risk status letters.
#   level 0: A I Q Z 0 # % + -        level 4: E M U 4
#   level 1: B J 1                    level 5: F N 5
#   level 2: C K 2                    level 6: G O 6
#   level 3: D L 3                    level 7: H P 7
#   risk statuses: B C E F L U
# Any other character is level 0.
# ---------------------------------------------------------------------------------------
LEVEL_CHARS = {
    1: "BJ1",
    2: "CK2",
    3: "DL3",
    4: "EMU4",
    5: "FN5",
    6: "GO6",
    7: "HP7",
}
RISK_STATUS_CHARS = "BCEFLU"

_DELINQUENT_CLASS = "[" + "".join(LEVEL_CHARS[k] for k in sorted(LEVEL_CHARS)) + "]"


def _upper(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(F.coalesce(c.cast("string"), F.lit("")))


def delinquent_cycle_count(col) -> Column:
    """Number of characters whose level is above 0."""
    return F.regexp_count(_upper(col), F.lit(_DELINQUENT_CLASS)).cast("int")


def max_delinquency_level(col) -> Column:
    """Highest level present in the string (0 when none)."""
    s = _upper(col)
    expr = F.lit(0)
    for level in sorted(LEVEL_CHARS):  # ascending, so the highest match is applied last
        expr = F.when(F.regexp_like(s, F.lit(f"[{LEVEL_CHARS[level]}]")), F.lit(level)).otherwise(expr)
    return expr.cast("int")


def risk_flag_count(col) -> Column:
    """Number of characters that are external risk statuses."""
    return F.regexp_count(_upper(col), F.lit(f"[{RISK_STATUS_CHARS}]")).cast("int")


def payment_history_columns(col: str = "payment_hist_1_12_mths") -> dict[str, Column]:
    return {
        "delinquent_cycle_count": delinquent_cycle_count(col),
        "max_delinquency_level": max_delinquency_level(col),
        "risk_flag_count": risk_flag_count(col),
    }


def add_payment_history_features(df, col: str = "payment_hist_1_12_mths"):
    return df.withColumns(payment_history_columns(col))

"""Categorical helpers: external status description, sentinel imputation, dates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# External status reason code -> description ('0' is the normal status).
# ---------------------------------------------------------------------------------------
EXT_STATUS = {
    "0": "Normal",
    "A": "Authorization Prohibited",
    "B": "Bankrupt",
    "C": "Closed",
    "E": "Revoked",
    "F": "Frozen",
    "I": "Interest Accrual Prohibited",
    "L": "Lost",
    "U": "Stolen",
    "Z": "Charged Off",
}


def external_status_desc(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(EXT_STATUS.items())])
    return F.coalesce(F.try_element_at(mapping, c.cast("string")), F.lit("Unknown"))


def map_external_status(df: DataFrame, col: str = "external_status_reason_code") -> DataFrame:
    return df.withColumn("ext_status_desc", external_status_desc(col))


def impute_sentinel(df: DataFrame, col: str, sentinel: str = "MISSING") -> DataFrame:
    """Cast to text; missing becomes the sentinel."""
    return df.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit(sentinel)))


# Formats tried in order when parsing date text.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd")


def parse_timestamp(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    text = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in DATE_FORMATS])


def parse_dates(df: DataFrame, cols) -> DataFrame:
    """Coerce listed columns to timestamps; unparsable -> null; absent columns skipped."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: parse_timestamp(c) for c in present})


def extract_month(df: DataFrame, date_col: str, new_col: str = "year_month") -> DataFrame:
    """Year-month text (``yyyy-MM``) of a date column; unparsable -> null."""
    return df.withColumn(new_col, F.date_format(parse_timestamp(date_col), "yyyy-MM"))

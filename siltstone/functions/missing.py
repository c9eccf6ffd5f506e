"""What a missing value is, in files and in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.types import is_fractional

# Text that CSV readers of the pandas family take as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Trimmed text that the record checks take as missing.
BLANK_TOKENS = ("", "None", "null")


def na_tokens_to_null(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN apart from null; the layers hold null only."""
    if not any(is_fractional(f.dataType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
            if is_fractional(f.dataType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def is_null(col: Column, data_type: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    if is_fractional(data_type):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def is_missing(col: Column, data_type: T.DataType) -> Column:
    """Null, NaN, or text that stands for nothing. Zero and false are values."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(strip(col).isin(*BLANK_TOKENS), F.lit(True))
    return is_null(col, data_type)


# White space of all kinds, in ASCII and beyond.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Drop white space of every kind at both ends (plain `trim` drops blanks only)."""
    return F.btrim(col, F.lit(WHITE_SPACE))

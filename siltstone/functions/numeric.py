"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number in text. A plain try_cast would also take Java
# suffixes ("1d", "2f") and the word "NaN".
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(col: Column, data_type: T.DataType) -> Column:
    """Numeric columns as they are (NaN becomes null), text that is no number becomes null."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    if isinstance(data_type, T.NumericType):
        return col
    if isinstance(data_type, T.BooleanType):
        return col.cast("int")
    text = col.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole in percent, ties to even, 0 for an empty whole."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100
    return F.coalesce(F.bround(share, digits), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))

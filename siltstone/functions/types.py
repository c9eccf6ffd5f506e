"""Type families and the names used for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def family(data_type: T.DataType) -> str:
    """numeric / string / datetime / boolean / other."""
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, T.StringType):
        return "string"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "other"


def columns_of(df: DataFrame, *families: str) -> list[str]:
    return [f.name for f in df.schema.fields if family(f.dataType) in families]


def is_fractional(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))

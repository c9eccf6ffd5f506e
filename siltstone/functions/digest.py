"""Short stand-ins for values and rows where only equality matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.types import is_fractional

# Text of this many characters or more travels as its SHA-256, which has
# exactly this many; shorter text travels as it is, so the two cannot meet.
DIGEST_LENGTH = 64


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def compact(col: Column, data_type: T.DataType) -> Column:
    """A value that is equal exactly where `col` is equal, and never long.

    Grouping or counting pages of text by this shuffles 64 bytes a row, not the
    pages.
    """
    if isinstance(data_type, T.StringType):
        return F.when(F.length(col) >= DIGEST_LENGTH, F.sha2(col, 256)).otherwise(col)
    if isinstance(data_type, T.BinaryType):
        return F.when(F.length(col) >= DIGEST_LENGTH, F.unhex(F.concat(F.sha2(col, 256), F.sha2(F.hex(col), 256)))).otherwise(col)
    return col


def compact_row(df: DataFrame, whole: Sequence[str] = ()) -> list[Column]:
    """The row's columns, long text shortened but for the columns in `whole`."""
    return [
        (F.col(quoted(f.name)) if f.name in whole else compact(F.col(quoted(f.name)), f.dataType)).alias(f.name)
        for f in df.schema.fields
    ]


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """A SHA-256 of some columns in which their borders, order and nulls count.

    Each value is written with its length before it, so ("ab", "c") and
    ("a", "bc") differ, and so do null and empty text.
    """
    parts = []
    for c in columns:
        data_type, col = df.schema[c].dataType, F.col(quoted(c))
        if isinstance(data_type, T.BinaryType):
            text = F.hex(col)
        elif isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(col), {"ignoreNullFields": "false"})
        elif is_fractional(data_type):
            # -0.0 and 0.0 are one value.
            text = (col + F.lit(0).cast(data_type)).cast("string")
        else:
            text = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.sha2(F.concat(F.lit(""), *parts), 256)

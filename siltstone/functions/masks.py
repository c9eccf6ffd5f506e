"""Column expressions that hide personal values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.missing import is_missing, strip

STRATEGIES = ("sha256", "sha256_short", "redact", "sentinel", "partial")


def sha256_hex(col: Column) -> Column:
    """64 hex digits, unsalted; null stays null."""
    return F.sha2(col.cast("string"), 256)


def mask(
    col: Column,
    data_type: T.DataType,
    strategy: str,
    *,
    name: str = "",
    salt: str = "",
) -> Column:
    """Mask present values; null, blank, `None` and `null` pass through as text."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown masking strategy {strategy!r}, choose from {STRATEGIES}")
    text = col.cast("string")
    value = strip(text)
    if strategy == "sha256":
        return sha256_hex(col)
    if strategy == "sha256_short":
        hidden = F.substring(F.sha2(F.concat(F.lit(salt), value), 256), 1, 16)
    elif strategy == "redact":
        hidden = F.lit("[REDACTED]")
    elif strategy == "sentinel":
        hidden = F.lit("MASKED_" + name.upper()[:10])
    else:
        size = F.length(value)
        hidden = F.when(size <= 4, F.lit("****")).otherwise(
            F.concat(F.left(value, F.lit(2)), F.repeat(F.lit("*"), size - 4), F.right(value, F.lit(2)))
        )
    return F.when(is_missing(col, data_type), text).otherwise(hidden)

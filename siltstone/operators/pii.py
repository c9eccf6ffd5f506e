"""Masking several columns of a table, with a log that shows no original value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.masks import mask
from siltstone.functions.missing import is_missing
from siltstone.functions.names import match_columns
from siltstone.operators.keys import q


def mask_columns(df: DataFrame, columns: Sequence[str], strategy: str = "sha256_short", *, salt: str = "") -> DataFrame:
    """Columns are found by exact name, else by name but for case and blanks."""
    wanted = set(match_columns(columns, df.columns))
    return df.select(
        *[
            mask(F.col(q(f.name)), f.dataType, strategy, name=f.name, salt=salt).alias(f.name)
            if f.name in wanted
            else F.col(q(f.name))
            for f in df.schema.fields
        ]
    )


def masking_log(df: DataFrame, columns: Sequence[str], strategy: str = "sha256_short") -> DataFrame:
    """Per masked column the number of values that were hidden, from the table before masking."""
    wanted = match_columns(columns, df.columns)
    aggs = [
        F.count_if(~is_missing(F.col(q(c)), df.schema[c].dataType)).alias(f"_m{i}") for i, c in enumerate(wanted)
    ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(strategy).alias("strategy"),
            F.col(f"_m{i}").alias("rows_masked"),
            F.lit(f"PII column '{c}' masked using {strategy} strategy").alias("note"),
        )
        for i, c in enumerate(wanted)
    ]
    if not wanted:
        return df.sparkSession.createDataFrame([], "column string, strategy string, rows_masked bigint, note string")
    return df.agg(*aggs).select(F.inline(F.array(*rows)))

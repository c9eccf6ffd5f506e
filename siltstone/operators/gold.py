"""Gold as a copy of silver or as an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.types import columns_of
from siltstone.operators.keys import q


def split_columns(text: str | Sequence[str]) -> list[str]:
    parts = text.split(",") if isinstance(text, str) else text
    return [p.strip() for p in parts if p.strip()]


def build_gold(
    df: DataFrame,
    group_by: str | Sequence[str] = "",
    *,
    dropna: bool = True,
    exclude: Sequence[str] = (),
) -> tuple[DataFrame, str]:
    """Sum every other numeric column per group and count its rows; the note says what was done.

    Without a group column the table has, or without numbers, gold is silver
    with a count of 1. Groups with a null key are left out unless `dropna` is
    false; a group without values sums to 0. `exclude` keeps ids out of the sums.
    """
    wanted = split_columns(group_by)
    copy = df.withColumn("_record_count", F.lit(1).cast("bigint"))
    if not wanted or [w.lower() for w in wanted] in (["none"], ["no"]):
        return copy, "No aggregation — Gold = Silver"
    numeric = columns_of(df, "numeric")
    if not numeric:
        return copy, "No numeric columns found for aggregation — Gold = Silver"
    keys = [w for w in wanted if w in df.columns]
    if not keys:
        return copy, f"Aggregation column(s) not found in schema: {', '.join(wanted)} — Gold = Silver"
    sums = [c for c in numeric if c not in keys and c not in exclude]
    source = df.na.drop("any", subset=keys) if dropna else df
    gold = source.groupBy(*[F.col(q(k)) for k in keys]).agg(
        *[F.coalesce(F.sum(q(c)), F.lit(0)).alias(c) for c in sums],
        F.count(F.lit(1)).alias("_record_count"),
    )
    return gold, f"Aggregated by {keys}"


def merge_groups(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregates of several loads as one: the sums and counts of a group add up, in the types they have."""
    sums = [f for f in parts.schema.fields if f.name not in keys]
    return parts.groupBy(*[F.col(q(k)) for k in keys]).agg(
        *[F.coalesce(F.sum(q(f.name)), F.lit(0)).cast(f.dataType).alias(f.name) for f in sums]
    )

"""Key joins: null-safe matching and one row per key.

Keys are matched as one struct. Structs are equal where all their fields are,
null to null, and grouping and joining by the same column share one exchange,
which `<=>` on the single columns would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.digest import quoted as q

KEY = "__key"


def key_of(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(q(k)).alias(f"k{i}") for i, k in enumerate(keys)]).alias(KEY)


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), *, keep_key: bool = False
) -> DataFrame:
    """The last row of every key by `order_by`; without it a repeated key raises.

    Written as an aggregate, not a window: copies of a hot key collapse on the
    map side. `keep_key` adds the key struct, on which a join needs no further
    exchange.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(q(c)) for c in rest]) if rest else F.lit(None)
    if order_by:
        # The row itself breaks ties of the order columns.
        rank = F.struct(*[F.col(q(c)) for c in order_by], *[F.col(q(c)) for c in rest])
        picked = F.max_by(row, rank)
    else:
        picked = F.any_value(row)
    grouped = df.groupBy(key_of(keys)).agg(picked.alias("_row"), F.count(F.lit(1)).alias("_copies"))
    if not order_by:
        problem = F.raise_error(F.concat(F.lit("repeated key, name an order column: "), F.to_json(KEY)))
        grouped = grouped.withColumn("_row", F.when(F.col("_copies") > 1, problem).otherwise(F.col("_row")))
    place = {k: F.col(f"{KEY}.k{i}").alias(k) for i, k in enumerate(keys)}
    columns = [place[c] if c in place else F.col(f"_row.{q(c)}").alias(c) for c in df.columns]
    return grouped.select(*([KEY] if keep_key else []), *columns)


def with_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in `other`."""
    return df.select(key_of(keys), "*").join(other.select(key_of(keys)).distinct(), KEY, "left_semi").drop(KEY)


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not occur in `other`."""
    return df.select(key_of(keys), "*").join(other.select(key_of(keys)).distinct(), KEY, "left_anti").drop(KEY)


def match_left(new: DataFrame, current: DataFrame, keys: Sequence[str], marker: str = "_match") -> DataFrame:
    """Left join with suffixes `_new` / `_old` on shared columns and a `both` / `left_only` marker."""
    shared = [c for c in new.columns if c in current.columns and c not in keys]
    left = new.select(key_of(keys), *[F.col(q(c)).alias(c + "_new" if c in shared else c) for c in new.columns])
    right = current.select(
        key_of(keys),
        *[F.col(q(c)).alias(c + "_old" if c in shared else c) for c in current.columns if c not in keys],
        F.lit(True).alias("_hit"),
    )
    return (
        left.join(right, KEY, "left")
        .withColumn(marker, F.when(F.col("_hit"), F.lit("both")).otherwise(F.lit("left_only")))
        .drop("_hit", KEY)
    )


def key_sets(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key with the side it is on: `new`, `old` or `both`. Null keys are left out."""
    def side(df: DataFrame, flag: str) -> DataFrame:
        present = df.select(*[F.col(q(k)) for k in keys]).na.drop("any")
        return present.withColumn(flag, F.lit(1))

    flags = side(old, "_old").unionByName(side(new, "_new"), allowMissingColumns=True)
    return (
        flags.groupBy(*[F.col(q(k)) for k in keys])
        .agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
        .withColumn(
            "side",
            F.when(F.col("_old").isNull(), F.lit("new"))
            .when(F.col("_new").isNull(), F.lit("old"))
            .otherwise(F.lit("both")),
        )
        .drop("_old", "_new")
    )

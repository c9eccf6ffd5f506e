"""Choosing a physical layout, and writing it without small files or hot tasks."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.keys import q

# Row counts from which a layout pays, and words for date columns.
RANGE_ROWS, MONTHLY_ROWS, LIST_ROWS, HASH_ROWS = 100_000, 1_000_000, 50_000, 500_000
LIST_VALUES, HASH_BUCKETS = 50, 8
DATE_WORDS = ("date", "ts", "created", "updated")

# A bucket of this many rows is a few files that a task can write.
ROWS_PER_BUCKET = 20_000_000


class Layout(NamedTuple):
    strategy: str
    column: str | None
    granularity: str
    reason: str

    @property
    def ddl_hint(self) -> str:
        return "No partitioning" if self.strategy == "none" else f"PARTITION BY {self.strategy.upper()}({self.column})"


def _dated(row: Row) -> bool:
    """A date, or text whose name has a date word as one of its words."""
    return row["dtype"] == "datetime" or (
        row["dtype"] == "string" and not set(DATE_WORDS).isdisjoint(re.split(r"[^a-z0-9]+", row["column"].lower()))
    )


def _few_valued(row: Row) -> bool:
    return row["dtype"] == "string" and row["n_unique"] is not None and row["n_unique"] < LIST_VALUES


def bucket_count(row_count: int) -> int:
    return max(HASH_BUCKETS, math.ceil(row_count / ROWS_PER_BUCKET))


# A layout, the rows above which it pays, the columns it fits and its grain; the first that holds is taken.
RULES = (
    ("range", RANGE_ROWS, _dated, lambda rows: "monthly" if rows > MONTHLY_ROWS else "daily"),
    ("list", LIST_ROWS, _few_valued, lambda rows: "per_value"),
    ("hash", HASH_ROWS, lambda row: True, lambda rows: f"{bucket_count(rows)}_buckets"),
)


def choose_layout(schema: Sequence[Row], row_count: int) -> Layout:
    """By date, by value, by hash or not at all, from rows of column, dtype family and n_unique."""
    for strategy, more_than, fits, grain in RULES:
        column = next((row["column"] for row in schema if fits(row)), None)
        if column is not None and row_count > more_than:
            return Layout(strategy, column, grain(row_count), f"more than {more_than:,} rows, and {column} fits")
    return Layout("none", None, "n/a", f"{row_count:,} rows are scanned as fast without a layout")


def write_layout(df: DataFrame, layout: Layout, path: str, *, mode: str = "overwrite", buckets: int | None = None) -> None:
    """Write parquet in the layout, the partition column named `_part`.

    Text that is no date goes to the partition of nulls. Buckets are as many as
    the layout says, unless given.

    REBALANCE brings a partition's rows together so that it has few files, and
    lets AQE split a partition that is too big for one task.
    """
    if layout.strategy == "none":
        df.write.mode(mode).parquet(path)
        return
    col = F.col(q(layout.column))
    if layout.strategy == "range":
        when = F.try_to_timestamp(col) if isinstance(df.schema[layout.column].dataType, T.StringType) else col
        part = F.date_format(when, "yyyy-MM" if layout.granularity == "monthly" else "yyyy-MM-dd")
    elif layout.strategy == "list":
        part = col
    elif layout.strategy == "hash":
        part = F.pmod(F.hash(col), F.lit(buckets or int(layout.granularity.partition("_")[0])))
    else:
        raise ValueError(f"unknown layout {layout.strategy!r}")
    parted = df.withColumn("_part", part)
    parted.hint("rebalance", F.col("_part")).write.mode(mode).partitionBy("_part").parquet(path)

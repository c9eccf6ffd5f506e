"""Reading only what is new: date windows and watermarks."""

from __future__ import annotations

import datetime as dt
import json
import uuid
import warnings
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.digest import row_digest
from siltstone.functions.types import family, is_fractional
from siltstone.operators.keys import q
from siltstone.sources.versions import VersionLog

Bound = str | dt.date | dt.datetime


def date_window(
    df: DataFrame, column: str | None, start: Bound | None = None, end: Bound | None = None
) -> DataFrame:
    """Rows with start <= column < end; either bound may be left out.

    A typed column is compared as it is, so the filter reaches the file scan;
    text is parsed first and what does not parse is dropped. Without the column
    the table is returned whole, with a warning.
    """
    if column is None or column not in df.columns:
        warnings.warn("no time stamp column, the date window is not applied", stacklevel=2)
        return df
    data_type = df.schema[column].dataType
    col = F.col(q(column))
    if family(data_type) == "datetime":
        kind = data_type.simpleString()
    else:
        df = df.withColumn(column, F.try_to_timestamp(col.cast("string")))
        kind = "timestamp"
    if start is not None:
        df = df.filter(col >= _bound(start, kind))
    if end is not None:
        df = df.filter(col < _bound(end, kind))
    return df


def _bound(value: Bound, kind: str) -> Column:
    text = str(value)
    # A day compares with dates as a date, so that the filter reaches the scan.
    return F.lit(text).cast("timestamp" if kind == "date" and len(text) > 10 else kind)


def _past(df: DataFrame, column: str | None, watermark: Any | None, mode: str, keep_null: bool) -> Column | None:
    """The condition on a row to be new, or none if every row is taken."""
    if mode == "full_load" or watermark is None or column is None:
        return None
    col, data_type = F.col(q(column)), df.schema[column].dataType
    newer, absent = col > F.lit(str(watermark)).cast(data_type), _absent(df, column)
    if family(data_type) == "string" or is_fractional(data_type):
        newer = F.coalesce(newer, F.lit(False)) & ~absent
    return newer | absent if keep_null else newer


def newer_than(
    df: DataFrame,
    column: str | None,
    watermark: Any | None,
    *,
    mode: str = "incremental",
    keep_null: bool = True,
) -> DataFrame:
    """Rows past the watermark, compared in the column's own type; rows without a value are kept on request."""
    past = _past(df, column, watermark, mode, keep_null)
    return df if past is None else df.filter(past)


def watermark_stats(
    df: DataFrame, column: str, watermark: Any | None, *, mode: str = "incremental", keep_null: bool = True
) -> DataFrame:
    """One row: rows in the source, returned and skipped, and the watermark to keep next; one pass."""
    past = _past(df, column, watermark, mode, keep_null)
    taken = F.lit(True) if past is None else F.coalesce(past, F.lit(False))
    last = F.lit(None if watermark is None else str(watermark)).cast("string")
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_in_source"),
        F.count_if(taken).alias("rows_returned"),
        F.max(F.when(taken & ~_absent(df, column), F.col(q(column)))).cast("string").alias("_max"),
    )
    return counts.select(
        F.lit("full_load" if past is None else mode).alias("mode"),
        "rows_in_source",
        "rows_returned",
        (F.col("rows_in_source") - F.col("rows_returned")).alias("rows_skipped"),
        last.alias("last_watermark"),
        F.coalesce("_max", last).alias("new_watermark"),
    )


class Watermark(NamedTuple):
    watermark: str | None
    type: str | None
    last_updated: dt.datetime | None


def _mark(value: Any, kind: str, at: dt.datetime | None) -> str:
    at = at or dt.datetime.now(dt.timezone.utc)
    return json.dumps({"watermark": str(value), "type": kind, "last_updated": at.isoformat()})


def save_watermark(spark: SparkSession, path: str, value: Any, kind: str = "timestamp", at: dt.datetime | None = None) -> None:
    """Publish the new watermark. Call it after the sink's write has succeeded."""
    VersionLog(spark, path).publish("watermark", {"mark": _mark(value, kind, at)})


def load_watermark(spark: SparkSession, path: str) -> Watermark:
    """The watermark saved last, or nothing."""
    state = VersionLog(spark, path).state()
    if state is None or "mark" not in state.entries:
        return Watermark(None, None, None)
    found = json.loads(state.entries["mark"])
    return Watermark(found["watermark"], found["type"], dt.datetime.fromisoformat(found["last_updated"]))


DIGEST = "__digest"


class Frontier:
    """How far a source has been read: a mark, and the rows beside it that have been taken.

    A row is new if its value is past the mark. Rows at the mark, and rows without
    a value (null, NaN, blank text), are new if their digest was not taken before:
    so rows that come late with the mark's own value are not lost, rows without a
    value come once, and NaN, which is greater than all numbers, moves nothing. A row
    equal in all columns to one that was taken beside the mark counts as that row.

    Digests are kept as files beside the mark, one folder for each run that took
    such rows; those at the mark are let go when it moves.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = VersionLog(spark, f"{self.path}/_versions")

    def mark(self) -> Watermark:
        return load_watermark(self.spark, self.log.path)

    def _taken(self) -> DataFrame | None:
        state = self.log.state()
        folders = [b for e, b in state.entries.items() if e.startswith(("at/", "without/"))] if state else []
        return self.spark.read.schema(f"{DIGEST} string").parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def unseen(self, df: DataFrame, column: str, *, keep_null: bool = True) -> DataFrame:
        """The rows that are new."""
        col, mark, taken = F.col(q(column)), self.mark().watermark, self._taken()
        absent = _absent(df, column)
        beside = absent if keep_null else F.lit(False)
        if mark is None:
            past = ~absent
        else:
            last = F.lit(mark).cast(df.schema[column].dataType)
            past = F.coalesce(col > last, F.lit(False)) & ~absent
            beside = beside | (F.coalesce(col == last, F.lit(False)) & ~absent)
        # The two are read apart, so that rows past the mark are neither digested nor joined.
        some = df.filter(beside)
        if taken is not None:
            some = some.withColumn(DIGEST, row_digest(df, df.columns)).join(taken.distinct(), DIGEST, "left_anti").drop(DIGEST)
        return df.filter(past).unionByName(some)

    def advance(self, taken: DataFrame, column: str, label: str, at: dt.datetime | None = None) -> None:
        """Publish that these rows, which `unseen` gave and a sink has written, are taken. Once for each label."""
        if self.log.has(label):
            return
        col, absent, before = F.col(q(column)), _absent(taken, column), self.mark().watermark
        kind = taken.schema[column].dataType
        newest = taken.agg(F.max(F.when(~absent, col)).alias("m")).select(F.col("m").cast("string")).first()[0]
        state = self.log.state()
        entries: dict[str, str | None] = {}
        mark = before
        if newest is not None and newest != before:
            mark = newest
            entries = {e: None for e in (state.entries if state else {}) if e.startswith("at/")}
            entries["mark"] = _mark(newest, kind.simpleString(), at)
        last = F.lit(mark).cast(kind)
        for name, rows in (("without", absent), ("at", F.coalesce(col == last, F.lit(False)) & ~absent)):
            folder = f"taken/{uuid.uuid4().hex}"
            digests = taken.filter(rows).select(row_digest(taken, taken.columns).alias(DIGEST)).distinct()
            digests.write.parquet(f"{self.path}/{folder}")
            if not self.spark.read.schema(f"{DIGEST} string").parquet(f"{self.path}/{folder}").isEmpty():
                entries[f"{name}/{folder}"] = folder
        self.log.publish(label, entries, before=state)


def _absent(df: DataFrame, column: str) -> Column:
    """Whether a row has no value to compare with a mark."""
    col, data_type = F.col(q(column)), df.schema[column].dataType
    absent = col.isNull()
    if is_fractional(data_type):
        absent = absent | F.coalesce(F.isnan(col.cast("double")), F.lit(False))
    if family(data_type) == "string":
        absent = absent | F.coalesce(F.trim(col) == "", F.lit(False))
    return absent

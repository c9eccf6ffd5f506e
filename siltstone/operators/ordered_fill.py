"""Forward fill, then backward fill along an order, without a global window.

A *position* is one value of the order columns. Positions with their values are
few bytes each and are collapsed on the map side, so rows that share a position
cost nothing. Positions are range-partitioned into blocks of about equal size
and written once; each block is filled on its own and takes what the blocks
before it leave (one row per block). Rows whose value is present never move:
only rows with a gap are joined to the filled positions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.missing import is_null
from siltstone.operators.keys import q
from siltstone.session import shared_dir
from siltstone.sources.versions import VersionLog


# At most about this many positions are filled by one task.
ROWS_PER_BLOCK = 10_000_000


def ordered_fill(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    *,
    drop_unfilled: bool = True,
    blocks: int | None = None,
    before: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fill gaps of `columns` with the last value before them, else the first after.

    `before` holds values that stood in front of these rows (literals), for
    increments: they fill what has no value before it here.

    The order columns should tell rows apart. Rows that tie have one position,
    whose value is the largest present one. Rows that nothing can fill are
    dropped (a column without any value).
    """
    if not order_by:
        raise ValueError("an ordered fill needs order columns; rows of a table have no order")
    if set(order_by) & set(columns):
        raise ValueError("a filled column cannot be an order column")
    spark = df.sparkSession
    order = [F.col(f"_o{i}") for i in range(len(order_by))]
    source = {f.name: f.dataType for f in df.schema.fields}
    value = {c: F.when(~is_null(F.col(q(c)), source[c]), F.col(q(c))) for c in columns}
    gap = reduce(lambda a, b: a | b, [value[c].isNull() for c in columns])

    positions = df.groupBy(*[F.col(q(o)).alias(f"_o{i}") for i, o in enumerate(order_by)]).agg(
        F.max(gap).alias("_gap"), *[F.max(value[c]).alias(f"_v{i}") for i, c in enumerate(columns)]
    )
    path = shared_dir(spark, "positions")
    # A block is one group of a window, so their number follows the rows. Where the
    # shuffle partitions are enough, AQE joins neighbours that are small; either
    # way block numbers follow the order.
    needed = math.ceil(df.count() / ROWS_PER_BLOCK)
    if blocks is None and needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        blocks = needed
    ranged = positions.repartitionByRange(blocks, *order) if blocks else positions.repartitionByRange(*order)
    ranged.withColumn("_block", F.spark_partition_id()).write.parquet(path)
    # Read back: block numbers are now data and stay the same when a task is rerun.
    positions = spark.read.schema(_position_schema(positions)).parquet(path)

    place = F.struct(*order)
    edges = positions.groupBy("_block").agg(
        *[
            agg
            for i in range(len(columns))
            for agg in (
                F.max_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), place)).alias(f"_last{i}"),
                F.min_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), place)).alias(f"_first{i}"),
            )
        ]
    )
    known = dict(before or {})
    # One row per block: few enough for one task. Spark broadcasts it if it is small.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    anywhere = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = edges.select(
        "_block",
        *[
            F.coalesce(
                F.last(f"_last{i}", True).over(earlier), known.get(c, F.lit(None)).cast(source[c]), F.first(f"_first{i}", True).over(anywhere)
            ).alias(f"_c{i}")
            for i, c in enumerate(columns)
        ],
    )
    so_far = Window.partitionBy("_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        positions.select(
            "_block", "_gap", *order, *[F.last(f"_v{i}", True).over(so_far).alias(f"_f{i}") for i in range(len(columns))]
        )
        .filter("_gap")
        .join(carried, "_block")
        .select(*order, *[F.coalesce(f"_f{i}", f"_c{i}").alias(f"_f{i}") for i in range(len(columns))])
    )

    whole = df.filter(~gap)
    gaps = df.filter(gap)
    same = reduce(
        lambda a, b: a & b,
        [gaps[q(o)].eqNullSafe(filled[f"_o{i}"]) for i, o in enumerate(order_by)],
    )
    index = {c: i for i, c in enumerate(columns)}
    mended = gaps.join(filled, same, "left").select(
        *[
            F.coalesce(value[c], F.col(f"_f{index[c]}")).alias(c) if c in index else F.col(q(c))
            for c in df.columns
        ]
    )
    if drop_unfilled:
        mended = mended.na.drop("any", subset=list(columns))
    return whole.unionByName(mended)


def _position_schema(positions: DataFrame) -> T.StructType:
    return T.StructType([*positions.schema.fields, T.StructField("_block", T.IntegerType())])


class FillState:
    """What increments leave to those after them: the place of the last row and the last value of each filled column.

    An increment takes the values of the one that ended last before it begins. So a
    window that is loaded again, or late, is filled as it would have been in its turn;
    windows loaded before it keep what they have.
    """

    OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], order_by: Sequence[str]):
        self.spark, self.columns = spark, list(columns)
        self.names = [*columns, *order_by]
        self.log = VersionLog(spark, path)
        place = T.StructType([T.StructField(f"o{i}", schema[c].dataType) for i, c in enumerate(order_by)])
        values = [T.StructField(f"v{i}", schema[c].dataType) for i, c in enumerate(columns)]
        self.types = T.StructType([T.StructField("names", T.ArrayType(T.StringType())), T.StructField("place", place), *values])
        self.place = F.struct(*[F.col(q(c)).alias(f"o{i}") for i, c in enumerate(order_by)])
        self.taken: str | None = None

    def _read(self, text: str | Column) -> Column:
        return F.from_json(F.lit(text) if isinstance(text, str) else text, self.types, self.OPTIONS)

    def values(self, rows: DataFrame, part: str) -> dict[str, Column]:
        """Literals to fill the rows of a part with; none where no part before it filled the same columns."""
        state = self.log.state()
        others = [(b,) for e, b in state.entries.items() if e != part] if state else []
        if not others:
            return {}
        first = rows.agg(F.to_json(F.struct(F.min(self.place).alias("place")), self.OPTIONS)).first()[0]
        known = self.spark.createDataFrame(others, "text string").withColumn("s", self._read(F.col("text")))
        same = F.col("s.names") == F.array(*[F.lit(c) for c in self.names])
        before = known.filter(same & (F.col("s.place") < self._read(first)["place"]))
        self.taken = before.agg(F.max_by("text", "s.place")).first()[0]
        return {c: self._read(self.taken)[f"v{i}"] for i, c in enumerate(self.columns)} if self.taken else {}

    def save(self, rows: DataFrame, part: str) -> None:
        """Publish what the rows of a part leave, after `values` of the same part."""
        types = {f.name: f.dataType for f in rows.schema.fields}
        last = [F.max_by(q(c), F.when(~is_null(F.col(q(c)), types[c]), self.place)).alias(f"v{i}") for i, c in enumerate(self.columns)]
        now = rows.agg(F.max(self.place).alias("place"), *last).filter("place IS NOT NULL")
        values = [F.col(f"v{i}") for i in range(len(self.columns))]
        if self.taken:
            values = [F.coalesce(v, self._read(self.taken)[f"v{i}"]).alias(f"v{i}") for i, v in enumerate(values)]
        names = F.array(*[F.lit(c) for c in self.names]).alias("names")
        line = now.select(F.to_json(F.struct(names, "place", *values), self.OPTIONS).alias("text")).first()
        if line is not None:
            self.log.publish(part, {part: line["text"]})

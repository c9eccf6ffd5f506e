"""Column and table profiles, each from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.digest import compact, compact_row
from siltstone.functions.missing import is_missing
from siltstone.functions.names import TIMESTAMP_NAMES
from siltstone.functions.numeric import percent, ratio
from siltstone.functions.sketch import approx_distinct
from siltstone.functions.types import family, is_fractional
from siltstone.operators.keys import q


def _distinct(col: Column, mode: str) -> Column:
    if mode == "exact":
        return F.count_distinct(col)
    if mode == "approx":
        return approx_distinct(col)
    if mode == "none":
        return F.lit(None).cast("bigint")
    raise ValueError("distinct is 'exact', 'approx' or 'none'")


def _value(f: T.StructField) -> Column:
    """The column for counting: NaN is null, long text is its digest."""
    col = F.col(q(f.name))
    return F.when(~F.isnan(col), col) if is_fractional(f.dataType) else compact(col, f.dataType)


def column_profile(
    df: DataFrame,
    *,
    distinct: str = "exact",
    exact_for: Sequence[str] = (),
    scan: str = "per_column",
) -> DataFrame:
    """One row per column: dtype, nulls, null % (2 digits, ties to even), distinct values.

    `distinct="approx"` keeps a sketch of a few KB per column and task and
    shuffles nothing but those; columns in `exact_for` are still counted exactly.

    Exact counts shuffle the distinct values of every column. `scan="per_column"`
    reads each column on its own: of a columnar file that is the same number of
    bytes, and every row stays one narrow value. `scan="once"` reads the input
    once, which multiplies its rows by the number of columns before they are
    collapsed: only for an input that is narrow and costly to compute.
    """
    if scan not in ("once", "per_column"):
        raise ValueError("scan is 'once' or 'per_column'")
    modes = {f.name: "exact" if f.name in exact_for else distinct for f in df.schema.fields}
    alone = [f.name for f in df.schema.fields if scan == "per_column" and modes[f.name] == "exact"]
    together = [f for f in df.schema.fields if f.name not in alone]
    position = {c: i for i, c in enumerate(df.columns)}
    parts = []
    if together:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for f in together:
            i, value = position[f.name], _value(f)
            aggs.append(F.count(value).alias(f"_v{i}"))
            aggs.append(_distinct(value, modes[f.name]).cast("bigint").alias(f"_d{i}"))
        rows = [
            F.struct(
                F.lit(f.name).alias("column"), F.lit(position[f.name]).alias("position"), F.lit(f.dataType.simpleString()).alias("dtype"),
                (F.col("_rows") - F.col(f"_v{position[f.name]}")).alias("null_count"),
                F.col(f"_d{position[f.name]}").alias("cardinality"), F.col("_rows").alias("total_rows"),
            )
            for f in together
        ]
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    for name in alone:
        f = df.schema[name]
        counted = df.select(_value(f).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            counted.agg(
                F.lit(name).alias("column"), F.lit(position[name]).alias("position"), F.lit(f.dataType.simpleString()).alias("dtype"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_count"),
                F.count("v").alias("cardinality"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
            )
        )
    stats = reduce(lambda a, b: a.unionByName(b), parts)
    return stats.select(
        "column", "position", "dtype", "null_count", percent(F.col("null_count"), F.col("total_rows")).alias("null_pct"), "cardinality", "total_rows"
    )


def duplicate_stats(df: DataFrame) -> DataFrame:
    """Rows, rows beyond the first of each identical group, and their share.

    Copies collapse on the map side, so a group holding much of the table
    crosses the network as one row per task, and long text as its digest.
    """
    copies = df.groupBy(*compact_row(df)).agg(F.count(F.lit(1)).alias("_copies"))
    totals = copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"),
    )
    return totals.withColumn("duplicate_pct", percent(F.col("duplicate_count"), F.col("total_rows")))


def table_profile(profile: DataFrame) -> DataFrame:
    """Row count, column count and the columns with nulls, from a column profile."""
    with_nulls = F.when(F.col("null_pct") > 0, F.struct("position", "column", "null_pct"))
    return profile.agg(
        F.max("total_rows").alias("total_rows"),
        F.count(F.lit(1)).alias("num_columns"),
        F.sort_array(F.collect_list(with_nulls)).alias("_nulls"),
    ).select(
        "total_rows",
        "num_columns",
        F.transform("_nulls", lambda n: F.struct(n["column"].alias("column"), n["null_pct"].alias("null_pct"))).alias("null_summary"),
    )


def top_null_columns(profile: DataFrame, n: int = 5) -> DataFrame:
    """The columns with most nulls as one text, `None` if there are none."""
    top = profile.filter("null_pct > 0").orderBy(F.desc("null_pct"), "position").limit(n)
    listed = top.agg(
        F.sort_array(
            F.collect_list(
                F.struct((-F.col("null_pct")).alias("k"), "position", F.format_string("%s (%s%%)", F.col("column"), F.col("null_pct").cast("string")).alias("text"))
            )
        ).alias("_top")
    )
    return listed.select(
        F.when(F.size("_top") == 0, F.lit("None"))
        .otherwise(F.array_join(F.transform("_top", lambda t: t["text"]), ", "))
        .alias("top_null_columns")
    )


def parse_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column the share of non-null values that parse as a time stamp; one aggregate."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(q(c)).alias(f"_v{i}"), F.count(F.try_to_timestamp(q(c))).alias(f"_p{i}")]
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"_v{i}").alias("values"), F.col(f"_p{i}").alias("parsed"))
        for i, c in enumerate(columns)
    ]
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    return out.withColumn("share", F.coalesce(F.col("parsed") / F.nullif(F.col("values").cast("double"), F.lit(0.0)), F.lit(0.0)))


def timestamp_column(df: DataFrame) -> str | None:
    """The row's time stamp: by name, else by type, else the first text column that mostly parses.

    Only the last needs the data: one aggregate over the text columns of all rows.
    """
    for name in df.columns:
        if name.lower() in TIMESTAMP_NAMES:
            return name
    for f in df.schema.fields:
        if family(f.dataType) == "datetime":
            return f.name
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if text:
        shares = {r["column"]: r["share"] for r in parse_share(df, text).collect()}
        for name in text:
            if shares[name] > 0.8:
                return name
    return None


# Parts of a name that decide a column's role, and plain numbers.
ID_WORDS = ("_id", "id_", "uuid", "key")
TIME_WORDS = ("date", "time", "ts", "timestamp", "created", "updated")
PLAIN_NUMBER = r"^-?\d+\.?\d*$"


def role_by_name(name: str) -> str | None:
    low = name.lower()
    if any(w in low for w in ID_WORDS):
        return "id"
    if any(w in low for w in TIME_WORDS):
        return "timestamp"
    return None


def column_roles(df: DataFrame) -> DataFrame:
    """One row per column: id, timestamp, numeric_metric, categorical or text.

    The share of numbers is taken over all values, in one aggregate. Few distinct
    values (< 30) are counted by sketch; the sketch is exact far beyond 30.
    """
    undecided = [f for f in df.schema.fields if role_by_name(f.name) is None]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(undecided):
        # Numbers need no look at their text, which Spark may write as 1.0E7.
        text = F.trim(F.col(q(f.name)).cast("string"))
        plain = F.col(q(f.name)).isNotNull() if family(f.dataType) == "numeric" else text.rlike(PLAIN_NUMBER)
        aggs += [
            F.count(text).alias(f"_v{i}"),
            F.count_if(plain).alias(f"_m{i}"),
            approx_distinct(F.col(q(f.name))).alias(f"_d{i}"),
        ]
    stats = df.agg(*aggs)
    numbers = {f.name: (F.col(f"_v{i}"), F.col(f"_m{i}")) for i, f in enumerate(undecided)}
    index = {f.name: i for i, f in enumerate(undecided)}
    rows = []
    for f in df.schema.fields:
        role = role_by_name(f.name)
        if role is not None:
            value = F.lit(role)
        else:
            present, numeric = numbers[f.name]
            value = (
                F.when((present > 0) & (numeric > present * 0.8), F.lit("numeric_metric"))
                .when(F.col(f"_d{index[f.name]}") < 30, F.lit("categorical"))
                .otherwise(F.lit("text"))
            )
        rows.append(F.struct(F.lit(f.name).alias("column"), value.alias("role")))
    return stats.select(F.inline(F.array(*rows)))


def record_schema(df: DataFrame, *, distinct: str = "approx") -> DataFrame:
    """The toolbox form of a schema: column, dtype family, share of missing values, distinct values."""
    # Present values are worked out once per row, before they are counted twice.
    present = df.select(
        *[
            F.when(~is_missing(F.col(q(f.name)), f.dataType), compact(F.col(q(f.name)), f.dataType)).alias(f"_p{i}")
            for i, f in enumerate(df.schema.fields)
        ]
    )
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i in range(len(df.columns)):
        aggs.append(F.count(f"_p{i}").alias(f"_v{i}"))
        aggs.append(_distinct(F.col(f"_p{i}"), distinct).cast("bigint").alias(f"_d{i}"))
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(i).alias("position"),
            F.lit(family(f.dataType)).alias("dtype"),
            ratio(F.col("_rows") - F.col(f"_v{i}"), F.col("_rows")).alias("null_rate"),
            F.col(f"_d{i}").alias("n_unique"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return present.agg(*aggs).select(F.inline(F.array(*rows)))

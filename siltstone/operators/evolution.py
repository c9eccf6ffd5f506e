"""Schema drift between two tables or a table and a saved baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.tables import read_if_there

# Type changes that lose nothing, as (from, to).
SAFE_CHANGES = (
    ("numeric", "string"),
    ("boolean", "string"),
    ("integer", "numeric"),
    ("integer", "float"),
)

SCHEMA_COLUMNS = "column string, dtype string"


def type_word(data_type: T.DataType) -> str:
    """integer, float, numeric (decimal), boolean, string or Spark's own type name."""
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(data_type, T.DecimalType):
        return "numeric"
    return data_type.simpleString()


def schema_table(df: DataFrame) -> DataFrame:
    rows = [(f.name, type_word(f.dataType)) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, SCHEMA_COLUMNS)


def is_breaking(from_type: str | Column, to_type: str | Column) -> Column:
    a, b = (F.lower(F.lit(t) if isinstance(t, str) else t) for t in (from_type, to_type))
    safe = F.lit(False)
    for old, new in SAFE_CHANGES:
        safe = safe | ((a == old) & (b == new))
    return ~safe


def schema_changes(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """New, removed and retyped columns of two (column, dtype) tables, with severities."""
    cur = current.select("column", F.col("dtype").alias("to_type"))
    base = baseline.select("column", F.col("dtype").alias("from_type"))
    both = cur.join(base, "column", "full_outer")
    name, old, new = F.col("column"), F.col("from_type"), F.col("to_type")
    return (
        both.withColumn(
            "change",
            F.when(old.isNull(), F.lit("new")).when(new.isNull(), F.lit("removed")).when(old != new, F.lit("retyped")),
        )
        .filter("change is not null")
        .select(
            "column",
            "change",
            "from_type",
            "to_type",
            F.when(F.col("change") == "new", F.lit("WARN"))
            .when(F.col("change") == "removed", F.lit("FAIL"))
            .when(is_breaking(old, new), F.lit("FAIL"))
            .otherwise(F.lit("WARN"))
            .alias("severity"),
            F.when(F.col("change") == "new", F.concat(name, F.lit(": not in the baseline; save a new one once its readers know it")))
            .when(F.col("change") == "removed", F.concat(name, F.lit(": in the baseline only; whoever selects it fails")))
            .otherwise(F.concat(name, F.lit(": was "), old, F.lit(", is "), new))
            .alias("recommendation"),
        )
    )


def column_counts(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: the columns of two (column, dtype) tables."""
    sides = current.select(F.lit(1).alias("now")).unionByName(baseline.select(F.lit(0).alias("now")))
    return sides.agg(F.count_if(F.col("now") == 0).alias("baseline_columns"), F.count_if(F.col("now") == 1).alias("current_columns"))


def evolution_status(changes: DataFrame) -> DataFrame:
    """One row: how many changes of each kind, and the worst severity."""
    kinds = {k: F.count_if(F.col("change") == k) for k in ("new", "removed", "retyped")}
    counts = changes.agg(
        *[v.alias(k) for k, v in kinds.items()],
        F.count_if(F.col("severity") == "FAIL").alias("_fails"),
        F.count_if(F.col("severity") == "WARN").alias("_warns"),
    )
    return counts.select(
        "new",
        "removed",
        "retyped",
        F.when(F.col("_fails") > 0, F.lit("FAIL")).when(F.col("_warns") > 0, F.lit("WARN")).otherwise(F.lit("PASS")).alias("status"),
        F.format_string("%d columns came, %d went, %d have another type", "new", "removed", "retyped").alias("summary"),
    )


def save_baseline(schema: DataFrame, path: str) -> None:
    schema.withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    """The saved (column, dtype) table; empty if there is none, an error if it cannot be read."""
    table = read_if_there(lambda: spark.read.schema(SCHEMA_COLUMNS).option("mode", "FAILFAST").json(path))
    return spark.createDataFrame([], SCHEMA_COLUMNS) if table is None else table

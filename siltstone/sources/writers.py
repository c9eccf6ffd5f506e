"""Writers of layers, tables and run records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.digest import quoted

BRONZE_PARTITION = "ingest_date"


def write_bronze(df: DataFrame, path: str, ingest_date: str | None = None) -> None:
    """A raw copy. With a date only that date's partition is replaced, so a rerun adds nothing twice.

    The partition's folder is written as such: a rerun without rows then leaves
    an empty partition, where a dynamic overwrite would leave the old rows.
    """
    if ingest_date is not None:
        path = f"{path}/{BRONZE_PARTITION}={dt.date.fromisoformat(ingest_date)}"
    df.write.mode("overwrite").parquet(path)


def read_bronze(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Bronze as it was read, or some days of it; the source itself is not read again."""
    table = spark.read.parquet(path)
    if dates is None:
        return table
    days = [F.lit(d).cast("date") for d in dates]
    return table.filter(F.col(BRONZE_PARTITION).isin(*days)).drop(BRONZE_PARTITION)


def write_layer(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


# Names of the write modes.
TABLE_MODES = {"append": "append", "replace": "overwrite"}


def write_table(df: DataFrame, name: str, *, mode: str = "append", path: str | None = None, jdbc: dict[str, str] | None = None) -> None:
    """Append to or replace a catalog table, or a database table when JDBC options are given."""
    if mode not in TABLE_MODES:
        raise ValueError(f"mode is one of {list(TABLE_MODES)}")
    writer = df.write.mode(TABLE_MODES[mode])
    if jdbc is not None:
        writer.format("jdbc").options(dbtable=name, **jdbc).save()
        return
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


RUN = "_run_id"


def append_run(df: DataFrame, name: str, run_id: str) -> None:
    """Append to a catalog table once: the rows of a run are a partition, which a repeated run replaces.

    A column the table does not know raises, one the rows lack is null.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.withColumn(RUN, F.lit(run_id)).limit(0).write.partitionBy(RUN).saveAsTable(name)
    columns = [f for f in spark.table(name).schema.fields if f.name != RUN]
    unknown = set(df.columns) - {f.name for f in columns}
    if unknown:
        raise ValueError(f"columns that table {name} does not have: {sorted(unknown)}")
    rows = df.select(*[(F.col(quoted(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns])
    spark.sql("INSERT OVERWRITE TABLE IDENTIFIER({name}) PARTITION (_run_id = {run}) SELECT * FROM {rows}", name=name, run=run_id, rows=rows)


def append_records(df: DataFrame, path: str, run_id: str) -> None:
    """Check or log rows of one run; a rerun with the same id replaces its own rows."""
    marked = df.withColumn("run_id", F.lit(run_id))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_records(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """One run's rows, without listing the folders of all the others."""
    return spark.read.parquet(f"{path}/run_id={run_id}")

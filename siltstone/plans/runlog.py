"""The transform log and the lineage it implies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.silver import Silver

LOG_SCHEMA = "step string, layer string, action string, rows_in bigint, rows_out bigint, notes string"


def transform_log(silver: Silver, silver_rows: int) -> list[tuple]:
    """One record per silver step, in order, with the rows that went in and came out."""
    start = rows = silver.source_rows
    log = []

    def note(step, action, notes, rows_in=None, rows_out=None):
        log.append((step, "silver", action, start if rows_in is None else rows_in, rows if rows_out is None else rows_out, notes))

    for s in silver.steps:
        c = s["column"]
        match s["kind"]:
            case "hash":
                note(f"pii_mask_{c}", f"SHA256 hash applied to {c}", f"PII column {c} hashed for privacy compliance")
            case "drop":
                rows = s["after"]
                note(f"null_drop_{c}", f"Drop rows with null {c}",
                     f"Dropped {s['before'] - s['after']} rows where {c} was null", s["before"], s["after"])
            case "zero":
                note(f"null_fill_zero_{c}", f"Fill nulls with 0 in {c}", f"Numeric nulls in {c} filled with 0")
            case "mean":
                note(f"null_fill_mean_{c}", f"Fill nulls with mean in {c}", f"Null values in {c} filled with column mean")
            case "median":
                note(f"null_fill_median_{c}", f"Fill nulls with median in {c}", f"Null values in {c} filled with column median")
            case "unknown":
                note(f"null_fill_unknown_{c}", f"Fill nulls with UNKNOWN in {c}", f"String nulls in {c} filled with UNKNOWN")
            case "sentinel":
                note(f"null_fill_sentinel_{c}", f"Fill nulls with a sentinel in {c}", f"Nulls in {c} filled with a sentinel value")
            case "flag":
                note(f"null_flag_{c}", f"Add null flag for {c}", f"Added {c}_is_null indicator column")
            case "ordered":
                unfilled = s["gaps"] == s["before"]
                parts = []
                if s["gaps"] and not unfilled:
                    parts.append(f"forward/backward filled {s['gaps']} null(s)")
                if unfilled and s["before"]:
                    parts.append(f"dropped {s['before']} row(s) still null after fill")
                if unfilled:
                    rows = 0
                note(f"null_ffill_bfill_{c}", f"Fill then drop nulls in key column {c}",
                     f"Key column '{c}': {'; '.join(parts) or 'no nulls found'}. Rows dropped only when fill was not possible.",
                     s["before"], rows)
            case "rule":
                e = s["expression"]
                lost = f"; null in {s['failed']} row(s) where it raised" if s.get("failed") else ""
                note(f"custom_{c}", f"Custom: {c} = {e}", f"Custom business rule applied: {c}={e}{lost}", rows, rows)
            case "clamp":
                n = silver.negatives.get(c)
                found = f"{n} negative value(s)" if n is not None else "Negative values"
                note(f"clamp_negative_{c}", f"Clamp negative values in {c} to 0",
                     f"{found} in {c} set to 0. Original flagged in {c}_had_negative.", rows, rows)
    note("dedup_silver", "Remove duplicate rows",
         f"Removed {start - silver_rows} duplicate rows in Silver layer", start, silver_rows)
    return log


def log_table(spark: SparkSession, log: Sequence[tuple]) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(log)]
    return spark.createDataFrame(rows, "step_no int, " + LOG_SCHEMA)


def lineage_edges(log: DataFrame, source: str, target: str) -> DataFrame:
    """Edges source → step → … → target of a log with `step_no`, weighted by rows, at least 1."""
    last = log.agg(F.max("step_no").alias("last"), F.max_by("step", "step_no").alias("step"), F.max_by("rows_out", "step_no").alias("rows"))
    names = log.select((F.col("step_no") + 1).alias("step_no"), F.col("step").alias("from"))
    steps = log.join(names, "step_no", "left").select(
        F.coalesce("from", F.lit(source)).alias("from"),
        F.col("step").alias("to"),
        F.col("rows_in").alias("rows"),
    )
    final = last.filter("last is not null").select(F.col("step").alias("from"), F.lit(target).alias("to"), "rows")
    edges = steps.unionByName(final)
    return edges.select(
        "from", "to", F.greatest("rows", F.lit(1).cast("bigint")).alias("rows"), F.format_string("%,d rows", "rows").alias("label")
    )


def lineage_nodes(edges: DataFrame) -> DataFrame:
    """Every node of the edges with its kind: source, transform or destination."""
    ends = edges.select(F.col("from").alias("label"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("to").alias("label"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    return ends.groupBy("label").agg(F.max("out").alias("out"), F.max("in").alias("in")).select(
        "label",
        F.when(F.col("in") == 0, F.lit("source")).when(F.col("out") == 0, F.lit("destination")).otherwise(F.lit("transform")).alias("type"),
    )

"""The toolbox's tiered checks, its summary, and run volume against history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.digest import compact
from siltstone.functions.missing import is_missing
from siltstone.functions.numeric import percent, ratio
from siltstone.operators.keys import q

# Default tiers.
THRESHOLDS = {
    "null_rate_warn": 0.05,
    "null_rate_fail": 0.20,
    "duplicate_rate_warn": 0.01,
    "duplicate_rate_fail": 0.05,
    "row_count_drift_warn": 0.10,
    "row_count_drift_fail": 0.30,
    "volume_anomaly_warn": 0.25,
    "z_score_outlier": 3.0,
    "iqr_multiplier": 1.5,
}


def _tier(value: Column, warn: float, fail: float) -> Column:
    return F.when(value <= warn, F.lit("PASS")).when(value <= fail, F.lit("WARN")).otherwise(F.lit("FAIL"))


def text_row(df: DataFrame) -> list[Column]:
    """The row as the record toolbox compares it: by its text, in which null reads `None`.

    Values of one type have equal text only if they are equal, so numbers and
    dates are grouped as they are, which is narrower; long text by its digest.
    """
    return [
        (
            compact(F.coalesce(F.col(q(f.name)).cast("string"), F.lit("None")), T.StringType())
            if isinstance(f.dataType, (T.StringType, T.MapType))
            else F.col(q(f.name))
        ).alias(f"_t{i}")
        for i, f in enumerate(df.schema.fields)
    ]


def text_duplicates(df: DataFrame) -> DataFrame:
    """Rows, and rows beyond the first of each group with equal text."""
    copies = df.groupBy(*text_row(df)).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"),
    ).withColumn("duplicate_rate", ratio(F.col("duplicate_count"), F.col("total_rows")))


def suite_checks(
    df: DataFrame, *, baseline_rows: int | None = None, thresholds: Mapping[str, float] = THRESHOLDS, duplicates: bool = True
) -> DataFrame:
    """Null rate per column, row completeness, copies, column and row count, volume; one pass.

    Text that stands for nothing counts as missing; zero and false are values.
    `duplicates=False` leaves out the check of copies and with it the shuffle of
    rows: the others are counts.
    """
    width = len(df.columns)
    gone = [is_missing(F.col(q(f.name)), f.dataType) for f in df.schema.fields]
    if duplicates:
        # Rows of equal text have equal missing cells, so one weighted pass does both.
        copies = df.groupBy(*text_row(df)).agg(
            F.count(F.lit(1)).alias("_copies"), *[F.bool_or(g).alias(f"_g{i}") for i, g in enumerate(gone)]
        )
    else:
        copies = df.select(F.lit(1).cast("bigint").alias("_copies"), *[g.alias(f"_g{i}") for i, g in enumerate(gone)])
    stats = copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("_dups"),
        *[
            F.coalesce(F.sum(F.when(F.col(f"_g{i}"), F.col("_copies"))), F.lit(0)).cast("bigint").alias(f"_n{i}")
            for i in range(width)
        ],
    )
    rows = F.col("_rows")
    pct = lambda v: F.format_string("%.1f%%", v * 100)

    def check(name, category, status, detail, value, threshold):
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(category).alias("category"),
            status.alias("status"),
            detail.alias("detail"),
            value.cast("double").alias("value"),
            F.lit(threshold).cast("double").alias("threshold"),
        )

    # Names, categories and order of the checks.
    checks = []
    for i, c in enumerate(df.columns):
        rate = ratio(F.col(f"_n{i}"), rows)
        made = check(
            f"Null Rate — {c}", "Completeness",
            _tier(rate, thresholds["null_rate_warn"], thresholds["null_rate_fail"]),
            F.concat(pct(rate), F.format_string(" nulls (%d rows)", F.col(f"_n{i}"))),
            rate, thresholds["null_rate_fail"],
        )
        checks.append(F.when(F.col(f"_n{i}") > 0, made))
    null_cells = sum((F.col(f"_n{i}") for i in range(width)), F.lit(0))
    complete = F.lit(1.0) - null_cells / F.greatest(rows * width, F.lit(1)).cast("double")
    checks.append(check(
        "Row-Level Completeness", "Completeness",
        F.when(complete >= 0.95, F.lit("PASS")).otherwise(F.lit("WARN")),
        F.concat(F.lit("Average completeness: "), pct(complete)), complete, 0.95,
    ))
    dup = ratio(F.col("_dups"), rows)
    checks.append(F.when(F.lit(duplicates), check(
        "Duplicate Rows", "Uniqueness",
        _tier(dup, 0.0, thresholds["duplicate_rate_warn"]),
        F.concat(F.format_string("%d duplicates (", F.col("_dups")), pct(dup), F.lit(")")),
        dup, thresholds["duplicate_rate_fail"],
    )))
    checks.append(check("Schema — Column Count", "Validity", F.lit("PASS"), F.lit(f"{width} columns"), F.lit(width), None))
    checks.append(check(
        "Row Count", "Completeness", F.when(rows > 0, F.lit("PASS")).otherwise(F.lit("FAIL")),
        F.format_string("%,d rows", rows), rows, 1.0,
    ))
    if baseline_rows is not None:
        drift = F.abs(rows - baseline_rows) / F.lit(float(max(baseline_rows, 1)))
        checks.append(check(
            "Volume vs Baseline", "Freshness",
            _tier(drift, thresholds["row_count_drift_warn"], thresholds["row_count_drift_fail"]),
            F.concat(F.lit("Drift: "), pct(drift), F.format_string(f" ({baseline_rows:,} → %,d)", rows)),
            drift, thresholds["row_count_drift_fail"],
        ))
    return (
        stats.select(F.posexplode(F.array(*checks)).alias("check_no", "_c")).filter("_c is not null").select("check_no", "_c.*")
    )


def suite_summary(checks: DataFrame) -> DataFrame:
    """Counts, score (0 without checks) and overall status; up to two warnings still pass."""
    counts = checks.agg(
        F.count_if(F.col("status") == "PASS").alias("pass"),
        F.count_if(F.col("status") == "WARN").alias("warn"),
        F.count_if(F.col("status") == "FAIL").alias("fail"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(
        "*",
        percent(F.col("pass"), F.col("total"), 1).alias("score"),
        F.when((F.col("fail") == 0) & (F.col("warn") <= 2), F.lit("PASS"))
        .when(F.col("fail") == 0, F.lit("WARN"))
        .otherwise(F.lit("FAIL"))
        .alias("overall"),
    )


def volume_anomaly(
    runs: DataFrame,
    *,
    dataset: str = "dataset",
    run: str = "run",
    rows: str = "rows",
    baseline: str = "baseline_rows",
    warn: float = THRESHOLDS["volume_anomaly_warn"],
) -> DataFrame:
    """Each run's volume against its baseline and the mean of the up to seven runs before it.

    `runs` holds one row per data set and run: the run log, or an aggregate of
    a table. The history counts once there are at least three earlier runs.
    """
    past = Window.partitionBy(dataset).orderBy(run).rowsBetween(-7, -1)
    count = F.col(rows)
    base = F.col(baseline)
    drift = (count - base) / F.greatest(base, F.lit(1)).cast("double")
    by_base = (
        F.when(F.abs(drift) > 2 * warn, F.lit("FAIL")).when(F.abs(drift) > warn, F.lit("WARN")).otherwise(F.lit("PASS"))
    )
    seen = F.count(count).over(past)
    mean = F.when(seen >= 3, F.avg(count).over(past))
    scored = runs.withColumn("_mean", mean).withColumn("_drift", drift)
    rolling = (count - F.col("_mean")) / F.greatest(F.col("_mean"), F.lit(1.0))
    return scored.select(
        dataset,
        run,
        count.alias(rows),
        base.alias(baseline),
        F.bround(F.col("_drift") * 100, 2).alias("drift_pct"),
        F.bround("_mean", 0).cast("bigint").alias("rolling_avg"),
        F.bround(rolling * 100, 2).alias("rolling_drift_pct"),
        F.when((by_base == "PASS") & (F.abs(rolling) > warn), F.lit("WARN")).otherwise(by_base).alias("status"),
        F.lit("baseline_comparison").alias("method"),
        F.format_string("%+.1f%% against a baseline of %d rows", F.col("_drift") * 100, base).alias("detail"),
        F.when(F.abs(rolling) > warn, F.format_string("%+.1f%% against the mean of earlier runs", rolling * 100)).alias("rolling_detail"),
    )

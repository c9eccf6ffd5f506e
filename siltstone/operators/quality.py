"""The silver scorecard: completeness, uniqueness and range checks, score and gate."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.digest import compact_row
from siltstone.functions.missing import is_null
from siltstone.functions.numeric import percent, to_number
from siltstone.operators.keys import q


class QualityGateError(RuntimeError):
    """The score or a check does not let the run go on."""


class RangeRule(NamedTuple):
    column: str
    low: float | None
    high: float | None


def _bound(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def split_ranges(rules: str) -> list[RangeRule]:
    """`column:min:max` parts between commas; a blank or bad bound is no bound."""
    found = []
    for part in rules.split(","):
        bits = [b.strip() for b in part.split(":")]
        if len(bits) == 3:
            found.append(RangeRule(bits[0], _bound(bits[1]), _bound(bits[2])))
    return found


def quality_checks(
    df: DataFrame,
    *,
    null_threshold: float = 5.0,
    dup_threshold: float = 1.0,
    ranges: str | list[RangeRule] = "",
    distinct_rows: bool = False,
    duplicates: bool = True,
) -> DataFrame:
    """One row per check, numbered in `check_no`.

    Everything comes from one pass. Identical rows are first collapsed with
    their number of copies (on the map side too), and each counter is weighted
    by it. A table known to hold no copies, such as a silver table just written,
    is checked with `distinct_rows=True`, which leaves that shuffle out;
    `duplicates=False` leaves out the check of copies together with the shuffle.
    """
    rules = split_ranges(ranges) if isinstance(ranges, str) else ranges
    rules = [r for r in rules if r.column in df.columns]
    if distinct_rows or not duplicates:
        source, copies = df.withColumn("_copies", F.lit(1).cast("bigint")), F.lit(1).cast("bigint")
    else:
        # Columns under a range rule keep their text, which is to be read as a number.
        whole = [r.column for r in rules]
        source = df.groupBy(*compact_row(df, whole)).agg(F.count(F.lit(1)).alias("_copies"))
        copies = F.col("_copies")

    def weigh(condition):
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0)).cast("bigint")

    aggs = [
        F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).cast("bigint").alias("_dups"),
    ]
    for i, f in enumerate(df.schema.fields):
        aggs.append(weigh(is_null(F.col(q(f.name)), f.dataType)).alias(f"_n{i}"))
    bounds = []
    for rule in rules:
        number = to_number(F.col(q(rule.column)), df.schema[rule.column].dataType)
        for sign, bound, bad in (("≥", rule.low, lambda v, b: v < b), ("≤", rule.high, lambda v, b: v > b)):
            if bound is not None:
                aggs.append(weigh(bad(number, F.lit(bound))).alias(f"_r{len(bounds)}"))
                bounds.append((rule.column, f"{rule.column} {sign} {bound}"))

    def check(category, column, text, value, threshold, ok):
        return F.struct(
            F.lit(category).alias("category"),
            F.lit(column).alias("column"),
            F.lit(text).alias("check"),
            value.cast("double").alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        )

    checks = []
    for i, c in enumerate(df.columns):
        pct = percent(F.col(f"_n{i}"), F.col("_rows"))
        checks.append(check("Completeness", c, f"Null % ≤ {null_threshold}%", pct, null_threshold, pct <= null_threshold))
    dup = percent(F.col("_dups"), F.col("_rows"))
    unique = check("Uniqueness", "_all_", f"Duplicate % ≤ {dup_threshold}%", dup, dup_threshold, dup <= dup_threshold)
    checks.append(F.when(F.lit(duplicates), unique))
    for i, (c, text) in enumerate(bounds):
        checks.append(check("Range", c, text, F.col(f"_r{i}"), 0, F.col(f"_r{i}") == 0))
    return source.agg(*aggs).select(F.posexplode(F.array(*checks)).alias("check_no", "_c")).filter("_c is not null").select("check_no", "_c.*")


def scorecard(checks: DataFrame) -> DataFrame:
    """One row: score in percent (1 digit, ties to even), status and counts."""
    passed = F.count_if(F.col("status") == "PASS")
    warned = F.count_if(F.col("status") == "WARN")
    failed = F.count_if(F.col("status") == "FAIL")
    counts = checks.agg(
        passed.alias("passed"), warned.alias("warnings"), failed.alias("failed"), F.count(F.lit(1)).alias("total_checks")
    )
    return counts.select(
        F.when(F.col("total_checks") == 0, F.lit(100.0))
        .otherwise(percent(F.col("passed"), F.col("total_checks"), 1))
        .alias("dq_score_pct"),
        F.when(F.col("failed") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("dq_status"),
        "passed",
        "warnings",
        "failed",
        "total_checks",
    )


SHOWN = 5  # failed checks that a message names


def gate(card, *, on_fail: str = "block", min_score: float = 0.0, checks: DataFrame | None = None) -> None:
    """Raise when a check failed (`on_fail="block"`) or the score is below `min_score`.

    `card` is a collected scorecard row.
    """
    if on_fail not in ("block", "warn"):
        raise ValueError("on_fail is 'block' or 'warn'")
    if card["failed"] > 0 and on_fail == "block":
        detail = ""
        if checks is not None:
            # The first few in words; the rest is in the checks that were written, and its number is told.
            bad = checks.filter("status = 'FAIL'").orderBy("check_no").limit(SHOWN).collect()
            detail = "".join(f"\n  {r['column']}: {r['check']} (value: {r['value']})" for r in bad)
            if card["failed"] > len(bad):
                detail += f"\n  and {card['failed'] - len(bad)} more"
        raise QualityGateError(f"score {card['dq_score_pct']}%, {card['failed']} check(s) failed{detail}")
    if card["dq_score_pct"] < min_score:
        raise QualityGateError(f"score {card['dq_score_pct']}% is below {min_score}%")

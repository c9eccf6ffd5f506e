"""Bronze to silver: one projection from the mapping, then rules, clamp and dedup."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.masks import sha256_hex
from siltstone.functions.missing import nan_to_null
from siltstone.functions.numeric import to_number
from siltstone.functions.types import columns_of, family
from siltstone.operators.keys import q
from siltstone.operators.mapping import MappingRow
from siltstone.operators.order_stats import order_statistics
from siltstone.operators.ordered_fill import ordered_fill

# Parts of a name that mark an amount which cannot be negative.
CLAMP_WORDS = ("spend", "budget", "revenue", "amount", "cost", "price")


def fill_zero(df: DataFrame, column: str) -> Column:
    return F.coalesce(to_number(F.col(q(column)), df.schema[column].dataType), F.lit(0))


def fill_unknown(df: DataFrame, column: str) -> Column:
    col = F.col(q(column))
    text = col if family(df.schema[column].dataType) == "string" else col.cast("string")
    return F.coalesce(text, F.lit("UNKNOWN"))


def fill_sentinel(df: DataFrame, column: str) -> Column:
    """-1 in numeric columns, `N/A` in text; other types have no sentinel."""
    kind = family(df.schema[column].dataType)
    if kind not in ("numeric", "string"):
        raise ValueError(f"no sentinel for {column} ({kind})")
    return F.coalesce(F.col(q(column)), F.lit(-1) if kind == "numeric" else F.lit("N/A"))


def null_flag(column: str) -> Column:
    return F.col(q(column)).isNull().cast("int").alias(f"{column}_is_null")


def mean_of(df: DataFrame, column: str, kept: Sequence[Column] = ()) -> Column:
    """Mean over the rows that earlier drops keep."""
    value = to_number(F.col(q(column)), df.schema[column].dataType).cast("double")
    return F.avg(F.when(_all(kept), value) if kept else value)


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the column's mean, 0 where there is none; one extra scan of those columns."""
    means = df.agg(*[mean_of(df, c).alias(f"m{i}") for i, c in enumerate(columns)])
    index = {c: i for i, c in enumerate(columns)}
    return df.select(
        *[_mean_filled(df, c, means.select(f"m{index[c]}").scalar()).alias(c) if c in index else F.col(q(c)) for c in df.columns]
    )


def _mean_filled(df: DataFrame, column: str, mean: Column) -> Column:
    value = to_number(F.col(q(column)), df.schema[column].dataType).cast("double")
    return F.coalesce(value, mean, F.lit(0.0))


def medians(df: DataFrame, columns: Sequence[str], **limits: int) -> dict[str, float | None]:
    """Exact medians: the middle value, or the mean of the two middle ones."""
    numbers = df.select(
        *[to_number(F.col(q(c)), df.schema[c].dataType).cast("double").alias(c) for c in columns]
    )
    if not columns:
        return {}
    counts = numbers.agg(*[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    ranks = {c: sorted({(counts[i] - 1) // 2, counts[i] // 2}) for i, c in enumerate(columns) if counts[i]}
    found = order_statistics(numbers, ranks, **limits)
    return {
        c: sum(found[c, r] for r in ranks[c]) / len(ranks[c]) if c in ranks else None for c in columns
    }


def fill_median(df: DataFrame, columns: Sequence[str], **limits: int) -> DataFrame:
    values = medians(df, columns, **limits)
    return df.select(
        *[
            F.coalesce(F.col(q(c)).cast("double"), F.lit(values[c])).alias(c) if values.get(c) is not None else F.col(q(c))
            for c in df.columns
        ]
    )


def clamp_candidates(df: DataFrame, words: Sequence[str] = CLAMP_WORDS) -> list[str]:
    return [c for c in columns_of(df, "numeric") if any(w in c.lower() for w in words)]


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows and, per column, how many values lie below zero."""
    return df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(q(c)) < 0).alias(c) for c in columns]
    )


def clamp_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values below zero become 0 and are flagged in `<column>_had_negative`; nulls stay."""
    if not columns:
        return df
    clamped = set(columns)
    below = {c: F.col(q(c)) < 0 for c in columns}
    return df.select(
        *[
            F.when(below[c], F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(q(c))).alias(c) if c in clamped else F.col(q(c))
            for c in df.columns
        ],
        *[F.coalesce(below[c], F.lit(False)).cast("int").alias(f"{c}_had_negative") for c in columns],
    )


def drop_copies(df: DataFrame) -> DataFrame:
    """Identical rows once, nulls equal to nulls."""
    return df.dropDuplicates()


def split_rules(rules: str) -> list[tuple[str, str]]:
    """`column=expression` parts between semicolons; quotes protect semicolons, notes with an arrow are no rules."""
    parts = re.findall(r"(?:[^;'\"]|'[^']*'|\"[^\"]*\")+", rules)
    found = []
    for part in parts:
        name, eq, expression = part.strip().partition("=")
        if eq and "→" not in part:
            found.append((name.strip(), expression.strip()))
    return found


# Types whose text gives the same value again.
PLAIN_TYPES = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def apply_rules(
    df: DataFrame, rules: str, *, failures: list[tuple[str, str]] | None = None
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Spark SQL expressions, each seeing the columns of those before; a bad one is warned about and left out.

    A row whose expression raises (division by zero, a cast, an overflow) gets null,
    as long as the result is a number, text, a truth value or a time. With
    `failures` a helper column that tells these rows is left in and (rule, helper)
    added to the list.
    """
    applied = []
    for name, expression in split_rules(rules):
        try:
            kind = df.select(F.expr(expression)).schema[0].dataType
            if isinstance(kind, PLAIN_TYPES):
                # try_to_binary is null where what it is given raises; a letter in front tells null from failure.
                marked = F.expr(f"try_to_binary(coalesce(concat('v', CAST(({expression}) AS STRING)), 'n'), 'utf-8')")
                text = F.decode(F.col("_marked"), "utf-8")
                value = F.when(text.startswith("v"), F.substring(text, F.lit(2), F.length(text))).cast(kind)
                failed = f"_failed{len(applied)}"
                held = df.withColumn("_marked", marked).withColumn(name, value)
                df = held.withColumn(failed, F.col("_marked").isNull()).drop("_marked") if failures is not None else held.drop("_marked")
                if failures is not None:
                    failures.append((name, failed))
            else:
                df = df.withColumn(name, F.expr(expression))
            applied.append((name, expression))
        except AnalysisException as error:
            warnings.warn(f"rule left out: {name} = {expression}: {error}", stacklevel=2)
    return df, applied


@dataclass
class Silver:
    """The silver table, not yet computed, and what the log needs to know of it."""

    df: DataFrame
    source_rows: int | None = None
    kept_rows: int | None = None
    negatives: dict[str, int] = field(default_factory=dict)
    steps: list[dict] = field(default_factory=list)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def build_silver(
    df: DataFrame,
    mapping: Sequence[MappingRow],
    *,
    rules: str = "",
    order_by: Sequence[str] = (),
    clamp_words: Sequence[str] = CLAMP_WORDS,
    fixed_schema: bool = False,
    dedup: bool = True,
    counted: bool = True,
    before: Mapping[str, Column] | None = None,
) -> Silver:
    """Apply a mapping. `before` holds values for ordered fills from earlier increments.

    `fixed_schema=True` adds every flag column whether or not the data needs
    it, looks at no data, and is what streams use. Otherwise one aggregate over
    the amount columns decides which of them are clamped. `counted=False` skips
    the counters that only the log needs.
    """
    source = nan_to_null(df)
    base = source
    names = set(df.columns)
    rows = [r for r in mapping if r.source_column in names]
    kept: list[Column] = []
    pending_drops = 0
    pending_fills: list[str] = []
    mean_aggs: list[Column] = []
    changed: dict[str, Column] = {}
    means: dict[str, int] = {}
    flags: list[Column] = []
    steps: list[dict] = []
    counters: list[Column] = [F.count(F.lit(1)).alias("_rows")]

    def fill() -> None:
        """Fills that follow each other share one pass over the rows kept so far."""
        nonlocal base, pending_drops
        if pending_fills:
            base = ordered_fill(base.filter(_all(kept[pending_drops:])), pending_fills, order_by, before=before)
            pending_drops = len(kept)
            pending_fills.clear()

    for row in rows:
        name, col = row.source_column, F.col(q(row.source_column))
        strategy = row.strategy
        if row.silver_transform == "SHA256_hash":
            changed[name] = sha256_hex(col)
            steps.append({"kind": "hash", "column": name})
        elif strategy == "drop":
            fill()
            counters.append(F.count_if(_all(kept)).alias(f"_before_{name}"))
            kept.append(col.isNotNull())
            counters.append(F.count_if(_all(kept)).alias(f"_after_{name}"))
            steps.append({"kind": "drop", "column": name})
        elif strategy == "fill_zero":
            changed[name] = fill_zero(source, name)
            steps.append({"kind": "zero", "column": name})
        elif strategy == "fill_mean":
            means[name] = len(mean_aggs)
            mean_aggs.append(mean_of(source, name, kept).alias(f"m{len(mean_aggs)}"))
            steps.append({"kind": "mean", "column": name})
        elif strategy == "fill_median":
            value = medians(source.filter(_all(kept)), [name])[name]
            changed[name] = F.coalesce(to_number(col, source.schema[name].dataType).cast("double"), F.lit(value))
            steps.append({"kind": "median", "column": name})
        elif strategy == "fill_unknown":
            changed[name] = fill_unknown(source, name)
            steps.append({"kind": "unknown", "column": name})
        elif strategy == "sentinel":
            changed[name] = fill_sentinel(source, name)
            steps.append({"kind": "sentinel", "column": name})
        elif strategy == "flag":
            flags.append(null_flag(name))
            steps.append({"kind": "flag", "column": name})
        elif strategy == "ffill_bfill_else_drop":
            counters.append(F.count_if(_all(kept)).alias(f"_before_{name}"))
            counters.append(F.count_if(_all([*kept, col.isNull()])).alias(f"_gaps_{name}"))
            pending_fills.append(name)
            steps.append({"kind": "ordered", "column": name})

    fill()
    if mean_aggs:
        statistics = source.agg(*mean_aggs)
        for name, i in means.items():
            changed[name] = _mean_filled(source, name, statistics.select(f"m{i}").scalar())
    out = base.filter(_all(kept[pending_drops:])) if kept[pending_drops:] else base
    if changed or flags:
        out = out.select(
            *[changed[c].alias(c) if c in changed else F.col(q(c)) for c in base.columns], *flags
        )
    if rules:
        failures = [] if counted and not fixed_schema else None
        out, applied = apply_rules(out, rules, failures=failures)
        found = {}
        if failures:
            found = out.agg(*[F.count_if(helper).alias(c) for c, helper in failures]).first().asDict()
            out = out.drop(*[helper for _, helper in failures])
        steps += [{"kind": "rule", "column": c, "expression": e, "failed": found.get(c, 0)} for c, e in applied]

    silver = Silver(out, steps=steps)
    candidates = clamp_candidates(out, clamp_words)
    if counted and len(counters) > 1:
        row = source.agg(*counters).first()
        silver.source_rows = row["_rows"]
        for step in steps:
            for key in ("before", "after", "gaps"):
                if f"_{key}_{step['column']}" in row:
                    step[key] = row[f"_{key}_{step['column']}"]
    if fixed_schema:
        clamped = candidates
    elif candidates or counted:
        row = negative_counts(out, candidates).first()
        silver.kept_rows = row["_rows"]
        silver.negatives = {c: row[c] for c in candidates if row[c] > 0}
        clamped = list(silver.negatives)
        if silver.source_rows is None:
            silver.source_rows = silver.kept_rows
    else:
        clamped = []
    out = clamp_negatives(out, clamped)
    steps += [{"kind": "clamp", "column": c} for c in clamped]
    silver.df = drop_copies(out) if dedup else out
    return silver

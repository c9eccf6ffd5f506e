"""Data contracts: rules derived from a schema, all checked in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siltstone.functions.missing import is_missing, strip
from siltstone.functions.numeric import to_number
from siltstone.operators.keys import q


class Contract(NamedTuple):
    column: str
    rule_type: str
    rule: str
    description: str
    severity: str


# Formats, descriptions and the words that call for a rule.
EMAIL = r"^[\w\.\+\-]+@[\w\-]+\.[a-zA-Z]{2,}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
DESCRIPTIONS = {
    "not_null": "Column must not contain null values",
    "email": "Valid email format",
    "date": "ISO date format YYYY-MM-DD",
    "positive": "Must be non-negative",
    "rating": "Rating must be between 1 and 5",
    "score": "Score normalized between 0 and 1",
}
DATE_WORDS = ("date", "ts", "timestamp", "created", "updated")
SCORE_WORDS = ("score", "index", "rate", "ratio")
AMOUNT_WORDS = ("weight", "distance", "revenue", "amount", "count", "qty", "quantity", "price", "cost")

# Range rules by their text, as (low, high).
RANGES: dict[str, tuple[float | None, float | None]] = {
    "0 <= value <= 1": (0.0, 1.0),
    "1 <= value <= 5": (1.0, 5.0),
    "value >= 0": (0.0, None),
}


def build_contracts(schema: Iterable[Row]) -> list[Contract]:
    """Rules for columns given as rows of column, dtype family and null_rate."""
    found = []
    for r in schema:
        name, low = r["column"], r["column"].lower()

        def add(kind, rule, about, severity, name=name):
            found.append(Contract(name, kind, rule, DESCRIPTIONS[about], severity))

        def named(words, low=low):
            return any(w in low for w in words)

        if r["null_rate"] == 0:
            add("NOT_NULL", "null_rate == 0", "not_null", "FAIL")
        if named(("email",)):
            add("FORMAT", EMAIL, "email", "WARN")
        if named(DATE_WORDS):
            add("FORMAT", ISO_DATE, "date", "WARN")
        if named(("rating",)):
            add("RANGE", "1 <= value <= 5", "rating", "FAIL")
        if r["dtype"] == "numeric" and named(SCORE_WORDS):
            add("RANGE", "0 <= value <= 1", "score", "WARN")
        if r["dtype"] == "numeric" and named(AMOUNT_WORDS):
            add("RANGE", "value >= 0", "positive", "FAIL")
    return found


def validate_contracts(df: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """One row per contract, numbered in `contract_no`; one aggregate serves them all.

    NOT_NULL violations are shared out over all rows, the others over present
    values. Patterns are ASCII, as in other engines; write `(?U)` to change it.
    """
    spark = df.sparkSession
    if not contracts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    types = {f.name: f.dataType for f in df.schema.fields}
    used = list(dict.fromkeys(c.column for c in contracts))
    # Text and numbers of each column are worked out once per row, however many
    # contracts look at them. A column the table lacks is missing in every row.
    fields = []
    for k, name in enumerate(used):
        col, kind = (F.col(q(name)), types[name]) if name in types else (F.lit(None), None)
        gone = F.lit(True) if kind is None else is_missing(col, kind)
        rules = {c.rule_type for c in contracts if c.column == name}
        fields.append(gone.alias(f"_g{k}"))
        if "FORMAT" in rules:
            fields.append(strip(col.cast("string")).alias(f"_t{k}"))
        if "RANGE" in rules:
            number = F.lit(None) if kind is None else to_number(col, kind)
            fields.append(number.cast("double").alias(f"_x{k}"))
    prepared = df.select(*fields)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(~F.col(f"_g{k}")).alias(f"_p{k}") for k in range(len(used))]
    for i, c in enumerate(contracts):
        k = used.index(c.column)
        gone, value = F.col(f"_g{k}"), F.col(f"_x{k}")
        if c.rule_type == "NOT_NULL":
            bad = gone
        elif c.rule_type == "FORMAT":
            bad = ~gone & ~F.col(f"_t{k}").rlike(c.rule)
        elif c.rule_type == "RANGE":
            if c.rule not in RANGES:
                raise ValueError(f"unknown range rule {c.rule!r}, choose from {list(RANGES)}")
            low, high = RANGES[c.rule]
            outside = value.isNull()
            if low is not None:
                outside = outside | (value < low)
            if high is not None:
                outside = outside | (value > high)
            bad = ~gone & outside
        else:
            raise ValueError(f"unknown rule type {c.rule_type!r}, choose from NOT_NULL, FORMAT, RANGE")
        aggs.append(F.count_if(bad).alias(f"_b{i}"))
    rows = []
    for i, c in enumerate(contracts):
        bad = F.col(f"_b{i}")
        base = F.col("_rows") if c.rule_type == "NOT_NULL" else F.col(f"_p{used.index(c.column)}")
        share = bad / F.greatest(base, F.lit(1)).cast("double")
        rate = F.bround(share * 100, 2)
        if c.rule_type == "FORMAT":
            status = F.when(share > 0.10, F.lit("FAIL")).when(share > 0.01, F.lit("WARN")).otherwise(F.lit("PASS"))
        else:
            on_bad = "FAIL" if c.rule_type == "NOT_NULL" else c.severity
            status = F.when(bad > 0, F.lit(on_bad)).otherwise(F.lit("PASS"))
        rows.append(
            F.struct(
                F.lit(i).alias("contract_no"),
                *[F.lit(v).alias(n) for n, v in c._asdict().items()],
                status.alias("status"),
                bad.alias("violations"),
                rate.alias("violation_rate_pct"),
                F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" violations ("), rate.cast("string"), F.lit("%)")))
                .otherwise(F.lit("All values conform"))
                .alias("detail"),
            )
        )
    return prepared.agg(*aggs).select(F.inline(F.array(*rows)))


RESULT_SCHEMA = (
    "contract_no int, column string, rule_type string, rule string, description string, severity string, "
    "status string, violations bigint, violation_rate_pct double, detail string"
)

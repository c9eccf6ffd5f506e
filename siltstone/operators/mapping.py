"""Source-to-target mapping: one decision per column, and the schemas that follow."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Row
from pyspark.sql import types as T

from siltstone.functions.types import family

NULL_STRATEGIES = (
    "none_needed", "drop", "fill_zero", "fill_mean", "fill_median", "fill_unknown",
    "flag", "ffill_bfill_else_drop", "sentinel",
)


class MappingRow(NamedTuple):
    source_column: str
    source_dtype: str
    silver_column: str
    silver_transform: str
    gold_column: str
    is_pii: bool
    is_key: bool
    null_pct: float
    scd_type: str

    @property
    def strategy(self) -> str | None:
        head, _, tail = self.silver_transform.partition(":")
        return tail if head == "null_handle" else None


def infer_null_strategy(name: str, data_type: T.DataType, null_pct: float, distinct_share: float = 0.0) -> str:
    """Near-unique id / key columns are filled from their neighbours, others by type and null share."""
    if null_pct == 0:
        return "none_needed"
    low = name.lower()
    if distinct_share >= 0.80 and ("id" in low or "key" in low):
        return "ffill_bfill_else_drop"
    kind = family(data_type)
    if kind == "numeric":
        return "fill_mean" if null_pct < 5 else "fill_zero"
    if kind == "string" and null_pct < 10:
        return "fill_unknown"
    return "flag"


def needs_cardinality(schema: T.StructType) -> list[str]:
    """Columns whose strategy depends on how many distinct values they hold."""
    return [f.name for f in schema.fields if "id" in f.name.lower() or "key" in f.name.lower()]


def build_mapping(
    schema: T.StructType,
    profile: Iterable[Row],
    *,
    pii: Sequence[str] = (),
    keys: Sequence[str] = (),
    scd_type: str = "1",
    override: str | Mapping[str, str] = "",
    rename_masked: bool = False,
) -> list[MappingRow]:
    """One row per column; hashing wins over null handling, which wins over passing through.

    `override` is one strategy for all columns with nulls, or one per column.
    """
    per_column = override if isinstance(override, Mapping) else {}
    for_all = override if isinstance(override, str) else ""
    for strategy in [*per_column.values(), *([for_all] if for_all else [])]:
        if strategy not in NULL_STRATEGIES:
            raise ValueError(f"unknown null strategy {strategy!r}, choose from {NULL_STRATEGIES}")
    stats = {r["column"]: r for r in profile}
    rows = []
    for f in schema.fields:
        found = stats[f.name]
        null_pct, total = found["null_pct"], found["total_rows"] or 1
        personal = f.name in pii
        transform = "pass_through"
        if personal:
            transform = "SHA256_hash"
        elif null_pct > 0:
            share = (found["cardinality"] or 0) / total
            strategy = per_column.get(f.name) or for_all or infer_null_strategy(f.name, f.dataType, null_pct, share)
            transform = f"null_handle:{strategy}"
        rows.append(
            MappingRow(
                source_column=f.name,
                source_dtype=f.dataType.simpleString(),
                silver_column=f.name,
                silver_transform=transform,
                gold_column=f"{f.name}_masked" if personal and rename_masked else f.name,
                is_pii=personal,
                is_key=f.name in keys,
                null_pct=null_pct,
                scd_type=scd_type if f.name in keys else "n/a",
            )
        )
    return rows


def with_personal(mapping: Sequence[MappingRow], schema: T.StructType, pii: Sequence[str]) -> list[MappingRow]:
    """A saved mapping, which also hashes the personal columns that it does not know."""
    known = {row.source_column for row in mapping}
    fresh = [f for f in schema.fields if f.name not in known and f.name in pii]
    return [
        *mapping,
        *[MappingRow(f.name, f.dataType.simpleString(), f.name, "SHA256_hash", f.name, True, False, 0.0, "n/a") for f in fresh],
    ]


MAPPING_SCHEMA = (
    "source_column string, source_dtype string, silver_column string, silver_transform string, "
    "gold_column string, is_pii boolean, is_key boolean, null_pct double, scd_type string"
)

# SQL type per Spark type in generated DDL; others are VARCHAR(512).
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "tinyint": "SMALLINT",
    "date": "DATE",
    "double": "DOUBLE PRECISION",
    "float": "REAL",
    "string": "VARCHAR(512)",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}

# The version columns of a gold table with history.
SCD2_DDL = (
    "_valid_from TIMESTAMP NOT NULL",
    "_valid_to TIMESTAMP",
    "_is_current BOOLEAN NOT NULL DEFAULT TRUE",
    "_change_hash VARCHAR(64)",
    "_last_updated TIMESTAMP NOT NULL",
)


def sql_type(row: MappingRow) -> str:
    """The type of a column in a CREATE TABLE text; masked values are text, whatever they were."""
    if not row.is_pii and row.source_dtype.startswith("decimal("):
        return row.source_dtype.upper()
    return SQL_TYPES["string"] if row.is_pii else SQL_TYPES.get(row.source_dtype, SQL_TYPES["string"])


def build_ddl(mapping: Sequence[MappingRow], table: str, layer: str = "silver") -> str:
    """CREATE TABLE text for a layer; keys are NOT NULL, gold has the version columns."""
    lines = []
    for row in mapping:
        name = row.silver_column if layer == "silver" else row.gold_column
        lines.append(f"{name} {sql_type(row)} {'NOT NULL' if row.is_key else 'NULL'}")
    if layer == "gold":
        lines += SCD2_DDL
    body = ",\n".join("    " + line for line in lines)
    return f"CREATE TABLE {table}_{layer} (\n{body}\n);"


def target_schema(mapping: Sequence[MappingRow], source: T.StructType, layer: str = "silver") -> T.StructType:
    """The same as a Spark schema."""
    fields = []
    for row in mapping:
        data_type = T.StringType() if row.is_pii else source[row.source_column].dataType
        name = row.silver_column if layer == "silver" else row.gold_column
        fields.append(T.StructField(name, data_type, not row.is_key))
    if layer == "gold":
        fields += SCD2_FIELDS
    return T.StructType(fields)


SCD2_FIELDS = [
    T.StructField("_valid_from", T.TimestampType(), False),
    T.StructField("_valid_to", T.TimestampType()),
    T.StructField("_is_current", T.BooleanType(), False),
    T.StructField("_change_hash", T.StringType()),
    T.StructField("_last_updated", T.TimestampType(), False),
]

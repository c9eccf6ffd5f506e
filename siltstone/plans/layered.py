"""A whole run: source → bronze → silver → scorecard → gate → gold."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import pii_columns
from siltstone.operators.gold import build_gold, merge_groups, split_columns
from siltstone.operators.incremental import Frontier, date_window
from siltstone.operators.keys import one_row_per_key
from siltstone.operators.mapping import MappingRow, build_ddl, build_mapping, needs_cardinality, with_personal
from siltstone.operators.profile import column_profile, timestamp_column
from siltstone.operators.ordered_fill import FillState
from siltstone.operators.quality import gate, quality_checks, scorecard
from siltstone.operators.scd2 import classify, default_keys, first_load, scd1_upsert, versions_after, widened
from siltstone.operators.silver import build_silver
from siltstone.plans.runlog import lineage_edges, log_table, transform_log
from siltstone.sources import writers
from siltstone.sources.tables import HistoryTable, KeyedTable, PartedTable, VersionedTable


@dataclass
class RunConfig:
    """What a run does. Paths must be visible to all executors.

    `silver_table_mode` and `gold_table_mode` are `table_mode` where not given.
    An appended table gets the rows of the run, once per run id; gold that is a
    whole (an aggregate, an upsert, a history) can only be replaced. Incremental
    runs have all flag columns unless `fixed_schema` is false, so that what they
    write fits together.
    """

    root: str
    keys: tuple[str, ...] = ()
    timestamp: str | None = None
    window_start: str | None = None
    window_end: str | None = None
    watermark: str | None = None
    watermark_keep_null: bool = True
    null_override: str | Mapping[str, str] = ""
    order_by: tuple[str, ...] = ()
    pii_match: str = "substring"
    pii_allow: tuple[str, ...] = ()
    pii_deny: tuple[str, ...] = ()
    rename_masked: bool = False  # in gold, masked columns are named so
    rules: str = ""
    ranges: str = ""
    null_threshold: float = 5.0
    dup_threshold: float = 1.0
    min_score: float = 0.0
    on_fail: str = "block"
    gold_mode: str = "passthrough"  # passthrough, aggregate, scd1, scd2
    group_by: str = ""
    batch_order: tuple[str, ...] = ()
    expire_missing: bool = False
    repeated: str = "raise"  # a key that comes several times in a later load of a history, see `classify`
    buckets: int = 64  # folders of gold in an upsert or a history
    fixed_schema: bool | None = None
    profile_distinct: str = "approx"
    silver_table: str | None = None
    gold_table: str | None = None
    table_mode: str = "replace"
    silver_table_mode: str | None = None
    gold_table_mode: str | None = None
    as_of: str | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)


@dataclass
class RunResult:
    """Lazy views of what was written, and the small records of the run."""

    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    checks: DataFrame
    card: Mapping
    log: DataFrame
    profile: DataFrame | None
    mapping: list[MappingRow]
    note: str
    gold_counts: DataFrame
    lineage: DataFrame
    ddl: DataFrame


def run(spark: SparkSession, source: DataFrame, config: RunConfig, mapping: list[MappingRow] | None = None) -> RunResult:
    """One load. Only one-row aggregates and the profile reach the driver.

    Each layer is written once and the next reads what was written, so a lost
    executor costs a few tasks, not the run, and counters come from the written
    tables: a rerun task cannot count twice. A saved mapping may be passed in
    so that later loads keep the first one's decisions; a column it does not know
    is hashed if its name is personal and passes through otherwise.

    An increment is one part of bronze, silver and a copied or aggregated gold,
    named by its window or else its run id; the same window again replaces its
    part. Windows must not overlap: rows in two of them are in both parts. A full
    load leaves the parts of bronze and silver alone and starts gold anew.
    """
    if config.gold_table and _mode(config, "gold") == "append" and config.gold_mode != "passthrough":
        raise ValueError(f"gold of mode {config.gold_mode} is a whole, its table can only be replaced")
    windowed = config.window_start is not None or config.window_end is not None
    incremental = windowed or config.watermark is not None
    stamp = config.timestamp or timestamp_column(source)
    frontier = Frontier(spark, f"{config.root}/watermark")
    if config.watermark and frontier.log.has(config.run_id):
        raise ValueError(f"run {config.run_id} is complete and the mark has moved: its rows would not be found again")
    if windowed:
        source = date_window(source, stamp, config.window_start, config.window_end)
    if config.watermark and config.watermark in source.columns:
        source = frontier.unseen(source, config.watermark, keep_null=config.watermark_keep_null)
    part = _part(config, windowed)
    bronze = _written(spark, source, config, "bronze", part if incremental else None)

    profile = None
    personal = pii_columns(bronze.columns, match=config.pii_match, allow=config.pii_allow, deny=config.pii_deny)
    if mapping is None:
        exact = needs_cardinality(bronze.schema) if not config.null_override else []
        found = column_profile(bronze, distinct=config.profile_distinct, exact_for=exact, scan="per_column")
        writers.append_records(found, f"{config.root}/profile", config.run_id)
        profile = writers.read_records(spark, f"{config.root}/profile", config.run_id)
        mapping = build_mapping(
            bronze.schema,
            profile.collect(),
            pii=personal,
            keys=config.keys,
            scd_type="2" if config.gold_mode == "scd2" else "1",
            override=config.null_override,
            rename_masked=config.rename_masked,
        )
    else:
        mapping = with_personal(mapping, bronze.schema, personal)
    fixed = incremental if config.fixed_schema is None else config.fixed_schema
    order = config.order_by or _fill_order(bronze, mapping, (stamp, *config.keys))
    filled = [row.source_column for row in mapping if row.strategy == "ffill_bfill_else_drop" and row.source_column in bronze.columns]
    fills = FillState(spark, f"{config.root}/fill_state", bronze.schema, filled, order) if incremental and filled else None
    before = fills.values(bronze, part) if fills else None
    built = build_silver(bronze, mapping, rules=config.rules, order_by=order, fixed_schema=fixed, before=before)
    if built.source_rows is None:
        built.source_rows = bronze.count()
    silver = _written(spark, built.df, config, "silver", part if incremental else None)

    checks = quality_checks(
        silver, null_threshold=config.null_threshold, dup_threshold=config.dup_threshold,
        ranges=config.ranges, distinct_rows=True,
    )
    writers.append_records(checks, f"{config.root}/dq_checks", config.run_id)
    checks = writers.read_records(spark, f"{config.root}/dq_checks", config.run_id)
    card = scorecard(checks).first().asDict()
    log = log_table(spark, transform_log(built, silver.count()))
    writers.append_records(log, f"{config.root}/run_log", config.run_id)
    gate(card, on_fail=config.on_fail, min_score=config.min_score, checks=checks)

    names = {row.silver_column: row.gold_column for row in mapping if row.gold_column != row.silver_column and row.silver_column in silver.columns}
    gold, added, note, versions = _gold(spark, silver.withColumnsRenamed(names), _renamed(config, names), incremental, part)
    gold_counts, lineage, ddl = _records(spark, config, log, mapping, silver.count(), gold.count(), versions, note)
    _to_table(spark, config, "silver", config.silver_table, silver, silver)
    _to_table(spark, config, "gold", config.gold_table, gold, added)
    if fills:
        fills.save(bronze, part)
    if config.watermark and config.watermark in bronze.columns:
        # Only now that everything is written; a failed run is repeated from the old mark.
        frontier.advance(bronze, config.watermark, config.run_id)
    return RunResult(bronze, silver, gold, checks, card, log, profile, mapping, note, gold_counts, lineage, ddl)


def _moment(bound: str | None) -> str:
    return "open" if bound is None else dt.datetime.fromisoformat(str(bound)).strftime("%Y%m%dT%H%M%S.%f%z")


def _part(config: RunConfig, windowed: bool) -> str:
    """The name of an increment: its whole window, so that two of one day differ, or its run."""
    return f"{_moment(config.window_start)}_{_moment(config.window_end)}" if windowed else f"run-{config.run_id}"


def _renamed(config: RunConfig, names: Mapping[str, str]) -> RunConfig:
    """The settings of gold in gold's names."""
    new = lambda columns: tuple(names.get(c, c) for c in columns)
    group = ",".join(new(split_columns(config.group_by)))
    return replace(config, keys=new(config.keys), batch_order=new(config.batch_order), group_by=group) if names else config


GOLD_COUNTS = "mode string, note string, rows_in bigint, rows_out bigint, versions_started bigint, versions_ended bigint"


def _records(
    spark: SparkSession, config: RunConfig, log: DataFrame, mapping: list[MappingRow], rows_in: int, rows_out: int,
    versions: tuple[int | None, int | None], note: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What became of gold, the edges from bronze to gold, and the tables' DDL, kept beside the log."""
    edge = [("silver", "gold", max(rows_out, 1), f"{rows_out:,d} rows")]
    edges = lineage_edges(log, "bronze", "silver")
    table = (config.gold_table or "sales").split(".")[-1]
    records = {
        "gold_counts": spark.createDataFrame([(config.gold_mode, note, rows_in, rows_out, *versions)], GOLD_COUNTS),
        "lineage": edges.unionByName(spark.createDataFrame(edge, "`from` string, `to` string, rows bigint, label string")),
        "ddl": spark.createDataFrame([(layer, build_ddl(mapping, table, layer)) for layer in ("silver", "gold")], "layer string, ddl string"),
    }
    for name, rows in records.items():
        writers.append_records(rows, f"{config.root}/{name}", config.run_id)
    return tuple(writers.read_records(spark, f"{config.root}/{name}", config.run_id) for name in records)


def _written(spark: SparkSession, rows: DataFrame, config: RunConfig, layer: str, part: str | None) -> DataFrame:
    """A layer as it was written: a part of the increments, published when it is whole, or all of a full load."""
    if part is None:
        table = VersionedTable(spark, f"{config.root}/{layer}")
        table.replace(rows, config.run_id)
        return table.read()
    parts = PartedTable(spark, f"{config.root}/{layer}_parts")
    parts.add_part(rows, part)
    return parts.read_part(part)


def read_layer(spark: SparkSession, root: str, layer: str, *, increments: bool = False) -> DataFrame | None:
    """Bronze or silver as runs have written it: the last full load, or all parts of the increments."""
    return PartedTable(spark, f"{root}/{layer}_parts").read() if increments else VersionedTable(spark, f"{root}/{layer}").read()


def _fill_order(bronze: DataFrame, mapping: list[MappingRow], wanted: tuple) -> tuple[str, ...]:
    """The wanted order columns but for those to be filled along it; all other columns where none is left."""
    filled = {row.source_column for row in mapping if row.strategy == "ffill_bfill_else_drop"}
    left = tuple(dict.fromkeys(c for c in wanted if c and c not in filled))
    return left or tuple(c for c in bronze.columns if c not in filled)


def _mode(config: RunConfig, layer: str) -> str:
    return (config.silver_table_mode if layer == "silver" else config.gold_table_mode) or config.table_mode


def _to_table(spark: SparkSession, config: RunConfig, layer: str, name: str | None, whole: DataFrame, added: DataFrame) -> None:
    """Replace a catalog table by the whole layer, or append the run's rows; a repeated run replaces its own."""
    if name is None:
        return
    mode = _mode(config, layer)
    if mode == "append":
        writers.append_run(added, name, config.run_id)
    else:
        writers.write_table(whole, name, mode=mode)


def _gold(
    spark: SparkSession, silver: DataFrame, config: RunConfig, incremental: bool, part: str
) -> tuple[DataFrame, DataFrame, str, tuple[int | None, int | None]]:
    """All of gold, the rows this run adds to a copy, what was done, and versions started and ended by a history."""
    as_of = config.as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    path = f"{config.root}/gold_{config.gold_mode}"
    if config.gold_mode == "scd2":
        table = HistoryTable(spark, path, config.buckets)
        apply_batch(
            table, silver, config.keys, as_of, label=config.run_id, order_by=config.batch_order,
            expire_missing=config.expire_missing, repeated=config.repeated,
        )
        return table.read(), silver, "SCD type 2", _versions(table, as_of)
    if config.gold_mode == "scd1":
        keyed = KeyedTable(spark, path, config.buckets)
        if incremental:
            upsert(keyed, silver, config.keys, label=config.run_id, order_by=config.batch_order)
        else:
            keys, _ = default_keys(silver.columns, config.keys)
            keyed.write(scd1_upsert(None, silver, keys, config.batch_order), config.run_id, keys)
        return keyed.read(), silver, "SCD type 1", (None, None)
    group = split_columns(config.group_by) if config.gold_mode == "aggregate" else []
    rows, note = build_gold(silver, group)
    keys = [c for c in group if c in silver.columns]
    summed = note.startswith("Aggregated")
    whole = VersionedTable(spark, path)
    # An aggregate keeps the sums of each load, which are small, beside the merged table.
    parts = PartedTable(spark, f"{path}_parts" if summed else path)
    if incremental:
        parts.add_part(rows, part)
    else:
        parts.replace(rows, config.run_id)
    if summed:
        whole.replace(merge_groups(parts.read(), keys), config.run_id)
        return whole.read(), rows, note, (None, None)
    return parts.read(), rows, note, (None, None)


def _versions(table: HistoryTable, as_of: str) -> tuple[int, int]:
    """Versions that the last batch has started and ended, from the folders it wrote; none if it was known already."""
    if table.last is None:
        return 0, 0
    rows = table.written(table.last, table.schema())
    # A version that others of its batch follow begins and ends in one.
    now = F.lit(as_of).cast("timestamp")
    return tuple(rows.agg(F.count_if(F.col("_valid_from") == now), F.count_if(~F.col("_is_current"))).first())


def apply_batch(
    table: HistoryTable, batch: DataFrame, keys, as_of, *, label: str, order_by=(), expire_missing: bool = False, repeated: str = "raise"
) -> bool:
    """Merge a batch into a history table once: a label that is already published is skipped.

    Only the folders of the batch's keys are read and written, all of them where missing keys end.
    The first batch must hold a key once; later ones do as `repeated` says (`classify`).
    """
    if table.has(label):
        return False
    keys, tracked = default_keys(batch.columns, keys)
    if table.schema() is None:
        rows, touched = first_load(one_row_per_key(batch, keys, order_by), tracked, as_of), None
    else:
        touched = None if expire_missing else table.touched(batch, keys)
        current = widened(table.current(touched), batch)
        classified = classify(current, batch, keys, tracked, order_by=order_by, snapshot=expire_missing, repeated=repeated)
        rows = versions_after(classified, current.columns, as_of, expire_missing=expire_missing)
    table.write(rows, label, keys, touched, ended=~F.col("_is_current"))
    return True


def upsert(table: KeyedTable, batch: DataFrame, keys, *, label: str, order_by=(), repeated: str = "raise") -> bool:
    """Put a batch into a table of one row per key, once; only the folders of its keys are read and written.

    With `repeated="pairs"` a key may have several rows (`scd1_upsert`).
    """
    if table.has(label):
        return False
    keys, _ = default_keys(batch.columns, keys)
    touched = None if table.schema() is None else table.touched(batch, keys)
    table.write(scd1_upsert(table.current(touched), batch, keys, order_by, repeated=repeated), label, keys, touched)
    return True

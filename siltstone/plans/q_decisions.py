"""Queries whose answer is a decision: names, strategies, contracts, gates, stored state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from siltstone.functions.names import RECORD_PII, date_like_columns, pii_columns
from siltstone.operators import contracts, evolution
from siltstone.operators.clean import normalise_names
from siltstone.operators.incremental import load_watermark, newer_than, save_watermark
from siltstone.operators.mapping import MAPPING_SCHEMA, build_ddl, build_mapping
from siltstone.operators.pii import mask_columns
from siltstone.operators.profile import column_profile, record_schema, timestamp_column
from siltstone.operators.quality import QualityGateError, gate, quality_checks, scorecard
from siltstone.operators.silver import build_silver
from siltstone.plans.inputs import DIRTY, DIRTY_COLUMNS, GAPPY, dirty_sales, gappy_sales, snapshots, table
from siltstone.plans.layered import apply_batch
from siltstone.plans.q_history import FIRST, MERGED, SECOND, _readable
from siltstone.plans.q_profile import profile_sql
from siltstone.plans.q_quality import DRIFT, RATED, RATED_RULES, drifted, rated
from siltstone.plans.registry import query
from siltstone.session import shared_dir
from siltstone.sources import readers, writers
from siltstone.sources.tables import HistoryTable


@query("s01_detected_sources", "SELECT 'csv' AS kind, COUNT(*) AS n FROM supplier UNION ALL SELECT 'parquet', COUNT(*) FROM supplier UNION ALL SELECT 'json', COUNT(*) FROM supplier")
def _detected(spark, sf_dir):
    # One table under three extensions; only the extension says how to read it.
    source = table(spark, sf_dir, "supplier")
    root = shared_dir(spark, "sources")
    writers.write_layer(source, f"{root}/s.csv", fmt="csv")
    writers.write_layer(source, f"{root}/s.parquet")
    writers.write_layer(source, f"{root}/s.json", fmt="json")
    counts = []
    for kind in ("csv", "parquet", "json"):
        rows = readers.load(spark, f"{root}/s.{kind}", schema=source.schema)
        counts.append(rows.agg(F.lit(kind).alias("kind"), F.count("s_suppkey").alias("n")))
    return readers.union_all(counts)


@query(
    "p05_date_like_columns",
    DIRTY + """SELECT 'transaction_date' AS "column", MIN(transaction_date) AS least, MAX(transaction_date) AS greatest FROM dirty
    UNION ALL SELECT 'created_at', strftime(MIN(created_at), '%Y-%m-%d'), strftime(MAX(created_at), '%Y-%m-%d') FROM dirty""",
)
def _date_like(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir)
    names = date_like_columns(sales.columns)
    days = sales.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("date").alias("day")) for c in names])))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return days.groupBy("column").agg(day(F.min("day")).alias("least"), day(F.max("day")).alias("greatest"))


@query("p06_timestamp_column", "SELECT 'created' AS \"column\", COUNT(o_orderdate) AS values FROM orders")
def _timestamp(spark, sf_dir):
    # Found by parsing: neither the name nor the type gives it away.
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"))
    name = timestamp_column(orders)
    return orders.agg(F.lit(name).alias("column"), F.count(name).alias("values"))


@query(
    "m01_stage_keywords",
    "SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, c_mktsegment FROM customer",
)
def _stage_keywords(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return mask_columns(customer, pii_columns(customer.columns), "sha256")


@query(
    "m02_record_keywords",
    "SELECT s_suppkey, s_name, '[REDACTED]' AS \"Full Name\", '[REDACTED]' AS postal_code FROM supplier",
)
def _record_keywords(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.col("s_name").alias("Full Name"), F.col("s_nationkey").alias("postal_code")
    )
    return mask_columns(supplier, pii_columns(supplier.columns, RECORD_PII), "redact")


@query("f03_saved_watermark", "SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def _watermark(spark, sf_dir):
    # A first load up to a day saves its watermark; the next load reads on from there.
    events = table(spark, sf_dir, "events")
    path = shared_dir(spark, "watermark")
    loaded = events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).agg(F.max("ts").cast("string")).first()[0]
    save_watermark(spark, path, loaded, at=dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    return newer_than(events, "ts", load_watermark(spark, path).watermark).select("event_id", "user_id", "value")


@query("f04_normalised_names", "SELECT c_custkey AS customer_key_, c_name AS full_name, c_acctbal AS balance____ FROM customer")
def _names(spark, sf_dir):
    return normalise_names(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("Customer Key#"), F.col("c_name").alias(" full_NAME "), F.col("c_acctbal").alias("Balance (€)")
        )
    )


def _strategy_sql(column: str, kind: str) -> str:
    """SQL of the strategy that the profile of one column gives."""
    low = column.lower()
    rule = "null_pct = 0 THEN 'pass_through'"
    if "id" in low or "key" in low:
        rule += " WHEN cardinality * 1.0 / total_rows >= 0.8 THEN 'null_handle:ffill_bfill_else_drop'"
    if kind in ("bigint", "double"):
        rule += " WHEN null_pct < 5 THEN 'null_handle:fill_mean' ELSE 'null_handle:fill_zero'"
    elif kind == "string":
        rule += " WHEN null_pct < 10 THEN 'null_handle:fill_unknown' ELSE 'null_handle:flag'"
    else:
        rule += " ELSE 'null_handle:flag'"
    return f"""SELECT "column", CASE WHEN {rule} END AS silver_transform, null_pct FROM profile WHERE "column" = '{column}'"""


NOT_PERSONAL = [(c, t) for c, t in DIRTY_COLUMNS if c not in ("customer_email", "customer_phone")]


@query(
    "n00_null_strategies",
    GAPPY + ", profile AS (" + profile_sql("gappy", DIRTY_COLUMNS) + ") " + " UNION ALL ".join(_strategy_sql(c, t) for c, t in NOT_PERSONAL)
    + " UNION ALL SELECT \"column\", 'SHA256_hash', null_pct FROM profile WHERE \"column\" IN ('customer_email', 'customer_phone')",
)
def _strategies(spark, sf_dir):
    sales = gappy_sales(spark, sf_dir)
    mapping = build_mapping(sales.schema, column_profile(sales).collect(), pii=pii_columns(sales.columns))
    rows = spark.createDataFrame([tuple(r) for r in mapping], MAPPING_SCHEMA)
    return rows.select(F.col("source_column").alias("column"), "silver_transform", "null_pct")


@query(
    "n06_key_fill_mapping",
    DIRTY + """, keyed AS (SELECT DISTINCT transaction_id, CASE WHEN transaction_id % 9 = 0 THEN NULL ELSE transaction_id * 2 END AS receipt_id FROM dirty),
    filled AS (SELECT transaction_id, LAST_VALUE(receipt_id IGNORE NULLS) OVER (ORDER BY transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up,
      FIRST_VALUE(receipt_id IGNORE NULLS) OVER (ORDER BY transaction_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS down FROM keyed)
    SELECT transaction_id, COALESCE(up, down) AS receipt_id FROM filled""",
)
def _key_fill(spark, sf_dir):
    # The profile finds a near-unique id with gaps, and the mapping fills it along the order column.
    key = F.col("transaction_id")
    sales = dirty_sales(spark, sf_dir).select("transaction_id", F.when(key % 9 != 0, key * 2).alias("receipt_id"))
    mapping = build_mapping(sales.schema, column_profile(sales).collect())
    return build_silver(sales, mapping, order_by=["transaction_id"]).df


@query(
    "f12_table_definitions",
    GAPPY + ", profile AS (" + profile_sql("gappy", [("transaction_id", "bigint"), ("customer_email", "string"), ("unit_price", "double")]) + """)
    SELECT COUNT(*) AS columns, SUM(null_count)::BIGINT AS nulls, 'CREATE TABLE sales_silver (' || chr(10) || '    transaction_id BIGINT NOT NULL,' || chr(10) || '    customer_email VARCHAR(512) NULL,' || chr(10)
    || '    unit_price DOUBLE PRECISION NULL' || chr(10) || ');' AS ddl FROM profile""",
)
def _ddl(spark, sf_dir):
    sales = gappy_sales(spark, sf_dir).select("transaction_id", "customer_email", "unit_price")
    profile = column_profile(sales, distinct="none")
    mapping = build_mapping(sales.schema, profile.collect(), pii=pii_columns(sales.columns), keys=["transaction_id"], override="flag")
    return profile.agg(F.count(F.lit(1)).alias("columns"), F.sum("null_count").alias("nulls")).withColumn("ddl", F.lit(build_ddl(mapping, "sales")))


def _rules_sql() -> str:
    parts = []
    for i, (column, kind, rule, severity) in enumerate(RATED_RULES):
        text = rule.replace("'", "''")
        row = f"SELECT '{column}' AS \"column\", '{kind}' AS rule_type, '{text}' AS rule, '{severity}' AS severity"
        if kind == "NOT_NULL":
            row += f" FROM (SELECT COUNT(*) FILTER (WHERE {column} IS NULL OR trim(CAST({column} AS VARCHAR)) IN ('', 'None', 'null')) AS gone FROM rated) WHERE gone = 0"
        parts.append(row)
    return " UNION ALL ".join(parts)


@query("r01_built_contracts", RATED + _rules_sql())
def _contracts(spark, sf_dir):
    made = contracts.build_contracts(record_schema(rated(spark, sf_dir), distinct="none").orderBy("position").collect())
    return spark.createDataFrame([tuple(c) for c in made], "column string, rule_type string, rule string, description string, severity string").drop("description")


GATES = (("block", 0.0), ("warn", 0.0), ("warn", 60.0), ("warn", 99.0))


@query(
    "v05_gate_outcomes",
    DIRTY + ", rates AS (" + " UNION ALL ".join(f"SELECT round_even((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 2) <= 5.0 AS ok FROM dirty" for c, _ in DIRTY_COLUMNS)
    + """ UNION ALL SELECT round_even((a.n - b.n) * 100.0 / a.n, 2) <= 1.0 FROM (SELECT COUNT(*) AS n FROM dirty) a, (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM dirty)) b),
    card AS (SELECT round_even(COUNT(*) FILTER (WHERE ok) * 100.0 / COUNT(*), 1)::DOUBLE AS score, COUNT(*) FILTER (WHERE NOT ok) AS failed FROM rates)
    SELECT on_fail, min_score::DOUBLE AS min_score, NOT (on_fail = 'block' AND failed > 0) AND score >= min_score AS passed
    FROM card, (VALUES ('block', 0.0), ('warn', 0.0), ('warn', 60.0), ('warn', 99.0)) g(on_fail, min_score)""",
)
def _gates(spark, sf_dir):
    checks = quality_checks(dirty_sales(spark, sf_dir))
    card = scorecard(checks).first()
    outcomes = []
    for on_fail, least in GATES:
        try:
            gate(card, on_fail=on_fail, min_score=least)
            outcomes.append((on_fail, least, True))
        except QualityGateError:
            outcomes.append((on_fail, least, False))
    return spark.createDataFrame(outcomes, "on_fail string, min_score double, passed boolean")


@query("e03_saved_baseline", DRIFT + 'SELECT "column", change, severity FROM changes')
def _baseline(spark, sf_dir):
    now, base = drifted(spark, sf_dir)
    path = shared_dir(spark, "baseline")
    evolution.save_baseline(record_schema(base, distinct="none").select("column", "dtype"), path)
    found = evolution.schema_changes(record_schema(now, distinct="none"), evolution.load_baseline(spark, path))
    return found.select("column", "change", "severity")


@query("c09_default_key", MERGED + "SELECT * FROM merged")
def _default_key(spark, sf_dir):
    # No keys named: the first column is the key, the rest is tracked.
    old, new = snapshots(spark, sf_dir)
    gold = HistoryTable(spark, shared_dir(spark, "history"))
    apply_batch(gold, old, (), FIRST, label="first")
    apply_batch(gold, new, (), SECOND, label="second", repeated="pairs")
    return _readable(gold.read())

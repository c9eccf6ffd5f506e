"""Queries over masks, copies, joins, gold, checks, contracts, anomalies and schema drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.digest import compact_row
from siltstone.functions.masks import mask, sha256_hex
from siltstone.functions.numeric import percent
from siltstone.functions.types import columns_of
from siltstone.operators import anomaly, contracts, evolution, keys, pii, suite
from siltstone.operators.gold import build_gold
from siltstone.operators.profile import duplicate_stats, record_schema
from siltstone.operators.quality import quality_checks, scorecard
from siltstone.operators.silver import drop_copies, fill_median, medians
from siltstone.plans.inputs import DIRTY, DIRTY_COLUMNS, SNAPSHOTS, dirty_sales, snapshots, table
from siltstone.plans.q_profile import SILVER, silver_sales
from siltstone.plans.registry import query
from siltstone.sources.readers import union_all


# Masks. Every eleventh name is blank and every thirteenth the word None.
BLANKED = """WITH blanked AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN ' ' WHEN c_custkey % 13 = 0 THEN 'None'
 WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN substr(c_name, 1, 4) ELSE c_name END AS c_name, c_mktsegment FROM customer)
"""
PRESENT = "c_name IS NOT NULL AND trim(c_name) NOT IN ('', 'None', 'null')"


def blanked(spark, sf_dir):
    key = F.col("c_custkey")
    name = (
        F.when(key % 11 == 0, F.lit(" "))
        .when(key % 13 == 0, F.lit("None"))
        .when(key % 17 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, F.substring("c_name", 1, 4))
        .otherwise(F.col("c_name"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("c_name"), "c_mktsegment")


@query("m03_sha256_mask", DIRTY + "SELECT transaction_id, sha256(customer_email) AS customer_email, sha256(customer_phone) AS customer_phone FROM dirty")
def _sha(spark, sf_dir):
    return dirty_sales(spark, sf_dir).select(
        "transaction_id", sha256_hex(F.col("customer_email")).alias("customer_email"), sha256_hex(F.col("customer_phone")).alias("customer_phone")
    )


def _mask_query(name, strategy, sql, salt=""):
    @query(name, BLANKED + f"SELECT c_custkey, CASE WHEN {PRESENT} THEN {sql} ELSE c_name END AS c_name FROM blanked")
    def _masked(spark, sf_dir):
        rows = blanked(spark, sf_dir)
        hidden = mask(F.col("c_name"), rows.schema["c_name"].dataType, strategy, name="c_name", salt=salt)
        return rows.select("c_custkey", hidden.alias("c_name"))


_mask_query("m04_salted_mask", "sha256_short", "substr(sha256('pepper' || trim(c_name)), 1, 16)", salt="pepper")
_mask_query("m05_redact_mask", "redact", "'[REDACTED]'")
_mask_query("m06_sentinel_mask", "sentinel", "'MASKED_C_NAME'")
_mask_query(
    "m07_partial_mask", "partial",
    "CASE WHEN length(trim(c_name)) <= 4 THEN '****' ELSE left(trim(c_name), 2) || repeat('*', length(trim(c_name)) - 4) || right(trim(c_name), 2) END",
)


@query(
    "m09_mask_columns",
    BLANKED + f"SELECT c_custkey, CASE WHEN {PRESENT} THEN '[REDACTED]' ELSE c_name END AS c_name, '[REDACTED]' AS c_mktsegment FROM blanked",
)
def _mask_columns(spark, sf_dir):
    return pii.mask_columns(blanked(spark, sf_dir), ["C Name", "c_mktsegment"], "redact")


@query(
    "m09_masking_log",
    BLANKED + f"""SELECT 'c_name' AS "column", 'redact' AS strategy, COUNT(*) FILTER (WHERE {PRESENT}) AS rows_masked,
    'PII column ''c_name'' masked using redact strategy' AS note FROM blanked
    UNION ALL SELECT 'c_mktsegment', 'redact', COUNT(c_mktsegment), 'PII column ''c_mktsegment'' masked using redact strategy' FROM blanked""",
)
def _mask_log(spark, sf_dir):
    return pii.masking_log(blanked(spark, sf_dir), ["C Name", "c_mktsegment"], "redact")


# Copies and sets.
@query("d01_drop_copies", DIRTY + "SELECT DISTINCT transaction_id, customer_email, status, unit_price FROM dirty")
def _dedup(spark, sf_dir):
    return drop_copies(dirty_sales(spark, sf_dir).select("transaction_id", "customer_email", "status", "unit_price"))


@query(
    "d02_copies_removed",
    """SELECT COUNT(*) AS rows_before, COUNT(DISTINCT text) AS rows_after, COUNT(*) - COUNT(DISTINCT text) AS removed FROM documents""",
)
def _removed(spark, sf_dir):
    found = duplicate_stats(table(spark, sf_dir, "documents").select("text"))
    total, copies = F.col("total_rows"), F.col("duplicate_count")
    return found.select(total.alias("rows_before"), (total - copies).alias("rows_after"), copies.alias("removed"))


@query(
    "d03_text_duplicates",
    DIRTY + """, n AS (SELECT COUNT(*) AS total_rows FROM dirty), d AS (SELECT COUNT(*) AS k FROM (SELECT DISTINCT * FROM dirty))
    SELECT total_rows, total_rows - k AS duplicate_count, ROUND((total_rows - k) * 1.0 / total_rows, 6)::DOUBLE AS duplicate_rate FROM n, d""",
)
def _text_duplicates(spark, sf_dir):
    return suite.text_duplicates(dirty_sales(spark, sf_dir)).withColumn("duplicate_rate", F.round("duplicate_rate", 6))


@query(
    "d04_union_versions",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'F'""",
)
def _union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    older = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    return union_all([orders.drop("o_orderstatus"), older])


@query(
    "d05_key_sets",
    SNAPSHOTS + """SELECT COALESCE(n.o_orderkey, o.o_orderkey) AS o_orderkey,
    CASE WHEN o.o_orderkey IS NULL THEN 'new' WHEN n.o_orderkey IS NULL THEN 'old' ELSE 'both' END AS side
    FROM new n FULL OUTER JOIN old o ON n.o_orderkey = o.o_orderkey""",
)
def _key_sets(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return keys.key_sets(old, new, ["o_orderkey"])


# Joins.
@query(
    "j01_match_left",
    SNAPSHOTS + """SELECT n.o_orderkey, n.o_totalprice AS o_totalprice_new, o.o_totalprice AS o_totalprice_old,
    CASE WHEN o.o_orderkey IS NULL THEN 'left_only' ELSE 'both' END AS _match FROM new n LEFT JOIN old o ON n.o_orderkey = o.o_orderkey""",
)
def _match(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    columns = ["o_orderkey", "o_totalprice"]
    return keys.match_left(new.select(columns), old.select(columns), ["o_orderkey"])


@query("j02_rows_with_keys", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _semi(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return keys.with_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), wanted, ["l_orderkey"])


@query("j03_rows_without_keys", SNAPSHOTS + "SELECT o_orderkey, o_totalprice FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def _anti(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return keys.without_keys(new.select("o_orderkey", "o_totalprice"), old, ["o_orderkey"])


# Gold.
@query("g01_gold_copy", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(1 AS BIGINT) AS _record_count FROM orders")
def _gold_copy(spark, sf_dir):
    return build_gold(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))[0]


@query(
    "g02_gold_groups",
    """SELECT l_returnflag, l_linestatus, SUM(l_orderkey)::BIGINT AS l_orderkey, SUM(l_linenumber)::BIGINT AS l_linenumber, ROUND(SUM(l_quantity), 2) AS l_quantity,
    ROUND(SUM(l_extendedprice), 2) AS l_extendedprice, COUNT(*) AS _record_count FROM lineitem GROUP BY 1, 2""",
)
def _gold_groups(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    gold, _ = build_gold(lines, "l_returnflag, l_linestatus, no_such_column")
    return gold.withColumn("l_quantity", F.round("l_quantity", 2)).withColumn("l_extendedprice", F.round("l_extendedprice", 2))


@query(
    "g02_gold_null_keys",
    DIRTY + """SELECT status, ROUND(COALESCE(SUM(unit_price), 0), 2) AS unit_price, COALESCE(SUM(quantity), 0)::BIGINT AS quantity, COUNT(*) AS _record_count
    FROM dirty WHERE status IS NOT NULL GROUP BY status""",
)
def _gold_nulls(spark, sf_dir):
    gold, _ = build_gold(dirty_sales(spark, sf_dir), "status", exclude=["transaction_id"])
    return gold.withColumn("unit_price", F.round("unit_price", 2))


@query(
    "g03_moments",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS values, ROUND(SUM({c}), 2) AS total, ROUND(AVG({c}), 4) AS mean, ROUND(VAR_POP({c}), 2) AS variance,
        ROUND(STDDEV_POP({c}), 4) AS std, MIN({c}) AS least, MAX({c}) AS greatest, MEDIAN({c}) AS median FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def _moments(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    middle = medians(lines, columns)
    stats = anomaly.moments(anomaly.numeric_values(lines, columns), columns)
    return stats.select(
        "column", "values", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"),
        F.round("std", 4).alias("std"), "least", "greatest",
        F.coalesce(*[F.when(F.col("column") == c, F.lit(middle[c])) for c in columns]).alias("median"),
    )


MODE_COLUMNS = {"customer": ["c_mktsegment"], "orders": ["o_orderstatus", "o_orderpriority"]}


@query(
    "g04_modes",
    "WITH counts AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n FROM orders GROUP BY {c}" for c in MODE_COLUMNS["orders"]
    ) + """), ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS k FROM counts)
    SELECT "column", MAX(value) FILTER (WHERE k = 1) AS value, MAX(n) AS n, SUM(n)::BIGINT AS total, COUNT(*) AS distinct_values FROM ranked GROUP BY "column" """,
)
def _modes(spark, sf_dir):
    return anomaly.modes(anomaly.value_counts(table(spark, sf_dir, "orders"), MODE_COLUMNS["orders"]))


# Scorecard.
SILVER_COLUMNS = [c for c, _ in DIRTY_COLUMNS] + ["transaction_date_is_null", "status_is_null", "unit_price_had_negative"]
RANGES = "unit_price:0:300000, quantity:1:, status:0:1, no_such:0:1, quantity:x:9"


def checks_sql(source: str, columns) -> str:
    """SQL of the scorecard's checks for `source`, with the range rules above."""
    parts = [
        f"SELECT {i} AS check_no, 'Completeness' AS category, '{c}' AS \"column\", 'Null % ≤ 5.0%' AS \"check\", "
        f"round_even((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 2)::DOUBLE AS value, 5.0::DOUBLE AS threshold FROM {source}"
        for i, c in enumerate(columns)
    ]
    n = len(columns)
    parts.append(
        f"SELECT {n}, 'Uniqueness', '_all_', 'Duplicate % ≤ 1.0%', round_even((a.n - b.n) * 100.0 / a.n, 2)::DOUBLE, 1.0::DOUBLE "
        f"FROM (SELECT COUNT(*) AS n FROM {source}) a, (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM {source})) b"
    )
    bounds = [
        ("unit_price", "unit_price ≥ 0.0", "unit_price < 0"),
        ("unit_price", "unit_price ≤ 300000.0", "unit_price > 300000"),
        ("quantity", "quantity ≥ 1.0", "quantity < 1"),
        ("status", "status ≥ 0.0", "TRY_CAST(status AS DOUBLE) < 0"),
        ("status", "status ≤ 1.0", "TRY_CAST(status AS DOUBLE) > 1"),
        ("quantity", "quantity ≤ 9.0", "quantity > 9"),
    ]
    for k, (column, text, bad) in enumerate(bounds):
        parts.append(f"SELECT {n + 1 + k}, 'Range', '{column}', '{text}', (COUNT(*) FILTER (WHERE {bad}))::DOUBLE, 0.0::DOUBLE FROM {source}")
    return " UNION ALL ".join(parts)


def _with_status(inner: str) -> str:
    return f"SELECT *, CASE WHEN value <= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM ({inner}) x"


DIRTY_NAMES = [c for c, _ in DIRTY_COLUMNS]


@query("v01_completeness", DIRTY + f"SELECT * FROM ({_with_status(checks_sql('dirty', DIRTY_NAMES))}) y WHERE category = 'Completeness'")
def _completeness(spark, sf_dir):
    return quality_checks(dirty_sales(spark, sf_dir), duplicates=False).filter("category = 'Completeness'")


@query("v02_uniqueness", DIRTY + f"SELECT * FROM ({_with_status(checks_sql('dirty', DIRTY_NAMES))}) y WHERE category = 'Uniqueness'")
def _uniqueness(spark, sf_dir):
    return quality_checks(dirty_sales(spark, sf_dir)).filter("category = 'Uniqueness'")


@query("v03_range_rules", DIRTY + f"SELECT * FROM ({_with_status(checks_sql('dirty', DIRTY_NAMES))}) y WHERE category = 'Range'")
def _ranges(spark, sf_dir):
    return quality_checks(dirty_sales(spark, sf_dir), ranges=RANGES, duplicates=False).filter("category = 'Range'")


CARD = """SELECT CASE WHEN COUNT(*) = 0 THEN 100.0 ELSE round_even(COUNT(*) FILTER (WHERE status = 'PASS') * 100.0 / COUNT(*), 1) END::DOUBLE AS dq_score_pct,
 CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS dq_status,
 COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) FILTER (WHERE status = 'WARN') AS warnings,
 COUNT(*) FILTER (WHERE status = 'FAIL') AS failed, COUNT(*) AS total_checks FROM """


@query("v04_scorecard", SILVER + CARD + f"({_with_status(checks_sql('silver', SILVER_COLUMNS))}) y")
def _card(spark, sf_dir):
    silver = silver_sales(spark, sf_dir).df
    return scorecard(quality_checks(silver, ranges=RANGES, distinct_rows=True))


@query("v04_silver_checks", SILVER + _with_status(checks_sql("silver", SILVER_COLUMNS)))
def _silver_checks(spark, sf_dir):
    silver = silver_sales(spark, sf_dir).df
    return quality_checks(silver, ranges=RANGES)


# Toolbox checks, over text that is partly blank.
SPOTTED = DIRTY + """, spotted AS (SELECT * REPLACE (CASE WHEN transaction_id % 40 = 0 THEN '' WHEN transaction_id % 41 = 0 THEN ' None ' ELSE region END AS region) FROM dirty)
"""


def spotted(spark, sf_dir):
    key = F.col("transaction_id")
    region = F.when(key % 40 == 0, F.lit("")).when(key % 41 == 0, F.lit(" None ")).otherwise(F.col("region"))
    return dirty_sales(spark, sf_dir).withColumn("region", region)


def _gone(c, t):
    return f"({c} IS NULL OR trim({c}) IN ('', 'None', 'null'))" if t == "string" else f"({c} IS NULL)"


def suite_sql(baseline: int = 12000) -> str:
    parts = [
        f"""SELECT 'Null Rate — {c}' AS "check", 'Completeness' AS category, CASE WHEN v <= 0.05 THEN 'PASS' WHEN v <= 0.20 THEN 'WARN' ELSE 'FAIL' END AS status, v AS value
        FROM (SELECT (COUNT(*) FILTER (WHERE {_gone(c, t)})) * 1.0::DOUBLE / COUNT(*) AS v FROM spotted) WHERE v > 0"""
        for c, t in DIRTY_COLUMNS
    ]
    cells = " + ".join(f"COUNT(*) FILTER (WHERE {_gone(c, t)})" for c, t in DIRTY_COLUMNS)
    parts.append(f"""SELECT 'Row-Level Completeness', 'Completeness', CASE WHEN v >= 0.95 THEN 'PASS' ELSE 'WARN' END, v
        FROM (SELECT 1.0::DOUBLE - ({cells}) * 1.0::DOUBLE / (COUNT(*) * {len(DIRTY_COLUMNS)}) AS v FROM spotted)""")
    parts.append("""SELECT 'Duplicate Rows', 'Uniqueness', CASE WHEN v = 0 THEN 'PASS' WHEN v <= 0.01 THEN 'WARN' ELSE 'FAIL' END, v
        FROM (SELECT (a.n - b.n) * 1.0::DOUBLE / a.n AS v FROM (SELECT COUNT(*) AS n FROM spotted) a, (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM spotted)) b)""")
    parts.append(f"SELECT 'Schema — Column Count', 'Validity', 'PASS', {len(DIRTY_COLUMNS)}.0::DOUBLE")
    parts.append("SELECT 'Row Count', 'Completeness', CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END, COUNT(*)::DOUBLE FROM spotted")
    parts.append(f"""SELECT 'Volume vs Baseline', 'Freshness', CASE WHEN v <= 0.1 THEN 'PASS' WHEN v <= 0.3 THEN 'WARN' ELSE 'FAIL' END, v
        FROM (SELECT ABS(COUNT(*) - {baseline}) * 1.0::DOUBLE / {baseline} AS v FROM spotted)""")
    return 'SELECT "check", category, status, ROUND(value, 8) AS value FROM (' + " UNION ALL ".join(parts) + ") s"


def _suite(spark, sf_dir, pattern):
    found = suite.suite_checks(spotted(spark, sf_dir), baseline_rows=12000, duplicates=pattern == "Duplicate%")
    return found.filter(F.col("check").like(pattern)).select("check", "category", "status", F.round("value", 8).alias("value"))


def _suite_query(name, pattern):
    @query(name, SPOTTED + f"""SELECT * FROM ({suite_sql()}) q WHERE "check" LIKE '{pattern}'""")
    def _run(spark, sf_dir):
        return _suite(spark, sf_dir, pattern)


_suite_query("v07_null_tiers", "Null Rate%")
_suite_query("v08_row_completeness", "Row-Level%")
_suite_query("v09_duplicate_tier", "Duplicate%")
_suite_query("v10_counts", "% Count")
_suite_query("v11_volume_drift", "Volume%")


@query(
    "v12_suite_summary",
    SPOTTED + f"""SELECT *, round_even(pass * 100.0 / total, 1)::DOUBLE AS score, CASE WHEN fail = 0 AND warn <= 2 THEN 'PASS' WHEN fail = 0 THEN 'WARN' ELSE 'FAIL' END AS overall
    FROM (SELECT COUNT(*) FILTER (WHERE status = 'PASS') AS pass, COUNT(*) FILTER (WHERE status = 'WARN') AS warn,
    COUNT(*) FILTER (WHERE status = 'FAIL') AS fail, COUNT(*) AS total FROM ({suite_sql()}) q) z""",
)
def _summary(spark, sf_dir):
    return suite.suite_summary(suite.suite_checks(spotted(spark, sf_dir), baseline_rows=12000))


# Contracts. Ratings and scores are made from order keys; some fall outside their range.
RATED = DIRTY + """, rated AS (SELECT transaction_id, transaction_date, customer_email, unit_price, quantity,
 CAST(transaction_id % 6 AS BIGINT) AS rating, (transaction_id % 101) / 100.0::DOUBLE AS score, CASE WHEN transaction_id % 6 = 0 THEN 'abc' ELSE CAST(transaction_id % 7 AS VARCHAR) END AS rating_text,
 CASE WHEN transaction_id % 19 = 0 THEN 'nobody' ELSE customer_email END AS backup_email FROM dirty)
"""


def rated(spark, sf_dir):
    key = F.col("transaction_id")
    return dirty_sales(spark, sf_dir).select(
        "transaction_id", "transaction_date", "customer_email", "unit_price", "quantity",
        (key % 6).alias("rating"), ((key % 101) / 100.0).alias("score"),
        F.when(key % 6 == 0, F.lit("abc")).otherwise((key % 7).cast("string")).alias("rating_text"),
        F.when(key % 19 == 0, F.lit("nobody")).otherwise(F.col("customer_email")).alias("backup_email"),
    )


# The contracts that the rated table's schema gives, as (column, type, rule, severity).
RATED_RULES = (
    ("transaction_id", "NOT_NULL", "null_rate == 0", "FAIL"),
    ("transaction_date", "FORMAT", contracts.ISO_DATE, "WARN"),
    ("customer_email", "FORMAT", contracts.EMAIL, "WARN"),
    ("unit_price", "NOT_NULL", "null_rate == 0", "FAIL"),
    ("unit_price", "RANGE", "value >= 0", "FAIL"),
    ("quantity", "NOT_NULL", "null_rate == 0", "FAIL"),
    ("quantity", "RANGE", "value >= 0", "FAIL"),
    ("rating", "NOT_NULL", "null_rate == 0", "FAIL"),
    ("rating", "RANGE", "1 <= value <= 5", "FAIL"),
    ("score", "NOT_NULL", "null_rate == 0", "FAIL"),
    ("score", "RANGE", "0 <= value <= 1", "WARN"),
    ("rating_text", "NOT_NULL", "null_rate == 0", "FAIL"),
    ("rating_text", "RANGE", "1 <= value <= 5", "FAIL"),
    ("backup_email", "FORMAT", contracts.EMAIL, "WARN"),
)


def contracts_sql() -> str:
    parts = []
    for i, (column, kind, rule, severity) in enumerate(RATED_RULES):
        gone = f"({column} IS NULL OR trim(CAST({column} AS VARCHAR)) IN ('', 'None', 'null'))"
        number = f"TRY_CAST({column} AS DOUBLE)"
        if kind == "NOT_NULL":
            bad = gone
        elif kind == "FORMAT":
            bad = f"(NOT {gone} AND NOT regexp_matches(trim(CAST({column} AS VARCHAR)), '{rule}'))"
        else:
            outside = {"value >= 0": f"{number} < 0", "1 <= value <= 5": f"{number} NOT BETWEEN 1 AND 5", "0 <= value <= 1": f"{number} NOT BETWEEN 0 AND 1"}[rule]
            bad = f"(NOT {gone} AND ({number} IS NULL OR {outside}))"
        base = "COUNT(*)" if kind == "NOT_NULL" else f"COUNT(*) FILTER (WHERE NOT {gone})"
        if kind == "FORMAT":
            status = "CASE WHEN share > 0.10 THEN 'FAIL' WHEN share > 0.01 THEN 'WARN' ELSE 'PASS' END"
        else:
            status = f"CASE WHEN violations > 0 THEN '{'FAIL' if kind == 'NOT_NULL' else severity}' ELSE 'PASS' END"
        parts.append(
            f"""SELECT {i} AS contract_no, '{column}' AS "column", '{kind}' AS rule_type, violations, round_even(share * 100, 2) AS violation_rate_pct, {status} AS status
            FROM (SELECT COUNT(*) FILTER (WHERE {bad}) AS violations, COUNT(*) FILTER (WHERE {bad}) * 1.0::DOUBLE / GREATEST({base}, 1) AS share FROM rated)"""
        )
    return " UNION ALL ".join(parts)


def _contract_query(name, kind):
    @query(name, RATED + f"SELECT * FROM ({contracts_sql()}) c" + (f" WHERE rule_type = '{kind}'" if kind else ""))
    def _run(spark, sf_dir):
        rows = rated(spark, sf_dir)
        made = contracts.build_contracts(record_schema(rows, distinct="none").orderBy("position").collect())
        found = contracts.validate_contracts(rows, made)
        if kind:
            found = found.filter(F.col("rule_type") == kind)
        return found.select("contract_no", "column", "rule_type", "violations", "violation_rate_pct", "status")


_contract_query("r02_not_null_contracts", "NOT_NULL")
_contract_query("r03_format_contracts", "FORMAT")
_contract_query("r04_range_contracts", "RANGE")
_contract_query("r05_violation_rates", None)


# Anomalies.
def z_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", COUNT(*) AS anomaly_count, round_even(COUNT(*) * 100.0 / MAX(n), 2)::DOUBLE AS anomaly_rate_pct,
    ROUND(MAX(m), 3) AS mean, ROUND(MAX(s), 3) AS std, CASE WHEN COUNT(*) * 1.0 / MAX(n) < 0.05 THEN 'WARN' ELSE 'FAIL' END AS severity
    FROM (SELECT {column} AS v, AVG({column}) OVER () AS m, STDDEV_POP({column}) OVER () AS s, COUNT({column}) OVER () AS n FROM {source})
    WHERE ABS((v - m) / s) > 3 HAVING COUNT(*) > 0"""


@query("a01_z_score", " UNION ALL ".join(z_sql(s, c) for s, c in (("events", "value"),)))
def _z(spark, sf_dir):
    found = anomaly.numeric_anomalies(table(spark, sf_dir, "events"), ["value"]).filter("method = 'Z-Score'")
    return found.select("column", "anomaly_count", "anomaly_rate_pct", "mean", "std", "severity")


IQR = """WITH v AS (SELECT value AS v, ROW_NUMBER() OVER (ORDER BY value) - 1 AS k, COUNT(*) OVER () AS n, AVG(value) OVER () AS m,
 STDDEV_POP(value) OVER () AS s FROM events),
q AS (SELECT MAX(v) FILTER (WHERE k = n // 4) AS q1, MAX(v) FILTER (WHERE k = 3 * n // 4) AS q3, MAX(n) AS n, MAX(m) AS m, MAX(s) AS s FROM v),
out AS (SELECT v.v, q.* FROM v, q WHERE v.v < q1 - 1.5 * (q3 - q1) OR v.v > q3 + 1.5 * (q3 - q1))
"""


@query(
    "a02_iqr",
    IQR + """SELECT 'value' AS "column", COUNT(*) AS anomaly_count, round_even(COUNT(*) * 100.0 / MAX(n), 2)::DOUBLE AS anomaly_rate_pct,
    ROUND(MAX(q1), 3) AS q1, ROUND(MAX(q3), 3) AS q3, ROUND(MAX(q3) - MAX(q1), 3) AS iqr, 'WARN' AS severity FROM out
    HAVING COUNT(*) > 0 AND COUNT(*) <> (SELECT COUNT(*) FROM events, q WHERE ABS((value - q.m) / q.s) > 3)""",
)
def _iqr(spark, sf_dir):
    found = anomaly.numeric_anomalies(table(spark, sf_dir, "events"), ["value"]).filter("method = 'IQR'")
    return found.select("column", "anomaly_count", "anomaly_rate_pct", "q1", "q3", "iqr", "severity")


@query(
    "a03_examples",
    IQR + """SELECT 'Z-Score' AS method, k AS pos, value FROM (SELECT CAST(ROW_NUMBER() OVER (ORDER BY ABS(value) DESC, value DESC) - 1 AS INTEGER) AS k, ROUND(value, 3) AS value
      FROM events, q WHERE ABS((value - q.m) / q.s) > 3) WHERE k < 3
    UNION ALL SELECT 'IQR', k, v FROM (SELECT CAST(ROW_NUMBER() OVER (ORDER BY ABS(v - m) DESC, v DESC) - 1 AS INTEGER) AS k, ROUND(v, 3) AS v FROM out) WHERE k < 3""",
)
def _examples(spark, sf_dir):
    found = anomaly.numeric_anomalies(table(spark, sf_dir, "events"), ["value"])
    return found.select("method", F.posexplode("examples").alias("pos", "value"))


CHANNELS = """WITH sales AS (SELECT CASE WHEN o_orderkey % 10 < 9 THEN 'WEB' WHEN o_orderkey % 20 = 9 THEN 'SHOP' ELSE 'PHONE' END AS channel, o_orderpriority, o_orderstatus FROM orders)
"""


@query(
    "a04_dominance",
    CHANNELS + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", MAX(n) AS anomaly_count, round_even(MAX(n) * 100.0 / SUM(n), 2)::DOUBLE AS anomaly_rate_pct, arg_max({c}, n) AS dominant_value
        FROM (SELECT {c}, COUNT(*) AS n FROM sales GROUP BY {c}) HAVING MAX(n) * 1.0 / SUM(n) > 0.8 AND COUNT(*) BETWEEN 3 AND 29"""
        for c in ("channel", "o_orderpriority", "o_orderstatus")
    ),
)
def _dominance(spark, sf_dir):
    key = F.col("o_orderkey")
    channel = F.when(key % 10 < 9, F.lit("WEB")).when(key % 20 == 9, F.lit("SHOP")).otherwise(F.lit("PHONE"))
    sales = table(spark, sf_dir, "orders").select(channel.alias("channel"), "o_orderpriority", "o_orderstatus")
    return anomaly.categorical_anomalies(sales).select("column", "anomaly_count", "anomaly_rate_pct", "dominant_value")


VOLUME = """WITH runs AS (SELECT event_type AS dataset, strftime(ts, '%Y-%m-%d') AS run, COUNT(*) AS rows FROM events GROUP BY 1, 2),
    h AS (SELECT *, CAST(MAX(rows) OVER (PARTITION BY dataset) * 2 // 3 AS BIGINT) AS baseline_rows,
      COUNT(*) OVER w AS seen, AVG(rows) OVER w AS mean FROM runs WINDOW w AS (PARTITION BY dataset ORDER BY run ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
    d AS (SELECT *, (rows - baseline_rows) * 1.0::DOUBLE / GREATEST(baseline_rows, 1) AS drift,
      CASE WHEN seen >= 3 THEN mean END AS m, CASE WHEN seen >= 3 THEN (rows - mean) / GREATEST(mean, 1.0) END AS rolling FROM h),
    s AS (SELECT *, CASE WHEN ABS(drift) > 0.5 THEN 'FAIL' WHEN ABS(drift) > 0.25 THEN 'WARN' ELSE 'PASS' END AS base FROM d)
"""


def _volumes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    runs = events.groupBy(F.col("event_type").alias("dataset"), F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    peaks = runs.groupBy("dataset").agg((F.max("rows") * 2).alias("_peak"))
    based = runs.join(peaks, "dataset").withColumn("baseline_rows", F.expr("_peak div 3")).drop("_peak")
    return suite.volume_anomaly(based)


@query(
    "a05_volume",
    VOLUME + """SELECT dataset, run, rows, baseline_rows, round_even(drift * 100, 2) AS drift_pct, CAST(round_even(m, 0) AS BIGINT) AS rolling_avg,
    round_even(rolling * 100, 2) AS rolling_drift_pct, CASE WHEN base = 'PASS' AND ABS(rolling) > 0.25 THEN 'WARN' ELSE base END AS status FROM s""",
)
def _volume(spark, sf_dir):
    return _volumes(spark, sf_dir).drop("method", "detail", "rolling_detail")


@query(
    "a05_findings",
    VOLUME + """SELECT dataset, run, 'baseline_comparison' AS method, 'against a baseline of ' || baseline_rows || ' rows' AS compared, ABS(rolling) > 0.25 IS TRUE AS rolling_told FROM s""",
)
def _volume_findings(spark, sf_dir):
    found = _volumes(spark, sf_dir)
    compared = F.regexp_extract("detail", "against.*", 0).alias("compared")
    return found.select("dataset", "run", "method", compared, F.col("rolling_detail").isNotNull().alias("rolling_told"))


# Schema drift: customer loses its segment, gains a flag, its key becomes a flag and its balance text.
DRIFT = """WITH now AS (SELECT c_custkey % 2 = 0 AS c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) END AS c_acctbal, c_acctbal > 5000 AS is_rich FROM customer),
 words(column_type, dtype) AS (VALUES ('BIGINT', 'numeric'), ('INTEGER', 'numeric'), ('DOUBLE', 'numeric'), ('VARCHAR', 'string'), ('BOOLEAN', 'boolean')),
 cur AS (SELECT column_name, dtype FROM (DESCRIBE SELECT c_custkey % 2 = 0 AS c_custkey, c_name, c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_acctbal > 5000 AS is_rich FROM customer) JOIN words USING (column_type)),
 base AS (SELECT column_name, dtype FROM (DESCRIBE SELECT * FROM customer) JOIN words USING (column_type)),
 changes AS (SELECT COALESCE(c.column_name, b.column_name) AS "column",
  CASE WHEN b.dtype IS NULL THEN 'new' WHEN c.dtype IS NULL THEN 'removed' ELSE 'retyped' END AS change, b.dtype AS from_type, c.dtype AS to_type,
  CASE WHEN b.dtype IS NULL THEN 'WARN' WHEN c.dtype IS NULL THEN 'FAIL' WHEN c.dtype = 'string' AND b.dtype IN ('numeric', 'boolean') THEN 'WARN' ELSE 'FAIL' END AS severity
  FROM cur c FULL OUTER JOIN base b USING (column_name) WHERE c.dtype IS DISTINCT FROM b.dtype)
"""


def drifted(spark, sf_dir):
    base = table(spark, sf_dir, "customer")
    now = base.select(
        (F.col("c_custkey") % 2 == 0).alias("c_custkey"), "c_name", "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        (F.col("c_acctbal") > 5000).alias("is_rich"),
    )
    return now, base


@query(
    "e01_schema_changes",
    DRIFT + """, rates AS (UNPIVOT (SELECT ROUND(COUNT(*) FILTER (WHERE c_custkey IS NULL) * 1.0 / COUNT(*), 6)::DOUBLE AS c_custkey,
      ROUND(COUNT(*) FILTER (WHERE c_acctbal IS NULL) * 1.0 / COUNT(*), 6)::DOUBLE AS c_acctbal, ROUND(COUNT(*) FILTER (WHERE is_rich IS NULL) * 1.0 / COUNT(*), 6)::DOUBLE AS is_rich FROM now)
      ON c_custkey, c_acctbal, is_rich INTO NAME "column" VALUE null_rate)
    SELECT "column", change, from_type, to_type, severity, null_rate FROM changes LEFT JOIN rates USING ("column")""",
)
def _drift(spark, sf_dir):
    now, base = drifted(spark, sf_dir)
    seen = record_schema(now, distinct="none")
    changes = evolution.schema_changes(seen, record_schema(base, distinct="none"))
    rates = seen.select("column", F.round("null_rate", 6).alias("null_rate"))
    return changes.drop("recommendation").join(rates, "column", "left")


@query(
    "e01_schema_status",
    DRIFT + """SELECT COUNT(*) FILTER (WHERE change = 'new') AS new, COUNT(*) FILTER (WHERE change = 'removed') AS removed, COUNT(*) FILTER (WHERE change = 'retyped') AS retyped,
    CASE WHEN COUNT(*) FILTER (WHERE severity = 'FAIL') > 0 THEN 'FAIL' WHEN COUNT(*) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM changes""",
)
def _drift_status(spark, sf_dir):
    now, base = drifted(spark, sf_dir)
    changes = evolution.schema_changes(record_schema(now, distinct="none"), record_schema(base, distinct="none"))
    return evolution.evolution_status(changes).drop("summary")


@query(
    "d02_duplicate_share",
    "SELECT lang, COUNT(*) AS documents, round_even((COUNT(*) - COUNT(DISTINCT text)) * 100.0 / COUNT(*), 2)::DOUBLE AS duplicate_pct FROM documents GROUP BY lang",
)
def _share(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("lang", "text")
    copies = documents.groupBy(*compact_row(documents)).agg(F.count(F.lit(1)).alias("_copies"))
    totals = copies.groupBy("lang").agg(F.sum("_copies").alias("documents"), F.count(F.lit(1)).alias("_kept"))
    return totals.select("lang", "documents", percent(F.col("documents") - F.col("_kept"), F.col("documents")).alias("duplicate_pct"))


@query(
    "r02_broken_not_null",
    """SELECT "column", violations, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
    SELECT 'c_custkey' AS "column", 0 AS violations UNION ALL SELECT 'c_name', COUNT(*) FILTER (WHERE c_custkey % 17 = 0) FROM customer
    UNION ALL SELECT 'c_nationkey', COUNT(*) FILTER (WHERE c_custkey % 5 = 0) FROM customer UNION ALL SELECT 'c_acctbal', 0
    UNION ALL SELECT 'c_mktsegment', COUNT(*) FILTER (WHERE c_custkey % 3 = 0) FROM customer) v""",
)
def _broken_not_null(spark, sf_dir):
    # Contracts of one snapshot, checked on a later one that has nulls, blanks included.
    first, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    made = contracts.build_contracts(record_schema(first, distinct="none").orderBy("position").collect())
    later = first.withColumns({
        "c_name": F.when(key % 17 != 0, F.col("c_name")),
        "c_nationkey": F.when(key % 5 != 0, F.col("c_nationkey")),
        "c_mktsegment": F.when(key % 3 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")),
    })
    return contracts.validate_contracts(later, made).filter("rule_type = 'NOT_NULL'").select("column", "violations", "status")


@query(
    "n08_infinite_median",
    """WITH v AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS k, COUNT(*) OVER () AS n FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 'infinity'::DOUBLE ELSE value END AS v FROM events WHERE event_id % 7 <> 0 AND (event_id % 3 = 0 OR value IS NOT NULL)))
    SELECT (SELECT ROUND(AVG(v), 6) FROM v WHERE k = (n - 1) // 2 OR k = n // 2) AS median, COUNT(*) AS filled FROM events WHERE event_id % 7 = 0 OR (event_id % 3 <> 0 AND value IS NULL)""",
)
def _infinite_median(spark, sf_dir):
    # A third of the values is infinite, a seventh is missing and gets the median.
    key = F.col("event_id")
    value = F.when(key % 7 != 0, F.when(key % 3 == 0, F.lit(float("inf"))).otherwise(F.col("value")))
    source = table(spark, sf_dir, "events").select("event_id", value.alias("v"), value.isNull().alias("gap"))
    filled = fill_median(source, ["v"]).filter("gap")
    return filled.agg(F.round(F.max("v"), 6).alias("median"), F.count(F.lit(1)).alias("filled"))


@query(
    "e01_column_counts",
    """SELECT 5 AS baseline_columns, 5 AS current_columns FROM (SELECT COUNT(*) AS n FROM customer) WHERE n >= 0""",
)
def _column_counts(spark, sf_dir):
    now, base = drifted(spark, sf_dir)
    return evolution.column_counts(record_schema(now, distinct="none"), record_schema(base, distinct="none"))


# Type changes that lose nothing.
SAFE = "('numeric', 'string'), ('boolean', 'string'), ('integer', 'numeric'), ('integer', 'float')"


@query(
    "e02_promotions",
    f"""WITH kinds AS (SELECT DISTINCT CASE data_type WHEN 'BIGINT' THEN 'integer' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END AS t
      FROM (SELECT unnest([typeof(c_custkey), typeof(c_nationkey), typeof(c_acctbal), typeof(c_name), typeof(c_acctbal > 0)]) AS data_type FROM customer))
    SELECT a.t AS from_type, b.t AS to_type, (a.t, b.t) NOT IN (VALUES {SAFE}) AS breaking FROM kinds a, kinds b WHERE a.t <> b.t""",
)
def _promotions(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("is_rich", F.col("c_acctbal") > 0)
    kinds = evolution.schema_table(rows).select(F.col("dtype").alias("t")).distinct().filter("t <> ''")
    pairs = kinds.select(F.col("t").alias("from_type")).join(kinds.select(F.col("t").alias("to_type")), F.col("from_type") != F.col("to_type"))
    return pairs.withColumn("breaking", evolution.is_breaking(F.col("from_type"), F.col("to_type")))


FAMILIES = {"numeric": ("event_id", "user_id", "value"), "string": ("event_type", "props"), "datetime": ("ts",)}


@query("p08_family_values", " UNION ALL ".join(f"SELECT '{k}' AS family, {len(v)} AS columns, {' + '.join(f'COUNT({c})' for c in v)} AS present FROM events" for k, v in FAMILIES.items()))
def _family_values(spark, sf_dir):
    """Columns and present values of each type family."""
    events = table(spark, sf_dir, "events")
    found = {kind: columns_of(events, kind) for kind in ("numeric", "string", "datetime", "boolean", "other")}
    counted = [
        F.struct(F.lit(kind).alias("family"), F.lit(len(names)).alias("columns"), sum(F.count(c) for c in names).alias("present"))
        for kind, names in found.items() if names
    ]
    return events.agg(F.array(*counted).alias("found")).select(F.inline("found"))


@query("m08_unknown_strategy", "SELECT c_custkey, substr(sha256(c_name), 1, 16) AS short, 'refused' AS other FROM customer")
def _unknown_strategy(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    kind = customer.schema["c_name"].dataType
    try:
        other = mask(F.col("c_name"), kind, "rot13")
    except ValueError:
        other = F.lit("refused")
    return customer.select("c_custkey", mask(F.col("c_name"), kind, "sha256_short", name="", salt="").alias("short"), other.alias("other"))

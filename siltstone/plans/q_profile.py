"""Queries over profiles, filters, rules and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.missing import WHITE_SPACE, strip
from siltstone.functions.numeric import to_number
from siltstone.operators import silver as sv
from siltstone.operators.clean import date_text_columns, flag_all_nulls, narrow_integers, parse_dates
from siltstone.operators.incremental import date_window, newer_than, watermark_stats
from siltstone.operators.mapping import build_mapping
from siltstone.operators.ordered_fill import ordered_fill
from siltstone.operators.profile import (
    column_profile,
    column_roles,
    duplicate_stats,
    parse_share,
    table_profile,
    top_null_columns,
)
from siltstone.functions.names import pii_columns
from siltstone.plans.inputs import DIRTY, DIRTY_COLUMNS, GAPPY, dirty_sales, gappy_sales, table
from siltstone.plans.registry import query

STAMP = "yyyy-MM-dd HH:mm:ss"
SQL_STAMP = "'%Y-%m-%d %H:%M:%S'"


def profile_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS position, '{t}' AS dtype, COUNT(*) - COUNT({c}) AS null_count, "
        f"round_even((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 2)::DOUBLE AS null_pct, "
        f"COUNT(DISTINCT {c}) AS cardinality, COUNT(*) AS total_rows FROM {source}"
        for i, (c, t) in enumerate(columns)
    )


@query("p01_column_profile", DIRTY + profile_sql("dirty", DIRTY_COLUMNS))
def _profile(spark, sf_dir):
    return column_profile(dirty_sales(spark, sf_dir))


@query(
    "p01_document_profile",
    profile_sql("documents", [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]),
)
def _document_profile(spark, sf_dir):
    return column_profile(table(spark, sf_dir, "documents"), scan="per_column")


@query(
    "p02_table_profile",
    DIRTY + ", profile AS (" + profile_sql("dirty", DIRTY_COLUMNS) + """)
    SELECT MAX(total_rows) AS total_rows, COUNT(*) AS num_columns,
    string_agg("column" || '=' || CAST(null_pct AS VARCHAR), ',' ORDER BY position) FILTER (WHERE null_pct > 0) AS nulls FROM profile""",
)
def _table_profile(spark, sf_dir):
    found = table_profile(column_profile(dirty_sales(spark, sf_dir), distinct="none"))
    pairs = F.transform("null_summary", lambda n: F.concat(n["column"], F.lit("="), n["null_pct"].cast("string")))
    return found.select("total_rows", "num_columns", F.array_join(pairs, ",").alias("nulls"))


@query(
    "p03_duplicate_stats",
    DIRTY + """, n AS (SELECT COUNT(*) AS total_rows FROM dirty), d AS (SELECT COUNT(*) AS k FROM (SELECT DISTINCT * FROM dirty))
    SELECT total_rows, total_rows - k AS duplicate_count, round_even((total_rows - k) * 100.0 / total_rows, 2)::DOUBLE AS duplicate_pct FROM n, d""",
)
def _duplicates(spark, sf_dir):
    return duplicate_stats(dirty_sales(spark, sf_dir))


@query(
    "p04_top_null_columns",
    DIRTY + ", profile AS (" + profile_sql("dirty", DIRTY_COLUMNS) + """),
    top AS (SELECT * FROM profile WHERE null_pct > 0 ORDER BY null_pct DESC, position LIMIT 5)
    SELECT COALESCE(string_agg("column" || ' (' || CAST(null_pct AS VARCHAR) || '%)', ', ' ORDER BY null_pct DESC, position), 'None') AS top_null_columns FROM top""",
)
def _top_nulls(spark, sf_dir):
    return top_null_columns(column_profile(dirty_sales(spark, sf_dir), distinct="none"))


TEXT_COLUMNS = ["transaction_date", "customer_email", "customer_phone", "status", "region"]


@query(
    "p06_timestamp_share",
    DIRTY + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS values, COUNT(TRY_CAST({c} AS TIMESTAMP)) AS parsed, "
        f"ROUND(COUNT(TRY_CAST({c} AS TIMESTAMP)) * 1.0 / COUNT({c}), 6)::DOUBLE AS share FROM dirty"
        for c in TEXT_COLUMNS
    ),
)
def _share(spark, sf_dir):
    return parse_share(dirty_sales(spark, sf_dir), TEXT_COLUMNS).withColumn("share", F.round("share", 6))


def roles_sql(source: str, fixed: dict[str, str], open_: list[str]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", '{r}' AS role FROM (SELECT COUNT(*) FROM {source})" for c, r in fixed.items()]
    for c in open_:
        parts.append(
            f"SELECT '{c}', CASE WHEN COUNT({c}) > 0 AND COUNT(*) FILTER (WHERE regexp_matches(trim(CAST({c} AS VARCHAR)), '^-?\\d+\\.?\\d*$')) > COUNT({c}) * 0.8 "
            f"THEN 'numeric_metric' WHEN COUNT(DISTINCT {c}) < 30 THEN 'categorical' ELSE 'text' END FROM {source}"
        )
    return " UNION ALL ".join(parts)


@query("p07_column_roles", roles_sql("events", {"event_id": "id", "ts": "timestamp", "user_id": "id"}, ["event_type", "value", "props"]))
def _roles(spark, sf_dir):
    return column_roles(table(spark, sf_dir, "events"))


@query("p07_document_roles", roles_sql("documents", {"doc_id": "id"}, ["text", "lang", "source", "n_chars"]))
def _document_roles(spark, sf_dir):
    return column_roles(table(spark, sf_dir, "documents"))


@query(
    "f01_date_window",
    f"""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, {SQL_STAMP}) AS o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""",
)
def _window(spark, sf_dir):
    rows = date_window(table(spark, sf_dir, "orders"), "o_orderdate", "1995-01-01", "1997-07-01")
    return rows.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", STAMP).alias("o_orderdate"))


@query(
    "f01_text_window",
    DIRTY + """SELECT transaction_id, strftime(CAST(transaction_date AS TIMESTAMP), '%Y-%m-%d') AS transaction_date FROM dirty
    WHERE CAST(transaction_date AS TIMESTAMP) >= TIMESTAMP '1996-03-01'""",
)
def _text_window(spark, sf_dir):
    rows = date_window(dirty_sales(spark, sf_dir), "transaction_date", "1996-03-01")
    return rows.select("transaction_id", F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"))


@query(
    "f02_watermark_filter",
    DIRTY + "SELECT transaction_id, transaction_date, unit_price FROM dirty WHERE transaction_date > '1998-01-15' OR transaction_date IS NULL",
)
def _newer(spark, sf_dir):
    rows = newer_than(dirty_sales(spark, sf_dir), "transaction_date", "1998-01-15")
    return rows.select("transaction_id", "transaction_date", "unit_price")


@query(
    "f02_watermark_stats",
    """SELECT 'incremental' AS mode, COUNT(*) AS rows_in_source, COUNT(*) FILTER (WHERE event_id > 999) AS rows_returned,
    COUNT(*) FILTER (WHERE event_id <= 999) AS rows_skipped, '999' AS last_watermark, CAST(MAX(event_id) AS VARCHAR) AS new_watermark FROM events""",
)
def _newer_stats(spark, sf_dir):
    return watermark_stats(table(spark, sf_dir, "events"), "event_id", 999)


@query("f05_strip_text", f"SELECT doc_id, trim(text, '{WHITE_SPACE}') AS text FROM documents")
def _strip(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", strip(F.col("text")).alias("text"))


@query(
    "f06_parse_dates",
    DIRTY + f"SELECT transaction_id, strftime(CAST(transaction_date AS TIMESTAMP), {SQL_STAMP}) AS transaction_date, customer_phone FROM dirty",
)
def _dates(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir).select("transaction_id", "transaction_date", "customer_phone")
    parsed = parse_dates(sales, date_text_columns(sales))
    return parsed.withColumn("transaction_date", F.date_format("transaction_date", STAMP))


@query(
    "f07_numeric_coercion",
    DIRTY + """SELECT transaction_id, TRY_CAST(CASE WHEN transaction_id % 3 = 0 THEN customer_phone ELSE CAST(quantity AS VARCHAR) END AS DOUBLE) AS number FROM dirty""",
)
def _coerce(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir)
    mixed = sales.select(
        "transaction_id",
        F.when(F.col("transaction_id") % 3 == 0, F.col("customer_phone")).otherwise(F.col("quantity").cast("string")).alias("mixed"),
    )
    return mixed.select("transaction_id", to_number(F.col("mixed"), mixed.schema["mixed"].dataType).alias("number"))


@query(
    "f08_narrow_integers",
    "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey, l_quantity FROM lineitem",
)
def _narrow(spark, sf_dir):
    return narrow_integers(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"))


@query(
    "f09_custom_rules",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) > 50000 AS big,
    CASE WHEN l_returnflag = 'R' THEN 'a;b' ELSE 'c' END AS mark FROM lineitem""",
)
def _rules(spark, sf_dir):
    import warnings

    lines = table(spark, sf_dir, "lineitem")
    rules = "net=l_extendedprice * (1 - l_discount); big=net > 50000; lost=no_such_column + 1; l_tax → net=0; mark=if(l_returnflag == 'R', 'a;b', 'c')"
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out, _ = sv.apply_rules(lines, rules)
    return out.select("l_orderkey", "l_linenumber", "net", "big", "mark")


@query(
    "f10_negative_clamp",
    DIRTY + """SELECT transaction_id, quantity, CASE WHEN unit_price < 0 THEN 0 ELSE unit_price END AS unit_price,
    CAST(unit_price < 0 AS INTEGER) AS unit_price_had_negative FROM dirty""",
)
def _clamp(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir).select("transaction_id", "quantity", "unit_price")
    return sv.clamp_negatives(sales, sv.clamp_candidates(sales))


@query(
    "f10_balance_clamp",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, CAST(c_acctbal < 0 AS INTEGER) AS c_acctbal_had_negative FROM customer""",
)
def _balance(spark, sf_dir):
    return sv.clamp_negatives(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


SILVER = DIRTY + f""", silver AS (SELECT DISTINCT transaction_id, transaction_date, sha256(customer_email) AS customer_email,
 sha256(customer_phone) AS customer_phone, quantity, CASE WHEN unit_price < 0 THEN 0 ELSE unit_price END AS unit_price,
 status, region, strftime(created_at, {SQL_STAMP}) AS created_at,
 CAST(transaction_date IS NULL AS INTEGER) AS transaction_date_is_null, CAST(status IS NULL AS INTEGER) AS status_is_null,
 CAST(unit_price < 0 AS INTEGER) AS unit_price_had_negative FROM dirty)
"""


def silver_sales(spark, sf_dir, override="flag"):
    """dirty_sales through the mapping that its profile gives."""
    sales = dirty_sales(spark, sf_dir)
    profile = column_profile(sales, distinct="none" if override else "exact").collect()
    mapping = build_mapping(sales.schema, profile, pii=pii_columns(sales.columns), override=override)
    return sv.build_silver(sales, mapping, order_by=["transaction_id"])


@query("f11_mapping_projection", SILVER + "SELECT * FROM silver")
def _silver(spark, sf_dir):
    return silver_sales(spark, sf_dir).df.withColumn("created_at", F.date_format("created_at", STAMP))


@query(
    "f11_inferred_mapping",
    DIRTY + """SELECT DISTINCT transaction_id, COALESCE(transaction_date, 'UNKNOWN') AS transaction_date, sha256(customer_email) AS customer_email,
    sha256(customer_phone) AS customer_phone, quantity, CASE WHEN unit_price < 0 THEN 0 ELSE unit_price END AS unit_price,
    COALESCE(status, 'UNKNOWN') AS status, region, CAST(unit_price < 0 AS INTEGER) AS unit_price_had_negative FROM dirty""",
)
def _inferred(spark, sf_dir):
    return silver_sales(spark, sf_dir, override="").df.drop("created_at")


@query("n01_drop_nulls", DIRTY + "SELECT transaction_id, transaction_date FROM dirty WHERE transaction_date IS NOT NULL")
def _drop(spark, sf_dir):
    return dirty_sales(spark, sf_dir).select("transaction_id", "transaction_date").na.drop(subset=["transaction_date"])


@query("n02_fill_zero", GAPPY + "SELECT transaction_id, COALESCE(unit_price, 0) AS unit_price FROM gappy")
def _zero(spark, sf_dir):
    sales = gappy_sales(spark, sf_dir)
    return sales.select("transaction_id", sv.fill_zero(sales, "unit_price").alias("unit_price"))


@query(
    "n03_fill_mean",
    GAPPY + "SELECT transaction_id, ROUND(COALESCE(unit_price, (SELECT AVG(unit_price) FROM gappy)), 4) AS unit_price FROM gappy",
)
def _mean(spark, sf_dir):
    filled = sv.fill_mean(gappy_sales(spark, sf_dir).select("transaction_id", "unit_price"), ["unit_price"])
    return filled.withColumn("unit_price", F.round("unit_price", 4))


@query(
    "n03_mean_after_drop",
    GAPPY + """, kept AS (SELECT * FROM gappy WHERE status IS NOT NULL)
    SELECT DISTINCT transaction_id, ROUND(COALESCE(unit_price, (SELECT AVG(unit_price) FROM kept)), 4) AS unit_price, status FROM kept""",
)
def _mean_after_drop(spark, sf_dir):
    sales = gappy_sales(spark, sf_dir).select("transaction_id", "status", "unit_price")
    profile = column_profile(sales, distinct="none").collect()
    mapping = build_mapping(sales.schema, profile, override={"status": "drop", "unit_price": "fill_mean"})
    out = sv.build_silver(sales, mapping, clamp_words=(), counted=False).df
    return out.select("transaction_id", F.round("unit_price", 4).alias("unit_price"), "status")


@query("n04_fill_unknown", DIRTY + "SELECT transaction_id, COALESCE(status, 'UNKNOWN') AS status FROM dirty")
def _unknown(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir)
    return sales.select("transaction_id", sv.fill_unknown(sales, "status").alias("status"))


@query("n05_flag_nulls", DIRTY + "SELECT transaction_id, status, CAST(status IS NULL AS INTEGER) AS status_is_null FROM dirty")
def _flag(spark, sf_dir):
    return dirty_sales(spark, sf_dir).select("transaction_id", "status", sv.null_flag("status"))


@query(
    "n05_flag_all_nulls",
    """SELECT d.doc_id, l.quality, l.toxic, CAST(l.quality IS NULL AS TINYINT) AS quality_is_null, CAST(l.toxic IS NULL AS TINYINT) AS toxic_is_null
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _flag_all(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return flag_all_nulls(joined, ["quality", "toxic"])


@query(
    "n06_ordered_fill",
    DIRTY + """, place AS (SELECT transaction_id, MAX(customer_email) AS e, MAX(status) AS s FROM dirty GROUP BY transaction_id),
    filled AS (SELECT transaction_id,
      COALESCE(LAST_VALUE(e IGNORE NULLS) OVER up, FIRST_VALUE(e IGNORE NULLS) OVER down) AS e,
      COALESCE(LAST_VALUE(s IGNORE NULLS) OVER up, FIRST_VALUE(s IGNORE NULLS) OVER down) AS s FROM place
      WINDOW up AS (ORDER BY transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             down AS (ORDER BY transaction_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT d.transaction_id, COALESCE(d.customer_email, f.e) AS customer_email, COALESCE(d.status, f.s) AS status, d.unit_price
    FROM dirty d JOIN filled f USING (transaction_id)""",
)
def _ordered(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir).select("transaction_id", "customer_email", "status", "unit_price")
    return ordered_fill(sales, ["customer_email", "status"], ["transaction_id"])


@query(
    "n07_fill_sentinel",
    GAPPY + "SELECT transaction_id, COALESCE(unit_price, -1) AS unit_price, COALESCE(status, 'N/A') AS status FROM gappy",
)
def _sentinel(spark, sf_dir):
    sales = gappy_sales(spark, sf_dir)
    return sales.select(
        "transaction_id", sv.fill_sentinel(sales, "unit_price").alias("unit_price"), sv.fill_sentinel(sales, "status").alias("status")
    )


@query(
    "n08_fill_median",
    GAPPY + "SELECT transaction_id, ROUND(COALESCE(unit_price, (SELECT MEDIAN(unit_price) FROM gappy)), 4) AS unit_price FROM gappy",
)
def _median(spark, sf_dir):
    filled = sv.fill_median(gappy_sales(spark, sf_dir).select("transaction_id", "unit_price"), ["unit_price"])
    return filled.withColumn("unit_price", F.round("unit_price", 4))


@query(
    "n09_drop_any_null",
    GAPPY + """SELECT transaction_id, customer_email, unit_price FROM gappy WHERE transaction_date IS NOT NULL AND customer_email IS NOT NULL
    AND customer_phone IS NOT NULL AND unit_price IS NOT NULL AND status IS NOT NULL""",
)
def _drop_any(spark, sf_dir):
    return gappy_sales(spark, sf_dir).na.drop("any").select("transaction_id", "customer_email", "unit_price")


RAISING = "ratio=o_totalprice / (o_orderkey % 5); code=CAST(o_orderpriority AS INT); part=o_custkey % (o_orderkey % 2)"


@query(
    "f09_raising_rules",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice / (o_orderkey % 5) END AS ratio, CAST(NULL AS INTEGER) AS code,
    CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey % (o_orderkey % 2) END AS part FROM orders""",
)
def _raising_rules(spark, sf_dir):
    out, _ = sv.apply_rules(table(spark, sf_dir, "orders"), RAISING)
    return out.select("o_orderkey", "ratio", "code", "part")


@query(
    "f09_raising_counts",
    """SELECT 'ratio' AS rule, COUNT(*) FILTER (WHERE o_orderkey % 5 = 0) AS failed FROM orders UNION ALL SELECT 'code', COUNT(*) FROM orders
    UNION ALL SELECT 'part', COUNT(*) FILTER (WHERE o_orderkey % 2 = 0) FROM orders""",
)
def _raising_counts(spark, sf_dir):
    built = sv.build_silver(table(spark, sf_dir, "orders"), [], rules=RAISING)
    return spark.createDataFrame([(s["column"], s["failed"]) for s in built.steps if s["kind"] == "rule"], "rule string, failed bigint")

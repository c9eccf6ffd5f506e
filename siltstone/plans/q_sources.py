"""Queries over sources and sinks: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.layout import Layout, choose_layout, write_layout
from siltstone.operators.profile import record_schema
from siltstone.operators.quality import quality_checks
from siltstone.plans.inputs import DIRTY, SNAPSHOTS, dirty_sales, snapshots, table
from siltstone.plans.registry import query
from siltstone.session import shared_dir
from siltstone.sources import readers, writers
from siltstone.sources.tables import VersionedTable


@query("s02_csv_source", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _csv(spark, sf_dir):
    path = shared_dir(spark, "csv")
    source = table(spark, sf_dir, "customer")
    writers.write_layer(source, path, fmt="csv")
    return readers.load(spark, path, format="csv", schema=source.schema)


@query(
    "s03_json_source",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders",
)
def _json(spark, sf_dir):
    path = shared_dir(spark, "json")
    source = table(spark, sf_dir, "orders")
    source.write.json(path)
    rows = readers.load(spark, path, format="json", schema=source.schema)
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("s04_parquet_source", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem")
def _parquet(spark, sf_dir):
    table(spark, sf_dir, "lineitem")
    return readers.load(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("s06_table_or_query", "SELECT c_mktsegment, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment")
def _catalog(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("siltstone_customer")
    return readers.load(
        spark,
        query="SELECT c_mktsegment, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS balance FROM siltstone_customer GROUP BY c_mktsegment",
    )


@query("s07_connector_source", "SELECT event_id, user_id, event_type, value, props FROM events")
def _connector(spark, sf_dir):
    table(spark, sf_dir, "events")
    return readers.read_connector(spark, "parquet", {"mergeSchema": "false"}, f"{sf_dir}/events.parquet").drop("ts")


@query("s09_payload_records", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _payload(spark, sf_dir):
    path = shared_dir(spark, "payload")
    source = table(spark, sf_dir, "customer")
    documents = source.select(F.lit("ok").alias("status"), F.array(F.struct("*")).alias("records"))
    documents.write.json(path)
    return readers.read_payload(spark, path, schema=documents.schema)


@query(
    "s10_bronze_replay",
    SNAPSHOTS + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM new",
)
def _replay(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    path = shared_dir(spark, "bronze")
    writers.write_bronze(old, path, "2024-01-01")
    writers.write_bronze(new, path, "2024-01-02")
    return writers.read_bronze(spark, path, ["2024-01-02"]).drop("o_orderdate")


@query("s11_ordered_head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def _head(spark, sf_dir):
    return readers.head(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


@query(
    "k01_bronze_partition",
    SNAPSHOTS
    + """SELECT '2024-01-01' AS ingest_date, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM new
    UNION ALL SELECT '2024-01-02', COUNT(*), ROUND(SUM(o_totalprice), 2) FROM new""",
)
def _bronze(spark, sf_dir):
    # The first day is written twice: the rerun replaces it and leaves the second alone.
    old, new = snapshots(spark, sf_dir)
    path = shared_dir(spark, "bronze")
    writers.write_bronze(old, path, "2024-01-01")
    writers.write_bronze(new, path, "2024-01-02")
    writers.write_bronze(new, path, "2024-01-01")
    rows = writers.read_bronze(spark, path)
    return rows.groupBy(F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "k02_layer_replace",
    SNAPSHOTS + "SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM new",
)
def _layer(spark, sf_dir):
    # The second version is computed from the first while that can still be read.
    _, new = snapshots(spark, sf_dir)
    gold = VersionedTable(spark, shared_dir(spark, "gold"))
    gold.replace(new.select("o_orderkey", "o_custkey", "o_totalprice"), "first")
    gold.replace(gold.read().withColumn("o_totalprice", F.col("o_totalprice") + 1), "second")
    return gold.read()


@query("k03_table_write", "SELECT c_custkey, COUNT(*) AS copies, ROUND(SUM(c_acctbal), 2) AS balance FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer) GROUP BY c_custkey")
def _table(spark, sf_dir):
    source = table(spark, sf_dir, "customer")
    path = shared_dir(spark, "table")
    name = "siltstone_" + path.rsplit("-", 1)[-1]
    writers.write_table(source.limit(0), name, mode="replace", path=path)
    writers.write_table(source, name, mode="replace", path=path)
    writers.write_table(source, name, mode="append")
    return spark.table(name).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("copies"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


def _completeness_sql(source: str, columns, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS check_no, '{c}' AS \"column\", COALESCE(round_even(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / NULLIF(COUNT(*), 0), 2), 0.0)::DOUBLE AS value{extra} FROM {source}"
        for i, c in enumerate(columns)
    )


@query(
    "k04_run_records",
    "WITH runs(run_id) AS (VALUES ('a'), ('b')), checks AS ("
    + _completeness_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    + " UNION ALL SELECT 5, '_all_', 0.0::DOUBLE) SELECT run_id, check_no, \"column\", value FROM runs CROSS JOIN checks",
)
def _records(spark, sf_dir):
    path = shared_dir(spark, "dq_checks")
    checks = quality_checks(table(spark, sf_dir, "customer"))
    for run_id in ("a", "b", "a"):
        writers.append_records(checks, path, run_id)
    return spark.read.parquet(path).select("run_id", "check_no", "column", "value")


@query(
    "l01_layout_write",
    "SELECT strftime(ts, '%Y-%m-%d') AS part, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1",
)
def _layout(spark, sf_dir):
    path = shared_dir(spark, "layout")
    write_layout(table(spark, sf_dir, "events"), Layout("range", "ts", "daily", ""), path)
    rows = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    return rows.groupBy(F.date_format(F.col("_part").cast("date"), "yyyy-MM-dd").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "l01_layout_choice",
    DIRTY
    + """, n AS (SELECT COUNT(*) AS n FROM dirty)
    SELECT CASE WHEN n > 100000 THEN 'range' WHEN n > 50000 THEN 'list' ELSE 'none' END AS strategy,
    CASE WHEN n > 100000 THEN 'transaction_date' WHEN n > 50000 THEN 'status' END AS "column",
    CASE WHEN n > 1000000 THEN 'monthly' WHEN n > 100000 THEN 'daily' WHEN n > 50000 THEN 'per_value' ELSE 'n/a' END AS granularity FROM n""",
)
def _choice(spark, sf_dir):
    sales = dirty_sales(spark, sf_dir)
    schema = record_schema(sales).orderBy("position").collect()
    layout = choose_layout(schema, sales.count())
    return spark.createDataFrame([layout[:3]], "strategy string, column string, granularity string")


@query("s09_records_with_lists", "SELECT c_custkey, c_custkey % 3 AS tags FROM customer")
def _nested_records(spark, sf_dir):
    # Documents that are lists of records, which hold lists of records themselves, some empty.
    tags = F.array_repeat(F.struct(F.col("c_nationkey").alias("x")), (F.col("c_custkey") % 3).cast("int"))
    records = table(spark, sf_dir, "customer").select("c_nationkey", F.struct("c_custkey", tags.alias("tags")).alias("r"))
    path = shared_dir(spark, "payload")
    records.groupBy("c_nationkey").agg(F.to_json(F.collect_list("r")).alias("value")).select("value").write.text(path)
    return readers.read_payload(spark, path).select("c_custkey", F.size("tags").cast("bigint").alias("tags"))


def _layout_query(name, source, column, strategy, grain, sql):
    @query(name, sql)
    def _written(spark, sf_dir):
        path = shared_dir(spark, "layout")
        write_layout(source(spark, sf_dir), Layout(strategy, column, grain, ""), path)
        part = F.col("_part").cast("string") if strategy != "hash" else F.lit("any")
        return spark.read.parquet(path).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


_layout_query("l01_layout_list", _events, "event_type", "list", "per_value", "SELECT event_type AS part, COUNT(*) AS n FROM events GROUP BY 1")
_layout_query("l01_layout_hash", _events, "user_id", "hash", "8_buckets", "SELECT 'any' AS part, COUNT(*) AS n FROM events")
_layout_query(
    "l01_layout_text_date", dirty_sales, "transaction_date", "range", "daily", DIRTY + "SELECT transaction_date AS part, COUNT(*) AS n FROM dirty GROUP BY 1"
)

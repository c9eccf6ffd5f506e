import os
import re

import pytest
from pyspark.sql import functions as F

from siltstone import session
from siltstone.operators.mapping import build_mapping
from siltstone.operators.profile import column_profile
from siltstone.session import shared_dir
from siltstone.sources import readers, writers
from siltstone.streaming import ingest as streams


@pytest.mark.parametrize(
    "source,kind",
    [
        ("postgres://h/db", "postgresql"), ("mysql+pymysql://h/db", "mysql"), ("mssql://h", "sqlserver"), ("oracle://h", "oracle"),
        ("s3://b/x.csv", "s3"), ("data/X.CSV", "csv"), ("a.xlsx", "excel"), ("a.sqlite3", "sqlite"), ("a.parquet", "parquet"), ("a.json", "json"),
        ("https://bigquery.example", "bigquery"), ("https://x.example/api", "rest_api"), ("whatever", "unknown"),
        ("kafka://broker/topic", "kafka"), ("snowflake://acc", "snowflake"),
    ],
)
def test_detection(source, kind):
    assert readers.detect_format(source) == kind


def test_csv_types_and_missing_words(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,name,price,ok,day\n1,"a ""b"", c",1.5,true,2024-01-01\n2,NA,n/a,false,2024-01-02\n3,,7,TRUE,NULL\n')
    inferred = readers.load(spark, str(path))
    assert inferred.dtypes == [("id", "bigint"), ("name", "string"), ("price", "double"), ("ok", "boolean"), ("day", "string")]
    assert [tuple(r) for r in inferred.orderBy("id").collect()] == [
        (1, 'a "b", c', 1.5, True, "2024-01-01"), (2, None, None, False, "2024-01-02"), (3, None, 7.0, True, None),
    ]
    typed = readers.read_csv(spark, str(path), "id int, name string, price double, ok boolean, day date")
    assert typed.filter("day is null").count() == 1
    bad = tmp_path / "bad.csv"
    bad.write_text("id\n1\nx\n")
    with pytest.raises(Exception):
        readers.read_csv(spark, str(bad), "id int").collect()
    assert readers.read_csv(spark, str(bad), "id int", on_bad="null").filter("id is null").count() == 1


def test_json_and_payload_shapes(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "wrapped.json").write_text('{"status": "ok", "tags": ["x"], "items": [{"a": 1}, {"a": 2}]}')
    (tmp_path / "plain.json").write_text('{"a": 1, "b": "x"}')
    (tmp_path / "two.json").write_text('{"x": [{"a": 1}], "y": [{"a": 5}]}')
    assert readers.read_payload(spark, str(tmp_path / "list.json")).count() == 2
    assert sorted(r["a"] for r in readers.read_payload(spark, str(tmp_path / "wrapped.json")).collect()) == [1, 2]
    assert tuple(readers.read_payload(spark, str(tmp_path / "plain.json")).first()) == (1, "x")
    with pytest.raises(ValueError, match="several lists"):
        readers.read_payload(spark, str(tmp_path / "two.json"))
    assert readers.read_payload(spark, str(tmp_path / "two.json"), records_field="y").first()["a"] == 5
    assert readers.load(spark, str(tmp_path / "list.json")).count() == 2


def test_jdbc_options():
    whole = readers.jdbc_options("postgresql://h:1/db", "sales")
    assert whole == {"url": "jdbc:postgresql://h:1/db", "dbtable": "sales"}
    assert readers.jdbc_options("mysql+pymysql://h/db", " select 1 ")["query"] == " select 1 "
    many = readers.jdbc_options("jdbc:x:y", "select * from t", partition_column="id", bounds=(1, 9), partitions=3)
    assert many["dbtable"] == "(select * from t) src" and many["numPartitions"] == "3" and "query" not in many
    assert readers.jdbc_url("data/x.db") == "jdbc:sqlite:data/x.db"
    for bad in (lambda: readers.jdbc_options("x://h", "t"), lambda: readers.jdbc_options("mysql://h", ""), lambda: readers.jdbc_options("mysql://h", "t", partition_column="id")):
        with pytest.raises(ValueError):
            bad()


def test_object_store_paths():
    assert readers.s3a("s3://b/k.csv") == "s3a://b/k.csv"
    assert readers.s3a("/data/k.csv") == "/data/k.csv"


def test_catalog_and_unreadable_sources(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert readers.load(spark, table="three").count() == 3
    assert readers.load(spark, query="select * from three where id > 0").count() == 2
    with pytest.raises(ValueError):
        readers.load(spark, "book.xlsx")
    with pytest.raises(ValueError):
        readers.load(spark)


def test_bronze_partitions(spark):
    path = shared_dir(spark, "bronze")
    for day, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-01", 5)):
        writers.write_bronze(spark.range(n), path, day)
    assert writers.read_bronze(spark, path, ["2024-01-01"]).count() == 5
    assert writers.read_bronze(spark, path).count() == 9
    with pytest.raises(ValueError):
        writers.write_table(spark.range(1), "x", mode="upsert")


class Session:
    """What shared_dir reads of a session."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master, self.applicationId = master, "app-1"

    def getCheckpointDir(self):
        return None


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(Session("hdfs:///shared/", "yarn"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(None, "yarn"), "x")
    local = Session(None, "local[2]")
    assert os.path.dirname(shared_dir(local, "x")) == os.path.dirname(shared_dir(local, "y"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_drained_stream_equals_batch(spark):
    path = shared_dir(spark, "in")
    schema = "id bigint, customer_email string, price double"
    spark.createDataFrame([(1, "a@b.c", -1.0), (2, None, 2.0)], schema).write.parquet(path)
    batch = spark.read.parquet(path)
    mapping = build_mapping(batch.schema, column_profile(batch).collect(), pii=["customer_email"])
    out = shared_dir(spark, "out")

    def drain():
        stream = streams.stream_silver(streams.file_stream(spark, path, batch.schema), mapping, rules="twice=price * 2")
        streams.ingest(stream, f"{out}/data", f"{out}/check", trigger="available").awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{out}/data").collect())

    first = drain()
    assert [(r[0], r[2], r[3], r[4]) for r in first] == [(1, 0.0, -2.0, 1), (2, 2.0, 4.0, 0)]
    assert drain() == first
    spark.createDataFrame([(3, "x", 3.0)], schema).write.mode("append").parquet(path)
    assert len(drain()) == 3


def test_streams_refuse_whole_table_strategies(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0)] * 30, "id bigint, price double")
    mapping = build_mapping(df.schema, column_profile(df).collect(), override="fill_mean")
    with pytest.raises(ValueError, match="whole table"):
        streams.stream_silver(df, mapping)


def test_late_copies_within_the_delay(spark):
    path = shared_dir(spark, "in")
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (2, "2024-01-01 00:01:00")], "id int, ts string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(path)
    stream = streams.file_stream(spark, path, "id int, ts timestamp_ntz")
    out = shared_dir(spark, "out")
    streams.ingest(streams.stream_distinct(stream, "ts", ["id"]), f"{out}/d", f"{out}/c", trigger="available").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/d").collect()) == [1, 2]


def test_rows_behind_the_watermark_are_dropped_and_counted(spark):
    path, out = shared_dir(spark, "in"), shared_dir(spark, "out")

    def arrive(*rows):
        df = spark.createDataFrame(list(rows), "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, "id int, ts timestamp_ntz")
        query = streams.ingest(streams.stream_distinct(stream, "ts", ["id"]), f"{out}/d", f"{out}/c", trigger="available")
        query.awaitTermination()
        return streams.late_rows(query)

    assert arrive((1, "2024-01-01 00:00:00"), (2, "2024-01-01 12:00:00")) == 0
    # The watermark stands at 11:50: row 3 is late, the copy of row 2 is known, row 4 is new.
    assert arrive((3, "2024-01-01 01:00:00"), (2, "2024-01-01 12:01:00"), (4, "2024-01-01 12:02:00")) == 1
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/d").collect()) == [1, 2, 4]


def test_late_rows_of_more_batches_than_spark_remembers(spark):
    path, out = shared_dir(spark, "in"), shared_dir(spark, "out")
    n = 12  # batches; Spark is told to remember four
    rows = [(i, 0 if i else 600) for i in range(n)]  # the first file moves the watermark, all others are late
    for i, minutes in rows:
        at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=F.lit(minutes))
        spark.range(i, i + 1 + i % 2).select(F.col("id").cast("int").alias("id"), at.alias("ts")).coalesce(1).write.mode("append").parquet(path)
    kept = streams.LateRows(spark, shared_dir(spark, "late"))
    spark.streams.addListener(kept)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        stream = streams.file_stream(spark, path, "id int, ts timestamp_ntz", files_per_batch=1)
        query = streams.ingest(streams.stream_distinct(stream, "ts", ["id"]), f"{out}/d", f"{out}/c", trigger="available")
        query.awaitTermination()
        kept.wait(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(kept)
    arrived = sum(1 + i % 2 for i, _ in rows if i)
    left = spark.read.parquet(f"{out}/d").count() - 1
    assert streams.late_rows(query, kept) == arrived - left > streams.late_rows(query)
    assert kept.table().count() > 4


def test_no_local_checkpoint_or_python_udf_in_the_package():
    root = os.path.dirname(session.__file__)
    for folder, _, files in os.walk(root):
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert not re.search(r"localCheckpoint|pandas_udf|\.rdd\b|F\.udf|crossJoin", f.read()), name


def test_broken_rows_raise_or_become_null(spark, tmp_path):
    (tmp_path / "fields.csv").write_text("a,b\n1,2\n3,4,5\n")
    (tmp_path / "short.csv").write_text("a,b\n1,2\n6\n")
    for name in ("fields.csv", "short.csv"):
        for schema in (None, "a int, b int"):
            with pytest.raises(Exception, match="(?i)malformed"):
                readers.read_csv(spark, str(tmp_path / name), schema).select("a").collect()
            assert readers.read_csv(spark, str(tmp_path / name), schema, on_bad="null").count() == 2
    (tmp_path / "broken.jsonl").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.load(spark, str(tmp_path / "broken.jsonl"), schema="a int").collect()
    assert readers.read_json(spark, str(tmp_path / "broken.jsonl"), "a int", on_bad="null").count() == 2


def test_records_that_hold_lists(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"id": 1, "s": [{"x": 1}, {"x": 2}]}, {"id": 2, "s": []}]')
    rows = readers.read_payload(spark, str(tmp_path / "list.json"))
    assert sorted((r["id"], len(r["s"])) for r in rows.collect()) == [(1, 2), (2, 0)]
    (tmp_path / "both").mkdir()
    (tmp_path / "both" / "a.json").write_text('[{"id": 1, "s": [{"x": 1}]}]')
    (tmp_path / "both" / "b.json").write_text('{"id": 3, "s": [{"x": 1}]}')
    with pytest.raises(ValueError, match="others objects"):
        readers.read_payload(spark, str(tmp_path / "both"))


def test_jdbc_bounds_are_asked_for(spark, monkeypatch):
    asked = []

    def opened(session, options):
        asked.append(options)
        return spark.sql("SELECT DATE'2024-01-01' AS low, DATE'2024-02-01' AS high" if "MIN(" in options.get("query", "") else "SELECT 1 AS x")

    monkeypatch.setattr(readers, "_open_jdbc", opened)
    readers.read_jdbc(spark, "mysql://h/db", "select * from t", partition_column="day", partitions=4, fetchsize="500")
    assert asked[0]["query"] == "SELECT MIN(day) AS low, MAX(day) AS high FROM (select * from t) src" and asked[0]["fetchsize"] == "500"
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"], asked[1]["dbtable"]) == ("2024-01-01", "2024-02-01", "4", "(select * from t) src")
    monkeypatch.setattr(readers, "_open_jdbc", lambda session, options: asked.append(options) or spark.sql("SELECT CAST(NULL AS INT) AS low, CAST(NULL AS INT) AS high"))
    readers.read_jdbc(spark, "mysql://h/db", "t", partition_column="id")
    assert asked[-1]["dbtable"] == "t" and "partitionColumn" not in asked[-1]


def test_jdbc_urls_of_each_database():
    sql = readers.jdbc_options("postgresql://u:p%40ss@h:5432/d", "t")
    assert sql == {"url": "jdbc:postgresql://h:5432/d", "user": "u", "password": "p@ss", "dbtable": "t"}
    assert readers.jdbc_options("oracle://u:p@h:1521/x", "t")["url"] == "jdbc:oracle:thin:@//h:1521/x"
    assert readers.jdbc_options("mssql+pyodbc://u:p@h:1433/d", "t")["url"] == "jdbc:sqlserver://h:1433;databaseName=d"
    assert readers.jdbc_url("sqlite:///data/x.db") == "jdbc:sqlite:data/x.db"
    assert readers.jdbc_url("sqlite:////data/x.db") == "jdbc:sqlite:/data/x.db"


def test_payload_files_of_lines_keep_every_line(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "tall.json").write_text('[\n {"a": 1},\n {"a": 2}\n]\n')
    for name in ("lines.json", "tall.json"):
        assert sorted(r["a"] for r in readers.read_payload(spark, str(tmp_path / name)).collect()) == [1, 2]

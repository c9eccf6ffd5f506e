"""Readers: one table of formats, all lazy, none of them collects."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.missing import NA_TOKENS, na_tokens_to_null
from siltstone.functions.numeric import NUMBER_TEXT
from siltstone.operators.keys import q

# How a source's text tells its kind; the first match counts.
PREFIXES = (
    (("postgresql://", "postgres://"), "postgresql"),
    (("mysql",), "mysql"),
    (("mssql", "sqlserver"), "sqlserver"),
    (("oracle",), "oracle"),
    (("s3://", "s3a://"), "s3"),
    (("snowflake://",), "snowflake"),
    (("kafka://",), "kafka"),
)
SUFFIXES = (
    ((".csv",), "csv"),
    ((".json", ".jsonl"), "json"),
    ((".parquet",), "parquet"),
    ((".xlsx", ".xls"), "excel"),
    ((".db", ".sqlite", ".sqlite3"), "sqlite"),
)
DATABASES = ("postgresql", "mysql", "sqlserver", "oracle", "sqlite")


def detect_format(source: str, default: str = "unknown") -> str:
    """Kind of a source by prefix, then by extension, then by being a web address."""
    text = source.lower().strip()
    for prefixes, kind in PREFIXES:
        if text.startswith(prefixes):
            return kind
    for suffixes, kind in SUFFIXES:
        if text.endswith(suffixes):
            return kind
    if text.startswith("http"):
        return "bigquery" if "bigquery" in text else "rest_api"
    return default


def s3a(uri: str) -> str:
    """Spark's name for an object-store path; credentials stay in the Hadoop configuration."""
    return "s3a://" + uri[len("s3://"):] if uri.lower().startswith("s3://") else uri


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    *,
    on_bad: str = "raise",
    multiline: bool = False,
    na_tokens: tuple[str, ...] = NA_TOKENS,
    **options: str,
) -> DataFrame:
    """CSV with a header. Missing-value words become null before types apply.

    With a schema, text that does not fit its type raises, or becomes null with
    `on_bad="null"`. Without one, types are inferred over all rows: bigint,
    double, boolean or string; dates stay text. A row with more or fewer fields
    than the header raises too; with `on_bad="null"` missing fields are null and
    surplus ones are left out.
    """
    if on_bad not in ("raise", "null"):
        raise ValueError("on_bad is 'raise' or 'null'")
    # All fields are parsed when rows may raise: pruning would hide surplus ones.
    strict = {"mode": "FAILFAST", "columnPruning": "false"} if on_bad == "raise" else {}
    settings = {"header": "true", "escape": '"', "multiLine": str(multiline).lower(), **strict, **options}
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.options(**settings)
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
        reader = reader.option("enforceSchema", "false")
    raw = na_tokens_to_null(reader.csv(path), na_tokens)
    if schema is None:
        return _cast_inferred(raw)
    casts = []
    for f in schema.fields:
        col = F.col(q(f.name))
        cast = col.cast(f.dataType) if on_bad == "raise" else col.try_cast(f.dataType)
        casts.append(cast.alias(f.name))
    return raw.select(*casts)


def _cast_inferred(raw: DataFrame) -> DataFrame:
    aggs = []
    for i, c in enumerate(raw.columns):
        col = F.col(q(c))
        aggs += [
            F.count(col).alias(f"n{i}"),
            F.count_if(col.rlike(r"^\s*[+-]?\d{1,18}\s*$")).alias(f"l{i}"),
            F.count_if(col.rlike(NUMBER_TEXT)).alias(f"d{i}"),
            F.count_if(F.lower(col).isin("true", "false")).alias(f"b{i}"),
        ]
    if not aggs:
        return raw
    seen = raw.agg(*aggs).first()
    casts = []
    for i, c in enumerate(raw.columns):
        n = seen[f"n{i}"]
        kind = "string"
        for key, name in (("b", "boolean"), ("d", "double"), ("l", "bigint")):
            if n and seen[f"{key}{i}"] == n:
                kind = name
        col = F.col(q(c))
        casts.append((col if kind == "string" else F.trim(col).cast(kind)).alias(c))
    return raw.select(*casts)


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema=None, *, multiline: bool = False, on_bad: str = "raise"
) -> DataFrame:
    """JSON files: one document per line (which splits), or one per file with `multiline=True`.

    A broken document, or a value that does not fit the schema, raises; with
    `on_bad="null"` what cannot be read is null.
    """
    if on_bad not in ("raise", "null"):
        raise ValueError("on_bad is 'raise' or 'null'")
    mode = "FAILFAST" if on_bad == "raise" else "PERMISSIVE"
    reader = spark.read.option("multiLine", str(multiline).lower()).option("mode", mode)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_payload(spark: SparkSession, path: str, *, records_field: str | None = None, schema=None, multiline: bool | None = None) -> DataFrame:
    """Landed API payloads as rows.

    Files of one document per line are told from files of one document by their
    lines, unless `multiline` says which they are.

    A list of records is read as rows, whatever lists the records hold. Of an
    object, the field holding a list of records is spread out; if there are
    several, name it. An object without one is a row itself. Lists beside objects
    raise unless the field is named.
    """
    if multiline is None:
        multiline = not _documents_by_line(spark, path)
    table = read_json(spark, path, schema, multiline=multiline)
    lists = [
        f.name
        for f in table.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    ]
    if records_field is None:
        if lists and _top_level_lists(spark, path, multiline):
            return table
        if len(lists) > 1:
            raise ValueError(f"several lists of records, choose records_field from {lists}")
        if not lists:
            return table
        records_field = lists[0]
    elif records_field not in lists:
        raise ValueError(f"{records_field!r} is not a list of records; those are {lists}")
    return table.select(F.inline(q(records_field)))


def _documents_by_line(spark: SparkSession, path: str) -> bool:
    """Whether every line that is not blank opens and closes a document."""
    line = F.col("value")
    seen = spark.read.text(path).agg(
        F.count_if(line.rlike(r"\S")).alias("lines"), F.count_if(line.rlike(r"^\s*[\[{].*[\]}]\s*$")).alias("whole")
    ).first()
    return seen["lines"] == seen["whole"]


def _top_level_lists(spark: SparkSession, path: str, multiline: bool) -> bool:
    """Whether the documents are lists of records; Spark reads such a list like single records."""
    text = spark.read.text(path, wholetext=multiline)
    starts = [F.count_if(F.col("value").rlike(rf"^\s*{c}")).alias(n) for c, n in ((r"\[", "lists"), (r"\{", "objects"))]
    seen = text.agg(*starts).first()
    if seen["lists"] and seen["objects"]:
        raise ValueError("some documents are lists, others objects: choose records_field")
    return bool(seen["lists"])


def is_query(text: str) -> bool:
    return re.match(r"\s*(select|with)(?!\w)", text, re.IGNORECASE) is not None


def read_table_or_query(spark: SparkSession, table_or_query: str) -> DataFrame:
    """A table or view of the catalog, or the result of a query on it; no row limit."""
    return spark.sql(table_or_query) if is_query(table_or_query) else spark.table(table_or_query)


# JDBC scheme of each database kind.
JDBC_SCHEMES = {
    "postgresql": "postgresql", "postgres": "postgresql", "mysql": "mysql",
    "sqlserver": "sqlserver", "mssql": "sqlserver", "oracle": "oracle:thin", "sqlite": "sqlite",
}


def jdbc_url(uri: str) -> str:
    return _jdbc_parts(uri)[0]


def _jdbc_parts(uri: str) -> tuple[str, dict[str, str]]:
    """A JDBC URL, and the user and password that other URLs carry before the host."""
    if uri.startswith("jdbc:"):
        return uri, {}
    scheme, sep, rest = uri.partition("://")
    if not sep:
        return f"jdbc:sqlite:{uri}", {}
    kind = JDBC_SCHEMES.get(scheme.split("+")[0].lower())
    if kind is None:
        raise ValueError(f"no JDBC scheme for {scheme!r}")
    if kind == "sqlite":
        return f"jdbc:sqlite:{rest.removeprefix('/')}", {}
    account, _, place = rest.rpartition("@")
    user, _, password = account.partition(":")
    login = {k: unquote(v) for k, v in (("user", user), ("password", password)) if v}
    host, _, database = place.partition("/")
    if kind == "oracle:thin":
        return f"jdbc:oracle:thin:@//{place}", login
    if kind == "sqlserver":
        return f"jdbc:sqlserver://{host}" + (f";databaseName={database}" if database else ""), login
    return f"jdbc:{kind}://{place}", login


def jdbc_options(
    uri: str,
    table_or_query: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column the table is read by many tasks."""
    if not table_or_query:
        raise ValueError("name a table or a query")
    url, login = _jdbc_parts(uri)
    found = {"url": url, **login, **options}
    if partition_column is None:
        found["query" if is_query(table_or_query) else "dbtable"] = table_or_query
        return found
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and a number of partitions")
    # Spark takes a partition column with `dbtable` only, so a query becomes a derived table.
    found["dbtable"] = f"({table_or_query}) src" if is_query(table_or_query) else table_or_query
    found.update(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    return found


def _open_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def jdbc_bounds(spark: SparkSession, uri: str, table_or_query: str, column: str, **options: str) -> tuple | None:
    """The least and the greatest value of a column, by a query that returns one row; nothing if it has none."""
    source = f"({table_or_query}) src" if is_query(table_or_query) else table_or_query
    row = _open_jdbc(spark, jdbc_options(uri, f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source}", **options)).first()
    return None if row is None or row[0] is None else (row[0], row[1])


def read_jdbc(
    spark: SparkSession,
    uri: str,
    table_or_query: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A table or query of a database. With a partition column it is read by many tasks, as many
    as a stage has by default; bounds that are not given are asked for first."""
    if partition_column is not None and bounds is None:
        bounds = jdbc_bounds(spark, uri, table_or_query, partition_column, **options)
        if bounds is None:  # no values, so nothing to divide
            partition_column = None
    if partition_column is None:
        return _open_jdbc(spark, jdbc_options(uri, table_or_query, **options))
    partitions = partitions or spark.sparkContext.defaultParallelism
    found = jdbc_options(uri, table_or_query, partition_column=partition_column, bounds=bounds, partitions=partitions, **options)
    return _open_jdbc(spark, found)


def read_connector(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None, schema=None) -> DataFrame:
    """Any connector on the class path, by format name and options."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def load(
    spark: SparkSession,
    uri: str | None = None,
    *,
    format: str | None = None,
    table: str | None = None,
    query: str | None = None,
    schema=None,
    **options,
) -> DataFrame:
    """Read a source. An explicit `format` wins over what the text of the source says."""
    kind = format or (detect_format(uri) if uri else "catalog")
    if uri and kind == "s3":
        uri = s3a(uri)
        kind = format or detect_format("file:" + uri, "csv")
    if kind == "csv":
        return read_csv(spark, uri, schema, **options)
    if kind == "json":
        return read_json(spark, uri, schema, **options)
    if kind == "payload":
        return read_payload(spark, uri, schema=schema, **options)
    if kind == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.options(**options).parquet(uri)
    if kind == "catalog":
        if not (query or table):
            raise ValueError("name a table or a query")
        return read_table_or_query(spark, query or table)
    if kind in DATABASES:
        return read_jdbc(spark, uri, query or table or "", **options)
    if kind in ("unknown", "excel", "rest_api", "bigquery", "kafka", "snowflake") and format is None:
        raise ValueError(f"no reader for {uri!r} ({kind}); name a format")
    return read_connector(spark, kind, options, uri, schema)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Chunks or versions one below the other, matched by name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def head(df: DataFrame, order_by: Sequence[str], n: int = 500) -> DataFrame:
    """The first n rows of an order: a distributed top-k."""
    return df.orderBy(*[F.col(q(c)) for c in order_by]).limit(n)

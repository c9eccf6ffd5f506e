"""Not-modified revisits of a web archive, resolved to the response they stand for.

Records are (record_id, url, warc_type, captured_at, headers), `warc_type` being
`response` or `revisit` and `headers` an array of (name, value). Each revisit is
matched, by canonical URL, with the latest full response captured before it.
The validators of the two are compared (ETag weakly, else Last-Modified), and
the response's headers are updated by those that a 304 answer may carry.

The as-of match moves only records' metadata, never payloads: records are sorted
by (URL, time) into ranges, each range carries its last response forward, and
what crosses a border is one row per range. A URL with a third of all captures
is spread over as many ranges as its rows fill.

Defined results: a revisit without a URL or time, or with no earlier response,
has status `no_prior`; with validators that differ `mismatch`, and then nothing
is resolved; without a validator on both sides `unchecked`, resolved; else
`verified`. Responses without time are never matched. A response at the same
instant is not earlier. Among responses of one instant the largest record_id
counts. Repeated records are kept. Records of other types are left out, null
headers are none, other columns are ignored. No records: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import shared_dir

# Headers by which a 304 answer updates the stored ones (RFC 9110 15.4.5, RFC 9111 3.2); fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that do not change the page.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"
ROWS_PER_RANGE = 1_000_000


def canonical_url(url: Column) -> Column:
    """No scheme, fragment, default port, `www.`, tracking parameters or closing slash; parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, "#[\\s\\S]*", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/$", "")
    asked = F.split(F.regexp_extract(bare, "\\?([\\s\\S]*)$", 1), "&")
    asked = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise(""))


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def _validated(now: Column, then: Column) -> Column:
    """null if there is nothing to compare."""
    tags = [F.regexp_replace(_header(h, "etag"), "^W/", "") for h in (now, then)]
    days = [_header(h, "last-modified") for h in (now, then)]
    return F.coalesce(tags[0] == tags[1], days[0] == days[1])


def merged_headers(then: Column, now: Column) -> Column:
    """`then` with its permitted headers replaced by those of `now`."""
    brought = F.filter(now, lambda h: F.lower(h["name"]).isin(*PERMITTED))
    names = F.transform(brought, lambda h: F.lower(h["name"]))
    kept = F.filter(then, lambda h: ~F.coalesce(F.array_contains(names, F.lower(h["name"])), F.lit(False)))
    return F.concat(kept, brought)


def _latest_earlier(events: DataFrame) -> DataFrame:
    """Revisits of `events` (key, at, response, own) with `found`, the last response before them."""
    spark = events.sparkSession
    n = events.count()
    if n == 0:
        return events.filter("response IS NULL").withColumn("found", F.col("response"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_RANGE))
    # A revisit sorts before a response of the same instant; a random last column splits ties.
    order = ["key", "at", F.col("response").isNotNull(), F.col("response.record_id")]
    folder = shared_dir(spark, "captures")
    events.repartitionByRange(ranges, *order).withColumn("block", F.spark_partition_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)
    within = Window.partitionBy("block", "key").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumn("local", F.last("response", ignorenulls=True).over(within)).filter("response IS NULL")
    # Only the last key of a block goes on in the next; a block hands over one row.
    ends = stored.groupBy("block").agg(F.max("key").alias("last_key"))
    newest = F.max(F.when(F.col("response").isNotNull(), F.struct("at", "response.record_id", "response")))
    handed = (
        stored.groupBy("block", "key").agg(newest.alias("newest"))
        .join(ends, "block").filter("key = last_key AND newest IS NOT NULL")
        .select("key", "block", "newest.response")
    )
    # Blocks are numbered in the order of (key, at): what the nearest earlier one of a key handed on counts.
    asked = local.filter("local IS NULL").select("key", "block").distinct().withColumn("response", F.lit(None).cast(stored.schema["response"].dataType))
    steps = handed.unionByName(asked).groupBy("key", "block").agg(F.max("response").alias("response"))
    so_far = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = steps.select("key", "block", F.last("response", ignorenulls=True).over(so_far).alias("carried"))
    return local.join(before, ["key", "block"], "left").withColumn("found", F.coalesce("local", "carried"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, canonical_url, status, resolved_to, validated_at, headers."""
    none = F.array().cast("array<struct<name:string,value:string>>")
    events = records.filter(F.col("warc_type").isin("response", "revisit")).select(
        canonical_url(F.col("url")).alias("key"),
        F.col("captured_at").alias("at"),
        F.struct("record_id", F.coalesce("headers", none).alias("headers")).alias("own"),
        F.col("warc_type"),
    )
    known = F.col("key").isNotNull() & F.col("at").isNotNull()
    response = F.when(F.col("warc_type") == "response", F.col("own"))
    matched = _latest_earlier(events.filter(known).select("key", "at", response.alias("response"), "own")).select("key", "at", "own", "found")
    lost = events.filter(~known & (F.col("warc_type") == "revisit")).select("key", "at", "own", F.lit(None).cast(matched.schema["found"].dataType).alias("found"))
    same = _validated(F.col("own.headers"), F.col("found.headers"))
    status = (
        F.when(F.col("found").isNull(), "no_prior").when(same.isNull(), "unchecked").when(same, "verified").otherwise("mismatch")
    )
    judged = matched.unionByName(lost).withColumn("status", status)
    good = F.col("status").isin("verified", "unchecked")
    return judged.select(
        F.col("own.record_id").alias("record_id"),
        F.col("key").alias("canonical_url"),
        "status",
        F.when(good, F.col("found.record_id")).alias("resolved_to"),
        F.when(good, F.col("at")).alias("validated_at"),
        F.when(good, merged_headers(F.col("found.headers"), F.col("own.headers"))).alias("headers"),
    )

"""Chats, archive records and token totals: round trips, ties, nulls and repeats."""

import datetime as dt
import re

from pyspark.sql import functions as F

from siltstone.llm.chat import format_chats, trained_texts
from siltstone.llm.registry import TOKENIZERS
from siltstone.llm.token_counts import Rollup, count_tokens
from siltstone.llm.warc_revisits import resolve_revisits
from siltstone.session import shared_dir


def test_chats_read_back(spark):
    nasty = ["<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<\\\\|", "<", "<|", "|>", "\n", "", None, "a<|im_end|>", "é𝒳\\"]
    rows = [(i // 3, i % 3, ["user", "assistant", "a\nb<|im_end|>"][i % 3], t) for i, t in enumerate(nasty)]
    rows += [(50, 1, None, "x"), (50, 1, "user", "x"), (50, 1, "user", "x"), (None, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    chats = format_chats(df)
    for r in chats.withColumn("trained", trained_texts(F.col("formatted"), F.col("mask_runs"))).collect():
        mine = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in mine]
        assert sum(m.chars for m in r.mask_runs) == len(r.formatted)
        assert r.trained == [t.text for t in r.turns if t.role == "assistant"]
        at, masked = 0, ""
        for m in r.mask_runs:
            masked += r.formatted[at : at + m.chars] if m.trained else ""
            at += m.chars
        assert re.sub(r"<(\\*)\\\|", r"<\1|", masked) == "".join(r.trained)
    assert format_chats(df.limit(0)).count() == 0


def test_revisits(spark):
    def at(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)

    head = lambda **h: [{"name": k.replace("_", "-"), "value": v} for k, v in h.items()]
    rows = [
        ("r1", "http://www.A.com/x/?b=2&a=1&utm_source=q#f", "response", at(1), head(ETag='"1"', Content_Type="t")),
        ("r2", "https://a.com:443/x?a=1&b=2", "response", at(3), head(ETag='"2"')),
        ("v1", "a.com/x?a=1&b=2", "revisit", at(2), head(etag='W/"1"', Date="d", Content_Type="no")),
        ("v2", "a.com/x?a=1&b=2", "revisit", at(4), head(ETag='"1"')),
        ("v3", "a.com/x?a=1&b=2", "revisit", at(1), None),
        ("v4", "a.com/x?a=1&b=2", "revisit", at(9), None),
        ("v5", None, "revisit", at(9), None),
        ("v6", "a.com/x?a=1&b=2", "revisit", None, None),
        ("m1", "a.com/x?a=1&b=2", "metadata", at(1), None),
    ]
    df = spark.createDataFrame(rows, "record_id string, url string, warc_type string, captured_at timestamp, headers array<struct<name:string,value:string>>")
    got = {r.record_id: r for r in resolve_revisits(df.withColumn("block", F.lit(1))).collect()}
    assert {k: (r.status, r.resolved_to) for k, r in got.items()} == {
        "v1": ("verified", "r1"), "v2": ("mismatch", None), "v3": ("no_prior", None), "v4": ("unchecked", "r2"), "v5": ("no_prior", None), "v6": ("no_prior", None),
    }
    assert [tuple(h) for h in got["v1"].headers] == [("Content-Type", "t"), ("etag", 'W/"1"'), ("Date", "d")]
    assert resolve_revisits(df.limit(0)).count() == 0


def test_one_url_over_many_ranges(spark):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("record_id"), F.lit("http://hot.com/").alias("url"),
        F.when(F.col("id") % 500 == 0, "response").otherwise("revisit").alias("warc_type"), F.timestamp_seconds("id").alias("captured_at"),
        F.array().cast("array<struct<name:string,value:string>>").alias("headers"),
    )
    got = resolve_revisits(rows).collect()
    assert len(got) == 3992 and all(int(r.resolved_to) == int(r.record_id) // 500 * 500 for r in got)


def test_token_totals(spark):
    docs = spark.createDataFrame([(1, "one two", "a", "en"), (2, None, "a", None), (3, "", "b", "en"), (3, "", "b", "en")], "doc_id long, text string, source string, lang string")
    counted = count_tokens(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "v1")
    rollup = Rollup(spark, shared_dir(spark, "rollup-test"))
    assert rollup.totals().count() == 0
    assert rollup.commit("b1", counted) and not rollup.commit("b1", counted)
    total = lambda: {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals().collect()}
    assert total() == {("a", "en"): (1, 2), ("a", None): (1, 0), ("b", "en"): (1, 0)}
    rollup.commit("b2", counted.filter("doc_id = 1").withColumn("tokens", F.lit(7).cast("long")).withColumn("source", F.lit("c")))
    rollup.commit("b3", deletes=counted.filter("doc_id = 2").select("doc_id", "tokenizer").union(spark.createDataFrame([(77, "v1")], "doc_id long, tokenizer string")))
    rollup.commit("b4", counted.limit(0))
    assert total() == {("a", "en"): (0, 0), ("a", None): (0, 0), ("b", "en"): (1, 0), ("c", "en"): (1, 7)}
    assert rollup.committed() == ["b1", "b2", "b3", "b4"]


def test_one_url_over_many_ranges(spark):
    """Revisits far behind the last response, ranges without any, repeated records and ties at one instant."""
    def at(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)

    rows = [(f"r{i}", "http://a.com/", "response", at(i), []) for i in (3, 4, 90, 91, 300)]
    rows += [("r91b", "http://a.com/", "response", at(91), []), ("z", "http://b.com/", "response", at(0), [])]
    rows += [(f"v{i}", "http://a.com/", "revisit", at(i), None) for i in range(400)] * 2
    records = spark.createDataFrame(rows, "record_id string, url string, warc_type string, captured_at timestamp, headers array<struct<name:string,value:string>>")
    got = sorted(((r.record_id, r.resolved_to) for r in resolve_revisits(records.repartition(5)).collect()), key=lambda x: (x[0], x[1] or ""))
    want = []
    for i in range(400):
        earlier = [(t, r) for r, u, k, t, _ in rows if k == "response" and u == "http://a.com/" and t < at(i)]
        want += [(f"v{i}", max(earlier)[1] if earlier else None)] * 2
    assert got == sorted(want, key=lambda x: (x[0], x[1] or ""))
    assert resolve_revisits(records.limit(0)).count() == 0


def test_each_text_of_a_batch_is_counted_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    facts = "doc_id bigint, tokenizer string, source string, lang string, tokens bigint"
    rollup = Rollup(spark, shared_dir(spark, "rollup-once"))
    for name, tokens in (("load", 5), ("revision", 7)):
        batch = spark.createDataFrame([(i, "v1", "s", "en", tokens) for i in range(4)], facts).mapInArrow(count, facts)
        before = counted.value
        rollup.commit(name, batch)
        assert counted.value - before == 4
    rollup.commit("takedown", deletes=spark.createDataFrame([(0, "v1"), (9, "v1")], "doc_id int, tokenizer string"))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "v1", 3, 21, 8, 48, 5, 27)]

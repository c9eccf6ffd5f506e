import datetime as dt
import warnings

import duckdb
import pytest
from pyspark.sql import functions as F

from siltstone.operators import cdc, incremental, keys, scd2
from siltstone.plans import q_decisions, q_history  # noqa: F401  (register queries)
from siltstone.plans.layered import RunConfig, apply_batch, read_layer, run, upsert
from siltstone.operators.quality import QualityGateError
from siltstone.plans.registry import ORACLES, QUERIES
from siltstone.session import shared_dir
from siltstone.sources import versions
from siltstone.sources.tables import HistoryTable, KeyedTable, PartedTable, VersionedTable
from siltstone.sources.versions import VersionLog, folder_names
from siltstone.streaming.ingest import file_stream, stream_history

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, r int, v string")


def state(df):
    return sorted(
        ((r["k"], r["r"], r["v"], str(r["_valid_from"]), str(r["_valid_to"]), r["_is_current"]) for r in df.collect()), key=repr
    )


def test_merge_cases_with_composite_and_null_keys(spark):
    first = orders(spark, (1, 1, "a"), (1, 2, "b"), (None, 1, "n"), (4, 1, "gone"))
    gold = scd2.scd2_merge(None, first, ["k", "r"], ["v"], T1)
    batch = orders(spark, (1, 1, "a"), (1, 2, "B"), (None, 1, "N"), (5, 1, "new"))
    merged = scd2.scd2_merge(gold, batch, ["k", "r"], ["v"], T2)
    got = state(merged)
    assert (1, 1, "a", T1, "None", True) in got
    assert (1, 2, "b", T1, T2, False) in got and (1, 2, "B", T2, "None", True) in got
    assert (None, 1, "n", T1, T2, False) in got and (None, 1, "N", T2, "None", True) in got
    assert (4, 1, "gone", T1, "None", True) in got
    assert (5, 1, "new", T2, "None", True) in got
    assert len(got) == 7
    assert merged.filter("_is_current").groupBy("k", "r").count().filter("count > 1").count() == 0
    assert merged.filter("_valid_to <= _valid_from").count() == 0


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_changes_and_snapshots_are_classified_alike(spark, threshold):
    gold = scd2.first_load(orders(spark, (1, 1, "a"), (1, 2, "b"), (None, 1, None), (4, None, "d")), ["v"], T1)
    batch = orders(spark, (1, 1, "a"), (1, 2, "B"), (None, 1, None), (4, None, "D"), (5, 5, "e"), (None, None, "f"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = [
            sorted(map(str, scd2.classify(gold, batch, ["k", "r"], ["v"], snapshot=s).select("status", "old", "new").collect()))
            for s in (False, True)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[0] == found[1] and len(found[0]) == 6


def test_replay_changes_nothing(spark):
    gold = scd2.scd2_merge(None, orders(spark, (1, 1, "a"), (2, 1, None)), ["k", "r"], ["v"], T1)
    batch = orders(spark, (1, 1, "x"), (2, 1, None))
    once = scd2.scd2_merge(gold, batch, ["k", "r"], ["v"], T2)
    twice = scd2.scd2_merge(once, batch, ["k", "r"], ["v"], T3)
    assert state(once) == state(twice)


def test_expire_missing_and_stats(spark):
    gold = scd2.first_load(orders(spark, (1, 1, "a"), (2, 1, "b")), ["v"], T1)
    batch = orders(spark, (1, 1, "a"))
    expired = scd2.scd2_merge(gold, batch, ["k", "r"], ["v"], T2, expire_missing=True)
    assert (2, 1, "b", T1, T2, False) in state(expired)
    stats = scd2.merge_stats(scd2.classify(gold, batch, ["k", "r"], ["v"])).first()
    assert tuple(stats) == (0, 0, 1, 1, 0)


def test_hash_sees_borders_nulls_and_small_parts_of_time(spark):
    df = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), (None, "abc"), ("abc", None), ("", "abc")], "a string, b string"
    )
    assert df.select(scd2.change_hash(df, ["a", "b"])).distinct().count() == 5
    times = spark.createDataFrame([("2024-01-01 00:00:00.000001",), ("2024-01-01 00:00:00.000002",)], "t string").select(F.col("t").cast("timestamp"))
    assert times.select(scd2.change_hash(times, ["t"])).distinct().count() == 2


def test_type_drift_is_no_change(spark):
    gold = scd2.first_load(spark.createDataFrame([(1, 9.0)], "k int, v double"), ["v"], T1)
    batch = spark.createDataFrame([(1, 9)], "k int, v int")
    assert scd2.classify(gold, batch, ["k"], ["v"]).first()["status"] == "unchanged"


def test_new_column_in_a_batch(spark):
    gold = scd2.first_load(spark.createDataFrame([(1, "a")], "k int, v string"), ["v"], T1)
    batch = spark.createDataFrame([(1, "a", "extra")], "k int, v string, w string")
    out = scd2.scd2_merge(gold, batch, ["k"], ["v", "w"], T2)
    assert sorted((r["w"], r["_is_current"]) for r in out.collect() if r["w"]) == [("extra", True)]


def test_repeated_keys_need_an_order(spark):
    gold = scd2.first_load(orders(spark, (1, 1, "a")), ["v"], T1)
    twice = orders(spark, (1, 1, "b"), (1, 1, "c"))
    with pytest.raises(Exception, match="repeated key"):
        scd2.scd2_merge(gold, twice, ["k", "r"], ["v"], T2).collect()
    last = scd2.scd2_merge(gold, twice, ["k", "r"], ["v"], T2, order_by=["v"])
    assert (1, 1, "c", T2, "None", True) in state(last)


def test_default_keys():
    assert scd2.default_keys(["a", "b"]) == (["a"], ["b"])
    assert scd2.default_keys(["a", "b"], ["b"]) == (["b"], ["a"])
    with pytest.raises(ValueError):
        scd2.default_keys(["a"], ["z"])


def test_history_table_counts_a_label_once_and_ignores_unpublished_writes(spark):
    table = HistoryTable(spark, shared_dir(spark, "gold"))
    assert table.read() is None
    assert apply_batch(table, orders(spark, (1, 1, "a"), (2, 1, "b")), ["k", "r"], T1, label="one")
    assert not apply_batch(table, orders(spark, (1, 1, "zzz")), ["k", "r"], T2, label="one")
    # A write that was never published leaves no trace.
    table.read().limit(1).write.parquet(f"{table.root}/data/unfinished")
    assert table.read().count() == 2
    assert apply_batch(table, orders(spark, (1, 1, "A")), ["k", "r"], T2, label="two")
    assert apply_batch(table, orders(spark, (1, 1, "AA")), ["k", "r"], T3, label="three")
    want = [(1, 1, "A", T2, T3, False), (1, 1, "AA", T3, "None", True), (1, 1, "a", T1, T2, False), (2, 1, "b", T1, "None", True)]
    assert state(table.read()) == sorted(want, key=repr)
    assert table.current().count() == 2


def test_history_table_starts_empty_and_takes_new_columns(spark):
    table = HistoryTable(spark, shared_dir(spark, "gold"))
    apply_batch(table, spark.createDataFrame([], "k int, r int, v string"), ["k", "r"], T1, label="none")
    assert table.read().count() == 0 and table.current().count() == 0
    apply_batch(table, orders(spark, (1, 1, "a"), (2, 2, "b")), ["k", "r"], T1, label="one")
    wider = spark.createDataFrame([(1, 1, "a", "w")], "k int, r int, v string, w string")
    apply_batch(table, wider, ["k", "r"], T2, label="two")
    got = sorted(((r["k"], r["w"], r["_is_current"]) for r in table.read().collect()), key=repr)
    assert got == [(1, "w", True), (1, None, False), (2, None, True)]
    narrower = spark.createDataFrame([(2, 2)], "k int, r int")
    apply_batch(table, narrower, ["k", "r"], T3, label="three")
    # What the batch does not bring keeps its value, and without a change there is no version.
    assert table.current().filter("k = 2").first()["v"] == "b"
    assert table.read().count() == 3


def test_versioned_table_can_be_replaced_from_itself(spark):
    table = VersionedTable(spark, shared_dir(spark, "v"))
    table.replace(spark.range(5), "a")
    table.replace(table.read().filter("id < 2"), "b")
    assert table.read().count() == 2 and table.latest() == 2 and table.has("a") and not table.has("c")


def test_upsert(spark):
    old = orders(spark, (1, 1, "a"), (2, 1, "b"))
    new = orders(spark, (2, 1, "B"), (3, 1, "c"))
    got = sorted(tuple(r) for r in scd2.scd1_upsert(old, new, ["k", "r"]).collect())
    assert got == [(1, 1, "a"), (2, 1, "B"), (3, 1, "c")]


def test_cdc_ignores_blank_keys_and_rebuilds_the_new_snapshot(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("", 9), (None, 9)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 4), (" ", 9)], "k string, v int")
    events = cdc.snapshot_diff(old, new, "k")
    assert {(r["pk"], r["op"], tuple(r["changed_cols"])) for r in events.collect()} == {
        ("a", "unchanged", ()), ("b", "update", ("v",)), ("c", "unchanged", ()), ("d", "insert", ()),
    }
    assert tuple(cdc.diff_counts(events).first()) == (1, 1, 0, 2, 4)
    rebuilt = cdc.apply_diff(old.filter("trim(k) <> ''"), events, "k")
    assert sorted((tuple(r) for r in rebuilt.collect()), key=repr) == [("a", 1), ("b", 3), ("c", None), ("d", 4)]


def test_cdc_columns_that_come_and_go(spark):
    old = spark.createDataFrame([(1, "x")], "k int, a string")
    new = spark.createDataFrame([(1, "y")], "k int, b string")
    row = cdc.snapshot_diff(old, new, "k").first()
    assert (row["op"], row["changed_cols"], row["before"]["a"], row["after"]["b"]) == ("update", ["b", "a"], "x", "y")


def test_cdc_duplicate_keys(spark):
    old = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, s int, v string")
    new = spark.createDataFrame([(1, 2, "y")], "k int, s int, v string")
    with pytest.raises(Exception, match="repeated key"):
        cdc.snapshot_diff(old, new, "k").collect()
    assert cdc.snapshot_diff(old, new, "k", order_by=["s"]).first()["op"] == "unchanged"


def test_cdc_pairs_of_repeated_keys(spark, rows):
    schema = "k int, v double"
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (5, None), (6, 6.0), (None, 9.0), (None, 9.0)], schema)
    new = spark.createDataFrame(
        [(1, 1.0), (1, 1.0), (2, 2.0), (2, 0.0), (3, 5.0), (3, 5.0), (5, None), (6, 7.0), (7, 7.0), (7, 8.0), (None, 8.0)], schema
    )
    want = sorted(
        [(1, "unchanged", 1.0, 1.0)] * 2 + [(2, "unchanged", 2.0, 2.0), (2, "update", 2.0, 0.0)] + [(3, "update", 3.0, 5.0)] * 2
        + [(4, "delete", 4.0, None), (5, "unchanged", None, None), (6, "update", 6.0, 7.0), (7, "insert", None, 7.0), (7, "insert", None, 8.0)],
        key=repr,
    )
    for images in ("all", "changed"):
        with pytest.raises(Exception, match="repeated key"):
            cdc.snapshot_diff(old, new, "k", images=images).collect()
        events = cdc.snapshot_diff(old, new, "k", images=images, repeated="pairs")
        seen = [w if images == "all" or w[1] != "unchanged" else (*w[:2], None, None) for w in want]
        assert rows(events, "pk", "op", "before.v", "after.v") == sorted(seen, key=repr)
        assert {r["op"]: r["changed_cols"] for r in events.collect()} == {"unchanged": [], "update": ["v"], "delete": [], "insert": []}
        rebuilt = cdc.apply_diff(old, events, "k", repeated="pairs")
        assert rows(rebuilt) == sorted([r for r in map(tuple, new.collect()) if r[0]] + [(None, 9.0)] * 2, key=repr)
        back = cdc.snapshot_diff(new, old, "k", images=images, repeated="pairs")
        assert back.filter("op = 'update' and pk = 3").count() == 2 and back.filter("op = 'delete' and pk = 7").count() == 2
        with pytest.raises(Exception, match="repeated key in the old snapshot"):
            cdc.apply_diff(new, back, "k", repeated="pairs").collect()
    with pytest.raises(ValueError):
        cdc.snapshot_diff(old, new, "k", order_by=["v"], repeated="pairs")


def test_diffs_of_orders_beyond_a_million(spark, rows, tmp_path):
    """The second snapshot's added keys meet keys that are there, so a key has two rows in it."""
    con = duckdb.connect()
    con.execute(
        """CREATE TABLE orders AS SELECT k AS o_orderkey, k % 7 AS o_custkey, 'O' AS o_orderstatus, k / 4 AS o_totalprice,
        TIMESTAMP '2024-01-01' + INTERVAL (k % 9) DAY AS o_orderdate, '1-URGENT' AS o_orderpriority
        FROM (SELECT unnest(range(300)) AS k UNION ALL SELECT 1000000 + unnest(range(300)))"""
    )
    con.execute(f"COPY orders TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    for name in (
        "c01_snapshot_diff", "c02_changed_columns", "c03_diff_counts", "j04_full_outer_match", "c01_replayed_diff",
        "c01_digest_first", "c03_digest_counts", "c01_digest_replayed",
    ):
        found = QUERIES[name](spark, str(tmp_path))
        want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLES[name]})").fetchall()
        assert rows(found) == sorted(want, key=repr), name


def orders_beyond_a_million(path):
    """Orders in which the second snapshot's added keys meet keys that are there, and a connection that knows them."""
    con = duckdb.connect()
    con.execute(
        """CREATE TABLE orders AS SELECT k AS o_orderkey, k % 7 AS o_custkey, 'O' AS o_orderstatus, k / 4 AS o_totalprice,
        TIMESTAMP '2024-01-01' + INTERVAL (k % 9) DAY AS o_orderdate, '1-URGENT' AS o_orderpriority
        FROM (SELECT unnest(range(300)) AS k UNION ALL SELECT 1000000 + unnest(range(300)))"""
    )
    con.execute(f"COPY orders TO '{path}/orders.parquet' (FORMAT parquet)")
    return con


MERGES_BEYOND_A_MILLION = (
    "t04_stream_history",
    "t04_two_streams",
    "c09_default_key",
    "c08_upsert",
    "c08_narrow_batch",
    "c06_same_moment",
    "c07_merge_stats",
    "c06_reordered_batch",
    "c07_expired_missing",
    "c06_late_batch",
    "c06_narrow_batch",
    "c06_history_table",
    "c06_expire_missing",
    "c06_history_merge",
)


@pytest.mark.parametrize("name", MERGES_BEYOND_A_MILLION)
def test_merges_of_orders_beyond_a_million(spark, rows, tmp_path, name):
    con = orders_beyond_a_million(tmp_path)
    found = QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLES[name]})").fetchall()
    assert rows(found) == sorted(want, key=repr)


@pytest.mark.parametrize("snapshot", [False, True])
def test_pairs_of_repeated_keys_in_a_merge(spark, snapshot):
    gold = scd2.first_load(orders(spark, (1, 1, "a"), (2, 1, "b"), (3, 1, "c"), (None, 1, "n"), (None, 1, "n")), ["v"], T1)
    batch = orders(spark, (1, 1, "a"), (1, 1, "A"), (2, 1, "B"), (5, 1, "e"), (5, 1, "E"))
    classified = scd2.classify(gold, batch, ["k", "r"], ["v"], snapshot=snapshot, repeated="pairs")
    assert tuple(scd2.merge_stats(classified).first()) == (2, 2, 1, 3, 2)
    merged = scd2.scd2_merge(gold, batch, ["k", "r"], ["v"], T2, snapshot=snapshot, repeated="pairs")
    now = (T2, "None", True)
    want = [
        (1, 1, "a", T1, "None", True), (1, 1, "a", T1, T2, False), (1, 1, "a", *now), (1, 1, "A", *now),
        (2, 1, "b", T1, T2, False), (2, 1, "B", *now), (3, 1, "c", T1, "None", True),
        *[(5, 1, v, *now) for v in "eeEE"], *[(None, 1, "n", T1, "None", True)] * 2,
    ]
    assert state(merged) == sorted(want, key=repr)
    # Key 1 has several current versions now: one row meets each of them, several are refused.
    once = scd2.scd2_merge(merged, orders(spark, (1, 1, "A")), ["k", "r"], ["v"], T3, snapshot=snapshot, repeated="pairs")
    assert [r for r in state(once) if r[0] == 1 and r[4] == T3] == [(1, 1, "a", T1, T3, False), (1, 1, "a", T2, T3, False)]
    with pytest.raises(Exception, match="several current versions"):
        scd2.scd2_merge(merged, batch, ["k", "r"], ["v"], T3, snapshot=snapshot, repeated="pairs").collect()
    with pytest.raises(ValueError):
        scd2.classify(gold, batch, ["k", "r"], ["v"], order_by=["v"], snapshot=snapshot, repeated="pairs")


def test_gold_counts_of_orders_beyond_a_million(spark, rows, tmp_path):
    con = orders_beyond_a_million(tmp_path)
    found = QUERIES["l04_gold_counts"](spark, str(tmp_path))
    assert rows(found) == con.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLES['l04_gold_counts']})").fetchall()


@pytest.mark.parametrize("snapshot", [False, True])
def test_sequence_of_repeated_keys_in_a_merge(spark, snapshot):
    gold = scd2.first_load(orders(spark, (1, 1, "a"), (2, 1, "b"), (3, 1, "c"), (4, 1, "d"), (None, 1, "n")), ["v"], T1)
    batch = orders(spark, (1, 1, "a"), (1, 1, "A"), (2, 1, "B"), (2, 1, "C"), (2, 1, "B"), (4, 1, "d"), (4, 1, "d"), (5, 1, "e"), (5, 1, "E"), (None, 1, "N"), (None, 1, None))
    classified = scd2.classify(gold, batch, ["k", "r"], ["v"], snapshot=snapshot, repeated="sequence")
    assert tuple(scd2.merge_stats(classified).first()) == (2, 6, 3, 1, 6)
    merged = scd2.scd2_merge(gold, batch, ["k", "r"], ["v"], T2, snapshot=snapshot, repeated="sequence")
    found = state(merged)
    # An event that is new or changed starts a version, and each ends the one before.
    assert [r for r in found if r[3] == T1] == sorted(
        [(1, 1, "a", T1, T2, False), (2, 1, "b", T1, T2, False), (3, 1, "c", T1, "None", True), (4, 1, "d", T1, "None", True), (None, 1, "n", T1, T2, False)], key=repr
    )
    started = [r for r in found if r[3] == T2]
    assert sorted((r[:3] for r in started), key=repr) == sorted([(1, 1, "A"), (2, 1, "B"), (2, 1, "B"), (2, 1, "C"), (5, 1, "E"), (5, 1, "e"), (None, 1, "N"), (None, 1, None)], key=repr)
    assert {(r[4], r[5]) for r in started} == {("None", True), (T2, False)}
    assert sorted((r[0] for r in found if r[5]), key=repr) == [1, 2, 3, 4, 5, None]
    # So the next batch finds one current version of every key, and one that begins now stands in for those of now.
    again = scd2.scd2_merge(merged, orders(spark, (2, 1, "x"), (2, 1, "y")), ["k", "r"], ["v"], T2, snapshot=snapshot, repeated="sequence")
    assert [r[5] for r in state(again) if r[0] == 2].count(True) == 1 and len([r for r in state(again) if r[0] == 2]) == 5
    ended = scd2.scd2_merge(gold, batch, ["k", "r"], ["v"], T2, expire_missing=True, repeated="sequence")
    assert [r for r in state(ended) if r[0] == 3] == [(3, 1, "c", T1, T2, False)]
    for call in (scd2.classify, scd2.scd1_upsert):
        with pytest.raises(ValueError):
            call(gold, batch, ["k", "r"], ["v"], repeated="sequence", **({"order_by": ["v"]} if call is scd2.classify else {}))


def test_key_joins_are_null_safe(spark):
    a = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    b = spark.createDataFrame([(None, 9), (1, 9), (1, 9)], "k int, v int")
    assert keys.with_keys(a, b, ["k"]).count() == 2
    assert [tuple(r) for r in keys.without_keys(a, b, ["k"]).collect()] == [(2, 3)]
    matched = keys.match_left(a, b.dropDuplicates(), ["k"])
    assert matched.columns == ["k", "v_new", "v_old", "_match"]
    assert {(r["k"], r["_match"]) for r in matched.collect()} == {(None, "both"), (1, "both"), (2, "left_only")}
    assert {tuple(r) for r in keys.key_sets(a, b, ["k"]).collect()} == {(1, "both"), (2, "old")}


def test_date_window(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("soon",), (None,)], "d string")
    assert incremental.date_window(df, "d", "2024-01-01", "2024-01-02").count() == 1
    assert incremental.date_window(df, "d", end="2024-01-03").count() == 2
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert incremental.date_window(df, "zzz", "2024-01-01").count() == 4
    assert seen
    typed = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 30),), (dt.datetime(2024, 1, 2),)], "t timestamp")
    windows = [incremental.date_window(typed, "t", a, b).count() for a, b in (("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-03"))]
    assert windows == [1, 1]


def test_watermark_compares_types(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "n int")
    assert sorted(r[0] or 0 for r in incremental.newer_than(df, "n", 9).collect()) == [0, 10]
    assert incremental.newer_than(df, "n", 9, keep_null=False).count() == 1
    assert incremental.newer_than(df, "n", None).count() == 3
    assert incremental.newer_than(df, "n", 9, mode="full_load").count() == 3
    assert tuple(incremental.watermark_stats(df, "n", 9).first()) == ("incremental", 3, 2, 1, "9", "10")
    text = spark.createDataFrame([("2024-01-02",), ("",), (None,), ("2023-12-31",)], "d string")
    assert incremental.newer_than(text, "d", "2024-01-01").count() == 3
    assert incremental.newer_than(text, "d", "2024-01-01", keep_null=False).count() == 1


def test_watermark_store(spark, tmp_path):
    path = shared_dir(spark, "mark")
    assert incremental.load_watermark(spark, path) == (None, None, None)
    incremental.save_watermark(spark, path, 5, "id", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    incremental.save_watermark(spark, path, 7, "id", dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    assert incremental.load_watermark(spark, path)[:2] == ("7", "id")


SALES = "id bigint, email string, amount double, at timestamp"


def sales(spark, *rows):
    return spark.createDataFrame([(i, f"u{i}@x.org", a, dt.datetime.fromisoformat(t)) for i, a, t in rows], SALES)


def test_incremental_runs_build_history(spark):
    root = shared_dir(spark, "run")
    base = dict(root=root, keys=("id",), timestamp="at", gold_mode="scd2", null_override="flag")
    one = run(
        spark, sales(spark, (1, 5.0, "2024-01-01T05:00:00"), (2, 6.0, "2024-01-01T06:00:00"), (3, 1.0, "2024-01-02T00:00:00")),
        RunConfig(window_start="2024-01-01", window_end="2024-01-02", as_of=T1, run_id="r1", **base),
    )
    assert one.bronze.count() == 2 and one.gold.count() == 2 and one.card["dq_status"] == "PASS"
    two = run(
        spark, sales(spark, (1, 9.0, "2024-01-02T05:00:00"), (3, 1.0, "2024-01-02T00:00:00")),
        RunConfig(window_start="2024-01-02", window_end="2024-01-03", as_of=T2, run_id="r2", **base), one.mapping,
    )
    got = sorted((r["id"], r["amount"], r["_is_current"]) for r in two.gold.collect())
    assert got == [(1, 5.0, False), (1, 9.0, True), (2, 6.0, True), (3, 1.0, True)]
    # The same run again changes nothing.
    again = run(
        spark, sales(spark, (1, 9.0, "2024-01-02T05:00:00"), (3, 1.0, "2024-01-02T00:00:00")),
        RunConfig(window_start="2024-01-02", window_end="2024-01-03", as_of=T3, run_id="r2", **base), one.mapping,
    )
    assert sorted((r["id"], r["amount"], r["_is_current"]) for r in again.gold.collect()) == got
    assert read_layer(spark, root, "bronze", increments=True).count() == 4
    # An empty increment is a run like any other.
    empty = run(
        spark, sales(spark, (9, 9.0, "2023-01-02T05:00:00")),
        RunConfig(window_start="2024-01-03", window_end="2024-01-04", as_of=T3, run_id="r3", **base), one.mapping,
    )
    assert empty.silver.count() == 0 and empty.gold.count() == 4


def test_an_empty_first_window_and_a_rerun_without_rows(spark):
    root = shared_dir(spark, "run")
    day = dict(root=root, timestamp="at", window_start="2024-01-01", window_end="2024-01-02", null_override="flag", keys=("id",), gold_mode="scd2")
    none = run(spark, sales(spark, (1, 5.0, "2025-01-01T05:00:00")), RunConfig(run_id="a", **day))
    assert (none.bronze.count(), none.gold.count(), none.card["dq_status"]) == (0, 0, "PASS")
    some = run(spark, sales(spark, (1, 5.0, "2024-01-01T05:00:00")), RunConfig(run_id="b", **day))
    assert (some.bronze.count(), some.gold.count()) == (1, 1)
    again = run(spark, sales(spark, (1, 5.0, "2025-01-01T05:00:00")), RunConfig(run_id="c", **day))
    assert (again.bronze.count(), again.gold.count()) == (0, 1)


def test_run_profiles_what_it_wrote(spark):
    root = shared_dir(spark, "run")
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")] * 10, "order_id bigint, note string")
    done = run(spark, df, RunConfig(root=root, on_fail="warn", timestamp=None, order_by=("note",)))
    found = {r["column"]: (r["null_count"], r["cardinality"], r["total_rows"]) for r in done.profile.collect()}
    assert found == {"order_id": (0, 3, 30), "note": (10, 1, 30)}
    assert done.silver.count() == 3 and done.note.startswith("No aggregation")


def test_block_stops_before_gold(spark):
    root = shared_dir(spark, "run")
    df = spark.createDataFrame([(1, None), (2, "x")], "id bigint, note string")
    with pytest.raises(QualityGateError):
        run(spark, df, RunConfig(root=root, null_override="flag"))
    assert read_layer(spark, root, "silver").count() == 2
    assert VersionedTable(spark, f"{root}/gold_passthrough").read() is None


def test_tables_and_upsert_mode(spark):
    root = shared_dir(spark, "run")
    name = "t" + root.rsplit("-", 1)[-1]
    config = RunConfig(root=root, keys=("id",), gold_mode="scd1", timestamp="at", window_end="2024-01-02", silver_table=name + "_s", gold_table=name + "_g")
    run(spark, sales(spark, (1, 5.0, "2024-01-01T05:00:00")), config)
    assert spark.table(name + "_g").count() == 1 and spark.table(name + "_s").count() == 1


def test_a_batch_in_another_shape_makes_no_false_history(spark):
    gold = HistoryTable(spark, shared_dir(spark, "gold"))
    first = spark.sql("SELECT 1 AS k, 'x' AS v, timestamp'2024-01-01 05:00:00' AS at, map('a', 1) AS m")
    apply_batch(gold, first, ["k"], T1, label="one")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        moved = first.select("m", "at", "v", "k").withColumn("fresh", F.lit(None).cast("string"))
        apply_batch(gold, moved, ["k"], T2, label="two")
        assert gold.read().count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    changed = spark.sql("SELECT 1 AS k, 'y' AS v")
    apply_batch(gold, changed, ["k"], T2, label="three")
    assert sorted((r["v"], r["m"]["a"], r["_is_current"]) for r in gold.read().collect()) == [("x", 1, False), ("y", 1, True)]


def test_a_batch_from_before_a_version_raises(spark):
    gold = HistoryTable(spark, shared_dir(spark, "gold"))
    apply_batch(gold, orders(spark, (1, 1, "a")), ["k", "r"], T2, label="one")
    with pytest.raises(Exception, match="its version began"):
        apply_batch(gold, orders(spark, (1, 1, "b")), ["k", "r"], T1, label="two")
    assert state(gold.read()) == [(1, 1, "a", T2, "None", True)]


def test_two_streams_into_one_history(spark):
    root = shared_dir(spark, "streams")
    schema = "k int, r int, v string"
    for name, row in (("a", (1, 1, "a")), ("b", (2, 2, "b"))):
        orders(spark, row).write.parquet(f"{root}/{name}")
        stream = file_stream(spark, f"{root}/{name}", schema)
        stream_history(stream, f"{root}/gold", f"{root}/{name}-marks", ["k", "r"], lambda i: T1, trigger="available").awaitTermination()
    assert [r[0] for r in state(HistoryTable(spark, f"{root}/gold").read())] == [1, 2]


HOURS = [f"2024-01-01T{h:02}:00:00" for h in range(24)]


@pytest.mark.parametrize("mode", ["passthrough", "aggregate", "scd1", "scd2"])
def test_windows_of_one_day_and_a_full_load_lose_nothing(spark, mode):
    root = shared_dir(spark, "run")
    name = "w" + root.rsplit("-", 1)[-1]
    everything = sales(spark, *[(i, -1.0 if i == 20 else 2.0, t) for i, t in enumerate(HOURS)])
    base = dict(root=root, keys=("id",), timestamp="at", gold_mode=mode, group_by="at_day", null_override="flag",
                rules="at_day = cast(at as date)", silver_table=name, silver_table_mode="append", as_of=T1)
    windows = [("2024-01-01", "2024-01-01 10:00:00"), ("2024-01-01 10:00", "2024-01-02")]
    first = run(spark, everything, RunConfig(window_start=windows[0][0], window_end=windows[0][1], run_id="a", **base))
    for _ in range(2):  # the second window, and the same run again
        last = run(spark, everything, RunConfig(window_start=windows[1][0], window_end=windows[1][1], run_id="b", **base), first.mapping)

    def check(gold):
        if mode == "aggregate":
            assert [(r["id"], r["amount"], r["amount_had_negative"], r["_record_count"]) for r in gold.collect()] == [(276, 46.0, 1, 24)]
        else:
            assert sorted(r["id"] for r in gold.collect()) == list(range(24))

    check(last.gold)
    assert read_layer(spark, root, "bronze", increments=True).count() == read_layer(spark, root, "silver", increments=True).count() == 24
    assert spark.table(name).count() == 24
    check(run(spark, everything, RunConfig(run_id="c", **{**base, "silver_table": None}), first.mapping).gold)
    assert read_layer(spark, root, "silver", increments=True).count() == 24


def test_gold_that_is_a_whole_is_not_appended(spark):
    config = RunConfig(root=shared_dir(spark, "run"), gold_mode="scd2", gold_table="t", table_mode="append")
    with pytest.raises(ValueError, match="only be replaced"):
        run(spark, sales(spark, (1, 5.0, HOURS[0])), config)


def test_a_personal_column_that_comes_later_is_hashed(spark):
    root = shared_dir(spark, "run")
    one = run(spark, sales(spark, (1, 5.0, HOURS[0])), RunConfig(root=root, timestamp="at"))
    later = sales(spark, (2, 5.0, HOURS[1])).withColumn("customer_phone", F.lit("+1 555 0100"))
    two = run(spark, later, RunConfig(root=root, timestamp="at"), one.mapping)
    assert len(two.gold.first()["customer_phone"]) == 64


def test_a_key_with_a_null_is_filled_along_the_rest(spark):
    rows = sales(spark, *[(i, 1.0, t) for i, t in enumerate(HOURS)]).withColumn("id", F.expr("nullif(id, 7)"))
    done = run(spark, rows, RunConfig(root=shared_dir(spark, "run"), keys=("id",), timestamp="at", on_fail="warn"))
    assert sorted(r["id"] for r in done.gold.collect()) == sorted([*range(7), 6, *range(8, 24)])


def data_files(spark, root):
    """Paths of data files below a table's folder."""
    return {r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/data").select("path").collect()}


@pytest.mark.parametrize("kind", ["history", "upsert"])
def test_a_small_batch_writes_its_share_of_folders(spark, kind):
    rows = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("r"), F.lit("a").alias("v"))
    batch = rows.filter("k % 400 = 7").withColumn("v", F.lit("b"))  # ten keys
    if kind == "history":
        table = HistoryTable(spark, shared_dir(spark, "gold"), buckets=100)
        put = lambda df, at, label: apply_batch(table, df, ["k"], at, label=label)
    else:
        table = KeyedTable(spark, shared_dir(spark, "gold"), buckets=100)
        put = lambda df, at, label: upsert(table, df, ["k"], label=label)
    put(rows, T1, "one")
    before = data_files(spark, table.root)
    put(batch, T2, "two")
    written = data_files(spark, table.root) - before
    folders = {p.rsplit("/", 1)[0] for p in written if "_state=current" in p}
    assert 0 < len(folders) <= 10
    now = table.current()
    assert now.count() == 4000 and now.filter("v = 'b'").count() == 10
    if kind == "history":
        assert table.read().count() == 4010
    wider = batch.withColumn("k", F.col("k").cast("bigint"))  # the same keys in another type
    put(wider.withColumn("v", F.lit("c")), T3, "three")
    assert table.current().count() == 4000 and table.current().filter("v = 'c'").count() == 10


def test_a_narrow_upsert_keeps_what_it_lacks(spark):
    gold = spark.createDataFrame([(1, "a", "p"), (2, "b", None), (None, "n", "q")], "k int, v string, w string")
    batch = spark.createDataFrame([(1, "A"), (None, "N"), (3, "c")], "k int, v string")
    got = scd2.scd1_upsert(gold, batch, ["k"]).select("k", "v", "w")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "A", "p"), (2, "b", None), (None, "N", "q"), (3, "c", None)], key=repr)


def test_a_version_of_no_length_is_replaced(spark):
    gold = scd2.first_load(orders(spark, (1, 1, "a"), (2, 2, "b")), ["v"], T1)
    merged = scd2.scd2_merge(gold, orders(spark, (1, 1, "x")), ["k", "r"], ["v"], T1, expire_missing=True)
    assert state(merged) == [(1, 1, "x", T1, "None", True)]


def test_expired_counts_missing_keys_that_end(spark):
    gold = scd2.first_load(orders(spark, (1, 1, "a"), (2, 1, "b"), (3, 1, "c")), ["v"], T1)
    classified = scd2.classify(gold, orders(spark, (1, 1, "a"), (2, 1, "B")), ["k", "r"], ["v"], snapshot=True)
    assert scd2.merge_stats(classified, expire_missing=True).first()["expired"] == 2
    assert scd2.merge_stats(classified).first()["expired"] == 1


class Killed(Exception):
    pass


def test_a_part_stays_until_its_successor_is_whole(spark, monkeypatch):
    table = PartedTable(spark, shared_dir(spark, "parts"))
    table.add_part(spark.range(5), "a")
    table.add_part(spark.range(7), "b")
    monkeypatch.setattr(VersionLog, "publish", lambda *a, **k: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):  # all files are written, but not published
        table.add_part(spark.range(100), "a")
    monkeypatch.undo()
    failing = spark.range(100).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):  # killed half-way
        table.add_part(failing, "a")
    assert table.read().count() == 12
    table.add_part(spark.range(3), "a")
    assert table.read().count() == 10 and table.parts() == ["a", "b"]


def test_parts_with_other_types_and_columns(spark):
    table = PartedTable(spark, shared_dir(spark, "parts"))
    table.add_part(spark.sql("SELECT 1 AS v, 'x' AS a"), "one")
    table.add_part(spark.sql("SELECT 5000000000L AS v, date'2024-01-01' AS d"), "two")
    table.add_part(spark.sql("SELECT 0.5D AS v"), "three")
    assert table.read().schema["v"].dataType.simpleString() == "double"
    assert sorted(r["v"] for r in table.read().collect()) == [0.5, 1.0, 5e9]
    before = data_files(spark, table.root)
    with pytest.raises(Exception, match="column v|CAST|incompatible|INCOMPATIBLE"):
        table.add_part(spark.sql("SELECT 'text' AS v"), "four")
    assert data_files(spark, table.root) == before and table.read().count() == 3


def test_many_publications_leave_few_files_to_read(spark, monkeypatch):
    monkeypatch.setattr(versions, "SEGMENT", 6)
    log = VersionLog(spark, shared_dir(spark, "log"))
    log.publish("first", {"kept": "k", "gone": "g"})
    n = 15
    for i in range(2, n + 1):
        log.publish(f"label-{i}", {"last": str(i), **({"gone": None} if i == 5 else {})})
    assert log.state() == (n, f"label-{n}", {"kept": "k", "last": str(n)})
    assert log.has("first") and log.has(f"label-{n}") and not log.has("label-0")
    newest = folder_names(spark, log.path)[-1]
    assert len(folder_names(spark, f"{log.path}/{newest}")) <= 6


def test_a_run_that_fails_after_its_append_is_not_doubled(spark, monkeypatch):
    root = shared_dir(spark, "run")
    name = "a" + root.rsplit("-", 1)[-1]
    base = dict(root=root, timestamp="at", silver_table=name, table_mode="append", null_override="flag")
    everything = sales(spark, *[(i, 2.0, t) for i, t in enumerate(HOURS)])
    windows = [dict(window_end="2024-01-01 10:00:00", run_id="a"), dict(window_start="2024-01-01 10:00:00", run_id="b")]
    first = run(spark, everything, RunConfig(**windows[0], **base))
    from siltstone.sources import writers

    append = writers.append_run
    monkeypatch.setattr(writers, "append_run", lambda *a: (append(*a), (_ for _ in ()).throw(Killed())))
    with pytest.raises(Killed):
        run(spark, everything, RunConfig(**windows[1], **base), first.mapping)
    monkeypatch.undo()
    assert spark.table(name).count() == 24
    run(spark, everything, RunConfig(**windows[1], **base), first.mapping)
    assert spark.table(name).count() == 24
    with pytest.raises(ValueError, match="does not have"):
        writers.append_run(spark.range(1).toDF("other"), name, "c")


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "timestamp"])
def test_rows_beside_the_mark_come_once(spark, kind):
    """Null, NaN and blank marks come once, late rows with the mark's own value are not lost."""
    value = lambda n: {"bigint": n, "double": float(n), "string": f"2024-01-0{n}", "timestamp": dt.datetime(2024, 1, n)}[kind]
    odd = {"double": [(90, float("nan"))], "string": [(90, " ")]}.get(kind, [])
    frontier = incremental.Frontier(spark, shared_dir(spark, "marks"))
    loads = [
        ([(1, value(1)), (2, None), *odd], {1, 2, *[i for i, _ in odd]}),
        ([(3, value(2)), (4, value(2))], {3, 4}),
        ([(5, value(2)), (6, None), (7, value(1))], {5, 6}),  # 7 is past
        ([], set()),
        ([(8, value(3))], {8}),
    ]
    source = []
    for i, (rows, want) in enumerate(loads):
        source += rows
        new = frontier.unseen(spark.createDataFrame(source, f"id int, m {kind}"), "m")
        assert {r["id"] for r in new.collect()} == want, i
        frontier.advance(spark.createDataFrame(new.collect(), new.schema), "m", f"run-{i}")
        frontier.advance(new, "m", f"run-{i}")  # again: nothing happens
    assert frontier.mark().watermark.startswith(str(value(3))[:10])
    assert frontier.unseen(spark.createDataFrame(source, f"id int, m {kind}"), "m", keep_null=False).count() == 0

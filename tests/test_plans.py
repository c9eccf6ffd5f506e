"""Plans: what reaches the scan, what is shuffled, what runs in one task."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from siltstone.operators import anomaly, cdc, scd2
from siltstone.operators.incremental import date_window
from siltstone.operators.profile import column_profile, duplicate_stats
from siltstone.operators.quality import quality_checks
from siltstone.operators.silver import drop_copies
from siltstone.plans.inputs import snapshots, table
from siltstone.session import shared_dir

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables here")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_date_window_reaches_the_scan(spark):
    text = plan(date_window(table(spark, SF, "orders"), "o_orderdate", "1995-01-01", "1996-01-01").select("o_orderkey", "o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_profile_scans_once_and_shuffles_single_rows_only(spark):
    text = plan(column_profile(table(spark, SF, "lineitem"), distinct="approx"))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "hashpartitioning" not in text


def test_scorecard_of_distinct_rows_has_no_row_shuffle(spark):
    text = plan(quality_checks(table(spark, SF, "orders"), distinct_rows=True))
    assert "hashpartitioning" not in text


@pytest.mark.parametrize("build", [drop_copies, duplicate_stats])
def test_copies_collapse_before_the_shuffle(spark, build):
    text = plan(build(table(spark, SF, "documents").select("text")))
    assert text.index("HashAggregate") < text.index("Exchange") or text.count("HashAggregate") >= 2
    assert "partial" in text or "keys=[text" in text.replace("Keys [1]: [text", "keys=[text")


def test_diff_joins_once_per_side_without_another_exchange(spark):
    old, new = snapshots(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(cdc.snapshot_diff(old, new, "o_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n\n")[0]
    assert tree.count("Exchange") == 2
    assert "CartesianProduct" not in tree and "NestedLoop" not in tree


def test_history_merge_is_an_equi_join(spark):
    old, new = snapshots(spark, SF)
    gold = scd2.first_load(old, ["o_totalprice"], "2024-01-01")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(scd2.classify(gold, new, ["o_orderkey"], ["o_totalprice"], snapshot=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n\n")[0]
    assert "SortMergeJoin FullOuter" in tree and "NestedLoop" not in tree
    assert tree.count("Exchange") == 2


def test_a_small_batch_does_not_move_gold(spark):
    """Only the batch and its few matches are shuffled or broadcast."""
    old, new = snapshots(spark, SF)
    gold = scd2.first_load(old, ["o_totalprice"], "2024-01-01")
    path = shared_dir(spark, "gold")
    gold.write.parquet(path)
    gold = spark.read.parquet(path)
    for built in (scd2.classify(gold, new, ["o_orderkey"], ["o_totalprice"]), scd2.scd1_upsert(gold, new, ["o_orderkey"])):
        tree = plan(built).split("\n\n\n")[0]
        assert "BroadcastHashJoin LeftOuter" in tree or "BroadcastHashJoin LeftAnti" in tree
        assert "SortMergeJoin" not in tree and "NestedLoop" not in tree


def test_modes_collapse_before_the_shuffle(spark):
    text = plan(anomaly.modes(anomaly.value_counts(table(spark, SF, "orders"), ["o_orderstatus"])))
    assert "Window" not in text


def test_exact_profile_makes_no_copies_of_rows(spark):
    text = plan(column_profile(table(spark, SF, "lineitem")))
    assert "Expand" not in text


def test_examples_of_outliers_take_one_scan_whatever_the_columns(spark):
    lines = table(spark, SF, "lineitem")
    tests = [(c, F.col(c) > 2, F.abs(F.col(c))) for c in ("l_quantity", "l_extendedprice", "l_tax")]
    text = plan(anomaly.extremes(lines, tests)).split("\n\n\n")[0]
    assert text.count("Scan parquet") == 1 and "WindowGroupLimit" in text


def test_unchanged_rows_do_not_travel(spark):
    """Both large exchanges carry a key and a digest; rows are fetched from the scan for keys that differ."""
    old, new = snapshots(spark, SF)
    counts = cdc.diff_counts(cdc.snapshot_diff(old, new, "o_orderkey", images="changed"))
    text = plan(counts)
    shuffled = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning") or "Output" in line and "before" in line]
    assert shuffled
    for block in text.split("\n\n"):
        if re.search(r"\) Exchange", block):
            inputs = re.search(r"Input \[\d+\]: \[(.*)\]", block)
            assert not inputs or "o_totalprice" not in inputs[1]

import datetime as dt
import random
import warnings

import pytest
from pyspark.sql import functions as F

from siltstone.functions import missing
from siltstone.functions.masks import mask
from siltstone.functions.numeric import percent, to_number
from siltstone.operators import clean, pii
from siltstone.operators import silver as sv
from siltstone.operators.mapping import build_mapping
from siltstone.operators.order_stats import order_statistics
from siltstone.operators.ordered_fill import ordered_fill
from siltstone.operators.profile import column_profile, column_roles, duplicate_stats, timestamp_column, top_null_columns
from siltstone.plans.runlog import transform_log


def profiled(df):
    return column_profile(df).collect()


def test_rounding_is_half_even(spark):
    found = spark.range(1).select(percent(F.lit(13), F.lit(16), 1).alias("a"), percent(F.lit(1), F.lit(0)).alias("b")).first()
    assert tuple(found) == (81.2, 0.0)


def test_to_number(spark):
    texts = ["1", " 2.5 ", "-3e2", ".5", "1d", "NaN", "abc", "", None, "0x10"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(to_number(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [1.0, 2.5, -300.0, 0.5, None, None, None, None, None, None]


def test_missing_tokens_and_nan(spark):
    df = spark.createDataFrame([("NA", float("nan")), ("x", 1.0), ("None", None)], "a string, b double")
    assert [tuple(r) for r in missing.na_tokens_to_null(df).select("a").collect()] == [(None,), ("x",), (None,)]
    assert [r[0] for r in missing.nan_to_null(df).select("b").collect()] == [None, 1.0, None]
    gone = df.select(missing.is_missing(F.col("a"), df.schema["a"].dataType), missing.is_missing(F.col("b"), df.schema["b"].dataType))
    assert [tuple(r) for r in gone.collect()] == [(False, True), (False, False), (True, True)]


def test_profile_counts_nan_as_null_and_ignores_it_in_distinct(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 2.0), (None, 2.0)], "a bigint, b double")
    got = {r["column"]: (r["null_count"], r["null_pct"], r["cardinality"]) for r in profiled(df)}
    assert got == {"a": (1, 33.33, 1), "b": (1, 33.33, 1)}
    approx = {r["column"]: r["cardinality"] for r in column_profile(df, distinct="approx").collect()}
    assert approx == {"a": 1, "b": 1}


def test_empty_table_profile(spark):
    df = spark.createDataFrame([], "a bigint, b string")
    assert [(r["null_count"], r["null_pct"], r["cardinality"], r["total_rows"]) for r in profiled(df)] == [(0, 0.0, 0, 0)] * 2
    assert tuple(duplicate_stats(df).first()) == (0, 0, 0.0)
    assert top_null_columns(column_profile(df)).first()[0] == "None"


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, b string")
    assert tuple(duplicate_stats(df).first()) == (3, 1, 33.33)


def test_timestamp_column_passes(spark):
    assert timestamp_column(spark.createDataFrame([(1, "x")], "id int, Created_At string")) == "Created_At"
    typed = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, seen timestamp")
    assert timestamp_column(typed) == "seen"
    text = spark.createDataFrame([("abc", "2024-01-01"), ("d", "2024-01-02")], "a string, b string")
    assert timestamp_column(text) == "b"
    assert timestamp_column(spark.createDataFrame([("abc",)], "a string")) is None


def test_roles_of_numbers_and_text(spark):
    df = spark.createDataFrame([(1, 2.5e8, "7", "x", "2024")], "order_id int, big double, figure string, word string, ts string")
    got = {r["column"]: r["role"] for r in column_roles(df).collect()}
    assert got == {"order_id": "id", "big": "numeric_metric", "figure": "numeric_metric", "word": "categorical", "ts": "timestamp"}


def test_long_text_counts_by_digest(spark):
    long = "x" * 63
    df = spark.createDataFrame([(long + "a",), (long + "b",), (long + "a",), (long,), (None,), (None,)], "t string")
    assert tuple(duplicate_stats(df).first()) == (6, 2, 33.33)
    for scan in ("once", "per_column"):
        assert [(r["null_count"], r["cardinality"]) for r in column_profile(df, scan=scan).collect()] == [(2, 3)]


def test_strategies_by_hand(spark):
    df = spark.createDataFrame(
        [(1, None, "a", None, 1.0), (2, "x", None, 5.0, None), (3, "y", "b", 7.0, 3.0)],
        "k bigint, dropme string, txt string, num double, avg double",
    )
    mapping = build_mapping(
        df.schema, profiled(df), override={"dropme": "drop", "txt": "fill_unknown", "num": "fill_zero", "avg": "fill_mean"}
    )
    built = sv.build_silver(df, mapping)
    got = sorted(tuple(r) for r in built.df.collect())
    # The mean is taken after the drop: only row 3 has a value left.
    assert got == [(2, "x", "UNKNOWN", 5.0, 3.0), (3, "y", "b", 7.0, 3.0)]
    log = transform_log(built, 2)
    assert [(r[0], r[3], r[4]) for r in log] == [
        ("null_drop_dropme", 3, 2), ("null_fill_unknown_txt", 3, 2), ("null_fill_zero_num", 3, 2),
        ("null_fill_mean_avg", 3, 2), ("dedup_silver", 3, 2),
    ]
    assert log[0][5] == "Dropped 1 rows where dropme was null"


def test_mean_of_all_null_column_is_zero(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    assert sorted(tuple(r) for r in sv.fill_mean(df, ["v"]).collect()) == [(1, 0.0), (2, 0.0)]


def test_sentinels_and_medians(spark):
    df = spark.createDataFrame([(1, None, None), (2, 4.0, "x"), (3, 8.0, "y")], "k int, v double, t string")
    got = df.select(sv.fill_sentinel(df, "v"), sv.fill_sentinel(df, "t")).collect()
    assert tuple(got[0]) == (-1.0, "N/A")
    assert sv.medians(df, ["v", "k"]) == {"v": 6.0, "k": 2.0}
    assert sorted(r[0] for r in sv.fill_median(df.select("v"), ["v"]).collect()) == [4.0, 6.0, 8.0]
    with pytest.raises(ValueError):
        sv.fill_sentinel(df.withColumn("d", F.current_date()), "d")


def test_clamp_leaves_nulls_and_flags(spark):
    df = spark.createDataFrame([(-1.0, -2), (None, 3), (-0.0, 4), (2.0, -5)], "unit_price double, quantity int")
    out = sv.clamp_negatives(df, sv.clamp_candidates(df))
    assert [tuple(r) for r in out.collect()] == [(0.0, -2, 1), (None, 3, 0), (0.0, 4, 0), (2.0, -5, 0)]


def test_flag_columns_only_where_the_data_needs_them(spark):
    clean_rows = spark.createDataFrame([(1, 2.0)], "k int, cost double")
    mapping = build_mapping(clean_rows.schema, profiled(clean_rows))
    assert sv.build_silver(clean_rows, mapping).df.columns == ["k", "cost"]
    fixed = sv.build_silver(clean_rows, mapping, fixed_schema=True).df
    assert fixed.columns == ["k", "cost", "cost_had_negative"]


def test_rules_see_earlier_rules_and_bad_ones_are_left_out(spark):
    df = spark.createDataFrame([(2, 3)], "a int, b int")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        out, applied = sv.apply_rules(df, "c=a * b; d = c + 1 ;; x → y=1; bad=nope+1; e='p;q'; f=a ==")
    assert [n for n, _ in applied] == ["c", "d", "e"]
    assert tuple(out.first()) == (2, 3, 6, 7, "p;q")
    assert sum("rule left out" in str(w.message) for w in seen) == 2


def test_dedup_after_transforms_and_idempotent(spark):
    df = spark.createDataFrame([("a", -1.0), ("a", -2.0), (None, 5.0), (None, 5.0)], "t string, price double")
    once = sv.build_silver(df, build_mapping(df.schema, profiled(df), override="fill_unknown")).df
    assert sorted(tuple(r) for r in once.collect()) == [("UNKNOWN", 5.0, 0), ("a", 0.0, 1)]
    assert once.dropDuplicates().count() == once.count()


def sequential_fill(values):
    out, last = [], None
    for v in values:
        last = v if v is not None else last
        out.append(last)
    first = next((v for v in values if v is not None), None)
    return [first if v is None else v for v in out]


@pytest.mark.parametrize("gaps", [0.1, 0.6, 0.98])
def test_ordered_fill_equals_sequential(spark, gaps):
    rng = random.Random(gaps)
    values = [None if rng.random() < gaps else i for i in range(700)]
    rows = list(enumerate(values))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "pos int, id int").repartition(6)
    got = [r["id"] for r in ordered_fill(df, ["id"], ["pos"], blocks=5).orderBy("pos").collect()]
    assert got == sequential_fill(values)


def test_ordered_fill_keeps_copies_of_a_hot_position(spark):
    rows = [(0, None, "a"), (1, 7, "b")] + [(2, None, "c")] * 300 + [(3, 9, "d"), (None, None, "e")]
    df = spark.createDataFrame(rows, "pos int, id int, tag string")
    out = ordered_fill(df, ["id"], ["pos"], blocks=3)
    assert out.count() == len(rows)
    assert {(r["tag"], r["id"]) for r in out.collect()} == {("a", 7), ("b", 7), ("c", 7), ("d", 9), ("e", 7)}


def test_ordered_fill_drops_what_cannot_be_filled(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "pos int, id int")
    assert ordered_fill(df, ["id"], ["pos"], blocks=2).count() == 0
    assert ordered_fill(df, ["id"], ["pos"], blocks=2, drop_unfilled=False).count() == 2
    with pytest.raises(ValueError):
        ordered_fill(df, ["id"], [])


def test_ordered_fill_in_a_mapping(spark):
    rows = [(i, None if i % 5 == 0 else i, f"v{i}") for i in range(1, 41)]
    df = spark.createDataFrame(rows, "pos int, order_id bigint, v string")
    mapping = build_mapping(df.schema, profiled(df))
    assert mapping[1].strategy == "ffill_bfill_else_drop"
    built = sv.build_silver(df, mapping, order_by=["pos"])
    got = {r["pos"]: r["order_id"] for r in built.df.collect()}
    assert got[5] == 4 and got[6] == 6 and len(got) == 40
    log = transform_log(built, 40)
    assert log[0][5] == "Key column 'order_id': forward/backward filled 8 null(s). Rows dropped only when fill was not possible."


@pytest.mark.parametrize("max_distinct", [100_000, 5])
def test_order_statistics_equal_sorting(spark, max_distinct):
    rng = random.Random(1)
    values = [rng.choice([1.0, 2.0, rng.random() * 100, -rng.random()]) for _ in range(997)] + [3.0] * 500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    ranks = [0, 1, len(values) // 4, len(values) // 2, 3 * len(values) // 4, len(values) - 1]
    found = order_statistics(df, {"v": ranks}, max_distinct=max_distinct, accuracy=50)
    ordered = sorted(values)
    assert found == {("v", r): ordered[r] for r in ranks}


def test_masks(spark):
    df = spark.createDataFrame([("alexander",), ("bob",), (" ",), ("None",), (None,)], "c string")
    kind = df.schema["c"].dataType
    get = lambda *a, **k: [r[0] for r in df.select(mask(F.col("c"), kind, *a, **k)).collect()]
    assert get("partial") == ["al*****er", "****", " ", "None", None]
    assert get("redact")[:3] == ["[REDACTED]", "[REDACTED]", " "]
    assert get("sentinel", name="customer_email")[0] == "MASKED_CUSTOMER_E"
    short = get("sha256_short", salt="s")
    assert len(short[0]) == 16 and short[0] != get("sha256_short", salt="t")[0] and short[2:] == [" ", "None", None]
    with pytest.raises(ValueError, match="unknown masking"):
        get("rot13")


def test_masking_log_shows_no_values(spark):
    df = spark.createDataFrame([("a@b.c", 1), (None, 2)], "E_mail string, n int")
    log = pii.masking_log(df, ["e mail"], "redact").collect()
    assert [(r["column"], r["rows_masked"]) for r in log] == [("E_mail", 1)]
    assert "a@b.c" not in str(log)
    assert [r[0] for r in pii.mask_columns(df, ["e mail"], "redact").collect()] == ["[REDACTED]", None]


def test_standard_clean(spark):
    df = spark.createDataFrame(
        [(" a ", "2024-01-05", 1.0, 5), (" a ", "2024-01-05", 1.0, 5), ("b", "2024-02-06", None, 6)],
        "`First Name` string, When string, Val double, N bigint",
    )
    out, log = clean.standard_clean(df, narrow=True)
    assert out.columns == ["first_name", "when", "val", "n", "val_is_null"]
    assert dict(out.dtypes)["n"] == "int" and dict(out.dtypes)["when"] == "timestamp"
    assert out.count() == 2
    assert [s["code"] for s in log] == ["rename", "strip", "date", "copies", "null_flag"]
    assert log[3] == {"step": 4, "code": "copies", "columns": [], "rows_in": 3, "rows_out": 2}
    filled, _ = clean.standard_clean(df, "fill_median")
    assert sorted(r["val"] for r in filled.collect()) == [1.0, 1.0]
    dropped, log = clean.standard_clean(df, "drop")
    assert dropped.count() == 1 and (log[-1]["rows_in"], log[-1]["rows_out"]) == (2, 1)
    with pytest.raises(ValueError, match="share a name"):
        clean.normalise_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_date_text(spark):
    df = spark.createDataFrame([("2024-03-01",), ("2024/03/02",), ("03/04/2024",), ("soon",), (None,)], "d string")
    got = [r[0] and r[0].date().isoformat() for r in df.select(clean.date_text(F.col("d"))).collect()]
    assert got == ["2024-03-01", "2024-03-02", "2024-03-04", None, None]


def test_narrow_checks_both_ends(spark):
    df = spark.createDataFrame([(-(2**40), 1), (5, 2)], "a bigint, b bigint")
    assert dict(clean.narrow_integers(df).dtypes) == {"a": "bigint", "b": "int"}


def test_first_rows_that_mislead_decide_nothing(spark):
    # 150 dates and numbers come first, 850 words after them.
    df = spark.range(0, 1000, 1, 1).selectExpr("if(id < 150, '2024-01-05', concat('word', id)) AS a", "if(id < 150, '7', concat('w', id)) AS b")
    assert clean.date_text_columns(df) == [] and timestamp_column(df) is None
    assert {r["column"]: r["role"] for r in column_roles(df).collect()} == {"a": "text", "b": "text"}
    out, _ = clean.standard_clean(df)
    assert out.filter("a IS NULL").count() == 0
    mostly = spark.range(100).selectExpr("if(id % 10 = 0, concat('2024-99-0', id % 7, id), date_format(date_add(date'2024-01-01', int(id)), 'yyyy-MM-dd')) AS a")
    _, log = clean.standard_clean(mostly)
    date = next(s for s in log if s["code"] == "date")
    assert (date["columns"], date["parsed"], date["unreadable"]) == (["a"], 90, 10)


@pytest.mark.parametrize("max_distinct", [100_000, 5])
def test_order_statistics_of_infinite_values(spark, max_distinct):
    values = [float("-inf")] * 20 + [float(i) for i in range(60)] + [float("inf")] * 21
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranks = [0, 19, 20, 50, 79, 80, 100]
    found = order_statistics(df, {"v": ranks}, max_distinct=max_distinct, accuracy=50)
    assert found == {("v", r): values[r] for r in ranks}
    assert sv.medians(df, ["v"]) == {"v": values[50]}
    with pytest.raises(ValueError, match="narrows nothing"):
        order_statistics(df, {"v": [0]}, accuracy=4)
    assert order_statistics(df, {"v": [50]}, max_distinct=1, accuracy=10) == {("v", 50): values[50]}


def test_a_rule_that_raises_gives_null_in_its_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2, 'x'), (4, 0, '7'), (null, 3, null) t(a, b, s)")
    failures = []
    rules = "d=a / b; n=CAST(s AS INT); w=d + n; e=concat(s, ''); m=array(a, b); t=timestamp'2024-01-01 00:00:00.123456'; z=9223372036854775807L + a"
    out, applied = sv.apply_rules(df, rules, failures=failures)
    got = {r["b"]: r for r in out.collect()}
    assert [c for c, _ in applied] == ["d", "n", "w", "e", "m", "t", "z"] and got[0]["m"] == [4, 0]
    assert (got[2]["d"], got[0]["d"], got[3]["d"]) == (0.5, None, None)
    assert (got[2]["n"], got[0]["n"], got[2]["e"], got[3]["e"], got[0]["z"]) == (None, 7, "x", None, None)
    assert got[2]["t"].microsecond == 123456
    told = {c: [got[b][f] for b in (2, 0, 3)] for c, f in failures}
    assert told["d"] == [False, True, False] and told["n"] == [True, False, False] and told["z"] == [True, True, False]

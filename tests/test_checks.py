import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from siltstone.operators import anomaly, contracts, evolution, suite
from siltstone.operators.gold import build_gold
from siltstone.operators.layout import Layout, choose_layout, write_layout
from siltstone.operators.profile import record_schema
from siltstone.operators.quality import QualityGateError, gate, quality_checks, scorecard, split_ranges
from siltstone.session import shared_dir


def test_one_pass_equals_two(spark):
    df = spark.createDataFrame([(1, None), (1, None), (-2, "x"), (None, "y")], "n int, t string")
    weighted = quality_checks(df, ranges="n:0:,n::0").drop("check_no").collect()
    assert [(r["column"], r["value"], r["status"]) for r in weighted] == [
        ("n", 25.0, "FAIL"), ("t", 50.0, "FAIL"), ("_all_", 25.0, "FAIL"), ("n", 1.0, "FAIL"), ("n", 2.0, "FAIL"),
    ]
    distinct = df.dropDuplicates()
    a = [tuple(r) for r in quality_checks(distinct, ranges="n:0:").collect()]
    b = [tuple(r) for r in quality_checks(distinct, ranges="n:0:", distinct_rows=True).collect()]
    assert a == b


def test_checks_of_an_empty_table_pass(spark):
    df = spark.createDataFrame([], "n int")
    card = scorecard(quality_checks(df, ranges="n:0:1")).first()
    assert (card["dq_score_pct"], card["dq_status"], card["total_checks"]) == (100.0, "PASS", 4)


def test_no_checks_score_full(spark):
    empty = quality_checks(spark.createDataFrame([(1,)], "n int")).limit(0)
    assert scorecard(empty).first()["dq_score_pct"] == 100.0


def test_range_text():
    assert split_ranges("a:0:5, b::x ,bad, c:1:") == [("a", 0.0, 5.0), ("b", None, None), ("c", 1.0, None)]


def test_gate(spark):
    checks = quality_checks(spark.createDataFrame([(None,), (1,)], "n int"))
    card = scorecard(checks).first()
    with pytest.raises(QualityGateError, match="n: Null % ≤ 5.0% \\(value: 50.0\\)"):
        gate(card, checks=checks)
    gate(card, on_fail="warn")
    with pytest.raises(QualityGateError, match="below"):
        gate(card, on_fail="warn", min_score=90)
    with pytest.raises(ValueError):
        gate(card, on_fail="shout")


def test_suite_keeps_zero_and_false_as_values(spark):
    df = spark.createDataFrame([(0, False, "null"), (1, True, "x")], "n int, b boolean, t string")
    got = {r["check"]: (r["status"], r["value"]) for r in suite.suite_checks(df, baseline_rows=10).collect()}
    assert got["Null Rate — t"] == ("FAIL", 0.5)
    assert "Null Rate — n" not in got and "Null Rate — b" not in got
    assert got["Row-Level Completeness"][0] == "WARN"
    assert got["Volume vs Baseline"] == ("FAIL", 0.8)


def test_suite_of_an_empty_table(spark):
    got = {r["check"]: r["status"] for r in suite.suite_checks(spark.createDataFrame([], "n int")).collect()}
    assert got == {"Row-Level Completeness": "PASS", "Duplicate Rows": "PASS", "Schema — Column Count": "PASS", "Row Count": "FAIL"}


def test_suite_details(spark):
    df = spark.createDataFrame([(None, 1), (2, 1), (2, 1), (4, 1)], "a int, b int")
    details = [r["detail"] for r in suite.suite_checks(df, baseline_rows=5).orderBy("check_no").collect()]
    assert details == [
        "25.0% nulls (1 rows)", "Average completeness: 87.5%", "1 duplicates (25.0%)", "2 columns", "4 rows", "Drift: 20.0% (5 → 4)",
    ]


def test_summary_allows_two_warnings(spark):
    def overall(*statuses):
        return suite.suite_summary(spark.createDataFrame([(s,) for s in statuses], "status string")).first()["overall"]

    assert overall("PASS", "WARN", "WARN") == "PASS"
    assert overall("PASS", "WARN", "WARN", "WARN") == "WARN"
    assert overall("PASS", "FAIL") == "FAIL"


def test_volume_history_counts_from_three_runs(spark):
    counts = [100, 100, 100, 140, 40]
    runs = spark.createDataFrame([("d", i, n, 100) for i, n in enumerate(counts)], "dataset string, run int, rows bigint, baseline_rows bigint")
    got = [(r["status"], r["rolling_avg"]) for r in suite.volume_anomaly(runs).orderBy("run").collect()]
    assert got == [("PASS", None), ("PASS", None), ("PASS", None), ("WARN", 100), ("FAIL", 110)]


def test_contracts_from_names():
    schema = [
        Row(column="Email", dtype="string", null_rate=0.1), Row(column="created", dtype="string", null_rate=0.0),
        Row(column="star_rating", dtype="numeric", null_rate=0.5), Row(column="price", dtype="string", null_rate=0.2),
    ]
    got = [(c.column, c.rule_type, c.rule, c.severity) for c in contracts.build_contracts(schema)]
    assert got == [
        ("Email", "FORMAT", contracts.EMAIL, "WARN"),
        ("created", "NOT_NULL", "null_rate == 0", "FAIL"),
        ("created", "FORMAT", contracts.ISO_DATE, "WARN"),
        ("star_rating", "RANGE", "1 <= value <= 5", "FAIL"),
        # "rating" holds "rat", not "rate"; no score rule
    ]


def test_contract_results(spark):
    df = spark.createDataFrame([("a@b.co", 1), ("bad", 9), (None, None)], "email string, rating int")
    made = [
        contracts.Contract("email", "NOT_NULL", "null_rate == 0", "d", "FAIL"),
        contracts.Contract("email", "FORMAT", contracts.EMAIL, "d", "WARN"),
        contracts.Contract("rating", "RANGE", "1 <= value <= 5", "d", "WARN"),
        contracts.Contract("gone", "NOT_NULL", "null_rate == 0", "d", "FAIL"),
    ]
    got = [(r["status"], r["violations"], r["violation_rate_pct"], r["detail"]) for r in contracts.validate_contracts(df, made).orderBy("contract_no").collect()]
    assert got == [
        ("FAIL", 1, 33.33, "1 violations (33.33%)"), ("FAIL", 1, 50.0, "1 violations (50.0%)"),
        ("WARN", 1, 50.0, "1 violations (50.0%)"), ("FAIL", 3, 100.0, "3 violations (100.0%)"),
    ]
    assert contracts.validate_contracts(df, []).count() == 0
    with pytest.raises(ValueError):
        contracts.validate_contracts(df, [contracts.Contract("rating", "RANGE", "value > 7", "d", "WARN")])


def brute_anomalies(values):
    n, mean = len(values), sum(values) / len(values)
    std = (sum((v - mean) ** 2 for v in values) / n) ** 0.5
    z = [v for v in values if std and abs((v - mean) / std) > 3]
    s = sorted(values)
    q1, q3 = s[n // 4], s[3 * n // 4]
    out = [v for v in values if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)]
    found = []
    if z:
        found.append(("Z-Score", len(z), sorted(z, key=abs, reverse=True)[:3]))
    if out and len(out) != len(z):
        found.append(("IQR", len(out), sorted(out, key=lambda v: abs(v - mean), reverse=True)[:3]))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_numeric_anomalies_by_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    values = [round(rng.gauss(10, 2), 3) for _ in range(300)] + [round(rng.uniform(25, 60), 3) for _ in range(4 * seed)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [(r["method"], r["anomaly_count"], r["examples"]) for r in anomaly.numeric_anomalies(df, max_distinct=20).collect()]
    assert got == brute_anomalies(values)


def test_anomalies_need_ten_values_and_spread(spark):
    few = spark.createDataFrame([(float(i),) for i in range(9)], "v double")
    flat = spark.createDataFrame([(5.0,)] * 20, "v double")
    assert anomaly.numeric_anomalies(few).count() == 0
    assert anomaly.numeric_anomalies(flat).count() == 0
    assert anomaly.numeric_anomalies(spark.createDataFrame([("a",)], "t string")).count() == 0


def test_dominance_and_ties(spark):
    rows = [("a", "x")] * 9 + [("b", "y"), (" ", "y"), ("c", None)]
    df = spark.createDataFrame(rows, "t string, u string")
    got = anomaly.categorical_anomalies(df).collect()
    assert [(r["column"], r["dominant_value"], r["anomaly_count"], r["anomaly_rate_pct"]) for r in got] == [("t", "a", 9, 81.82)]
    tie = spark.createDataFrame([("b",), ("a",)], "t string")
    assert anomaly.modes(anomaly.value_counts(tie, ["t"])).first()["value"] == "a"


def test_schema_changes(spark):
    old = spark.createDataFrame([(1, "a", 1.0)], "id int, gone string, n double")
    new = spark.createDataFrame([("1", 1.0, True)], "id string, n double, more boolean")
    got = {r["column"]: (r["change"], r["severity"]) for r in evolution.schema_changes(evolution.schema_table(new), evolution.schema_table(old)).collect()}
    assert got == {"id": ("retyped", "FAIL"), "gone": ("removed", "FAIL"), "more": ("new", "WARN")}


@pytest.mark.parametrize(
    "old,new,breaking",
    [("numeric", "string", False), ("boolean", "string", False), ("integer", "float", False), ("integer", "numeric", False), ("string", "numeric", True), ("float", "integer", True)],
)
def test_safe_changes(spark, old, new, breaking):
    assert spark.range(1).select(evolution.is_breaking(old, new)).first()[0] is breaking


def test_baseline_round_trip(spark, tmp_path):
    schema = evolution.schema_table(spark.createDataFrame([(1, "a")], "id int, t string"))
    path = shared_dir(spark, "baseline")
    assert evolution.load_baseline(spark, path).count() == 0
    evolution.save_baseline(schema, path)
    status = evolution.evolution_status(evolution.schema_changes(schema, evolution.load_baseline(spark, path))).first()
    assert (status["status"], status["summary"]) == ("PASS", "0 columns came, 0 went, 0 have another type")
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "x.json").write_text("{not json")
    with pytest.raises(Exception):
        evolution.load_baseline(spark, str(broken)).collect()


def test_gold_choices(spark):
    df = spark.createDataFrame([("a", 1, None), (None, 2, 3.0), ("a", 3, None)], "k string, n int, v double")
    copy, note = build_gold(df, "none")
    assert copy.columns[-1] == "_record_count" and copy.count() == 3 and note.startswith("No aggregation")
    assert build_gold(df, "zzz")[1].startswith("Aggregation column(s) not found")
    assert build_gold(df.select("k"), "k")[1].startswith("No numeric columns")
    grouped, _ = build_gold(df, "k")
    assert [tuple(r) for r in grouped.collect()] == [("a", 4, 0.0, 2)]
    kept, _ = build_gold(df, "k", dropna=False, exclude=["n"])
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == [("a", 0.0, 2), (None, 3.0, 1)]


def column(name, dtype, n=None):
    return Row(column=name, dtype=dtype, n_unique=n)


def test_layout_rules():
    dated = [column("id", "numeric"), column("created", "string", 9999), column("kind", "string", 5)]
    assert choose_layout(dated, 2_000_000)[:3] == ("range", "created", "monthly")
    assert choose_layout(dated, 1_000_000)[:3] == ("range", "created", "daily")
    assert choose_layout(dated, 100_000)[:3] == ("list", "kind", "per_value")
    plain = [column("id", "numeric")]
    assert choose_layout(plain, 500_001)[:3] == ("hash", "id", "8_buckets")
    assert choose_layout(plain, 500_000)[:3] == ("none", None, "n/a")
    assert choose_layout(plain, 500_001).ddl_hint == "PARTITION BY HASH(id)"


@pytest.mark.parametrize("layout", [Layout("list", "k", "per_value", ""), Layout("hash", "n", "8_buckets", ""), Layout("none", None, "n/a", "")])
def test_layouts_keep_all_rows(spark, layout):
    df = spark.range(500).select(F.col("id").alias("n"), (F.col("id") % 3).cast("string").alias("k"))
    path = shared_dir(spark, "layout")
    write_layout(df, layout, path)
    assert spark.read.parquet(path).agg(F.count("n"), F.sum("n")).first() == df.agg(F.count("n"), F.sum("n")).first()


def test_record_schema(spark):
    df = spark.createDataFrame([("", 1), ("x", 1)], "t string, n int")
    assert [(r["dtype"], r["null_rate"], r["n_unique"]) for r in record_schema(df).collect()] == [("string", 0.5, 1), ("numeric", 0.0, 1)]


def test_layout_of_names_that_only_look_like_dates_and_of_bad_dates(spark):
    assert choose_layout([column("products", "string", 5), column("created", "numeric")], 200_000)[:2] == ("list", "products")
    assert choose_layout([column("id", "numeric")], 10**12).granularity == "50000_buckets"
    df = spark.createDataFrame([("2024-01-05",), ("soon",), (None,)], "day string")
    path = shared_dir(spark, "layout")
    write_layout(df, Layout("range", "day", "daily", ""), path)
    assert sorted(str(r["_part"]) for r in spark.read.parquet(path).collect()) == ["2024-01-05", "None", "None"]

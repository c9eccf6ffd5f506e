import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from siltstone.functions import names
from siltstone.functions.types import family
from siltstone.operators import mapping as mp


def test_pii_by_substring_keeps_the_recorded_choice():
    columns = ["transaction_id", "customer_email", "customer_phone", "product_name", "region", "status"]
    assert names.pii_columns(columns) == ["customer_email", "customer_phone", "product_name"]


def test_pii_by_token_and_lists():
    columns = ["company", "expander", "pan", "product_name", "notes"]
    assert names.pii_columns(columns, match="token") == ["pan", "product_name"]
    assert names.pii_columns(columns, allow=["product_name"], deny=["notes"]) == ["company", "expander", "pan", "notes"]
    assert names.pii_columns(["National Id", "Zip", "city"], names.RECORD_PII) == ["National Id", "Zip"]
    with pytest.raises(ValueError):
        names.pii_columns(columns, match="fuzzy")


def test_date_like():
    columns = ["order_date", "status", "created_at", "at_risk", "category", "time"]
    assert names.date_like_columns(columns) == ["order_date", "created_at", "time"]
    assert "status" in names.date_like_columns(columns, match="substring")


def test_names_match_but_for_case_and_blanks():
    assert names.match_columns(["E Mail", "phone", "lost"], ["e_mail", "phone"]) == ["e_mail", "phone"]
    assert names.normalise(" Unit Price(€) ") == "unit_price___"


def test_families():
    assert [family(t) for t in (T.LongType(), T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.MapType(T.StringType(), T.StringType()))] == [
        "numeric", "string", "datetime", "boolean", "other",
    ]


@pytest.mark.parametrize(
    "name,kind,null_pct,share,want",
    [
        ("order_id", T.LongType(), 0.0, 1.0, "none_needed"),
        ("order_id", T.LongType(), 1.0, 0.9, "ffill_bfill_else_drop"),
        ("order_id", T.LongType(), 1.0, 0.5, "fill_mean"),
        ("price", T.DoubleType(), 4.99, 0.0, "fill_mean"),
        ("price", T.DoubleType(), 5.0, 0.0, "fill_zero"),
        ("city", T.StringType(), 9.99, 0.0, "fill_unknown"),
        ("city", T.StringType(), 10.0, 0.0, "flag"),
        ("seen", T.TimestampType(), 1.0, 0.0, "flag"),
    ],
)
def test_null_strategy(name, kind, null_pct, share, want):
    assert mp.infer_null_strategy(name, kind, null_pct, share) == want


SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()), T.StructField("email", T.StringType()),
        T.StructField("price", T.DoubleType()), T.StructField("born", T.TimestampType()),
    ]
)
PROFILE = [
    Row(column="id", null_pct=0.0, cardinality=10, total_rows=10),
    Row(column="email", null_pct=20.0, cardinality=8, total_rows=10),
    Row(column="price", null_pct=20.0, cardinality=8, total_rows=10),
    Row(column="born", null_pct=10.0, cardinality=9, total_rows=10),
]


def test_mapping_precedence_and_keys():
    made = mp.build_mapping(SCHEMA, PROFILE, pii=["email"], keys=["id"], scd_type="2")
    assert [r.silver_transform for r in made] == ["pass_through", "SHA256_hash", "null_handle:fill_zero", "null_handle:flag"]
    assert [r.scd_type for r in made] == ["2", "n/a", "n/a", "n/a"]
    assert [r.gold_column for r in made] == ["id", "email", "price", "born"]
    renamed = mp.build_mapping(SCHEMA, PROFILE, pii=["email"], rename_masked=True)
    assert renamed[1].gold_column == "email_masked"


def test_override_is_checked():
    made = mp.build_mapping(SCHEMA, PROFILE, override="drop")
    assert [r.strategy for r in made] == [None, "drop", "drop", "drop"]
    made = mp.build_mapping(SCHEMA, PROFILE, override={"price": "sentinel"})
    assert made[2].strategy == "sentinel" and made[1].strategy == "flag"
    with pytest.raises(ValueError, match="unknown null strategy"):
        mp.build_mapping(SCHEMA, PROFILE, override="guess")


def test_ddl_and_target_schema():
    made = mp.build_mapping(SCHEMA, PROFILE, pii=["email"], keys=["id"])
    silver = mp.build_ddl(made, "sales")
    assert silver.startswith("CREATE TABLE sales_silver (\n    id BIGINT NOT NULL,\n    email VARCHAR(512) NULL,")
    gold = mp.build_ddl(made, "sales", "gold")
    assert "_is_current BOOLEAN NOT NULL DEFAULT TRUE" in gold and gold.endswith("\n);")
    schema = mp.target_schema(made, SCHEMA, "gold")
    assert not schema["id"].nullable and schema["email"].nullable
    assert [f.name for f in schema.fields][-5:] == ["_valid_from", "_valid_to", "_is_current", "_change_hash", "_last_updated"]

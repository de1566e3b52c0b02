"""Types, decimals and rows that do not convert."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.functions.decimals import decimal_problem, decimal_text, significant_digits, scale_of
from tidemark.functions.types import spark_schema, spark_type
from tidemark.operators import decimals, schema


@pytest.mark.parametrize(
    ("name", "size", "want"),
    [
        ("int", (), T.IntegerType()),
        ("BIGINT", (), T.LongType()),
        ("tinyint", (), T.ShortType()),
        ("bit", (), T.BooleanType()),
        ("money", (), T.DecimalType(19, 4)),
        ("smallmoney", (), T.DecimalType(10, 4)),
        ("decimal", (38, 18), T.DecimalType(38, 18)),
        ("numeric", (9, 0), T.DecimalType(9, 0)),
        ("float", (), T.DoubleType()),
        ("real", (), T.FloatType()),
        ("nvarchar", (), T.StringType()),
        ("datetime2", (), T.TimestampNTZType()),
        ("time", (), T.TimeType(6)),
        ("image", (), T.BinaryType()),
        ("uniqueidentifier", (), T.StringType()),
    ],
)
def test_type_map(name, size, want):
    assert spark_type(name, *size) == want


def test_type_map_errors():
    for bad in [("decimal",), ("decimal", 50, 2), ("decimal", 5, 6), ("xml",)]:
        with pytest.raises(ValueError):
            spark_type(*bad)
    assert spark_type("xml", strict=False) == T.StringType()
    assert spark_type("decimal", strict=False) == T.DecimalType(18, 0)


def test_schema_from_declaration():
    declared = spark_schema(
        {
            "ID": {"data_type": "int", "is_nullable": False},
            "Amount": {"data_type": "decimal", "precision": 18, "scale": 4},
        }
    )
    assert declared.simpleString() == "struct<ID:int,Amount:decimal(18,4)>"
    assert not declared["ID"].nullable


def test_precision_and_scale_are_two_issues(spark):
    declared = spark_schema({"Amount": {"data_type": "decimal", "precision": 18, "scale": 4}})
    stored = T.StructType([T.StructField("Amount", T.DecimalType(10, 2))])
    assert [i[1] for i in schema.schema_issues(declared, stored)] == ["precision", "scale"]
    assert schema.schema_issues(declared, declared) == []
    text = T.StructType([T.StructField("Amount", T.StringType())])
    assert [i[1] for i in schema.schema_issues(declared, text)] == ["not_decimal"]
    assert [i[1] for i in schema.schema_issues(declared, T.StructType([]))] == ["missing_column"]
    df = spark.createDataFrame([(1,)], "a int")
    assert [i[0] for i in schema.missing_columns(df, ["a", "b"])] == ["b"]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.decimals(allow_nan=False, allow_infinity=False, places=None, min_value=-10**9, max_value=10**9),
        min_size=1,
        max_size=30,
    )
)
def test_digits_and_scale_follow_the_written_form(spark, values):
    texts = [str(v) for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", significant_digits(F.col("t")), scale_of(F.col("t"))).collect()
    for text, digits, scale in got:
        _, want_digits, exponent = Decimal(text).as_tuple()
        shown = len("".join(map(str, want_digits)).lstrip("0")) or 1
        assert (digits, scale) == (shown, max(-exponent, 0)), text


def test_decimal_problems(spark):
    cases = {
        "123.45": None, "0.05": None, "-1.5": None, "1e2": None, None: None,
        "123456.78": "precision", "1.234": "scale", "abc": "not_a_number", "": "not_a_number",
        "1e-3": "scale", ".": "not_a_number",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert dict(rows(df.select("t", decimal_problem(F.col("t"), 6, 2)))) == cases


def test_format(spark):
    df = spark.createDataFrame([("123.45",), (None,), ("456.78",), ("789.1",), (" ",)], "t string")
    got = [r[0] for r in df.select(decimal_text(F.col("t"), 10, 2)).collect()]
    assert got == ["123.45", None, "456.78", "789.10", None]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_INVALID"):
        df.select(decimal_text(F.lit("123456789.5"), 10, 2)).collect()
    assert df.select(decimal_text(F.lit("123456789.5"), 10, 2, strict=False)).first()[0] is None


def test_long_decimals_keep_every_digit(spark):
    text = "12345678901234567890.123456789012345678"
    df = spark.createDataFrame([(text,)], "t string")
    kept = decimals.decimal_cast(df, {"t": (38, 18)})
    assert kept.first()[0] == Decimal(text)


def side(spark, *values):
    data = [(i, None if v is None else Decimal(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "id int, v decimal(18,2)")


def test_three_way_comparison(spark):
    source = side(spark, "123.45", None, "678.90", "123.45", "1.00")
    stored = side(spark, "123.45", None, "678.90", "123.46", "1.00")
    target = side(spark, "123.45", None, "678.90", "123.47", None)
    compared = decimals.decimal_compare_rows(source, stored, target, ["id"], "v")
    assert [r[1] for r in rows(compared, "id", "outcome")] == [
        "match", "all_null", "match", "mismatch", "null_mismatch",
    ]
    close = decimals.decimal_compare_rows(source, stored, target, ["id"], "v", tolerance="0.01")
    assert dict(rows(close, "id", "outcome"))[3] == "match"
    summary = decimals.decimal_compare(compared).first()
    assert (summary["n_match"], summary["n_all_null"], summary["match_rate"]) == (2, 1, 0.6)
    odd = decimals.decimal_compare_rows(source, stored.union(stored), target.limit(0), ["id"], "v")
    assert {r["outcome"] for r in odd.collect()} == {"missing"}
    twice = decimals.decimal_compare_rows(source, stored.union(stored), target, ["id"], "v")
    assert {r["outcome"] for r in twice.collect()} == {"duplicate"}


def test_statistics(spark):
    df = spark.createDataFrame(
        [(Decimal(v) if v else None,) for v in ("100.1", "200.2", None, "300.3")], "v decimal(18,4)"
    )
    found = decimals.decimal_stats(df, "v").first().asDict()
    assert found == {
        "column_name": "v", "row_count": 4, "null_count": 1, "non_null_count": 3,
        "min_value": "100.1000", "max_value": "300.3000", "precision": 18, "scale": 4,
        "sample_values": "100.1000, 200.2000, 300.3000",
    }
    with pytest.raises(ValueError):
        decimals.decimal_stats(spark.range(1), "id")


WANTED = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("amount", T.DecimalType(6, 2)),
        T.StructField("day", T.DateType()),
    ]
)


def test_quarantine(spark):
    df = spark.createDataFrame(
        [
            ("1", "1.50", "2024-01-01"),
            ("x", "1.50", "2024-01-01"),
            ("3", "1.505", "2024-13-01"),
            ("4", "99999.5", "2024-01-01"),
            (None, None, None),
            ("6", " ", None),
        ],
        "id string, amount string, day string",
    )
    good, bad = schema.quarantine(df, WANTED)
    assert good.schema.simpleString() == "struct<id:int,amount:decimal(6,2),day:date>"
    assert rows(good, "id", "amount") == [(1, Decimal("1.50")), (6, None)]
    assert rows(bad, "id", "problems") == [
        ("3", "amount,day"), ("4", "amount"), ("x", "id"), (None, "id"),
    ]
    assert good.count() + bad.count() == df.count()
    with pytest.raises(schema.TooManyErrors):
        schema.require_error_rate(df, WANTED, 0.5)
    schema.require_error_rate(df, WANTED, 0.7)

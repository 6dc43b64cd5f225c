"""Type normalization: mixed text, coercion, strategies, consistency."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import normalize as N


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [("1", 1.0, "a", 1.0), ("2", 2.0, "b", float("nan")), ("three", 3.0, "c", 3.0), ("4", 4.0, "d", None), ("five", 5.0, "e", 5.0)]
    return spark.createDataFrame(rows, "col_mixed string, col_numeric double, col_string string, col_with_nan double")


@pytest.fixture(scope="module")
def clean(spark):
    rows = [(25, 50000, "Sales", True), (30, 60000, "IT", False), (35, 70000, "HR", True), (40, 80000, "Sales", True), (45, 90000, "IT", False)]
    return spark.createDataFrame(rows, "age long, salary long, department string, active boolean")


def test_mixed_types(mixed, clean):
    found = {r["column"]: r["classes"] for r in N.detect_mixed_types(mixed).collect()}
    assert found == {"col_mixed": ["int", "str"]}
    assert N.detect_mixed_types(clean).count() == 0
    assert N.detect_mixed_types(clean.limit(0)).count() == 0


def test_categorical_text(mixed, clean):
    text = lambda df, c, na=None: [r[0] for r in df.select(N.categorical_column(F.col(c), df.schema[c].dataType, na)).collect()]
    assert text(clean, "active") == ["True", "False", "True", "True", "False"]
    assert text(clean, "age")[0] == "25"
    assert text(mixed, "col_with_nan") == ["1.0", None, "3.0", None, "5.0"]
    assert text(mixed, "col_with_nan", "missing")[1] == "missing"


@pytest.mark.parametrize("value,want", [
    ("1", 1.0), (" 12 ", 12.0), ("-3.5", -3.5), ("1e3", 1000.0), ("+.5", 0.5), ("1d", None), ("1f", None), ("", None), ("abc", None), ("1,5", None), ("1e10", 1e10), (None, None),
])
def test_number_coercion(spark, value, want):
    got = spark.createDataFrame([(value,)], "x string").select(S.parse_number(F.col("x"))).first()[0]
    assert got == want


def test_column_types(mixed, clean, spark):
    assert N.column_types(mixed) == (["col_mixed", "col_string"], ["col_numeric", "col_with_nan"])
    assert N.column_types(clean) == (["department", "active"], ["age", "salary"])
    empty = spark.createDataFrame([(None,)], "x string")
    assert N.column_types(empty) == ([], ["x"])


def test_normalize_frame(mixed, clean):
    shaped = N.normalize_frame(clean)
    assert dict(shaped.dtypes) == {"age": "bigint", "salary": "bigint", "department": "string", "active": "string"}
    kept = N.normalize_frame(clean, exclude=["active"])
    assert dict(kept.dtypes)["active"] == "boolean"
    forced = N.normalize_frame(mixed, categorical=["col_string"], numeric=["col_mixed"])
    assert [r[0] for r in forced.select("col_mixed").collect()] == [1.0, 2.0, None, 4.0, None]
    untouched = N.normalize_frame(clean, categorical=[], numeric=[])
    assert untouched.dtypes == clean.dtypes
    assert N.normalize_for_ml(clean, "active").dtypes[-1] == ("active", "boolean")


def test_numeric_strategies(mixed):
    got = lambda s: [r[0] for r in N.normalize_frame(mixed.select("col_with_nan"), strategy=s).collect()]
    assert got("keep") == [1.0, None, 3.0, None, 5.0]
    assert got("zero") == [1.0, 0.0, 3.0, 0.0, 5.0]
    assert got("mean") == [1.0, 3.0, 3.0, 3.0, 5.0]
    with pytest.raises(ValueError):
        N.fill_numeric(mixed, ["col_numeric"], "median")


def test_consistency(clean, spark):
    assert N.consistency_issues(clean, clean).count() == 0
    other = clean.drop("salary").withColumn("age", F.concat(F.lit("x"), F.col("age"))).withColumn("extra", F.lit(1))
    found = {(r["column"], r["issue"]) for r in N.consistency_issues(clean, other).collect()}
    assert found == {("salary", "missing_in_second"), ("extra", "missing_in_first"), ("age", "type_mismatch")}
    assert {r["issue"] for r in N.consistency_issues(clean, other, check_columns=False).collect()} == {"type_mismatch"}
    assert "type_mismatch" not in {r["issue"] for r in N.consistency_issues(clean, other, check_types=False).collect()}


def test_report(mixed):
    found = {r["column"]: r for r in N.normalization_report(mixed).collect()}
    assert found["col_mixed"]["was_mixed"] and found["col_mixed"]["n_lost"] == 0
    assert not found["col_numeric"]["type_changed"]


def test_magnitudes_and_signs(spark):
    df = spark.createDataFrame([("1e10", "-5"), ("2e10", "7"), (None, "-0.5")], "big string, signed string")
    got = N.normalize_frame(df).collect()
    assert [r["big"] for r in got] == [1e10, 2e10, None] and [r["signed"] for r in got] == [-5.0, 7.0, -0.5]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (9.0,), (None,)], "x double")
    assert [r[0] for r in df.select(S.clip(F.col("x"), 0.0, 0.95)).collect()] == [0.0, 0.5, 0.95, None]

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import distribution, missing
from tidemark.spec import GateRule


def test_missingness_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(missing.missingness(df)) == [("a", 0, 0.0), ("b", 0, 0.0)]
    assert rows(missing.mean_missingness(df)) == [(2, 0.0)]


def test_worst_first_then_column_order(spark):
    df = spark.createDataFrame([(1, None, None), (None, 2, None)], "b int, a int, c int")
    assert [r["column"] for r in missing.missingness(df).collect()] == ["c", "b", "a"]


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` int")
    assert rows(missing.missingness(df)) == [("a.b", 0, 0.0), ("c d", 1, 100.0)]
    assert rows(distribution.value_counts(df, ["a.b", "c d"])) == [("a.b", "1", 1)]


def test_an_empty_gate_means_the_question_does_not_apply(spark):
    df = spark.createDataFrame(
        [(None, "Yes"), (None, "No"), (None, None), (1, "Yes"), (1, None)], "d int, g string"
    )
    split = missing.gate_split(df, [GateRule("d", "g", "Yes")])
    assert rows(split) == [("d", "g", 3, 2, 1, 66.67)]
    assert missing.mostly_incidental(split).count() == 1
    full = missing.gate_split(df.filter("d = 1"), [GateRule("d", "g", "Yes")])
    assert rows(full) == [("d", "g", 0, 0, 0, 0.0)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.integers(0, 3), st.none() | st.sampled_from("YN")), max_size=20))
def test_structural_and_incidental_add_up(spark, data):
    df = spark.createDataFrame(data, "d int, g string")
    row = missing.gate_split(df, [GateRule("d", "g", "Y")]).first()
    assert row["n_structural"] + row["n_incidental"] == row["n_missing"]
    assert row["n_missing"] == sum(d is None for d, _ in data)


def test_frequency_of_nothing_is_empty(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert distribution.frequency_table(df, "v").count() == 0
    assert rows(distribution.valid_and_missing(df, ["v"])) == [("v", 0, 1)]


def test_codes_without_a_label_show_themselves(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    got = distribution.frequency_table(df, "v", {"1": "one"})
    assert [tuple(r) for r in got.collect()] == [("1", "one", 2, 66.67), ("2", "2", 1, 33.33)]


def test_bins_are_right_open_and_empty_ones_stay(spark):
    df = spark.createDataFrame([(-1,), (0,), (14,), (15,), (150,), (None,)], "age tinyint".replace("tiny", ""))
    bins = [("0-14", 0, 15), ("15-24", 15, 25), ("25+", 25, 150)]
    got = distribution.binned_distribution(df, "age", bins).orderBy("bin").collect()
    assert [(r["label"], r["count"], r["n_missing"]) for r in got] == [
        ("0-14", 2, 3),
        ("15-24", 1, 3),
        ("25+", 0, 3),
    ]


def test_casing_variants_are_caught(spark):
    df = spark.createDataFrame(
        [("Male", "A", None), ("male ", "B", None), ("Male", "A", None)], "s string, t string, u string"
    )
    assert rows(distribution.casing_consistency(df, ["s", "t", "u"])) == [
        ("s", False),
        ("t", True),
        ("u", True),
    ]


def test_value_sets_by_type(spark):
    data = [(i, f"v{i % 3}", f"w{i}", None, i / 2, i % 2 == 0, 2.5e9) for i in range(12)]
    df = spark.createDataFrame(
        data, "n int, few string, many string, none string, x double, b boolean, big double"
    )
    df = df.withColumn("cat", F.col("many").alias("cat", metadata={"kind": "category"}))
    assert dict(rows(distribution.value_sets(df))) == {
        "n": "0–11",
        "few": "v0; v1; v2",
        "many": "free text (12 distinct values)",
        "none": "",
        "x": "0.0–5.5",
        "b": "False–True",
        "big": "2500000000.0–2500000000.0",
        "cat": "12 distinct values",
    }


def test_dominant_category_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert rows(distribution.dominant_category(df, "v")) == [("a", 2, 50.0, 1)]
    empty = distribution.dominant_category(df.filter("v is null"), "v")
    assert rows(empty) == [(None, None, 0.0, 1)]


@pytest.mark.parametrize("values,is_key", [([1, 2, 3], True), ([1, 1, 2], False)])
def test_pseudo_keys(spark, values, is_key):
    df = spark.createDataFrame([(v,) for v in values], "id int")
    assert rows(distribution.pseudo_key_check(df, ["id"], ), "n_rows", "is_key") == [(3, is_key)]

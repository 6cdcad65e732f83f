import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import typing as types
from tidemark.sources import tables


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(
        [
            ("sex", "Sex", "byte", "Sex"),
            ("age", "Age", "byte", "  "),
            ("total", "Total", "int", None),
            ("money", "Money", "long", None),
            ("weight", "Weight", "double", None),
            ("job", "Job title", "str51", None),
            ("region", "Region", "str2", None),
            ("odd", "Odd", "complex", None),
        ],
        "column string, description string, type string, choices string",
    )


def test_recommended_types(dictionary):
    got = {r["column"]: (r["recommended_type"], r["kind"]) for r in types.recommend_types(dictionary).collect()}
    assert got == {
        "sex": ("string", "category"),
        "age": ("tinyint", "number"),
        "total": ("int", "number"),
        "money": ("bigint", "number"),
        "weight": ("double", "number"),
        "job": ("string", "free_text"),
        "region": ("string", "code"),
        "odd": ("string", "unknown"),
    }


@pytest.mark.parametrize(
    "text,expected",
    [
        ("5", 5), (" 5 ", 5), ("+5", 5), ("-1", -1), ("5.0", 5), ("1e2", 100), ("5.5", None),
        ("300", None), ("abc", None), ("5d", None), ("0x5", None), ("", None), ("NaN", None), ("Infinity", None),
    ],
)
def test_small_whole_numbers(spark, text, expected):
    plan = [types.ColumnType("v", "tinyint", "number")]
    df = spark.createDataFrame([(text,)], "v string")
    assert rows(types.apply_types(df, plan)) == [(expected,)]


def test_large_integers_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("9223372036854775808",), ("1e300",)], "v string")
    plan = [types.ColumnType("v", "bigint", "number")]
    assert rows(types.apply_types(df, plan)) == [(9007199254740993,), (None,), (None,)]


def test_coercion_losses_are_told_apart_from_gaps(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("x", None), ("2.5", "c")], "n string, t string")
    plan = [types.ColumnType("n", "int", "number"), types.ColumnType("t", "string", "code")]
    report = types.coercion_report(df, plan)
    assert rows(report) == [("n", "int", 1, 2), ("t", "string", 1, 0)]
    assert rows(types.coercion_summary(report)) == [(2, 1, 2)]


def test_contract_lists_both_differences(dictionary):
    with pytest.raises(ValueError, match="not in data: \\['odd'\\].*not in dictionary: \\['new'\\]"):
        names = [r["column"] for r in dictionary.collect() if r["column"] != "odd"]
        types.check_contract("t", [*names, "new"], dictionary)
    types.check_contract("t", [r["column"] for r in dictionary.collect()], dictionary)


def test_count_mismatch_fails(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "hh int")
    assert rows(types.count_check(df, "hh", 4, 2), "measure", "observed", "ok") == [
        ("entities", 2, True),
        ("rows", 4, True),
    ]
    types.require_counts("t", types.count_check(df, "hh", None, None))
    with pytest.raises(ValueError, match="rows: 4 instead of 5"):
        types.require_counts("t", types.count_check(df, "hh", 5, 2))


def test_dictionary_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "dictionary.csv"
    path.write_text(
        'column,description,type,choices\nq1,"Did ""you"", or\nsomeone else, go?",byte,yesno\nq2,Age,byte,\n'
    )
    assert rows(tables.read_dictionary(spark, str(path))) == [
        ("q1", 'Did "you", or\nsomeone else, go?', "byte", "yesno"),
        ("q2", "Age", "byte", None),
    ]


def test_na_tokens_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("a,b\n01,NA\n,null\nn/a, x\nNAN,None\n")
    got = tables.read_text_csv(spark, str(path))
    assert rows(got) == [("01", None), ("NAN", None), (None, " x"), (None, None)]
    checked = tables.read_text_csv(spark, str(path), ["a", "b"])
    assert rows(checked) == rows(got)


def test_round_trip_notices_a_difference(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, True), (2, False)], "x int, x_imputed boolean")
    result = tables.export_table(df, {"x": "The x"}, str(tmp_path / "a")).first()
    assert (result["n_rows"], result["same_content"], result["n_labelled"]) == (2, True, 1)
    back = spark.read.parquet(str(tmp_path / "a"))
    assert back.schema["x"].metadata["label"] == "The x"
    assert back.schema["x_imputed"].metadata["value_labels"] == {"0": "Not imputed", "1": "Imputed"}

    keep = tables.write_layer
    monkeypatch.setattr(tables, "write_layer", lambda d, p: keep(d, p).filter("x = 1"))
    with pytest.raises(ValueError, match="does not read back"):
        tables.export_table(df, {}, str(tmp_path / "b"))


def test_fingerprint_ignores_order_but_not_content(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    other = spark.createDataFrame([(2, "a"), (1, "b")], "k int, v string")
    assert rows(tables.fingerprint(one)) == rows(tables.fingerprint(two))
    assert rows(tables.fingerprint(one)) != rows(tables.fingerprint(other))


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return "/shared/folder" if key == "spark.checkpoint.dir" else default

    class Cluster:
        conf = Conf

        class sparkContext:
            master = "yarn"
            applicationId = "app"

    assert session.scratch_dir(Cluster) == "/shared/folder/app"
    # without one the warehouse, which executors share as well
    shared = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}
    monkeypatch.setattr(Conf, "get", staticmethod(lambda key, default=None: shared.get(key, default)))
    assert session.scratch_dir(Cluster) == "hdfs://store/warehouse/scratch/app"


def test_materialized_tables_keep_metadata(spark):
    df = spark.range(3).select(F.col("id").alias("id", metadata={"kind": "code"}))
    back = session.materialize(df, "t")
    assert back.schema["id"].metadata == {"kind": "code"} and back.count() == 3

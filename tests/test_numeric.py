import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import impute, numeric, sketches
from tidemark.spec import ImputeRule

DRAW = np.random.default_rng(4)
COLUMNS = {
    "uniform": DRAW.uniform(-5, 5, 3000),
    "whole": DRAW.integers(0, 9, 3000).astype(float),
    "heavy": np.exp(DRAW.normal(0, 12, 3000)),
    "mostly_one": np.where(DRAW.uniform(size=3000) < 0.9, 7.0, DRAW.uniform(0, 100, 3000)),
    "constant": np.full(3000, 2.5),
}


@pytest.fixture(scope="module")
def numbers(spark):
    names = list(COLUMNS)
    data = list(zip(*[COLUMNS[c].tolist() for c in names]))
    data += [(None,) * len(names)] * 10 + [(float("nan"),) * len(names)] * 5
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in names)).repartition(5).cache()


@pytest.mark.parametrize("limits", [{}, {"accuracy": 200}, {"accuracy": 50, "finish_values": 0}])
def test_quantiles_are_exact(numbers, limits):
    asked = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = numeric.exact_quantiles(numbers, {c: asked for c in COLUMNS}, **limits)
    for column, values in COLUMNS.items():
        assert got[column][0] == len(values)
        np.testing.assert_allclose(got[column][1], np.quantile(values, asked), rtol=1e-12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30), st.floats(0, 1))
def test_any_quantile_of_any_list(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = numeric.exact_quantiles(df, {"x": [p]}, accuracy=20)["x"][1][0]
    assert got == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_infinity_is_a_value(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf] * 30 + [1.0, 2.0, 3.0] + [inf] * 40 + [1e308, -1e308]], "x double")
    got = numeric.exact_quantiles(df, {"x": [0.0, 0.2, 0.42, 0.5, 1.0]}, accuracy=20)["x"]
    values = sorted([-inf] * 30 + [1.0, 2.0, 3.0] + [inf] * 40 + [1e308, -1e308])
    assert got[0] == 75 and got[1][0] == -inf and got[1][3] == values[37] and got[1][4] == inf
    assert not any(np.isnan(v) for v in got[1])


def test_large_whole_numbers_keep_every_digit(spark):
    start = 2**53 + 1
    values = [start + 2 * i for i in range(5001)] + [-(2**63), 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(4)
    ranked = sorted(values)
    got = numeric.exact_quantiles(df, {"x": [0.0, 0.5, 1.0]}, accuracy=100)["x"]
    assert got == (5003, [ranked[0], ranked[2501], ranked[-1]])
    assert numeric.column_extent(df.filter("x > 0 AND x < 10000000000000000"), ["x"])["x"] == (5001, start, start + 10000)


def test_wide_ranges_take_a_fixed_number_of_scans(spark, monkeypatch):
    values = np.exp(np.linspace(0, 690, 30_000))
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    scans = {"n": 0}
    for owner, name in ((sketches, "column_sketches"), (numeric, "_values_inside")):
        original = getattr(owner, name)

        def counted(*args, original=original):
            scans["n"] += 1
            return original(*args)

        monkeypatch.setattr(owner, name, counted)
    got = numeric.exact_quantiles(df, {"x": [0.1, 0.5, 0.9]}, finish_values=0)["x"][1]
    np.testing.assert_allclose(got, np.quantile(values, [0.1, 0.5, 0.9]), rtol=1e-9)
    assert scans["n"] <= 2


def test_column_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert numeric.exact_quantiles(df, {"x": [0.5]}) == {"x": (0, None)}
    assert rows(numeric.numeric_summary(df, ["x"])) == [("x", 0, None, None, None, None)]
    assert {r["count"] for r in numeric.histogram(df, "x", 4).collect()} == {0}


@pytest.mark.parametrize("column", ["uniform", "whole", "mostly_one", "constant"])
@pytest.mark.parametrize("bins", [1, 20, 30])
def test_histogram_equals_numpy(numbers, column, bins):
    counts, edges = np.histogram(COLUMNS[column], bins=bins)
    got = numeric.histogram(numbers, column, bins).orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["lower"] for r in got], edges[:-1], rtol=1e-12)
    np.testing.assert_allclose([r["upper"] for r in got], edges[1:], rtol=1e-12)


def test_imputed_values_outside_the_observed_edges_are_not_counted(spark):
    df = spark.createDataFrame(
        [(0.0, False), (10.0, False), (None, False), (5.0, True), (11.0, True), (10.0, True)],
        "x double, x_imputed boolean",
    )
    got = numeric.observed_vs_imputed(df, "x", "x_imputed", 5).orderBy("bin").collect()
    assert [r["n_observed"] for r in got] == [1, 0, 0, 0, 1]
    assert [r["n_imputed"] for r in got] == [0, 0, 1, 0, 1]


# -------------------------------------------------------------------------- imputation


def test_median_over_all_values_fills_only_the_population(spark):
    df = spark.createDataFrame(
        [(1, 2, "Yes"), (2, 3, "Yes"), (3, None, "Yes"), (4, None, "No"), (5, None, None)],
        "id int, x tinyint, asked string",
    )
    filled, value = impute.impute_median(df, "x", "asked = 'Yes'")
    assert value == 2  # 2.5 rounds half-even
    assert dict(filled.dtypes)["x"] == "tinyint"
    assert rows(filled, "id", "x", "x_imputed") == [
        (1, 2, False),
        (2, 3, False),
        (3, 2, True),
        (4, None, False),
        (5, None, False),
    ]


def test_nothing_to_learn_from_fills_nothing(spark):
    df = spark.createDataFrame([(None,)], "x int")
    filled, value = impute.impute_median(df, "x")
    assert value is None and rows(filled) == [(None, False)]


def test_median_within_the_population(spark):
    df = spark.createDataFrame([(1, 10, 1), (2, None, 1), (3, 90, 0), (4, 90, 0)], "id int, x int, p int")
    rule = ImputeRule("x", "p = 1", "p")
    assert impute.fit_medians(df, [rule])[0].value == 90
    assert impute.fit_medians(df, [rule], within_population=True)[0].value == 10


def test_flags_tell_what_was_filled(spark):
    df = spark.createDataFrame([(1, None), (None, 5), (3, None)], "x int, y int")
    fills = impute.fit_medians(df, [ImputeRule("x"), ImputeRule("y", "x IS NOT NULL", "has x")])
    done = impute.impute(df, fills)
    assert rows(impute.imputation_ledger(done, fills)) == [
        ("x", "Median", 1, 2, "Everyone"),
        ("y", "Median", 2, 5, "has x"),
    ]

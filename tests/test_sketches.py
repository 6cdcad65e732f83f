import numpy as np
import pytest
from conftest import rows

from tidemark.operators import impute, numeric, rules, sketches
from tidemark.spec import ImputeRule, OutlierRule

DRAW = np.random.default_rng(11)


def table(spark, n, seed, parts=3):
    draw = np.random.default_rng(seed)
    data = [(float(a), int(b), None) for a, b in zip(draw.normal(0, 1e6, n), draw.integers(-(2**62), 2**62, n))]
    data += [(None, None, None), (float("nan"), 5, None), (float("inf"), 5, None)]
    return spark.createDataFrame(data, "r double, `w w` long, e int").repartition(parts)


def stored(tmp_path):
    return str(tmp_path / "sketches")


def test_batches_add_up(spark, tmp_path):
    first, second = table(spark, 4000, 1), table(spark, 2500, 2)
    columns = ["r", "w w", "e"]
    sketches.write_sketches(first, columns, stored(tmp_path))
    kept = sketches.write_sketches(second, columns, stored(tmp_path))
    both = first.union(second)
    once = {r["column"]: r for r in sketches.column_sketches(both, columns).collect()}
    for r in kept.collect():
        exact = once[r["column"]]
        for name in ("whole", "n", "low_whole", "high_whole", "low_real", "high_real"):
            assert r[name] == exact[name]
    asked = {c: [0.0, 0.05, 0.5, 0.77, 1.0] for c in columns}
    assert numeric.exact_quantiles(both, asked, kept) == numeric.exact_quantiles(both, asked)
    pairs = zip(rows(numeric.numeric_summary(both, columns, kept)), rows(numeric.numeric_summary(both, columns)))
    for got, wanted in pairs:
        # sums of doubles depend on the order
        assert got[2] == (wanted[2] if wanted[2] is None else pytest.approx(wanted[2], rel=1e-12))
        assert got[:2] + got[3:] == wanted[:2] + wanted[3:]


@pytest.mark.parametrize("accuracy", [8, 64, 8192])
def test_results_do_not_depend_on_the_sketch(spark, tmp_path, accuracy):
    values = np.concatenate([DRAW.uniform(0, 1, 9000), np.full(4000, 0.5), np.exp(DRAW.normal(0, 50, 3000))])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    kept = sketches.write_sketches(df, ["x"], stored(tmp_path), accuracy)
    asked = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = numeric.exact_quantiles(df, {"x": asked}, kept, finish_values=0)["x"]
    assert got[0] == len(values)
    np.testing.assert_allclose(got[1], np.quantile(values, asked), rtol=1e-12)


def test_kept_sketches_save_a_scan(spark, tmp_path, monkeypatch):
    df = table(spark, 3000, 3)
    kept = sketches.write_sketches(df, ["r", "w w"], stored(tmp_path))
    scans = []
    original = numeric._values_inside
    monkeypatch.setattr(numeric, "_values_inside", lambda *a: scans.append("values") or original(*a))
    monkeypatch.setattr(sketches, "column_sketches", lambda *a: scans.append("sketches"))
    numeric.exact_quantiles(df, {"r": [0.5], "w w": [0.1]}, kept)
    assert scans == ["values"]


def test_sketches_of_other_rows_raise(spark, tmp_path):
    df = table(spark, 500, 4)
    kept = sketches.write_sketches(df, ["r"], stored(tmp_path))
    with pytest.raises(ValueError, match="not of these rows"):
        numeric.exact_quantiles(df.union(table(spark, 10, 5)), {"r": [0.5]}, kept)
    with pytest.raises(ValueError, match="no stored sketch"):
        numeric.exact_quantiles(df, {"w w": [0.5]}, kept)
    with pytest.raises(ValueError, match="another kind"):
        numeric.exact_quantiles(df.withColumn("r", df["w w"]), {"r": [0.5]}, kept)
    with pytest.raises(ValueError, match="between"):
        sketches.column_sketches(df, ["r"], 4)


def test_empty_batches(spark, tmp_path):
    df = table(spark, 300, 6)
    empty = df.limit(0)
    sketches.write_sketches(empty, ["r", "e"], stored(tmp_path))
    kept = sketches.write_sketches(df, ["r", "e"], stored(tmp_path))
    assert numeric.exact_quantiles(df, {"r": [0.5], "e": [0.5]}, kept) == numeric.exact_quantiles(
        df, {"r": [0.5], "e": [0.5]}
    )
    assert numeric.exact_quantiles(empty, {"r": [0.5]}) == {"r": (0, None)}


def test_medians_and_fences_use_kept_sketches(spark, tmp_path):
    df = table(spark, 1200, 7)
    kept = sketches.write_sketches(df, ["r", "w w"], stored(tmp_path))
    wanted = [ImputeRule("r", None), ImputeRule("w w", None)]
    plain = df.filter("r < 1e300 OR r IS NULL")
    assert impute.fit_medians(df, wanted, sketches=kept) == impute.fit_medians(df, wanted)
    kept = sketches.write_sketches(plain, ["r", "w w"], str(tmp_path / "plain"))
    rule = OutlierRule(("r", "w w"), min_valid=10)
    assert rules.outlier_fences(plain, rule, kept) == rules.outlier_fences(plain, rule)

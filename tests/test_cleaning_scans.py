"""What the cleaning plan reads row by row: no filters of arrays, no lookups that the answer does not need."""

from tidemark.operators import dedup, numeric
from tidemark.plans.clean import clean
from tidemark.plans.diagnose import diagnose
from tidemark.session import materialize
from tidemark.spec import DatasetSpec


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_brackets_are_read_without_a_filter_of_arrays(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(numeric, "materialize", lambda df, label: (plans.append(optimized(df)), materialize(df, label))[1])
    df = spark.range(5000).selectExpr("id", "id * 0.5 AS half", "CASE WHEN id % 7 > 0 THEN id END AS gaps")
    found = numeric.exact_quantiles(df, {"id": [0.25, 0.75], "half": [0.5], "gaps": [0.5]})
    assert found["id"][1] == [1249.75, 3749.25] and found["half"][1] == [1249.75]
    assert found["gaps"] == (4285, [2500])
    assert plans and not any("lambda" in plan for plan in plans)


def test_texts_are_read_without_the_reviewed_values_of_other_columns(spark):
    rows = [(i, "O" if i % 2 else "F", name) for i, name in enumerate(["BARBER", "BARBER", "BARBERS", None, "COOK"])]
    df = spark.createDataFrame(rows, "id int, status string, job string")
    spec = DatasetSpec("people", keys=("id",), free_text=("job",), value_map=(("status", "O", "Open"),))
    result = clean(df, spec)
    assert "Join" not in optimized(result._with_free_text) and "Join" in optimized(result._mapped)
    own = clean(df, DatasetSpec("people", keys=("id",), free_text=("job",), value_map=(("job", "COOK", "Cook"),)))
    assert "Cook" in {r.job for r in own._with_free_text.collect()}


def test_repeated_keys_of_the_diagnosis_are_not_counted_again(spark, monkeypatch):
    written = []
    monkeypatch.setattr(dedup, "materialize", lambda df, label: (written.append(label), materialize(df, label))[1])
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "d"), (None, "c"), (2, "e")], "id int, v string")
    spec = DatasetSpec("people", keys=("id",))
    found = diagnose(df, spec)
    for limit in (0, 10):
        kept = dedup.keep_first(df, ["id"], broadcast_rows=limit, repeated=found.repeated)
        assert sorted((str(r.id), r.v) for r in kept.collect()) == [("1", "a"), ("2", "e"), ("None", "c")]
    assert clean(df, spec, repeated=found.repeated).table.count() == 3
    assert written == ["repeated-keys"]

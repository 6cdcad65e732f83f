import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.columns import number_text, strip, whole_number_text
from tidemark.operators import dedup, document, lookup, rules
from tidemark.plans import clean as plan
from tidemark.spec import (
    ClassifyRule,
    ConsistencyRule,
    DatasetSpec,
    DerivedTotal,
    MissingRule,
    OutlierRule,
    RangeRule,
    SentinelRule,
    SkipRule,
)


def test_bounds_are_valid_and_null_is_not_out_of_range(spark):
    df = spark.createDataFrame([(1, -1), (2, 0), (3, 115), (4, 116), (5, None)], "id int, age int")
    both = [RangeRule("age", 0, 115), RangeRule("age", 0, None)]
    assert rows(rules.range_violations(df, ["id"], both)) == [
        (1, "age", -1.0),
        (1, "age", -1.0),
        (4, "age", 116.0),
    ]


def test_one_value_out_of_range_is_a_sentinel(spark):
    df = spark.createDataFrame([(-1, 200), (-1, 300), (5, 1), (None, None)], "a int, b int")
    got = rules.range_summary(df, [RangeRule("a", 0, 115), RangeRule("b", 0, 100), RangeRule("a", -1, 5)])
    assert rows(got) == [
        ("a", 0, False, None),
        ("a", 2, True, -1.0),
        ("b", 2, False, None),
    ]


def test_sentinels_become_null_once_and_stay_so(spark):
    df = spark.createDataFrame([(99, -1), (98, 99), (None, 3)], "a tinyint, b tinyint")
    rule = [SentinelRule(("a",), 99), SentinelRule(("b",), -1)]
    once = rules.correct_sentinels(df, rule)
    assert rows(once) == [(98, 99), (None, 3), (None, None)]
    assert rows(rules.correct_sentinels(once, rule)) == rows(once)
    assert dict(once.dtypes) == dict(df.dtypes)
    assert rows(rules.sentinel_counts(df, rule)) == [("a", "99", 1, 33.33), ("b", "-1", 1, 33.33)]


def test_totals_widen_propagate_null_and_chain(spark):
    df = spark.createDataFrame(
        [(100, 100, 1, "x", 0, 0), (1, None, 1, "x", 1, 1), (1, 2, 3, None, 3, None)],
        "p tinyint, q tinyint, r tinyint, gate string, t int, u int",
    )
    totals = [DerivedTotal("t", ("p", "q"), "gate"), DerivedTotal("u", ("t", "r"))]
    assert rows(rules.recompute_totals(df, totals), "t", "u") == [(200, 201), (None, None), (None, None)]
    after = rules.derived_totals(df, totals)
    assert rows(rules.change_counts(df, after)) == [("t", 3), ("u", 2)]


def test_tolerance_is_strict_and_missing_parts_count_as_zero(spark):
    df = spark.createDataFrame(
        [(1, 5, 5, 11), (2, 5, 5, 12), (3, None, 5, 6), (4, None, 5, 7), (5, 1, 1, None)],
        "id int, a tinyint, b tinyint, total int",
    )
    flag = rules.consistency_flag(ConsistencyRule("m", ("a", "b"), "total", 1.0))
    got = rules.flag_rows(df, ["id"], [flag])
    assert rows(got, "id", "rule_name", "detail") == [
        (2, "m", "a+b=10.0 vs total=12.0"),
        (4, "m", "a+b=5.0 vs total=7.0"),
    ]


def test_blank_evidence_is_no_evidence(spark):
    df = spark.createDataFrame(
        [(1, "Yes", None, "c"), (2, "No", None, "c"), (3, None, None, "c"), (4, None, 99, "c"),
         (5, None, 1, "c"), (6, None, None, None)],
        "id int, q4 string, q6 tinyint, code string",
    )
    flag = rules.skip_flag(SkipRule("skip", "code", ("q4 = 'Yes'", "q6 <> 99")))
    assert rows(rules.flag_rows(df, ["id"], [flag]), "id") == [(2,), (3,), (4,)]


def test_outliers_need_enough_values_and_some_spread(spark):
    data = [(i, float(i), 5, i if i < 9 else None) for i in range(1, 20)] + [(99, 1000.0, 5, None)]
    df = spark.createDataFrame(data, "id int, wide double, flat int, few int")
    rule = OutlierRule(("wide", "flat", "few", "absent"), prefix="monetary_outlier_")
    assert set(rules.outlier_fences(df, rule)) == {"wide"}
    flags = rules.flag_rows(df, ["id"], rules.outlier_flags(df, rule))
    assert rows(flags, "id", "rule_name", "detail") == [
        (99, "monetary_outlier_wide", "wide=1000.0 outside IQR bounds [-8, 30]")
    ]
    assert rows(rules.flag_summary(flags, ["id"])) == [(1, 1, 1)]


def test_no_rules_no_flags(spark):
    df = spark.createDataFrame([(1, "a")], "id int, k string")
    flags = rules.flag_rows(df, ["id", "k"], [])
    assert flags.columns == ["id", "k", "rule_name", "value", "low", "high", "detail"]
    assert rows(rules.flag_summary(flags, ["id", "k"])) == [(0, 0, 0)]


# ------------------------------------------------------------------------------- dedup


def test_null_keys_are_equal_keys(spark):
    df = spark.createDataFrame([(None, 1, "b"), (None, 1, "a"), (2, 1, "c")], "k int, m int, v string")
    assert rows(dedup.duplicate_rows(df, ["k", "m"])) == [(None, 1, "a"), (None, 1, "b")]
    assert rows(dedup.keep_first(df, ["k", "m"], ["v"])) == [(2, 1, "c"), (None, 1, "a")]
    assert rows(dedup.duplicate_count(df, ["k", "m"])) == [(3, 2, 1)]


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "heavy_rows": 20}])
def test_repeated_keys_by_broadcast_and_by_shuffle(spark, limits):
    data = [(None, "hot", i) for i in range(200)] + [(i, None, i) for i in range(50)] + [(7, None, 99)]
    df = spark.createDataFrame(data, "k int, m string, v int")
    expected = [r for r in data if r[:2] in ((None, "hot"), (7, None))]
    assert sorted(map(str, rows(dedup.duplicate_rows(df, ["k", "m"], **limits)))) == sorted(map(str, expected))
    limits = {k: v for k, v in limits.items() if k == "broadcast_rows"}
    kept = dedup.keep_first(df, ["k", "m"], ["v"], **limits)
    assert kept.count() == 51 and kept.filter("m = 'hot'").first()["v"] == 0
    assert kept.filter("k = 7").first()["v"] == 7


def test_a_table_without_repeated_keys_is_left_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert dedup.keep_first(df, ["k"]) is df


def test_first_follows_the_named_order_then_the_other_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, "x"), (1, 4, "z"), (1, 4, "y"), (2, None, "n"), (2, 1, "o")], "k int, o int, v string"
    )
    assert rows(dedup.keep_first(df, ["k"], ["o"])) == [(1, 4, "y"), (2, None, "n")]
    assert dedup.keep_first(df, ["k"], ["o"]).columns == df.columns


def test_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    assert dedup.keep_first(df, ["k"], ["v"]).count() == 20_001
    assert dedup.duplicate_rows(df, ["k"]).count() == 10_000


def test_keys_only_table_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedup.keep_first(df, ["k"])) == [(1,), (2,)]


# ---------------------------------------------------------------------- classification


@pytest.fixture(scope="module")
def industry(spark):
    structure = spark.createDataFrame(
        [
            ("A", "A Agriculture, forestry and fishing"),
            ("01", " A Agriculture, forestry and fishing"),
            ("07", "B Mining and quarrying"),
            ("0729", "B Mining and quarrying"),
            ("84", "O Public administration"),
        ],
        "Code string, Section string",
    )
    return lookup.division_sections(structure), lookup.section_labels(structure)


def test_lost_leading_zeros_are_put_back(spark, industry):
    codes = ["0111", "111", "729", " 729 ", "8411", "9999", "84110", "x1", "", None]
    df = spark.createDataFrame([(c,) for c in codes], "isic string")
    rule = ClassifyRule("isic", "s", "l", "industry", leading=2, numeric_key=True, blank_is_code=True)
    got = {r["isic"]: (r["s"], r["l"]) for r in lookup.classify(df, rule, *industry).collect()}
    farm, mine, public = (
        ("A", "Agriculture, forestry and fishing"),
        ("B", "Mining and quarrying"),
        ("O", "Public administration"),
    )
    nothing = (None, None)
    assert got == {
        "0111": farm, "111": farm, "729": mine, " 729 ": mine, "8411": public, "9999": nothing,
        "84110": public, "x1": nothing, "": nothing, None: nothing,
    }


def test_long_codes_keep_their_first_digit_and_blanks_stay_unclassified(spark):
    structure = spark.createDataFrame(
        [(1, "0", "Armed forces"), (1, "6", "Skilled farm workers"), (2, "61", "Growers")],
        "Level int, Code string, Title string",
    )
    majors = lookup.major_group_labels(structure)
    df = spark.createDataFrame([(c,) for c in ["110", "61111", "6111", "", " ", None, "7"]], "isco string")
    rule = ClassifyRule("isco", "g", "l", "occupation")
    groups = majors.select(F.col("group_code").alias("group_key"), "group_code")
    got = lookup.classify(df, rule, groups, majors)
    assert {r["isco"]: r["g"] for r in got.collect()} == {
        "110": "0", "61111": "6", "6111": "6", "": None, " ": None, None: None, "7": "0",
    }
    assert rows(lookup.classification_coverage(got, [("isco", "g")])) == [("isco", 6, 4, 2)]


def test_version_diff_aligns_on_the_key(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    after = spark.createDataFrame([(4, "D"), (3, "c"), (2, None), (1, "a")], "k int, v string")
    assert rows(lookup.version_diff(before, after, ["k"], ["v"])) == [("v", 1)]
    assert rows(lookup.version_diff(before, after, ["k"], ["v"], both_present=False)) == [("v", 3)]
    with pytest.raises(ValueError):
        lookup.version_diff(before.union(before), after, ["k"], ["v"])


def test_number_text_keeps_every_digit(spark):
    values = [1e-7, 1.25e-9, -3.5e-12, 1e33, 1.5e16, -2.25e20, 123.456, 0.0, 1e7, 12345678.9, 5e-324, 1.7976931348623157e308]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = df.select("i", number_text(F.col("v")).alias("t"), whole_number_text(F.col("v")).alias("w")).orderBy("i").collect()
    assert [float(r["t"]) for r in got] == values
    assert not any("E" in r["t"] or "E" in r["w"] for r in got)
    assert [r["t"] for r in got[:4]] == ["0.0000001", "0.00000000125", "-0.0000000000035", "1" + "0" * 33 + ".0"]
    assert [int(r["w"]) for r in got[3:7]] == [10**33, 15 * 10**15, -225 * 10**18, 123]
    missing = spark.createDataFrame([(None,)], "v double")
    assert rows(missing.select(number_text(F.col("v")), whole_number_text(F.col("v")))) == [(None, None)]


def test_strip_takes_all_white_space(spark):
    texts = [" a ", "\ta\n", "　a\xa0", "\x1ca\x85", "a b", "", " \t"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(strip("t")).collect()] == [t.strip() for t in texts]


def test_repeated_lookup_entries_multiply_no_row(spark):
    df = spark.createDataFrame([(1, "x"), (2, " x\t"), (3, "y"), (4, None)], "id int, c string")
    entries = [("c", "x", "b"), ("c", "x", "a"), ("c", "y", "z"), ("d", "x", "q")]
    mapping = lookup.mapping_table(df, entries)
    assert rows(lookup.apply_value_map(df, mapping, ["c"], trim=True)) == [(1, "a"), (2, "a"), (3, "z"), (4, None)]
    assert rows(lookup.mapping_effect(df, mapping, ["c"], trim=True)) == [("c", 3)]
    structure = spark.createDataFrame([(1, "1", "Managers"), (1, "1", "Managers "), (1, "2", "Others")], "Level int, Code string, Title string")
    assert rows(lookup.major_group_labels(structure)) == [("1", "Managers"), ("2", "Others")]


def test_severity_follows_the_rule(spark):
    df = spark.createDataFrame([(1, None, "no"), (2, None, None), (99, 5, "yes")], "x int, y int, asked string")
    spec = DatasetSpec(
        "t", ("x",), sentinels=(SentinelRule(("x",), 99, "Medium"), SentinelRule(("x",), 98, "High")),
        missing_findings=(MissingRule("y", "asked = 'yes'"), MissingRule("y", "asked = 'no'", "High"), MissingRule("x")),
    )
    got = [(r["variable"], r["count"], r["severity"]) for r in document.problem_inventory(df, spec).collect()]
    assert got == [("y", 2, "None (structural)"), ("y", 2, "High"), ("x", 0, "None"), ("x", 1, "Medium"), ("x", 0, "None")]


def test_flags_of_the_plan_do_not_look_for_near_duplicates(spark, monkeypatch):
    """And the table does not need the flags: what is not read is not worked out."""
    df = spark.createDataFrame([(1, 1, 0, "x"), (1, 1, 0, "x"), (2, 1, 1, "y")], "id int, asked int, why int, name string")
    rule = SkipRule("no_reason", "asked", ("why = 1",), "none")
    spec = DatasetSpec("t", keys=("id",), skips=(rule,), free_text=("name",))
    whole = plan.clean(df, spec)
    assert rows(whole.table) == [(1, 1, 0, "x"), (2, 1, 1, "y")] and whole.mapping.isEmpty()

    def unasked(*args, **options):
        raise AssertionError("was not asked for")

    monkeypatch.setattr(plan.near_duplicates, "near_duplicates", unasked)
    assert rows(plan.clean(df, spec).flags, "id", "rule_name") == [(1, "no_reason")]
    monkeypatch.undo()
    monkeypatch.setattr(plan.rules, "flag_rows", unasked)
    assert plan.clean(df, spec).table.count() == 2

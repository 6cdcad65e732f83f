"""Profiles asked together: the same answers as alone, from a fixed number of scans."""

import re
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import dedup, distribution, document, missing, near_duplicates, numeric, rules
from tidemark.operators.combine import answer_all
from tidemark.plans.diagnose import diagnose
from tidemark.plans.report import report_facts
from tidemark.queries.cleaning import SALES, sales
from tidemark.sources import tables
from tidemark.spec import OutlierRule, RangeRule

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def typed(spark, tmp_path_factory):
    return tables.write_layer(sales(spark, SF), str(tmp_path_factory.mktemp("layer") / "typed-layer"))


def scans(spark, path_part, work):
    """Executions that scan a table whose path has ``path_part``, while ``work`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    before = store.executionsCount()
    work()
    bus.waitUntilEmpty(30_000)
    after = store.executionsList(int(before), 100_000)
    plans = [after.apply(i).physicalPlanDescription() for i in range(after.size())]
    return sum(bool(re.search(rf"Location: [^\n]*{path_part}", plan)) for plan in plans)


def test_diagnosis_reads_its_table_three_times(spark, typed):
    results = []

    def work():
        found = diagnose(typed, SALES)
        for table in {**found.tables(), **found.distributions}.values():
            results.append(table.collect())
        results.append(document.problem_inventory(typed, replace(SALES, pseudo_keys=()), found.inventory).collect())
        results.append(report_facts(replace(SALES, free_text=(), classify=()), typed, sales(spark, SF), sales(spark, SF), [], found=found).filter("section = 'before'").collect())

    assert scans(spark, "typed-layer", work) == 3
    assert scans(spark, "typed-layer", lambda: [missing.missingness(typed).collect(), missing.gate_split(typed, SALES.gates).collect()]) == 2
    assert all(len(r) or i == 6 for i, r in enumerate(results))


def test_answers_equal_those_of_single_profiles(spark, typed):
    found = diagnose(typed, SALES)
    categories = distribution.columns_of_kind(typed, "category")
    alone = {
        "missingness": missing.missingness(typed),
        "duplicates": dedup.duplicate_rows(typed, SALES.keys).select(*SALES.keys),
        "range_summary": rules.range_summary(typed, SALES.ranges),
        "range_values": rules.range_value_counts(typed, SALES.ranges),
        "filled": distribution.valid_and_missing(typed, ["l_linestatus"]),
        "gate_split": missing.gate_split(typed, SALES.gates),
        "near_duplicates": near_duplicates.near_duplicates(typed, ["p_name"]),
    }
    if categories:
        alone["casing"] = distribution.casing_consistency(typed, categories)
    for name, table in alone.items():
        assert rows(found.tables()[name]) == rows(table), name
    assert rows(found.distributions["status"]) == rows(distribution.frequency_table(typed, "l_linestatus"))
    assert rows(found.distributions["l_quantity (binned)"]) == rows(distribution.binned_distribution(typed, *SALES.bins[0]))
    assert rows(found.share) == rows(distribution.category_share(typed, *SALES.share))
    assert rows(found.dominant) == rows(distribution.dominant_category(typed, SALES.dominant))
    assert rows(found.sentinels) == rows(rules.sentinel_counts(typed, SALES.sentinels))
    assert rows(found.surplus) == rows(dedup.duplicate_count(typed, SALES.keys))
    assert rows(found.inventory) == rows(document.problem_inventory(typed, replace(SALES, pseudo_keys=())))


def test_an_empty_table(spark, typed):
    found = diagnose(typed.limit(0), SALES)
    assert found.n_rows == 0 and rows(found.duplicates) == [] and rows(found.surplus) == [(0, 0, 0)]
    assert answer_all(typed, {}) == {}


def floats(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_nan_is_missing_in_ranges_and_fences(spark):
    df = floats(spark, [*map(float, range(20)), 1000.0, INF, NAN, None])
    rule = [RangeRule("v", 0, 50)]
    assert rows(rules.range_violations(df, [], rule), "value") == [(1000.0,), (INF,)]
    assert rows(rules.range_summary(df, rule), "n_flagged") == [(2,)]
    flags = rules.outlier_flags(df, OutlierRule(("v",)))
    assert rows(rules.flag_rows(df, ["v"], flags), "value") == [(1000.0,), (INF,)]
    only = floats(spark, [0.5, NAN, 2.5])
    assert rows(distribution.value_sets(only)) == [("v", "0.5–2.5")]


def test_infinite_values_stay_in_the_end_bins(spark):
    df = floats(spark, [*map(float, range(20)), INF, -INF, -INF, NAN])
    counts = [r["count"] for r in numeric.histogram(df, "v", 4).orderBy("bin").collect()]
    assert counts == [7, 5, 5, 6]
    assert sum(r["count"] for r in numeric.histogram(floats(spark, [INF, -INF]), "v", 3).collect()) == 2
    huge = numeric.histogram(floats(spark, [-1.7e308, 0.0, 1.7e308]), "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in huge] == [1, 0, 1, 1]
    both = df.withColumn("filled", F.col("v") == 3)
    found = numeric.observed_vs_imputed(both, "v", "filled", 4).orderBy("bin").collect()
    assert [(r.n_observed, r.n_imputed) for r in found] == [(6, 1), (5, 0), (5, 0), (6, 0)]


@pytest.mark.parametrize(
    "values, kind, share, wanted",
    [
        ([-1.7e308, 1.7e308], "double", 0.5, 0.0),
        ([2**53 + 1, 2**53 + 3], "bigint", 0.5, 2**53 + 2),
        ([-INF, 1.0], "double", 0.1, -INF),
        ([1.0, 2.0], "double", 0.25, 1.25),
        ([-(2**63), 2**63 - 1], "bigint", 0.5, -0.5),
    ],
)
def test_interpolation(spark, values, kind, share, wanted):
    found = numeric.exact_quantiles(floats(spark, values, kind), {"v": [share]})
    assert found["v"] == (2, [wanted])


def test_checksum_sees_a_null_that_changes_its_column(spark):
    one = spark.createDataFrame([("x", None)], "a string, b string")
    two = spark.createDataFrame([(None, "x")], "a string, b string")
    assert tables.fingerprint(one).first()["checksum"] != tables.fingerprint(two).first()["checksum"]
    twice = one.unionByName(two)
    assert tables.fingerprint(twice).first() == tables.fingerprint(two.unionByName(one)).first()

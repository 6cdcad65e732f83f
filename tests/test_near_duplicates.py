import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_similarity import GOLDEN, variants

from tidemark.functions import graph
from tidemark.functions.similarity import jaro_winkler
from tidemark.operators import clusters, lookup
from tidemark.operators.near_duplicates import near_duplicates
from tidemark.queries import text
from tidemark.session import materialize


def brute_force(values, threshold):
    """Pairs of distinct values by comparing all of them; counts decide who comes first."""
    counts = {}
    for v in values:
        v = v.strip(" ")
        if v:
            counts[v] = counts.get(v, 0) + 1
    order = sorted(counts, key=lambda v: (-counts[v], v.encode()))
    left = [a for i, a in enumerate(order) for _ in order[i + 1 :]]
    right = [b for i in range(len(order)) for b in order[i + 1 :]]
    if not left:
        return []
    scores = jaro_winkler(left, right)
    return sorted(
        (a, counts[a], b, counts[b]) for a, b, s in zip(left, right, scores) if s >= threshold - 1e-9
    )


def found(spark, values, threshold, **options):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    pairs = near_duplicates(df, ["v"], threshold, **options)
    return sorted((r.value_a, r.count_a, r.value_b, r.count_b) for r in pairs.collect())


@pytest.mark.parametrize("threshold", [0.85, 0.95])
def test_equals_brute_force(spark, threshold):
    values = [v for p in variants(5, 150, "abcdé ", 14) for v in p]
    values += [v for p in variants(6, 60, "abcdefghijklmnopqrstuvwxyz ", 60) for v in p]
    assert found(spark, values, threshold) == brute_force(values, threshold)


def test_hot_keys_are_split_without_loss_or_repetition(spark):
    """Names that all share their letters and prefix land on the same keys."""
    draw = random.Random(3)
    values = ["Supplier#" + "".join(draw.choice("0123") for _ in range(6)) for _ in range(400)]
    expected = brute_force(values, 0.97)
    assert len(expected) > 1000
    assert found(spark, values, 0.97, block_rows=16) == expected


def test_golden_pairs_are_found_at_the_boundary(spark):
    values = sorted({v for a, b, _ in GOLDEN for v in (a, b)})
    got = {frozenset((a, b)) for a, _, b, _ in found(spark, values, 0.95)}
    assert {frozenset((a, b)) for a, b, _ in GOLDEN} <= got


def test_blank_null_and_single_values(spark):
    assert found(spark, [None, "", "  ", "one", " one "], 0.95) == []
    df = spark.createDataFrame([], "v string")
    assert near_duplicates(df, ["v"]).count() == 0


def test_columns_do_not_mix(spark):
    df = spark.createDataFrame([("BARBER", "BARER"), ("BARBER", "CATERER")], "a string, b string")
    assert near_duplicates(df, ["a", "b"], 0.95).count() == 0


def test_low_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        near_duplicates(spark.createDataFrame([("x",)], "v string"), ["v"], 0.5)


def test_words_query_equals_brute_force_on_a_fixture(spark, tmp_path):
    """The registered words query has no SQL; here it runs on three small documents."""
    texts = [
        "The mechanic met the mechanics. Mechanical engineers, engineer!",
        "Élève élèves eleve; dont know\nDONT KNOW don't",
        "representative representatives representation",
    ]
    spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = text.near_dups_words(spark, str(tmp_path))
    words = [r.word for r in text.words(spark, str(tmp_path)).collect()]
    assert sorted((r.value_a, r.count_a, r.value_b, r.count_b) for r in got.collect()) == brute_force(
        words, 0.97
    )


# ---------------------------------------------------------------------------- clusters


def components(spark, edges, **options):
    df = spark.createDataFrame([("c", a, b) for a, b in edges], "column string, a string, b string")
    return {r.value: r.component for r in clusters.connected_components(df, **options).collect()}


def test_chains_stars_and_separate_groups(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    star = [("s000", f"s{i:03d}") for i in range(1, 40)]
    got = components(spark, chain + star + [("x", "y")])
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert {got[f"s{i:03d}"] for i in range(40)} == {"s000"}
    assert got["x"] == got["y"] == "x"


def test_links_that_lie_together_need_no_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "materialize", lambda df, label: (written.append(label), materialize(df, label))[1])
    edges = spark.range(2000).coalesce(1).filter("(id + 1) % 100 > 0").select(
        F.lit("c").alias("column"), (F.col("id") + 1).alias("a"), F.col("id").alias("b")
    )
    got = {r.node: r.component for r in graph.star_components(edges, ["column"]).collect()}
    assert got == {i: i - i % 100 for i in range(2000)}
    assert written == ["edges"]


def test_edge_order_and_direction_do_not_matter(spark):
    draw = random.Random(9)
    edges = [(f"v{draw.randrange(40)}", f"v{draw.randrange(40)}") for _ in range(30)]
    edges = [e for e in edges if e[0] != e[1]]
    shuffled = [(b, a) for a, b in draw.sample(edges, len(edges))]
    assert components(spark, edges) == components(spark, shuffled)


def test_components_do_not_cross_columns(spark):
    df = spark.createDataFrame(
        [("p", "a", "b"), ("q", "b", "c")], "column string, a string, b string"
    )
    got = rows(clusters.connected_components(df))
    assert got == [("p", "a", "a"), ("p", "b", "a"), ("q", "b", "b"), ("q", "c", "b")]


def test_components_with_a_hub(spark):
    star = [("s000", f"s{i:03d}") for i in range(1, 60)]
    got = components(spark, star + [("x", "y"), ("y", "z")])
    assert {got[f"s{i:03d}"] for i in range(60)} == {"s000"}
    assert got["x"] == got["y"] == got["z"] == "x"


def test_chains_that_rise_and_fall_settle_in_few_rounds(spark, monkeypatch):
    """60 to a slope: every local minimum has to be replaced by another."""
    order = [f"n{abs((i % 120) - 60):03d}x{i // 60:02d}" for i in range(480)]
    assert len(set(order)) == 480
    rounds = {"n": 0}
    original = graph._large_star

    def counted(*args):
        rounds["n"] += 1
        return original(*args)

    monkeypatch.setattr(graph, "_large_star", counted)
    got = components(spark, list(zip(order, order[1:])))
    assert set(got.values()) == {min(order)} and len(got) == 480
    assert rounds["n"] <= 14


def pair_table(spark, pairs):
    return spark.createDataFrame(
        pairs,
        "column string, value_a string, count_a bigint, value_b string, count_b bigint, similarity double",
    )


def test_the_most_frequent_then_greatest_value_is_kept(spark):
    pairs = pair_table(
        spark,
        [
            ("c", "TAXI DRIVER", 3, "TAXI DRIIVER", 1, 0.983),
            ("c", "GOLDSMITH", 1, "GOLD SMITH", 1, 0.98),
            ("c", "MECHANIC", 3, "MECHANICS", 1, 0.978),
        ],
    )
    assert rows(clusters.consolidation_map(pairs, 0.98)) == [
        ("c", "GOLD SMITH", "GOLDSMITH"),
        ("c", "TAXI DRIIVER", "TAXI DRIVER"),
    ]


# ----------------------------------------------------------------------- value mapping


@pytest.mark.parametrize(
    "limits", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "heavy_rows": 40}]
)
def test_value_map_by_broadcast_and_by_shuffle_with_heavy_keys_cut(spark, limits):
    """The hot value holds most rows; NULL and untrimmed text stay as they are."""
    values = ["hot"] * 500 + ["b", " b", None, "c"] * 5
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    mapping = lookup.mapping_table(df, [("v", "hot", "HOT"), ("v", "b", "B"), ("other", "c", "C")])
    got = lookup.apply_value_map(df, mapping, ["v"], **limits)
    counted = {r["v"]: r["count"] for r in got.groupBy("v").count().collect()}
    assert counted == {"HOT": 500, "B": 5, " b": 5, None: 5, "c": 5}
    assert rows(lookup.mapping_effect(df, mapping, ["v"])) == [("v", 505)]


def test_value_map_can_trim(spark):
    df = spark.createDataFrame([(" b ",), ("x",)], "v string")
    mapping = lookup.mapping_table(df, [("v", "b", "B")])
    assert rows(lookup.apply_value_map(df, mapping, ["v"], trim=True)) == [("B",), ("x",)]

"""Layers bucketed by their key: no shuffle on the key, and digests that leave out equal buckets."""

import contextlib
import io

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import dedup, keyed_layers, lookup
from tidemark.session import scratch_path


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def people(spark, n=2000):
    return spark.range(n).select(
        F.col("id").alias("k"),
        (F.col("id") % 7).cast("int").alias("part"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), "id")).alias("v"),
        (F.col("id") / 3).alias("x"),
    )


def layer(df, keys=("k",), buckets=8, **limits):
    return keyed_layers.write_keyed_layer(df, scratch_path(df.sparkSession, "t"), keys, buckets, **limits)


def test_no_shuffle_on_the_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before, after = layer(people(spark)), layer(people(spark).withColumn("v", F.upper("v")))
        assert rows(before.rows) == rows(people(spark))
        assert "Exchange" not in plan_of(dedup.duplicate_keys(before.rows, ["k"]))
        assert "Exchange" not in plan_of(dedup.keep_first(before.rows, ["k"]))
        doubled = layer(people(spark).union(people(spark).withColumn("x", F.lit(-1.0))))
        for few in (0, 10_000):
            kept = dedup.keep_first(doubled.rows, ["k"], ["x"], broadcast_rows=few)
            assert "hashpartitioning" not in plan_of(kept)
            assert rows(kept) == rows(dedup.keep_first(people(spark).withColumn("x", F.lit(-1.0)), ["k"]).filter("k > 0")
                                      .union(people(spark).withColumn("x", F.lit(-1.0)).filter("k = 0")))
        difference = keyed_layers.layer_diff(before, after, ["v", "x"])
        # one row for each task meets at the end; nothing is dealt by key
        assert "hashpartitioning" not in plan_of(difference)
        assert "SortMergeJoin" in plan_of(difference)
        assert rows(difference) == rows(lookup.version_diff(people(spark), people(spark).withColumn("v", F.upper("v")), ["k"], ["v", "x"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_digests_do_not_sort_the_rows(spark):
    found = keyed_layers._digests(layer(people(spark)).rows, ["k"], 8)
    assert "FileScan" in plan_of(found) and "d0" in plan_of(found)
    below = [line for line in plan_of(found).splitlines() if "SortAggregate" in line and "xxhash64" in line]
    assert not below
    assert sum(r.n_rows for r in found.collect()) == 2000 and {r.n_files for r in found.collect()} == {1}


def test_only_buckets_that_differ_are_read(spark):
    one = F.when(F.col("k") == 77, "other").otherwise(F.col("v"))
    before, after = layer(people(spark)), layer(people(spark).withColumn("v", one))
    changes = keyed_layers.bucket_changes(before, after, ["part", "v", "x"]).collect()
    assert [(c["columns"], c["n_before"] == c["n_after"]) for c in changes] == [(["v"], True)]
    old, new = keyed_layers.changed_rows(before, after, ["v"])
    assert len(old.inputFiles()) == len(new.inputFiles()) == 1 < len(before.rows.inputFiles())
    assert rows(keyed_layers.layer_diff(before, after, ["v", "x"])) == [("v", 1), ("x", 0)]
    # the column that changed is not asked for
    assert keyed_layers.bucket_changes(before, after, ["x"]).isEmpty()
    assert rows(keyed_layers.layer_diff(before, after, ["x"])) == [("x", 0)]


@pytest.mark.parametrize("both_present", [True, False])
def test_added_missing_and_null_keyed_rows(spark, both_present):
    schema = "k int, j string, v string, w double"
    old = spark.createDataFrame([(1, "a", "x", 1.0), (2, "a", None, None), (None, "b", "n", 0.0), (3, None, "p", float("nan")), (4, "z", "gone", 4.0)], schema)
    new = spark.createDataFrame([(1, "a", "X", 1.0), (2, "a", "y", -0.0), (None, "b", "m", -0.0), (3, None, None, float("nan")), (5, "z", "come", 5.0)], schema)
    layers = [layer(side, ("k", "j")) for side in (old, new)]
    got = keyed_layers.layer_diff(*layers, ["v", "w"], both_present)
    assert rows(got) == rows(lookup.version_diff(old, new, ["k", "j"], ["v", "w"], both_present))
    assert rows(keyed_layers.layer_counts(layers[0])) == [(5, 2, 0)]


def test_a_value_that_changes_column_or_row_shows(spark):
    def made(values):
        return layer(spark.createDataFrame(values, "k int, a string, b string"), buckets=1)

    before = made([(1, "x", None), (2, None, "y")])
    for values in ([(1, None, "x"), (2, None, "y")], [(1, None, None), (2, "x", "y")], [(2, "x", None), (1, None, "y")]):
        assert not keyed_layers.bucket_changes(before, made(values), ["a", "b"]).isEmpty()
    assert keyed_layers.bucket_changes(before, made([(2, None, "y"), (1, "x", None)]), ["a", "b"]).isEmpty()


def test_repeated_keys_empty_tables_and_unequal_layers(spark):
    base, none = layer(people(spark, 20)), layer(people(spark, 0))
    assert rows(keyed_layers.layer_counts(none)) == [(0, 0, 0)]
    assert rows(keyed_layers.layer_diff(base, none, ["v"])) == rows(keyed_layers.layer_diff(none, none, ["v"])) == [("v", 0)]
    repeated = layer(people(spark, 20).union(people(spark, 3)))
    assert rows(keyed_layers.layer_counts(repeated)) == [(23, 0, 3)]
    for other in (repeated, layer(people(spark, 20), buckets=4), layer(people(spark, 20), ["part"])):
        with pytest.raises(ValueError):
            keyed_layers.layer_diff(base, other, ["v"])
    with pytest.raises(ValueError):
        keyed_layers.layer_diff(base, base, ["nothing"])
    with pytest.raises(ValueError):
        layer(people(spark, 20), ["nothing"])


def test_a_heavy_key_is_refused(spark):
    heavy = people(spark).withColumn("k", F.when(F.col("k") % 3 == 0, -1).otherwise(F.col("k")))
    with pytest.raises(ValueError, match="write_layer"):
        layer(heavy, buckets=64, uneven_rows=100)
    assert rows(keyed_layers.layer_counts(layer(heavy, buckets=64))) == [(2000, 0, 1)]


def test_another_session_and_a_new_version(spark):
    df = people(spark, 50).withColumn("odd `name`", F.col("v").substr(1, 2)).withMetadata("v", {"label": "Value"})
    first = layer(df)
    for _ in range(2):
        other = keyed_layers.open_keyed_layer(spark.newSession(), first.path)
        assert rows(other.rows) == rows(df) and other.rows.schema["v"].metadata == {"label": "Value"}
        assert "Exchange" not in plan_of(dedup.duplicate_keys(other.rows, ["k"]))
        # the catalogue may have lost the table
        spark.sql(f"DROP TABLE IF EXISTS {keyed_layers._table_name(first.path)}")
    again = keyed_layers.write_keyed_layer(people(spark, 30), first.path, ["k"], 4)
    assert rows(again.rows) == rows(people(spark, 30)) and again.buckets == 4

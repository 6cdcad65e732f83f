"""What a full run keeps on disk, and deduplication a slice of the keys at a time."""

import glob
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import dedup
from tidemark.plans.clean import clean
from tidemark.queries import documents
from tidemark.queries.cleaning import SALES, hierarchies, sales
from tidemark.session import materialize, materialize_parts, release, scratch_dir
from tidemark.sources import tables

SF = "/root/testdata/sf0.001"


def scratch(spark):
    return set(os.listdir(scratch_dir(spark).removeprefix("file:")))


def copies(spark):
    """Rows whose keys repeat, are NULL in part or as a whole, and hold both zeros and NaN."""
    rng = random.Random(3)
    keys = [None, 0.0, -0.0, float("nan"), *map(float, range(1, 60))]
    data = [(rng.choice(keys), rng.choice([None, "a", "b"]), rng.choice([None, *range(9)]), rng.random()) for _ in range(900)]
    return spark.createDataFrame(data, "k double, s string, first int, v double")


@pytest.mark.parametrize("slices", [1, 2, 7])
def test_slices_keep_the_same_rows(spark, slices):
    df = copies(spark)
    parts = dedup.keep_first_parts(df, ["k", "s"], ["first"], broadcast_rows=0, slices=slices)
    assert len(parts) == slices
    kept = materialize_parts(parts, "sliced", tables.LAYER_CODEC)
    alone = dedup.keep_first(df, ["k", "s"], ["first"], broadcast_rows=0)
    text = [(F.col("k") + 0.0).cast("string"), "s", "first", "v"]  # NaN is not equal to itself in Python
    assert rows(kept, *text) == rows(alone, *text)
    assert kept.count() == df.select("k", "s").distinct().count()


def test_cleaning_takes_slices_of_a_large_layer(spark, monkeypatch):
    typed = materialize(sales(spark, SF), "typed")
    whole = clean(typed, SALES, hierarchies(spark, SF)).kept
    # as if the repeated keys were too many for a broadcast
    monkeypatch.setattr(dedup, "is_small", lambda *_: False)
    monkeypatch.setattr("tidemark.plans.clean.SLICE_ROWS", 2_500)
    asked = []
    first_rows = dedup._first_rows
    monkeypatch.setattr(dedup, "_first_rows", lambda df, *rest: asked.append(df) or first_rows(df, *rest))
    kept = clean(typed, SALES, hierarchies(spark, SF), n_rows=typed.count()).kept
    assert len(asked) == 3
    assert rows(kept) == rows(whole)


def test_released_tables_are_deleted_in_the_scratch_folder_alone(spark, tmp_path):
    inside = materialize(spark.range(5).withColumn("v", F.lit("x")), "inside")
    outside = tables.write_layer(spark.range(5), str(tmp_path / "outside"))
    folder = os.path.basename(os.path.dirname(inside.inputFiles()[0]))
    assert folder in scratch(spark)
    release(spark, inside, outside)
    assert folder not in scratch(spark)
    assert outside.count() == 5


def test_text_csv_reads_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TEXT_ROWS", 3)
    data = [(i, t) for i, t in enumerate(["a,b", ' "q" ', "", None, "NA", "ä\\", "'"] * 2)]
    df = spark.createDataFrame(data, "i bigint, t string").coalesce(1)
    tables.write_text_csv(df, str(tmp_path / "packed"))
    tables.write_report_csv(tables.as_text(df), str(tmp_path / "plain"))
    packed, plain = (tables.read_text_csv(spark, str(tmp_path / name), df.columns) for name in ("packed", "plain"))
    assert rows(packed) == rows(plain)
    assert len(glob.glob(str(tmp_path / "packed" / "*.csv.gz"))) == 5


@pytest.mark.parametrize("name", ["full_run", "full_run_facts"])
def test_full_run_gives_its_disk_back(spark, monkeypatch, name):
    before = scratch(spark)
    paths = {}
    run = documents._run
    monkeypatch.setattr(documents, "_run", lambda *args: paths.update(run(*args)) or paths)
    assert getattr(documents, name)(spark, SF).count() > 0
    left = {folder.rsplit("-", 1)[0] for folder in scratch(spark) - before}
    assert "run" in left and not left & {"sales-csv", "deduplicated"}
    for layer in ("raw", "typed", "cleaned", "imputed", "final"):
        assert spark.read.parquet(paths[layer]).count() > 0
        assert glob.glob(f"{paths[layer].removeprefix('file:')}/*.zstd.parquet")

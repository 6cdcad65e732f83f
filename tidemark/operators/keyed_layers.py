"""Layers kept bucketed and sorted by their key, with a digest for each bucket and column.

Rows of one key lie in one bucket, and two layers with the same key and number of buckets have
theirs in the same ones.  So counting, deduplication and joins on the key need no shuffle, and two
versions are compared by their digests first: buckets that agree are never read.

A folder holds ``rows`` (a bucketed Parquet table), ``digests`` (a row for each bucket that is not
empty) and ``about`` (one row that describes both).  The catalogue entry that tells Spark of the
buckets is made anew by ``open_keyed_layer`` in every session that lacks it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted, sql_name, sql_text
from tidemark.operators.lookup import change_counts_of_pairs

MAX_BUCKETS = 65_536  # digests of so many buckets at most pass the driver
BUCKET_ROWS = 4_000_000  # rows of a bucket, expected, unless the caller names a number of buckets
# A key with many rows makes its bucket larger than the others by more than this factor and
# these rows: such tables belong into an ordinary layer, whose operators cut heavy keys.
UNEVEN, UNEVEN_ROWS = 8, 100_000


@dataclass(frozen=True)
class KeyedLayer:
    """A layer as read back: its rows, bucketed by ``keys``, and its digests."""

    path: str
    keys: tuple[str, ...]
    buckets: int
    rows: DataFrame
    digests: DataFrame


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, as Spark's writer of bucketed tables deals rows."""
    return F.pmod(F.hash(*[quoted(k) for k in keys]), F.lit(buckets))


def _table_name(path: str) -> str:
    return "keyed_layer_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _default_buckets(df: DataFrame) -> int:
    """From the number of rows, but no fewer than a shuffle has partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, max(least, -(-df.count() // BUCKET_ROWS)))


def write_keyed_layer(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int | None = None,
    uneven_rows: int = UNEVEN_ROWS,
) -> KeyedLayer:
    """Write ``df`` bucketed and sorted by ``keys`` below ``path`` and return it as read back.

    The rows are shuffled once, so that each bucket is one sorted file; a second scan of what
    was written makes the digests.  NULL keys are kept and share a bucket.  A key that would
    make its bucket much larger than the others raises before anything is written.
    """
    keys = tuple(keys)
    unknown = [k for k in keys if k not in df.columns]
    if not keys or unknown:
        raise ValueError(f"no such key columns: {unknown}")
    buckets = _default_buckets(df) if buckets is None else buckets
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"{buckets} buckets: 1 to {MAX_BUCKETS} are allowed")
    per_bucket = df.groupBy(_bucket(keys, buckets).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sizes = per_bucket.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (sizes["most"] or 0) > max(uneven_rows, UNEVEN * sizes["n"] / buckets if sizes["n"] else 0):
        raise ValueError(
            f"one of {buckets} buckets would hold {sizes['most']} of {sizes['n']} rows; "
            f"write a table with such keys by write_layer"
        )
    spark = df.sparkSession
    (
        df.repartition(buckets, *[quoted(k) for k in keys])
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", f"{path}/rows")
        .saveAsTable(_table_name(path))
    )
    about = (path, list(keys), buckets, json.dumps(df.schema.jsonValue()))
    schema = "path string, keys array<string>, buckets int, schema string"
    spark.createDataFrame([about], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    rows = spark.table(_table_name(path))
    _digests(rows, keys, buckets).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")
    return open_keyed_layer(spark, path)


def open_keyed_layer(spark: SparkSession, path: str) -> KeyedLayer:
    """A layer written before, in this session or another."""
    about = spark.read.parquet(f"{path}/about").first()
    keys, schema = tuple(about["keys"]), T.StructType.fromJson(json.loads(about["schema"]))
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(map(sql_name, keys))
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {about['buckets']} BUCKETS "
            f"LOCATION {sql_text(f'{path}/rows')}"
        )
    labelled = [quoted(f.name).alias(f.name, metadata=f.metadata) if f.metadata else quoted(f.name) for f in schema.fields]
    return KeyedLayer(
        path, keys, about["buckets"], spark.table(name).select(*labelled), spark.read.parquet(f"{path}/digests")
    )


def _digests(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, file, n_rows, n_null_keys, n_repeated, digests``: for each column the sum of a hash
    of key and value over the rows of the bucket, in any order.  ``n_repeated`` counts the keys
    that occur more than once.  Only one row for each task, bucket and file is shuffled."""
    key = [quoted(k) for k in keys]
    nulls = [k.isNull() for k in key]
    any_null = nulls[0]
    for null in nulls[1:]:
        any_null = any_null | null

    def digest(column: str) -> Column:
        value = quoted(column)
        hashed = F.xxhash64(*key, *nulls, value, value.isNull())
        return F.sum(hashed.cast("decimal(38,0)"))

    # a text's minimum cannot be updated in place: files are grouping keys, so that rows are not sorted for it
    per_file = (
        rows.withColumn("__file", F.col("_metadata.file_name"))
        .groupBy(_bucket(keys, buckets).alias("bucket"), "__file")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(any_null).alias("n_null_keys"),
            *[digest(c).alias(f"d{i}") for i, c in enumerate(rows.columns)],
        )
    )
    measured = per_file.groupBy("bucket").agg(
        F.min("__file").alias("file"),
        F.count(F.lit(1)).alias("n_files"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null_keys")],
        *[F.sum(f"d{i}").cast("string").alias(f"d{i}") for i in range(len(rows.columns))],
    )
    repeated = (
        rows.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
        .groupBy(_bucket(keys, buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n_repeated"))
    )
    pairs = [x for i, c in enumerate(rows.columns) for x in (F.lit(c), F.col(f"d{i}"))]
    return measured.join(repeated, "bucket", "left").select(
        "bucket",
        "file",
        "n_files",
        "n_rows",
        "n_null_keys",
        F.coalesce("n_repeated", F.lit(0).cast("bigint")).alias("n_repeated"),
        F.create_map(*pairs).alias("digests"),
    )


def layer_counts(layer: KeyedLayer) -> DataFrame:
    """``n_rows, n_null_keys, n_repeated`` of a layer: rows, rows with a NULL in the key, and keys that
    occur more than once.  Read from the digests; the rows are not touched."""
    zero = F.lit(0).cast("bigint")
    return layer.digests.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("n_rows", "n_null_keys", "n_repeated")]
    )


def bucket_changes(before: KeyedLayer, after: KeyedLayer, columns: Sequence[str]) -> DataFrame:
    """``bucket, n_before, n_after, columns``: the buckets that differ, with the columns whose digest does."""
    _check_comparable(before, after, columns)
    old = before.digests.select("bucket", F.col("n_rows").alias("n_before"), F.col("digests").alias("old"))
    new = after.digests.select("bucket", F.col("n_rows").alias("n_after"), F.col("digests").alias("new"))
    differing = F.filter(
        F.array(*[F.lit(c) for c in columns]), lambda c: ~F.col("old")[c].eqNullSafe(F.col("new")[c])
    )
    zero = F.lit(0).cast("bigint")
    return (
        old.join(new, "bucket", "full_outer")
        .select(
            "bucket",
            F.coalesce("n_before", zero).alias("n_before"),
            F.coalesce("n_after", zero).alias("n_after"),
            differing.alias("columns"),
        )
        .filter(F.size("columns") > 0)
    )


def _check_comparable(before: KeyedLayer, after: KeyedLayer, columns: Sequence[str]) -> None:
    if (before.keys, before.buckets) != (after.keys, after.buckets):
        raise ValueError("the layers differ in key or number of buckets")
    for side in (before, after):
        unknown = [c for c in columns if c not in side.rows.columns]
        if unknown:
            raise ValueError(f"no such columns: {unknown}")
    kinds = [[(k, side.rows.schema[k].dataType) for k in before.keys] for side in (before, after)]
    if kinds[0] != kinds[1]:
        raise ValueError("the key has different types in the two layers")


def changed_rows(
    before: KeyedLayer, after: KeyedLayer, columns: Sequence[str], whole_share: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """The rows of both layers that lie in buckets whose digests differ in one of ``columns``.

    If more than ``whole_share`` of the buckets differ, these are the whole layers, which join without a
    shuffle; else only the files of those buckets are read.
    """
    found = bucket_changes(before, after, columns).select("bucket")
    sides = [
        side.digests.join(F.broadcast(found), "bucket", "left_semi").select("file", "n_files").collect()
        for side in (before, after)
    ]
    whole = any(r["n_files"] > 1 for side in sides for r in side)
    if whole or max(map(len, sides)) > whole_share * before.buckets:
        return before.rows, after.rows
    return tuple(_some_files(layer, [r["file"] for r in side]) for layer, side in zip((before, after), sides))


def _some_files(layer: KeyedLayer, files: Sequence[str]) -> DataFrame:
    if not files:
        return layer.rows.filter(F.lit(False))
    return layer.rows.sparkSession.read.schema(layer.rows.schema).parquet(*[f"{layer.path}/rows/{file}" for file in files])


def layer_diff(
    before: KeyedLayer, after: KeyedLayer, columns: Sequence[str], both_present: bool = True
) -> DataFrame:
    """``column, n_changed`` between two versions, as ``lookup.version_diff`` counts them.

    Buckets that agree in all of ``columns`` are left out by their digests.  That keys are unique is known
    from the digests as well; a repeated key raises.  Digests are sums of 64-bit hashes.
    """
    _check_comparable(before, after, columns)
    counts = [layer_counts(side).first() for side in (before, after)]
    if any(c["n_repeated"] for c in counts):
        raise ValueError(f"key {list(before.keys)} is not unique")
    nulls = all(c["n_null_keys"] for c in counts)
    old, new = changed_rows(before, after, columns)
    return change_counts_of_pairs(old, new, before.keys, columns, both_present, null_keys=nulls)

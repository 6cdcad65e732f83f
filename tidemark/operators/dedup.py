"""Duplicate detection and keep-first deduplication on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.operators.lookup import BROADCAST_ROWS, HEAVY_ROWS, heavy_keys, is_small, lookup_join
from tidemark.session import materialize


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``n_copies``; NULL keys count as equal."""
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_copies"))
        .filter(F.col("n_copies") > 1)
    )


def _repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The repeated keys as one struct column ``__key``, written out: NULLs inside a struct
    compare as equal, so a join on it pairs NULL keys as grouping does."""
    found = duplicate_keys(df, keys).select(
        F.struct(*[quoted(k) for k in keys]).alias("__key"), F.col("n_copies").alias("n")
    )
    return materialize(found, "repeated-keys")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``__key, n``: the repeated keys and how often each occurs, written out, from one scan of the keys."""
    return _repeated(df, keys)


def keys_of_copies(repeated: DataFrame) -> DataFrame:
    """The key of every row whose key repeats, in the order of the keys: each key once per copy.  The rows
    themselves are not needed for that."""
    each = repeated.select("__key", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return each.orderBy("__key").select("__key.*")


def counts_of_copies(repeated: DataFrame, n_rows: int) -> DataFrame:
    """``n_rows, n_keys, n_surplus`` as ``duplicate_count`` gives them, from the repeated keys."""
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint"))
    rows = F.lit(n_rows).cast("bigint")
    return repeated.agg(surplus.alias("n_surplus")).select(
        rows.alias("n_rows"), (rows - F.col("n_surplus")).alias("n_keys"), "n_surplus"
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str], ordered: bool = False, **limits: int) -> DataFrame:
    """Every row whose key occurs more than once.

    Only keys are counted and shuffled to find the repeated ones; the rows then look their
    key up, by broadcast if the repeated keys are few and else by a shuffle that cuts heavy
    keys into pieces.  No window gathers the copies of a key.  ``ordered`` sorts by key for
    a report, with the other columns behind it so that the copies of one key can spread
    over several ranges.
    """
    repeated = _repeated(df, keys)
    small = is_small(repeated, limits.get("broadcast_rows", BROADCAST_ROWS))
    heavy = None
    if not small:
        n_rows = repeated.agg(F.sum("n")).first()[0]
        heavy = heavy_keys(repeated, ["__key"], n_rows, limits.get("heavy_rows", HEAVY_ROWS))
    keyed = df.withColumn("__key", F.struct(*[quoted(k) for k in keys]))
    result = (
        lookup_join(keyed, repeated.select("__key", F.lit(True).alias("__hit")), ["__key"], small=small, heavy=heavy)
        .filter("__hit")
        .select(*[quoted(c) for c in df.columns])
    )
    if ordered:
        rest = [c for c in df.columns if c not in keys]
        result = result.orderBy(*[quoted(c) for c in [*keys, *rest]])
    return result


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """One row per key: the first in ``order_by``, then in the order of the other columns,
    NULLs first.  Rows have no position in a distributed table, so "first" always means
    first under a total order.

    The keys are counted alone.  If none repeats, the table is returned as it is; if few
    do, only their rows are compared and all others pass without a shuffle.  ``repeated`` are the
    ``repeated_keys`` of the same table, if they are known; the keys are then not counted again.
    """
    return keep_first_parts(df, keys, order_by, broadcast_rows, repeated)[0]


def keep_first_parts(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    repeated: DataFrame | None = None,
    slices: int = 1,
) -> list[DataFrame]:
    """The rows of ``keep_first`` in parts that together hold each of them once.  Where all rows have to move, the
    keys are dealt into ``slices`` by a hash; written one after the other, the parts each shuffle only their slice,
    for a scan of the table each."""
    lead = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if not lead and not rest:
        return [df.distinct()]
    repeated = _repeated(df, keys) if repeated is None else repeated
    if repeated.isEmpty():
        return [df]
    if not is_small(repeated, broadcast_rows):
        if slices < 2:
            return [_first_rows(df, keys, [*lead, *rest])]
        dealt = F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(slices))
        return [_first_rows(df.filter(dealt == i), keys, [*lead, *rest]) for i in range(slices)]
    keyed = df.withColumn("__key", F.struct(*[quoted(k) for k in keys]))
    probe = F.broadcast(repeated.select("__key"))
    once = keyed.join(probe, "__key", "left_anti").drop("__key")
    copies = keyed.join(probe, "__key", "left_semi").drop("__key")
    return [once.unionByName(_first_rows(copies, keys, [*lead, *rest]))]


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A ``min`` over a struct combines on the map side: each task sends one row per key, and
    a key that holds a third of the table is no larger than any other after that."""
    first = F.min(F.struct(*[quoted(c) for c in order])).alias("first_row")
    kept = df.groupBy(*[quoted(k) for k in keys]).agg(first)
    return kept.select(
        *[
            quoted(c) if c in keys else F.col("first_row").getField(c).alias(c, metadata=_metadata(df, c))
            for c in df.columns
        ]
    )


def _metadata(df: DataFrame, column: str) -> dict:
    return df.schema[column].metadata


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows.  Keys are counted first and summed after, so
    only distinct keys travel."""
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    ).select("n_rows", "n_keys", (F.col("n_rows") - F.col("n_keys")).alias("n_surplus"))

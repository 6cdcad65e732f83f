"""Near-duplicate values of free-text columns: an exact Jaro-Winkler self-join."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.block_pairs import Block, close_pairs
from tidemark.functions.columns import literal_table, quoted, strip
from tidemark.functions.signatures import (
    BOTH,
    KEY_SCHEMA,
    LONGER,
    PREFIX_CAP,
    PREFIX_WEIGHT,
    SHORTER,
    SIGNATURE_WORDS,
    blocking_keys,
    bucket_range,
    chance_of_a_common_key,
    class_keys,
    class_runs,
    length_bucket,
)
from tidemark.functions.similarity import jaro_winkler
from tidemark.operators.distribution import value_counts
from tidemark.operators.lookup import heavy_keys, lookup_join
from tidemark.session import materialize, ship_package

LEAST_THRESHOLD = 0.85
# scores this close below the threshold count as equal to it (0.95 is not exact in binary)
_ROUNDING = 1e-9
# a blocking key with more values than this is split into blocks of this size
BLOCK_ROWS = 4096
_VALUES_PER_TASK = 16_000
# nanoseconds, as measured: to make, move and sort one key, to compare two rows of one key and to
# follow up what passes, to look at one pair in a block, and to begin a pair of blocks
_KEY_COST, _JOIN_COST, _BLOCK_COST, _BLOCK_START = 10_000, 100, 50, 20_000_000
_FREQUENT_CHARACTERS = 128
# texts on whose keys the plan is tried; they decide how pairs are found, never which
_SAMPLE = 4096
_SAMPLE_LENGTH = 256
# a pair of texts is looked at in blocks of so many characters, at most so many texts
_BLOCK_CHARACTERS, _BLOCK_TEXTS = 1 << 20, 1 << 14
_BLOCK_TASKS = 2048

PAIR_COLUMNS = ["column", "value_a", "count_a", "value_b", "count_b", "similarity"]


def text_values(df: DataFrame, columns: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """``column, value, count`` of the trimmed, non-blank texts; from value counts of the columns, if
    they are known."""
    if counts is not None:
        known = counts.filter(F.col("column").isin(list(columns)))
        stripped = known.select("column", strip(F.col("value")).alias("value"), "count").filter(F.col("value") != "")
        return stripped.groupBy("column", "value").agg(F.sum("count").alias("count"))
    # texts are counted as they are, so that each distinct one is trimmed once
    return text_values(df, columns, value_counts(df, columns))


def frequent_characters(values: DataFrame) -> str:
    """The most frequent characters of the values, most frequent first.  They only balance
    the blocking keys; a fixed number of them suffices."""
    rows = (
        values.select(F.explode(F.split("value", "")).alias("c"))
        .filter(F.length("c") == 1)
        .groupBy("c")
        .count()
        .orderBy(F.desc("count"), "c")
        .limit(_FREQUENT_CHARACTERS)
        .collect()
    )
    return "".join(r["c"] for r in rows)


def _difference_bound(threshold: float) -> Column:
    """How many characters the two texts of a candidate may differ in, from their lengths
    and their common prefix."""
    prefix = F.col("a.prefix").cast("double") * PREFIX_WEIGHT
    jaro = (F.lit(threshold) - prefix) / (F.lit(1.0) - prefix)
    n, m = F.col("a.length").cast("double"), F.col("b.length").cast("double")
    needed = F.ceil((jaro * 3 - 1) * n * m / (n + m) - _ROUNDING)
    return n + m - needed * 2


def _candidate_condition(threshold: float) -> Column:
    """Exact tests a pair has to pass before it leaves the join, all on numbers."""
    # within one length bucket both sides hold every value: each pair is taken once
    once = (F.col("a.side") != BOTH) | (F.col("a.id") < F.col("b.id"))
    # below the cap, the pair belongs to the run of classes that holds its common prefix; a text
    # that ends there has no next character
    exact_prefix = F.col("a.next").isNull() | (F.col("a.next") != F.col("b.next"))
    differing_bits = sum(
        (F.bit_count(F.col(f"a.s{w}").bitwiseXOR(F.col(f"b.s{w}"))) for w in range(1, SIGNATURE_WORDS)),
        F.bit_count(F.col("a.s0").bitwiseXOR(F.col("b.s0"))),
    )
    return once & exact_prefix & (differing_bits <= _difference_bound(threshold))


def _hot_blocks(keys: DataFrame, block_rows: int) -> DataFrame:
    """Keys with more than ``block_rows`` values on a side, with the number of blocks to cut
    each side into; written out."""
    sizes = keys.groupBy("key").agg(
        F.count_if(F.col("side") != LONGER).alias("a"), F.count_if(F.col("side") != SHORTER).alias("b")
    )
    blocks = [F.greatest(F.ceil(F.col(c) / block_rows), F.lit(1)).cast("int") for c in ("a", "b")]
    return materialize(
        sizes.filter((F.col("a") > block_rows) | (F.col("b") > block_rows)).select(
            "key", (F.col("a") + F.col("b")).alias("n"), blocks[0].alias("a_blocks"), blocks[1].alias("b_blocks")
        ),
        "hot-keys",
    )


def _place(keys: DataFrame, hot: DataFrame, heavy: DataFrame, own: str, other: str) -> DataFrame:
    """Add the block pair (``a_block, b_block``) in which a value is compared: its own block
    by a hash, repeated for every block of the other side.  Keys that are not hot have one
    block pair, so no task ever meets a whole hot key."""
    blocks = hot.select("key", "a_blocks", "b_blocks")
    placed = lookup_join(keys, blocks, ["key"], heavy=heavy)
    own_blocks = F.coalesce(f"{own}_blocks", F.lit(1))
    other_blocks = F.coalesce(f"{other}_blocks", F.lit(1))
    return (
        placed.withColumn(f"{own}_block", F.pmod(F.xxhash64("id"), own_blocks).cast("int"))
        .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), other_blocks - 1)))
        .drop("a_blocks", "b_blocks")
    )


def _bucket(length: Column) -> Column:
    """``length_bucket`` of a column."""
    step = F.length(F.bin(length)) - F.lit(4)
    wide = F.lit(16) + (step - 1) * 8 + (F.expr("length >> (length(bin(length)) - 4)") - 8)
    return F.when(length < 16, length).otherwise(wide).cast("int")


def _plan(
    values: DataFrame, threshold: float, key_budget: int, frequent: str
) -> tuple[frozenset[tuple[int, int, int]], frozenset[tuple[int, int, int]], dict[tuple[int, int], tuple[int, int]]]:
    """How the pairs of two length buckets are found at the least cost: the classes (common prefix and two
    length buckets) that get keys, those among them whose one key is the prefix, and the pairs of buckets that
    are compared in blocks without any key, with the numbers of blocks of both.  Classes without a pair are left out.

    Prefixes are counted by bucket; the counts of two buckets give the comparisons, and a sample of the
    texts how often two of them share a key.  What comes back is one row for each class, of which the plan
    has a fixed number, and the sample.
    """
    sized = values.select("column", "value", F.length("value").alias("length"))
    prefixes = F.explode(F.sequence(F.lit(0), F.least(F.col("length"), F.lit(PREFIX_CAP))))
    counts = materialize(
        sized.select("column", "value", "length", prefixes.alias("prefix"))
        .groupBy("column", "prefix", F.substring("value", F.lit(1), F.col("prefix")).alias("head"), _bucket(F.col("length")).alias("bucket"))
        .agg(F.count(F.lit(1)).cast("double").alias("n")),
        "prefix-counts",
    )
    totals = counts.groupBy("prefix", "bucket").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    sizes = {(r["prefix"], r["bucket"]): r["n"] for r in totals}
    keys = class_keys(threshold, key_budget, sorted({b for _, b in sizes}))
    # the pairs of buckets that the plan compares, one row each
    wanted = F.broadcast(
        literal_table(values.sparkSession, sorted(keys), "prefix int, one int, other int")
    )
    on = ["column", "prefix", "head"]
    compared = (
        counts.withColumnsRenamed({"bucket": "one", "n": "n_one"})
        .join(wanted, ["prefix", "one"])
        .join(counts.withColumnsRenamed({"bucket": "other", "n": "n_other"}), [*on, "other"])
        .groupBy("prefix", "one", "other")
        .agg(F.sum(F.col("n_one") * F.col("n_other")).alias("pairs"))
        .collect()
    )
    pairs = {(r["prefix"], r["one"], r["other"]): r["pairs"] for r in compared}
    for at in pairs:
        if at[1] == at[2]:
            pairs[at] = (pairs[at] - sizes[at[:2]]) / 2
    sample: dict[int, list[str]] = {}
    text = F.substring("value", 1, _SAMPLE_LENGTH)
    for r in values.orderBy(F.xxhash64("value"), "id").limit(_SAMPLE).select(text.alias("value"), F.length("value").alias("n")).collect():
        sample.setdefault(length_bucket(r["n"]), []).append(r["value"])
    shared: dict[tuple[int, int, int], float] = {}

    def keys_in_common(bucket: int, differences: int, groups: int) -> float:
        at = (bucket, differences, groups)
        if at not in shared:
            texts = sample.get(bucket, [])
            shared[at] = chance_of_a_common_key(texts[:1024], differences, groups, frequent) if len(texts) > 1 else 0.0
        return shared[at]

    among, plain, blocks = set(), set(), {}
    most = {r["bucket"]: int(r["most"]) for r in totals if r["prefix"] == 0}
    for one, other in sorted({(a, b) for _, a, b in keys}):
        cost = 0.0
        for low, high, partner, differences, groups, _ in class_runs(threshold, one, key_budget, frozenset()):
            met = pairs.get((low, one, other), 0)
            if partner != other or not met:
                continue
            among.add((low, one, other))
            texts = sizes.get((low, one), 0) + (sizes.get((low, other), 0) if one != other else 0)
            by_prefix = texts * _KEY_COST + met * _JOIN_COST
            by_keys = texts * keys[(low, one, other)] * _KEY_COST
            if by_keys < by_prefix:
                by_keys += met * keys_in_common(one, differences, groups) * _JOIN_COST
            if by_prefix <= by_keys:
                plain |= {(prefix, one, other) for prefix in range(low, high + 1)}
            cost += min(by_prefix, by_keys)
        rows = [max(1, min(_BLOCK_TEXTS, _BLOCK_CHARACTERS // max(bucket_range(b)[1], 1))) for b in (one, other)]
        n = tuple(-(-most.get(b, 0) // size) for b, size in zip((one, other), rows))
        # short texts without a common prefix may have no class, but a block compares them all
        met = sizes.get((0, one), 0) * sizes.get((0, other), 0) / (2 if one == other else 1)
        if met * _BLOCK_COST + n[0] * n[1] * _BLOCK_START < cost:
            blocks[(one, other)] = n
    return frozenset(a for a in among if a[1:] not in blocks), frozenset(plain), blocks


def _block_pairs(values: DataFrame, blocks: dict[tuple[int, int], tuple[int, int]], threshold: float) -> DataFrame:
    """``x, y``: ids of the close pairs between texts of two length buckets, every pair looked at.  Each bucket is cut
    into blocks by a hash of the id, each pair of blocks is a group of its own."""
    plan = []
    for (one, other), (n_one, n_other) in sorted(blocks.items()):
        if one == other:
            plan.append((one, one, other, BOTH, n_one, n_one))
        else:
            plan += [(one, one, other, SHORTER, n_one, n_other), (other, one, other, LONGER, n_other, n_one)]
    spark = values.sparkSession
    sides = F.broadcast(literal_table(spark, plan, "bucket int, one int, other int, side int, own int, others int"))
    against = F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("against")
    placed = (
        values.withColumn("length", F.length("value"))
        .withColumn("bucket", _bucket(F.col("length")))
        .join(sides, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("own")).cast("int"))
        .select("column", "id", "value", "one", "other", "side", "block", against)
    )
    # within one bucket a pair of blocks is named by the smaller one first
    first = F.when(F.col("side") == BOTH, F.least("block", "against")).when(F.col("side") == SHORTER, F.col("block"))
    second = F.when(F.col("side") == BOTH, F.greatest("block", "against")).when(F.col("side") == LONGER, F.col("block"))
    named = placed.select(
        "column", "one", "other", F.coalesce(first, "against").alias("a_block"), F.coalesce(second, "against").alias("b_block"),
        "id", "value", ((F.col("side") == SHORTER) | ((F.col("side") == BOTH) & (F.col("block") <= F.col("against")))).alias("left"),
    )
    group = ["column", "one", "other", "a_block", "b_block"]
    n_groups = sum(n * m for n, m in blocks.values())

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        left = rows.column("left").to_numpy(zero_copy_only=False)
        ids, texts = rows.column("id").to_numpy(), rows.column("value").to_pylist()
        one, other, a_block, b_block = (k.as_py() for k in key[1:])
        same = one == other and a_block == b_block
        sides = [np.flatnonzero(left)] + ([] if same else [np.flatnonzero(~left)])
        found = []
        if all(len(side) for side in sides):
            made = [Block(ids[side], [texts[i] for i in side]) for side in sides]
            found = list(close_pairs(made[0], made[-1], threshold, same))
        x, y = (np.concatenate([pair[i] for pair in found]) if found else np.empty(0, dtype=np.int64) for i in (0, 1))
        return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    # as many tasks as groups: small rows make long work here, which sizes cannot tell
    return (
        named.repartition(max(2, min(2 * n_groups, _BLOCK_TASKS)), *group)
        .groupBy(*group)
        .applyInArrow(compare, "x bigint, y bigint")
    )


def candidate_pairs(
    values: DataFrame, threshold: float, key_budget: int = 16, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``x, y``: distinct pairs of ids of ``values (column, id, value)``; every qualifying pair
    is among them.  The keys are made once and written out, and hold numbers alone.  Pairs of lengths at
    which keys would tell too few texts apart are compared in blocks."""
    frequent = frequent_characters(values)
    among, plain, blocks = _plan(values, threshold, key_budget, frequent)
    by_keys = _key_pairs(values, threshold, key_budget, block_rows, frequent, among, plain)
    return by_keys.unionByName(_block_pairs(values, blocks, threshold)).distinct() if blocks else by_keys.distinct()


def _key_pairs(
    values: DataFrame,
    threshold: float,
    key_budget: int,
    block_rows: int,
    frequent: str,
    among: frozenset[tuple[int, int, int]],
    plain: frozenset[tuple[int, int, int]],
) -> DataFrame:
    """``x, y``: pairs of ids that share a key and pass the tests on numbers."""
    n_values = values.count()
    keys = materialize(
        values.select("column", "id", "value")
        .repartition(max(2, -(-n_values // _VALUES_PER_TASK)), "id")
        .mapInArrow(blocking_keys(threshold, key_budget, frequent, plain, among), KEY_SCHEMA),
        "blocking-keys",
    )
    shorter, longer = keys.filter(F.col("side") != LONGER), keys.filter(F.col("side") != SHORTER)
    on = ["key", "prefix"]
    # a key can only exceed the block size if there are that many values at all
    if n_values > block_rows:
        hot = _hot_blocks(keys, block_rows)
        if not hot.isEmpty():
            heavy = heavy_keys(hot, ["key"], hot.agg(F.sum("n")).first()[0])
            shorter = _place(shorter, hot, heavy, "a", "b")
            longer = _place(longer, hot, heavy, "b", "a")
            on = [*on, "a_block", "b_block"]
    # a class has one bucket or two: sides that are both meet only such
    condition = _candidate_condition(threshold) & ((F.col("a.side") == BOTH) == (F.col("b.side") == BOTH))
    for name in on:
        condition = condition & (F.col(f"a.{name}") == F.col(f"b.{name}"))
    # the planner cannot see how many keys a value has, so it must not guess a broadcast
    return (
        shorter.alias("a")
        .join(longer.alias("b").hint("merge"), condition)
        .select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    )


def _with_texts(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Texts and counts of the candidates, the more frequent value first."""
    side = lambda n: values.select(
        F.col("id").alias(n), F.col("column").alias(f"column_{n}"), F.struct("value", "count").alias(f"of_{n}")
    )
    found = pairs.join(side("x"), "x").join(side("y"), "y").filter(F.col("column_x") == F.col("column_y"))
    x, y = F.col("of_x"), F.col("of_y")
    x_first = (x["count"] > y["count"]) | ((x["count"] == y["count"]) & (x["value"] < y["value"]))
    ordered = found.select(
        F.col("column_x").alias("column"), F.when(x_first, x).otherwise(y).alias("a"), F.when(x_first, y).otherwise(x).alias("b")
    )
    return ordered.select(
        "column",
        F.col("a.value").alias("value_a"),
        F.col("a.count").alias("count_a"),
        F.col("b.value").alias("value_b"),
        F.col("b.count").alias("count_b"),
    )


@F.pandas_udf(T.DoubleType())
def _similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        yield pd.Series(jaro_winkler(left.tolist(), right.tolist(), PREFIX_WEIGHT))


# scored once, after the pairs are distinct: not again below the aggregate
_similarity = _similarity.asNondeterministic()


def near_duplicates(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = 0.95,
    key_budget: int = 16,
    block_rows: int = BLOCK_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Unordered pairs of distinct values with Jaro-Winkler similarity at or above the
    threshold: ``column, value_a, count_a, value_b, count_b, similarity`` (3 decimals).

    ``value_a`` is the more frequent value, the smaller one among equals.  Meant for short
    texts such as titles and job names: the number of keys grows with length.  The result
    holds every qualifying pair, so it is as large as the data makes it.
    """
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"threshold must be at least {LEAST_THRESHOLD}; lower ones block too little")
    ship_package(df.sparkSession)
    at = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")).cast("int")
    # the id is fixed once the table is written
    values = materialize(
        text_values(df, columns, counts).select(at.alias("column"), F.monotonically_increasing_id().alias("id"), "value", "count"),
        "text-values",
    )
    pairs = _with_texts(candidate_pairs(values, threshold, key_budget, block_rows), values)
    scored = pairs.withColumn("score", _similarity("value_a", "value_b"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    return scored.filter(F.col("score") >= threshold - _ROUNDING).select(
        name.alias("column"), *PAIR_COLUMNS[1:-1], F.round("score", 3).alias("similarity")
    )


def most_similar_first(pairs: DataFrame) -> DataFrame:
    """The report order: most similar pairs on top of each column."""
    return pairs.orderBy("column", F.desc("similarity"), "value_a", "value_b")

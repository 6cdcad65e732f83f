"""Left joins against a lookup table, value mappings, and hierarchical classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    blank_to_null,
    changed,
    is_true,
    literal_table,
    quoted,
    stack_rows,
    strip,
    zero_pad,
)
from tidemark.operators.distribution import value_counts
from tidemark.session import materialize
from tidemark.spec import ClassifyRule

# A lookup within both limits is sent to every executor; checked by counting and measuring.
BROADCAST_ROWS = 200_000
_BROADCAST_CHARACTERS = 100_000_000
# A key counts as heavy from this many rows on, and only if it holds more than this share of
# all rows: so there are never more heavy keys than the inverse of the share.
HEAVY_ROWS = 100_000
_HEAVY_SHARE = 1 / 10_000
# Rows without a key match nothing; this many buckets keep them from meeting in one task.
_NULL_BUCKETS = 1024


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if the table has at most ``rows`` rows and their text is not too long either.
    Counted and measured by one aggregate; only its row comes back."""
    width = F.length(F.to_json(F.struct(*[quoted(c) for c in df.columns])))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= _BROADCAST_CHARACTERS


def heavy_keys(counts: DataFrame, on: Sequence[str], n_rows: int, at_least: int = HEAVY_ROWS) -> DataFrame:
    """From key counts (``on``, ``n``): the keys that would overload a task, with the number
    of ``pieces`` to cut them into.  At most 10,000 keys can hold so large a share."""
    limit = max(at_least, int(n_rows * _HEAVY_SHARE))
    return counts.filter(F.col("n") > limit).select(
        *[quoted(c) for c in on], F.ceil(F.col("n") / limit).cast("int").alias("__pieces")
    )


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    small: bool | None = None,
    heavy: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Left join on columns that are unique in ``lookup``.

    A small lookup is broadcast (``small`` states the result of that check if the caller has
    made it).  A larger one is joined by shuffle, with heavy keys cut into pieces: rows take
    a piece by a hash of their content, the same on every retry, and only the lookup rows of
    heavy keys are repeated, once per piece.  ``heavy`` names these keys if they are known;
    otherwise the keys of ``df`` are counted, on the map side first.
    """
    if is_small(lookup, broadcast_rows) if small is None else small:
        return df.join(F.broadcast(lookup), list(on), "left")
    if heavy is None:
        counts = df.groupBy(*[quoted(c) for c in on]).agg(F.count(F.lit(1)).alias("n"))
        heavy = materialize(heavy_keys(counts, on, df.count(), heavy_rows), "heavy-keys")
    # keys may be long texts: what is broadcast is a 128-bit digest of each, 10,000 at most
    digest = F.unhex(F.md5(F.encode(F.to_json(F.struct(*[quoted(c) for c in on])), "utf-8")))
    heavy = F.broadcast(heavy.select(digest.alias("__digest"), "__pieces"))
    pieces = F.coalesce("__pieces", F.lit(1))
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | quoted(c).isNull()
    spread = F.when(no_key, F.lit(_NULL_BUCKETS)).otherwise(pieces)
    cut = df.withColumn("__digest", digest).join(heavy, "__digest", "left").drop("__digest").withColumn(
        "__piece", F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), spread).cast("int")
    )
    copies = lookup.withColumn("__digest", digest).join(heavy, "__digest", "left").drop("__digest").withColumn(
        "__piece", F.explode(F.sequence(F.lit(0), pieces - 1))
    )
    return (
        cut.drop("__pieces")
        .join(copies.drop("__pieces").hint("merge"), [*on, "__piece"], "left")
        .drop("__piece")
    )


def mapping_table(df: DataFrame, entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Declared ``(column, from_value, to_value)`` entries as a DataFrame."""
    return literal_table(
        df.sparkSession, entries, "column string, from_value string, to_value string"
    )


def apply_value_map(
    df: DataFrame,
    mapping: DataFrame,
    columns: Sequence[str],
    trim: bool = False,
    **limits: int,
) -> DataFrame:
    """Replace values listed for a column in ``mapping (column, from_value, to_value)``.
    The raw text has to match exactly unless ``trim`` is set; NULL never matches.  Of several
    entries for one value the smallest ``to_value`` counts, so no row is ever multiplied."""
    order = df.columns
    for column in columns:
        key, target = "__from", "__to"
        entries = (
            mapping.filter(F.col("column") == column)
            .groupBy(F.col("from_value").alias(key))
            .agg(F.min("to_value").alias(target))
        )
        probe = strip(quoted(column)) if trim else quoted(column)
        joined = lookup_join(df.withColumn(key, probe), entries, [key], **limits)
        new_value = F.coalesce(F.col(target), quoted(column)).alias(column, metadata=df.schema[column].metadata)
        df = joined.select(*[new_value if c == column else quoted(c) for c in order])
    return df


def mapping_effect(df: DataFrame, mapping: DataFrame, columns: Sequence[str], trim: bool = False) -> DataFrame:
    """``column, n_rows_affected``: rows whose value is listed as a ``from_value``.  Values
    are counted before the join, so it moves distinct values instead of rows."""
    counts = value_counts(df, columns)
    if trim:
        counts = counts.withColumn("value", strip("value"))
    matched = counts.join(
        mapping.select("column", F.col("from_value").alias("value")), ["column", "value"], "left_semi"
    )
    names = literal_table(df.sparkSession, [(c,) for c in columns], "column string")
    return (
        names.join(matched.groupBy("column").agg(F.sum("count").alias("n")), "column", "left")
        .select("column", F.coalesce("n", F.lit(0)).alias("n_rows_affected"))
    )


# ----------------------------------------------------------------------- classification


def division_sections(structure: DataFrame, code: str = "Code", section: str = "Section") -> DataFrame:
    """``group_key, group_code``: the two-character rows of an industry structure give each
    division its section letter, the first character of the section text."""
    return (
        structure.filter(F.length(quoted(code)) == 2)
        .select(
            quoted(code).try_cast("int").alias("group_key"),
            F.substring(strip(quoted(section)), 1, 1).alias("group_code"),
        )
        .groupBy("group_key")
        .agg(F.min("group_code").alias("group_code"))
    )


def section_labels(structure: DataFrame, code: str = "Code", section: str = "Section") -> DataFrame:
    """``group_code, group_label``: the section text split at its first blank."""
    text = strip(quoted(section))
    return (
        structure.filter(F.length(quoted(code)) == 2)
        .select(
            F.substring_index(text, " ", 1).alias("group_code"),
            F.when(F.contains(text, F.lit(" ")), F.substr(text, F.instr(text, " ") + 1))
            .otherwise(F.lit(""))
            .alias("group_label"),
        )
        .groupBy("group_code")
        .agg(F.min("group_label").alias("group_label"))
    )


def major_group_labels(
    structure: DataFrame, level: str = "Level", code: str = "Code", title: str = "Title"
) -> DataFrame:
    """``group_code, group_label`` from the level-1 rows of an occupation structure, one row
    per code: of several titles the smallest."""
    return (
        structure.filter(quoted(level) == 1)
        .groupBy(strip(quoted(code).cast("string")).alias("group_code"))
        .agg(F.min(strip(quoted(title).cast("string"))).alias("group_label"))
    )


def leading_key(code: Column, rule: ClassifyRule) -> Column:
    """The part of a code that decides its group: trimmed, padded, cut to the leading
    characters.  Codes longer than the width keep their own leading characters."""
    text = strip(code) if rule.blank_is_code else blank_to_null(strip(code))
    head = F.substring(zero_pad(text, rule.width), 1, rule.leading)
    if not rule.numeric_key:
        return head
    return F.when(head.rlike(f"^[0-9]{{{rule.leading}}}$"), head.try_cast("int"))


def classify(df: DataFrame, rule: ClassifyRule, groups: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Add group and label columns.  ``groups (group_key, group_code)`` and
    ``labels (group_code, group_label)`` are lookups; unknown codes stay NULL.  Without
    separate labels, ``groups`` has to carry ``group_label`` itself.  A key or code that a
    lookup repeats counts once, with its smallest group and label."""
    if labels is not None:
        named = labels.groupBy("group_code").agg(F.min("group_label").alias("group_label"))
        groups = groups.join(named, "group_code", "left")
    group = F.min(F.struct("group_code", "group_label")).alias("__group")
    groups = groups.groupBy(F.col("group_key").alias("__group_key")).agg(group).select(
        "__group_key",
        F.col("__group.group_code").alias(rule.group_column),
        F.col("__group.group_label").alias(rule.label_column),
    )
    keyed = df.withColumn("__group_key", leading_key(quoted(rule.column), rule))
    return lookup_join(keyed, groups, ["__group_key"]).drop("__group_key")


def classification_coverage(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Coded rows, classified rows and rows that failed, per (code, group) column pair."""
    counted = df.agg(
        *[F.count(quoted(code)).alias(f"c{i}") for i, (code, _) in enumerate(pairs)],
        *[F.count(quoted(group)).alias(f"g{i}") for i, (_, group) in enumerate(pairs)],
    )
    return counted.select(
        stack_rows(
            [
                [
                    ("code_column", F.lit(code)),
                    ("n_coded", F.col(f"c{i}")),
                    ("n_classified", F.col(f"g{i}")),
                    ("n_unclassified", F.col(f"c{i}") - F.col(f"g{i}")),
                ]
                for i, (code, _) in enumerate(pairs)
            ]
        )
    )


# ------------------------------------------------------------------------- version diff


def version_diff(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    both_present: bool = True,
) -> DataFrame:
    """``column, n_changed`` between two versions of a table, aligned on its key.  With
    ``both_present`` only rows that are filled in both versions can count.  The key has to
    be unique; a repeated key raises, because it would pair rows that do not belong together."""
    for side in (before, after):
        repeated = side.groupBy(*[quoted(k) for k in keys]).count().filter(F.col("count") > 1)
        if not repeated.isEmpty():
            raise ValueError(f"key {list(keys)} is not unique")
    return change_counts_of_pairs(before, after, keys, columns, both_present)


def change_counts_of_pairs(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    both_present: bool = True,
    null_keys: bool = True,
) -> DataFrame:
    """``column, n_changed`` of versions whose key is known to be unique.  Without NULLs in the
    keys of one side (``null_keys=False``) the keys are compared bare, so that tables bucketed by
    them join as they lie."""
    old = before.select(
        *[quoted(k).alias(f"k{i}") for i, k in enumerate(keys)],
        *[quoted(c).alias(f"b{i}") for i, c in enumerate(columns)],
    )
    new = after.select(
        *[quoted(k).alias(f"j{i}") for i, k in enumerate(keys)],
        *[quoted(c).alias(f"a{i}") for i, c in enumerate(columns)],
    )
    condition = F.lit(True)
    for i in range(len(keys)):
        k, j = F.col(f"k{i}"), F.col(f"j{i}")
        condition = condition & (k.eqNullSafe(j) if null_keys else k == j)
    joined = old.join(new, condition)
    measures = []
    for i in range(len(columns)):
        if both_present:
            differs = is_true(F.col(f"b{i}") != F.col(f"a{i}"))
        else:
            differs = changed(F.col(f"b{i}"), F.col(f"a{i}"))
        measures.append(F.count_if(differs).alias(f"n{i}"))
    return joined.agg(*measures).select(
        stack_rows(
            [[("column", F.lit(c)), ("n_changed", F.col(f"n{i}"))] for i, c in enumerate(columns)]
        )
    )

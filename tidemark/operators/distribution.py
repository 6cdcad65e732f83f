"""Frequency tables, shares, bins and other categorical profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import (
    lay_out,
    literal_table,
    percent,
    quoted,
    sql_name,
    stack_rows,
    strip,
    without_exponent,
)

from tidemark.operators.combine import Profile, answer
from tidemark.session import materialize


def value_counts(df: DataFrame, columns: Sequence[str], derived: Mapping[str, Column] | None = None) -> DataFrame:
    """``column, value, count`` for several columns in one scan.  Values are counted on
    the map side before the shuffle, so a value holding most rows costs one row per task.
    ``derived`` counts the values of expressions under names of their own."""
    names = [*columns, *(derived or {})]
    return (
        df.select(
            *[F.expr(f"CAST({sql_name(c)} AS STRING)").alias(c) for c in columns],
            *[value.cast("string").alias(name) for name, value in (derived or {}).items()],
        )
        .unpivot([], [sql_name(c) for c in names], "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _counts_of(df: DataFrame, column: str, counts: DataFrame | None) -> DataFrame:
    """The value counts of one column: out of ``counts`` of many, if these are known."""
    return value_counts(df, [column]) if counts is None else counts.filter(F.col("column") == column)


def frequency_table(
    df: DataFrame, column: str, labels: Mapping[str, str] | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """``code, label, count, pct_of_valid``, most frequent first.  A code without a label
    shows itself.  A column without values gives an empty table."""
    counts = _counts_of(df, column, counts)
    # one-row total as a scalar subquery: no window over the whole table
    total = counts.agg(F.sum("count").alias("n_valid")).scalar()
    named = literal_table(df.sparkSession, list((labels or {}).items()), "value string, label string")
    return (
        counts.join(F.broadcast(named), "value", "left")
        .select(
            F.col("value").alias("code"),
            F.coalesce("label", "value").alias("label"),
            "count",
            percent(F.col("count"), total).alias("pct_of_valid"),
        )
        .orderBy(F.desc("count"), "label")
    )


def filled_profile(columns: Sequence[str]) -> Profile:
    return Profile(
        {"n": F.count(F.lit(1)), **{f"c{i}": F.count(quoted(c)) for i, c in enumerate(columns)}},
        lambda counted: counted.select(
            stack_rows(
                [
                    [
                        ("column", F.lit(c)),
                        ("n_valid", F.col(f"c{i}")),
                        ("n_missing", F.col("n") - F.col(f"c{i}")),
                    ]
                    for i, c in enumerate(columns)
                ]
            )
        ),
    )


def valid_and_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_valid, n_missing``, the line printed over each frequency table."""
    return answer(df, filled_profile(columns))


def category_ranking(df: DataFrame, column: str) -> DataFrame:
    """Categories from rare to frequent, as a horizontal bar chart draws them."""
    return (
        value_counts(df, [column])
        .select(F.col("value").alias("label"), "count")
        .orderBy("count", F.desc("label"))
    )


def share_profile(column: str, categories: Sequence[str]) -> Profile:
    value = quoted(column).cast("string")
    valid = sum((F.col(f"n{i}") for i in range(1, len(categories))), F.col("n0"))
    return Profile(
        {"n_missing": F.count_if(value.isNull()), **{f"n{i}": F.count_if(value == c) for i, c in enumerate(categories)}},
        lambda counted: counted.select(
            stack_rows(
                [
                    [
                        ("category", F.lit(c)),
                        ("count", F.col(f"n{i}")),
                        ("n_valid", valid),
                        ("pct", percent(F.col(f"n{i}"), valid)),
                        ("n_missing", F.col("n_missing")),
                    ]
                    for i, c in enumerate(categories)
                ]
            )
        ),
    )


def category_share(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """Share of each listed category among the rows that hold one of them."""
    return answer(df, share_profile(column, categories))


def dominant_category(
    df: DataFrame, column: str, counts: DataFrame | None = None, n_rows: Column | None = None
) -> DataFrame:
    """The most frequent category with its share; among equals the first by name.  ``counts`` and
    ``n_rows`` are used where they are known."""
    counts = _counts_of(df, column, counts)
    n_rows = df.agg(F.count(F.lit(1)).alias("n")).scalar() if n_rows is None else n_rows
    best = F.min_by("value", F.struct(-F.col("count"), F.col("value")))
    return counts.agg(
        best.alias("label"), F.max("count").alias("count"), F.sum("count").alias("n_valid")
    ).select(
        "label",
        "count",
        percent(F.col("count"), F.col("n_valid")).alias("pct_of_valid"),
        (n_rows - F.coalesce(F.col("n_valid"), F.lit(0))).alias("n_missing"),
    )


def binned_profile(column: str, bins: Sequence[tuple[str, float, float]]) -> Profile:
    value = quoted(column).cast("double")
    position = F.coalesce(
        *[F.when((value >= low) & (value < high), F.lit(i)) for i, (_, low, high) in enumerate(bins)]
    )
    valid = sum((F.col(f"b{i}") for i in range(1, len(bins))), F.col("b0"))
    return Profile(
        {"n": F.count(F.lit(1)), **{f"b{i}": F.count_if(position == i) for i in range(len(bins))}},
        lambda counts: counts.select(
            stack_rows(
                [
                    [
                        ("bin", F.lit(i)),
                        ("label", F.lit(label)),
                        ("count", F.col(f"b{i}")),
                        ("pct_of_valid", percent(F.col(f"b{i}"), valid)),
                        ("n_missing", F.col("n") - valid),
                    ]
                    for i, (label, _, _) in enumerate(bins)
                ]
            )
        ),
    )


def binned_distribution(
    df: DataFrame, column: str, bins: Sequence[tuple[str, float, float]]
) -> DataFrame:
    """Counts per right-open bin ``[low, high)``, empty bins included; values outside every
    bin count as missing.  ``bins`` is a short declared list, so it becomes one CASE."""
    return answer(df, binned_profile(column, bins))


def casing_consistency(df: DataFrame, columns: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """False where values differ only by case or surrounding white space.  Two grouping steps,
    the wide one first, so nothing but the distinct values is shuffled."""
    distinct = value_counts(df, columns) if counts is None else counts.filter(F.col("column").isin(list(columns)))
    folded = distinct.groupBy("column", F.lower(strip("value")).alias("folded")).agg(
        F.count(F.lit(1)).alias("spellings")
    )
    found = folded.groupBy("column").agg((F.max("spellings") == 1).alias("consistent"))
    names = literal_table(df.sparkSession, [(c,) for c in columns], "column string")
    return names.join(found, "column", "left").select(
        "column", F.coalesce("consistent", F.lit(True)).alias("casing_consistent")
    )


def _distinct_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_values``: distinct values of each column, none for a column without values.
    128-bit digests are counted instead of the texts, which may be long."""
    digests = df.selectExpr(
        *[f"unhex(md5(encode(CAST({sql_name(c)} AS STRING), 'utf-8'))) AS {sql_name(c)}" for c in columns]
    )
    return (
        digests.unpivot([], [sql_name(c) for c in columns], "column", "digest")
        .filter(F.col("digest").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_values"))
    )


def value_sets(df: DataFrame, columns: Sequence[str] | None = None, max_values: int = 8) -> DataFrame:
    """``column, value_set_or_range``: few values are listed, many are counted, numbers
    show their range.  Which of these applies follows from the column's type and, for
    text, from its ``kind`` metadata (see ``recommend_types``)."""
    fields = {f.name: f for f in df.schema.fields}
    names = list(columns or df.columns)
    numeric = [c for c in names if isinstance(fields[c].dataType, T.NumericType)]
    listed = [c for c in names if c not in numeric]
    many_prefix = {
        c: ("" if fields[c].metadata.get("kind") == "category" else "free text (") for c in listed
    }
    parts = []
    plain_bool = [c for c in listed if isinstance(fields[c].dataType, T.BooleanType)]
    texts = [c for c in listed if c not in plain_bool]
    ranged_columns = [*numeric, *plain_bool]
    if ranged_columns:
        # NaN is a missing value and no end of a range
        fractional = (T.FloatType, T.DoubleType)
        known = [
            f"nanvl({sql_name(c)}, NULL)" if isinstance(fields[c].dataType, fractional) else sql_name(c) for c in ranged_columns
        ]
        ranged = df.selectExpr(
            *[f"min({value}) AS lo{i}" for i, value in enumerate(known)],
            *[f"max({value}) AS hi{i}" for i, value in enumerate(known)],
        )
        bounds = lay_out(
            ranged,
            "column string",
            [(c,) for c in ranged_columns],
            {
                side: [
                    f"initcap(CAST({side}{i} AS STRING))" if c in plain_bool else f"CAST({side}{i} AS STRING)"
                    for i, c in enumerate(ranged_columns)
                ]
                for side in ("lo", "hi")
            },
        )
        parts.append(
            bounds.select(
                "column",
                F.coalesce(
                    F.concat(without_exponent(F.col("lo")), F.lit("–"), without_exponent(F.col("hi"))), F.lit("")
                ).alias("value_set_or_range"),
            )
        )
    if texts:
        sizes = materialize(_distinct_sizes(df, texts), "value-set-sizes")
        # one row per column; the texts are fetched of those with a short value set alone, so
        # collect_set holds no more than max_values of them
        few = [r["column"] for r in sizes.filter(F.col("n_values") <= max_values).select("column").collect()]
        shown = "array_join(array_sort(collect_set(CAST({c} AS STRING))), '; ')"
        short = (
            lay_out(
                df.selectExpr(*[f"{shown.format(c=sql_name(c))} AS s{i}" for i, c in enumerate(few)]),
                "column string",
                [(c,) for c in few],
                {"shown": [f"s{i}" for i in range(len(few))]},
            )
            if few
            else literal_table(df.sparkSession, [], "column string, shown string")
        )
        all_names = literal_table(
            df.sparkSession, [(c, many_prefix[c]) for c in texts], "column string, opening string"
        )
        opening = F.col("opening")
        many = F.concat(
            opening,
            F.col("n_values").cast("string"),
            F.lit(" distinct values"),
            F.when(opening != "", F.lit(")")).otherwise(F.lit("")),
        )
        parts.append(
            all_names.join(sizes, "column", "left")
            .join(short, "column", "left")
            .select(
                "column",
                F.when(F.col("n_values").isNull(), F.lit(""))
                .otherwise(F.coalesce("shown", many))
                .alias("value_set_or_range"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def pseudo_key_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of columns that look like IDs, against the number of rows."""
    sizes = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    n_rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    names = literal_table(df.sparkSession, [(c,) for c in columns], "column string")
    return names.join(sizes, "column", "left").select(
        "column",
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        n_rows.alias("n_rows"),
        (F.coalesce("n_distinct", F.lit(0)) == n_rows).alias("is_key"),
    )


def width_condition(column: str, condition: str) -> Column:
    """A SQL condition on ``width``, the length of a text column.  The condition is evaluated
    on a value of that name, so no other part of it is touched."""
    met = f"element_at(transform(array(length({sql_name(column)})), width -> {condition}), 1)"
    return F.coalesce(F.expr(met), F.lit(False))


def code_width_check(df: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """Count codes whose length meets a condition on ``width``, e.g. ``("isic", "width <> 4")``."""
    measures = []
    for i, (column, condition) in enumerate(checks):
        width = F.length(quoted(column))
        measures += [
            F.count(quoted(column)).alias(f"c{i}"),
            F.count_if(width_condition(column, condition)).alias(f"n{i}"),
            F.min(width).alias(f"lo{i}"),
            F.max(width).alias(f"hi{i}"),
        ]
    return df.agg(*measures).select(
        stack_rows(
            [
                [
                    ("column", F.lit(column)),
                    ("condition", F.lit(condition)),
                    ("n_codes", F.col(f"c{i}")),
                    ("n_off_width", F.col(f"n{i}")),
                    ("min_width", F.col(f"lo{i}")),
                    ("max_width", F.col(f"hi{i}")),
                ]
                for i, (column, condition) in enumerate(checks)
            ]
        )
    )


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Columns whose metadata says ``kind`` (category, free_text, code, number, flag)."""
    return [f.name for f in df.schema.fields if f.metadata.get("kind") == kind]


def columns_with_suffix(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]

"""Missing-value profiles.  Each profile is one scan with one aggregate over all columns;
the single result row is then laid out as one row per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    is_true,
    lay_out,
    literal_table,
    percent,
    quoted,
    sql_name,
    stack_rows,
)
from tidemark.operators.combine import Profile, answer
from tidemark.spec import GateRule


def null_profile(columns: Sequence[str]) -> Profile:
    """``position, column, n_rows, n_missing`` for every column."""
    names = list(columns)
    return Profile(
        {"n": F.count(F.lit(1)), **{f"c{i}": F.expr(f"count({sql_name(c)})") for i, c in enumerate(names)}},
        lambda counted: lay_out(
            counted,
            "position int, column string",
            list(enumerate(names)),
            {"n_rows": ["n"] * len(names), "n_missing": [f"n - c{i}" for i in range(len(names))]},
        ),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``position, column, n_rows, n_missing`` for every column."""
    return answer(df, null_profile(columns or df.columns))


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_missing, pct_missing``, worst first, then in column order."""
    return missingness_of(null_counts(df, columns))


def missingness_of(counts: DataFrame) -> DataFrame:
    """The same from counts that are known."""
    return (
        counts.withColumn("pct_missing", percent(F.col("n_missing"), F.col("n_rows")))
        .orderBy(F.desc("pct_missing"), "position")
        .select("column", "n_missing", "pct_missing")
    )


def mean_missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Average share of missing values over all columns, in percent."""
    return mean_missingness_of(null_counts(df, columns))


def mean_missingness_of(counts: DataFrame) -> DataFrame:
    share = F.when(F.col("n_rows") > 0, F.col("n_missing") / F.col("n_rows")).otherwise(F.lit(0.0))
    return counts.agg(
        F.count(F.lit(1)).alias("n_columns"), F.round(F.avg(share) * 100, 4).alias("mean_pct_missing")
    )


def missingness_change(
    before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None, known_before: DataFrame | None = None
) -> DataFrame:
    """Percent missing of the columns present in both versions of a table.  ``known_before`` are the
    null counts of the earlier version, if it has been profiled already."""
    names = [c for c in (columns or before.columns) if c in before.columns and c in after.columns]
    counts = null_counts(before, names) if known_before is None else known_before.filter(F.col("column").isin(names))
    old = missingness_of(counts).select("column", F.col("pct_missing").alias("pct_before"))
    new = missingness(after, names).select("column", F.col("pct_missing").alias("pct_after"))
    return old.join(new, "column")


def raw_vs_cleaned(
    raw: DataFrame, cleaned: DataFrame, columns: Sequence[str], known_raw: DataFrame | None = None
) -> DataFrame:
    """Percent missing before and after cleaning as text; a column that a version does not
    have yet reads "N/A (derived column)".  ``known_raw`` are the null counts of the raw version."""
    absent = F.lit("N/A (derived column)")
    there = [c for c in columns if c in raw.columns]
    old = missingness_of(null_counts(raw, there) if known_raw is None else known_raw.filter(F.col("column").isin(there)))
    new = missingness(cleaned, [c for c in columns if c in cleaned.columns])
    wanted = df_of_names(raw, columns)
    return (
        wanted.join(old.select("column", F.col("pct_missing").alias("raw")), "column", "left")
        .join(new.select("column", F.col("pct_missing").alias("cleaned")), "column", "left")
        .select(
            "position",
            "column",
            F.coalesce(F.col("raw").cast("string"), absent).alias("pct_missing_raw"),
            F.coalesce(F.col("cleaned").cast("string"), absent).alias("pct_missing_cleaned"),
        )
    )


def df_of_names(like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The column names of a table as rows ``position, column``."""
    return literal_table(like.sparkSession, list(enumerate(columns)), "position int, column string")


def heavy_missing(profile: DataFrame, above: float = 90.0) -> DataFrame:
    """Columns of a missingness profile above the cut."""
    return profile.filter(F.col("pct_missing") > above)


def worst_columns(profile: DataFrame, n: int = 15) -> DataFrame:
    """The report's top-n columns by percent missing."""
    return profile.orderBy(F.desc("pct_missing"), F.desc("n_missing"), "column").limit(n)


def gate_profile(gates: Sequence[GateRule]) -> Profile:
    measures = {}
    for i, gate in enumerate(gates):
        missing = quoted(gate.dependent).isNull()
        applies = quoted(gate.gate).eqNullSafe(F.lit(gate.applies_when))
        measures[f"s{i}"] = F.count_if(missing & ~applies)
        measures[f"i{i}"] = F.count_if(missing & applies)
    return Profile(
        measures,
        lambda counted: counted.select(
            stack_rows(
                [
                    [
                        ("dependent_col", F.lit(gate.dependent)),
                        ("gate_col", F.lit(gate.gate)),
                        ("n_missing", F.col(f"s{i}") + F.col(f"i{i}")),
                        ("n_structural", F.col(f"s{i}")),
                        ("n_incidental", F.col(f"i{i}")),
                        ("pct_structural", percent(F.col(f"s{i}"), F.col(f"s{i}") + F.col(f"i{i}"))),
                    ]
                    for i, gate in enumerate(gates)
                ]
            )
        ),
    )


def gate_split(df: DataFrame, gates: Sequence[GateRule]) -> DataFrame:
    """Split the missing values of gated columns into structural (the gate says the
    question does not apply, an empty gate included) and incidental."""
    return answer(df, gate_profile(gates))


def mostly_incidental(split: DataFrame, below: float = 90.0) -> DataFrame:
    """Gated columns with missing values whose structural share is under the cut."""
    return split.filter((F.col("n_missing") > 0) & (F.col("pct_structural") < below))


def residual_missing(df: DataFrame, populations: Mapping[str, str | None]) -> DataFrame:
    """For each column: rows in its population (SQL condition, ``None`` = everyone), all
    missing values, and the missing values inside the population."""
    measures: list[Column] = []
    for i, (column, condition) in enumerate(populations.items()):
        inside = is_true(F.expr(condition)) if condition else F.lit(True)
        missing = quoted(column).isNull()
        measures += [
            F.count_if(inside).alias(f"p{i}"),
            F.count_if(missing).alias(f"m{i}"),
            F.count_if(missing & inside).alias(f"r{i}"),
        ]
    return df.agg(*measures).select(
        stack_rows(
            [
                [
                    ("column", F.lit(column)),
                    ("n_population", F.col(f"p{i}")),
                    ("n_missing", F.col(f"m{i}")),
                    ("n_incidental", F.col(f"r{i}")),
                ]
                for i, column in enumerate(populations)
            ]
        )
    )

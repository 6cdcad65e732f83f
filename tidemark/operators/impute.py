"""Median imputation inside a population, with a flag for every filled value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import is_true, quoted, stack_rows
from tidemark.operators.numeric import exact_quantiles
from tidemark.spec import ImputeRule

FLAG_SUFFIX = "_imputed"


@dataclass(frozen=True)
class Fill:
    rule: ImputeRule
    value: int | None


def fit_medians(
    df: DataFrame,
    rules: Sequence[ImputeRule],
    within_population: bool = False,
    sketches: DataFrame | None = None,
) -> list[Fill]:
    """The fill value of each rule: the median of all non-null values of the column, rounded
    half-even to a whole number.  ``within_population`` takes the median over the rule's
    population instead.  All columns are fitted together; ``sketches`` kept beside the table save
    a scan (not within a population, of which they say nothing)."""
    source = df
    if within_population:
        source = df.select(
            *[
                F.when(_population(rule), quoted(rule.column)).alias(rule.column)
                for rule in rules
            ]
        )
    medians = exact_quantiles(source, {rule.column: [0.5] for rule in rules}, None if within_population else sketches)
    fills = []
    for rule in rules:
        middle = medians[rule.column][1]
        # Python's round is half-even
        fills.append(Fill(rule, None if middle is None else round(middle[0])))
    return fills


def _population(rule: ImputeRule):
    return is_true(F.expr(rule.population)) if rule.population else F.lit(True)


def impute(df: DataFrame, fills: Sequence[Fill]) -> DataFrame:
    """Fill the gaps inside each population and add ``<column>_imputed``.  Gaps outside stay
    empty.  One projection for all columns; populations are judged on the data as it came."""
    types = dict(df.dtypes)
    columns = {}
    for fill in fills:
        name = fill.rule.column
        gap = quoted(name).isNull() & _population(fill.rule)
        if fill.value is None:
            gap = F.lit(False)
        filled = F.when(gap, F.lit(fill.value)).otherwise(quoted(name)).cast(types[name])
        columns[name] = filled.alias(name, metadata=df.schema[name].metadata)
        columns[name + FLAG_SUFFIX] = gap.alias(name + FLAG_SUFFIX, metadata={"kind": "flag"})
    kept = [columns.pop(c) if c in columns else quoted(c) for c in df.columns]
    return df.select(*kept, *columns.values())


def impute_median(
    df: DataFrame, column: str, population: str | None = None
) -> tuple[DataFrame, int | None]:
    """Fit and fill one column; also returns the fill value."""
    fills = fit_medians(df, [ImputeRule(column, population)])
    return impute(df, fills), fills[0].value


def imputation_ledger(df: DataFrame, fills: Sequence[Fill]) -> DataFrame:
    """``variable, method, n_imputed, fill_value, population`` from the flag columns."""
    counted = df.agg(
        *[F.count_if(quoted(f.rule.column + FLAG_SUFFIX)).alias(f"n{i}") for i, f in enumerate(fills)]
    )
    return counted.select(
        stack_rows(
            [
                [
                    ("variable", F.lit(f.rule.column)),
                    ("method", F.lit("Median")),
                    ("n_imputed", F.col(f"n{i}")),
                    ("fill_value", F.lit(f.value).cast("bigint")),
                    ("population", F.lit(f.rule.population_label)),
                ]
                for i, f in enumerate(fills)
            ]
        )
    )

"""Row rules: ranges, sentinels, derived totals, consistency, skip logic, outlier flags.

Everything here is row-local, so any number of rules runs in one scan; only the counts
need an aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    INTEGER_TYPES,
    changed,
    is_true,
    number_text,
    percent,
    quoted,
    stack_rows,
    whole_number_text,
)
from tidemark.operators.combine import Profile, answer
from tidemark.operators.numeric import exact_quantiles
from tidemark.spec import (
    ConsistencyRule,
    DerivedTotal,
    OutlierRule,
    RangeRule,
    SentinelRule,
    SkipRule,
)


# No number is above NaN but NaN itself, which compares as greater than any number.
_NAN = float("nan")


def above(value: Column, bound: float | Column) -> Column:
    """Above a bound; NaN counts as missing and is not.  Both comparisons can reach the scan."""
    return (value > bound) & (value < F.lit(_NAN))


def out_of_range(rule: RangeRule) -> Column:
    value = quoted(rule.column)
    tests = []
    if rule.low is not None:
        tests.append(value < F.lit(rule.low))
    if rule.high is not None:
        tests.append(above(value, F.lit(rule.high)))
    if not tests:
        return F.lit(False)
    # left as it is for NULL: a filter drops it, and a plain comparison reaches the scan
    return _any(tests)


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def range_violations(df: DataFrame, keys: Sequence[str], rules: Sequence[RangeRule]) -> DataFrame:
    """One row per value outside its bounds: keys, ``column, value``.  One scan for all rules."""
    hits = [
        F.when(
            out_of_range(rule),
            F.struct(F.lit(rule.column).alias("column"), quoted(rule.column).cast("double").alias("value")),
        )
        for rule in rules
    ]
    return (
        df.filter(_any([out_of_range(rule) for rule in rules]))
        .select(*[quoted(k) for k in keys], F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        .select(*[quoted(k) for k in keys], "hit.column", "hit.value")
    )


def _flagged_value(rule: RangeRule) -> Column:
    return F.when(out_of_range(rule), quoted(rule.column).cast("double"))


def range_profile(rules: Sequence[RangeRule]) -> Profile:
    measures = {}
    for i, rule in enumerate(rules):
        flagged = _flagged_value(rule)
        measures |= {f"n{i}": F.count(flagged), f"lo{i}": F.min(flagged), f"hi{i}": F.max(flagged)}
    return Profile(
        measures,
        lambda counted: counted.select(
            stack_rows(
                [
                    [
                        ("column", F.lit(rule.column)),
                        ("n_flagged", F.col(f"n{i}")),
                        ("is_sentinel", is_true(F.col(f"lo{i}") == F.col(f"hi{i}"))),
                        (
                            "sentinel_value",
                            F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}")),
                        ),
                    ]
                    for i, rule in enumerate(rules)
                ]
            )
        ),
    )


def range_summary(df: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """Per rule: flagged rows, and whether all of them hold one single value, which points
    to a sentinel rather than to scattered errors."""
    return answer(df, range_profile(rules))


def flagged_values(rules: Sequence[RangeRule]) -> dict[str, Column]:
    """What ``range_value_counts`` counts, for a scan that counts other values as well."""
    return {f"range {i}": _flagged_value(rule) for i, rule in enumerate(rules)}


def range_value_counts(df: DataFrame, rules: Sequence[RangeRule], counts: DataFrame | None = None) -> DataFrame:
    """``column, value, count`` of the out-of-range values; from value counts that hold
    ``flagged_values``, if they are known."""
    if counts is not None:
        names = {f"range {i}": rule.column for i, rule in enumerate(rules)}
        column = F.lit(None).cast("string")
        for name, c in names.items():
            column = F.when(F.col("column") == name, F.lit(c)).otherwise(column)
        found = counts.filter(F.col("column").isin(list(names)))
        # two rules on one column count their values together
        return (
            found.select(column.alias("column"), F.col("value").cast("double").alias("value"), "count")
            .groupBy("column", "value")
            .agg(F.sum("count").alias("count"))
        )
    return (
        range_violations(df, [], rules).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    )


def _replace(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """New values for columns, which keep their metadata."""
    known = {f.name: f.metadata for f in df.schema.fields}
    return df.withColumns(
        {c: value.alias(c, metadata=known.get(c) or {}) for c, value in columns.items()}
    )


def correct_sentinels(df: DataFrame, rules: Sequence[SentinelRule]) -> DataFrame:
    """Replace sentinels by NULL.  A projection; column types stay as they are."""
    corrected = {}
    for rule in rules:
        for column in rule.columns:
            value = corrected.get(column, quoted(column))
            corrected[column] = F.when(~is_true(value == F.lit(rule.value)), value)
    return _replace(df, corrected)


def sentinel_profile(rules: Sequence[SentinelRule]) -> Profile:
    pairs = [(column, rule.value) for rule in rules for column in rule.columns]
    return Profile(
        {"n": F.count(F.lit(1)), **{f"s{i}": F.count_if(quoted(c) == F.lit(v)) for i, (c, v) in enumerate(pairs)}},
        lambda counted: counted.select(
            stack_rows(
                [
                    [
                        ("column", F.lit(c)),
                        ("sentinel", F.lit(str(v))),
                        ("count", F.col(f"s{i}")),
                        ("pct", percent(F.col(f"s{i}"), F.col("n"))),
                    ]
                    for i, (c, v) in enumerate(pairs)
                ]
            )
        ),
    )


def sentinel_counts(df: DataFrame, rules: Sequence[SentinelRule]) -> DataFrame:
    """``column, sentinel, count, pct`` with the percentage over all rows."""
    return answer(df, sentinel_profile(rules))


def derived_totals(df: DataFrame, rules: Sequence[DerivedTotal]) -> dict[str, Column]:
    """New value of each derived column.  A missing part makes the total missing; a later
    rule sees the totals of the earlier ones.  Parts are widened first, so small integer
    types cannot overflow; the total keeps its column's type."""
    types = dict(df.dtypes)
    current: dict[str, Column] = {}
    for rule in rules:
        whole = all(types[p] in INTEGER_TYPES for p in rule.parts)
        wide = "bigint" if whole else "double"
        parts = [current.get(p, quoted(p)).cast(wide) for p in rule.parts]
        total = sum(parts[1:], parts[0])
        if rule.gate is not None:
            total = F.when(quoted(rule.gate).isNotNull(), total)
        types.setdefault(rule.target, wide)
        current[rule.target] = total.cast(types[rule.target])
    return current


def recompute_totals(df: DataFrame, rules: Sequence[DerivedTotal]) -> DataFrame:
    return _replace(df, derived_totals(df, rules))


def change_counts(df: DataFrame, after: dict[str, Column]) -> DataFrame:
    """``column, n_changed`` between the present columns of ``df`` and new values for them;
    becoming or ceasing to be NULL is a change."""
    names = list(after)
    counted = df.agg(
        *[F.count_if(changed(quoted(c), after[c])).alias(f"c{i}") for i, c in enumerate(names)]
    )
    return counted.select(
        stack_rows(
            [[("column", F.lit(c)), ("n_changed", F.col(f"c{i}"))] for i, c in enumerate(names)]
        )
    )


# --------------------------------------------------------------------------- flag rules


@dataclass(frozen=True)
class FlagRule:
    """A condition that marks a row, with what to write about it."""

    name: str
    condition: Column
    value: Column
    low: Column
    high: Column
    detail: Column


def _number(column: Column | None) -> Column:
    return F.lit(None).cast("double") if column is None else column.cast("double")


def consistency_flag(rule: ConsistencyRule) -> FlagRule:
    parts = [F.coalesce(quoted(p).cast("double"), F.lit(0.0)) for p in rule.parts]
    expected = sum(parts[1:], parts[0])
    total = quoted(rule.total).cast("double")
    detail = F.concat(
        F.lit("+".join(rule.parts) + "="),
        number_text(expected),
        F.lit(f" vs {rule.total}="),
        number_text(total),
    )
    return FlagRule(
        rule.name,
        F.abs(expected - total) > F.lit(rule.tolerance),
        total,
        expected - F.lit(rule.tolerance),
        expected + F.lit(rule.tolerance),
        detail,
    )


def skip_flag(rule: SkipRule) -> FlagRule:
    """The target is filled although no evidence condition holds; an unanswered evidence
    column is no evidence."""
    any_evidence = _any([is_true(F.expr(e)) for e in rule.evidence])
    return FlagRule(
        rule.name,
        ~any_evidence & quoted(rule.target).isNotNull(),
        _number(None),
        _number(None),
        _number(None),
        F.lit(rule.detail or f"no evidence in ({'; '.join(rule.evidence)}) but {rule.target} is filled"),
    )


def outlier_fences(
    df: DataFrame, rule: OutlierRule, sketches: DataFrame | None = None
) -> dict[str, tuple[float, float]]:
    """Tukey fences per column; columns with too few values or no spread have none.  ``sketches``
    kept beside the table save a scan."""
    present = [c for c in rule.columns if c in df.columns]
    fences = {}
    for column, (n, quartiles) in exact_quantiles(df, {c: [0.25, 0.75] for c in present}, sketches).items():
        if n < rule.min_valid or quartiles is None:
            continue
        low, high = quartiles
        spread = high - low
        if spread:
            fences[column] = (low - rule.multiplier * spread, high + rule.multiplier * spread)
    return fences


def outlier_flags(df: DataFrame, rule: OutlierRule) -> list[FlagRule]:
    flags = []
    for column, (low, high) in outlier_fences(df, rule).items():
        value = quoted(column).cast("double")
        detail = F.concat(
            F.lit(f"{column}="),
            number_text(value),
            F.lit(" outside IQR bounds ["),
            whole_number_text(F.lit(low)),
            F.lit(", "),
            whole_number_text(F.lit(high)),
            F.lit("]"),
        )
        flags.append(
            FlagRule(
                f"{rule.prefix}{column}",
                (value < F.lit(low)) | above(value, F.lit(high)),
                value,
                F.lit(low),
                F.lit(high),
                detail,
            )
        )
    return flags


FLAG_COLUMNS = "rule_name string, value double, low double, high double, detail string"


def flag_rows(df: DataFrame, keys: Sequence[str], rules: Sequence[FlagRule]) -> DataFrame:
    """Keys, ``rule_name, value, low, high, detail`` for every (row, rule) that applies.
    All rules share one scan, and rows without a flag leave before anything is built."""
    key_columns = [quoted(k) for k in keys]
    if not rules:
        empty = df.select(*key_columns).schema.simpleString()[len("struct<") : -1]
        names = ", ".join(filter(None, [empty.replace(":", " "), FLAG_COLUMNS]))
        return df.sparkSession.createDataFrame([], names)
    flagged = _any([rule.condition for rule in rules])
    entries = [
        F.when(
            rule.condition,
            F.struct(
                F.lit(rule.name).alias("rule_name"),
                _number(rule.value).alias("value"),
                _number(rule.low).alias("low"),
                _number(rule.high).alias("high"),
                rule.detail.alias("detail"),
            ),
        )
        for rule in rules
    ]
    return (
        df.filter(flagged)
        .select(*key_columns, F.explode(F.array(*entries)).alias("flag"))
        .filter(F.col("flag").isNotNull())
        .select(*key_columns, "flag.*")
    )


def flag_summary(flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flags, distinct flagged rows and distinct rules.  Flags are first reduced to one line
    per row, so one distinct count does not multiply the other."""
    per_row = flags.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("flags_on_row"))
    rows = per_row.agg(
        F.coalesce(F.sum("flags_on_row"), F.lit(0)).alias("n_flags"), F.count(F.lit(1)).alias("n_rows")
    )
    n_rules = flags.groupBy("rule_name").count().agg(F.count(F.lit(1)).alias("n_rules")).scalar()
    return rows.select("n_flags", "n_rows", n_rules.alias("n_rules"))


def flag_counts(flags: DataFrame) -> DataFrame:
    return flags.groupBy("rule_name").agg(F.count(F.lit(1)).alias("n_flags"))

"""Every number of the written report as rows ``section, item, metric, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import dedup, impute, lookup, missing, numeric, rules
from tidemark.operators.document import facts
from tidemark.plans.clean import flag_rules
from tidemark.plans.diagnose import Diagnosis
from tidemark.session import materialize
from tidemark.spec import DatasetSpec


def report_facts(
    spec: DatasetSpec,
    typed: DataFrame,
    cleaned: DataFrame,
    final: DataFrame,
    fills: list[impute.Fill],
    kept: DataFrame | None = None,
    flags: DataFrame | None = None,
    found: Diagnosis | None = None,
) -> DataFrame:
    """``kept`` and ``flags`` are what the cleaning has written already; without them the rows
    that survive are found again, and the cleaned table is flagged anew.  ``found`` is the diagnosis
    of the typed table: with it the table is not scanned again."""
    name = F.lit(spec.name)
    nulls = missing.null_counts(typed) if found is None else found.null_counts
    surplus = dedup.duplicate_count(typed, spec.keys) if found is None else found.surplus
    parts = [
        facts(
            "before",
            missing.mean_missingness_of(nulls).withColumn("item", name),
            "item",
            ["n_columns", "mean_pct_missing"],
        ),
        facts(
            "before",
            surplus.withColumn("item", name),
            "item",
            ["n_rows", "n_keys", "n_surplus"],
        ),
        facts(
            "after",
            missing.mean_missingness(final).withColumn("item", name),
            "item",
            ["n_columns", "mean_pct_missing"],
        ),
    ]
    if spec.scope_columns:
        change = missing.missingness_change(typed, cleaned, spec.scope_columns, nulls)
        parts.append(facts("missingness", change, "column", ["pct_before", "pct_after"]))
    if spec.sentinels:
        sentinels = rules.sentinel_counts(typed, spec.sentinels) if found is None else found.sentinels
        parts.append(facts("cleaning", sentinels, "column", ["count", "pct"]))
    classified = [(r.column, r.group_column) for r in spec.classify]
    if classified:
        coverage = lookup.classification_coverage(cleaned, classified)
        parts.append(facts("cleaning", coverage, "code_column", ["n_coded", "n_unclassified"]))
    if spec.free_text:
        # rows that the cleaning dropped have no later version: compare the surviving ones
        if kept is None:
            kept = dedup.keep_first(typed, spec.keys, spec.order_by)
        diff = lookup.version_diff(kept, cleaned, spec.keys, spec.free_text)
        parts.append(facts("cleaning", diff, "column", ["n_changed"]))
    if flags is None:
        flag_list = flag_rules(cleaned, spec)
        flags = materialize(rules.flag_rows(cleaned, spec.keys, flag_list), "flags") if flag_list else None
    if flags is not None:
        parts.append(
            facts("flags", rules.flag_counts(flags), "rule_name", ["n_flags"])
        )
        parts.append(
            facts(
                "flags",
                rules.flag_summary(flags, spec.keys).withColumn("item", name),
                "item",
                ["n_flags", "n_rows", "n_rules"],
            )
        )
    if fills:
        parts.append(
            facts("imputation", impute.imputation_ledger(final, fills), "variable", ["n_imputed", "fill_value"])
        )
    if spec.summary_columns:
        summary = numeric.numeric_summary(final, spec.summary_columns)
        parts.append(facts("after", summary, "column", ["mean", "median", "min", "max"]))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

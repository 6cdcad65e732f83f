"""The cleaning plan of one dataset, in its fixed order.

dedup -> consistency check on raw values -> sentinels -> derived totals -> flags -> reviewed
value map -> automatic consolidation -> classification.  All row-local steps collapse into
one projection; shuffles remain only where the work needs them (dedup, clusters, lookups
too large to broadcast).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import changed, quoted, stack_rows
from tidemark.operators import clusters, dedup, lookup, near_duplicates, rules
from tidemark.session import materialize, materialize_parts
from tidemark.sources.tables import LAYER_CODEC
from tidemark.spec import DatasetSpec

# Rows whose shuffle files lie on disk at once when a written layer is deduplicated.
SLICE_ROWS = 40_000_000


@dataclass(frozen=True)
class Hierarchy:
    """Lookup tables of one classification: ``groups (group_key, group_code)`` and
    ``labels (group_code, group_label)``."""

    groups: DataFrame
    labels: DataFrame


def row_rules(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Sentinels to NULL, then derived totals from the corrected parts."""
    corrected = rules.correct_sentinels(df, spec.sentinels)
    return rules.recompute_totals(corrected, spec.derived) if spec.derived else corrected


def flag_rules(df: DataFrame, spec: DatasetSpec) -> list[rules.FlagRule]:
    """The flag-only rules, fitted on the corrected table."""
    found = [rules.skip_flag(rule) for rule in spec.skips]
    if spec.outliers:
        found += rules.outlier_flags(df, spec.outliers)
    return found


def correction_metrics(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``step, item, value`` of the row-local steps: raw inconsistencies, sentinels replaced,
    totals changed.  Each measure is a condition on the row at its point in the order; one
    aggregate counts them all."""
    labels: list[tuple[str, str]] = [("dedup", "rows kept")]
    measured = df.withColumn("__m0", F.lit(True))

    def mark(table: DataFrame, found: list[tuple[str, str, Column]]) -> DataFrame:
        new = {f"__m{len(labels) + i}": condition for i, (_, _, condition) in enumerate(found)}
        labels.extend((step, item) for step, item, _ in found)
        return table.withColumns(new) if new else table

    raw = [
        ("raw_consistency", rule.name, rules.consistency_flag(rule).condition)
        for rule in spec.raw_consistency
    ]
    raw += [
        ("sentinel", column, quoted(column) == F.lit(rule.value))
        for rule in spec.sentinels
        for column in rule.columns
    ]
    measured = rules.correct_sentinels(mark(measured, raw), spec.sentinels)
    totals = rules.derived_totals(measured, spec.derived)
    measured = mark(
        measured, [("derived_total", c, changed(quoted(c), total)) for c, total in totals.items()]
    )
    counted = measured.agg(*[F.count_if(F.col(f"__m{i}")).alias(f"__m{i}") for i in range(len(labels))])
    return counted.select(
        stack_rows(
            [
                [("step", F.lit(step)), ("item", F.lit(item)), ("value", F.col(f"__m{i}"))]
                for i, (step, item) in enumerate(labels)
            ]
        )
    )


def _metric(df: DataFrame, step: str, item: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(step).alias("step"), item.alias("item"), value.cast("bigint").alias("value")
    )


class Cleaned:
    """The results of the plan, each worked out when it is first asked for.

    ``kept`` are the rows that survive the deduplication, as they came in.
    """

    def __init__(
        self,
        df: DataFrame,
        spec: DatasetSpec,
        hierarchies: Mapping[str, Hierarchy],
        pairs: DataFrame | None,
        repeated: DataFrame | None = None,
        n_rows: int = 0,
    ) -> None:
        self._df, self._spec, self._hierarchies, self._pairs = df, spec, hierarchies, pairs
        slices = max(1, -(-n_rows // SLICE_ROWS))
        kept = dedup.keep_first_parts(df, spec.keys, spec.order_by, repeated=repeated, slices=slices)
        # without repeated keys there is nothing to write
        self.kept = df if kept[0] is df else materialize_parts(kept, "deduplicated", LAYER_CODEC)

    @cached_property
    def _corrected(self) -> DataFrame:
        return row_rules(self.kept, self._spec)

    @cached_property
    def flags(self) -> DataFrame:
        found = flag_rules(self._corrected, self._spec)
        return materialize(rules.flag_rows(self._corrected, self._spec.keys, found), "flags")

    @cached_property
    def _reviewed(self) -> DataFrame:
        return lookup.mapping_table(self._df, self._spec.value_map)

    @property
    def _mapped_columns(self) -> list[str]:
        return sorted({column for column, _, _ in self._spec.value_map})

    @cached_property
    def _mapped(self) -> DataFrame:
        if not self._spec.value_map:
            return self._corrected
        return lookup.apply_value_map(self._corrected, self._reviewed, self._mapped_columns)

    @property
    def _with_free_text(self) -> DataFrame:
        """Rows with the texts that are consolidated; reviewed values of other columns need not be looked up."""
        return self._mapped if set(self._mapped_columns) & set(self._spec.free_text) else self._corrected

    @cached_property
    def mapping(self) -> DataFrame | None:
        spec, pairs = self._spec, self._pairs
        if not spec.free_text:
            return None
        if pairs is None:
            pairs = near_duplicates.near_duplicates(self._with_free_text, spec.free_text, spec.near_duplicate_threshold)
        return clusters.consolidation_map(pairs, spec.merge_threshold)

    @cached_property
    def table(self) -> DataFrame:
        table = self._mapped
        if self.mapping is not None:
            table = lookup.apply_value_map(table, self.mapping, self._spec.free_text)
        for rule in self._spec.classify:
            hierarchy = self._hierarchies[rule.lookup]
            table = lookup.classify(table, rule, hierarchy.groups, hierarchy.labels)
        return table

    @cached_property
    def metrics(self) -> DataFrame:
        spec = self._spec
        n_kept = self.kept.agg(F.count(F.lit(1)).alias("n")).scalar()
        metrics = _metric(
            self._df.agg(F.count(F.lit(1)).alias("n")), "dedup", F.lit("rows dropped"), F.col("n") - n_kept
        )
        metrics = metrics.unionByName(correction_metrics(self.kept, spec))
        summary = rules.flag_summary(self.flags, spec.keys)
        for column, label in (("n_flags", "flags"), ("n_rows", "flagged rows"), ("n_rules", "rules")):
            metrics = metrics.unionByName(_metric(summary, "flags", F.lit(label), F.col(column)))
        if spec.value_map:
            effect = lookup.mapping_effect(self._corrected, self._reviewed, self._mapped_columns)
            metrics = metrics.unionByName(_metric(effect, "value_map", F.col("column"), F.col("n_rows_affected")))
        if self.mapping is not None:
            merged = clusters.consolidation_summary(self.mapping)
            metrics = metrics.unionByName(_metric(merged, "variants_merged", F.col("column"), F.col("n_variants")))
            effect = lookup.mapping_effect(self._with_free_text, self.mapping, spec.free_text)
            metrics = metrics.unionByName(
                _metric(effect, "rows_consolidated", F.col("column"), F.col("n_rows_affected"))
            )
        if spec.classify:
            classified = [(rule.column, rule.group_column) for rule in spec.classify]
            coverage = lookup.classification_coverage(self.table, classified)
            for column in ("n_coded", "n_classified"):
                metrics = metrics.unionByName(_metric(coverage, column, F.col("code_column"), F.col(column)))
        return metrics


def clean(
    df: DataFrame,
    spec: DatasetSpec,
    hierarchies: Mapping[str, Hierarchy] | None = None,
    pairs: DataFrame | None = None,
    repeated: DataFrame | None = None,
    n_rows: int = 0,
) -> Cleaned:
    """Run the plan.  ``pairs`` are near-duplicate pairs and ``repeated`` the repeated keys of ``df``, found earlier
    (by the diagnosis); without them they are computed here, the pairs from the corrected text columns.  Rows are
    deduplicated at once; flags, mapping, table and metrics cost nothing unless they are read.  With ``n_rows``, for a
    layer that is cheap to scan, more than ``SLICE_ROWS`` of them are deduplicated a slice of the keys at a time."""
    hierarchies = hierarchies or {}
    for rule in spec.classify:
        if hierarchies.get(rule.lookup) is None:
            raise ValueError(f"no hierarchy named '{rule.lookup}' was given for {rule.column}")
    return Cleaned(df, spec, hierarchies, pairs, repeated, n_rows)

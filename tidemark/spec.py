"""Rules that describe one dataset.  Operators take these as parameters; no column name
is written into operator code.  Conditions are Spark SQL expression strings, so a spec
stays plain data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RangeRule:
    """Valid values lie in ``[low, high]``; ``None`` leaves that side open."""

    column: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class SentinelRule:
    """``value`` in any of ``columns`` stands for "unknown"."""

    columns: tuple[str, ...]
    value: float | str
    severity: str = "Low"
    addressed_by: str = "correct_sentinels"


@dataclass(frozen=True)
class MissingRule:
    """Missing values of ``column`` are a finding.  Where ``asked`` (a SQL condition) does not
    hold a value cannot be expected: if all gaps lie there the finding is structural."""

    column: str
    asked: str | None = None
    severity: str = "Low"
    addressed_by: str = "flagged only"


@dataclass(frozen=True)
class GateRule:
    """``dependent`` is only asked when ``gate`` equals ``applies_when``."""

    dependent: str
    gate: str
    applies_when: str | float


@dataclass(frozen=True)
class DerivedTotal:
    """``target`` is the sum of ``parts`` on rows where ``gate`` is filled."""

    target: str
    parts: tuple[str, ...]
    gate: str | None = None


@dataclass(frozen=True)
class ConsistencyRule:
    """The parts (missing ones count as 0) must add up to ``total`` within ``tolerance``."""

    name: str
    parts: tuple[str, ...]
    total: str
    tolerance: float = 1.0
    severity: str = "Low"
    addressed_by: str = "recompute_totals"


@dataclass(frozen=True)
class SkipRule:
    """``target`` must be empty unless one of the ``evidence`` conditions holds."""

    name: str
    target: str
    evidence: tuple[str, ...]
    detail: str = ""


@dataclass(frozen=True)
class OutlierRule:
    """Tukey fences on each column."""

    columns: tuple[str, ...]
    multiplier: float = 1.5
    min_valid: int = 10
    prefix: str = "outlier_"


@dataclass(frozen=True)
class ImputeRule:
    """Fill ``column`` with its median where ``population`` (SQL condition) holds."""

    column: str
    population: str | None = None
    population_label: str = "Everyone"


@dataclass(frozen=True)
class ClassifyRule:
    """Look a code up in a hierarchy after padding it to ``width``.

    ``leading`` digits of the padded code form the lookup key; ``numeric_key`` compares
    them as a number.  ``blank_is_code`` says whether a blank code is padded like any
    other or left unclassified.
    """

    column: str
    group_column: str
    label_column: str
    lookup: str
    width: int = 4
    leading: int = 1
    numeric_key: bool = False
    blank_is_code: bool = False


@dataclass(frozen=True)
class CodeWidthRule:
    """Count codes by length; ``condition`` is applied to the column ``width``."""

    column: str
    issue: str
    condition: str
    severity: str = "Low"
    addressed_by: str = ""


@dataclass(frozen=True)
class FrequencySpec:
    title: str
    column: str


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    keys: tuple[str, ...]
    entity: str | None = None
    # what an honest "keep first" needs: a total order (defaults to every column)
    order_by: tuple[str, ...] = ()
    expected_rows: int | None = None
    expected_entities: int | None = None
    ranges: tuple[RangeRule, ...] = ()
    sentinels: tuple[SentinelRule, ...] = ()
    gates: tuple[GateRule, ...] = ()
    derived: tuple[DerivedTotal, ...] = ()
    raw_consistency: tuple[ConsistencyRule, ...] = ()
    skips: tuple[SkipRule, ...] = ()
    outliers: OutlierRule | None = None
    free_text: tuple[str, ...] = ()
    near_duplicate_threshold: float = 0.95
    merge_threshold: float = 0.98
    # (column, from_value, to_value), reviewed by hand
    value_map: tuple[tuple[str, str, str], ...] = ()
    classify: tuple[ClassifyRule, ...] = ()
    impute: tuple[ImputeRule, ...] = ()
    left_missing: tuple[str, ...] = ()
    code_widths: tuple[CodeWidthRule, ...] = ()
    # gaps that the problem inventory lists
    missing_findings: tuple[MissingRule, ...] = ()
    pseudo_keys: tuple[str, ...] = ()
    frequencies: tuple[FrequencySpec, ...] = ()
    bins: tuple[tuple[str, Sequence[tuple[str, float, float]]], ...] = ()
    share: tuple[str, tuple[str, ...]] | None = None
    dominant: str | None = None
    summary_columns: tuple[str, ...] = ()
    scope_columns: tuple[str, ...] = ()
    derived_labels: dict[str, str] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

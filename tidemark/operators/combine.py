"""Several profiles of one table from one scan.

A profile that needs only counts is a set of aggregates and a way to lay their one row out.  Asked
alone it scans the table for itself; asked together, all aggregates run in one scan (equal ones
once), the row is written, and every profile reads its own part of that row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


@dataclass(frozen=True)
class Profile:
    measures: Mapping[str, Column]
    layout: Callable[[DataFrame], DataFrame]


def answer(df: DataFrame, profile: Profile) -> DataFrame:
    """One profile by a scan of its own."""
    return profile.layout(df.agg(*[measure.alias(name) for name, measure in profile.measures.items()]))


def answer_all(df: DataFrame, profiles: Mapping[str, Profile], label: str = "profiles") -> dict[str, DataFrame]:
    """All profiles by one scan.  Only one row is written; laying it out reads no more than that."""
    if not profiles:
        return {}
    names = {title: {m: f"p{i}_{m}" for m in profile.measures} for i, (title, profile) in enumerate(profiles.items())}
    row = materialize(
        df.agg(*[measure.alias(names[title][m]) for title, p in profiles.items() for m, measure in p.measures.items()]),
        label,
    )
    return {
        title: profile.layout(row.select(*[F.col(long).alias(m) for m, long in names[title].items()]))
        for title, profile in profiles.items()
    }

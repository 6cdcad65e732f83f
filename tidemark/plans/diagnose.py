"""The diagnosis of one dataset: every profile its spec asks for, and what follows from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import percent
from tidemark.operators import dedup, distribution, document, missing, near_duplicates, rules
from tidemark.operators.combine import Profile, answer_all
from tidemark.session import materialize
from tidemark.spec import DatasetSpec


@dataclass
class Diagnosis:
    missingness: DataFrame
    duplicates: DataFrame
    # what later stages ask about the same table: its size, null counts, sentinels, surplus rows and repeated keys
    n_rows: int = 0
    null_counts: DataFrame | None = None
    sentinels: DataFrame | None = None
    surplus: DataFrame | None = None
    repeated: DataFrame | None = None
    inventory: DataFrame | None = None
    share: DataFrame | None = None
    dominant: DataFrame | None = None
    range_summary: DataFrame | None = None
    range_values: DataFrame | None = None
    filled: DataFrame | None = None
    gate_split: DataFrame | None = None
    near_duplicates: DataFrame | None = None
    casing: DataFrame | None = None
    distributions: dict[str, DataFrame] = field(default_factory=dict)
    recommendations: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        named = {
            "missingness": self.missingness,
            "duplicates": self.duplicates,
            "range_summary": self.range_summary,
            "range_values": self.range_values,
            "filled": self.filled,
            "gate_split": self.gate_split,
            "near_duplicates": self.near_duplicates,
            "casing": self.casing,
            "recommendations": self.recommendations,
        }
        return {name: table for name, table in named.items() if table is not None}


def _check(
    table: DataFrame, check: str, item: Column, passed: Column, count: Column, detail: Column
) -> DataFrame:
    return table.select(
        F.lit(check).alias("check"),
        item.cast("string").alias("item"),
        passed.alias("passed"),
        count.cast("bigint").alias("n"),
        detail.cast("string").alias("detail"),
    )


def recommendations(spec: DatasetSpec, found: Diagnosis) -> DataFrame:
    """``check, item, passed, n, detail``: the rules a reviewer reads the profiles by."""
    nothing = F.lit(None)
    n_rows = F.lit(found.n_rows)
    duplicated = found.duplicates.agg(F.count(F.lit(1)).alias("n")).withColumn("pct", percent(F.col("n"), n_rows))
    parts = [
        _check(
            duplicated,
            "unique_key",
            F.lit("+".join(spec.keys)),
            F.col("n") == 0,
            F.col("n"),
            F.when(F.col("n") == 0, F.lit("no key repeats")).otherwise(
                F.concat(F.col("pct").cast("string"), F.lit(" percent of the rows share a key"))
            ),
        ),
        _check(
            missing.heavy_missing(found.missingness).agg(F.count(F.lit(1)).alias("n")),
            "heavy_missing",
            F.lit("columns above 90 percent missing"),
            F.col("n") == 0,
            F.col("n"),
            nothing,
        ),
    ]
    if found.range_summary is not None:
        parts.append(
            _check(
                found.range_summary,
                "range",
                F.col("column"),
                F.col("n_flagged") == 0,
                F.col("n_flagged"),
                F.when(F.col("n_flagged") == 0, F.lit("within bounds"))
                .when(F.col("is_sentinel"), F.lit("one value only: treat as a sentinel"))
                .otherwise(F.lit("inspect before cleaning")),
            )
        )
    if found.gate_split is not None:
        flagged = (F.col("n_missing") > 0) & (F.col("pct_structural") < 90)
        parts.append(
            _check(
                found.gate_split,
                "gate",
                F.col("dependent_col"),
                ~flagged,
                F.col("n_incidental"),
                F.when(flagged, F.lit("real nonresponse")).otherwise(F.lit("structural")),
            )
        )
    if spec.share:
        parts.append(
            _check(found.share, "share", F.col("category"), F.lit(True), F.col("count"), F.col("pct"))
        )
    if spec.dominant:
        parts.append(
            _check(found.dominant, "dominant", F.col("label"), F.lit(True), F.col("count"), F.col("pct_of_valid"))
        )
    if found.near_duplicates is not None:
        pairs = found.near_duplicates.agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            _check(pairs, "near_duplicates", F.lit("value pairs"), F.col("n") == 0, F.col("n"), nothing)
        )
    if found.casing is not None:
        mixed = found.casing.agg(F.count_if(~F.col("casing_consistent")).alias("n"))
        parts.append(
            _check(mixed, "casing", F.lit("columns with variants"), F.col("n") == 0, F.col("n"), nothing)
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def diagnose(df: DataFrame, spec: DatasetSpec) -> Diagnosis:
    """Profiles of a typed table, from three scans.  Nothing is changed.

    All counts of rows share one scan, all counts of values (categories, free texts, values out of
    range) the second, and the third counts the keys.  What these give is written once; every
    profile is laid out from that.
    """
    categories = distribution.columns_of_kind(df, "category")
    counted = [wanted.column for wanted in spec.frequencies]
    asked: dict[str, Profile] = {
        "rows": Profile({"n": F.count(F.lit(1))}, lambda row: row),
        "nulls": missing.null_profile(df.columns),
        "inventory": document.inventory_profile(spec),
    }
    if spec.ranges:
        asked["ranges"] = rules.range_profile(spec.ranges)
    if spec.gates:
        asked["gates"] = missing.gate_profile(spec.gates)
    if counted:
        asked["filled"] = distribution.filled_profile(counted)
    if spec.share:
        asked["share"] = distribution.share_profile(*spec.share)
    if spec.sentinels:
        asked["sentinels"] = rules.sentinel_profile(spec.sentinels)
    for i, (column, bins) in enumerate(spec.bins):
        asked[f"bins {i}"] = distribution.binned_profile(column, bins)
    answers = answer_all(df, asked, "diagnosis-counts")

    names = [*dict.fromkeys([*categories, *counted, *([spec.dominant] if spec.dominant else []), *spec.free_text])]
    flagged = rules.flagged_values(spec.ranges)
    values = materialize(distribution.value_counts(df, names, flagged), "diagnosis-values") if names or flagged else None
    repeated = dedup.repeated_keys(df, spec.keys)

    n_rows = answers["rows"].first()["n"]
    found = Diagnosis(
        missingness=missing.missingness_of(answers["nulls"]),
        duplicates=dedup.keys_of_copies(repeated),
        n_rows=n_rows,
        null_counts=answers["nulls"],
        sentinels=answers.get("sentinels"),
        inventory=answers["inventory"],
        surplus=dedup.counts_of_copies(repeated, n_rows),
        repeated=repeated,
        range_summary=answers.get("ranges"),
        gate_split=answers.get("gates"),
        filled=answers.get("filled"),
        share=answers.get("share"),
    )
    if spec.ranges:
        found.range_values = rules.range_value_counts(df, spec.ranges, values)
    if spec.dominant:
        found.dominant = distribution.dominant_category(df, spec.dominant, values, F.lit(n_rows))
    if spec.free_text:
        found.near_duplicates = materialize(
            near_duplicates.near_duplicates(df, spec.free_text, spec.near_duplicate_threshold, counts=values),
            "near-duplicates",
        )
    if categories:
        found.casing = distribution.casing_consistency(df, categories, values)
    for wanted in spec.frequencies:
        found.distributions[wanted.title] = distribution.frequency_table(df, wanted.column, counts=values)
    for i, (column, _) in enumerate(spec.bins):
        found.distributions[f"{column} (binned)"] = answers[f"bins {i}"]
    found.recommendations = recommendations(spec, found)
    return found

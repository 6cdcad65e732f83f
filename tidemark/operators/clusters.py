"""Group near-duplicate values and choose one spelling per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.graph import star_components
from tidemark.operators.lookup import lookup_join
from tidemark.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``column, value, component`` for undirected edges ``column, a, b``; the component is
    the smallest value it contains.  Only values with an edge to another value appear."""
    found = star_components(edges.select("column", "a", "b"), ["column"])
    return found.withColumnRenamed("node", "value")


def close_pairs(pairs: DataFrame, min_similarity: float = 0.98) -> DataFrame:
    """Pairs to merge.  The cut applies to the similarity as reported, at 3 decimals."""
    return pairs.filter(F.col("similarity") >= min_similarity)


def consolidation_map(pairs: DataFrame, min_similarity: float = 0.98) -> DataFrame:
    """``column, from_value, to_value``: every value of a cluster of close pairs maps to the
    cluster's most frequent value (the greatest one among equals)."""
    close = materialize(close_pairs(pairs, min_similarity), "close-pairs")
    components = connected_components(
        close.select("column", F.col("value_a").alias("a"), F.col("value_b").alias("b"))
    )
    counts = (
        close.select("column", F.col("value_a").alias("value"), F.col("count_a").alias("count"))
        .unionByName(
            close.select("column", F.col("value_b").alias("value"), F.col("count_b").alias("count"))
        )
        .groupBy("column", "value")
        .agg(F.max("count").alias("count"))
    )
    members = components.join(counts, ["column", "value"])
    chosen = members.groupBy("column", "component").agg(
        F.max(F.struct("count", "value")).getField("value").alias("to_value")
    )
    mapped = lookup_join(members, chosen, ["column", "component"])
    return materialize(
        mapped.filter(F.col("value") != F.col("to_value")).select(
            "column", F.col("value").alias("from_value"), "to_value"
        ),
        "consolidation",
    )


def consolidation_summary(mapping: DataFrame) -> DataFrame:
    """``column, n_variants`` merged into another spelling."""
    return mapping.groupBy("column").agg(F.count(F.lit(1)).alias("n_variants"))

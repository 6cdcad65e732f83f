"""Row numbers within groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

ROWS = 250_000  # rows of a range, about


def numbered(rows: DataFrame, group: str, order: list[Column], label: str, per_range: int = ROWS) -> DataFrame:
    """``rows`` with ``pos`` (from 0, gapless in each group) and ``members``, the rows of the group.

    The rows are dealt by ranges of group and order, so a group that holds most rows is spread over
    many tasks; each range is numbered on its own and the few counts of the ranges give each its
    start.  Nulls are a group like any other.  Rows that agree in group and order are numbered in
    any order; they too may lie in several ranges.  An empty table gives no rows.
    """
    rows = materialize(rows.withColumn("__tag", F.monotonically_increasing_id()), f"{label}-rows")
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // per_range))
    keys = [F.col(group).asc_nulls_first(), *order, F.col("__tag").asc()]
    dealt = materialize(
        rows.repartitionByRange(ranges, *keys).withColumn("__range", F.spark_partition_id()), f"{label}-ranges"
    )
    counts = dealt.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("__g"),
        F.col("__range").alias("__r"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"),
        F.sum("__rows").over(Window.partitionBy(group)).alias("members"),
    )
    within = Window.partitionBy(group, "__range").orderBy(*order, F.col("__tag").asc())
    return (
        dealt.withColumn("__inside", F.row_number().over(within).cast("long") - F.lit(1))
        .join(starts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__r")))
        .withColumn("pos", F.col("__start") + F.col("__inside"))
        .drop("__g", "__r", "__start", "__inside", "__range", "__tag")
    )

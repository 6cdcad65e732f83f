"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

# The white space of ASCII, which separates words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: Column | str) -> Column:
    """crc32 of an id written as text; a null id stays null."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    while any(n.lower() in taken for n in names):
        names = tuple(f"{n}_" for n in names)
    return list(names)


def pieces_for(rows: int, per_piece: int, least: int = 1) -> int:
    return max(least, -(-rows // per_piece))


def running_start(
    df: DataFrame, group: str, order: list[str], value: Column, spread: Column, rows_per_piece: int, label: str
) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of the same group that come
    earlier, in the order of ``spread`` (a uniform hash) and then of ``order``.

    Each group's hash range is cut into equal pieces, so that a group which holds most rows is
    spread over many tasks.  Sums are taken within a piece; the totals of the pieces, of which
    there are few, give each piece its start.  A piece whose rows share one hash (repeated
    rows) is cut again by the row's random tag.  ``df`` is written out first: its rows must not
    change between the two passes.
    """
    df = df.withColumns({"__spread": spread, "__value": value, "__tag": F.monotonically_increasing_id()})
    df = materialize(df, label)
    # the number of pieces follows the number of rows; 2**20 cells divide the hash range
    n = min(1 << 20, pieces_for(df.count(), rows_per_piece, 16))
    cell = F.floor(F.shiftrightunsigned(F.col("__spread"), 32) * F.lit(float(n)) / F.lit(float(1 << 32)))
    df = df.withColumn("__piece", cell.cast("long"))
    sizes = df.groupBy(group, "__piece").agg(F.count(F.lit(1)).alias("__rows"))
    heavy = sizes.filter(F.col("__rows") > 8 * rows_per_piece).select(
        F.col(group).alias("__g"), F.col("__piece").alias("__p"), F.ceil(F.col("__rows") / rows_per_piece).alias("__cuts")
    )
    # only repeated rows can fill a piece that far: at most one piece in 8 * n is heavy
    if not heavy.isEmpty():
        df = (
            df.join(heavy, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__piece") == F.col("__p")), "left")
            .withColumn("__cut", F.coalesce(F.pmod(F.xxhash64("__tag"), F.col("__cuts")), F.lit(0).cast("long")))
            .drop("__g", "__p", "__cuts")
        )
    else:
        df = df.withColumn("__cut", F.lit(0).cast("long"))
    totals = df.groupBy(group, "__piece", "__cut").agg(F.sum("__value").alias("__total"))
    starts = totals.select(
        F.col(group).alias("__g"),
        F.col("__piece").alias("__p"),
        F.col("__cut").alias("__c"),
        (
            F.sum("__total").over(
                Window.partitionBy(group)
                .orderBy("__piece", "__cut")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            - F.col("__total")
        ).alias("__start"),
    )
    within = Window.partitionBy(group, "__piece", "__cut").orderBy("__spread", *order, "__tag")
    df = df.withColumn(
        "__inside",
        F.sum("__value").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__value"),
    )
    return (
        df.join(
            starts,
            F.col(group).eqNullSafe(F.col("__g"))
            & (F.col("__piece") == F.col("__p"))
            & (F.col("__cut") == F.col("__c")),
        )
        .withColumn("before", F.col("__start") + F.col("__inside"))
        .drop("__g", "__p", "__c", "__start", "__inside", "__piece", "__cut", "__spread", "__value", "__tag")
    )

"""Mergeable sketches of numeric columns, kept beside a layer.

A sketch row describes one column of one batch of rows: how many values, their sum, least and
greatest, and a KLL sketch of their ranks.  Rows of several batches merge, so a layer that grows
by files adds the rows of the new files alone, and no old file is read again.  A sketch only says
where to look; results stay exact because the operators count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import sql_name
from tidemark.session import materialize

# Size parameter of the sketches: about three times as many values are kept at most.
ACCURACY = 8_192
_LEAST, _MOST = 8, 65_535
# Sketches of tasks are merged in so many pieces before those of a column meet.
_PIECES = 64


def is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def usable_sql(df: DataFrame, column: str) -> str:
    """A column of whole numbers as bigint, which keeps every digit; any other as double, NaN
    read as missing.  Infinity is a value like any other."""
    name = sql_name(column)
    return f"CAST({name} AS BIGINT)" if is_whole(df, column) else f"nanvl(CAST({name} AS DOUBLE), NULL)"


def rank_error(accuracy: int) -> float:
    """Share of the ranks by which a sketch is off at most, but for one query in a hundred
    (the published error of KLL sketches)."""
    return 2.296 / accuracy**0.9021


@dataclass(frozen=True)
class Extent:
    """What is known exactly about a column."""

    n: int
    low: float | int | None
    high: float | int | None
    total: float | None
    accuracy: int
    whole: bool


def column_sketches(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """``column, whole, accuracy, n, total, low_whole, high_whole, low_real, high_real, sketch``:
    one row for each column, from one scan.  A column without values has n = 0, NULL measures
    and an empty sketch; an empty table gives no rows."""
    if not _LEAST <= accuracy <= _MOST:
        raise ValueError(f"accuracy has to lie between {_LEAST} and {_MOST}")
    columns = list(dict.fromkeys(columns))
    values = df.select(
        F.pmod(F.spark_partition_id(), F.lit(_PIECES)).alias("piece"),
        *[F.expr(usable_sql(df, c)).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    measured = []
    for i, c in enumerate(columns):
        value, whole = F.col(f"v{i}"), is_whole(df, c)
        sketch = F.kll_sketch_agg_bigint(value, accuracy) if whole else F.kll_sketch_agg_double(value, accuracy)
        none = F.lit(None)
        measured.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(whole).alias("whole"),
                F.lit(accuracy).alias("accuracy"),
                F.count(value).alias("n"),
                F.sum(value.cast("double")).alias("total"),
                *[
                    (f(value) if kind == whole else none).cast("bigint" if kind else "double").alias(name)
                    for name, f, kind in (
                        ("low_whole", F.min, True),
                        ("high_whole", F.max, True),
                        ("low_real", F.min, False),
                        ("high_real", F.max, False),
                    )
                ],
                sketch.alias("sketch"),
            ).alias(f"x{i}")
        )
    pieces = values.groupBy("piece").agg(*measured)
    rows = pieces.select(F.inline(F.array(*[F.col(f"x{i}") for i in range(len(columns))])))
    return merge_sketches(rows)


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row for each column from those of all batches.  A column that changed between whole
    and real numbers cannot be merged; it keeps a row of each kind, which reading refuses."""
    whole = F.col("whole")
    return sketches.groupBy("column", "whole").agg(
        F.min("accuracy").alias("accuracy"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("low_whole").alias("low_whole"),
        F.max("high_whole").alias("high_whole"),
        F.min("low_real").alias("low_real"),
        F.max("high_real").alias("high_real"),
        F.when(F.first("whole"), F.kll_merge_agg_bigint(F.when(whole, F.col("sketch"))))
        .otherwise(F.kll_merge_agg_double(F.when(~whole, F.col("sketch"))))
        .alias("sketch"),
    )


def write_sketches(df: DataFrame, columns: Sequence[str], path: str, accuracy: int = ACCURACY) -> DataFrame:
    """Add the sketches of a batch of rows to those at ``path`` and return all of them, merged."""
    column_sketches(df, columns, accuracy).write.mode("append").parquet(path)
    return read_sketches(df.sparkSession, path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The merged sketches of every batch written to ``path``."""
    return merge_sketches(spark.read.parquet(path))


class Sketches:
    """Sketches of the columns of a table, at hand for quantiles.

    ``stored`` holds rows of :func:`column_sketches`; without it the table is scanned once.
    """

    def __init__(
        self, df: DataFrame, columns: Sequence[str], stored: DataFrame | None = None, accuracy: int = ACCURACY
    ):
        self.stored = stored is not None
        rows = merge_sketches(stored) if self.stored else column_sketches(df, columns, accuracy)
        self.rows = materialize(rows.filter(F.col("column").isin(list(columns))), "sketches")
        self.extent: dict[str, Extent] = {}
        for r in self.rows.drop("sketch").collect():
            c = r["column"]
            if c in self.extent:
                raise ValueError(f"stored sketches of '{c}' are of whole and of real numbers")
            low, high = (r["low_whole"], r["high_whole"]) if r["whole"] else (r["low_real"], r["high_real"])
            self.extent[c] = Extent(r["n"], low, high, r["total"], r["accuracy"], r["whole"])
        for c in columns:
            if c not in self.extent:
                if self.stored:
                    raise ValueError(f"no stored sketch of '{c}'")
                self.extent[c] = Extent(0, None, None, None, accuracy, is_whole(df, c))
            elif self.extent[c].whole != is_whole(df, c):
                raise ValueError(f"the stored sketch of '{c}' is of another kind of numbers")

    def brackets(self, ranks: Mapping[str, Sequence[int]]) -> dict[str, list[tuple]]:
        """``(low, high)`` around each rank: what the sketch holds some errors to either side."""
        asked: dict[str, list[float]] = {}
        for c, wanted in ranks.items():
            n, margin = self.extent[c].n, 2 * rank_error(self.extent[c].accuracy) * self.extent[c].n + 1
            asked[c] = [min(1.0, max(0.0, (r + 0.5 + side * margin) / n)) for r in wanted for side in (-1, 1)]

        def values(whole: bool) -> Column:
            take = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
            found = F.lit(None).cast("array<bigint>" if whole else "array<double>")
            for c, shares in asked.items():
                if self.extent[c].whole == whole:
                    here = take(F.col("sketch"), F.array(*[F.lit(s) for s in shares]))
                    found = F.when(F.col("column") == c, here).otherwise(found)
            return found

        result = {}
        for r in self.rows.select("column", values(True).alias("whole"), values(False).alias("real")).collect():
            c = r["column"]
            if c not in asked:
                continue
            got, extent = r["whole"] if self.extent[c].whole else r["real"], self.extent[c]
            result[c] = [
                (
                    extent.low if asked[c][k] == 0.0 else max(got[k], extent.low),
                    extent.high if asked[c][k + 1] == 1.0 else min(got[k + 1], extent.high),
                )
                for k in range(0, len(got), 2)
            ]
        return result

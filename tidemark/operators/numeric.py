"""Exact quantiles, summaries and histograms that never gather a column in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.operators.sketches import ACCURACY, Sketches, is_whole, usable_sql
from tidemark.session import materialize

# Accuracy of the approximate cuts of a bracket that is too large to fetch.
_ACCURACY = 10_000
# A bracket with at most this many distinct values is finished by fetching them.
_FINISH_VALUES = 20_000
_LEAST_FINISH = 4_096
# Cells that a larger bracket is cut into.
_CELLS = 256


@dataclass
class _Bracket:
    """Ranks of a column whose values lie between ``low`` and ``high``, both included."""

    column: str
    low: float | int
    high: float | int
    ranks: list[int]
    below: int = 0


def _usable(df: DataFrame, column: str) -> Column:
    return F.expr(usable_sql(df, column))


def column_extent(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float | None, float | None]]:
    """``(n, min, max)`` of each numeric column, from one scan."""
    row = df.selectExpr(
        *[
            f"named_struct('n', count({v}), 'lo', min({v}), 'hi', max({v})) AS x{i}"
            for i, v in enumerate(usable_sql(df, c) for c in columns)
        ]
    ).first()
    return {c: (row[i]["n"], row[i]["lo"], row[i]["hi"]) for i, c in enumerate(columns)}


def _bracketed(sketches: Sketches, ranks: Mapping[str, Sequence[int]]) -> list[_Bracket]:
    """Brackets around the ranks; those of a column that meet are one."""
    brackets: list[_Bracket] = []
    for c, bounds in sketches.brackets(ranks).items():
        mine: list[_Bracket] = []
        for rank, (low, high) in sorted(zip(ranks[c], bounds)):
            if mine and low <= mine[-1].high:
                mine[-1].low, mine[-1].high = min(mine[-1].low, low), max(mine[-1].high, high)
                mine[-1].ranks.append(rank)
            else:
                mine.append(_Bracket(c, low, high, [rank]))
        brackets += mine
    return brackets


def _values_inside(df: DataFrame, brackets: Sequence[_Bracket], above: bool) -> DataFrame:
    """``bracket, side, whole, real, count``, written out, from one scan: the distinct values of
    every bracket (side 0), and how many rows lie below it (-1) and, if asked for, ``above`` (1).
    Counting begins on the map side, so rows outside cost one entry for each task and bracket."""

    def entry(i: int, side: int, whole: Column, real: Column) -> Column:
        return F.struct(
            F.lit(i).alias("bracket"),
            F.lit(side).alias("side"),
            whole.cast("bigint").alias("whole"),
            real.cast("double").alias("real"),
        )

    entries, none = [], F.lit(None)
    for i, box in enumerate(brackets):
        value, whole = _usable(df, box.column), is_whole(df, box.column)
        found = F.when(value < F.lit(box.low), entry(i, -1, none, none)).when(
            value <= F.lit(box.high), entry(i, 0, value if whole else none, none if whole else value)
        )
        entries.append(found.when(value.isNotNull(), entry(i, 1, none, none)) if above else found)
    # empty entries leave after the array is opened: a filter of the array would run row by row
    inside = df.select(F.inline(F.array(*entries))).filter("bracket IS NOT NULL")
    counted = inside.groupBy("bracket", "side", "whole", "real").agg(F.count(F.lit(1)).alias("count"))
    return materialize(counted, "bracket-values")


def _pick(box: _Bracket, counted: Sequence[tuple], found: dict) -> None:
    """Values at the ranks of a bracket, from ``(value, count)`` of all its values."""
    below, pending = box.below, sorted(box.ranks)
    for value, count in sorted(counted):
        while pending and pending[0] < below + count:
            found[(box.column, pending.pop(0))] = value
        below += count


def _narrowed(values: DataFrame, boxes: dict[int, _Bracket], kinds: dict[int, str], found: dict, finish: int) -> None:
    """Finish the brackets on their written distinct values: few are fetched, many are cut into
    cells of about equally many values until few are left around each rank."""
    open_ = list(boxes.items())
    while open_:
        tests = F.lit(None).cast("int")
        for at, (i, box) in enumerate(open_):
            held = (F.col("bracket") == i) & F.col(kinds[i]).between(F.lit(box.low), F.lit(box.high))
            # boxes of one bracket do not overlap
            tests = F.when(held, F.lit(at)).otherwise(tests)
        here = values.withColumn("box", tests).filter("box IS NOT NULL")
        sizes = {r["box"]: r["n"] for r in here.groupBy("box").agg(F.count(F.lit(1)).alias("n")).collect()}
        few = [at for at in range(len(open_)) if sizes.get(at, 0) <= finish]
        if few:
            fetched: dict[int, list] = {at: [] for at in few}
            for r in here.filter(F.col("box").isin(few)).collect():
                fetched[r["box"]].append((r[kinds[open_[r["box"]][0]]], r["count"]))
            for at in few:
                _pick(open_[at][1], fetched[at], found)
        rest = [at for at in range(len(open_)) if at not in set(few)]
        if not rest:
            return
        value = F.coalesce(F.col("real"), F.col("whole").cast("double"))
        shares = [k / _CELLS for k in range(1, _CELLS)]
        cuts = (
            here.filter(F.col("box").isin(rest)).groupBy("box").agg(F.percentile_approx(value, shares, _ACCURACY).alias("cuts")).collect()
        )
        listed = F.lit(None).cast("array<double>")
        for r in cuts:
            listed = F.when(F.col("box") == r["box"], F.array(*[F.lit(float(c)) for c in sorted(set(r["cuts"]))])).otherwise(listed)
        cell = F.size(F.filter(listed, lambda c: c <= value))
        counted = (
            here.filter(F.col("box").isin(rest))
            .withColumn("cell", cell)
            .groupBy("box", "cell")
            .agg(
                F.sum("count").alias("rows"),
                *[f(k).alias(f"{n}_{k}") for k in ("whole", "real") for f, n in ((F.min, "lo"), (F.max, "hi"))],
            )
            .collect()
        )
        narrowed = []
        for at in rest:
            i, box = open_[at]
            below = box.below
            for r in sorted((r for r in counted if r["box"] == at), key=lambda r: r["cell"]):
                inside = [x for x in box.ranks if below <= x < below + r["rows"]]
                if inside:
                    low, high = r[f"lo_{kinds[i]}"], r[f"hi_{kinds[i]}"]
                    narrowed.append((i, _Bracket(box.column, low, high, inside, below)))
                below += r["rows"]
        open_ = narrowed


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    sketches: Sketches,
    finish_values: int = _FINISH_VALUES,
) -> dict[tuple[str, int], float | int]:
    """The value at each 0-based rank of each column, exactly and in the column's own type.

    One scan, whatever the values: the sketches bracket every rank, and the distinct values
    inside, a small share of the table, are written out with their counts and the number of rows
    below.  The rest works on that.  A sketch that missed its rank shows in the counts; its
    bracket is then opened to the column's end and read again.  Stored sketches of other rows
    than ``df`` show in the counts as well, and raise.
    """
    found: dict[tuple[str, int], float | int] = {}
    wanted: dict[str, list[int]] = {}
    for c, asked in ranks.items():
        extent = sketches.extent[c]
        if extent.n and asked and extent.low == extent.high and not sketches.stored:
            found.update({(c, r): extent.low for r in asked})
        elif extent.n and asked:
            wanted[c] = sorted(set(asked))
    pending = _bracketed(sketches, wanted) if wanted else []
    while pending:
        values = _values_inside(df, pending, sketches.stored)
        counts: dict[tuple[int, int], int] = {}
        for r in values.groupBy("bracket", "side").agg(F.sum("count").alias("n")).collect():
            counts[(r["bracket"], r["side"])] = r["n"]
        missed, boxes = [], {}
        for i, box in enumerate(pending):
            extent, inside = sketches.extent[box.column], counts.get((i, 0), 0)
            box.below = counts.get((i, -1), 0)
            if sketches.stored and box.below + inside + counts.get((i, 1), 0) != extent.n:
                raise ValueError(f"the stored sketch of '{box.column}' is not of these rows")
            ends = box.low, box.high
            if box.ranks[0] < box.below:
                box.low = extent.low
            if box.ranks[-1] >= box.below + inside:
                box.high = extent.high
            if (box.low, box.high) == ends:
                boxes[i] = box
            else:
                missed.append(box)
        kinds = {i: "whole" if is_whole(df, box.column) else "real" for i, box in boxes.items()}
        _narrowed(values.filter("side = 0"), boxes, kinds, found, max(_LEAST_FINISH, finish_values))
        pending = missed
    return found


def _between(low: float | int, high: float | int, share: float) -> float | int:
    """The point at ``share`` of the way, without overflow and with every digit of whole numbers."""
    if low == high or not share:
        # infinite values among them: there is nothing to interpolate
        return low
    if isinstance(low, int) and max(abs(low), abs(high)) > 1 << 53:
        return float(low + (high - low) * Fraction(share))
    point = low + (high - low) * share
    return point if math.isfinite(point) else low * (1 - share) + high * share


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    sketches: DataFrame | Sketches | None = None,
    accuracy: int = ACCURACY,
    **limits: int,
) -> dict[str, tuple[int, list[float] | None]]:
    """Linearly interpolated quantiles: ``{column: (n_valid, values)}``; values is ``None``
    for a column without values.  Two scans; one where the ``sketches`` of the table were kept
    (:mod:`tidemark.operators.sketches`)."""
    if not isinstance(sketches, Sketches):
        sketches = Sketches(df, list(probabilities), sketches, accuracy)
    sizes = {c: sketches.extent[c].n for c in probabilities}
    ranks: dict[str, list[int]] = {}
    for column, asked in probabilities.items():
        n = sizes[column]
        ranks[column] = sorted(
            {r for p in asked for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))} if n else set()
        )
    values = order_statistics(df, ranks, sketches, **limits)
    result: dict[str, tuple[int, list[float] | None]] = {}
    for column, asked in probabilities.items():
        n = sizes[column]
        if not n:
            result[column] = (0, None)
            continue
        quantiles = []
        for p in asked:
            at = (n - 1) * p
            low = values[(column, math.floor(at))]
            high = values[(column, math.ceil(at))]
            quantiles.append(_between(low, high, at - math.floor(at)))
        result[column] = (n, quantiles)
    return result


def numeric_summary(df: DataFrame, columns: Sequence[str], sketches: DataFrame | None = None) -> DataFrame:
    """``column, n, mean, median, min, max`` over the non-null values.  Two scans, or one where
    the ``sketches`` of the table were kept."""
    known = Sketches(df, columns, sketches)
    medians = exact_quantiles(df, {c: [0.5] for c in columns}, known)
    rows = []
    for c in columns:
        extent, middle = known.extent[c], medians[c][1]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(extent.n).cast("bigint").alias("n"),
                F.round(F.lit(extent.total / extent.n if extent.n else None).cast("double"), 4).alias("mean"),
                F.lit(middle[0] if middle else None).cast("double").alias("median"),
                F.lit(extent.low).cast("double").alias("min"),
                F.lit(extent.high).cast("double").alias("max"),
            )
        )
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _edges(extent: tuple[int, float | None, float | None], bins: int) -> tuple[float, float, float]:
    n, low, high = extent
    if not n:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    low, high = float(low), float(high)
    step = (high - low) / bins
    return low, high, step if math.isfinite(step) else high / bins - low / bins


def _finite(df: DataFrame, column: str) -> Column:
    value = _usable(df, column).cast("double")
    return F.when(F.abs(value) < F.lit(math.inf), value)


def _finite_extent(df: DataFrame, column: str) -> tuple[int, float | None, float | None]:
    """Count, least and greatest of the finite values: what the edges of bins are laid between."""
    value = _finite(df, column)
    return tuple(df.agg(F.count(value), F.min(value), F.max(value)).first())


def _bin_of(value: Column, low: float, high: float, step: float, bins: int) -> Column:
    """0-based bin of a value: right-open bins, the last one closed, NULL outside.  The
    division only guesses; comparing with the edges themselves settles it."""
    if not math.isfinite(high - low):
        # a quarter of everything has the same bins and does not overflow
        value, low, high, step = value / 4, low / 4, high / 4, step / 4
    guess = F.least(F.floor((value - low) / step), F.lit(bins - 1))
    at_edge = (
        F.when(value < F.lit(low) + guess * step, guess - 1)
        .when((guess < bins - 1) & (value >= F.lit(low) + (guess + 1) * step), guess + 1)
        .otherwise(guess)
    )
    return F.when(value.between(F.lit(low), F.lit(high)), at_edge)


def _all_bins(df: DataFrame, low: float, high: float, step: float, bins: int) -> DataFrame:
    at = F.col("id")

    def edge(k: Column) -> Column:
        if math.isfinite(high - low):
            return F.lit(low) + k * step
        return (F.lit(low / 4) + k * (step / 4)) * 4

    return df.sparkSession.range(bins).select(
        at.alias("bin"),
        edge(at).alias("lower"),
        F.when(at == bins - 1, F.lit(high)).otherwise(edge(at + 1)).alias("upper"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``bin, lower, upper, count`` over equal-width bins, empty ones included.  The edges follow the
    finite values; infinite ones count in the first and the last bin."""
    low, high, step = _edges(_finite_extent(df, column), bins)
    value = F.greatest(F.lit(low), F.least(F.lit(high), _usable(df, column).cast("double")))
    counts = (
        df.filter(_usable(df, column).isNotNull())
        .select(_bin_of(value, low, high, step, bins).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .count()
    )
    return (
        _all_bins(df, low, high, step, bins)
        .join(counts, "bin", "left")
        .select("bin", "lower", "upper", F.coalesce("count", F.lit(0)).alias("count"))
    )


def observed_vs_imputed(df: DataFrame, column: str, flag: str, bins: int = 25) -> DataFrame:
    """Histogram of observed and of imputed values on the edges of the observed ones;
    imputed values outside these edges are not counted.  Observed infinite values count in the
    first and the last bin."""
    filled = F.coalesce(quoted(flag).cast("boolean"), F.lit(False))
    low, high, step = _edges(_finite_extent(df.filter(~filled), column), bins)
    value = _usable(df, column).cast("double")
    value = F.when(filled | value.isNull(), value).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), value)))
    counts = (
        df.select(_bin_of(value, low, high, step, bins).alias("bin"), filled.alias("filled"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count_if(~F.col("filled")).alias("n_observed"), F.count_if("filled").alias("n_imputed"))
    )
    return (
        _all_bins(df, low, high, step, bins)
        .join(counts, "bin", "left")
        .select(
            "bin",
            "lower",
            "upper",
            F.coalesce("n_observed", F.lit(0)).alias("n_observed"),
            F.coalesce("n_imputed", F.lit(0)).alias("n_imputed"),
        )
    )

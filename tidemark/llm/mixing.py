"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, running_start, unused
from tidemark.session import materialize

SEED = 20_26


def n_words(text: Column) -> Column:
    """Number of words; none in a null text.  Counting the starts of words needs no array:
    a word starts where a word character follows white space or the beginning."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn.  Together they get
    ``share`` of all sizes, by weight; a target stops at ``most`` times its source's size and
    the excess is shared anew by weight.  With the sources sorted by ``most * size / weight``,
    those below some level stop and the others get ``level * weight``: the first source whose
    own ratio exceeds the level found from what is left fixes it.  One row per source passes
    through these windows; the documents do not.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    ranked = sources.withColumn("__w", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("__cap", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").isNull(), F.encode("source", "utf-8"))
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0))) / F.sum("__w").over(rest)
    ranked = ranked.withColumn("__level", level)
    # the level of the first source that stays below its own cap holds for all after it
    open_ = F.col("__level") * F.col("__w") < F.col("__cap")
    final = F.min(F.when(open_, F.struct((F.col("__cap") / F.col("__w")).alias("r"), F.col("__level").alias("l")))).over(everything)
    target = F.when(final.isNull(), F.col("__cap")).otherwise(F.least(F.col("__cap"), final.getField("l") * F.col("__w")))
    return ranked.select("source", "source_size", target.alias("target"))


def _key(id_col: str, text_col: str) -> Column:
    """A uniform hash that every pass over the documents computes alike."""
    return F.xxhash64(F.lit(SEED), F.col(id_col), F.crc32(F.col(text_col)))


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, rows_per_piece: int) -> DataFrame:
    """``doc_id, source, size, key, before``: each document's words, and those of the documents
    before it in its source.  Written out; texts are not part of it."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        _key(id_col, text_col).alias("key"),
    )
    return materialize(
        running_start(rows, "source", ["doc_id", "size"], F.col("size"), F.col("key"), rows_per_piece, "mix-rows"),
        "mix-placed",
    )


def _budgets(placed: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``s, source_size, target, epochs, left``, one row per source: the whole passes over a
    source, and the words that the last, partial pass takes."""
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    size, budget = F.col("source_size"), F.round("target").cast("long")
    epochs = F.when(size > 0, F.floor(budget / size)).otherwise(F.lit(0)).cast("long")
    return water_fill(sources, weights, share, most).select(
        F.col("source").alias("s"), "source_size", "target", epochs.alias("epochs"), (budget - epochs * size).alias("left")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_per_piece: int = 50_000,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken``, one row per document.

    Documents are laid out within their source by a hash of id and text; prefix sums of their
    word counts are distributed.  A source's budget is its target rounded to whole words: every
    full epoch takes each document once, and the last, partial epoch takes the documents before
    the cut, and of the one on the cut the words that still fit.  So the words taken of a source
    equal its budget exactly, and no document exceeds ``most`` times its size.

    A null source is a source of its own, sorted last; a null or empty text has no words and
    adds none; a null id is an id like any other.  Which of several equal rows meets the cut is
    open, the sums are not.  An empty table gives no rows.  Other columns are ignored.
    """
    placed = _placed(docs, id_col, text_col, source_col, rows_per_piece)
    budgets = _budgets(placed, weights, share, most)
    size = F.col("size")
    partial = F.greatest(F.lit(0).cast("long"), F.least(size, F.col("left") - F.col("before")))
    return placed.join(budgets, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("epochs") * size + partial).alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_per_piece: int = 50_000,
) -> DataFrame:
    """The documents of the mix with all their columns, one row for each time they are taken.

    Texts stay whole: the document on a source's cut is taken if at least half of it fits.  The
    cut is a position in the hash order, so one row per source decides about its documents, and
    no text is shuffled.  Equal rows lie on the same side.  Edge cases are those of ``mix``.
    """
    placed = _placed(docs, id_col, text_col, source_col, rows_per_piece)
    budgets = _budgets(placed, weights, share, most)
    # longs compare as signed, the hash order is unsigned
    place = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    inside = F.col("before") + F.col("size") / 2 <= F.col("left")
    cuts = (
        placed.join(budgets, F.col("source").eqNullSafe(F.col("s")))
        .groupBy("s")
        .agg(F.max("epochs").alias("epochs"), F.max(F.when(inside & (F.col("left") > 0), place)).alias("cut"))
    )
    of, epochs, cut, time = unused(docs, "of", "epochs", "cut", "time")
    cuts = materialize(cuts.toDF(of, epochs, cut), "mix-cuts")
    here = _key(id_col, text_col).bitwiseXOR(F.lit(-(1 << 63)))
    times = (F.col(epochs) + F.coalesce((here <= F.col(cut)).cast("long"), F.lit(0))).cast("int")
    return (
        docs.join(cuts, F.col(source_col).eqNullSafe(F.col(of)))
        .select(*docs.columns, F.explode(F.array_repeat(F.lit(1), times)).alias(time))
        .drop(time)
    )

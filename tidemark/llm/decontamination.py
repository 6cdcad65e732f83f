"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of ``width`` words of a benchmark item, or the whole item if it is shorter.
Windows and the equally long windows of a document are sets of words with positions.  Full
containment is asked for, so the necessary prefix of a window, with its words ordered from the
rarest in the corpus to the most frequent, is its first word alone: a document without it cannot
hold the window.  Each occurrence of a prefix word fixes where the window would have to lie
(positional bound) and that it has to fit into the document (length bound); what passes is
verified word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_package

# Word characters are 0-9, a-z, and everything beyond ASCII.
_WORD_BYTES = bytes(b"0123456789abcdefghijklmnopqrstuvwxyz") + bytes(range(128, 256))
_TO_SPACE = bytes(c if c in _WORD_BYTES else 32 for c in range(256))
BLOCK_WINDOWS = 100_000  # windows that a task holds at once; more are searched in several blocks


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only) of a whole text."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()


def windows_of(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if len(words) < width:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


def item_windows(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, window``: the distinct windows of each item, their words joined by spaces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [b" ".join(w).decode("utf-8", "surrogatepass") for w in dict.fromkeys(windows_of(words_of(text), width))]
                for s in range(0, len(found), 10_000):
                    part = found[s : s + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.string()), pa.array(part, pa.string())], names=["item", "window"]
                    )

    chosen = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(cut, "item string, window string")


def corpus_counts(docs: DataFrame, vocabulary: list[DataFrame], text_col: str) -> DataFrame:
    """``word, n``: how often each word of the windows occurs in all documents.  Tasks count
    their own documents first, so a frequent word costs one row per task and block."""
    counted = None
    for block in vocabulary:
        known = docs.sparkSession.sparkContext.broadcast({r["word"].encode() for r in block.collect()})

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            wanted, totals = known.value, {}
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    for word in words_of(text):
                        if word in wanted:
                            totals[word] = totals.get(word, 0) + 1
            found = list(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in found], pa.string()), pa.array([totals[w] for w in found], pa.int64())],
                names=["word", "n"],
            )

        part = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
        counted = part if counted is None else counted.unionByName(part)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Block:
    """Windows by their prefix word: the word's place in the window, the window's words, and
    the items that hold it."""

    by_word: dict[bytes, list[tuple[int, tuple[bytes, ...], tuple[str, ...]]]]


@dataclass
class Decontaminator:
    """Searches documents for the windows of a benchmark.  ``blocks`` are broadcast one by one;
    each holds at most ``BLOCK_WINDOWS`` windows, whatever the size of the benchmark."""

    blocks: list

    def matches(self, text: Column) -> Column:
        """Struct ``n_words, n_hit, n_items, items_sha256`` of each text."""
        blocks = self.blocks

        @F.pandas_udf("n_words long, n_hit long, n_items long, items_sha256 string")
        def searched(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in texts:
                yield pd.DataFrame(
                    [search(t, blocks) for t in batch], columns=["n_words", "n_hit", "n_items", "items_sha256"]
                )

        return searched(text)


def search(text: str | None, blocks: list) -> tuple[int, int, int, str]:
    words = words_of(text)
    n = len(words)
    hit, items = None, set()
    for block in blocks:
        by_word = block.value.by_word
        for at, word in enumerate(words):
            windows = by_word.get(word)
            if windows is None:
                continue
            for offset, window, holders in windows:
                start = at - offset
                if start < 0 or start + len(window) > n:
                    continue
                if tuple(words[start : start + len(window)]) == window:
                    if hit is None:
                        hit = np.zeros(n, dtype=bool)
                    hit[start : start + len(window)] = True
                    items.update(holders)
    listed = ",".join(sorted(items)).encode()
    return n, 0 if hit is None else int(hit.sum()), len(items), hashlib.sha256(listed).hexdigest()


def prepare(
    docs: DataFrame, items: DataFrame, width: int = 13, item_col: str = "item_id", text_col: str = "text"
) -> Decontaminator:
    """Orders the words of all windows by how rare they are in ``docs`` and lays the windows out
    by their prefix words."""
    spark = docs.sparkSession
    ship_package(spark)
    windows = materialize(item_windows(items, width, item_col, text_col).distinct(), "windows")
    listed = materialize(windows.groupBy("window").agg(F.collect_set("item").alias("items")), "window-items")
    n_blocks = max(1, -(-listed.count() // BLOCK_WINDOWS))
    block_of = F.pmod(F.xxhash64("window"), F.lit(n_blocks))
    listed = listed.withColumn("block", block_of)
    words = materialize(
        listed.select("block", F.explode(F.array_distinct(F.split("window", " "))).alias("word")).distinct(), "window-words"
    )
    counts = corpus_counts(
        docs, [words.filter(F.col("block") == b).select("word").distinct() for b in range(n_blocks)], text_col
    )
    # a word of several blocks is counted once for each of them, alike
    share = words.groupBy("word").agg(F.count(F.lit(1)).alias("blocks"))
    rarity = materialize(
        share.join(counts, "word", "left").select("word", (F.coalesce("n", F.lit(0)) / F.col("blocks")).alias("n")), "rarity"
    )
    # the rarest word of each window, and of equally rare ones the first in code point order
    prefix = (
        listed.select("window", F.explode(F.array_distinct(F.split("window", " "))).alias("word"))
        .join(rarity, "word")
        .groupBy("window")
        .agg(F.min(F.struct("n", "word")).getField("word").alias("prefix"))
    )
    laid = materialize(listed.join(prefix, "window"), "windows-by-prefix")
    blocks = []
    for b in range(n_blocks):
        by_word: dict = {}
        for r in laid.filter(F.col("block") == b).toLocalIterator():
            window = tuple(r["window"].encode("utf-8", "surrogatepass").split(b" "))
            word = r["prefix"].encode("utf-8", "surrogatepass")
            by_word.setdefault(word, []).append((window.index(word), window, tuple(r["items"])))
        blocks.append(spark.sparkContext.broadcast(Block(by_word)))
    return Decontaminator(blocks)


def decontaminate(
    docs: DataFrame, searcher: Decontaminator, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, one row per document.

    A word is hit if any occurrence of a window covers it.  ``items_sha256`` is the digest of the
    ids of all items with an occurring window, sorted as strings and joined by commas (of nothing,
    if there are none).  Contaminated: at least one hit, and at least a twentieth of the words.

    A null or empty text has no words and is clean.  Null or empty items have no windows; an item
    without an id marks words but is not listed.  Repeated documents come back as often, repeated
    items count once.  Empty tables give no rows, or no hits.  Other columns are ignored.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), searcher.matches(F.col(text_col)).alias("__m"))
    return found.select("doc_id", "__m.*").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
    )


def clean(docs: DataFrame, searcher: Decontaminator, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    m = searcher.matches(F.col(text_col))
    n_hit = m.getField("n_hit")
    return docs.filter(~((n_hit > 0) & (n_hit * 20 >= m.getField("n_words"))))

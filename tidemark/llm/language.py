"""Language identification by prediction with partial matching.

For every language a tree of byte contexts of up to ``ORDER`` bytes is counted and frozen.  The
next byte is coded in the longest context that has been seen; a byte that is new there costs an
escape, with a probability given by the number of distinct bytes seen in the context (method C),
and is coded one order lower; below order 0 all bytes are alike.  The code length of the whole
text is exact under these statistics, and the language with the shortest code wins.

The trees of all languages are laid out as one hash table for each order, so that a task scores
all positions of many texts and all languages at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_crc
from tidemark.session import ship_package

ORDER = 4  # bytes of the longest context; a context and its byte fit into a long
SAMPLE = 1_500  # documents of each language that the trees are counted on, expected
POSITIONS = 1 << 18  # bytes scored together
UNKNOWN = "und"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def grams(texts: list[bytes], order: int) -> np.ndarray:
    """For every byte its context and itself as one number, the byte lowest.  Before a text
    come zero bytes."""
    pad = bytes(order)
    raw = np.frombuffer(pad + pad.join(texts), dtype=np.uint8).astype(np.uint64)
    codes = np.zeros(len(raw) - order, dtype=np.uint64)
    for k in range(order + 1):
        codes |= raw[order - k : len(raw) - k] << np.uint64(8 * k)
    if len(texts) == 1:
        return codes
    # the padding between texts is not part of any text
    keep = np.ones(len(codes), dtype=bool)
    ends = np.cumsum([len(t) + order for t in texts])[:-1]
    for k in range(order):
        keep[ends - order + k] = False
    return codes[keep]


class Places:
    """Open addressing over distinct numbers: the place of each in the given order, or -1."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.place = np.full(1 << self.bits, -1, dtype=np.int32)
        self.probes = 0
        open_ = np.arange(len(keys))
        slot = self._slot(keys)
        while len(open_):
            self.probes += 1
            free = self.place[slot] < 0
            # of several numbers that want a slot the last one written gets it
            self.place[slot[free]] = open_[free]
            self.keys[slot[free]] = keys[open_[free]]
            left = self.place[slot] != open_
            open_, slot = open_[left], (slot[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.place[slot]
        open_ = np.nonzero((found >= 0) & (self.keys[slot] != keys))[0]
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = slot[open_]
            found[open_] = self.place[at]
            open_ = open_[(found[open_] >= 0) & (self.keys[at] != keys[open_])]
        return found


def _spread(keys: np.ndarray, every: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values`` of sorted ``keys`` laid out over the sorted ``every``, zero elsewhere."""
    out = np.zeros(len(every), dtype=np.float64)
    out[np.searchsorted(every, keys)] = values
    return out


@dataclass
class Trees:
    """For each order: the costs in bits of the known grams, and of the escapes from the known
    contexts, one column for each language."""

    languages: list[str]
    order: int
    gram_places: list[Places]
    gram_bits: list[np.ndarray]
    context_places: list[Places]
    escape_bits: list[np.ndarray]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text (none of them empty) in each language."""
        codes = grams(texts, self.order)
        total = np.zeros((len(codes), len(self.languages)), dtype=np.float32)
        at = None  # positions still open; all of them at first
        for k in range(self.order, -1, -1):
            found = self.gram_places[k].find(codes)
            hit = found >= 0
            if at is None:
                total[hit] = self.gram_bits[k][found[hit]]
                at = np.nonzero(~hit)[0]
            else:
                total[at[hit]] += self.gram_bits[k][found[hit]]
                at = at[~hit]
            codes = codes[~hit]
            if not len(at):
                break
            known = self.context_places[k].find(codes >> np.uint64(8))
            seen = known >= 0
            total[at[seen]] += self.escape_bits[k][known[seen]]
            codes = codes & np.uint64((1 << 8 * k) - 1) if k else codes
        else:
            total[at] += 8.0
        starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))
        return np.add.reduceat(total, starts, axis=0, dtype=np.float64)


def grow(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> Trees:
    """Trees from the counts of the longest grams of each language."""
    languages = sorted(counts)
    levels = []  # from the longest grams down: for each language sorted grams and counts
    current = [counts[x] for x in languages]
    for k in range(order, -1, -1):
        levels.append(current)
        if k:
            cut = []
            for keys, n in current:
                short, at = np.unique(keys & np.uint64((1 << 8 * k) - 1), return_inverse=True)
                cut.append((short, np.bincount(at, weights=n).astype(np.int64)))
            current = cut
    levels.reverse()
    trees = Trees(languages, order, [], [], [], [])
    below = np.empty(0, dtype=np.uint64)
    for k in range(order + 1):
        every = np.unique(np.concatenate([keys for keys, _ in levels[k]]))
        contexts = np.unique(every >> np.uint64(8))
        gram_bits = np.zeros((len(every), len(languages)))
        escape_bits = np.zeros((len(contexts), len(languages)))
        for i, (keys, n) in enumerate(levels[k]):
            own, at, distinct = np.unique(keys >> np.uint64(8), return_inverse=True, return_counts=True)
            whole = np.bincount(at, weights=n)
            escape_bits[:, i] = _spread(own, contexts, np.log2((whole + distinct) / distinct))
            here = _spread(keys, every, np.log2((whole + distinct)[at] / n))
            # a gram that this language has not seen: the escape, if it knows the context, and
            # the shorter gram, which some language has seen
            if k:
                shorter = np.searchsorted(below, every & np.uint64((1 << 8 * k) - 1))
                lower = trees.gram_bits[k - 1][shorter, i].astype(np.float64)
            else:
                lower = np.full(len(every), 8.0)
            unseen = np.ones(len(every), dtype=bool)
            unseen[np.searchsorted(every, keys)] = False
            context = np.searchsorted(contexts, every >> np.uint64(8))
            gram_bits[:, i] = np.where(unseen, escape_bits[context, i] + lower, here)
        below = every
        trees.gram_places.append(Places(every))
        trees.gram_bits.append(gram_bits.astype(np.float32))
        trees.context_places.append(Places(contexts))
        trees.escape_bits.append(escape_bits.astype(np.float32))
    return trees


def _bytes_of(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def train(
    docs: DataFrame,
    order: int = ORDER,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Trees | None:
    """Trees of all languages of the training documents: those with a text and a language whose
    crc32 of the id modulo 4 is not 2.

    About ``sample`` documents of each language are counted, chosen by a hash of the id, so that
    the statistics which reach the driver are bounded.  None if there is nothing to learn.
    """
    ship_package(docs.sparkSession)
    known = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    ).filter((F.pmod(F.coalesce(id_crc("id"), F.lit(0)), F.lit(4)) != 2) & F.col("lang").isNotNull() & (F.length("text") > 0))
    # one row for each language
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return None
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["n"])))])
    place = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = known.filter(place < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(_bytes_of(text))
            for lang, texts in by_lang.items():
                keys, n = np.unique(grams(texts, order), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    counted = (
        chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    counts = {}
    for lang, rows in counted.groupby("lang"):
        rows = rows.sort_values("gram")
        counts[lang] = (rows["gram"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64))
    return grow(counts, order) if counts else None


def _scored(trees: Trees, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; None marks one that has nothing to score."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, rows, size
        if not held:
            return
        bits = trees.bits(held)
        best = bits.argmin(axis=1)
        gap = np.clip((bits - bits.min(axis=1, keepdims=True)) * np.log(2), 0, 700)
        chance = 1 / np.exp(-gap).sum(axis=1)
        for r, b in zip(rows, best.tolist()):
            lang[r] = trees.languages[b]
        score[rows] = chance
        held, rows, size = [], [], 0

    for i, text in enumerate(texts):
        if text is None:
            continue
        raw = _bytes_of(text)
        if len(raw) > POSITIONS:
            # a very long text is scored in pieces whose contexts reach back into the last piece
            lang[i], score[i] = _long(trees, raw)
            continue
        held.append(raw)
        rows.append(i)
        size += len(raw)
        if size >= POSITIONS:
            flush()
    flush()
    return lang, score


def _long(trees: Trees, raw: bytes) -> tuple[str, float]:
    bits = np.zeros(len(trees.languages))
    for s in range(0, len(raw), POSITIONS):
        back = min(s, trees.order)
        piece = raw[s - back : s + POSITIONS]
        bits += trees.bits([piece])[0]
        if back:
            # less the bytes that were scored already, which here lacked their own contexts
            bits -= trees.bits([piece[:back]])[0]
    gap = np.clip((bits - bits.min()) * np.log(2), 0, 700)
    return trees.languages[int(bits.argmin())], float(1 / np.exp(-gap).sum())


def identify(docs: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per document.

    The score is the chance of the language under equal priors.  A text that is null or has no
    letter is ``und`` with score 0, and so is every text if no language was learned.  Equal code
    lengths go to the language that sorts first.  A null id counts as not held out; repeated rows
    come back as often; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    held = F.coalesce(F.pmod(id_crc("doc_id"), F.lit(4)) == 2, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if trees is None:
        return rows.select("doc_id", held, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(trees)
    readable = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = _scored(shared.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    found = rows.select("doc_id", predicted(readable).alias("p"))
    return found.select("doc_id", held, F.col("p.lang_pred").alias("lang_pred"), F.col("p.score").alias("score"))

"""Stupid-backoff scores of documents under the counts of the whole corpus.

A word is scored by the longest n-gram, of at most ``order`` words, that ends with it and occurs
elsewhere in the corpus: ``ln(c(context word) / c(context))``.  Each step down to a shorter context
costs the factor ``backoff``; without a context the word's own relative frequency counts, and a word
that occurs nowhere else backs off once more, to a uniform share.  "Elsewhere": the document's own
counts are taken off all counts, so that no document vouches for itself.

The work is three exchanges.  Documents are dealt into blocks, and each block is exploded into
its distinct n-grams with their counts, as arrays for each hash bucket.  The count tables are
partitioned by that hash: a bucket adds up its n-grams over all blocks and joins what other blocks
have back to the arrays they came from.  These sums return to their block, where they are joined to the words
of its documents and added up for each document.  Every count is exact and covers all documents;
n-grams are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

BLOCK_BYTES = 14 << 20  # UTF-8 bytes of a block of documents
BUCKET_GRAMS = 2_000_000  # n-grams of a bucket, expected
ORDER = 3
BACKOFF = 0.4
TASK_BLOCKS = 4  # blocks that a task takes at most on average, whatever the size of the input
RAW_PLANES = 5  # low bytes of a step between sorted hashes that no compression shortens
LEVEL = 1
OWN_WORDS = 200_000  # words of the documents whose own counts are taken together

_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Grams:
    """The n-grams of a block: first one row for each word, then one for each pair of neighbours, and
    so on up to ``order`` words; n-grams do not cross from one document to the next."""

    def __init__(self, texts: Iterator[str | None], order: int = ORDER):
        hashes, sizes = [], []
        for text in texts:
            words = _words(text)
            sizes.append(len(words))
            if words:
                hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)))
        self.sizes = np.array(sizes, dtype=np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        words = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        del hashes
        self.n_words = len(words)
        last = _mixed(words ^ _TWO)
        # ends: for each size of n-gram, the places of its last word
        self.ends, levels, named = [np.arange(len(words))], [words], words
        for size in range(2, order + 1):
            # an n-gram is named by the one that lacks its last word, and by that word
            longer = np.zeros_like(words)
            longer[1:] = _mixed(named[:-1] * _ONE + last[1:])
            named = longer
            self.ends.append(np.nonzero(self.doc[size - 1 :] == self.doc[: -(size - 1)])[0] + size - 1)
            levels.append(named[self.ends[-1]])
        self.starts = np.concatenate(([0], np.cumsum([len(e) for e in self.ends])))
        keys = np.concatenate(levels)
        del words, last, named, levels
        order_of_keys = np.argsort(keys)
        keys = keys[order_of_keys]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        self.keys = keys[new]
        del keys
        # the place of every n-gram among the distinct ones
        self.at = np.empty(len(order_of_keys), dtype=np.int32)
        self.at[order_of_keys] = np.cumsum(new, dtype=np.int32) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.at, minlength=len(self.keys))

    def cuts(self, buckets: int) -> np.ndarray:
        """Where each bucket's keys begin: a bucket is an equal range of hashes."""
        upper = (self.keys >> np.uint64(32)).astype(np.uint64)
        bucket = (upper * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def own(self) -> np.ndarray:
        """For every n-gram how often its own document has it."""
        out = np.empty(len(self.at), dtype=np.int64)
        words = np.concatenate(([0], np.cumsum(self.sizes)))
        bounds = [
            start + np.concatenate(([0], np.cumsum(np.maximum(self.sizes - size, 0))))
            for size, start in enumerate(self.starts[:-1])
        ]
        width = max(1, len(self.keys))
        first = 0
        while first < len(self.sizes):
            # some documents at a time: their n-grams of each size lie together
            last = max(first + 1, int(np.searchsorted(words, words[first] + OWN_WORDS, side="right")) - 1)
            parts = [slice(b[first], b[last]) for b in bounds]
            doc = np.concatenate(
                [self.doc[ends[p.start - start : p.stop - start]] for ends, p, start in zip(self.ends, parts, self.starts)]
            )
            code = doc * width + np.concatenate([self.at[p] for p in parts])
            _, at, n = np.unique(code, return_inverse=True, return_counts=True)
            found = n[at]
            for p in parts:
                out[p], found = found[: p.stop - p.start], found[p.stop - p.start :]
            first = last
        return out


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The bytes of whole numbers: first the lowest of all, last the highest of all."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _pack(counts: np.ndarray) -> bytes:
    """Counts are mostly small: their planes shrink to little."""
    return zstandard.compress(_planes(counts).tobytes(), LEVEL)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(8, n)
    return _numbers(planes).astype(np.int64)


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Rising hashes as their steps.  The low planes of the steps are as good as random and stay as
    they are, the high ones are nearly empty and are compressed."""
    planes = _planes(np.diff(keys, prepend=np.uint64(0)))
    return planes[:RAW_PLANES].tobytes() + zstandard.compress(planes[RAW_PLANES:].tobytes(), LEVEL)


def _unpack_sorted(raw: bytes, n: int) -> np.ndarray:
    cut = RAW_PLANES * n
    low = np.frombuffer(raw, dtype=np.uint8, count=cut)
    high = np.frombuffer(zstandard.decompress(raw[cut:]), dtype=np.uint8)
    return np.cumsum(_numbers(np.concatenate((low, high)).reshape(8, n)), dtype=np.uint64)


def _explode(buckets: int, order: int):
    def work(table: pa.Table) -> pa.Table:
        grams = Grams(table.column("text").to_pylist(), order)
        counts, cuts = grams.counts(), grams.cuts(buckets)
        filled = np.nonzero(np.diff(cuts))[0]
        return pa.table(
            {
                "bucket": pa.array(filled, pa.int64()),
                "block": pa.array([table.column("block")[0].as_py()] * len(filled), pa.int64()),
                "n_grams": pa.array(np.diff(cuts)[filled], pa.int64()),
                "grams": pa.array([_pack_sorted(grams.keys[cuts[b] : cuts[b + 1]]) for b in filled], pa.binary()),
                "counts": pa.array([_pack(counts[cuts[b] : cuts[b + 1]]) for b in filled], pa.binary()),
            }
        )

    return work


def _add_up(table: pa.Table) -> pa.Table:
    """The count table of a bucket, joined back to the n-grams of each block: how often each occurs in
    other blocks, which is never for most of the longer ones."""
    sizes = table.column("n_grams").to_pylist()
    grams = [_unpack_sorted(x.as_py(), n) for x, n in zip(table.column("grams"), sizes)]
    counts = np.concatenate([_unpack(x.as_py(), n) for x, n in zip(table.column("counts"), sizes)])
    _, at = np.unique(np.concatenate(grams), return_inverse=True)
    del grams
    total = np.zeros(at.max() + 1, dtype=np.int64)
    np.add.at(total, at, counts)
    return pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "others": pa.array([_pack(x) for x in np.split(total[at] - counts, np.cumsum(sizes)[:-1])], pa.binary()),
        }
    )


def _score(backoff: float, n_corpus: int, order: int):
    def work(docs: pa.Table, sums: pa.Table) -> pa.Table:
        grams = Grams(docs.column("text").to_pylist(), order)
        by_bucket = np.argsort(sums.column("bucket").to_numpy()) if sums.num_rows else []
        packed = sums.column("others")
        total = grams.counts()
        filled = 0
        cuts = np.nonzero(np.diff(grams.cuts(_buckets_of(sums))))[0] if sums.num_rows else []
        bounds = grams.cuts(_buckets_of(sums)) if sums.num_rows else [0]
        for row, b in zip(by_bucket, cuts):
            a, z = bounds[b], bounds[b + 1]
            total[a:z] += _unpack(packed[int(row)].as_py(), z - a)
            filled += z - a
        if filled != len(total):
            raise RuntimeError("the counts of a block are not complete")
        other = total[grams.at] - grams.own()
        del total
        size = len(grams.sizes)
        add = lambda w, d: np.bincount(d, weights=w, minlength=size).astype(np.float64)
        rest = n_corpus - np.repeat(grams.sizes, grams.sizes)
        seen = []
        context = cost = None
        for length, ends in enumerate(grams.ends, start=1):
            count = np.zeros(grams.n_words, dtype=np.int64)
            count[ends] = other[grams.starts[length - 1] : grams.starts[length]]
            with np.errstate(divide="ignore", invalid="ignore"):
                if length == 1:
                    # a word: its share elsewhere, or one more step down to a uniform share
                    cost = np.where(count > 0, np.log(count / rest), np.log(backoff / (rest + 1.0)))
                else:
                    share = np.log(count[ends] / context[ends - 1])
                    cost[ends] = np.where(count[ends] > 0, share, np.log(backoff) + cost[ends])
            seen.append(pa.array(add(count > 0, grams.doc).astype(np.int64)))
            context = count
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(grams.sizes),
                **dict(zip(_seen_columns(order), seen)),
                "log_score": pa.array(add(cost, grams.doc)),
            }
        )

    return work


def _buckets_of(sums: pa.Table) -> int:
    return sums.column("buckets")[0].as_py()


def _seen_columns(order: int) -> list[str]:
    return ["n_words_seen", "n_pairs_seen", *[f"n_{size}grams_seen" for size in range(3, order + 1)]][:order]


def backoff_scores(
    docs: DataFrame,
    order: int = ORDER,
    backoff: float = BACKOFF,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_grams: int = BUCKET_GRAMS,
) -> DataFrame:
    """``doc_id, n_words, n_words_seen, n_pairs_seen, n_3grams_seen, log_score, mean_score``, one row per
    document; the columns ``..._seen`` count the n-grams of each size, up to ``order`` words, that occur elsewhere.

    Words are lower-cased (A-Z) runs between ASCII white space.  ``log_score`` adds the natural
    logarithms of the scores of all words, ``mean_score`` is that for each word.  The first word
    of a document has no context and is scored by its own frequency.

    A null, empty or blank text has no words, a ``log_score`` of 0 and no ``mean_score``.
    Repeated rows vouch for each other and are scored each; a null id is kept.  An empty table
    gives no rows; other columns are ignored.  A very long text is one member of one block.
    """
    if order < 1:
        raise ValueError(f"order {order}: at least single words are needed")
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("words")
    ).first()
    n_bytes, n_words = size["bytes"] or 0, size["words"] or 0
    blocks = max(1, -(-n_bytes // block_bytes))
    buckets = max(1, -(-order * n_words // bucket_grams))
    # tasks follow the blocks and buckets, so that the share of each is bounded at any size
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_tasks, bucket_tasks = (max(least, -(-n // TASK_BLOCKS)) for n in (blocks, buckets))
    # the partition number spreads rows that repeat an id
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(blocks)))
    dealt = dealt.repartition(block_tasks, "block")
    exploded = dealt.groupBy("block").applyInArrow(
        _explode(buckets, order), "bucket long, block long, n_grams long, grams binary, counts binary"
    )
    sums = (
        exploded.repartition(bucket_tasks, "bucket")
        .groupBy("bucket")
        .applyInArrow(_add_up, "block long, bucket long, others binary")
        .withColumn("buckets", F.lit(buckets))
        .repartition(block_tasks, "block")
    )
    seen = ", ".join(f"{c} long" for c in _seen_columns(order))
    scored = (
        dealt.groupBy("block")
        .cogroup(sums.groupBy("block"))
        .applyInArrow(
            _score(backoff, n_words, order),
            f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words long, {seen}, log_score double",
        )
    )
    return scored.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))

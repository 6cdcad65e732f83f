"""Sharding by jump consistent hashing, in DataFrame functions alone.

Every key follows its own pseudo-random sequence of increasing jumps (Lamping and Veach); the
last jump below the number of shards is its shard.  One more shard can only end one sequence
later, so rows move into the new shard and nowhere else.  No ring table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running_start

# Fixed value: the multiplier of the published generator, state * M + 1 modulo 2**64.
MULTIPLIER = 2862933555777941757
LIMB = 22  # bits of a limb; products of limbs stay far below 2**63
MASK = (1 << LIMB) - 1
JUMPS = 160  # a sequence below 2**31 shards takes about 22 jumps; 160 are never reached


def _next_state(s: Column) -> list[Column]:
    """The next state of the generator, in limbs of 22, 22 and 20 bits.  A product of two
    longs would overflow, which is an error in SQL's ANSI mode."""
    m0, m1, m2 = (MULTIPLIER >> (LIMB * i) & MASK for i in range(3))
    a, b, c = s.getField("a"), s.getField("b"), s.getField("c")
    low = a * F.lit(m0) + F.lit(1)
    mid = a * F.lit(m1) + b * F.lit(m0) + F.shiftright(low, LIMB)
    high = a * F.lit(m2) + b * F.lit(m1) + c * F.lit(m0) + F.shiftright(mid, LIMB)
    return [low.bitwiseAND(F.lit(MASK)), mid.bitwiseAND(F.lit(MASK)), high.bitwiseAND(F.lit((1 << 20) - 1))]


def jump_shards(key: Column, n_shards: int) -> Column:
    """Struct ``shard`` (of ``n_shards``) and ``grown`` (of one shard more) for a long key.

    A null key counts as 0.  The state's upper 31 bits drive the jump:
    ``next = floor((shard + 1) * 2**31 / (upper + 1))``.
    """
    if not 0 < n_shards < (1 << 31) - 1:
        raise ValueError("n_shards must be between 1 and 2**31 - 2")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    long = lambda v: F.lit(v).cast("long")
    start = F.struct(
        key.bitwiseAND(long(MASK)).alias("a"),
        F.shiftrightunsigned(key, LIMB).bitwiseAND(long(MASK)).alias("b"),
        F.shiftrightunsigned(key, 2 * LIMB).alias("c"),
        long(0).alias("shard"),
        long(0).alias("grown"),
        long(0).alias("j"),
    )

    def step(s: Column, _: Column) -> Column:
        a, b, c = _next_state(s)
        state = F.struct(a.alias("a"), b.alias("b"), c.alias("c"), *[s.getField(f).alias(f) for f in ("shard", "grown", "j")])
        return F.when(s.getField("j") > F.lit(n_shards), s).otherwise(_jump(state, s.getField("j")))

    def _jump(state: Column, j: Column) -> Column:
        # bits 33 to 63 of the state: the upper 11 bits of limb b and the 20 bits of limb c
        upper = F.shiftleft(state.getField("c"), 11) + F.shiftright(state.getField("b"), 11)
        target = F.floor((j + F.lit(1)).cast("double") * F.lit(float(1 << 31)) / (upper + F.lit(1)).cast("double"))
        return F.struct(
            state.getField("a").alias("a"),
            state.getField("b").alias("b"),
            state.getField("c").alias("c"),
            F.when(j < F.lit(n_shards), j).otherwise(state.getField("shard")).alias("shard"),
            j.alias("grown"),
            target.alias("j"),
        )

    # j starts at 0, so the first step records shard 0; each later step records the jump before it
    steps = F.sequence(F.lit(1), F.lit(min(n_shards + 2, JUMPS)))
    done = F.aggregate(steps, start, step)
    return F.when(
        done.getField("j") > F.lit(n_shards),
        F.struct(done.getField("shard").cast("int").alias("shard"), done.getField("grown").cast("int").alias("grown")),
    ).otherwise(F.raise_error(F.lit("a jump sequence did not end")).cast("struct<shard:int,grown:int>"))


def shard_documents(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", rows_per_piece: int = 50_000
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per document.

    The law is ``key``: id and number of shards decide, and ``grown_shard`` is the shard with
    one shard more.  ``size`` is the UTF-8 bytes of the text (null: none) plus 8, the bytes of
    an id.  ``slot`` numbers the rows of a shard from 0 without gaps, in the order of a hash of
    id and text.  The text itself is never shuffled.

    A null id counts as id 0; a null text as an empty one (crc32 0).  Repeated rows go to one
    shard, each with its own slot; which of them gets which slot is open.  An empty table gives
    no rows.  Other columns are ignored, whatever their names.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32"),
        jump_shards(F.col(id_col), n_shards).alias("__to"),
    ).select("doc_id", "size", "text_crc32", F.col("__to.shard").alias("shard"), F.col("__to.grown").alias("grown_shard"))
    numbered = running_start(
        rows,
        "shard",
        ["doc_id", "text_crc32", "size"],
        F.lit(1).cast("long"),
        F.xxhash64("doc_id", "text_crc32", "size"),
        rows_per_piece * 24 // max(n_shards, 24) + 1,
        "shard-rows",
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("before").alias("slot"), "grown_shard"
    )

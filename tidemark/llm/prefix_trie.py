"""Prefix trie of rebuilt conversations, with subtree totals by tree contraction.

A node is named by its depth and by the exclusive or of position-salted hashes of its turns, which
can be run up piece by piece: no task walks a whole conversation and no text is shuffled.  A node's
short id is its smallest member and its depth: nodes of one depth share no member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.ordering import numbered
from tidemark.llm.tree_contraction import subtree_totals
from tidemark.operators.lookup import heavy_keys, lookup_join
from tidemark.session import materialize

EVERY = 5  # conversations that share the head of the first of them
HEADS = 9  # lengths of heads: 0 to 8 turns
PIECE = 4_096  # turns of a conversation that are run up at once; also ids that are written at once
HEAVY = 50_000  # children from which a parent is met in pieces

NODE = ["depth", "a", "b"]


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, members, digest, bytes``: the turns of each conversation in their order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return numbered(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest").asc()], "turns").drop("turn")


def rebuild(ordered: DataFrame, every: int = EVERY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``conv_id, length`` of every rebuilt conversation, and ``conv_id, depth, digest, bytes, length`` of its turns."""
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("long")
    sizes = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.select("conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % F.lit(every)).alias("base"))
    convs = materialize(
        convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
        .withColumn("taken", F.least(F.col("h"), F.coalesce("base_n", _long(0))))
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), _long(0))),
        "conversations",
    )
    opening = ordered.filter(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "bytes")
    first = (
        convs.filter("taken > 0")
        .select("conv_id", "base", "taken", "length")
        .join(opening, "base")
        .filter("pos < taken")
        .select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "bytes", "length")
    )
    # a conversation's row is repeated for each piece of its turns, so that a long one meets in many tasks
    pieces = convs.filter("n > h").select(
        "conv_id", "h", "taken", "length", F.explode(F.sequence(_long(0), F.floor((F.col("n") - 1) / PIECE))).alias("piece")
    )
    own = (
        ordered.withColumn("piece", F.floor(F.col("pos") / PIECE))
        .join(pieces, ["conv_id", "piece"])
        .filter("pos >= h")
        .select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "bytes", "length")
    )
    return convs.select("conv_id", "length"), first.unionByName(own)


def prefixes(rebuilt: DataFrame, piece: int = PIECE) -> DataFrame:
    """``rebuilt`` with the node ``a, b`` that each turn leads to, and its parent's ``pa, pb``."""
    rows = rebuilt.select(
        "conv_id",
        "depth",
        "bytes",
        "length",
        F.xxhash64("depth", "digest").alias("x"),
        F.xxhash64("digest", "depth").alias("y"),
        F.floor((F.col("depth") - 1) / piece).alias("piece"),
    )
    run = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"a": F.bit_xor("x").over(run), "b": F.bit_xor("y").over(run)})
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = rows.filter(F.col("depth") % piece == 0).select("conv_id", "piece", "a", "b")
    starts = full.select(
        "conv_id",
        (F.col("piece") + 1).alias("piece"),
        F.bit_xor("a").over(earlier).alias("sa"),
        F.bit_xor("b").over(earlier).alias("sb"),
    )
    named = rows.join(starts, ["conv_id", "piece"], "left").withColumns(
        {c: F.col(c).bitwiseXOR(F.coalesce(f"s{c}", _long(0))) for c in ("a", "b")}
    )
    return named.select(
        "conv_id",
        *NODE,
        F.col("a").bitwiseXOR(F.col("x")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
        "bytes",
        (F.col("depth") == F.col("length")).alias("last"),
    )


def _hash_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id lists, read in their order; only a digest is held."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        values = [*key, state.hexdigest()]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if node != key:
                if key is not None:
                    yield done()
                key, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if key is not None:
        yield done()


def _ends(rows: DataFrame, piece: int) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the nodes where a conversation ends.  Ids are written in runs of
    ``piece`` at most; a node with several runs is hashed run after run."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    runs = materialize(
        rows.groupBy(*NODE, F.floor(F.col("conv_id") / piece).alias("run")).agg(ids.alias("ids")), "ends"
    )
    counted = runs.groupBy(*NODE).agg(F.count(F.lit(1)).alias("runs"), F.min("ids").alias("ids"))
    one = counted.filter("runs = 1").select(*NODE, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    several = (
        runs.join(counted.filter("runs > 1").select(*NODE), NODE, "left_semi")
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "run")
        .select(*NODE, "ids")
        .mapInArrow(_hash_parts, "depth long, a long, b long, ends_sha256 string")
    )
    return one.unionByName(several)


def prefix_trie(
    conversations: DataFrame, every: int = EVERY, heads: int = HEADS, piece: int = PIECE, heavy: int = HEAVY
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A conversation c is rebuilt from the first h turns of conversation ``c - c % every`` (h is the
    unsigned crc32 of the decimal c, modulo ``heads``) and its own turns after its first h.

    Turns are ordered by ``turn``, nulls first; ties, repeated rows included, by a digest of role and
    text.  A null role or text counts as empty.  Rows without a ``conv_id`` belong to no conversation
    and take no part.  Texts of any length are read whole and travel as a digest.  An empty table has
    no root and gives no rows.  Other columns are ignored, whatever their names.  Turns are told
    apart by 128 bits of hash.
    """
    convs, rebuilt = rebuild(turns(conversations), every, heads)
    rows = materialize(prefixes(rebuilt, piece), "prefixes")
    known = materialize(
        rows.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("bytes").alias("bytes"),
            F.min("pa").alias("pa"),
            F.min("pb").alias("pb"),
        ),
        "nodes",
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    smallest = convs.agg(F.min("conv_id")).first()[0]
    top = root.select(*[_long(0).alias(c) for c in NODE], "conv_id", "n_convs", _long(0).alias("bytes"))
    kids = materialize(
        known.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor("conv_id").alias("kc"), F.bit_xor("depth").alias("kd")
        ),
        "children",
    )
    above = [F.col(c).alias(f"p_{c}") for c in NODE]
    parents = known.select(*above, F.col("conv_id").alias("parent_conv_id"))
    crowded = heavy_keys(kids.filter("depth > 0").select(*above, "n"), [f"p_{c}" for c in NODE], known.count(), heavy)
    lower = lookup_join(
        known.filter("depth > 1").withColumns(
            {"p_depth": F.col("depth") - 1, "p_a": F.col("pa"), "p_b": F.col("pb")}
        ),
        parents,
        [f"p_{c}" for c in NODE],
        small=False,
        heavy=crowded,
    ).select(*NODE, "conv_id", "n_convs", "bytes", "parent_conv_id")
    first = known.filter("depth = 1").withColumn("parent_conv_id", F.lit(smallest).cast("long"))
    nodes = (
        lower.unionByName(first.select(*lower.columns))
        .unionByName(top.withColumn("parent_conv_id", F.lit(None).cast("long")))
        .join(kids, NODE, "left")
    )
    ended = rows.filter("last").select("conv_id", *NODE)
    turnless = convs.filter("length = 0").select("conv_id", *[_long(0).alias(c) for c in NODE])
    nodes = nodes.join(_ends(ended.unionByName(turnless), piece), NODE, "left")
    zero = lambda c: F.coalesce(F.col(c), _long(0))
    nodes = materialize(
        nodes.select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            zero("n").alias("n_children"),
            zero("kc").alias("kc"),
            zero("kd").alias("kd"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        ),
        "trie",
    )
    tree = nodes.select(
        F.col("conv_id").alias("c"),
        F.col("depth").alias("d"),
        F.col("parent_conv_id").alias("pc"),
        F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pd"),
        F.col("n_children").alias("kids"),
        "kc",
        "kd",
        F.when(F.col("n_children") == 0, _long(1)).otherwise(_long(0)).alias("n_leaves"),
        "saved_tokens",
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"]).withColumnsRenamed({"c": "conv_id", "d": "depth"})
    return nodes.drop("saved_tokens", "kc", "kd").join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )

"""Merkle manifest of a dataset: stored levels of parent-linked nodes, climbed by a recursive query.

Each group (a language) is a binary tree over its rows, and the groups' roots are the leaves of a
tree on top.  Levels are built ``HOP`` at a time: the nodes of up to ``2**HOP`` neighbours become
one stored node, and each of them is stored with its link to that node and the siblings that it
meets on the way.  A recursive query then takes every leaf up link by link, appending the siblings
to its proof, a row for each step, and folding its hash into them.

A node near the top is met by most leaves, so it is stored in as many copies as it has ``PIECE``s
of leaves below it, and the leaves are spread over the copies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_crc
from tidemark.llm.ordering import numbered
from tidemark.session import materialize

HOP = 8  # levels between two stored nodes
PIECE = 4_096  # leaves that meet one copy of a node
EVERY = 7  # tampered are rows whose crc32 of the id is a multiple
TOP = ""  # name of the tree over the groups' roots; the groups' own names are never empty

LINK = "p_tree string, p_level long, p_pos long, p_copies long"


def _hex_hash(parts: Column) -> Column:
    return F.sha2(parts.cast("binary"), 256)


def _told(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_rows(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``doc_id, grp, leaf, start``: the hash of each row, and the one its climb starts with (tampered:
    one more in ``n_chars``).  The texts go no further than this."""

    def leaf(n_chars: Column) -> Column:
        return _hex_hash(F.concat(*[_told(F.col(c)) for c in ("doc_id", "source", "lang")], _told(n_chars), _told(F.col("text"))))

    more = F.col("n_chars").cast("decimal(20,0)") + F.lit(1)
    hit = F.coalesce(F.pmod(id_crc("doc_id"), F.lit(every)) == 0, F.lit(False))
    return docs.select(
        "doc_id",
        F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "lang")).alias("grp"),
        F.unhex(leaf(F.col("n_chars"))).alias("leaf"),
        F.unhex(F.when(hit & F.col("n_chars").isNotNull(), leaf(more)).otherwise(leaf(F.col("n_chars")))).alias("start"),
    )


def _pairs(level: str) -> str:
    """The level above an array of hex hashes."""
    return f"""transform(sequence(0, (size({level}) - 1) div 2),
                         i -> sha2(concat(get({level}, 2 * i), coalesce(get({level}, 2 * i + 1), '')), 256))"""


def _climb_one_hop(level: DataFrame, hop: int, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """From nodes ``tree, members, level, pos, hash, below`` of trees of several nodes: the same nodes with
    link and siblings, and the nodes above.  ``below`` counts leaves; ``carried`` columns stay."""
    wide = 1 << hop
    groups = level.groupBy("tree", "members", "level", F.floor(F.col("pos") / wide).alias("p_pos")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "hash", "below", *carried))).alias("nodes"),
        F.sum("below").cast("long").alias("p_below"),
    )
    groups = groups.withColumn("l0", F.expr("transform(nodes.hash, h -> lower(hex(h)))"))
    for i in range(hop):
        # a tree ends where one node is left; until then a last node without a neighbour is hashed alone
        goes_on = f"(members > {wide} OR size(l{i}) > 1)"
        groups = groups.withColumn(f"l{i + 1}", F.expr(f"CASE WHEN {goes_on} THEN {_pairs(f'l{i}')} ELSE l{i} END"))
    groups = materialize(groups.withColumn("p_level", F.col("level") + 1), "hops")
    siblings = ", ".join(
        f"""CASE WHEN members > {wide} OR size(l{i}) > 1 THEN
            named_struct('left', shiftright(at, {i}) % 2 = 1,
                         'hash', unhex(get(l{i}, shiftright(at, {i}) + 1 - 2 * (shiftright(at, {i}) % 2)))) END"""
        for i in range(hop)
    )
    linked = groups.select("*", F.posexplode("nodes").alias("at", "node")).select(
        "tree",
        "level",
        "node.pos",
        "node.hash",
        "node.below",
        *[f"node.{c}" for c in carried],
        F.col("tree").alias("p_tree"),
        "p_level",
        "p_pos",
        "p_below",
        F.expr(f"filter(array({siblings}), s -> s IS NOT NULL)").alias("siblings"),
    )
    above = groups.select(
        "tree",
        F.ceil(F.col("members") / wide).alias("members"),
        F.col("p_level").alias("level"),
        F.col("p_pos").alias("pos"),
        F.expr(f"unhex(get(l{hop}, 0))").alias("hash"),
        F.col("p_below").alias("below"),
    )
    return linked, above


def _build(level: DataFrame, hop: int, label: str) -> tuple[DataFrame, DataFrame]:
    """All linked nodes above the first level of some trees, and each tree's root (``tree, level, hash, below``)."""
    linked, roots = [], []
    while True:
        roots.append(level.filter("members = 1").select("tree", "level", "hash", "below"))
        rest = level.filter("members > 1")
        if rest.isEmpty():
            break
        nodes, level = _climb_one_hop(rest, hop, [])
        linked.append(nodes)
        level = materialize(level, label)
    for more in linked[1:]:
        linked[0] = linked[0].unionByName(more)
    for more in roots[1:]:
        roots[0] = roots[0].unionByName(more)
    return (linked[0] if linked else None), materialize(roots[0], f"{label}-roots")


# A stored node's siblings one after the other, and the hash folded into them.
FOLD = """unhex(aggregate({s}, lower(hex({h})), (h, s) -> sha2(CASE WHEN s.hash IS NULL THEN h
          WHEN s.left THEN concat(lower(hex(s.hash)), h) ELSE concat(h, lower(hex(s.hash))) END, 256)))"""
PROOF = "aggregate({s}, X'', (p, s) -> concat(p, coalesce(s.hash, X'')))"


def manifest(docs: DataFrame, hop: int = HOP, every: int = EVERY, piece: int = PIECE) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the hash of id, source, language, length and text.  The leaves of a language ascend by
    id and pair up until one node is left, its subroot; the subroots ascend by language (null first,
    by bytes) and pair up to the root.  Where ``every`` divides the crc32 of the id, the climb
    starts with a leaf whose ``n_chars`` is one more.

    Any column may be null: a null language is a language of its own, a null id comes first and is
    never tampered, and a null ``n_chars`` stays null.  Rows that repeat an id are ordered by their
    leaves; equal rows are leaves of their own with proofs of their own.  Texts of any length are
    hashed whole where they are read.  An empty table gives no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    leaves = numbered(leaf_rows(docs, every), "grp", [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], "leaves")
    first = leaves.select(
        F.col("grp").alias("tree"),
        "members",
        F.lit(0).cast("long").alias("level"),
        "pos",
        F.col("leaf").alias("hash"),
        F.lit(1).cast("long").alias("below"),
        "doc_id",
        "start",
    )
    first = materialize(first, "first-level")
    linked, above = _climb_one_hop(first.filter("members > 1"), hop, ["doc_id", "start"])
    linked = materialize(linked, "linked-leaves")
    lone = first.filter("members = 1")
    inner, subroots = _build(above.unionByName(lone.select(*above.columns)), hop, "levels")
    # groups may be as many as the documents: they are numbered and built like any other level
    trees = numbered(subroots.withColumn("all", F.lit(1)), "all", [F.col("tree").asc()], "groups")
    trees = materialize(trees.withColumnsRenamed({"tree": "grp", "level": "grp_level", "members": "n"}), "groups")
    outer, roots = _build(
        trees.select(F.lit(TOP).alias("tree"), F.col("n").alias("members"), F.lit(0).cast("long").alias("level"), "pos", "hash", "below"),
        hop,
        "top",
    )
    found = roots.first()  # one row
    kind = docs.schema["doc_id"].dataType.simpleString()
    if found is None:
        return spark.createDataFrame(
            [], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
    root, top_level = found["hash"].hex(), found["level"]

    copies = lambda c: F.greatest(F.ceil(F.col(c) / piece), F.lit(1).cast("long"))
    # the root of a group's tree links to its leaf in the tree on top, with nothing in between
    joints = trees.select(
        F.col("grp").alias("tree"),
        F.col("grp_level").alias("level"),
        F.lit(0).cast("long").alias("pos"),
        "hash",
        "below",
        F.lit(TOP).alias("p_tree"),
        F.lit(0).cast("long").alias("p_level"),
        F.col("pos").alias("p_pos"),
        F.col("below").alias("p_below"),
        F.expr("CAST(array() AS array<struct<left: boolean, hash: binary>>)").alias("siblings"),
        F.col("hash").alias("subroot"),
    )
    nodes = joints
    for more in (inner, outer):
        if more is not None:
            nodes = nodes.unionByName(more.withColumn("subroot", F.lit(None).cast("binary")))
    nodes = materialize(
        nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies("below") - 1))).select(
            "tree", "level", "pos", "copy", "p_tree", "p_level", "p_pos", copies("p_below").alias("p_copies"), "siblings", "subroot"
        ),
        "nodes",
    )
    anchor = linked.select(
        "doc_id",
        F.col("hash").alias("leaf"),
        F.col("pos").alias("number"),
        F.col("p_tree").alias("tree"),
        F.col("p_level").alias("level"),
        F.col("p_pos").alias("pos"),
        F.pmod("pos", copies("p_below")).alias("copy"),
        F.expr(FOLD.format(s="siblings", h="start")).alias("folded"),
        F.expr(PROOF.format(s="siblings")).alias("proof"),
    )
    alone = lone.select(
        "doc_id",
        F.col("hash").alias("leaf"),
        F.col("pos").alias("number"),
        "tree",
        "level",
        "pos",
        F.lit(0).cast("long").alias("copy"),
        F.col("start").alias("folded"),
        F.expr("X''").alias("proof"),
    )
    anchor = anchor.unionByName(alone).withColumn("row", F.monotonically_increasing_id())
    climbed = _climb(materialize(anchor, "anchor"), nodes, top_level)
    text = lambda c: F.lower(F.hex(c))
    return climbed.select(
        "doc_id",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        F.lit(root).alias("root"),
        "proof_sha256",
        text("folded").alias("folded_root"),
        (text("folded") == F.lit(root)).alias("verified"),
    )


def _climb(anchor: DataFrame, nodes: DataFrame, top_level: int) -> DataFrame:
    """``doc_id, leaf, folded, subroot, proof_sha256`` at the root, by a recursive query over the stored nodes.

    A step keeps what the next one needs and leaves its siblings behind as a row of its own: carried
    along, a proof would be moved once for each step.  The rows of a leaf, one for each step, are
    put together at the end.
    """
    spark = anchor.sparkSession
    tag = uuid.uuid4().hex
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    anchor.createOrReplaceTempView(f"anchor_{tag}")
    nodes.createOrReplaceTempView(f"nodes_{tag}")
    try:
        # the limit is there to stop endless recursion; this one ends at the root
        spark.conf.set(limit, "-1")
        return materialize(
            spark.sql(f"""
                WITH RECURSIVE climb AS (
                    SELECT row, 0 AS step, number, tree, level, pos, copy, folded, proof, CAST(NULL AS BINARY) AS subroot,
                           doc_id, leaf FROM anchor_{tag}
                    UNION ALL
                    SELECT c.row, c.step + 1, c.number, n.p_tree, n.p_level, n.p_pos, pmod(c.number, n.p_copies),
                           {FOLD.format(s="n.siblings", h="c.folded")}, {PROOF.format(s="n.siblings")}, n.subroot, NULL, NULL
                    FROM climb c
                    JOIN nodes_{tag} n ON n.tree = c.tree AND n.level = c.level AND n.pos = c.pos AND n.copy = c.copy
                ),
                leaves AS (
                    SELECT max(doc_id) AS doc_id, max(leaf) AS leaf, max(subroot) AS subroot,
                           max(CASE WHEN tree = '{TOP}' AND level = {top_level} THEN folded END) AS folded,
                           array_sort(collect_list(CASE WHEN proof != X'' THEN struct(step, proof) END)) AS steps
                    FROM climb GROUP BY row
                )
                SELECT doc_id, leaf, subroot, folded,
                       sha2(CAST(lower(hex(aggregate(steps, X'', (p, s) -> concat(p, s.proof)))) AS BINARY), 256) AS proof_sha256
                FROM leaves"""),
            "climbed",
        )
    finally:
        spark.catalog.dropTempView(f"anchor_{tag}")
        spark.catalog.dropTempView(f"nodes_{tag}")
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)

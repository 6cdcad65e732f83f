"""Subtree totals of a tree by parallel contraction: rake the leaves, compress the chains, expand again.

A round takes all leaves off (their totals are final and go to their parents) and then takes out
some of the nodes that have one child: the child hangs on to the grandparent and remembers what the
removed node would have added.  At least a fixed share of the nodes goes in each round on average,
whatever the shape of the tree, so a path of a million turns needs some dozens of rounds, not a
million.  Going back through the rounds, a removed node's total is what it held plus the total of
the child that took its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

ID, PARENT, KID = ("c", "d"), ("pc", "pd"), ("kc", "kd")


def _coin(c: str, d: str, turn: int) -> Column:
    return F.xxhash64(F.col(c), F.col(d), F.lit(turn)).bitwiseAND(F.lit(1).cast("long")) == 1


def _rake(active: DataFrame, values: list[str], turn: int) -> DataFrame:
    """The inner nodes of ``active`` after their leaves have handed in what they hold."""
    given = (
        active.filter("kids = 0 AND pc IS NOT NULL")
        .groupBy(*PARENT)
        .agg(
            F.count(F.lit(1)).alias("gone"),
            F.bit_xor("c").alias("gone_c"),
            F.bit_xor("d").alias("gone_d"),
            *[F.sum(F.col(v) + F.col(f"via_{v}")).alias(f"more_{v}") for v in values],
        )
        .withColumnsRenamed({"pc": "__c", "pd": "__d"})
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    inner = active.filter("kids > 0 OR pc IS NULL").join(
        given, (F.col("c") == F.col("__c")) & (F.col("d") == F.col("__d")), "left"
    )
    return materialize(
        inner.select(
            *ID,
            *PARENT,
            (F.col("kids") - zero("gone")).alias("kids"),
            F.col("kc").bitwiseXOR(zero("gone_c")).alias("kc"),
            F.col("kd").bitwiseXOR(zero("gone_d")).alias("kd"),
            *[(F.col(v) + zero(f"more_{v}")).alias(v) for v in values],
            *[f"via_{v}" for v in values],
        ),
        f"raked-{turn}",
    )


def _spliced(raked: DataFrame, values: list[str], turn: int) -> DataFrame:
    """Nodes with one child that leave in this round: those with heads whose child stays.  ``uc, ud`` is
    the child, ``has_*`` the total without the child's, ``new_*`` what the child has to carry."""
    chosen = raked.filter((F.col("kids") == 1) & F.col("pc").isNotNull() & _coin("c", "d", turn))
    child = raked.select(
        F.col("c").alias("uc"),
        F.col("d").alias("ud"),
        ((F.col("kids") == 1) & _coin("c", "d", turn)).alias("leaves_too"),
        *[F.col(f"via_{v}").alias(f"below_{v}") for v in values],
    )
    # every id is unique on both sides: no key of this join repeats
    met = chosen.join(child, (F.col("kc") == F.col("uc")) & (F.col("kd") == F.col("ud"))).filter(~F.col("leaves_too"))
    has = {v: F.col(v) + F.col(f"below_{v}") for v in values}
    return materialize(
        met.select(
            *ID,
            *PARENT,
            "uc",
            "ud",
            *[has[v].alias(f"has_{v}") for v in values],
            *[(has[v] + F.col(f"via_{v}")).alias(f"new_{v}") for v in values],
        ),
        f"spliced-{turn}",
    )


def _compress(raked: DataFrame, spliced: DataFrame, values: list[str], turn: int) -> DataFrame:
    long = lambda c: c.cast("long")
    none = long(F.lit(None))

    def change(c: str, d: str, **told: Column) -> DataFrame:
        names = ["gone", "npc", "npd", *[f"new_{v}" for v in values], "dc", "dd"]
        return spliced.select(
            F.col(c).alias("__c"), F.col(d).alias("__d"), *[long(told.get(n, none)).alias(n) for n in names]
        )

    carried = {f"new_{v}": F.col(f"new_{v}") for v in values}
    changes = (
        change("c", "d", gone=F.lit(1))
        .unionByName(change("uc", "ud", npc=F.col("pc"), npd=F.col("pd"), **carried))
        .unionByName(
            change("pc", "pd", dc=F.col("c").bitwiseXOR(F.col("uc")), dd=F.col("d").bitwiseXOR(F.col("ud")))
        )
        .groupBy("__c", "__d")
        .agg(
            *[F.max(n).alias(n) for n in ("gone", "npc", "npd", *carried)],
            F.bit_xor("dc").alias("dc"),
            F.bit_xor("dd").alias("dd"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    stay = raked.join(changes, (F.col("c") == F.col("__c")) & (F.col("d") == F.col("__d")), "left").filter("gone IS NULL")
    return materialize(
        stay.select(
            *ID,
            F.coalesce("npc", "pc").alias("pc"),
            F.coalesce("npd", "pd").alias("pd"),
            "kids",
            F.col("kc").bitwiseXOR(zero("dc")).alias("kc"),
            F.col("kd").bitwiseXOR(zero("dd")).alias("kd"),
            *values,
            *[F.coalesce(f"new_{v}", f"via_{v}").alias(f"via_{v}") for v in values],
        ),
        f"compressed-{turn}",
    )


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``c, d`` and, for each of ``values``, its sum over the node's subtree (itself included).

    ``nodes`` has an id of two longs (``c, d``), the parent's (``pc, pd``, null at a root), the number
    of children ``kids``, the exclusive or of the children's ids (``kc, kd``: with one child left it
    is that child's id, so no node has to look for its child among its parent's children) and the
    values, which must be longs without nulls.  Ids must be unique and parents present.  Leaves
    are added up on the map side before they meet their parent, so a parent of most nodes costs one
    row per task.  Several roots give several trees; no rows give no rows.
    """
    active = materialize(
        nodes.select(*ID, *PARENT, "kids", *KID, *values, *[F.lit(0).cast("long").alias(f"via_{v}") for v in values]),
        "tree",
    )
    rounds = []
    while True:
        leaves = active.filter("kids = 0 AND pc IS NOT NULL").select(*ID, *values)
        raked = _rake(active, values, len(rounds))
        if raked.filter("pc IS NOT NULL").isEmpty():
            break
        spliced = _spliced(raked, values, len(rounds))
        rounds.append((leaves, spliced))
        active = _compress(raked, spliced, values, len(rounds))
    totals = materialize(raked.select(*ID, *values).unionByName(leaves), "totals")
    for turn, (leaves, spliced) in reversed(list(enumerate(rounds))):
        below = totals.select(F.col("c").alias("uc"), F.col("d").alias("ud"), *[F.col(v).alias(f"below_{v}") for v in values])
        back = spliced.join(below, ["uc", "ud"]).select(
            *ID, *[(F.col(f"has_{v}") + F.col(f"below_{v}")).alias(v) for v in values]
        )
        totals = materialize(totals.unionByName(back).unionByName(leaves), f"totals-{turn}")
    return totals

"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, in DataFrame functions alone.

A sketch has ``TABLES`` tables of ``CELLS`` cells.  A paragraph's digest goes into one cell of each:
the cell counts it and keeps the exclusive or of its digests and of their checks.  Two sketches
subtract cell by cell, which leaves the paragraphs that only one version has.  A cell with one such
paragraph gives it away; it is taken out of its other cells, which may free the next one, and so on.
Where that gets stuck, the pair is sketched anew with four times the cells: its digests are dealt
into four parts by a hash, each part with a sketch of its own, and only stuck parts go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

TABLES, CELLS = 3, 16  # CELLS: a power of two
BITS = CELLS.bit_length() - 1
ROUNDS = 24  # of peeling; a sketch that needs more counts as stuck
PARTS = 4  # a stuck sketch is followed by so many
PIECE = 2_000  # documents that are sorted together, about
BOUNDS = 4_096  # most bounds between such pieces

CELL = "named_struct('n', 0, 'k', 0L, 'c', 0L)"


def digests(text: str) -> str:
    """SQL: the distinct 64-bit digests of the paragraphs, lines without the blanks around them, empty ones left out."""
    lines = f"filter(transform(split({text}, '\\n'), p -> trim(p)), p -> p != '')"
    return f"array_distinct(transform({lines}, p -> xxhash64(p)))"


def _here(hashed: str, i: str) -> str:
    return f"(shiftright({hashed}, CAST({BITS} * ({i} div {CELLS}) AS INT)) & {CELLS - 1}) = {i} % {CELLS}"


def sketch(keys: str, seed: int) -> str:
    """SQL: the cells of an array of digests."""
    hashed = f"transform({keys}, d -> named_struct('d', d, 'q', xxhash64(d, {seed}), 'c', xxhash64(d, {seed}, 1)))"
    put = "named_struct('n', a.n + 1, 'k', a.k ^ x.d, 'c', a.c ^ x.c)"
    return f"""transform(array({hashed}), h -> transform(sequence(0, {TABLES * CELLS - 1}),
        i -> aggregate(filter(h, x -> {_here("x.q", "i")}), {CELL}, (a, x) -> {put})))[0]"""


def peeled(one: str, two: str, seed: int) -> str:
    """SQL: ``cells, keys`` after peeling the difference of two sketches.  ``keys`` holds the recovered
    digests with 1 (only in the first) or -1; it is whole where all cells are empty."""
    minus = "named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c)"
    single = f"(x.n = 1 OR x.n = -1) AND x.c = xxhash64(x.k, {seed}, 1)"
    found = f"""array_distinct(transform(filter(s.cells, x -> {single}),
                x -> named_struct('k', x.k, 'n', x.n, 'q', xxhash64(x.k, {seed}))))"""
    out = f"named_struct('n', a.n - y.n, 'k', a.k ^ y.k, 'c', a.c ^ xxhash64(y.k, {seed}, 1))"
    step = f"""transform(array({found}), p -> named_struct(
        'cells', transform(s.cells, (x, i) -> aggregate(filter(p, y -> {_here("y.q", "i")}), x, (a, y) -> {out})),
        'keys', concat(s.keys, transform(p, y -> named_struct('k', y.k, 'n', y.n))),
        'more', size(p) > 0))[0]"""
    start = f"""named_struct('cells', zip_with({one}, {two}, (x, y) -> {minus}),
        'keys', CAST(array() AS array<struct<k: bigint, n: int>>), 'more', true)"""
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> CASE WHEN s.more THEN {step} ELSE s END)"


def emptied(peel: str) -> str:
    return f"forall({peel}.cells, x -> x.n = 0 AND x.k = 0 AND x.c = 0)"


def printed(cells: str) -> str:
    """SQL: a sketch as text; empty cells are blank."""
    return f"""array_join(transform({cells}, x -> CASE WHEN x.n = 0 THEN ''
        ELSE concat(x.n, ':', lower(hex(x.k)), ':', lower(hex(x.c))) END), ',')"""


def differences(pairs: DataFrame, first_seed: int = 0) -> DataFrame:
    """``pair, gone, came``: the digests that only ``one`` and only ``two`` hold, recovered from sketches.

    ``pairs`` has ``pair`` and two arrays of distinct digests without nulls.  A pair whose sketch got
    stuck comes in several rows, one for each part; together they hold the whole difference.
    """
    left = pairs.select("pair", "one", "two")
    done = []
    seed = first_seed
    while True:
        peel = left.withColumns({"s1": F.expr(sketch("one", seed)), "s2": F.expr(sketch("two", seed))}).withColumn(
            "peel", F.expr(peeled("s1", "s2", seed))
        )
        tried = materialize(
            peel.select("pair", F.expr(emptied("peel")).alias("whole"), F.expr("peel.keys").alias("keys"), "one", "two"),
            "peeled",
        )
        done.append(
            tried.filter("whole").select(
                "pair",
                F.expr("transform(filter(keys, x -> x.n = 1), x -> x.k)").alias("gone"),
                F.expr("transform(filter(keys, x -> x.n = -1), x -> x.k)").alias("came"),
            )
        )
        stuck = tried.filter("NOT whole")
        if stuck.isEmpty():
            break
        part = f"d -> pmod(xxhash64(d, {seed}, 2), {PARTS}) = part"
        left = stuck.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).select(
            "pair", F.expr(f"filter(one, {part})").alias("one"), F.expr(f"filter(two, {part})").alias("two")
        )
        seed += 1
    for more in done[1:]:
        done[0] = done[0].unionByName(more)
    return done[0]


def _in_pieces(docs: DataFrame, per_piece: int) -> DataFrame:
    """``doc_id, text, piece, cut, copy, mark``: documents dealt into pieces that follow each other by
    descending id (nulls last).  The rows of an id that holds several pieces' worth are cut by a hash of
    their text (``mark``), and equal rows beyond that are spread at random.  Texts are not shuffled yet."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    mark = F.shiftrightunsigned(F.xxhash64("text"), 1)
    n = rows.count()
    target = max(per_piece, -(-n // BOUNDS))
    wanted = max(1, n // target)
    shares = [i / wanted for i in range(1, wanted)] or [0.5]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 100 * wanted + 10_000)).first()[0] or []))
    listed = f"from_json('{bounds}', 'array<bigint>')"
    steps = ", ".join(str(1 << i) for i in range(len(bounds).bit_length(), -1, -1))
    below = f"""aggregate(array({steps}), 0, (a, s) ->
        CASE WHEN a + s <= {len(bounds)} AND get({listed}, a + s - 1) < doc_id THEN a + s ELSE a END)"""
    # a bound is a piece of its own: many rows share an id only there
    place = f"2 * below + CASE WHEN get({listed}, below) = doc_id THEN 1 ELSE 0 END"
    piece = F.expr(f"CASE WHEN doc_id IS NULL THEN {2 * len(bounds) + 1} ELSE {2 * len(bounds)} - ({place}) END")
    dealt = rows.withColumn("below", F.expr(below)).withColumn("piece", piece).drop("below")
    counts = dealt.groupBy("piece").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    # at most one piece in four of BOUNDS can hold that much
    crowded = materialize(
        counts.filter((F.col("rows") > 4 * target) & F.col("a").eqNullSafe(F.col("b"))).select(
            "piece", F.ceil(F.col("rows") / target).alias("cuts")
        ),
        "crowded-ids",
    )
    if crowded.isEmpty():
        return dealt.withColumns({"cut": F.lit(0).cast("long"), "copy": F.lit(0).cast("long"), "mark": mark})
    cut = F.coalesce(F.floor(mark / F.lit(2.0**63) * F.col("cuts")), F.lit(0).cast("long"))
    dealt = dealt.join(F.broadcast(crowded), "piece", "left").withColumns({"mark": mark, "cut": cut})
    equal = materialize(
        dealt.filter("cuts IS NOT NULL")
        .groupBy("piece", "mark")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 4 * target)
        .select("piece", "mark", F.ceil(F.col("rows") / target).alias("copies")),
        "crowded-rows",
    )
    copy = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("copies", F.lit(1)))
    return dealt.join(F.broadcast(equal), ["piece", "mark"], "left").withColumn("copy", copy).drop("cuts", "copies")


PLACE = ["piece", "cut", "copy"]


def _prints(rows: DataFrame) -> DataFrame:
    """Fingerprints of ``text``, of its edited text and of ``next``, and their differences as far as the
    first sketches tell.  Without a ``next`` all of that is null."""
    half = "(length(text) div 2)"
    edited = f"concat(substring(text, 1, CAST(length(text) - {half} AS INT)), substring(next, 1, CAST({half} AS INT)))"
    rows = rows.withColumn("edited", F.expr(edited)).withColumns(
        {f"d{v}": F.expr(digests(c)) for v, c in enumerate(("text", "edited", "next"))}
    )
    rows = rows.withColumns({f"s{v}": F.expr(sketch(f"d{v}", 0)) for v in range(3)})
    rows = rows.withColumns({f"p{v}": F.expr(peeled("s0", f"s{v}", 0)) for v in (1, 2)})
    rows = rows.withColumns({f"whole{v}": F.expr(emptied(f"p{v}")) for v in (1, 2)})
    stuck = "whole1 AND whole2"
    return rows.select(
        *[c for c in rows.columns if c in (*PLACE, "row", "first", "last")],
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.expr(printed("s0")).alias("fingerprint"),
        F.expr(printed("s1")).alias("edited_fingerprint"),
        *[F.expr(f"size(d{v})").alias(f"n{v}") for v in range(3)],
        *[F.expr(f"CASE WHEN whole{v} THEN size(p{v}.keys) END").alias(f"differ{v}") for v in (1, 2)],
        *[F.expr(f"CASE WHEN {stuck} THEN NULL ELSE d{v} END").alias(f"d{v}") for v in range(3)],
        *([F.expr("CASE WHEN first OR last THEN text END").alias("edge")] if "first" in rows.columns else []),
    )


def _likeness(one: str, two: str, differ: Column) -> Column:
    """Shared paragraphs of all paragraphs, from two counts and the size of the difference."""
    both = F.col(one) + F.col(two)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differ).cast("double") / (both + differ))


def fingerprints(docs: DataFrame, per_piece: int = PIECE) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per document.

    A document's edited text has its last half replaced by the beginning of the next document, by
    descending id; the first follows the last.  Likeness is the share of equal paragraphs among all
    of both versions, from the difference that their sketches give back: 1 if both have none.

    A null text counts as empty: its fingerprint has blank cells only.  Null ids come last.  Documents
    that repeat an id follow each other by a hash of their text; which of equal rows comes first makes
    no difference.  Repeated paragraphs of a text count once.  Long texts are sketched whole, in
    as many parts as their difference needs.  A single document follows itself.  An empty table
    gives no rows.  Other columns are ignored, whatever their names.
    """
    dealt = _in_pieces(docs, per_piece)
    order = Window.partitionBy(*PLACE).orderBy(F.col("doc_id").desc_nulls_last(), "mark")
    rows = dealt.withColumns({"place": F.row_number().over(order), "following": F.lead(F.struct("text")).over(order)})
    found = materialize(
        _prints(
            rows.select(
                *PLACE,
                "doc_id",
                "text",
                F.col("following.text").alias("next"),
                (F.col("place") == 1).alias("first"),
                F.col("following").isNull().alias("last"),
                F.monotonically_increasing_id().alias("row"),
            )
        ),
        "prints",
    )
    # the last document of a piece is followed by the first of the next piece: some thousand rows at most
    heads = found.filter("first").select(*PLACE, F.col("edge").alias("next"))
    ring = Window.orderBy(*PLACE)
    places = heads.select(*PLACE).withColumns(
        {f"next_{c}": F.coalesce(F.lead(c).over(ring), F.first(c).over(ring)) for c in PLACE}
    )
    tails = (
        found.filter("last")
        .select(*PLACE, "row", "doc_id", F.col("edge").alias("text"))
        .join(places, PLACE)
        .drop(*PLACE)
        .join(heads.withColumnsRenamed({c: f"next_{c}" for c in PLACE}), [f"next_{c}" for c in PLACE])
        .select("row", "doc_id", "text", "next")
    )
    tails = materialize(_prints(tails), "tail-prints")
    found = found.filter("NOT last").drop(*PLACE, "first", "last", "edge").unionByName(tails)
    stuck = [
        found.filter(f"differ{v} IS NULL").select(
            F.struct("row", F.lit(v).alias("version")).alias("pair"), F.col("d0").alias("one"), F.col(f"d{v}").alias("two")
        )
        for v in (1, 2)
    ]
    more = (
        differences(stuck[0].unionByName(stuck[1]), first_seed=1)
        .groupBy("pair")
        .agg(F.sum(F.size("gone") + F.size("came")).alias("differ"))
        .groupBy("pair.row")
        .agg(*[F.max(F.when(F.col("pair.version") == v, F.col("differ"))).alias(f"more{v}") for v in (1, 2)])
    )
    whole = found.filter("d0 IS NULL").withColumns({f"more{v}": F.lit(None).cast("long") for v in (1, 2)})
    rest = found.filter("d0 IS NOT NULL").join(more, "row", "left")
    every = whole.unionByName(rest)
    return every.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        _likeness("n0", "n1", F.coalesce("differ1", "more1")).alias("near_edited"),
        _likeness("n0", "n2", F.coalesce("differ2", "more2")).alias("near_next"),
    )

"""Secret scans with multipart linking, in DataFrame functions alone.

Strong patterns are reported wherever they match.  Weak candidates - names of accounts, bare
40-character keys, endpoints - are reported only where complementary parts occur within the
same scope of text: a credential needs an identifier and a secret, and an endpoint is of
interest beside both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

SCOPE = 400  # code points between parts that belong together, at most


@dataclass(frozen=True)
class Kind:
    """A pattern and what a match has to pass.  ``least`` is the least length of ``group``.

    ``role``: what the part contributes; ``needs``: the roles that must occur in its scope.
    """

    name: str
    pattern: str
    least: int
    group: int = 0
    role: str = ""
    needs: str = ""
    exactly: bool = False


# The base patterns.  Runs shorter than the least length can be left out of the
# pattern of ``access`` and ``hex``: a run is matched whole or not at all.
BASE = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
        "secret",
    ),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 16, 0, "identifier"),
    Kind("hex", r"[0-9a-f]{32,}", 32, 0, "secret"),
)
WEAK = (
    Kind(
        "account",
        r"""((?i:access_?key_?id|client_?id|user_?name|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]+)""",
        3,
        2,
        "identifier",
        "secret",
    ),
    Kind("key40", r"[A-Za-z0-9+/]{40,}", 40, 0, "secret", "identifier", True),
    Kind("endpoint", r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9/._~%?=&+-]*)?", 10, 0, "", "identifier secret"),
)
KINDS = BASE + WEAK
_PART = "array<struct<kind:int,ord:int,gap:int,size:int,ok:boolean>>"


def _matches(text: Column, place: int) -> Column:
    """Array of ``kind, ord, gap, size, ok`` of all leftmost, non-overlapping matches: the text
    is cut at them, so the pieces between them give their positions in code points."""
    kind = KINDS[place]
    pattern = F.lit(kind.pattern)
    gaps = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, pattern, 0)
    value = F.regexp_extract_all(text, pattern, kind.group) if kind.group else found
    checked = F.zip_with(
        found,
        value,
        lambda m, v: F.struct(
            F.length(m).alias("size"),
            (
                ((F.length(v) == kind.least) & v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]"))
                if kind.exactly
                else F.length(v) >= kind.least
            ).alias("ok"),
        ),
    )
    # one more gap than matches: the last pair has no match and is dropped
    paired = F.zip_with(gaps, checked, lambda g, c: F.struct(F.length(g).alias("gap"), c.alias("c")))
    listed = F.transform(
        F.filter(paired, lambda x: x.getField("c").isNotNull()),
        lambda x, i: F.struct(
            F.lit(place).alias("kind"),
            i.alias("ord"),
            x.getField("gap").alias("gap"),
            x.getField("c").getField("size").alias("size"),
            x.getField("c").getField("ok").alias("ok"),
        ),
    )
    return listed.cast(_PART)


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak parts whose needed roles all occur within ``scope`` code points.

    Parts are entered in every bin of ``scope`` code points that they touch, and reduced to the
    first start and the last end for each document, bin and role.  A weak part then meets at
    most one row for each bin and role in its reach, however many parts lie there.
    """
    at = lambda p: F.floor(p / F.lit(scope)).cast("long")
    number = {name: i for i, name in enumerate(k.name for k in KINDS)}
    role = F.lit(None).cast("string")
    for kind in KINDS:
        if kind.role:
            role = F.when(F.col("kind") == number[kind.name], kind.role).otherwise(role)
    touched = parts.select(
        "row", role.alias("role"), "start", "end", F.explode(F.sequence(at(F.col("start")), at(F.col("end") - 1))).alias("bin")
    ).filter("role IS NOT NULL")
    held = touched.groupBy("row", "bin", "role").agg(
        F.min(F.greatest("start", F.col("bin") * scope)).alias("first"),
        F.max(F.least("end", (F.col("bin") + 1) * scope)).alias("last"),
    )
    weak = parts.filter(F.col("kind") >= len(BASE))
    reach = weak.select(
        "row",
        "kind",
        "start",
        "end",
        F.explode(F.sequence(at(F.greatest(F.col("start") - scope, F.lit(0))), at(F.col("end") + scope - 1))).alias("bin"),
    )
    met = (
        reach.join(held, ["row", "bin"])
        .filter((F.col("first") < F.col("end") + scope) & (F.col("last") > F.col("start") - scope))
        .groupBy("row", "kind", "start", "end")
        .agg(*[F.max((F.col("role") == r).cast("int")).alias(r) for r in ("identifier", "secret")])
    )
    enough = F.lit(False)
    for kind in WEAK:
        needs = F.lit(True)
        for r in kind.needs.split():
            needs = needs & (F.col(r) == 1)
        enough = enough | ((F.col("kind") == number[kind.name]) & needs)
    return met.filter(enough).select("row", "kind", "start", "end")


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row per document.

    A span is ``kind:start:end`` in code points, end exclusive; spans are sorted by start, then
    by kind as listed in ``KINDS``, and joined by commas.  ``base_sha256`` is the digest of the
    base spans, ``spans`` has all of them.  Spans of different kinds may overlap.

    A null or empty text has no spans: counts of 0, the digest of nothing, an empty string.
    Repeated rows are scanned each, told apart by a row number that is written out before it is
    used; a null id is kept.  An empty table gives no rows.  Other columns are ignored.
    """
    text = F.col("__text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))

    def searched(place: int, where: Column) -> Column:
        return F.coalesce(F.when(where & text.rlike(KINDS[place].pattern), _matches(text, place)), F.array().cast(_PART))

    identified = text.rlike(KINDS[1].pattern) | text.rlike(KINDS[3].pattern)
    # a bare key or an endpoint needs an identifier in the same text
    arrays = [searched(i, identified if i >= 4 else F.lit(True)) for i in range(len(KINDS))]
    scanned = materialize(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*arrays).alias("parts")), "secret-parts"
    )
    before = Window.partitionBy("row", "kind").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exploded = scanned.select("row", F.inline("parts"))
    parts = (
        exploded.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter("ok")
        .select("row", "kind", "start", "end")
    )
    parts = materialize(parts, "secret-spans")
    reported = parts.filter(F.col("kind") < len(BASE)).unionByName(_linked(parts, scope))
    names = F.array(*[F.lit(k.name) for k in KINDS])

    def joined(spans: Column) -> Column:
        # a document's own spans
        return F.array_join(
            F.transform(
                F.array_sort(spans),
                lambda s: F.concat_ws(
                    ":",
                    F.element_at(names, s.getField("kind") + 1),
                    s.getField("start").cast("string"),
                    s.getField("end").cast("string"),
                ),
            ),
            ",",
        )

    def count(place: int) -> Column:
        return F.coalesce(F.sum((F.col("kind") == place).cast("long")), F.lit(0).cast("long")).alias(f"n_{KINDS[place].name}")

    span = F.struct("start", "kind", "end")
    by_row = reported.groupBy("row").agg(
        count(0), count(1), count(2), F.collect_list(span).alias("every"),
        F.collect_list(F.when(F.col("kind") < len(BASE), span)).alias("base"),
    )
    zero = F.lit(0).cast("long")
    return scanned.select("row", "doc_id").join(by_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(F.col(f"n_{k.name}"), zero).alias(f"n_{k.name}") for k in BASE],
        F.sha2(F.coalesce(joined(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("every")), F.lit("")).alias("spans"),
    )

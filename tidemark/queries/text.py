"""Near-duplicate values and their consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clusters, lookup, near_duplicates
from tidemark.queries.registry import query, table


# The SQL function compares bytes, the operator characters.  For scoring alone, SQL reads each
# letter beyond ASCII as a control character, which no text holds.
_LETTERS = "éóèüñçêäößÉíÈÊÑÓÇÜÍÖÄ"


def _scored_as(value: str) -> str:
    codes = " || ".join(f"chr({i + 1})" for i in range(len(_LETTERS)))
    return f"translate({value}, '{_LETTERS}', {codes})"


def stripped_sql(value: str) -> str:
    """Text without any white space around it."""
    space = r"[\s\x0B\x1C-\x1F\x{85}\pZ]+"
    return f"regexp_replace({value}, '^{space}|{space}$', '', 'g')"


def near_duplicates_sql(source: str, column: str, threshold: float, name: str = "") -> str:
    """CTEs ``vals`` and ``pairs`` for one text column."""
    return f"""vals AS (SELECT {stripped_sql(column)} AS v, count(*) AS c FROM {source}
    WHERE {stripped_sql(column)} <> '' GROUP BY 1),
    scored AS (SELECT a.v AS value_a, a.c AS count_a, b.v AS value_b, b.c AS count_b,
    jaro_winkler_similarity({_scored_as("a.v")}, {_scored_as("b.v")}) AS s
    FROM vals a JOIN vals b ON a.c > b.c OR (a.c = b.c AND a.v < b.v)),
    pairs AS (SELECT '{name or column}' AS "column", value_a, count_a, value_b, count_b, round(s, 3) AS similarity
    FROM scored WHERE s >= {threshold} - 1e-9)"""


def consolidation_sql(min_similarity: float) -> str:
    """CTEs ``mapping`` on top of ``pairs``: reachability, then the most frequent member."""
    return f"""close_ AS (SELECT * FROM pairs WHERE similarity >= {min_similarity}),
    edges AS (SELECT value_a AS a, value_b AS b FROM close_ UNION SELECT value_b, value_a FROM close_),
    reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT reach.node, edges.b
    FROM reach JOIN edges ON reach.other = edges.a),
    counted AS (SELECT DISTINCT value_a AS v, count_a AS c FROM close_ UNION SELECT value_b, count_b FROM close_),
    best AS (SELECT node, other AS to_value FROM reach JOIN counted ON other = v
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY c DESC, other DESC) = 1),
    mapping AS (SELECT node AS from_value, to_value FROM best WHERE node <> to_value)"""


def titles(spark, sf_dir):
    """Whole page titles."""
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"))


TITLES = "titles AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)"

_PAIRS = 'SELECT "column", value_a, count_a, value_b, count_b, similarity FROM pairs'


@query("near_dups_parts", f"WITH {near_duplicates_sql('part', 'p_name', 0.95)} {_PAIRS}")
def near_dups_parts(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "part"), ["p_name"], 0.95)


@query("near_dups_parts_loose", f"WITH {near_duplicates_sql('part', 'p_name', 0.85)} {_PAIRS}")
def near_dups_parts_loose(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "part"), ["p_name"], 0.85)


def _customer_nations(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").select("c_nationkey").join(nation, "c_nationkey")


_NATIONS = "nations AS (SELECT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query("near_dups_nations", f"WITH {_NATIONS}, {near_duplicates_sql('nations', 'n_name', 0.95)} {_PAIRS}")
def near_dups_nations(spark, sf_dir):
    """The nation each customer wrote down."""
    return near_duplicates.near_duplicates(_customer_nations(spark, sf_dir), ["n_name"], 0.95)


@query("near_dups_titles", f"WITH {TITLES}, {near_duplicates_sql('titles', 'title', 0.9)} {_PAIRS}")
def near_dups_titles(spark, sf_dir):
    return near_duplicates.near_duplicates(titles(spark, sf_dir), ["title"], 0.9)


@query(
    "near_dups_ordered",
    f"""WITH {near_duplicates_sql('supplier', 's_name', 0.98)}
    {_PAIRS} ORDER BY similarity DESC, value_a, value_b""",
)
def near_dups_ordered(spark, sf_dir):
    pairs = near_duplicates.near_duplicates(table(spark, sf_dir, "supplier"), ["s_name"], 0.98)
    return near_duplicates.most_similar_first(pairs)


def words(spark, sf_dir):
    """Every word of every document."""
    return table(spark, sf_dir, "documents").select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    )


# Too many words to compare all pairs.  At 0.97 the two words of a pair either begin with the
# same four letters or hold nearly the same letters: one may lack a letter from 8 letters on, two
# from 16 on, and one letter may differ from 16 on.  (A third could be lacking from 24 on.)
_WORDS_SQL = f"""words AS (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS word FROM documents),
    vals AS (SELECT word AS v, count(*) AS c FROM words WHERE word <> '' GROUP BY 1),
    spelled AS (SELECT v, c, {_scored_as("v")} AS x, list_sort(string_split({_scored_as("v")}, '')) AS l FROM vals),
    one AS (SELECT v, l, unnest(range(1, len(l) + 1)) AS i FROM spelled WHERE len(l) >= 8),
    lacking AS (SELECT v, list_concat(l[1:i - 1], l[i + 1:]) AS l, i FROM one),
    two AS (SELECT v, l, unnest(range(i, len(l) + 1)) AS j FROM lacking WHERE len(l) >= 15),
    held AS (SELECT v, array_to_string(l, '') AS letters FROM spelled UNION SELECT v, array_to_string(l, '') FROM lacking
    UNION SELECT v, array_to_string(list_concat(l[1:j - 1], l[j + 1:]), '') FROM two),
    near AS (SELECT a.v AS a, b.v AS b FROM spelled a JOIN spelled b ON left(a.x, 4) = left(b.x, 4) AND a.v < b.v
    UNION SELECT a.v, b.v FROM held a JOIN held b ON a.letters = b.letters AND a.v < b.v),
    compared AS (SELECT a.v AS av, a.c AS ac, b.v AS bv, b.c AS bc, jaro_winkler_similarity(a.x, b.x) AS s
    FROM near JOIN spelled a ON a.v = near.a JOIN spelled b ON b.v = near.b),
    pairs AS (SELECT 'word' AS "column", CASE WHEN ac >= bc THEN av ELSE bv END AS value_a, greatest(ac, bc) AS count_a,
    CASE WHEN ac >= bc THEN bv ELSE av END AS value_b, least(ac, bc) AS count_b, round(s, 3) AS similarity
    FROM compared WHERE s >= 0.97 - 1e-9)"""


@query("near_dups_words", f"WITH {_WORDS_SQL} {_PAIRS}")
def near_dups_words(spark, sf_dir):
    return near_duplicates.near_duplicates(words(spark, sf_dir), ["word"], 0.97)


_PART_MAP = f"{near_duplicates_sql('part', 'p_name', 0.85)}, {consolidation_sql(0.88)}"


def _part_pairs(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "part"), ["p_name"], 0.85)


@query(
    "components",
    f"""WITH RECURSIVE {_PART_MAP} SELECT 'p_name' AS "column", node AS value, min(other) AS component
    FROM reach GROUP BY node""",
)
def components(spark, sf_dir):
    close = clusters.close_pairs(_part_pairs(spark, sf_dir), 0.88)
    return clusters.connected_components(
        close.select("column", F.col("value_a").alias("a"), F.col("value_b").alias("b"))
    )


def _link(at):
    """A name that rises and falls along a chain of 1,600 links, 400 to a slope."""
    height = F.abs(F.pmod(at, F.lit(800)) - 400)
    return F.concat(F.lpad(height.cast("string"), 3, "0"), F.lit("-"), at.cast("string"))


@query(
    "components_chain",
    """WITH k AS (SELECT o_orderkey AS k FROM orders WHERE (o_orderkey + 1) % 1600 <> 0),
    nodes AS (SELECT k FROM k UNION SELECT k + 1 FROM k),
    named AS (SELECT k // 1600 AS chain, lpad(CAST(abs(k % 800 - 400) AS VARCHAR), 3, '0') || '-' || k AS value FROM nodes)
    SELECT 'link' AS "column", value, min(value) OVER (PARTITION BY chain) AS component FROM named""",
)
def components_chain(spark, sf_dir):
    """Chains through all orders, whose smallest name is reached over several slopes."""
    key = F.col("o_orderkey")
    ends = table(spark, sf_dir, "orders").filter((key + 1) % 1600 != 0)
    return clusters.connected_components(
        ends.select(F.lit("link").alias("column"), _link(key).alias("a"), _link(key + 1).alias("b"))
    )


@query(
    "consolidation_map",
    f"""WITH RECURSIVE {_PART_MAP} SELECT 'p_name' AS "column", from_value, to_value FROM mapping""",
)
def consolidation_map(spark, sf_dir):
    return clusters.consolidation_map(_part_pairs(spark, sf_dir), 0.88)


@query(
    "consolidation_nations",
    f"""WITH RECURSIVE {_NATIONS}, {near_duplicates_sql('nations', 'n_name', 0.95)}, {consolidation_sql(0.955)}
    SELECT 'n_name' AS "column", from_value, to_value FROM mapping""",
)
def consolidation_nations(spark, sf_dir):
    return clusters.consolidation_map(near_dups_nations(spark, sf_dir), 0.955)


@query(
    "consolidate",
    f"""WITH RECURSIVE {_PART_MAP} SELECT p_partkey, coalesce(to_value, p_name) AS p_name
    FROM part LEFT JOIN mapping ON p_name = from_value""",
)
def consolidate(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lookup.apply_value_map(part, consolidation_map(spark, sf_dir), ["p_name"])


@query(
    "consolidation_summary",
    f"""WITH RECURSIVE {_PART_MAP} SELECT 'p_name' AS "column", (SELECT count(*) FROM mapping) AS n_variants,
    (SELECT count(*) FROM part JOIN mapping ON p_name = from_value) AS n_rows_affected""",
)
def consolidation_summary(spark, sf_dir):
    mapping = consolidation_map(spark, sf_dir)
    effect = lookup.mapping_effect(table(spark, sf_dir, "part"), mapping, ["p_name"])
    return clusters.consolidation_summary(mapping).join(effect, "column")

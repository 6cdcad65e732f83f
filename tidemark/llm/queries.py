"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    invertible_sketch,
    language,
    merkle,
    mixing,
    multiprobe,
    ngram_lm,
    prefix_trie,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_files,
)
from tidemark.llm.common import table
from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_documents(spark, path)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontamination.decontaminate(docs, decontamination.prepare(docs, table(spark, sf_dir, "benchmark")))


def op9_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = ngram_lm.backoff_scores(table(spark, sf_dir, "documents"))
    # the order of summation shows in the last digits
    return scores.withColumns({"log_score": F.round("log_score", 6), "mean_score": F.round("mean_score", 9)})


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invertible_sketch.fingerprints(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_language,
        op3_quality,
        op4_token_files,
        op5_mixing,
        op6_simhash,
        op7_secret_scan,
        op8_decontamination,
        op9_multiprobe,
        op10_ngram_lm,
        op11_prefix_trie,
        op12_fingerprints,
        op13_merkle,
    )
}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
iw AS (SELECT item_id, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
       FROM benchmark WHERE text IS NOT NULL),
cut AS (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM iw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win FROM cut),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM dw, sizes WHERE len(w) >= size),
hits AS (SELECT l.doc_id, l.p, l.size, x.item_id FROM places l
         JOIN windows x ON x.size = l.size AND x.win = array_to_string(l.w[l.p:l.p + l.size - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM
            (SELECT doc_id, unnest(range(p, p + size)) AS word FROM hits) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
         (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(h.n_items, 0) AS n_items, sha256(coalesce(h.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM dw d LEFT JOIN covered c USING (doc_id) LEFT JOIN held h USING (doc_id)
"""

OP10_SQL = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all({LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS c, generate_subscripts(w, 1) AS p FROM t),
pos AS (SELECT doc_id, p, c, lag(c) OVER (PARTITION BY doc_id ORDER BY p) AS b,
               lag(c, 2) OVER (PARTITION BY doc_id ORDER BY p) AS a FROM u),
size AS (SELECT doc_id, count(*) AS n FROM pos GROUP BY doc_id),
one AS (SELECT c, count(*) AS n FROM pos GROUP BY c),
one_d AS (SELECT doc_id, c, count(*) AS n FROM pos GROUP BY doc_id, c),
two AS (SELECT b, c, count(*) AS n FROM pos WHERE b IS NOT NULL GROUP BY b, c),
two_d AS (SELECT doc_id, b, c, count(*) AS n FROM pos WHERE b IS NOT NULL GROUP BY doc_id, b, c),
three AS (SELECT a, b, c, count(*) AS n FROM pos WHERE a IS NOT NULL GROUP BY a, b, c),
three_d AS (SELECT doc_id, a, b, c, count(*) AS n FROM pos WHERE a IS NOT NULL GROUP BY doc_id, a, b, c),
k AS (SELECT pos.*, (SELECT count(*) FROM pos) - size.n AS rest, o1.n - d1.n AS c1,
             coalesce(o2.n - d2.n, 0) AS c2, coalesce(o3.n - d3.n, 0) AS c3
      FROM pos JOIN size ON size.doc_id = pos.doc_id
      JOIN one o1 ON o1.c = pos.c JOIN one_d d1 ON d1.doc_id = pos.doc_id AND d1.c = pos.c
      LEFT JOIN two o2 ON o2.b = pos.b AND o2.c = pos.c
      LEFT JOIN two_d d2 ON d2.doc_id = pos.doc_id AND d2.b = pos.b AND d2.c = pos.c
      LEFT JOIN three o3 ON o3.a = pos.a AND o3.b = pos.b AND o3.c = pos.c
      LEFT JOIN three_d d3 ON d3.doc_id = pos.doc_id AND d3.a = pos.a AND d3.b = pos.b AND d3.c = pos.c),
x AS (SELECT *, lag(c1) OVER (PARTITION BY doc_id ORDER BY p) AS before1,
             lag(c2) OVER (PARTITION BY doc_id ORDER BY p) AS before2 FROM k),
s AS (SELECT doc_id, c1, c2, c3, CASE WHEN c3 > 0 THEN ln(CAST(c3 AS DOUBLE) / before2) ELSE
             (CASE WHEN a IS NULL THEN 0 ELSE ln(0.4) END) + CASE WHEN c2 > 0 THEN ln(CAST(c2 AS DOUBLE) / before1) ELSE
             (CASE WHEN b IS NULL THEN 0 ELSE ln(0.4) END)
             + CASE WHEN c1 > 0 THEN ln(CAST(c1 AS DOUBLE) / rest) ELSE ln(0.4 / (rest + 1.0)) END END END AS cost FROM x),
total AS (SELECT doc_id, count(*) AS n, count(*) FILTER (c3 > 0) AS n3, count(*) FILTER (c2 > 0) AS n2,
                 count(*) FILTER (c1 > 0) AS n1, sum(cost) AS log_score FROM s GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0) AS n_words, coalesce(n1, 0) AS n_words_seen, coalesce(n2, 0) AS n_pairs_seen,
       coalesce(n3, 0) AS n_3grams_seen, round(coalesce(log_score, 0.0), 6) AS log_score,
       round(log_score / n, 9) AS mean_score
FROM t LEFT JOIN total USING (doc_id)
"""

# crc32 of ASCII text, bit by bit with the reversed polynomial; DuckDB has no function for it
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({}, ''), lambda c: ascii(c))),
    lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""

OP11_SQL = f"""
WITH t AS (SELECT conv_id, md5(length(r) || ':' || r || x) AS m, strlen(x) AS b,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS p
           FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
s AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM t GROUP BY conv_id),
c AS (SELECT s.*, least(s.h, coalesce(o.n, 0)) AS taken FROM s LEFT JOIN s o ON o.conv_id = s.base),
seq AS (SELECT c.conv_id, t.p AS d, m, b FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.taken
        UNION ALL SELECT c.conv_id, taken + t.p - h, m, b FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > h),
run AS (SELECT conv_id, d, b, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY d) AS path,
               d = count(*) OVER (PARTITION BY conv_id) AS ends FROM seq
        UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM seq) FROM c),
node AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * min(b) AS own,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS e
         FROM run GROUP BY path, d),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
above AS (SELECT left(path, 32 * unnest(range(0, d + 1))) AS path, own, node.path NOT IN (SELECT path FROM kids) AS leaf FROM node),
total AS (SELECT path, sum(own) AS saved, count(*) FILTER (leaf) AS leaves FROM above GROUP BY path)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(k, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.e AS ends_sha256
FROM node JOIN total ON total.path = node.path LEFT JOIN kids ON kids.path = node.path
LEFT JOIN node p ON node.d > 0 AND p.path = left(node.path, length(node.path) - 32)
"""


def _told(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _op13_leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_told(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


OP13_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_op13_leaf("n_chars")} AS leaf,
    CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_op13_leaf("(CAST(n_chars AS HUGEINT) + 1)")}
         ELSE {_op13_leaf("n_chars")} END AS start FROM documents),
x AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
             count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g FROM d),
level AS (SELECT g, 0 AS k, p, n, leaf AS h FROM x
    UNION ALL SELECT g, k + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM level WHERE n > 1 GROUP BY g, k, p // 2, n),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM level WHERE n = 1),
top AS (SELECT 0 AS k, p, n, h FROM sub
    UNION ALL SELECT k + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM top WHERE n > 1 GROUP BY k, p // 2, n),
step AS (SELECT g, k, p, n, h FROM level WHERE n > 1 UNION ALL SELECT -1, k, p, n, h FROM top WHERE n > 1),
climb AS (SELECT doc_id, g AS own, leaf, g, 0 AS k, p, n, start AS f, '' AS proof FROM x
    UNION ALL
    SELECT c.doc_id, c.own, c.leaf, CASE WHEN c.n = 1 THEN -1 ELSE c.g END, CASE WHEN c.n = 1 THEN 0 ELSE c.k + 1 END,
           CASE WHEN c.n = 1 THEN sub.p ELSE c.p // 2 END, CASE WHEN c.n = 1 THEN sub.n ELSE (c.n + 1) // 2 END,
           CASE WHEN c.n = 1 THEN f WHEN s.h IS NULL THEN sha256(f) WHEN c.p % 2 = 1 THEN sha256(s.h || f) ELSE sha256(f || s.h) END,
           proof || coalesce(s.h, '')
    FROM climb c LEFT JOIN step s ON c.n > 1 AND s.g = c.g AND s.k = c.k AND s.p = xor(c.p, 1) LEFT JOIN sub ON sub.g = c.own
    WHERE c.n > 1 OR c.g <> -1)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top.h AS verified
FROM climb JOIN sub ON sub.g = own JOIN top ON top.n = 1 WHERE climb.g = -1 AND climb.n = 1
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op7_sql() -> str:
    kinds = secret_scan.KINDS
    found = " UNION ALL ".join(
        f"""SELECT r, {i} AS k, regexp_extract_all(t, {_literal(kind.pattern)}) AS ms,
        regexp_extract_all(t, {_literal(kind.pattern)}, {kind.group}) AS vs,
        string_split_regex(t, {_literal(kind.pattern)}) AS gs FROM d WHERE regexp_matches(t, {_literal(kind.pattern)})"""
        for i, kind in enumerate(kinds)
    )
    mixed = "length(v) = 40 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')"
    passes = " ".join(
        f"WHEN {i} THEN {mixed if kind.exactly else f'length(v) >= {kind.least}'}" for i, kind in enumerate(kinds)
    )
    near = f"p.r = w.r AND p.s < w.e + {secret_scan.SCOPE} AND p.e > w.s - {secret_scan.SCOPE}"

    def needs(role: str) -> str:
        wanted = ", ".join(str(i) for i, kind in enumerate(kinds) if role in kind.needs)
        parts = ", ".join(str(i) for i, kind in enumerate(kinds) if kind.role == role)
        return f"(w.k NOT IN ({wanted}) OR EXISTS (SELECT 1 FROM spans p WHERE {near} AND p.k IN ({parts})))"

    first_weak = len(secret_scan.BASE)
    names = " ".join(f"WHEN {i} THEN '{kind.name}'" for i, kind in enumerate(kinds))
    joined = f"string_agg(CASE k {names} END || ':' || s || ':' || e, ',' ORDER BY s, k, e)"
    counts = ", ".join(f"count(*) FILTER (k = {i}) AS n_{kind.name}" for i, kind in enumerate(secret_scan.BASE))
    filled = ", ".join(f"coalesce(n_{kind.name}, 0) AS n_{kind.name}" for kind in secret_scan.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
u AS (SELECT r, k, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS i FROM m),
q AS (SELECT r, k, v, length(m) AS n, sum(length(g) + length(m)) OVER (PARTITION BY r, k ORDER BY i) AS e FROM u),
spans AS (SELECT r, k, CAST(e - n AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM q WHERE CASE k {passes} END),
kept AS (SELECT * FROM spans WHERE k < {first_weak}
         UNION ALL SELECT * FROM spans w WHERE k >= {first_weak} AND {needs("identifier")} AND {needs("secret")}),
total AS (SELECT r, {counts}, {joined} AS spans, {joined} FILTER (k < {first_weak}) AS base FROM kept GROUP BY r)
SELECT d.doc_id, {filled}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN total USING (r)
"""


ORACLE_SQL: dict[str, str] = {
    "op7_secret_scan": _op7_sql(),
    "op8_decontamination": OP8_SQL,
    "op10_ngram_lm": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_merkle": OP13_SQL,
}

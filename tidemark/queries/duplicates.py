"""Duplicate keys and keep-first deduplication."""

from __future__ import annotations

from tidemark.operators import dedup, keyed_layers
from tidemark.queries.registry import LINE_ITEMS, line_items, query, table
from tidemark.session import scratch_path

KEY = ["l_orderkey", "l_linenumber"]
# a total order over the remaining columns, NULLs first as Spark sorts them
REST = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query(
    "dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dup_keys(spark, sf_dir):
    return dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), KEY)


@query(
    "dup_rows",
    f"""WITH {LINE_ITEMS} SELECT * FROM items
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
)
def dup_rows(spark, sf_dir):
    return dedup.duplicate_rows(line_items(spark, sf_dir), KEY)


@query(
    "dup_rows_ordered",
    """SELECT l_orderkey, l_linenumber FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 ORDER BY 1, 2""",
)
def dup_rows_ordered(spark, sf_dir):
    return dedup.duplicate_rows(table(spark, sf_dir, "lineitem").select(*KEY), KEY, ordered=True)


@query(
    "dedup_first",
    f"""WITH {LINE_ITEMS} SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {", ".join(f"{c} NULLS FIRST" for c in REST)}) = 1""",
)
def dedup_first(spark, sf_dir):
    return dedup.keep_first(line_items(spark, sf_dir), KEY, REST)


@query(
    "keyed_dedup_first",
    f"""WITH {LINE_ITEMS} SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {", ".join(f"{c} NULLS FIRST" for c in REST)}) = 1""",
)
def keyed_dedup_first(spark, sf_dir):
    """The same from a layer bucketed by the key, without a shuffle after it is written."""
    layer = keyed_layers.write_keyed_layer(line_items(spark, sf_dir), scratch_path(spark, "keyed-items"), KEY)
    return dedup.keep_first(layer.rows, KEY, REST)


@query(
    "keyed_counts",
    """WITH k AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n_rows,
    CAST(coalesce(sum(n) FILTER (l_orderkey IS NULL), 0) AS BIGINT) AS n_null_keys,
    count(*) FILTER (n > 1) AS n_repeated FROM k""",
)
def keyed_counts(spark, sf_dir):
    """Rows and repeated keys of a layer, from its digests alone."""
    layer = keyed_layers.write_keyed_layer(
        table(spark, sf_dir, "lineitem"), scratch_path(spark, "keyed-orders"), ["l_orderkey"]
    )
    return keyed_layers.layer_counts(layer)


@query(
    "dup_count",
    """WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n) - count(*) AS BIGINT) AS n_surplus
    FROM k""",
)
def dup_count(spark, sf_dir):
    return dedup.duplicate_count(table(spark, sf_dir, "lineitem"), KEY)


@query(
    "dup_texts",
    """SELECT lang, text, count(*) AS n_copies FROM documents GROUP BY lang, text HAVING count(*) > 1""",
)
def dup_texts(spark, sf_dir):
    return dedup.duplicate_keys(table(spark, sf_dir, "documents"), ["lang", "text"])

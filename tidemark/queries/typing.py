"""Dictionaries, text sources, the typed cast, layers and labelled export."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import na_to_null
from tidemark.operators import missing
from tidemark.operators import typing as types
from tidemark.operators.distribution import columns_with_suffix, value_counts
from tidemark.queries.numbers import _FILLED, impute_plan
from tidemark.queries.registry import query, table, union_all
from tidemark.session import scratch_path
from tidemark.sources import tables

# ----------------------------------------------------------------------- dictionaries

_DOCUMENT_DICTIONARY = """dict AS (SELECT 'doc_id' AS "column", 'doc id' AS description, 'long' AS type, '' AS choices
    UNION ALL SELECT 'text', 'text', 'str' || (SELECT max(length(text)) FROM documents), ''
    UNION ALL SELECT 'lang', 'lang', 'byte', 'lang'
    UNION ALL SELECT 'source', 'source', 'str' || (SELECT max(length(source)) FROM documents), ''
    UNION ALL SELECT 'n_chars', 'n chars', 'long', '')"""


def _document_dictionary(spark, sf_dir):
    return types.describe_table(table(spark, sf_dir, "documents"), choices=["lang"])


@query("describe_table", f"WITH {_DOCUMENT_DICTIONARY} SELECT * FROM dict")
def describe_table(spark, sf_dir):
    return _document_dictionary(spark, sf_dir)


@query(
    "dictionary_csv",
    f"""WITH {_DOCUMENT_DICTIONARY} SELECT "column", 'The "' || "column" || '",' || chr(10) || 'as written'
    AS description, type, nullif(choices, '') AS choices FROM dict""",
)
def dictionary_csv(spark, sf_dir):
    """Quotes, commas and line breaks in descriptions survive the way through a CSV."""
    described = _document_dictionary(spark, sf_dir).withColumn(
        "description", F.concat(F.lit('The "'), F.col("column"), F.lit('",\nas written'))
    )
    path = scratch_path(spark, "dictionary-csv")
    tables.write_report_csv(described, path)
    return tables.read_dictionary(spark, path).withColumn(
        "choices", F.when(F.col("choices") != "", F.col("choices"))
    )


@query(
    "recommend_types",
    f"""WITH {_DOCUMENT_DICTIONARY} SELECT "column", description, type, choices,
    CASE WHEN type = 'long' THEN 'bigint' ELSE 'string' END AS recommended_type,
    CASE WHEN type = 'long' THEN 'number' WHEN type = 'byte' THEN 'category'
    WHEN CAST(substr(type, 4) AS INTEGER) > 20 THEN 'free_text' ELSE 'code' END AS kind,
    CASE WHEN type = 'long' THEN 'stored as a number' WHEN type = 'byte' THEN 'one of a fixed set of answers'
    WHEN CAST(substr(type, 4) AS INTEGER) > 20 THEN 'longer text, kept as it is' ELSE 'short text, compared as text' END
    AS reason FROM dict""",
)
def recommend_types(spark, sf_dir):
    return types.recommend_types(_document_dictionary(spark, sf_dir))


@query(
    "contract",
    """SELECT 'dictionary_only' AS side, c AS "column" FROM (VALUES ('c_nationkey'), ('c_mktsegment')) t(c)
    UNION ALL SELECT 'data_only', 'c_segment_size' FROM (SELECT count(*) FROM customer)""",
)
def contract(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    data = customer.select("c_custkey", "c_name", "c_acctbal").withColumn("c_segment_size", F.lit(1))
    return types.contract_violations(
        missing.df_of_names(data, data.columns), types.describe_table(customer)
    )


@query(
    "count_check",
    """SELECT 'rows' AS measure, count(*) AS observed, CAST(NULL AS BIGINT) AS expected, true AS ok FROM lineitem
    UNION ALL SELECT 'entities', count(DISTINCT l_orderkey), 5, count(DISTINCT l_orderkey) = 5 FROM lineitem""",
)
def count_check(spark, sf_dir):
    return types.count_check(table(spark, sf_dir, "lineitem"), "l_orderkey", None, 5)


# --------------------------------------------------------------------------- typing

_PLAIN = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]


def _text_lines(spark, sf_dir):
    """Line items as a CSV would hold them, with values that are no numbers, fractions in a
    whole-number column, values out of range, and NA tokens."""
    text = tables.as_text(table(spark, sf_dir, "lineitem"))
    tax, discount = F.col("l_tax"), F.col("l_discount")
    written = text.select(
        *[F.col(c) for c in _PLAIN],
        F.when(tax == "0.01", F.concat(F.lit(" "), "l_orderkey")).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        F.when(tax == "0.02", F.concat("l_linenumber", F.lit(".5")))
        .when(tax == "0.03", F.lit("300"))
        .when(tax == "0.04", F.concat("l_linenumber", F.lit(".0")))
        .otherwise(F.col("l_linenumber"))
        .alias("l_linenumber"),
        F.when(discount == "0.01", F.lit("NA"))
        .when(discount == "0.02", F.lit("many"))
        .when(discount == "0.03", F.lit("1e3"))
        .when(discount == "0.04", F.lit("17d"))
        .otherwise(F.col("l_quantity"))
        .alias("l_quantity"),
        F.when(discount == "0.05", F.lit("")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
    )
    return written.select(*[na_to_null(F.col(c)).alias(c) for c in written.columns])


_TEXT_LINES = """lines AS (SELECT
    CASE WHEN l_tax = 0.01 THEN ' ' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS l_orderkey,
    CASE WHEN l_tax = 0.02 THEN l_linenumber || '.5' WHEN l_tax = 0.03 THEN '300'
    WHEN l_tax = 0.04 THEN l_linenumber || '.0' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
    CASE WHEN l_discount = 0.01 THEN NULL WHEN l_discount = 0.02 THEN 'many' WHEN l_discount = 0.03 THEN '1e3'
    WHEN l_discount = 0.04 THEN '17d' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity,
    CASE WHEN l_discount = 0.05 THEN NULL ELSE l_returnflag END AS l_returnflag,
    l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
    FROM lineitem),
    typed AS (SELECT CAST(trim(l_orderkey) AS BIGINT) AS l_orderkey,
    CASE WHEN l_linenumber LIKE '%.5' OR l_linenumber = '300' THEN NULL
    ELSE CAST(CAST(l_linenumber AS DOUBLE) AS TINYINT) END AS l_linenumber,
    TRY_CAST(l_quantity AS DOUBLE) AS l_quantity, l_returnflag, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax,
    l_linestatus, l_shipdate FROM lines)"""


def _line_plan(spark, sf_dir):
    described = types.describe_table(table(spark, sf_dir, "lineitem"), choices=["l_returnflag"])
    narrow = F.when(F.col("column") == "l_linenumber", F.lit("byte")).otherwise(F.col("type"))
    return types.column_types(described.withColumn("type", narrow))


@query("typed_table", f"WITH {_TEXT_LINES} SELECT * FROM typed")
def typed_table(spark, sf_dir):
    return types.apply_types(_text_lines(spark, sf_dir), _line_plan(spark, sf_dir))


_APPLIED = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "tinyint",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "string",
}
_REPORT = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS type_applied, (SELECT count(*) - count({c}) FROM lines) AS n_missing_before,
    (SELECT count({c}) FROM lines) - (SELECT count({c}) FROM typed) AS n_new_nulls"""
    for c, t in _APPLIED.items()
)


@query("coercion_report", f"WITH {_TEXT_LINES} {_REPORT}")
def coercion_report(spark, sf_dir):
    return types.coercion_report(_text_lines(spark, sf_dir), _line_plan(spark, sf_dir))


@query(
    "coercion_summary",
    f"""WITH {_TEXT_LINES}, r AS ({_REPORT}) SELECT count(*) AS n_columns,
    count(*) FILTER (WHERE n_new_nulls > 0) AS n_columns_with_losses, CAST(sum(n_new_nulls) AS BIGINT) AS n_values_lost
    FROM r""",
)
def coercion_summary(spark, sf_dir):
    return types.coercion_summary(coercion_report(spark, sf_dir))


# ------------------------------------------------------------------- sources and sinks

_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "csv_round_trip",
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _EVENT_COLUMNS) + " FROM events",
)
def csv_round_trip(spark, sf_dir):
    """The whole table as text through a CSV."""
    path = scratch_path(spark, "events-csv")
    events = table(spark, sf_dir, "events")
    tables.write_report_csv(tables.as_text(events), path)
    return tables.read_text_csv(spark, path, events.columns)


@query(
    "csv_multi_line",
    "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations",
)
def csv_multi_line(spark, sf_dir):
    path = scratch_path(spark, "conversations-csv")
    tables.write_report_csv(table(spark, sf_dir, "conversations"), path)
    return tables.read_text_csv(spark, path, multi_line=True)


@query(
    "layer_round_trip",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def layer_round_trip(spark, sf_dir):
    return tables.write_layer(table(spark, sf_dir, "customer"), scratch_path(spark, "layer"))


@query(
    "labelled_export",
    f"""WITH {_FILLED} SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, true AS same_shape,
    true AS same_schema, true AS same_content, CAST(2 AS BIGINT) AS n_labelled FROM filled""",
)
def labelled_export(spark, sf_dir):
    filled = impute_plan(spark, sf_dir)
    labels = {"p_size": "Size of the part", "p_type": "Type of the part"}
    return tables.export_table(filled, labels, scratch_path(spark, "export"))


@query(
    "flag_codes",
    f"WITH {_FILLED}, f AS ("
    + union_all(
        ["p_size_imputed", "price_imputed"],
        "SELECT '{c}' AS \"column\", CAST({c} AS INTEGER) AS v FROM filled",
    )
    + """) SELECT "column", CAST(v AS VARCHAR) AS code, CASE v WHEN 0 THEN 'Not imputed' ELSE 'Imputed' END AS label,
    count(*) AS "count" FROM f GROUP BY ALL""",
)
def flag_codes(spark, sf_dir):
    """Flag columns as codes, counted under the value labels their metadata carries."""
    coded = tables.flags_to_codes(impute_plan(spark, sf_dir))
    flags = columns_with_suffix(coded, "_imputed")
    labels = coded.schema[flags[0]].metadata["value_labels"]
    shown = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return value_counts(coded, flags).select(
        "column", F.col("value").alias("code"), shown[F.col("value")].alias("label"), "count"
    )

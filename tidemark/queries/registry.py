"""Registration of queries and a few helpers to state them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query '{name}' is registered twice")
        _queries[name] = function
        if sql:
            _sql[name] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def union_all(columns: Sequence[str], template: str) -> str:
    """One SELECT per column; ``{c}`` is the column and ``{i}`` its position."""
    return " UNION ALL ".join(template.format(c=c, i=i) for i, c in enumerate(columns))


# ------------------------------------------------------------------- shared inputs
# Each input comes as a Spark plan and as the same common table expression in SQL.


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; unlabelled documents have gaps."""
    documents = table(spark, sf_dir, "documents")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED_DOCUMENTS = (
    "docs AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
)


def gated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose language answer is empty for one source, and whose quality answer is
    only asked for German texts."""
    return labelled_documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        F.when(F.col("source") != "src3", F.col("lang")).alias("gate"),
        "quality",
        "toxic",
        F.when(F.col("lang") == "de", F.col("quality")).alias("quality_de"),
    )


GATED_DOCUMENTS = (
    LABELLED_DOCUMENTS
    + """, gated AS (SELECT doc_id, lang, CASE WHEN source <> 'src3' THEN lang END AS gate,
    quality, toxic, CASE WHEN lang = 'de' THEN quality END AS quality_de FROM docs)"""
)


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the ship date as a date."""
    return table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date").cast("string")
    )


LINE_ITEMS = (
    "items AS (SELECT * REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate) FROM lineitem)"
)

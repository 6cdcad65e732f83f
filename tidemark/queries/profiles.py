"""Missing values, frequencies, bins and other profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import distribution, missing
from tidemark.queries.registry import (
    GATED_DOCUMENTS,
    LABELLED_DOCUMENTS,
    gated_documents,
    labelled_documents,
    query,
    table,
    union_all,
)
from tidemark.spec import GateRule

_DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_UNKNOWN_PRIORITY = "4-NOT SPECIFIED"
_ORDER_COLUMNS = ["o_orderstatus", "o_totalprice", "o_orderpriority"]


def _missing_sql(relation: str, columns) -> str:
    return union_all(
        columns,
        "SELECT {i} AS pos, '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_missing FROM "
        + relation,
    )


_PCT = "round(100.0 * n_missing / n_rows, 2)"


@query(
    "missingness",
    f"""WITH {LABELLED_DOCUMENTS}, m AS ({_missing_sql("docs", _DOC_COLUMNS)})
    SELECT "column", n_missing, {_PCT} AS pct_missing FROM m""",
)
def missingness(spark, sf_dir):
    return missing.missingness(labelled_documents(spark, sf_dir))


@query(
    "mean_missingness",
    f"""WITH {LABELLED_DOCUMENTS}, m AS ({_missing_sql("docs", _DOC_COLUMNS)})
    SELECT count(*) AS n_columns, round(avg(n_missing / n_rows) * 100, 4) AS mean_pct_missing FROM m""",
)
def mean_missingness(spark, sf_dir):
    return missing.mean_missingness(labelled_documents(spark, sf_dir))


@query(
    "heavy_missing",
    f"""WITH {GATED_DOCUMENTS}, m AS ({_missing_sql("gated", ["lang", "gate", "quality", "quality_de"])})
    SELECT "column", n_missing, {_PCT} AS pct_missing FROM m WHERE {_PCT} > 90""",
)
def heavy_missing(spark, sf_dir):
    df = gated_documents(spark, sf_dir)
    return missing.heavy_missing(missing.missingness(df, ["lang", "gate", "quality", "quality_de"]))


@query(
    "worst_columns",
    f"""WITH {GATED_DOCUMENTS}, m AS ({_missing_sql("gated", ["doc_id", "lang", "gate", "quality", "toxic", "quality_de"])})
    SELECT "column", n_missing, {_PCT} AS pct_missing FROM m
    ORDER BY pct_missing DESC, n_missing DESC, "column" LIMIT 3""",
)
def worst_columns(spark, sf_dir):
    return missing.worst_columns(missing.missingness(gated_documents(spark, sf_dir)), 3)


def _orders_corrected(spark, sf_dir):
    before = table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS)
    after = before.withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderpriority") != _UNKNOWN_PRIORITY, F.col("o_orderpriority")),
    ).withColumn("is_open", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "O"))
    return before, after


_ORDERS_CORRECTED = f"""after_ AS (SELECT o_orderstatus, o_totalprice,
    nullif(o_orderpriority, '{_UNKNOWN_PRIORITY}') AS o_orderpriority,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'O' END AS is_open FROM orders)"""


@query(
    "missingness_change",
    f"""WITH {_ORDERS_CORRECTED}, b AS ({_missing_sql("orders", _ORDER_COLUMNS)}),
    a AS ({_missing_sql("after_", _ORDER_COLUMNS)})
    SELECT b."column", round(100.0 * b.n_missing / b.n_rows, 2) AS pct_before,
    round(100.0 * a.n_missing / a.n_rows, 2) AS pct_after FROM b JOIN a ON a."column" = b."column" """,
)
def missingness_change(spark, sf_dir):
    before, after = _orders_corrected(spark, sf_dir)
    return missing.missingness_change(before, after)


@query(
    "raw_vs_cleaned",
    f"""WITH {_ORDERS_CORRECTED}, b AS ({_missing_sql("orders", _ORDER_COLUMNS)}),
    a AS ({_missing_sql("after_", [*_ORDER_COLUMNS, "is_open"])})
    SELECT a."column", coalesce(CAST(round(100.0 * b.n_missing / b.n_rows, 2) AS VARCHAR), 'N/A (derived column)')
    AS pct_missing_raw, CAST(round(100.0 * a.n_missing / a.n_rows, 2) AS VARCHAR) AS pct_missing_cleaned
    FROM a LEFT JOIN b ON a."column" = b."column" """,
)
def raw_vs_cleaned(spark, sf_dir):
    before, after = _orders_corrected(spark, sf_dir)
    return missing.raw_vs_cleaned(before, after, after.columns).drop("position")


_GATES = [("quality", "gate", "en"), ("toxic", "lang", "de"), ("quality_de", "lang", "de")]
_GATES_SQL = " UNION ALL ".join(
    f"""SELECT '{d}' AS dependent_col, '{g}' AS gate_col, count(*) FILTER (WHERE {d} IS NULL) AS n_missing,
    count(*) FILTER (WHERE {d} IS NULL AND {g} IS DISTINCT FROM '{v}') AS n_structural,
    count(*) FILTER (WHERE {d} IS NULL AND {g} IS NOT DISTINCT FROM '{v}') AS n_incidental FROM gated"""
    for d, g, v in _GATES
)
_GATE_SPLIT = f"""WITH {GATED_DOCUMENTS}, s AS ({_GATES_SQL}), split AS (SELECT *,
    CASE WHEN n_missing > 0 THEN round(100.0 * n_structural / n_missing, 2) ELSE 0.0 END
    AS pct_structural FROM s)"""


@query("gate_split", f"{_GATE_SPLIT} SELECT * FROM split")
def gate_split(spark, sf_dir):
    return missing.gate_split(gated_documents(spark, sf_dir), [GateRule(*g) for g in _GATES])


@query(
    "mostly_incidental",
    f"{_GATE_SPLIT} SELECT * FROM split WHERE n_missing > 0 AND pct_structural < 90",
)
def mostly_incidental(spark, sf_dir):
    return missing.mostly_incidental(gate_split(spark, sf_dir))


@query(
    "residual_missing",
    f"""WITH {GATED_DOCUMENTS}
    SELECT 'quality' AS "column", count(*) FILTER (WHERE gate = 'en') AS n_population,
    count(*) FILTER (WHERE quality IS NULL) AS n_missing,
    count(*) FILTER (WHERE quality IS NULL AND gate = 'en') AS n_incidental FROM gated
    UNION ALL SELECT 'toxic', count(*), count(*) FILTER (WHERE toxic IS NULL),
    count(*) FILTER (WHERE toxic IS NULL) FROM gated""",
)
def residual_missing(spark, sf_dir):
    return missing.residual_missing(
        gated_documents(spark, sf_dir), {"quality": "gate = 'en'", "toxic": None}
    )


def _frequency_sql(relation: str, column: str, label: str | None = None) -> str:
    return f"""SELECT {column} AS code, {label or column} AS label, count(*) AS "count",
    round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_of_valid
    FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column}"""


@query("frequency", _frequency_sql("events", "event_type"))
def frequency(spark, sf_dir):
    return distribution.frequency_table(table(spark, sf_dir, "events"), "event_type")


@query(
    "frequency_labelled",
    _frequency_sql(
        "orders",
        "o_orderstatus",
        "CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE o_orderstatus END",
    ),
)
def frequency_labelled(spark, sf_dir):
    return distribution.frequency_table(
        table(spark, sf_dir, "orders"), "o_orderstatus", {"O": "Open", "F": "Filled"}
    )


@query(
    "frequency_many",
    union_all(
        ["l_returnflag", "l_linestatus", "l_linenumber"],
        "SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" FROM lineitem GROUP BY {c}",
    ),
)
def frequency_many(spark, sf_dir):
    return distribution.value_counts(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
    )


@query(
    "frequency_missing",
    f"WITH {GATED_DOCUMENTS} "
    + union_all(
        ["gate", "quality", "toxic"],
        "SELECT '{c}' AS \"column\", count({c}) AS n_valid, count(*) - count({c}) AS n_missing FROM gated",
    ),
)
def frequency_missing(spark, sf_dir):
    return distribution.valid_and_missing(gated_documents(spark, sf_dir), ["gate", "quality", "toxic"])


@query(
    "category_ranking",
    """SELECT source AS label, count(*) AS "count" FROM documents GROUP BY source ORDER BY 2""",
)
def category_ranking(spark, sf_dir):
    return distribution.category_ranking(table(spark, sf_dir, "documents"), "source")


@query(
    "category_share",
    """WITH s AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS o,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus IS NULL) AS n_missing
    FROM orders)
    SELECT 'O' AS category, o AS "count", o + f AS n_valid, round(100.0 * o / (o + f), 2) AS pct, n_missing FROM s
    UNION ALL SELECT 'F', f, o + f, round(100.0 * f / (o + f), 2), n_missing FROM s""",
)
def category_share(spark, sf_dir):
    return distribution.category_share(table(spark, sf_dir, "orders"), "o_orderstatus", ["O", "F"])


@query(
    "dominant_category",
    f"""WITH {GATED_DOCUMENTS}, c AS (SELECT gate, count(*) AS n FROM gated WHERE gate IS NOT NULL GROUP BY gate)
    SELECT gate AS label, n AS "count", round(100.0 * n / (SELECT sum(n) FROM c), 2) AS pct_of_valid,
    (SELECT count(*) FROM gated WHERE gate IS NULL) AS n_missing
    FROM c ORDER BY n DESC, gate LIMIT 1""",
)
def dominant_category(spark, sf_dir):
    return distribution.dominant_category(gated_documents(spark, sf_dir), "gate")


# the second bin is empty on purpose, and prices above 400000 fall outside every bin
_BINS = [
    ("below 0", -1000.0, 0.0),
    ("0-999", 0.0, 1000.0),
    ("1000-99999", 1000.0, 100000.0),
    ("100000-249999", 100000.0, 250000.0),
    ("250000-399999", 250000.0, 400000.0),
]
_BINS_SQL = ", ".join(f"({i}, '{label}', {lo}, {hi})" for i, (label, lo, hi) in enumerate(_BINS))


@query(
    "binned",
    f"""WITH bins(bin, label, lo, hi) AS (VALUES {_BINS_SQL}),
    c AS (SELECT bin, label, count(o_orderkey) AS n FROM bins LEFT JOIN orders
    ON o_totalprice >= lo AND o_totalprice < hi GROUP BY bin, label)
    SELECT bin, label, n AS "count", round(100.0 * n / sum(n) OVER (), 2) AS pct_of_valid,
    CAST((SELECT count(*) FROM orders) - sum(n) OVER () AS BIGINT) AS n_missing FROM c""",
)
def binned(spark, sf_dir):
    return distribution.binned_distribution(table(spark, sf_dir, "orders"), "o_totalprice", _BINS)


def _mixed_casing(spark, sf_dir):
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, F.lower(segment))
        .when(F.col("c_acctbal") > 9000, F.concat(segment, F.lit("\t")))
        .otherwise(segment)
        .alias("written_segment"),
        F.nullif(segment, segment).alias("never_filled"),
    )


@query(
    "casing",
    """WITH c AS (SELECT c_mktsegment, CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment)
    WHEN c_acctbal > 9000 THEN c_mktsegment || chr(9) ELSE c_mktsegment END AS written_segment,
    nullif(c_mktsegment, c_mktsegment) AS never_filled FROM customer) """
    + union_all(
        ["c_mktsegment", "written_segment", "never_filled"],
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) = count(DISTINCT lower(trim({c}, ' ' || chr(9)))) AS casing_consistent FROM c",
    ),
)
def casing(spark, sf_dir):
    return distribution.casing_consistency(
        _mixed_casing(spark, sf_dir), ["c_mktsegment", "written_segment", "never_filled"]
    )


def _listed(relation: str, column: str, many: str) -> str:
    return f"""SELECT '{column}' AS "column", CASE WHEN count(DISTINCT {column}) = 0 THEN ''
    WHEN count(DISTINCT {column}) <= 8 THEN string_agg(DISTINCT {column}, '; ' ORDER BY {column})
    ELSE {many} END AS value_set_or_range FROM {relation}"""


@query(
    "value_sets",
    " UNION ALL ".join(
        [
            _listed("part", "p_name", "'free text (' || count(DISTINCT p_name) || ' distinct values)'"),
            _listed("part", "p_brand", "count(DISTINCT p_brand) || ' distinct values'"),
            _listed("part", "p_type", "''"),
            union_all(
                ["p_partkey", "p_size", "p_retailprice"],
                "SELECT '{c}', CAST(min({c}) AS VARCHAR) || '–' || CAST(max({c}) AS VARCHAR) FROM part",
            ),
            "SELECT 'is_large', 'False–True' FROM (SELECT count(*) FROM part)",
        ]
    ),
)
def value_sets(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    branded = part.select(
        "p_partkey",
        "p_name",
        F.col("p_brand").alias("p_brand", metadata={"kind": "category"}),
        "p_type",
        "p_size",
        "p_retailprice",
        (F.col("p_size") > 25).alias("is_large"),
    )
    return distribution.value_sets(branded)


@query(
    "pseudo_key",
    union_all(
        ["user_id", "event_id"],
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, count(*) AS n_rows,"
        " count(DISTINCT {c}) = count(*) AS is_key FROM events",
    ),
)
def pseudo_key(spark, sf_dir):
    return distribution.pseudo_key_check(table(spark, sf_dir, "events"), ["user_id", "event_id"])


@query(
    "code_width",
    """WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS code FROM part)
    SELECT 'code' AS "column", 'width <> 4' AS condition, count(*) AS n_codes,
    count(*) FILTER (WHERE length(code) <> 4) AS n_off_width, CAST(min(length(code)) AS INTEGER) AS min_width,
    CAST(max(length(code)) AS INTEGER) AS max_width FROM c
    UNION ALL SELECT 'code', 'width = 3', count(*), count(*) FILTER (WHERE length(code) = 3),
    CAST(min(length(code)) AS INTEGER), CAST(max(length(code)) AS INTEGER) FROM c""",
)
def code_width(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("code"))
    return distribution.code_width_check(codes, [("code", "width <> 4"), ("code", "width = 3")])


_KINDS = ["p_brand", "p_type"]


@query(
    "category_columns",
    union_all(
        _KINDS,
        "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS \"count\" FROM part GROUP BY {c}",
    ),
)
def category_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_name", *[F.col(c).alias(c, metadata={"kind": "category"}) for c in _KINDS]
    )
    return distribution.value_counts(part, distribution.columns_of_kind(part, "category"))


@query(
    "value_sets_extremes",
    """SELECT 'tiny' AS "column", '0.' || repeat('0', 6) || min(p_size) || '–0.' || repeat('0', 7 - length(CAST(max(p_size)
    AS VARCHAR))) || rtrim(CAST(max(p_size) AS VARCHAR), '0') AS value_set_or_range FROM part
    UNION ALL SELECT 'huge', min(p_size) || repeat('0', 33) || '.0–' || max(p_size) || repeat('0', 33) || '.0' FROM part""",
)
def value_sets_extremes(spark, sf_dir):
    """Ranges of very small and very large numbers, with all their digits."""
    scaled = lambda power: F.concat(F.col("p_size").cast("string"), F.lit(power)).cast("double")
    part = table(spark, sf_dir, "part").select(scaled("E-7").alias("tiny"), scaled("E33").alias("huge"))
    return distribution.value_sets(part)

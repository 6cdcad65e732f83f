"""Data dictionary, problem inventory, recommendations, report facts, and the full run."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from tidemark.operators import dedup, document, rules
from tidemark.operators import typing as types
from tidemark.plans.clean import clean
from tidemark.plans.diagnose import diagnose
from tidemark.plans.report import report_facts as build_facts
from tidemark.plans.run import Input, impute_stage, run_all
from tidemark.queries.cleaning import (
    CLEANED_SALES_SQL,
    SALES,
    SALES_SQL,
    hierarchies,
    sales,
)
from tidemark.queries.registry import query, table
from tidemark.queries.text import near_duplicates_sql
from tidemark.session import materialize, scratch_path
from tidemark.sources import tables
from tidemark.spec import DatasetSpec, GateRule, ImputeRule, OutlierRule, SentinelRule

# -------------------------------------------------------------------- data dictionary

PARTS = DatasetSpec(
    name="parts",
    keys=("p_partkey",),
    sentinels=(SentinelRule(("p_size",), 50), SentinelRule(("p_type",), "PROMO")),
    gates=(GateRule("p_type", "p_brand", "Brand#1"),),
    outliers=OutlierRule(("p_retailprice",)),
    free_text=("p_name",),
    impute=(ImputeRule("p_size", None),),
    left_missing=("p_type",),
    notes={"p_partkey": "Key of the part."},
)
_DESCRIPTIONS = {"p_partkey": "Key", "p_name": "Name", "p_size": "Size"}

_PART_LAYERS = """cleaned AS (SELECT * REPLACE (nullif(p_size, 50) AS p_size, nullif(p_type, 'PROMO') AS p_type) FROM part),
    final AS (SELECT * REPLACE (coalesce(p_size, (SELECT CAST(round_even(median(p_size), 0) AS INTEGER) FROM cleaned))
    AS p_size), p_size IS NULL AS p_size_imputed FROM cleaned)"""
_RANGE = "(SELECT CAST(min({c}) AS VARCHAR) || '–' || CAST(max({c}) AS VARCHAR) FROM final)"
_LISTED = """(SELECT CASE WHEN count(DISTINCT {c}) <= 8 THEN string_agg(DISTINCT {c}, '; ' ORDER BY {c})
    ELSE 'free text (' || count(DISTINCT {c}) || ' distinct values)' END FROM final)"""
_PCT_OF = "(SELECT CAST(round(100.0 * (count(*) - count({c})) / count(*), 2) AS VARCHAR) FROM {r})"


def _dictionary_row(column, type_, label, values, treatment, note, derived=False):
    absent = "'N/A (derived column)'"
    raw = absent if derived else _PCT_OF.format(c=column, r="part")
    cleaned = absent if derived else _PCT_OF.format(c=column, r="cleaned")
    return f"""SELECT '{column}' AS variable, '{type_}' AS type, '{label}' AS label,
    {values.format(c=column)} AS value_set_or_range, {raw} AS pct_missing_raw, {cleaned} AS pct_missing_cleaned,
    {treatment} AS imputation_treatment, '{note}' AS notes"""


_NONE_MISSING = "'Complete'"
_DICTIONARY = " UNION ALL ".join(
    [
        _dictionary_row("p_partkey", "bigint", "Key", _RANGE, _NONE_MISSING, "Key of the part."),
        _dictionary_row(
            "p_name", "string", "Name", _LISTED, _NONE_MISSING,
            "Free text; spellings at least 0.98 alike are merged.",
        ),
        _dictionary_row("p_brand", "string", "", _LISTED, _NONE_MISSING, ""),
        _dictionary_row(
            "p_type", "string", "", _LISTED, "'Left empty on purpose'",
            "Asked only if p_brand is Brand#1.",
        ),
        _dictionary_row(
            "p_size", "int", "Size", _RANGE,
            "(SELECT 'Filled with the median, ' || count(*) || ' row(s)' FROM final WHERE p_size_imputed)", "",
        ),
        _dictionary_row(
            "p_retailprice", "double", "", _RANGE, _NONE_MISSING, "Outliers beyond 1.5 IQR are flagged."
        ),
        _dictionary_row(
            "p_size_imputed", "boolean", "Size: filled (yes or no)",
            "'False–True'", "'Marks filled values'", "", derived=True,
        ),
    ]
)


def _part_layers(spark, sf_dir):
    raw = table(spark, sf_dir, "part")
    cleaned = rules.correct_sentinels(raw, PARTS.sentinels)
    final, _ = impute_stage(cleaned, PARTS)
    return raw, cleaned, final


@query("data_dictionary", f"WITH {_PART_LAYERS} {_DICTIONARY}")
def data_dictionary(spark, sf_dir):
    return document.data_dictionary(PARTS, *_part_layers(spark, sf_dir), _DESCRIPTIONS)


@query(
    "dictionary_summary",
    f"""WITH {_PART_LAYERS}, d AS ({_DICTIONARY}) SELECT count(*) AS n_variables,
    count(*) FILTER (WHERE imputation_treatment LIKE 'Filled with the median%') AS n_imputed_variables,
    count(*) FILTER (WHERE imputation_treatment LIKE 'Left empty%') AS n_left_missing FROM d""",
)
def dictionary_summary(spark, sf_dir):
    return document.dictionary_summary(data_dictionary(spark, sf_dir))


# ------------------------------------------------- inventory, recommendations, facts

_INVENTORY_ROWS = [
    ("returned", "Missing", "returned IS NULL", "left empty", "'None (structural)'"),
    ("l_quantity", "Missing", "l_quantity IS NULL", "flagged only", "'Low'"),
    ("l_quantity", "sentinel value 50.0", "l_quantity = 50", "correct_sentinels", "'Medium'"),
    ("l_tax", "sentinel value 0.08", "l_tax = 0.08", "correct_sentinels", "'Low'"),
    (
        "l_total",
        "l_quantity+l_linenumber does not match within 1.0",
        "abs(l_quantity + l_linenumber - l_total) > 1",
        "recompute_totals",
        "'Low'",
    ),
    (
        "l_total",
        "computed total: recalculated from its parts, not validated against them",
        "false",
        "recompute_totals",
        "'None'",
    ),
]
_INVENTORY = " UNION ALL ".join(
    f"""SELECT '{v}' AS variable, '{issue}' AS issue, count(*) FILTER (WHERE {test}) AS "count",
    round(100.0 * count(*) FILTER (WHERE {test}) / count(*), 2) AS pct,
    CASE WHEN count(*) FILTER (WHERE {test}) = 0 THEN 'None' ELSE {grade} END AS severity, '{by}' AS addressed_by FROM sales"""
    for v, issue, test, by, grade in _INVENTORY_ROWS
)


@query(
    "problem_inventory",
    f"""WITH {SALES_SQL} {_INVENTORY}
    UNION ALL SELECT 'l_orderkey', 'named like an ID: ' || count(DISTINCT l_orderkey) || ' distinct values across '
    || count(*) || ' rows', count(*), 100.0, 'High if used as a key',
    'not used as a join key' FROM sales""",
)
def problem_inventory(spark, sf_dir):
    return document.problem_inventory(
        sales(spark, sf_dir), replace(SALES, pseudo_keys=("l_orderkey",))
    )


# Every table of the diagnosis as one, its cells as text beside their column names.
_KEY = "l_orderkey, l_linenumber"
_RANGE_TEST = {"l_quantity": "l_quantity < 1 OR l_quantity > 49", "l_discount": "l_discount < 0 OR l_discount > 0.08"}


def _pct(part: str, whole: str) -> str:
    return f"round(100.0 * {part} / {whole}, 2)"


_DIAGNOSIS = f"""WITH {SALES_SQL}, {near_duplicates_sql("sales", "p_name", 0.95)},
    size AS (SELECT count(*) AS n FROM sales),
    copies AS (SELECT {_KEY} FROM sales QUALIFY count(*) OVER (PARTITION BY {_KEY}) > 1),
    missing AS ({" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n, {_pct(f"(count(*) - count({c}))", "count(*)")} AS pct
        FROM sales""" for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate", "p_name", "returned", "l_total", "volume", "part_code"))}),
    ranges AS ({" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n, count(DISTINCT {c}) = 1 AS one, CASE WHEN count(DISTINCT {c}) = 1
        THEN CAST(min({c}) AS DOUBLE) END AS v FROM sales WHERE {test}""" for c, test in _RANGE_TEST.items())}),
    out AS ({" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS v, count(*) AS n FROM sales WHERE {test} GROUP BY 2"""
        for c, test in _RANGE_TEST.items())}),
    gate AS (SELECT count(*) FILTER (returned IS NULL) AS n,
        count(*) FILTER (returned IS NULL AND l_linestatus IS DISTINCT FROM 'F') AS s FROM sales),
    top AS (SELECT l_returnflag AS label, count(*) AS n FROM sales WHERE l_returnflag IS NOT NULL GROUP BY 1
        ORDER BY n DESC, label LIMIT 1),
    recs AS (SELECT 'unique_key' AS "check", 'l_orderkey+l_linenumber' AS item, count(*) = 0 AS passed, count(*) AS n,
        CASE WHEN count(*) = 0 THEN 'no key repeats' ELSE CAST({_pct("count(*)", "(SELECT n FROM size)")} AS VARCHAR)
        || ' percent of the rows share a key' END AS detail FROM copies
    UNION ALL SELECT 'heavy_missing', 'columns above 90 percent missing', count(*) FILTER (pct > 90) = 0,
        count(*) FILTER (pct > 90), NULL FROM missing
    UNION ALL SELECT 'range', "column", n = 0, n, CASE WHEN n = 0 THEN 'within bounds' WHEN one
        THEN 'one value only: treat as a sentinel' ELSE 'inspect before cleaning' END FROM ranges
    UNION ALL SELECT 'gate', 'returned', NOT (n > 0 AND {_pct("s", "n")} < 90), n - s,
        CASE WHEN n > 0 AND {_pct("s", "n")} < 90 THEN 'real nonresponse' ELSE 'structural' END FROM gate
    UNION ALL SELECT 'share', c, true, count(*) FILTER (l_linestatus = c), CAST({_pct("count(*) FILTER (l_linestatus = c)",
        "count(*) FILTER (l_linestatus IN ('O', 'F'))")} AS VARCHAR) FROM sales, (VALUES ('O'), ('F')) t(c) GROUP BY c
    UNION ALL SELECT 'dominant', label, true, n, CAST({_pct("n", "(SELECT count(l_returnflag) FROM sales)")} AS VARCHAR)
        FROM top
    UNION ALL SELECT 'near_duplicates', 'value pairs', count(*) = 0, count(*), NULL FROM pairs)"""


@query("recommendations", f"{_DIAGNOSIS} SELECT * FROM recs")
def recommendations(spark, sf_dir):
    return diagnose(sales(spark, sf_dir), SALES).recommendations


@query(
    "diagnosis",
    f"""{_DIAGNOSIS}
    SELECT 'missingness' AS "table", "column" AS item, CAST(n AS DOUBLE) AS n, pct AS value, NULL AS detail FROM missing
    UNION ALL SELECT 'duplicates', l_orderkey || '/' || l_linenumber, count(*), NULL, NULL FROM copies GROUP BY {_KEY}
    UNION ALL SELECT 'range_summary', "column", n, v, CAST(coalesce(one, false) AS VARCHAR) FROM ranges
    UNION ALL SELECT 'range_values', "column", n, v, NULL FROM out
    UNION ALL SELECT 'filled', 'l_linestatus', count(l_linestatus), count(*) - count(l_linestatus), NULL FROM sales
    UNION ALL SELECT 'gate_split', 'returned', n, {_pct("s", "n")}, CAST(s AS VARCHAR) FROM gate
    UNION ALL SELECT 'near_duplicates', value_a, count_a, similarity, value_b FROM pairs
    UNION ALL SELECT 'status', l_linestatus, count(*), {_pct("count(*)", "(SELECT count(l_linestatus) FROM sales)")}, l_linestatus
    FROM sales WHERE l_linestatus IS NOT NULL GROUP BY l_linestatus
    UNION ALL SELECT 'recommendations', "check" || ' ' || item, n, CAST(passed AS DOUBLE), detail FROM recs""",
)
def diagnosis(spark, sf_dir):
    """Every table of the diagnosis with its contents."""
    found = diagnose(sales(spark, sf_dir), SALES)
    tables_ = found.tables()
    text = lambda c: c.cast("string")
    none = F.lit(None)

    def laid(name, table_, item, n, value, detail):
        return table_.select(
            F.lit(name).alias("table"),
            text(item).alias("item"),
            n.cast("double").alias("n"),
            value.cast("double").alias("value"),
            text(detail).alias("detail"),
        )

    c = F.col
    copies = tables_["duplicates"].groupBy(*SALES.keys).agg(F.count(F.lit(1)).alias("n"))
    parts = [
        laid("missingness", tables_["missingness"], c("column"), c("n_missing"), c("pct_missing"), none),
        laid("duplicates", copies, F.concat_ws("/", *SALES.keys), c("n"), none, none),
        laid("range_summary", tables_["range_summary"], c("column"), c("n_flagged"), c("sentinel_value"), c("is_sentinel")),
        laid("range_values", tables_["range_values"], c("column"), c("count"), c("value"), none),
        laid("filled", tables_["filled"], c("column"), c("n_valid"), c("n_missing"), none),
        laid("gate_split", tables_["gate_split"], c("dependent_col"), c("n_missing"), c("pct_structural"), c("n_structural")),
        laid("near_duplicates", tables_["near_duplicates"], c("value_a"), c("count_a"), c("similarity"), c("value_b")),
        laid("status", found.distributions["status"], c("code"), c("count"), c("pct_of_valid"), c("label")),
        laid(
            "recommendations", tables_["recommendations"], F.concat_ws(" ", "check", "item"), c("n"),
            c("passed").cast("int"), c("detail"),
        ),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


_IMPUTED_SALES = """med AS (SELECT round_even(median(l_quantity), 0) AS q FROM cleaned),
    filled AS (SELECT cleaned.* REPLACE (CASE WHEN l_quantity IS NULL AND returned IS NOT NULL THEN q ELSE l_quantity END
    AS l_quantity), CAST(l_quantity IS NULL AND returned IS NOT NULL AS INTEGER) AS l_quantity_imputed
    FROM cleaned, med),
    final AS (SELECT * REPLACE (CASE WHEN returned IS NOT NULL THEN l_quantity + l_linenumber END AS l_total)
    FROM filled)"""

_FINAL_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate", "p_name", "returned", "l_total", "volume", "part_code",
    "section", "section_label", "l_quantity_imputed",
]
_TYPED_COLUMNS = _FINAL_COLUMNS[:16]


def _fact(section, item, metric, value, source=""):
    return f"""SELECT '{section}' AS section, '{item}' AS item, '{metric}' AS metric,
    round(CAST({value} AS DOUBLE), 4) AS value {source}"""


def _mean_missing(relation, columns):
    shares = " + ".join(f"(count(*) - count({c})) / count(*)" for c in columns)
    return f"(SELECT round(100 * ({shares}) / {len(columns)}, 4) FROM {relation})"


def _pct_missing(relation, column):
    return f"(SELECT round(100.0 * (count(*) - count({column})) / count(*), 2) FROM {relation})"


def _facts_sql(typed: str) -> str:
    """The facts for the layer ``typed``, whose keys may repeat."""
    return " UNION ALL ".join([
        _fact("before", "sales", "n_columns", 16),
        _fact("before", "sales", "mean_pct_missing", _mean_missing(typed, _TYPED_COLUMNS)),
        _fact("before", "sales", "n_rows", f"(SELECT count(*) FROM {typed})"),
        _fact("before", "sales", "n_keys", "(SELECT count(*) FROM kept)"),
        _fact("before", "sales", "n_surplus", f"(SELECT count(*) FROM {typed}) - (SELECT count(*) FROM kept)"),
        _fact("after", "sales", "n_columns", 19),
        _fact("after", "sales", "mean_pct_missing", _mean_missing("final", _FINAL_COLUMNS)),
        *[
            _fact("missingness", c, m, _pct_missing(r, c))
            for c in ("l_quantity", "l_tax")
            for m, r in (("pct_before", typed), ("pct_after", "cleaned"))
        ],
        *[
            _fact("cleaning", c, m, v, f"FROM {typed}")
            for c, t in (("l_quantity", "l_quantity = 50"), ("l_tax", "l_tax = 0.08"))
            for m, v in (
                ("count", f"count(*) FILTER (WHERE {t})"),
                ("pct", f"round(100.0 * count(*) FILTER (WHERE {t}) / count(*), 2)"),
            )
        ],
        _fact("cleaning", "part_code", "n_coded", "count(part_code)", "FROM cleaned"),
        _fact("cleaning", "part_code", "n_unclassified", "count(part_code) - count(section)", "FROM cleaned"),
        _fact(
            "cleaning", "p_name", "n_changed", "count(*)",
            "FROM kept JOIN cleaned USING (l_orderkey, l_linenumber) WHERE kept.p_name <> cleaned.p_name",
        ),
        """SELECT 'flags', rule_name, 'n_flags', CAST(count(*) AS DOUBLE) FROM flags GROUP BY rule_name""",
        _fact("flags", "sales", "n_flags", "count(*)", "FROM flags"),
        _fact("flags", "sales", "n_rows", "count(DISTINCT (l_orderkey, l_linenumber))", "FROM flags"),
        _fact("flags", "sales", "n_rules", "count(DISTINCT rule_name)", "FROM flags"),
        _fact("imputation", "l_quantity", "n_imputed", "sum(l_quantity_imputed)", "FROM final"),
        _fact("imputation", "l_quantity", "fill_value", "q", "FROM med"),
        *[
            _fact("after", c, m, f"{f}({c})", "FROM final")
            for c in ("l_quantity", "l_extendedprice")
            for m, f in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max"))
        ],
    ])


@query("report_facts", f"WITH RECURSIVE {CLEANED_SALES_SQL}, {_IMPUTED_SALES} {_facts_sql('kept')}")
def report_facts(spark, sf_dir):
    typed = materialize(dedup.keep_first(sales(spark, sf_dir), SALES.keys), "typed")
    result = clean(typed, SALES, hierarchies(spark, sf_dir))
    cleaned = materialize(result.table, "cleaned")
    final, fills = impute_stage(cleaned, SALES)
    found = build_facts(SALES, typed, cleaned, materialize(final, "final"), fills, result.kept, result.flags)
    return found.withColumn("value", F.round("value", 4))


# --------------------------------------------------------------------------- full run

# the diagnosis looks for near-duplicates before the cleaning drops repeated rows
_RUN_SQL = CLEANED_SALES_SQL.replace(
    near_duplicates_sql("corrected", "p_name", 0.95), near_duplicates_sql("sales", "p_name", 0.95)
)


def _run(spark, sf_dir):
    raw = sales(spark, sf_dir)
    data, dictionary = scratch_path(spark, "sales-csv"), scratch_path(spark, "sales-dictionary")
    tables.write_text_csv(raw, data)
    tables.write_report_csv(types.describe_table(raw, choices=["returned", "l_linestatus"]), dictionary)
    return run_all(
        spark,
        [Input(SALES, data, dictionary, staged=True)],
        scratch_path(spark, "run"),
        hierarchies(spark, sf_dir),
    )["sales"]


@query(
    "full_run",
    f"WITH RECURSIVE {_RUN_SQL}, {_IMPUTED_SALES} SELECT * REPLACE (CAST(l_quantity_imputed AS TINYINT)"
    " AS l_quantity_imputed) FROM final",
)
def full_run(spark, sf_dir):
    """From a CSV and its dictionary through every stage; returns the exported table."""
    return spark.read.parquet(_run(spark, sf_dir)["final"])


@query("full_run_facts", f"WITH RECURSIVE {_RUN_SQL}, {_IMPUTED_SALES} {_facts_sql('sales')}")
def full_run_facts(spark, sf_dir):
    """The facts that the full run writes; keys repeat in its typed layer."""
    written = tables.read_text_csv(spark, _run(spark, sf_dir)["report_facts"])
    return written.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query(
    "impute_stage",
    f"""WITH RECURSIVE {CLEANED_SALES_SQL}, {_IMPUTED_SALES} SELECT l_orderkey, l_linenumber, l_quantity, l_total,
    l_quantity_imputed = 1 AS l_quantity_imputed FROM final""",
)
def impute_stage_query(spark, sf_dir):
    cleaned = materialize(
        clean(sales(spark, sf_dir), SALES, hierarchies(spark, sf_dir)).table, "cleaned"
    )
    final, _ = impute_stage(cleaned, SALES)
    return final.select("l_orderkey", "l_linenumber", "l_quantity", "l_total", "l_quantity_imputed")

"""Row rules, value maps, classification, and the whole cleaning plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import strip
from tidemark.operators import keyed_layers, lookup, rules
from tidemark.plans.clean import Cleaned, Hierarchy, clean
from tidemark.queries.duplicates import KEY
from tidemark.queries.registry import (
    LABELLED_DOCUMENTS,
    LINE_ITEMS,
    labelled_documents,
    line_items,
    query,
    table,
    union_all,
)
from tidemark.queries.text import consolidation_sql, near_duplicates_sql
from tidemark.session import scratch_path
from tidemark.spec import (
    ClassifyRule,
    ConsistencyRule,
    DatasetSpec,
    DerivedTotal,
    FrequencySpec,
    GateRule,
    ImputeRule,
    MissingRule,
    OutlierRule,
    RangeRule,
    SentinelRule,
    SkipRule,
)

# ---------------------------------------------------------------------------- ranges

_LINE_RANGES = [
    RangeRule("l_discount", 0.0, 0.08),
    RangeRule("l_quantity", 2.0, None),
    RangeRule("l_tax", None, 0.07),
]


@query(
    "range_flags",
    """SELECT l_orderkey, l_linenumber, 'l_discount' AS "column", l_discount AS value FROM lineitem
    WHERE l_discount < 0 OR l_discount > 0.08
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', l_quantity FROM lineitem WHERE l_quantity < 2
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem WHERE l_tax > 0.07""",
)
def range_flags(spark, sf_dir):
    return rules.range_violations(table(spark, sf_dir, "lineitem"), KEY, _LINE_RANGES)


_PART_RANGES = [
    RangeRule("p_size", 1, 49),
    RangeRule("p_retailprice", 905, 995),
    RangeRule("p_partkey", 0, None),
]
_PART_RANGES_SQL = """v AS (SELECT 'p_size' AS "column", CAST(p_size AS DOUBLE) AS value FROM part
    WHERE p_size < 1 OR p_size > 49
    UNION ALL SELECT 'p_retailprice', p_retailprice FROM part WHERE p_retailprice < 905 OR p_retailprice > 995
    UNION ALL SELECT 'p_partkey', CAST(p_partkey AS DOUBLE) FROM part WHERE p_partkey < 0)"""


@query(
    "range_summary",
    f"""WITH {_PART_RANGES_SQL}, r("column") AS (VALUES ('p_size'), ('p_retailprice'), ('p_partkey'))
    SELECT "column", count(value) AS n_flagged, count(DISTINCT value) = 1 AS is_sentinel,
    CASE WHEN count(DISTINCT value) = 1 THEN min(value) END AS sentinel_value
    FROM r LEFT JOIN v USING ("column") GROUP BY "column" """,
)
def range_summary(spark, sf_dir):
    return rules.range_summary(table(spark, sf_dir, "part"), _PART_RANGES)


@query(
    "range_values",
    f"""WITH {_PART_RANGES_SQL} SELECT "column", value, count(*) AS "count" FROM v GROUP BY ALL""",
)
def range_values(spark, sf_dir):
    return rules.range_value_counts(table(spark, sf_dir, "part"), _PART_RANGES)


# ------------------------------------------------------------- sentinels and totals

_SENTINELS = [
    SentinelRule(("l_quantity",), 50.0),
    SentinelRule(("l_linenumber",), 7),
    SentinelRule(("l_discount", "l_tax"), 0.0),
]
_SENTINEL_PAIRS = [
    ("l_quantity", "50.0"),
    ("l_linenumber", "7"),
    ("l_discount", "0.0"),
    ("l_tax", "0.0"),
]
_CORRECTED = f"""{LINE_ITEMS}, corrected AS (SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity,
    nullif(l_linenumber, 7) AS l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax)
    FROM items)"""


@query("sentinel_null", f"WITH {_CORRECTED} SELECT * FROM corrected")
def sentinel_null(spark, sf_dir):
    return rules.correct_sentinels(line_items(spark, sf_dir), _SENTINELS)


@query(
    "sentinel_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{v}' AS sentinel, count(*) FILTER (WHERE {c} = {v}) AS "count",
        round(100.0 * count(*) FILTER (WHERE {c} = {v}) / count(*), 2) AS pct FROM lineitem"""
        for c, v in _SENTINEL_PAIRS
    ),
)
def sentinel_counts(spark, sf_dir):
    return rules.sentinel_counts(table(spark, sf_dir, "lineitem"), _SENTINELS)


_TOTALS = [
    DerivedTotal("units", ("l_quantity", "l_linenumber")),
    DerivedTotal("units_and_part", ("units", "l_partkey"), gate="l_discount"),
]
_TOTALS_SQL = f"""{_CORRECTED}, totals AS (SELECT l_orderkey, l_partkey, l_quantity + l_linenumber AS units,
    CASE WHEN l_discount IS NOT NULL THEN l_quantity + l_linenumber + l_partkey END AS units_and_part FROM corrected)"""


@query("derived_totals", f"WITH {_TOTALS_SQL} SELECT * FROM totals")
def derived_totals(spark, sf_dir):
    corrected = rules.correct_sentinels(line_items(spark, sf_dir), _SENTINELS)
    return rules.recompute_totals(corrected, _TOTALS).select(
        "l_orderkey", "l_partkey", "units", "units_and_part"
    )


@query(
    "change_counts",
    """SELECT 'units' AS "column", count(*) FILTER (WHERE (l_quantity + l_linenumber) IS DISTINCT FROM
    (nullif(l_quantity, 50) + nullif(l_linenumber, 7))) AS n_changed FROM lineitem""",
)
def change_counts(spark, sf_dir):
    raw = rules.recompute_totals(table(spark, sf_dir, "lineitem"), _TOTALS[:1])
    corrected = rules.correct_sentinels(raw, _SENTINELS)
    return rules.change_counts(corrected, rules.derived_totals(corrected, _TOTALS[:1]))


# ------------------------------------------------------------------------ flag rules

_REPORTED = """reported AS (SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_linenumber, 7) AS l_line,
    l_quantity + l_linenumber + CASE WHEN l_discount = 0.1 THEN 2 WHEN l_discount = 0.09 THEN 1 ELSE 0 END AS l_total
    FROM lineitem)"""


def _reported(spark, sf_dir):
    """Line items with a reported total that is off by 2 (an error), by 1 (tolerated) or by
    a part that is missing."""
    error = F.when(F.col("l_discount") == 0.1, 2).when(F.col("l_discount") == 0.09, 1).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("l_line"),
        (F.col("l_quantity") + F.col("l_linenumber") + error).alias("l_total"),
    )


_MISMATCH = ConsistencyRule("total_mismatch", ("l_quantity", "l_line"), "l_total", 1.0)


@query(
    "consistency",
    f"""WITH {_REPORTED} SELECT l_orderkey, l_linenumber, 'total_mismatch' AS rule_name,
    CAST(l_total AS DOUBLE) AS value, coalesce(l_quantity, 0) + coalesce(l_line, 0) - 1 AS low,
    coalesce(l_quantity, 0) + coalesce(l_line, 0) + 1 AS high,
    'l_quantity+l_line=' || CAST(coalesce(l_quantity, 0) + coalesce(l_line, 0) AS VARCHAR) || ' vs l_total='
    || CAST(CAST(l_total AS DOUBLE) AS VARCHAR) AS detail FROM reported
    WHERE abs(coalesce(l_quantity, 0) + coalesce(l_line, 0) - l_total) > 1""",
)
def consistency(spark, sf_dir):
    return rules.flag_rows(_reported(spark, sf_dir), KEY, [rules.consistency_flag(_MISMATCH)])


@query(
    "skip_violation",
    f"""WITH {LABELLED_DOCUMENTS} SELECT doc_id, 'toxic_without_evidence' AS rule_name, CAST(NULL AS DOUBLE) AS value,
    CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, 'no evidence' AS detail FROM docs
    WHERE toxic IS NOT NULL AND NOT coalesce(quality = 1, false) AND NOT coalesce(lang = 'de', false)""",
)
def skip_violation(spark, sf_dir):
    rule = SkipRule("toxic_without_evidence", "toxic", ("quality = 1", "lang = 'de'"), "no evidence")
    return rules.flag_rows(labelled_documents(spark, sf_dir), ["doc_id"], [rules.skip_flag(rule)])


def _fences(relation: str, column: str) -> str:
    q1, q3 = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    return f"""(SELECT {q1} - 1.5 * ({q3} - {q1}) AS low, {q3} + 1.5 * ({q3} - {q1}) AS high FROM {relation}
    HAVING count({column}) >= 10 AND {q3} <> {q1})"""


@query(
    "iqr_flags",
    f"""SELECT event_id, 'outlier_value' AS rule_name, value, round(low, 6) AS low, round(high, 6) AS high,
    'value=' || CAST(value AS VARCHAR) || ' outside IQR bounds [' || CAST(CAST(round_even(low, 0) AS BIGINT) AS VARCHAR)
    || ', ' || CAST(CAST(round_even(high, 0) AS BIGINT) AS VARCHAR) || ']' AS detail
    FROM events, {_fences("events", "value")} WHERE value < low OR value > high""",
)
def iqr_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = rules.outlier_flags(events, OutlierRule(("value",)))
    return rules.flag_rows(events, ["event_id"], found).withColumns(
        {"low": F.round("low", 6), "high": F.round("high", 6)}
    )


# ------------------------------------------------------------- value maps, versions

_EVENT_MAP = [
    ("event_type", "signup", "sign-up"),
    ("event_type", "purchase", "sale"),
    ("event_type", "refund", "return"),
]
_EVENT_MAP_SQL = "m(f, t) AS (VALUES ('signup', 'sign-up'), ('purchase', 'sale'), ('refund', 'return'))"


def _mapped_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return events, lookup.mapping_table(events, _EVENT_MAP)


@query(
    "value_map",
    f"""WITH {_EVENT_MAP_SQL} SELECT event_id, coalesce(t, event_type) AS event_type, user_id FROM events
    LEFT JOIN m ON event_type = f""",
)
def value_map(spark, sf_dir):
    events, mapping = _mapped_events(spark, sf_dir)
    return lookup.apply_value_map(events, mapping, ["event_type"])


@query(
    "value_map_repeated",
    """WITH m(f, t) AS (VALUES ('signup', 'sign-up'), ('purchase', 'sale')) SELECT event_id,
    coalesce(t, event_type) AS event_type FROM events LEFT JOIN m ON event_type = f""",
)
def value_map_repeated(spark, sf_dir):
    """Several entries for one value, and text with white space around it, multiply no row."""
    events = table(spark, sf_dir, "events")
    written = events.select("event_id", F.concat(F.lit("\t"), "event_type", F.lit(" \n")).alias("event_type"))
    entries = [
        ("event_type", "signup", "sign-up"),
        ("event_type", "signup", "signed up"),
        ("event_type", "purchase", "sale"),
        ("event_type", "purchase", "sale"),
    ]
    mapped = lookup.apply_value_map(written, lookup.mapping_table(events, entries), ["event_type"], trim=True)
    return mapped.withColumn("event_type", strip("event_type"))


@query(
    "value_map_effect",
    f"""WITH {_EVENT_MAP_SQL} SELECT 'event_type' AS "column", count(*) AS n_rows_affected FROM events
    JOIN m ON event_type = f""",
)
def value_map_effect(spark, sf_dir):
    events, mapping = _mapped_events(spark, sf_dir)
    return lookup.mapping_effect(events, mapping, ["event_type"])


@query(
    "version_diff",
    f"""WITH {_EVENT_MAP_SQL} SELECT 'event_type' AS "column", count(*) FILTER (WHERE t <> event_type) AS n_changed
    FROM events LEFT JOIN m ON event_type = f UNION ALL SELECT 'user_id', 0""",
)
def version_diff(spark, sf_dir):
    events, mapping = _mapped_events(spark, sf_dir)
    after = lookup.apply_value_map(events, mapping, ["event_type"])
    return lookup.version_diff(events, after, ["event_id"], ["event_type", "user_id"])


@query(
    "keyed_version_diff",
    f"""WITH {_EVENT_MAP_SQL} SELECT 'event_type' AS "column", count(*) FILTER (WHERE t <> event_type) AS n_changed
    FROM events LEFT JOIN m ON event_type = f UNION ALL SELECT 'user_id', 0""",
)
def keyed_version_diff(spark, sf_dir):
    """The same from two bucketed layers: buckets whose digests agree are left out."""
    events, mapping = _mapped_events(spark, sf_dir)
    after = lookup.apply_value_map(events, mapping, ["event_type"])
    layers = [
        keyed_layers.write_keyed_layer(side, scratch_path(spark, "keyed-events"), ["event_id"])
        for side in (events, after)
    ]
    return keyed_layers.layer_diff(*layers, ["event_type", "user_id"])


# -------------------------------------------------------------------- classification


def _structure(spark, sf_dir) -> DataFrame:
    """A two-level code structure drawn from the customers: the regions they live in are
    level 1, their nations level 2.  Every customer lists both."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").select("c_nationkey")
    lived_in = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    section = F.concat(
        F.substring(F.lit("ABCDE"), F.col("r_regionkey") + 1, F.lit(1)), F.lit(" "), F.col("r_name")
    )
    divisions = lived_in.select(
        F.lit(2).alias("Level"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("Code"),
        section.alias("Section"),
        F.col("n_name").alias("Title"),
    )
    groups = lived_in.select(
        F.lit(1).alias("Level"),
        F.col("r_regionkey").cast("string").alias("Code"),
        section.alias("Section"),
        F.col("r_name").alias("Title"),
    )
    return divisions.unionByName(groups)


_STRUCTURE = """sections AS (SELECT DISTINCT n_nationkey AS division, substr('ABCDE', r_regionkey + 1, 1) AS letter,
    r_name AS title, CAST(r_regionkey AS VARCHAR) AS major FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey), majors AS (SELECT DISTINCT major, title FROM sections)"""


def hierarchies(spark, sf_dir) -> dict[str, Hierarchy]:
    structure = _structure(spark, sf_dir)
    majors = lookup.major_group_labels(structure)
    return {
        "industry": Hierarchy(lookup.division_sections(structure), lookup.section_labels(structure)),
        "occupation": Hierarchy(
            majors.select(F.col("group_code").alias("group_key"), "group_code"), majors
        ),
    }


@query(
    "division_sections",
    f"WITH {_STRUCTURE} SELECT division AS group_key, letter AS group_code FROM sections",
)
def division_sections(spark, sf_dir):
    return lookup.division_sections(_structure(spark, sf_dir))


@query(
    "section_labels",
    f"WITH {_STRUCTURE} SELECT DISTINCT letter AS group_code, title AS group_label FROM sections",
)
def section_labels(spark, sf_dir):
    return lookup.section_labels(_structure(spark, sf_dir))


@query(
    "major_group_labels",
    f"WITH {_STRUCTURE} SELECT major AS group_code, title AS group_label FROM majors",
)
def major_group_labels(spark, sf_dir):
    return lookup.major_group_labels(_structure(spark, sf_dir))


INDUSTRY = ClassifyRule(
    "code", "section", "section_label", "industry", leading=2, numeric_key=True, blank_is_code=True
)
OCCUPATION = ClassifyRule("code", "major_group", "major_group_label", "occupation")


def _codes(spark, sf_dir):
    """Codes of one to five digits that lost their leading zeros; some are blank or missing."""
    number = F.col("p_partkey") * 7
    code = (
        F.when(F.col("p_brand") == "Brand#3", F.lit(None).cast("string"))
        .when(F.col("p_brand") == "Brand#4", F.lit(" "))
        .otherwise(number.cast("string"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("code"))


_CODES = """codes AS (SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN NULL WHEN p_brand = 'Brand#4' THEN ' '
    ELSE CAST(p_partkey * 7 AS VARCHAR) END AS code FROM part),
    padded AS (SELECT *, CASE WHEN length(trim(code)) < 4 THEN lpad(trim(code), 4, '0') ELSE trim(code) END AS full_code
    FROM codes)"""


@query(
    "classify_sections",
    f"""WITH {_STRUCTURE}, {_CODES} SELECT p_partkey, code, letter AS section, title AS section_label
    FROM padded LEFT JOIN sections ON CAST(substr(full_code, 1, 2) AS INTEGER) = division""",
)
def classify_sections(spark, sf_dir):
    industry = hierarchies(spark, sf_dir)["industry"]
    return lookup.classify(_codes(spark, sf_dir), INDUSTRY, industry.groups, industry.labels)


@query(
    "classify_groups",
    f"""WITH {_STRUCTURE}, {_CODES} SELECT p_partkey, code, major AS major_group, title AS major_group_label
    FROM padded LEFT JOIN majors ON trim(code) <> '' AND substr(full_code, 1, 1) = major""",
)
def classify_groups(spark, sf_dir):
    occupation = hierarchies(spark, sf_dir)["occupation"]
    return lookup.classify(_codes(spark, sf_dir), OCCUPATION, occupation.groups, occupation.labels)


@query(
    "classification_coverage",
    f"""WITH {_STRUCTURE}, {_CODES} SELECT 'code' AS code_column, count(code) AS n_coded, count(letter) AS n_classified,
    count(code) - count(letter) AS n_unclassified
    FROM padded LEFT JOIN sections ON CAST(substr(full_code, 1, 2) AS INTEGER) = division""",
)
def classification_coverage(spark, sf_dir):
    return lookup.classification_coverage(classify_sections(spark, sf_dir), [("code", "section")])


# ------------------------------------------------------------------ the cleaning plan

SALES = DatasetSpec(
    name="sales",
    keys=("l_orderkey", "l_linenumber"),
    entity="l_orderkey",
    ranges=(RangeRule("l_quantity", 1, 49), RangeRule("l_discount", 0, 0.08)),
    sentinels=(SentinelRule(("l_quantity",), 50.0, "Medium"), SentinelRule(("l_tax",), 0.08)),
    derived=(DerivedTotal("l_total", ("l_quantity", "l_linenumber"), gate="returned"),),
    raw_consistency=(ConsistencyRule("total_mismatch", ("l_quantity", "l_linenumber"), "l_total", 1.0),),
    skips=(SkipRule("return_unexplained", "returned", ("l_returnflag = 'A'", "l_tax > 0.05"), "unexplained"),),
    outliers=OutlierRule(("l_extendedprice", "volume", "l_suppkey")),
    free_text=("p_name",),
    merge_threshold=0.95,
    value_map=(("l_linestatus", "O", "Open"), ("l_linestatus", "F", "Filled")),
    classify=(
        ClassifyRule(
            "part_code", "section", "section_label", "industry",
            leading=2, numeric_key=True, blank_is_code=True,
        ),
    ),
    impute=(ImputeRule("l_quantity", "returned IS NOT NULL", "Returned lines"),),
    summary_columns=("l_quantity", "l_extendedprice"),
    scope_columns=("l_quantity", "l_tax"),
    missing_findings=(
        MissingRule("returned", "l_returnflag <> 'N'", "High", "left empty"),
        MissingRule("l_quantity"),
    ),
    gates=(GateRule("returned", "l_linestatus", "F"),),
    frequencies=(FrequencySpec("status", "l_linestatus"),),
    bins=(("l_quantity", (("low", 0, 25), ("high", 25, 60))),),
    share=("l_linestatus", ("O", "F")),
    dominant="l_returnflag",
)


def sales(spark, sf_dir) -> DataFrame:
    """Line items with their part's name, a reported total that is sometimes wrong, and an
    answer that only returned lines have."""
    error = F.when(F.col("l_discount") == 0.1, 2).when(F.col("l_discount") == 0.09, 1).otherwise(0)
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return (
        line_items(spark, sf_dir)
        .join(part, "l_partkey")
        .select(
            *[c for c in table(spark, sf_dir, "lineitem").columns],
            "p_name",
            F.nullif(F.col("l_returnflag"), F.lit("N")).alias("returned"),
            (F.col("l_quantity") + F.col("l_linenumber") + error).alias("l_total"),
            (F.col("l_extendedprice") * F.col("l_quantity")).alias("volume"),
            (F.col("l_partkey") * 3).cast("string").alias("part_code"),
        )
    )


SALES_SQL = f"""{LINE_ITEMS}, sales AS (SELECT items.*, p_name, nullif(l_returnflag, 'N') AS returned,
    l_quantity + l_linenumber + CASE WHEN l_discount = 0.1 THEN 2 WHEN l_discount = 0.09 THEN 1 ELSE 0 END AS l_total,
    l_extendedprice * l_quantity AS volume, CAST(l_partkey * 3 AS VARCHAR) AS part_code
    FROM items JOIN part ON l_partkey = p_partkey)"""

_SALES_COLUMNS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate", "p_name", "returned", "l_total", "volume", "part_code",
]

CORRECTED_SALES_SQL = f"""{SALES_SQL}, kept AS (SELECT * FROM sales QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _SALES_COLUMNS)}) = 1),
    sentineled AS (SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity, nullif(l_tax, 0.08) AS l_tax) FROM kept),
    corrected AS (SELECT * REPLACE (CASE WHEN returned IS NOT NULL THEN l_quantity + l_linenumber END AS l_total)
    FROM sentineled)"""

_OUTLIERS = ["l_extendedprice", "volume", "l_suppkey"]

SALES_FLAGS_SQL = f"""flags AS (SELECT l_orderkey, l_linenumber, 'return_unexplained' AS rule_name,
    CAST(NULL AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high FROM corrected
    WHERE returned IS NOT NULL AND NOT coalesce(l_returnflag = 'A', false) AND NOT coalesce(l_tax > 0.05, false)
    UNION ALL """ + union_all(
    _OUTLIERS,
    "SELECT l_orderkey, l_linenumber, 'outlier_{c}', CAST({c} AS DOUBLE), low, high FROM corrected, FENCES_{c}"
    " WHERE {c} < low OR {c} > high",
) + ")"
SALES_FLAGS_SQL = reduce(
    lambda sql, c: sql.replace(f"FENCES_{c}", _fences("corrected", c)), _OUTLIERS, SALES_FLAGS_SQL
)

CLEANED_SALES_SQL = f"""{CORRECTED_SALES_SQL}, {SALES_FLAGS_SQL},
    {near_duplicates_sql("corrected", "p_name", 0.95)}, {consolidation_sql(0.95)}, {_STRUCTURE},
    cleaned AS (SELECT corrected.* REPLACE (CASE l_linestatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled'
    ELSE l_linestatus END AS l_linestatus, coalesce(to_value, p_name) AS p_name),
    letter AS section, title AS section_label FROM corrected LEFT JOIN mapping ON p_name = from_value
    LEFT JOIN sections ON CAST(substr(CASE WHEN length(part_code) < 4 THEN lpad(part_code, 4, '0') ELSE part_code END,
    1, 2) AS INTEGER) = division)"""


def clean_sales(spark, sf_dir) -> Cleaned:
    return clean(sales(spark, sf_dir), SALES, hierarchies(spark, sf_dir))


@query("clean_table", f"WITH RECURSIVE {CLEANED_SALES_SQL} SELECT * FROM cleaned")
def clean_table(spark, sf_dir):
    return clean_sales(spark, sf_dir).table


@query(
    "clean_flags",
    f"""WITH {CORRECTED_SALES_SQL}, {SALES_FLAGS_SQL} SELECT l_orderkey, l_linenumber, rule_name,
    round(value, 4) AS value, round(low, 4) AS low, round(high, 4) AS high FROM flags""",
)
def clean_flags(spark, sf_dir):
    flags = clean_sales(spark, sf_dir).flags
    return flags.select(
        *KEY, "rule_name", *[F.round(c, 4).alias(c) for c in ("value", "low", "high")]
    )


@query(
    "flag_summary",
    f"""WITH {CORRECTED_SALES_SQL}, {SALES_FLAGS_SQL} SELECT count(*) AS n_flags,
    count(DISTINCT (l_orderkey, l_linenumber)) AS n_rows, count(DISTINCT rule_name) AS n_rules FROM flags""",
)
def flag_summary(spark, sf_dir):
    return rules.flag_summary(clean_sales(spark, sf_dir).flags, KEY)


@query(
    "flag_counts",
    f"""WITH {CORRECTED_SALES_SQL}, {SALES_FLAGS_SQL} SELECT rule_name, count(*) AS n_flags FROM flags
    GROUP BY rule_name""",
)
def flag_counts(spark, sf_dir):
    return rules.flag_counts(clean_sales(spark, sf_dir).flags)


@query(
    "clean_metrics",
    f"""WITH RECURSIVE {CLEANED_SALES_SQL}
    SELECT 'dedup' AS step, 'rows dropped' AS item, (SELECT count(*) FROM sales) - (SELECT count(*) FROM kept) AS value
    UNION ALL SELECT 'dedup', 'rows kept', count(*) FROM kept
    UNION ALL SELECT 'raw_consistency', 'total_mismatch', count(*) FROM kept
    WHERE abs(l_quantity + l_linenumber - l_total) > 1
    UNION ALL SELECT 'sentinel', 'l_quantity', count(*) FROM kept WHERE l_quantity = 50
    UNION ALL SELECT 'sentinel', 'l_tax', count(*) FROM kept WHERE l_tax = 0.08
    UNION ALL SELECT 'derived_total', 'l_total', count(*) FROM sentineled WHERE l_total IS DISTINCT FROM
    CASE WHEN returned IS NOT NULL THEN l_quantity + l_linenumber END
    UNION ALL SELECT 'flags', 'flags', count(*) FROM flags
    UNION ALL SELECT 'flags', 'flagged rows', count(DISTINCT (l_orderkey, l_linenumber)) FROM flags
    UNION ALL SELECT 'flags', 'rules', count(DISTINCT rule_name) FROM flags
    UNION ALL SELECT 'value_map', 'l_linestatus', count(*) FROM corrected WHERE l_linestatus IN ('O', 'F')
    UNION ALL SELECT 'variants_merged', 'p_name', count(*) FROM mapping
    UNION ALL SELECT 'rows_consolidated', 'p_name', count(*) FROM corrected JOIN mapping ON p_name = from_value
    UNION ALL SELECT 'n_coded', 'part_code', count(part_code) FROM cleaned
    UNION ALL SELECT 'n_classified', 'part_code', count(section) FROM cleaned""",
)
def clean_metrics(spark, sf_dir):
    return clean_sales(spark, sf_dir).metrics

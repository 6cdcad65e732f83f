"""Quantiles, summaries, histograms and median imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import impute as imputation
from tidemark.operators import numeric, rules, sketches
from tidemark.queries.registry import query, table, union_all
from tidemark.session import scratch_path
from tidemark.spec import DerivedTotal, ImputeRule, SentinelRule

_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "numeric_summary",
    union_all(
        _LINE_NUMBERS,
        "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, median({c}) AS median,"
        " min({c}) AS min, max({c}) AS max FROM lineitem",
    ),
)
def numeric_summary(spark, sf_dir):
    return numeric.numeric_summary(table(spark, sf_dir, "lineitem"), _LINE_NUMBERS)


@query(
    "quantiles",
    union_all(
        ["o_totalprice"],
        "SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.05), 4) AS p05, round(quantile_cont({c}, 0.25), 4) AS p25,"
        " round(quantile_cont({c}, 0.75), 4) AS p75, round(quantile_cont({c}, 0.95), 4) AS p95 FROM orders",
    ),
)
def quantiles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    found = numeric.exact_quantiles(orders, {"o_totalprice": [0.05, 0.25, 0.75, 0.95]})
    names = ["p05", "p25", "p75", "p95"]
    return spark.range(1).select(
        F.lit("o_totalprice").alias("column"),
        *[F.round(F.lit(v), 4).alias(n) for n, v in zip(names, found["o_totalprice"][1])],
    )


_ORDER_NUMBERS = ["o_totalprice", "o_orderkey"]


@query(
    "numeric_summary_kept",
    union_all(
        _ORDER_NUMBERS,
        "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, CAST(median({c}) AS DOUBLE) AS median,"
        " CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM orders",
    ),
)
def numeric_summary_kept(spark, sf_dir):
    """Closed orders come first, the others later; the sketches of both batches are kept."""
    orders = table(spark, sf_dir, "orders")
    closed = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    path = scratch_path(spark, "order-sketches")
    sketches.write_sketches(orders.filter(closed), _ORDER_NUMBERS, path)
    kept = sketches.write_sketches(orders.filter(~closed), _ORDER_NUMBERS, path)
    return numeric.numeric_summary(orders, _ORDER_NUMBERS, kept)


def _histogram_sql(relation: str, column: str, bins: int) -> str:
    """Bins by comparing with the edges ``lo + i * step``; the last bin is closed."""
    return f"""WITH e AS (SELECT min({column}) AS lo, max({column}) AS hi,
    (max({column}) - min({column})) / {bins} AS step FROM {relation}),
    b AS (SELECT i AS bin, lo + i * step AS "lower", CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * step END
    AS "upper" FROM e, range({bins}) AS r(i))
    SELECT bin, round("lower", 6) AS "lower", round("upper", 6) AS "upper", count({column}) AS "count"
    FROM b LEFT JOIN {relation} ON {column} >= "lower" AND ({column} < "upper" OR (bin = {bins - 1} AND {column} <= "upper"))
    GROUP BY ALL"""


def _rounded_edges(df):
    return df.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query("histogram_20", _histogram_sql("lineitem", "l_quantity", 20))
def histogram_20(spark, sf_dir):
    return _rounded_edges(numeric.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", 20))


@query("histogram_30", _histogram_sql("events", "value", 30))
def histogram_30(spark, sf_dir):
    return _rounded_edges(numeric.histogram(table(spark, sf_dir, "events"), "value", 30))


# ----------------------------------------------------------------------- imputation

_SIZE_UNKNOWN = SentinelRule(("p_size",), 50)


def _parts(spark, sf_dir):
    """Parts whose size 50 stands for "unknown" and whose price is missing for one brand."""
    part = table(spark, sf_dir, "part").withColumn(
        "price", F.when(F.col("p_brand") != "Brand#7", F.floor("p_retailprice"))
    )
    return rules.correct_sentinels(part, [_SIZE_UNKNOWN])


_PARTS = """parts AS (SELECT p_partkey, p_name, p_brand, p_type, nullif(p_size, 50) AS p_size, p_retailprice,
    CASE WHEN p_brand <> 'Brand#7' THEN CAST(floor(p_retailprice) AS BIGINT) END AS price FROM part)"""

_SIZE_RULE = ImputeRule("p_size", "p_type IN ('ECONOMY', 'SMALL', 'LARGE')", "Three types")
_PRICE_RULE = ImputeRule("price", None, "Everyone")

_FILLED = f"""{_PARTS}, med AS (SELECT CAST(round_even(median(p_size), 0) AS INTEGER) AS s,
    CAST(round_even(median(price), 0) AS BIGINT) AS p FROM parts),
    filled AS (SELECT p_partkey, p_type,
    CASE WHEN p_size IS NULL AND p_type IN ('ECONOMY', 'SMALL', 'LARGE') THEN s ELSE p_size END AS p_size,
    coalesce(price, p) AS price,
    p_size IS NULL AND p_type IN ('ECONOMY', 'SMALL', 'LARGE') AS p_size_imputed,
    price IS NULL AS price_imputed FROM parts, med)"""


@query(
    "impute_median",
    f"WITH {_FILLED} SELECT p_partkey, p_type, p_size, p_size_imputed FROM filled",
)
def impute_median(spark, sf_dir):
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type", "p_size")
    filled, _ = imputation.impute_median(parts, "p_size", _SIZE_RULE.population)
    return filled


def _fills(parts):
    return imputation.fit_medians(parts, [_SIZE_RULE, _PRICE_RULE])


@query(
    "impute_plan",
    f"WITH {_FILLED} SELECT p_partkey, p_type, p_size, price, p_size_imputed, price_imputed FROM filled",
)
def impute_plan(spark, sf_dir):
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type", "p_size", "price")
    return imputation.impute(parts, _fills(parts))


@query(
    "impute_ledger",
    f"""WITH {_FILLED} SELECT 'p_size' AS variable, 'Median' AS method,
    count(*) FILTER (WHERE p_size_imputed) AS n_imputed, (SELECT CAST(s AS BIGINT) FROM med) AS fill_value,
    'Three types' AS population FROM filled
    UNION ALL SELECT 'price', 'Median', count(*) FILTER (WHERE price_imputed), (SELECT p FROM med), 'Everyone'
    FROM filled""",
)
def impute_ledger(spark, sf_dir):
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type", "p_size", "price")
    fills = _fills(parts)
    return imputation.imputation_ledger(imputation.impute(parts, fills), fills)


@query(
    "impute_scoped_median",
    f"""WITH {_PARTS}, med AS (SELECT CAST(round_even(median(p_size), 0) AS INTEGER) AS s FROM parts
    WHERE p_type IN ('ECONOMY', 'SMALL', 'LARGE'))
    SELECT p_partkey, CASE WHEN p_size IS NULL AND p_type IN ('ECONOMY', 'SMALL', 'LARGE') THEN s ELSE p_size END
    AS p_size, p_size IS NULL AND p_type IN ('ECONOMY', 'SMALL', 'LARGE') AS p_size_imputed FROM parts, med""",
)
def impute_scoped_median(spark, sf_dir):
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type", "p_size")
    fills = imputation.fit_medians(parts, [_SIZE_RULE], within_population=True)
    return imputation.impute(parts, fills).drop("p_type")


_TOTAL = DerivedTotal("size_and_price", ("p_size", "price"), gate="p_type")


@query(
    "impute_totals",
    f"""WITH {_FILLED}, t AS (SELECT parts.p_size + parts.price AS old, filled.p_size + filled.price AS new
    FROM parts JOIN filled USING (p_partkey))
    SELECT 'size_and_price' AS "column", count(*) FILTER (WHERE old IS DISTINCT FROM new) AS n_changed FROM t""",
)
def impute_totals(spark, sf_dir):
    parts = _parts(spark, sf_dir).select("p_partkey", "p_type", "p_size", "price")
    with_total = rules.recompute_totals(parts, [_TOTAL])
    filled = imputation.impute(with_total, _fills(parts))
    return rules.change_counts(filled, rules.derived_totals(filled, [_TOTAL]))


_BINS = 25


@query(
    "observed_vs_imputed",
    f"""WITH {_FILLED}, e AS (SELECT min(p_size) AS lo, max(p_size) AS hi,
    (max(p_size) - min(p_size)) / {_BINS} AS step FROM filled WHERE NOT p_size_imputed),
    b AS (SELECT i AS bin, lo + i * step AS "lower", CASE WHEN i = {_BINS - 1} THEN hi ELSE lo + (i + 1) * step END
    AS "upper" FROM e, range({_BINS}) AS r(i))
    SELECT bin, round("lower", 6) AS "lower", round("upper", 6) AS "upper",
    count(p_partkey) FILTER (WHERE NOT p_size_imputed) AS n_observed,
    count(p_partkey) FILTER (WHERE p_size_imputed) AS n_imputed
    FROM b LEFT JOIN filled ON p_size >= "lower" AND (p_size < "upper" OR (bin = {_BINS - 1} AND p_size <= "upper"))
    GROUP BY ALL""",
)
def observed_vs_imputed(spark, sf_dir):
    return _rounded_edges(
        numeric.observed_vs_imputed(impute_median(spark, sf_dir), "p_size", "p_size_imputed", _BINS)
    )

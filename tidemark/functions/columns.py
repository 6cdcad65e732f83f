"""Column expressions shared by the operators.  All of them stay JVM-side."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The texts a data CSV uses for "no value".
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# the cast to double also reads type suffixes, hexadecimal and words; numbers need none
_NOT_IN_A_NUMBER = r"[^0-9eE+.\-\s]"

INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")


def quoted(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col(sql_name(name))


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def na_to_null(column: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~column.isin(*tokens), column)


def is_true(condition: Column) -> Column:
    """A condition with SQL's "unknown" read as false, safe to negate."""
    return F.coalesce(condition, F.lit(False))


def changed(before: Column, after: Column) -> Column:
    """Null-safe "the value is not the same any more"."""
    return ~before.eqNullSafe(after)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, places)).otherwise(F.lit(0.0))


# all white space of Unicode, and the separators that control characters stand for
_SPACE = r"(?U)[\s\x1c-\x1f]"


def strip(column: Column | str) -> Column:
    """Text without white space around it: blanks, tabs, line breaks and their like."""
    return F.regexp_replace(column, rf"^{_SPACE}+|{_SPACE}+$", "")


def blank_to_null(column: Column) -> Column:
    return F.when(strip(column) != "", column)


def zero_pad(column: Column, width: int) -> Column:
    """Left-pad with zeros.  Longer text is kept whole (``lpad`` alone would cut it)."""
    return F.when(F.length(column) < width, F.lpad(column, width, "0")).otherwise(column)


def number_sql(column: str, type_name: str) -> str:
    """SQL that parses the text column ``column`` as ``type_name`` (tinyint, smallint, int,
    bigint or double).

    Text that is no number, a fraction where a whole number is wanted, and a value out of
    range all become NULL, so that a coercion report can count them.  Plain digits, the
    usual case, are settled by the first cast and never pass through a double, so large
    integers stay exact.
    """
    text = sql_name(column)
    as_double = f"CASE WHEN NOT {text} RLIKE {sql_text(_NOT_IN_A_NUMBER)} THEN try_cast(trim({text}) AS DOUBLE) END"
    if type_name == "double":
        return as_double
    # the cast itself refuses values out of range, except for 2^63, which it would round down
    fits = f" AND ({as_double}) < 9223372036854775808D" if type_name == "bigint" else ""
    whole_double = (
        f"CASE WHEN ({as_double}) = floor({as_double}){fits} THEN try_cast({as_double} AS {type_name}) END"
    )
    return f"coalesce(try_cast(trim({text}) AS {type_name}), {whole_double})"


def number_text(column: Column) -> Column:
    """A number as plain decimal text with all its digits: ``10000.0``, never ``1.0E4``."""
    return without_exponent(column.cast("double").cast("string"))


def without_exponent(text: Column) -> Column:
    """The text of a number, its decimal point moved by the exponent if it has one.  Any other
    text stays as it is."""
    mantissa = F.ltrim(F.substring_index(text, "E", 1), F.lit("-"))
    whole, after = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    fraction = F.when(after == "0", F.lit("")).otherwise(after)
    shift = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    moved = (
        F.when(shift < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -shift - 1), whole, fraction))
        .when(
            shift >= F.length(fraction),
            F.concat(whole, fraction, F.repeat(F.lit("0"), shift - F.length(fraction)), F.lit(".0")),
        )
        .otherwise(
            F.concat(whole, F.substr(fraction, F.lit(1), shift), F.lit("."), F.substr(fraction, shift + 1))
        )
    )
    return F.when(~F.contains(text, F.lit("E")), text).otherwise(F.concat(sign, moved))


def whole_number_text(column: Column) -> Column:
    """A number rounded half-even to a whole, as text; numbers of any size."""
    value = column.cast("double")
    # from 2**53 on every double is whole
    whole = F.when(F.abs(value) < float(1 << 53), F.bround(value, 0).try_cast("bigint").cast("string"))
    return F.coalesce(whole, F.regexp_replace(number_text(value), r"\.0$", ""))


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A short declared list as a DataFrame.  It is one JSON literal, folded while planning,
    so neither the driver nor the generated code grows with the number of rows."""
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def lay_out(
    df: DataFrame, schema: str, labels: Sequence[Sequence], measures: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Turn one row of aggregates into one row per label.

    ``labels`` are declared rows of ``schema``; each entry of ``measures`` gives one SQL
    expression per label.  Measures travel as arrays and labels as one literal, so a profile
    of hundreds of columns still plans quickly and fits into generated code.
    """
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in labels])
    arrays = [f"array({', '.join(expressions)}) AS {sql_name(m)}" for m, expressions in measures.items()]
    zipped = ", ".join(sql_name(m) for m in measures)
    one = df.selectExpr(*arrays).selectExpr(f"posexplode(arrays_zip({zipped})) AS (at, measure)")
    label = F.from_json(F.lit(text), f"array<struct<{schema}>>")[F.col("at")]
    return one.select(label.alias("label"), "measure").select("label.*", "measure.*")


def stack_rows(rows: Sequence[Sequence[tuple[str, Column]]]) -> Column:
    """Turn a fixed list of rows built from one input row into a table-valued column:
    ``df.select(stack_rows([...]))``.  Used after a one-row aggregate to lay many measures
    out as rows."""
    return F.inline(
        F.array(*[F.struct(*[value.alias(name) for name, value in row]) for row in rows])
    )

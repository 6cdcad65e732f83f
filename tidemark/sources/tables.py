"""Reading text data and dictionaries; writing layers, reports and labelled exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import NA_TOKENS, quoted, sql_name, sql_text

# The labels of imputation flags.
FLAG_LABELS = {"0": "Not imputed", "1": "Imputed"}
# Layers stay side by side until a run ends, so they are packed more tightly than Spark's default does.
LAYER_CODEC = "zstd"
# Rows of a file of compressed CSV, which one task reads whole.
TEXT_ROWS = 500_000


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``column, description, type, choices``; descriptions may span lines and hold quotes."""
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .schema("column string, description string, type string, choices string")
        .csv(path)
    )


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV with every column as text and the NA tokens as NULL.

    With ``columns`` given, no pass over the data is spent on the header beyond checking it.
    ``multi_line`` allows line breaks inside values; such files cannot be split, so it is off
    for large data.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
    )
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    missing = ", ".join(sql_text(token) for token in na_tokens)
    return df.selectExpr(
        *[f"CASE WHEN {n} NOT IN ({missing}) THEN {n} END AS {n}" for n in map(sql_name, df.columns)]
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to text, as a CSV holds it."""
    return df.selectExpr(*[f"CAST({n} AS STRING) AS {n}" for n in map(sql_name, df.columns)])


def write_text_csv(df: DataFrame, path: str) -> None:
    """A table as the text CSV that ``read_text_csv`` reads, compressed.  Files that are compressed cannot be
    split, so each holds ``TEXT_ROWS`` rows at most."""
    writer = as_text(df).write.mode("overwrite").option("maxRecordsPerFile", TEXT_ROWS)
    # the quickest level: text of numbers packs nearly as well with it
    packed = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    _exact_text(packed).csv(path)


def write_layer(df: DataFrame, path: str) -> DataFrame:
    """Write a parquet layer and return it as read back.  Writing over one's own input is
    refused by Spark, so a layer always has its own folder."""
    df.write.mode("overwrite").option("compression", LAYER_CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report table as CSV with header; text is written exactly as it is."""
    _exact_text(df.write.mode("overwrite")).csv(path)


def _exact_text(writer: DataFrameWriter) -> DataFrameWriter:
    return (
        writer.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def with_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Attach a variable label to every column, next to the metadata it has."""
    return df.select(
        *[
            quoted(f.name).alias(f.name, metadata={**f.metadata, "label": labels.get(f.name) or ""})
            for f in df.schema.fields
        ]
    )


def flags_to_codes(df: DataFrame, suffix: str = "_imputed") -> DataFrame:
    """Boolean flag columns as 0/1 with their value labels in the metadata."""
    columns = []
    for field in df.schema.fields:
        if field.name.endswith(suffix):
            metadata = {**field.metadata, "value_labels": FLAG_LABELS}
            columns.append(quoted(field.name).cast("tinyint").alias(field.name, metadata=metadata))
        else:
            columns.append(quoted(field.name))
    return df.select(*columns)


def labels_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata.get("label", "") for f in df.schema.fields}


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows, columns and an order-independent checksum of the content.  The hash passes over NULLs,
    so which values are NULL is hashed as well: a value that changes its column shows."""
    values = [quoted(c) for c in df.columns]
    digest = F.xxhash64(*values, *[value.isNull() for value in values]).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.coalesce(F.sum(digest), F.lit(0).cast("decimal(38,0)")).cast("string").alias("checksum"),
    )


def export_table(df: DataFrame, labels: Mapping[str, str], path: str) -> DataFrame:
    """Labelled export with a round-trip check: ``n_rows, n_columns, same_shape,
    same_schema, same_content, n_labelled``.  Raises if the copy differs."""
    labelled = flags_to_codes(with_labels(df, labels))
    back = write_layer(labelled, path)
    sent, got = fingerprint(labelled).first(), fingerprint(back).first()
    plain = [(f.name, f.dataType) for f in labelled.schema.fields]
    same_schema = plain == [(f.name, f.dataType) for f in back.schema.fields]
    kept = labels_of(back)
    result = {
        "n_rows": got["n_rows"],
        "n_columns": got["n_columns"],
        "same_shape": (sent["n_rows"], sent["n_columns"]) == (got["n_rows"], got["n_columns"]),
        "same_schema": same_schema,
        "same_content": sent["checksum"] == got["checksum"],
        "n_labelled": sum(1 for v in kept.values() if v),
    }
    if not (result["same_shape"] and result["same_schema"] and result["same_content"]):
        raise ValueError(f"export to {path} does not read back as written: {result}")
    return df.sparkSession.createDataFrame(
        [tuple(result.values())],
        "n_rows bigint, n_columns bigint, same_shape boolean, same_schema boolean, "
        "same_content boolean, n_labelled bigint",
    )

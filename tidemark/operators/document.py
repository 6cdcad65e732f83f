"""Documentation tables: labels, notes, the data dictionary, findings and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import is_true, literal_table, percent, quoted, stack_rows
from tidemark.operators.combine import Profile, answer
from tidemark.operators.distribution import pseudo_key_check, value_sets, width_condition
from tidemark.operators.impute import FLAG_SUFFIX
from tidemark.operators.missing import raw_vs_cleaned
from tidemark.operators.rules import consistency_flag
from tidemark.spec import DatasetSpec

# How the data dictionary words the treatment of a column.
TREATED = "Filled with the median"
IS_FLAG = "Marks filled values"
LEFT_MISSING = "Left empty on purpose"
NOTHING_MISSING = "Complete"
OUT_OF_SCOPE = "Not filled"
PSEUDO_KEY_SEVERITY = "High if used as a key"
STRUCTURAL_SEVERITY = "None (structural)"


def label_table(
    spark: SparkSession, columns: Sequence[str], descriptions: Mapping[str, str | None], derived: Mapping[str, str]
) -> DataFrame:
    """``column, label``.  Labels are a table of their own: first the columns that the
    dictionary describes, then derived columns; a flag borrows the label of the column it
    belongs to; what is left has an empty label."""
    given = literal_table(
        spark,
        [(c, d, 0) for c, d in descriptions.items() if d] + [(c, d, 1) for c, d in derived.items()],
        "column string, label string, place int",
    )
    given = given.groupBy("column").agg(F.min_by("label", "place").alias("label"))
    names = literal_table(spark, [(c, c.removesuffix(FLAG_SUFFIX)) for c in columns], "column string, base string")
    owner = given.select(F.col("column").alias("base"), F.col("label").alias("base_label"))
    flag = F.concat(F.coalesce("base_label", "base"), F.lit(": filled (yes or no)"))
    return (
        names.join(given, "column", "left")
        .join(owner, "base", "left")
        .select("column", F.coalesce("label", F.when(F.col("column") != F.col("base"), flag), F.lit("")).alias("label"))
    )


def column_labels(
    spark: SparkSession, columns: Sequence[str], descriptions: Mapping[str, str | None], derived: Mapping[str, str]
) -> dict[str, str]:
    """The label table as a dictionary, to be written into a schema: one entry per column."""
    return {r["column"]: r["label"] for r in label_table(spark, columns, descriptions, derived).collect()}


def note_table(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """``column, notes``: what the rules of a spec say about each column, in the order of the
    rules.  A note that the spec itself gives replaces them."""
    said = [(c, 1, f"Free text; spellings at least {spec.merge_threshold} alike are merged.") for c in spec.free_text]
    if spec.outliers:
        said += [(c, 2, f"Outliers beyond {spec.outliers.multiplier} IQR are flagged.") for c in spec.outliers.columns]
    said += [(g.dependent, 3, f"Asked only if {g.gate} is {g.applies_when}.") for g in spec.gates]
    told = literal_table(spark, said, "column string, place int, note string")
    told = told.groupBy("column").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "note"))), lambda x: x["note"]), " ").alias("rules")
    )
    own = literal_table(spark, list(spec.notes.items()), "column string, own string")
    return told.join(own, "column", "full").select("column", F.coalesce("own", "rules").alias("notes"))


def data_dictionary(
    spec: DatasetSpec,
    raw: DataFrame,
    cleaned: DataFrame,
    final: DataFrame,
    descriptions: Mapping[str, str | None],
    known_raw: DataFrame | None = None,
) -> DataFrame:
    """One row per column of the final table: ``variable, type, label, value_set_or_range,
    pct_missing_raw, pct_missing_cleaned, imputation_treatment, notes``.  ``known_raw`` are the null
    counts of the raw table, if it has been profiled."""
    columns = final.columns
    types = dict(final.dtypes)
    kinds = {f.name: f.metadata.get("kind") for f in final.schema.fields}
    missing = raw_vs_cleaned(raw, cleaned, columns, known_raw)
    sets = value_sets(final)
    flagged = [c for c in columns if c + FLAG_SUFFIX in columns]
    names = literal_table(
        final.sparkSession,
        [
            (i, c, "category" if kinds[c] == "category" else types[c])
            for i, c in enumerate(columns)
        ],
        "position int, column string, type string",
    )
    names = names.join(label_table(final.sparkSession, columns, descriptions, spec.derived_labels), "column").join(
        note_table(final.sparkSession, spec), "column", "left"
    )
    if flagged:
        counted = final.agg(
            *[F.count_if(quoted(c + FLAG_SUFFIX)).alias(f"n{i}") for i, c in enumerate(flagged)]
        ).select(
            stack_rows(
                [[("column", F.lit(c)), ("n_imputed", F.col(f"n{i}"))] for i, c in enumerate(flagged)]
            )
        )
        names = names.join(counted, "column", "left")
    else:
        names = names.withColumn("n_imputed", F.lit(None).cast("bigint"))
    column = F.col("column")
    none_missing = F.coalesce(
        F.col("pct_missing_cleaned").try_cast("double") == 0,
        # a derived column is absent from the cleaned layer: nothing known to be missing
        F.lit(True),
    )
    treatment = (
        F.when(
            F.col("n_imputed").isNotNull(),
            F.concat(F.lit(TREATED + ", "), F.col("n_imputed").cast("string"), F.lit(" row(s)")),
        )
        .when(column.endswith(FLAG_SUFFIX), F.lit(IS_FLAG))
        .when(column.isin(*spec.left_missing) if spec.left_missing else F.lit(False), F.lit(LEFT_MISSING))
        .when(none_missing, F.lit(NOTHING_MISSING))
        .otherwise(F.lit(OUT_OF_SCOPE))
    )
    return (
        names.join(missing.drop("position"), "column")
        .join(sets, "column", "left")
        .orderBy("position")
        .select(
            column.alias("variable"),
            "type",
            "label",
            F.coalesce("value_set_or_range", F.lit("")).alias("value_set_or_range"),
            "pct_missing_raw",
            "pct_missing_cleaned",
            treatment.alias("imputation_treatment"),
            F.coalesce("notes", F.lit("")).alias("notes"),
        )
    )


def dictionary_summary(dictionary: DataFrame) -> DataFrame:
    treatment = F.col("imputation_treatment")
    return dictionary.agg(
        F.count(F.lit(1)).alias("n_variables"),
        F.count_if(treatment.startswith(TREATED)).alias("n_imputed_variables"),
        F.count_if(treatment == LEFT_MISSING).alias("n_left_missing"),
    )


def inventory_profile(spec: DatasetSpec) -> Profile:
    """The findings of ``problem_inventory`` that are counts of rows."""
    measures: dict[str, Column] = {"n": F.count(F.lit(1))}
    rows: list[list[tuple[str, Column]]] = []

    def finding(variable: str, issue: str, count: Column, severity: Column, addressed_by: str) -> None:
        at = len(measures)
        measures[f"f{at}"] = count
        found = F.col(f"f{at}")
        rows.append(
            [
                ("variable", F.lit(variable)),
                ("issue", F.lit(issue)),
                ("count", found),
                ("pct", percent(found, F.col("n"))),
                ("severity", F.when(found == 0, F.lit("None")).otherwise(severity)),
                ("addressed_by", F.lit(addressed_by)),
            ]
        )

    for gap in spec.missing_findings:
        missing = quoted(gap.column).isNull()
        severity = F.lit(gap.severity)
        if gap.asked:
            at = len(measures)
            measures[f"f{at}"] = F.count_if(missing & is_true(F.expr(gap.asked)))
            severity = F.when(F.col(f"f{at}") == 0, F.lit(STRUCTURAL_SEVERITY)).otherwise(severity)
        finding(gap.column, "Missing", F.count_if(missing), severity, gap.addressed_by)
    for rule in spec.sentinels:
        for column in rule.columns:
            finding(
                column,
                f"sentinel value {rule.value}",
                F.count_if(quoted(column) == F.lit(rule.value)),
                F.lit(rule.severity),
                rule.addressed_by,
            )
    for rule in spec.raw_consistency:
        finding(
            rule.total,
            f"{'+'.join(rule.parts)} does not match within {rule.tolerance}",
            F.count_if(consistency_flag(rule).condition),
            F.lit(rule.severity),
            rule.addressed_by,
        )
    for rule in spec.derived:
        finding(
            rule.target,
            "computed total: recalculated from its parts, not validated against them",
            F.count_if(F.lit(False)),
            F.lit("None"),
            "recompute_totals",
        )
    for rule in spec.code_widths:
        finding(
            rule.column,
            rule.issue,
            F.count_if(width_condition(rule.column, rule.condition)),
            F.lit(rule.severity),
            rule.addressed_by,
        )
    if not rows:
        empty = "variable string, issue string, count bigint, pct double, severity string, addressed_by string"
        return Profile(measures, lambda counted: literal_table(counted.sparkSession, [], empty))
    return Profile(measures, lambda counted: counted.select(stack_rows(rows)))


def problem_inventory(df: DataFrame, spec: DatasetSpec, known: DataFrame | None = None) -> DataFrame:
    """Findings on the uncleaned table: ``variable, issue, count, pct, severity,
    addressed_by``; percentages are of all rows.  A rule brings its severity; nothing found is
    "None", and gaps where nothing was asked are structural.  Everything but the distinct counts of
    supposed IDs comes from one aggregate, ``known`` if a scan for other profiles has made it."""
    found = answer(df, inventory_profile(spec)) if known is None else known
    if spec.pseudo_keys:
        pseudo = pseudo_key_check(df, list(spec.pseudo_keys)).select(
            F.col("column").alias("variable"),
            F.concat(
                F.lit("named like an ID: "),
                F.col("n_distinct").cast("string"),
                F.lit(" distinct values across "),
                F.col("n_rows").cast("string"),
                F.lit(" rows"),
            ).alias("issue"),
            F.when(F.col("is_key"), F.lit(0)).otherwise(F.col("n_rows")).cast("bigint").alias("count"),
            F.when(F.col("is_key") | (F.col("n_rows") == 0), F.lit(0.0))
            .otherwise(F.lit(100.0))
            .alias("pct"),
            F.when(F.col("is_key"), F.lit("None")).otherwise(F.lit(PSEUDO_KEY_SEVERITY))
            .alias("severity"),
            F.lit("not used as a join key").alias("addressed_by"),
        )
        found = found.unionByName(pseudo)
    return found


def facts(section: str, table: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """A report table as rows ``section, item, metric, value``."""
    return table.select(
        F.lit(section).alias("section"),
        quoted(key).cast("string").alias("item"),
        stack_rows(
            [[("metric", F.lit(m)), ("value", quoted(m).cast("double"))] for m in metrics]
        ),
    )
